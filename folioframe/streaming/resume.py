"""Resumption: a sink of JSON lines that a killed run leaves in order, and rules on which work is done.

A batch's rows are staged under a hidden name and renamed to the name of the batch, so readers see whole batches only and a batch
that is run again after a kill replaces nothing and adds nothing. Rows of other writers may be errors or torn; a policy says
which of them count as done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.readers import CORRUPT

#: ``complete_only``: errors and empty results are tried again. ``any_row``: every row that can be read counts, error or not.
POLICIES = ("complete_only", "any_row")


class BatchSink:
    """JSON lines under ``path``, a folder for each run and batch; ``run`` names the stream, as batch numbers begin anew with a new checkpoint."""

    def __init__(self, spark: SparkSession, path: str, run: str = "run"):
        self.spark, self.path, self.run = spark, path.rstrip("/"), run

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def batch_path(self, batch: int) -> str:
        return f"{self.path}/{self.run}/batch={batch}"

    def has(self, batch: int) -> bool:
        fs, p = self._at(self.batch_path(batch))
        return fs.exists(p)

    def write(self, rows: DataFrame, batch: int) -> bool:
        """Store a batch unless it is there already; False if it was. A kill at any point leaves the batch whole or absent."""
        if self.has(batch):
            return False
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        rows.write.json(staged)
        fs, source = self._at(staged)
        target = self._at(self.batch_path(batch))[1]
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            fs.delete(source, True)
            if not self.has(batch):
                raise OSError(f"cannot move {staged} to {target}")
            return False
        return True

    def clear(self) -> None:
        """Take away all rows and what killed runs staged."""
        fs, p = self._at(self.path)
        fs.delete(p, True)


def load(spark: SparkSession, path: str, schema: StructType, key: str, error: str = "error", result: str | None = None) -> DataFrame:
    """The log's rows with ``status``: complete, error, empty (no result) or torn (no JSON, or no key). Blank lines and a missing folder give no rows."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], StructType([*schema.fields, StructField("status", StringType())]))
    lines = spark.read.option("recursiveFileLookup", True).text(path).where(F.regexp_replace("value", r"(?U)\s+", "") != "")
    rows = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
    blank = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"(?U)\s+", "") == ""
    status = F.when(F.col(CORRUPT).isNotNull() | F.col(key).isNull(), "torn")
    status = status.when(~blank(error), "error") if error in schema.fieldNames() else status
    status = status.when(blank(result), "empty") if result else status
    return rows.withColumn("status", status.otherwise("complete")).drop(CORRUPT)


def done(log: DataFrame, policy: str = "complete_only") -> Column:
    """Whether a row of :func:`load` counts its key as done."""
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}")
    return log["status"] == "complete" if policy == "complete_only" else log["status"] != "torn"


def remaining(work: DataFrame, log: DataFrame, key: str, policy: str = "complete_only") -> DataFrame:
    """Work whose key no row of the log counts as done; null keys never are."""
    return work.join(log.where(done(log, policy)).select(key), key, "left_anti")


def log_summary(log: DataFrame, key: str) -> DataFrame:
    """(status, rows, keys): how many rows and different keys each status has."""
    return log.groupBy("status").agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"))


def resume(spark: SparkSession, work: DataFrame, sink: BatchSink, schema: StructType, key: str, result: str | None = None, policy: str = "complete_only", restart_empty: bool = True) -> DataFrame:
    """What is left to do. With ``restart_empty`` an output of which nothing counts as done is emptied first, so that errors don't pile up."""
    log = load(spark, sink.path, schema, key, result=result)
    if restart_empty and log.where(done(log, policy)).isEmpty():
        sink.clear()
        return work
    return remaining(work, log, key, policy)


def process(stream: DataFrame, sink: BatchSink, checkpoint: str, call: Callable[[DataFrame], DataFrame], schema: StructType, key: str, result: str | None = None, policy: str = "complete_only"):
    """Run ``call`` over the stream's new rows that aren't done, once a batch.

    If the run dies between a batch's write and the checkpoint's commit, the batch is given again: it is there, so ``call`` isn't
    asked again and no row is written twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        if not sink.has(number):
            left = remaining(batch, load(batch.sparkSession, sink.path, schema, key, result=result), key, policy)
            sink.write(call(left), number)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
