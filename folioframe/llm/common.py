"""Shared folder, stored intermediate tables and text constants used by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_path

#: A word is a run of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"

#: Spark's setting by which an execution's shuffle files go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs meanwhile go with its end; a later use of the same DataFrame would shuffle again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage is cut and lost executors cost nothing."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the path, for callers that delete the table when nothing reads it any more."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def unused(names: list[str], base: str) -> str:
    """A column name that begins with ``base`` and that none of ``names`` begins with, whatever its case."""
    taken = [n.lower() for n in names]
    name = f"_{base}"
    while any(n.startswith(name) for n in taken):
        name = f"_{name}"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast("long")
