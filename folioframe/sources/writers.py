"""Sinks: ordered JSON lines with an atomic switch, appends, CSV and TSV tables, a file for each row or group."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _switch(df: DataFrame, path: str, write) -> None:
    """Write beside ``path``, move the old result aside, rename the new one, and only then delete the old one.

    A folder can't replace another in one step on Hadoop's file systems. A crash in between leaves the old result whole under
    ``<path>.old``, and the next call, or :func:`recover`, puts it back if the new one didn't arrive.
    """
    spark = df.sparkSession
    recover(spark, path)
    aside = f"{path}.{uuid.uuid4().hex}"
    write(aside)
    fs, target = _fs(spark, path)
    old, new = _fs(spark, f"{path}.old")[1], _fs(spark, aside)[1]
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        recover(spark, path)
        raise OSError(f"cannot move {aside} to {path}")
    fs.delete(old, True)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def recover(spark: SparkSession, path: str) -> None:
    """After a crash between the two renames: the old result returns if there is no new one, and goes if there is."""
    fs, target = _fs(spark, path)
    old = _fs(spark, f"{path}.old")[1]
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)


def segment_order(df: DataFrame) -> list[Column]:
    """Page, body before footnotes, seq (missing ones last), id."""
    return [F.col("page_id").asc_nulls_first(), F.col("segment_id").contains("_fn_").asc(), F.coalesce("seq", F.lit(1_000_000_000)).asc(), F.col("segment_id").asc()]


def sorted_jsonl(df: DataFrame, path: str, order: list[Column]) -> None:
    """Range-sorted part files; their names' order is the rows' order."""
    _switch(df, path, lambda p: df.orderBy(*order).write.json(p))


def ordered_jsonl(df: DataFrame, path: str, position: str = "_pos") -> None:
    _switch(df, path, lambda p: df.orderBy(position).drop(position).write.json(p))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def metrics_csv(df: DataFrame, path: str, columns: list[str], digits: int = 4) -> None:
    """Columns in the given order, fractions rounded."""
    kinds = dict(df.dtypes)
    out = df.select(*[F.round(c, digits).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in columns])
    _switch(out, path, lambda p: out.write.option("header", True).csv(p))


def manifest_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    kinds = dict(df.dtypes)
    out = df.select(*[F.lower(F.col(c).cast("string")).alias(c) if kinds[c] == "boolean" else F.col(c) for c in columns])
    _switch(out, path, lambda p: out.write.option("header", True).csv(p))


def tsv(df: DataFrame, path: str) -> None:
    _switch(df, path, lambda p: df.write.option("header", True).option("sep", "\t").csv(p))


def text_per_group(df: DataFrame, path: str, group: str, text: str) -> None:
    """A folder ``<group>=<value>`` with one text file for each group (a single row each)."""
    _switch(df, path, lambda p: df.select(group, text).repartition(group).write.partitionBy(group).text(p))
