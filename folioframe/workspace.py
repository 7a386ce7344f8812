"""The folder that driver and executors share, for intermediate tables and written results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Characters or bytes of an Arrow batch that Python works on at once.
PIECE = 1 << 20

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where it is unset and the session runs in one process an own folder of this machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share: intermediate tables go there")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="folioframe-")
    return _OWN[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, where a result is used more than once."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tightly(df: DataFrame, name: str) -> DataFrame:
    """As :func:`stored`, in less room: for words of all texts, which take about half of it so."""
    return stored(df, name, compression="zstd")


def pieces(sizes: np.ndarray) -> Iterator[slice]:
    """A batch's rows in runs of at most ``PIECE`` in all, or of one larger row: what Python makes of a run is given on before the next one."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        until = max(at + 1, int(np.searchsorted(ends, PIECE + (ends[at - 1] if at else 0), "right")))
        yield slice(at, until)
        at = until


def in_pieces(texts: pd.Series) -> Iterator[pd.Series]:
    """A batch's texts in runs as :func:`pieces` gives them."""
    for p in pieces(np.array([len(t or "") for t in texts], np.int64)):
        yield texts.iloc[p]


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over as many tasks as the session has cores where the source gives fewer, as one file of one row group does; otherwise as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
