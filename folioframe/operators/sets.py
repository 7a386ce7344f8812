"""Set operations over keys, runs and n-grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intersect_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def except_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def union_runs(runs: dict[str, DataFrame], name: str = "run") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [r.withColumn(name, F.lit(k)) for k, r in runs.items()])


def without_subgrams(grams: DataFrame, gram: str = "phrase", count: str = "count", least: int = 2, most: int = 6) -> DataFrame:
    """Drop an (n-1)-gram that begins or ends an n-gram of equal count, n up to ``most``; all drops are decided on the given table."""
    words = F.split(F.col(gram), " ")
    n = F.size(words)
    ends = F.array(F.array_join(F.slice(words, F.lit(1), n - 1), " "), F.array_join(F.slice(words, F.lit(2), n - 1), " "))
    covered = grams.where((n > least) & (n <= most)).select(F.explode(ends).alias(gram), F.col(count)).distinct()
    return grams.join(covered, [gram, count], "left_anti")
