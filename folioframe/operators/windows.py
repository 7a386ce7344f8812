"""Neighbourhoods, sessions, fills, and rules on which row of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stored


def neighbour_text(text: Column, group: list[str], order: list[str], radius: int = 1, sep: str = " ") -> Column:
    """Texts of the rows up to ``radius`` away, joined in order; nulls count as ''."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(-radius, radius)
    return F.array_join(F.collect_list(F.coalesce(text, F.lit(""))).over(w), sep)


def neighbour_set(items: Column, group: list[str], order: list[str], radius: int = 1) -> Column:
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(-radius, radius)
    return F.array_distinct(F.flatten(F.collect_list(items).over(w)))


def session_number(ends: Column, group: list[str], order: list[str]) -> Column:
    """0 for the first session of a group; a row that ends a session belongs to it, the next row begins another."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(ends.cast("int")).over(w), F.lit(0))


def sessions(rows: DataFrame, ends: Column, group: list[str], order: list[str], text: str, sep: str = " ") -> DataFrame:
    """A row for each session: its number, its texts joined in order, and the number of rows."""
    x = rows.withColumn("session", session_number(ends, group, order))
    out = x.groupBy(*group, "session").agg(F.count("*").alias("lines"), F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("_t")))).alias("_p"))
    return out.select(*group, "session", "lines", F.array_join(F.transform("_p", lambda p: p["_t"]), sep).alias("text"))


def sessions_across(rows: DataFrame, ends: Column, block: str, order: list[str], text: str, sep: str = " ") -> DataFrame:
    """Sessions over the whole ordered corpus, by blocks (pages, conversations) in their order: numbers within blocks plus
    the sessions that earlier blocks ended, added up by ranges of blocks. (session, home, lines, text); home is the block of its first row."""
    x = rows.withColumns({"_end": ends.cast("int"), "_own": session_number(ends, [block], order)})
    totals = x.groupBy(block).agg(F.sum("_end").alias("_n"))
    x = x.join(sum_before_by_ranges(totals, [F.col(block)], F.col("_n"), "_before").drop("_n"), block).withColumn("session", F.col("_own") + F.col("_before"))
    part = F.struct(block, *order, F.coalesce(text, F.lit("")).alias("_t"))
    out = x.groupBy("session").agg(F.count("*").alias("lines"), F.min(block).alias("home"), F.array_sort(F.collect_list(part)).alias("_p"))
    return out.select("session", "home", "lines", F.array_join(F.transform("_p", lambda p: p["_t"]), sep).alias("text"))


def carry_forward(value: Column, group: list[str], order: list[str], default: Column | None = None) -> Column:
    """The last value that isn't null up to the row."""
    x = F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(x, default) if default is not None else x


def interpolate(value: Column, at: Column, group: list[str], order: list[str]) -> Column:
    """Nulls lie on the line between the neighbours that are known; at the ends the nearest known value stands."""
    known = F.when(value.isNotNull(), F.struct(at.cast("double").alias("x"), value.cast("double").alias("y")))
    w = Window.partitionBy(*group).orderBy(*order)
    a = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    inside = a["y"] + (b["y"] - a["y"]) * (at - a["x"]) / (b["x"] - a["x"])
    return F.coalesce(value.cast("double"), F.when(a.isNotNull() & b.isNotNull(), inside), a["y"], b["y"])


def monotone(value: Column, group: list[str], order: list[str], most: Column | None = None) -> Column:
    """Values rounded half to even, clamped to ``most``, and never below an earlier one."""
    v = F.bround(value).cast("long")
    v = F.least(v, most) if most is not None else v
    return F.max(v).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def fixed_chunks(rows: DataFrame, index: str, mapped: str, size: int, group: list[str]) -> DataFrame:
    """Chunks of ``size`` reference rows with the span of source positions they map to; empty ones go, the rest are numbered."""
    x = rows.withColumn("_c", F.floor(F.col(index) / size))
    out = x.groupBy(*group, "_c").agg(F.min(mapped).alias("first"), F.max(mapped).alias("last"), F.count("*").alias("n")).where("first is not null")
    return out.withColumn("chunk", F.row_number().over(Window.partitionBy(*group).orderBy("_c"))).drop("_c")


def latest_success(rows: DataFrame, key: list[str], ok: Column, order: list[str]) -> DataFrame:
    """Of each key the last good row; keys without one go."""
    good = rows.where(ok)
    rest = [c for c in rows.columns if c not in key]
    return good.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def success_else_first_error(rows: DataFrame, key: list[str], ok: Column, order: str) -> DataFrame:
    """Of each key the last good row, else its first row."""
    rest = [c for c in rows.columns if c not in key]
    rank = F.struct(ok.cast("int").alias("ok"), F.when(ok, F.col(order)).otherwise(-F.col(order)).alias("o"))
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(*key, "r.*")


def first_per_key(rows: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.min_by(value, F.struct(*order)).alias(value))


def dense_sequence(rows: DataFrame, group: list[str], order: list[Column], name: str = "seq") -> DataFrame:
    """1, 2, 3 ... within each group."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def page_context(rows: DataFrame, group: list[str], page: str, text: str, size: int = 240) -> DataFrame:
    """The end of page - 1 and the beginning of page + 1, by number; '' where there is no such page."""
    before = rows.select(*group, (F.col(page) + 1).alias(page), F.right(F.col(text), F.lit(size)).alias("previous"))
    after = rows.select(*group, (F.col(page) - 1).alias(page), F.left(F.col(text), F.lit(size)).alias("following"))
    out = rows.select(*group, page).join(before, [*group, page], "left").join(after, [*group, page], "left")
    return out.select(*group, page, F.coalesce("previous", F.lit("")).alias("previous"), F.coalesce("following", F.lit("")).alias("following"))


def fragment_groups(rows: DataFrame, page: str, order: str, anchor: str, continues: str) -> DataFrame:
    """Number the groups of fragments of each page: a fragment joins the open group if its anchor is the group's first one,
    or lies 0 or 1 after it and the fragment continues a text. A fold in one pass over a page's fragments."""
    item = F.struct(F.col(order).alias("o"), F.col(anchor).alias("a"), F.col(continues).alias("c"))
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("first"), F.array().cast("array<struct<o:bigint,g:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        joins = F.coalesce((x["a"] == s["first"]) | (x["c"] & (x["a"] - s["first"]).between(0, 1)), F.lit(False))
        n = s["n"] + F.when(joins, 0).otherwise(1)
        row = F.struct(x["o"].cast("long").alias("o"), n.alias("g"))
        return F.struct(n.alias("n"), F.when(joins, s["first"]).otherwise(x["a"]).cast("int").alias("first"), F.concat(s["out"], F.array(row)).alias("out"))

    out = rows.groupBy(page).agg(F.aggregate(F.array_sort(F.collect_list(item)), start, step, lambda s: s["out"]).alias("f"))
    return out.select(page, F.explode("f").alias("f")).select(page, F.col("f.o").alias(order), F.col("f.g").alias("fragment_group"))


def sum_before_by_ranges(rows: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before them in the order, as one window over all would give it, ties aside; 0 for the first.

    Rows are dealt into ranges of the order and stored with their range; what lies before a range is the sum of the ranges before it,
    of which the driver sees one number each. So no task sees more than its range.
    """
    spark = rows.sparkSession
    part, mine, before = f"_{name}_part", f"_{name}_value", f"_{name}_before"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = stored(rows.withColumn(mine, F.coalesce(value.cast("long"), F.lit(0))).repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()), "ranges")
    sums, offsets, total = {r[0]: r[1] for r in x.groupBy(part).agg(F.sum(mine)).collect()}, [], 0
    for p in sorted(sums):
        offsets.append((p, total))
        total += sums[p]
    known = F.broadcast(spark.createDataFrame(offsets, f"{part} int, {before} long"))  # a row a range
    w = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return x.join(known, part).withColumn(name, F.coalesce(F.sum(mine).over(w), F.lit(0)) + F.col(before)).drop(part, mine, before)


def rank_by_ranges(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place in the order, from 1, as row_number over one window would give it, ties aside."""
    return sum_before_by_ranges(rows, order, F.lit(1), name).withColumn(name, F.col(name) + 1)
