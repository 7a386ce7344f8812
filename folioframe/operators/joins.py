"""Joins over runs, units, lines and markers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .literals import possible, required


def shared(a: DataFrame, b: DataFrame, key: str, values: list[str], first: list[str] | None = None) -> DataFrame:
    """Rows of keys that both runs have: ``<value>_a`` and ``<value>_b``; ``first`` columns are a's, else b's."""
    x = a.select(key, *[F.col(v).alias(f"{v}_a") for v in [*values, *(first or [])]])
    y = b.select(key, *[F.col(v).alias(f"{v}_b") for v in [*values, *(first or [])]])
    out = x.join(y, key)
    return out.select(key, *[f"{v}_{s}" for v in values for s in "ab"], *[F.coalesce(f"{v}_a", f"{v}_b").alias(v) for v in first or []])


def full_pair(a: DataFrame, b: DataFrame, key: str, value: str, source: str, missing: str = "(missing)") -> DataFrame:
    """All keys of two runs; a placeholder stands for a missing side, ``source_differs`` where both have unequal sources."""
    x = a.select(key, F.col(value).alias("a"), F.col(source).alias("_sa"), F.lit(True).alias("_ha"))
    y = b.select(key, F.col(value).alias("b"), F.col(source).alias("_sb"), F.lit(True).alias("_hb"))
    out = x.join(y, key, "full_outer")
    both = F.col("_ha").isNotNull() & F.col("_hb").isNotNull()
    side = lambda c, h: F.when(F.col(h).isNotNull(), F.coalesce(c, F.lit(""))).otherwise(F.lit(missing))
    return out.select(key, side("a", "_ha").alias("a"), side("b", "_hb").alias("b"), F.coalesce("_sa", "_sb").alias(source), (both & ~F.col("_sa").eqNullSafe(F.col("_sb"))).alias("source_differs"))


def left_compare(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Every row of ``a`` with b's value, status compared or a_only, and the difference."""
    y = b.select(key, F.col(value).alias("value_b"), F.lit(True).alias("_h"))
    out = a.select(key, F.col(value).alias("value_a")).join(y, key, "left")
    return out.select(key, "value_a", "value_b", F.when(F.col("_h"), "compared").otherwise("a_only").alias("status"), (F.col("value_b") - F.col("value_a")).alias("delta"))


def missing_and_unexpected(wanted: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Keys asked for and not there, and keys there that nobody asked for."""
    a = wanted.select(key).distinct().join(got.select(key), key, "left_anti").withColumn("problem", F.lit("missing"))
    return a.union(got.select(key).distinct().join(wanted.select(key), key, "left_anti").withColumn("problem", F.lit("unexpected")))


def paired_versions(versions: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """Rows of the first version, with ``<name>`` columns of all that pair with it by ``keys``."""
    named = [v.select(*keys, F.col(value).alias(n)) for n, v in versions.items()]
    return reduce(lambda a, b: a.join(b, keys, "left"), named)


def concat_lines(units: DataFrame, lines: DataFrame, unit: str, ids: str, line_id: str, text: str, sep: str = " ") -> DataFrame:
    """For each unit the texts of its lines, in the order of its id array; lines that don't exist are left out."""
    each = units.select(unit, F.posexplode(ids).alias("_pos", line_id)).join(lines.select(line_id, text), line_id, "left")
    parts = each.groupBy(unit).agg(F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("_pos", text)))).alias("_p"))
    return parts.select(unit, F.array_join(F.transform("_p", lambda x: x[text]), sep).alias("text"))


def rarest_holders(big: DataFrame, small: DataFrame, big_id: str, small_id: str, items: str) -> DataFrame:
    """(big, small): each small set with the big sets that hold its rarest item. Small sets with an item that no big set has are left out.

    So an item that all sets have makes pairs only for small sets that have no other.
    """
    held = big.select(big_id, F.explode(F.array_distinct(items)).alias("_x"))
    holders = held.groupBy("_x").agg(F.count("*").alias("_h"))
    need = small.select(small_id, F.size(F.array_distinct(items)).alias("_n"), F.explode(F.array_distinct(items)).alias("_x")).join(holders, "_x")
    rare = need.groupBy(small_id, "_n").agg(F.count("*").alias("_k"), F.min(F.struct("_h", "_x")).alias("_r")).where("_k = _n")
    return held.join(rare.select(small_id, F.col("_r._x").alias("_x")), "_x").select(big_id, small_id)


def contained_sets(big: DataFrame, small: DataFrame, big_id: str, small_id: str, items: str) -> DataFrame:
    """(big, small, n) where every item of the small set is in the big one: looked up by the rarest item, then compared. Empty sets and null items are in none."""
    s, b = small.select(small_id, F.array_distinct(items).alias("_s")), big.select(big_id, F.array_distinct(items).alias("_b"))
    pairs = rarest_holders(big, small, big_id, small_id, items).join(s, small_id).join(b, big_id)
    return pairs.where(F.size(F.array_except("_s", "_b")) == 0).select(big_id, small_id, F.size("_s").cast("long").alias("n"))


def tiled_exactly(big: DataFrame, small: DataFrame, big_id: str, small_id: str, items: str) -> DataFrame:
    """Big sets that the small sets contained in them cover without overlap or rest, with the number of small ones."""
    inside = contained_sets(big, small, big_id, small_id, items)
    sizes = big.select(big_id, F.size(F.array_distinct(items)).alias("_size"))
    covered = inside.join(small.select(small_id, F.explode(F.array_distinct(items)).alias("_x")), small_id).groupBy(big_id).agg(F.countDistinct("_x").alias("_cover"), F.count("*").alias("_total"), F.countDistinct(small_id).alias("pieces"))
    return covered.join(sizes, big_id).where("_cover = _size and _total = _size").select(big_id, "pieces")


#: Patterns, and characters of patterns, that a block holds at most, on average: the blocks' number follows from a count.
RULES_AT_MOST, RULE_CHARS_AT_MOST = 20_000, 4_000_000


def matching_rules(texts: DataFrame, text: str, rules: DataFrame, pattern: str) -> DataFrame:
    """Pairs of a text and a rule whose pattern it matches; null patterns and texts match nothing.

    Each different pattern is tried once a text, whatever the number of its rules, and only where the text holds a literal that the
    pattern needs: literals of a block of patterns are looked for in one pass. Patterns without such a literal are broadcast and tried on
    every text. A larger rule table means more blocks, a pass over the texts each, and never a product of two shuffled sides; the driver
    holds a block at a time.
    """
    each = rules.where(F.col(pattern).isNotNull()).select(F.col(pattern).alias("_pattern")).distinct()
    number, chars = each.agg(F.count("*"), F.coalesce(F.sum(F.length("_pattern")), F.lit(0))).head()
    blocks = max(1, -(-number // RULES_AT_MOST), -(-chars // RULE_CHARS_AT_MOST))
    hits = []
    for i in range(blocks):
        needs, anywhere = {}, []
        for (p,) in each.where(F.pmod(F.xxhash64("_pattern"), F.lit(blocks)) == i).collect():
            found = required(p)
            for literal in found:
                needs.setdefault(literal, []).append(p)
            if not found:
                anywhere.append((p,))
        if needs:
            hits.append(texts.withColumn("_pattern", F.explode(possible(F.col(text), needs))).where(F.rlike(F.col(text), F.col("_pattern"))))
        if anywhere or not needs:
            hits.append(texts.join(F.broadcast(texts.sparkSession.createDataFrame(anywhere, "_pattern string")), F.rlike(F.col(text), F.col("_pattern"))))
    return reduce(DataFrame.unionByName, hits).join(rules, F.col("_pattern") == F.col(pattern)).drop("_pattern")


def bind_by_rank(a: DataFrame, b: DataFrame, keys: list[str], order_a: str, order_b: str) -> DataFrame:
    """The n-th of ``a`` and the n-th of ``b`` for each key: every row binds once at most."""
    x = a.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order_a)))
    y = b.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order_b)))
    return x.join(y, [*keys, "_rank"]).drop("_rank")


def ownership_clashes(new: DataFrame, old: DataFrame, unit: str, ids: str) -> DataFrame:
    """New units that hold lines of another unit: the lines and the owners."""
    n = new.select(F.col(unit).alias("unit"), F.explode(ids).alias("line_id"))
    o = old.select(F.col(unit).alias("owner"), F.explode(ids).alias("line_id"))
    return n.join(o, "line_id").where("unit <> owner").groupBy("unit").agg(F.array_sort(F.collect_set("line_id")).alias("lines"), F.array_sort(F.collect_set("owner")).alias("owners"))


def prefer(first: DataFrame, then: DataFrame, key: str) -> DataFrame:
    """All rows of ``first``, and those of ``then`` whose key it lacks."""
    return first.unionByName(then.join(first.select(key), key, "left_anti"))


def first_of(sources: list[tuple[DataFrame, str]], key: str, value: str) -> DataFrame:
    """Key -> value of the first source that has one, with the source's name."""
    tagged = [s.select(key, F.col(value).alias("value")).where("value is not null").withColumns({"source": F.lit(n), "_p": F.lit(i)}) for i, (s, n) in enumerate(sources)]
    return reduce(DataFrame.union, tagged).groupBy(key).agg(F.min_by(F.struct("value", "source"), "_p").alias("r")).select(key, "r.*")


def lead_pairs(rows: DataFrame, group: list[str], order: str, mine: Column, next_one: Column) -> DataFrame:
    """Each row's ``mine`` beside the next row's ``next_one``, with match, mismatch, or missing for an empty side."""
    w = Window.partitionBy(*group).orderBy(order)
    x = rows.select(*group, order, mine.alias("caught"), F.lead(next_one).over(w).alias("found"), F.lead(F.lit(True)).over(w).alias("_more")).where("_more").drop("_more")
    none = (F.coalesce("caught", F.lit("")) == "") | (F.coalesce("found", F.lit("")) == "")
    return x.withColumn("status", F.when(none, "missing").when(F.col("caught") == F.col("found"), "match").otherwise("mismatch"))
