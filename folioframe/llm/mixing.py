"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all words; a target
stops at twice its source's size and the excess goes to the others by weight. Blocks of equal token counts are
allocated to sources by the highest quotients target / (2 s + 1), and those of a source to its shards likewise, which
gives integer quotas. Inside a shard documents lie in seeded order on a ring of words; a seeded place picks
where the quota's run of blocks begins, so what a document gives is plain arithmetic.

Native. A source of any size is split into shards by a seeded hash, so no task sees a whole source. Only one row a
source and one row a shard meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from .common import n_words, stored

#: Tokens of a block; no source is off its target by more than about half of it, plus what rounding of whole shards leaves.
BLOCK = 16
#: Documents of a shard, about.
SHARD_DOCS = 4_000
SEED = 17
WEIGHTS = (3, 1, 2)


def apportion(parties: DataFrame, key: list[str], group: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague: ``parties`` with ``out``, the seats each gets of its group's ``seats``, by ``votes``.

    Ties go to the smaller key (nulls last). Only seats whose number is in doubt are ranked: with n parties and N
    seats, the final divisor is within a factor 1 +- n / N of the exact share, so all seats below that range are
    certain, and the ranked ones are about 3 n. Parties without votes, and groups without votes, get 0.
    """
    g = Window.partitionBy(*[F.col(c) for c in group]) if group else Window.partitionBy(F.lit(0))
    total, n = F.sum(votes).over(g), F.count(F.when(F.col(votes) > 0, 1)).over(g)
    exact = F.col(seats) * F.col(votes) / F.col("_total")
    slack = exact * F.col("_n") / F.col(seats)
    base = parties.withColumns({"_total": total, "_n": n}).withColumns(
        {
            "_low": F.when((F.col(votes) > 0) & (F.col(seats) > 0), F.greatest(F.lit(0), F.floor(exact - slack))).otherwise(0).cast("long"),
            "_high": F.when((F.col(votes) > 0) & (F.col(seats) > 0), F.ceil(exact + slack) + 1).otherwise(0).cast("long"),
        }
    )
    base = base.withColumn("_free", F.col(seats) - F.sum("_low").over(g))
    tried = base.where("_high > _low").select("*", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_seat"))
    order = Window.partitionBy(*[F.col(c) for c in group] or [F.lit(0)]).orderBy((F.col(votes) / (2 * F.col("_seat") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in key], "_seat")
    won = tried.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("_free")).groupBy(*key).agg(F.count("*").alias("_won"))
    names = parties.columns
    won = won.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "_won")
    on = F.lit(True)
    for i, c in enumerate(key):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return base.join(won, on, "left").select(*names, (F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).cast("long").alias(out))


def source_targets(sources: DataFrame, source: str = "source", size: str = "source_size", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row a source in, the same with ``target``: min(most * size, level * weight), the level such that targets add up.

    That is what resharing the excess by weight, until none is above its cap, ends at. The level is found from
    running sums over the sources by cap / weight, without rounds.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col(source).asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    x = sources.withColumn("_i", rank).withColumn("_w", w).withColumn("_cap", F.col(size) * F.lit(most))
    by_ratio = everything.orderBy(F.col("_cap") / F.col("_w"), "_i")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum(size).over(everything) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    # The level is that of the first source, by cap / weight, which it doesn't lift above its cap.
    x = x.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    found = F.min(F.when(F.col("_open"), F.struct(F.col("_cap") / F.col("_w"), F.col("_i"), F.col("_level").alias("level")))).over(everything)["level"]
    target = F.coalesce(F.least(F.col("_cap"), found * F.col("_w")), F.col("_cap"))
    return x.withColumn("target", target.cast("double")).drop("_i", "_w", "_cap", "_level", "_open")


def _overlap(lo: Column, hi: Column, a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(hi, b) - F.greatest(lo, a))


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def plan(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """Every row with size, source_size, target, taken, and how: ``whole`` full copies and word ranges [a0, b0), [a1, b1) of one more.

    ``keep`` names further columns to carry (none by default). A null or blank text has size 0 and is never taken;
    the null source is a source like others; texts of any length are taken by word; repeated rows are rows of their own
    (ties in the seeded order are broken by the columns carried that have an order, which maps don't, and rows equal in all are alike);
    an empty table gives no rows. taken <= 2 * size.
    """
    keep = keep or []
    source = docs[source_col].cast("string")
    sized = docs.select(
        *[docs[c].alias(f"_c{i}") for i, c in enumerate(keep)],
        docs[id_col].alias("_id"),
        # One key a source, never null and in the order of code points, null last.
        F.coalesce(F.concat(F.lit("s"), source), F.lit("z")).alias("_key"),
        n_words(docs[text_col].cast("string")).alias("size"),
        F.xxhash64(F.lit(seed), docs[id_col].cast("string"), docs[text_col].cast("string")).alias("_h"),
    )
    slim = stored(sized.select("_id", "_key", "size", "_h"), "mix-sizes")
    # Columns that are carried are read again rather than stored twice.
    sized = sized if keep else slim
    n_shards = F.lit(max(1, -(-slim.count() // shard_docs)))
    sized, slim = (x.withColumn("_shard", F.pmod(F.col("_h"), n_shards)) for x in (sized, slim))
    shards = slim.groupBy("_key", "_shard").agg(F.sum("size").alias("shard_size"))
    targets = source_targets(shards.groupBy("_key").agg(F.sum("shard_size").alias("source_size")), "_key", weights=weights)
    all_blocks = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long")
    quotas = apportion(targets.withColumn("_blocks", all_blocks), ["_key"], [], "target", "_blocks", "source_blocks").drop("_blocks")
    # Two levels: a source's quota goes to about a square root of its shards in groups, a group's to its shards, so no task sees all of them.
    shards = shards.withColumn("_group", F.pmod("_shard", F.ceil(F.sqrt(n_shards)).cast("long")))
    grouped = shards.groupBy("_key", "_group").agg(F.sum("shard_size").alias("group_size"))
    by_group = apportion(grouped.join(quotas, "_key"), ["_key", "_group"], ["_key"], "group_size", "source_blocks", "group_blocks").drop("group_size")
    by_shard = apportion(shards.join(by_group, ["_key", "_group"]), ["_key", "_group", "_shard"], ["_key", "_group"], "shard_size", "group_blocks", "shard_blocks")
    ring = by_shard.select(
        "_key",
        "_shard",
        "source_size",
        "target",
        "shard_size",
        F.least(F.col("shard_blocks") * block, 2 * F.col("shard_size")).alias("_quota"),
        (F.pmod(F.xxhash64(F.lit(seed + 1), "_key", "_shard"), F.greatest(F.lit(1), F.floor(F.col("shard_size") / block))) * block).alias("_from"),
    )
    order = Window.partitionBy("_key", "_shard").orderBy("_h", *[f"_c{i}" for i, c in enumerate(keep) if _orderable(docs.schema[c].dataType)]).rowsBetween(Window.unboundedPreceding, 0)
    # The window and the join share one exchange.
    x = sized.withColumn("_hi", F.sum("size").over(order)).join(ring, ["_key", "_shard"])
    lo, hi, total = F.col("_hi") - F.col("size"), F.col("_hi"), F.col("shard_size")
    rest = F.when(total > 0, F.pmod("_quota", total)).otherwise(0)
    whole = F.when(total > 0, F.floor(F.col("_quota") / total)).otherwise(0).cast("long")
    x = x.withColumns({"_rest": rest, "whole": whole})
    first, wrapped = (F.col("_from"), F.least(total, F.col("_from") + F.col("_rest"))), (F.lit(0), F.greatest(F.lit(0), F.col("_from") + F.col("_rest") - total))
    cut = {}
    for i, (a, b) in enumerate((wrapped, first)):
        n = _overlap(lo, hi, a, b)
        cut[f"a{i}"] = F.when(n > 0, F.greatest(lo, a) - lo).otherwise(0).cast("long")
        cut[f"b{i}"] = F.when(n > 0, F.least(hi, b) - lo).otherwise(0).cast("long")
    x = x.withColumns(cut)
    taken = F.col("whole") * F.col("size") + F.col("b0") - F.col("a0") + F.col("b1") - F.col("a1")
    return x.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], F.col("_id").alias(id_col), F.nullif(F.substring("_key", 2, 1 << 30), F.when(F.col("_key") == "z", "")).alias(source_col), "size", "source_size", "target", taken.cast("long").alias("taken"), "whole", "a0", "b0", "a1", "b1")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: a row for each full copy, and one for each range of a partly taken document.

    The text of a partly taken document is its words of that range, joined by single spaces. Rows of size 0 are never
    taken; null and repeated rows as in :func:`plan`.
    """
    from .common import words

    own = [c for c in docs.columns if c not in (id_col, source_col)]
    names = {c: f"_own{i}" for i, c in enumerate(own)}
    x = plan(docs.select(id_col, source_col, *[F.col(c).alias(n) for c, n in names.items()]), [*names.values()], id_col, names[text_col], source_col, **options)
    text = F.col(names[text_col])
    part = lambda a, b: F.concat_ws(" ", F.slice(F.col("_words"), (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int")))
    pieces = F.filter(F.array(F.when(F.col("b0") > F.col("a0"), part("a0", "b0")), F.when(F.col("b1") > F.col("a1"), part("a1", "b1"))), lambda p: p.isNotNull())
    copies = F.when(F.col("size") > 0, F.array_repeat(text, F.col("whole").cast("int"))).otherwise(F.array().cast("array<string>"))
    out = x.withColumn("_words", words(text)).withColumn("_out", F.explode(F.concat(copies, pieces)))
    return out.select([F.col("_out").alias(c) if c == text_col else F.col(names.get(c, c)).alias(c) for c in docs.columns])
