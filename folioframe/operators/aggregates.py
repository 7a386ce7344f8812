"""Aggregations: scores, wins, rates, rubrics, clusters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stored

#: Shares of a group between which its middle rows lie for certain, as the sketch's rank error is a 10,000th of the group.
_AROUND = (0.498, 0.502)


def with_medians(rows: DataFrame, keys: list[str], values: dict[str, Column], *others: Column) -> DataFrame:
    """Keys, the exact median of each named value that isn't null (null where there is none), and ``others``, plain aggregates.

    A sketch of bounded size, made beside the other aggregates, brackets the middle of each group. Only different values inside the
    bracket, counted before the shuffle, are then ranked: a group of any size sends 0.4 % of its rows to one task, not all of them.
    Null keys are a group. Without keys there is one row, also of an empty table.
    """
    x = rows.withColumns({f"_m_{n}": v.cast("double") for n, v in values.items()})
    sketch = [F.struct(F.count(f"_m_{n}").alias("n"), F.percentile_approx(f"_m_{n}", F.array(*map(F.lit, _AROUND)), F.lit(10_000)).alias("at")).alias(f"_s_{n}") for n in values]
    out = x.groupBy(*keys).agg(*others, *sketch)
    names = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(c).alias(k) for c, k in zip(keys, names, strict=True)]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(keys, names, strict=True)], F.lit(True))
    for n in values:
        v, s = F.col(f"_m_{n}"), F.col("_s")
        groups = out.select(*renamed, F.col(f"_s_{n}").alias("_s"))
        y = x.select(*keys, v).where(v.isNotNull()).join(groups if keys else F.broadcast(groups), same)  # without keys one row
        # One row for all below the bracket, and one for each different value in it.
        inside = v >= s["at"][0]
        y = y.where(v <= s["at"][1]).groupBy(*names, F.when(inside, v).alias("_v")).agg(F.count("*").alias("_c"), F.first(s["n"]).alias("_n"))
        y = y.withColumn("_to", F.sum("_c").over(Window.partitionBy(*names).orderBy(F.col("_v").asc_nulls_first())))
        # Rows n/2 and n/2 + 1 of an even n, the middle one of an odd n, are those that a value's run of rows reaches.
        middle = (F.col("_to") * 2 >= F.col("_n")) & ((F.col("_to") - F.col("_c")) * 2 <= F.col("_n"))
        m = y.where(middle & F.col("_v").isNotNull()).groupBy(*names).agg(((F.min("_v") + F.max("_v")) / 2).alias(n))
        out = out.join(m, same, "left").drop(*names, f"_s_{n}")
    return out


def score_stats(rows: DataFrame, keys: list[str], score: str) -> DataFrame:
    """n, mean, median, sample deviation (null for one row), min and max of the scores that aren't null."""
    s = F.col(score)
    out = with_medians(rows, keys, {"median": s}, F.count(s).alias("n"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("stdev"), F.min(s).alias("min"), F.max(s).alias("max"))
    return out.select(*keys, "n", "mean", "median", "stdev", "min", "max")


def win_tie_loss(pairs: DataFrame, a: str, b: str, keys: list[str] | None = None) -> DataFrame:
    """Over pairs with both scores: means, medians, mean delta, wins of b, ties, losses, win rate; n_errored counts the rest.

    The pairs are stored once, as each median reads them again.
    """
    pairs = stored(pairs.select(*(keys or []), a, b), "score-pairs")
    d = F.col(b) - F.col(a)
    ok = d.isNotNull()
    only = lambda c: F.when(ok, F.col(c))
    out = with_medians(
        pairs, keys or [], {"median_a": only(a), "median_b": only(b)},
        F.count_if(ok).alias("n"), F.count_if(~ok).alias("n_errored"), F.avg(only(a)).alias("mean_a"), F.avg(only(b)).alias("mean_b"),
        F.avg(d).alias("mean_delta"), F.count_if(d > 0).alias("wins"), F.count_if(d == 0).alias("ties"), F.count_if(d < 0).alias("losses"),
    )
    return out.withColumn("win_rate", F.try_divide("wins", "n"))


def stability(rows: DataFrame, unit: str, score: str) -> DataFrame:
    """Each unit's mean, deviation (0 for one run), min, max and spread across runs."""
    s = F.col(score)
    out = rows.groupBy(unit).agg(F.count(s).alias("n"), F.avg(s).alias("mean"), F.coalesce(F.stddev_samp(s), F.lit(0.0)).alias("stdev"), F.min(s).alias("min"), F.max(s).alias("max"))
    return out.withColumn("spread", F.col("max") - F.col("min"))


def group_winners(rows: DataFrame, group: str, run: str, score: str) -> DataFrame:
    """(run or 'tie', groups won): a group is won by the run that alone has its best score."""
    best = rows.withColumn("_best", F.max(score).over(Window.partitionBy(group))).where(F.col(score) == F.col("_best"))
    won = best.groupBy(group).agg(F.when(F.countDistinct(run) == 1, F.min(run)).otherwise("tie").alias("winner"))
    return won.groupBy("winner").agg(F.count("*").alias("groups_won"))


def best_group(rows: DataFrame, run: str, score: str) -> DataFrame:
    """The run of the highest mean; of equal ones the smallest name."""
    return rows.groupBy(run).agg(F.avg(score).alias("mean")).orderBy(F.col("mean").desc(), run).limit(1)


def confidence(rows: DataFrame, keys: list[str], value: str, illegible: Column) -> DataFrame:
    """Mean and minimum in per cent over legible lines above 0, to two digits."""
    v = F.when(~illegible & (F.col(value) > 0), F.col(value))
    return rows.groupBy(*keys).agg(F.round(100 * F.avg(v), 2).alias("confidence_avg"), F.round(100 * F.min(v), 2).alias("confidence_min"))


def rubric_long(rows: DataFrame, scores: str, rubrics: list[str]) -> DataFrame:
    return rows.select("*", F.explode(F.array(*[F.struct(F.lit(r).alias("rubric"), F.col(scores)[r].alias("raw")) for r in rubrics])).alias("_x")).select(*rows.columns, "_x.*")


def rubric_summary(rows: DataFrame, scores: str, rubrics: list[str]) -> DataFrame:
    """Per rubric: mean, min, max, number, 'na' count, and count of what is neither."""
    x = rubric_long(rows, scores, rubrics)
    v, na = F.col("raw").try_cast("int"), F.coalesce(F.lower(F.trim("raw")) == "na", F.lit(False))
    return x.groupBy("rubric").agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("n"), F.count_if(na).alias("n_na"), F.count_if(v.isNull() & ~na).alias("n_err"))


def histogram(rows: DataFrame, key: str, value: str, bins: list) -> DataFrame:
    """A column for each bin with its count; other values aren't counted."""
    v = F.col(value).cast("string")
    return rows.groupBy(key).agg(*[F.count_if(v == str(b)).alias(f"n_{b}") for b in bins])


def pooled_rate(findings: DataFrame, segments: DataFrame, version: str) -> DataFrame:
    """Findings per segment of each version; 0 where there are no findings or no segments."""
    f, s = findings.groupBy(version).agg(F.count("*").alias("findings")), segments.groupBy(version).agg(F.count("*").alias("segments"))
    out = s.join(f, version, "full_outer").select(version, F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("segments", F.lit(0)).alias("segments"))
    return out.withColumn("rate", F.coalesce(F.try_divide("findings", "segments"), F.lit(0.0)))


def variant_drift(rows: DataFrame, term: str, variant: str, segment: str) -> DataFrame:
    """Terms with more than one variant: how many segments have each, and in all."""
    n = rows.groupBy(term, variant).agg(F.countDistinct(segment).alias("n"))
    out = n.groupBy(term).agg(F.count("*").alias("variants"), F.sum("n").alias("segments"), F.array_sort(F.collect_list(F.struct(variant, "n"))).alias("_v"))
    return out.where("variants > 1").withColumn("uses", F.map_from_entries("_v")).drop("_v")


def clusters(rows: DataFrame, key: Column, name: str, count: str, pages: str) -> DataFrame:
    """Rows with one key as one: the most frequent name stands for them (of equals the smallest), with variants, total and most pages."""
    x = rows.withColumn("_key", key)
    return x.groupBy("_key").agg(
        F.min(F.struct((-F.col(count)).alias("_c"), F.col(name))).alias("_best"),
        F.array_join(F.array_sort(F.collect_set(name)), "|").alias("variants"), F.sum(count).alias("total"), F.max(pages).alias("pages"),
    ).select(F.col("_key").alias("cluster"), F.col(f"_best.{name}").alias("representative"), "variants", "total", "pages")


def text_by_group(rows: DataFrame, group: list[str], order: str, text: str, sep: str = " ") -> DataFrame:
    """Texts joined in order. A group's text is one value, so groups are pages or documents."""
    parts = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(order, F.coalesce(text, F.lit("")).alias("_t")))).alias("_p"))
    return parts.select(*group, F.array_join(F.transform("_p", lambda x: x["_t"]), sep).alias("text"))


def multiset_overlap(pairs: DataFrame, keys: list[str], prediction: str, reference: str, e: float = 2.718281828) -> DataFrame:
    """Unigram precision with brevity penalty; tokens split at blanks. ``e`` is the constant that the scores were defined with.

    The pairs are stored once; a word's two counts come from one grouping.
    """
    tok = lambda c: F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda x: x != "")
    x = stored(pairs.select(*keys, tok(F.col(prediction)).alias("_p"), tok(F.col(reference)).alias("_r")), "overlap-words")
    tagged = lambda side: F.transform(f"_{side}", lambda w: F.struct(w.alias("_w"), F.lit(side == "p").alias("_of")))
    words = x.select(*keys, F.inline(F.concat(tagged("p"), tagged("r"))))
    counts = words.groupBy(*keys, "_w").agg(F.count_if("_of").alias("p"), F.count_if(~F.col("_of")).alias("r"))
    hit = counts.groupBy(*keys).agg(F.sum(F.least("p", "r")).alias("hits"))
    size = x.select(*keys, F.size("_p").alias("np"), F.size("_r").alias("nr"))
    penalty = F.when(F.col("np") >= F.col("nr"), 1.0).otherwise(F.pow(F.lit(e), 1 - F.col("nr") / F.col("np")))
    return size.join(hit, keys, "left").select(*keys, F.when((F.col("np") == 0) | (F.col("nr") == 0), 0.0).otherwise(F.coalesce("hits", F.lit(0)) / F.col("np") * penalty).alias("score"))


def position_bias(rows: DataFrame, choice: str) -> DataFrame:
    """abs(share of A among A and B picks - 0.5); null without picks."""
    a, b = F.count_if(F.col(choice) == "A"), F.count_if(F.col(choice) == "B")
    return rows.agg(a.alias("n_a"), b.alias("n_b"), F.abs(F.try_divide(a, a + b) - 0.5).alias("bias"))
