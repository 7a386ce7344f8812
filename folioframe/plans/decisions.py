"""Decision gates over judgements and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ab_verdict(judgements: DataFrame, winner: str, picked: str, keys: list[str] | None = None, win: float = 0.55, tie: float = 0.40, bias: float = 0.10, invalid: float = 0.10) -> DataFrame:
    """PASS, FAIL or INSUFFICIENT with reasons.

    winner is v0, v1, tie or null (invalid); picked is A or B as shown. Without decided rows the verdict is INSUFFICIENT,
    as it is where the invalid share reaches its bound or nobody picked A or B; else FAIL where v1's win rate among
    decided rows is below its bound, or ties or position bias reach theirs.
    """
    w = F.col(winner)
    x = judgements.groupBy(*(keys or [])).agg(
        F.count("*").alias("n"), F.count_if(w == "v0").alias("v0_wins"), F.count_if(w == "v1").alias("v1_wins"), F.count_if(w == "tie").alias("ties"), F.count_if(w.isNull()).alias("invalid"),
        F.count_if(F.col(picked) == "A").alias("n_a"), F.count_if(F.col(picked) == "B").alias("n_b"),
    )
    decided = F.col("v0_wins") + F.col("v1_wins")
    x = x.withColumns({"win_rate": F.try_divide("v1_wins", decided), "tie_rate": F.try_divide("ties", decided + F.col("ties")), "invalid_rate": F.try_divide("invalid", "n"), "bias": F.abs(F.try_divide(F.col("n_a"), F.col("n_a") + F.col("n_b")) - 0.5)})
    why = lambda c, text: F.when(F.coalesce(c, F.lit(False)), text)
    short = F.array_compact(F.array(why(decided == 0, "no decided rows"), why(F.col("invalid_rate") >= invalid, "invalid share"), why(F.col("n_a") + F.col("n_b") == 0, "no picks")))
    failed = F.array_compact(F.array(why(F.col("win_rate") < win, "win rate"), why(F.col("tie_rate") >= tie, "ties"), why(F.col("bias") >= bias, "position bias")))
    verdict = F.when(F.size(short) > 0, "INSUFFICIENT").when(F.size(failed) > 0, "FAIL").otherwise("PASS")
    return x.select("*", verdict.alias("verdict"), F.array_join(F.when(F.size(short) > 0, short).otherwise(failed), "; ").alias("reasons"))


def ablation(a: DataFrame, b: DataFrame, unit: str, scores: list[str], least: float = 0.10) -> DataFrame:
    """Means over shared units and their differences; accepted where the largest difference reaches ``least``."""
    x = a.select(unit, *[F.col(s).alias(f"{s}_a") for s in scores]).join(b.select(unit, *[F.col(s).alias(f"{s}_b") for s in scores]), unit)
    x = x.agg(F.count("*").alias("n"), *[F.avg(f"{s}_{v}").alias(f"{s}_{v}") for s in scores for v in "ab"])
    d = [F.col(f"{s}_b") - F.col(f"{s}_a") for s in scores]
    best = F.greatest(*d) if len(d) > 1 else d[0]
    return x.select("*", *[c.alias(f"{s}_delta") for s, c in zip(scores, d, strict=True)], F.coalesce(best >= least, F.lit(False)).alias("accepted"))


def within(mean: Column, target: float, tolerance: float) -> Column:
    return F.coalesce(F.abs(mean - target) <= tolerance, F.lit(False))


def agreement(deltas: DataFrame, a: str, b: str) -> DataFrame:
    """How often two metrics move the same way, over rows where both move."""
    sign = F.signum(a) * F.signum(b)
    return deltas.agg(F.count_if(sign > 0).alias("agree"), F.count_if(sign < 0).alias("disagree"), F.try_divide(F.count_if(sign > 0), F.count_if(sign != 0)).alias("rate"))


def spot_check(judgements: DataFrame, segment: str, winner: str, swing: str) -> DataFrame:
    """Per segment: pairings, wins, equal ones, and the sum of rubric swings; ties are counted as such."""
    w = F.col(winner)
    return judgements.groupBy(segment).agg(F.count("*").alias("pairings"), F.count_if(w == "v0").alias("v0"), F.count_if(w == "v1").alias("v1"), F.count_if(w.isin("tie", "equal")).alias("equal"), F.sum(swing).alias("swing"))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int, without: DataFrame | None = None) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key."""
    x = rows.join(without.select(key), key, "left_anti") if without is not None else rows
    return x.orderBy(F.sha1(F.encode(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), "UTF-8")), key).limit(n)
