"""Differences between snapshots, versioned histories, refreshes, resumption, and checks of edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields]))
    return rows.select(*key, each.alias("_x")).select(*key, "_x.*")


def diff(before: DataFrame, after: DataFrame, key: list[str], fields: list[str], deletions: bool = True) -> DataFrame:
    """(key, field, before, after) of each field that changed, null and missing being one value.

    A new row gives ``_added`` besides its fields; a row that went gives ``_deleted``, unless ``deletions`` is off, as for lines.
    """
    b, a = before.select(*key, F.struct(*fields).alias("_b")), after.select(*key, F.struct(*fields).alias("_a"))
    both = b.join(a, key, "full_outer")
    text = lambda s, f: F.col(f"{s}.{f}").cast("string")
    changes = [F.when(F.col("_a").isNotNull() & ~text("_b", f).eqNullSafe(text("_a", f)), F.struct(F.lit(f).alias("field"), text("_b", f).alias("before"), text("_a", f).alias("after"))) for f in fields]
    mark = lambda name, when: F.when(when, F.struct(F.lit(name).alias("field"), F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after")))
    changes.append(mark("_added", F.col("_b").isNull()))
    if deletions:
        changes.append(mark("_deleted", F.col("_a").isNull()))
    return both.select(*key, F.explode(F.array_compact(F.array(*changes))).alias("_x")).select(*key, "_x.*")


def append_history(rows: DataFrame, history: str, entry: Column, status: str) -> DataFrame:
    """Add a version; a status that is empty or pending becomes machine_draft."""
    advance = F.coalesce(F.col(status), F.lit("")).isin("", "pending")
    return rows.withColumn(history, F.concat(F.col(history), F.array(entry))).withColumn(status, F.when(advance, "machine_draft").otherwise(F.col(status)))


def refresh(current: DataFrame, derived: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Derived fields overwrite those of the same key; all else stays."""
    d = derived.select(key, F.lit(True).alias("_h"), *[F.col(f).alias(f"_{f}") for f in fields])
    out = current.join(d, key, "left")
    return out.select(*[F.when(F.col("_h"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in current.columns])


def remaining(work: DataFrame, log: DataFrame, key: str, done: Column) -> DataFrame:
    """Work whose key has no row in the log for which ``done`` holds."""
    return work.join(log.where(done).select(key), key, "left_anti")


def rerun_missing(wanted: DataFrame, key: str, request, rounds: int = 2):
    """Ask ``request`` (DataFrame of keys -> rows) for what is missing, at most ``rounds`` times, while there is progress.

    Rows must be stored by ``request``; the driver sees counts only.
    """
    got, left, before = None, wanted, None
    for _ in range(rounds + 1):
        n = left.count()
        if n == 0 or n == before:
            break
        before = n
        more = request(left)
        got = more if got is None else got.unionByName(more)
        left = wanted.join(got.select(key), key, "left_anti")
    return got, left


def stale(derived: DataFrame, versions: str, current: DataFrame, key: str, source: str, version: str) -> DataFrame:
    """Derived rows of which some recorded source version isn't the current one."""
    used = derived.select(key, F.explode(versions).alias(source, "_used"))
    return used.join(current.select(source, F.col(version).alias("_now")), source, "left").where(~F.col("_used").eqNullSafe(F.col("_now"))).select(key).distinct()


def violations(rows: DataFrame, key: str, allowed: dict[str, list[str]]) -> DataFrame:
    """(key, field, value) of values outside their field's list; nulls pass."""
    bad = [F.when(~F.col(f).isin(*v), F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))) for f, v in allowed.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*bad))).alias("x")).select(key, "x.*")


def dangling(rows: DataFrame, key: str, reference: str, target: DataFrame, target_key: str) -> DataFrame:
    """Rows whose reference isn't null and names nothing."""
    t = target.select(F.col(target_key).alias("_t")).distinct()
    return rows.where(F.col(reference).isNotNull()).join(t, F.col(reference) == F.col("_t"), "left_anti").select(key, F.lit(reference).alias("field"), F.col(reference).cast("string").alias("value"))


def once_each(text: Column, required: Column) -> dict[str, Column]:
    """Markers missing from a text, those there twice or more, and those nobody asked for."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\^[A-Za-z0-9]{1,2}"), F.lit(0)), lambda m: F.substring(m, 2, 2))
    count = lambda m: F.size(F.filter(found, lambda x: x == m))
    return {"missing": F.filter(required, lambda m: count(m) == 0), "repeated": F.filter(required, lambda m: count(m) > 1), "extra": F.array_except(found, required)}


def placed(original: Column, response: Column, token: Column) -> Column:
    """Whether the response is the original plus the token once, white space aside: the response without the token's first place is
    the original. False for null and blank responses and for those without the token. Linear in the texts.
    """
    spaced = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    at = F.instr(response, token)
    rest = F.concat(F.left(response, at - 1), F.substring(response, at + F.length(token), F.length(response)))
    return F.coalesce((at > 0) & (spaced(rest) == spaced(original)), F.lit(False))


def place_or_append(original: Column, response: Column, token: Column) -> Column:
    """The trimmed response where it fits, else the original with the token at its end, so that no marker is lost."""
    trimmed = lambda c, ends: F.regexp_replace(c, rf"(?U){ends}", "")
    return F.when(placed(original, trimmed(response, r"^\s+|\s+$"), token), trimmed(response, r"^\s+|\s+$")).otherwise(F.concat(trimmed(F.coalesce(original, F.lit("")), r"\s+$"), token))
