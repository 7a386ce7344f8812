"""Column functions over records: latest values of histories, ids, page numbers, order keys, and judgement columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

RUBRICS = ("cf", "rf", "gp", "ph")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit("")) == ""


def last_value(history: Column, field: str = "english") -> Column:
    """Last history entry's field, without fallback (null for an empty history)."""
    return F.try_element_at(history, F.lit(-1))[field]


def latest_value(history: Column, final: Column, field: str = "english") -> Column:
    """Last entry's field unless blank, then ``final``, then ''. The value isn't trimmed."""
    last = last_value(history, field)
    return F.when(~blank(last), last).otherwise(F.coalesce(final, F.lit("")))


def latest_value_trimmed(history: Column, final: Column, field: str = "english") -> Column:
    return F.trim(latest_value(history, final, field))


def latest_nonempty_value(history: Column, field: str = "english") -> Column:
    """The last entry whose field isn't blank; '' if there is none."""
    return F.coalesce(F.try_element_at(F.filter(history, lambda x: ~blank(x[field])), F.lit(-1))[field], F.lit(""))


def next_version(history: Column) -> Column:
    return F.coalesce(F.try_element_at(history, F.lit(-1))["version"], F.lit(0)) + 1


def max_version(history: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(history, lambda x: x["version"])), F.lit(0)) + 1


def coalesce_text(*columns: Column) -> Column:
    """The first that is neither null nor ''; else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def page_number(page_id: Column, segment_id: Column | None = None) -> Column:
    """First digits of the page id, else those of ``_p<digits>_`` in the segment id; null if neither has any."""
    first = F.nullif(F.regexp_extract(page_id, r"([0-9]+)", 1), F.lit(""))
    other = F.nullif(F.regexp_extract(segment_id, r"_p([0-9]+)_", 1), F.lit("")) if segment_id is not None else F.lit(None)
    return F.coalesce(first, other).try_cast("int")


def page_of_unit(unit_id: Column) -> Column:
    return F.nullif(F.regexp_extract(unit_id, r"p([0-9]+)", 1), F.lit("")).try_cast("int")


def order_key(seq: Column, row_id: Column) -> Column:
    """seq, else the last digits of the id, else 0."""
    return F.coalesce(seq, F.nullif(F.regexp_extract(row_id, r"([0-9]+)[^0-9]*$", 1), F.lit("")).try_cast("int"), F.lit(0))


def in_range(number: Column, low: int | None, high: int | None, keep_unknown: bool = False) -> Column:
    """Inclusive bounds. With a bound given, an unknown number is dropped unless ``keep_unknown``."""
    tests = [number >= low] if low is not None else []
    tests += [number <= high] if high is not None else []
    if not tests:
        return F.lit(True)
    inside = reduce(lambda a, b: a & b, tests)
    return number.isNull() | inside if keep_unknown else F.coalesce(inside, F.lit(False))


def confidence_band(c: Column, red: float = 75.0, yellow: float = 85.0) -> Column:
    return F.when(c < red, "red").when(c < yellow, "yellow").when(c.isNotNull(), "green")


def any_rubric_at_most(scores: Column, most: int, rubrics: tuple[str, ...] = RUBRICS) -> Column:
    """Whether any whole-number score of the map is at most ``most``; 'na', missing and broken scores never count."""
    return reduce(lambda a, b: a | b, [F.coalesce(scores[r].try_cast("int") <= most, F.lit(False)) for r in rubrics])


def short_with_marker(text: Column, marker: str, most: int = 400) -> Column:
    """Texts of at most ``most`` characters that contain the marker, as quota messages do."""
    return (F.length(text) <= most) & F.lower(text).contains(marker.lower())


def scorable_error(src: Column, mt: Column, ref: Column | None = None) -> Column:
    """Null where a row can be scored, else which part is blank."""
    e = F.when(blank(src), "missing_source").when(blank(mt), "missing_translation")
    return e.when(blank(ref), "missing_reference") if ref is not None else e


def stable_swap(row_id: Column, seed: str) -> Column:
    """Whether a pair is shown swapped: the lowest bit of the first byte of sha1("seed:id")."""
    first = F.conv(F.substring(F.sha1(F.encode(F.concat(F.lit(f"{seed}:"), row_id.cast("string")), "UTF-8")), 1, 2), 16, 10)
    return first.cast("int") % 2 == 1


def decode_choice(choice: Column, swapped: Column, tie: str = "tie") -> Column:
    """A/B/tie as shown -> v0/v1/tie; null for anything else. Case and blanks don't matter."""
    c = F.upper(F.trim(choice))
    return F.when(c == "A", F.when(swapped, "v1").otherwise("v0")).when(c == "B", F.when(swapped, "v0").otherwise("v1")).when(c.isin("TIE", "EQUAL"), tie)


def page_id(number: Column, prefix: str = "p") -> Column:
    return F.format_string(f"{prefix}%04d", number)


def page_from_path(path: Column) -> Column:
    """The last folder named pNNNN in a path."""
    return F.nullif(F.regexp_extract(path, r".*(?:^|/)(p[0-9]{4})/", 1), F.lit(""))


def to_wsl(path: Column) -> Column:
    drive = F.lower(F.regexp_extract(path, r"^([A-Za-z]):", 1))
    return F.when(path.rlike(r"^[A-Za-z]:[\\/]"), F.concat(F.lit("/mnt/"), drive, F.lit("/"), F.translate(F.substring(path, 4, 1 << 30), "\\", "/"))).otherwise(path)


def to_windows(path: Column) -> Column:
    m = r"^/mnt/([a-z])/(.*)$"
    return F.when(path.rlike(m), F.concat(F.upper(F.regexp_extract(path, m, 1)), F.lit(":\\"), F.translate(F.regexp_extract(path, m, 2), "/", "\\"))).otherwise(path)


def json_score(raw: Column, key: str) -> Column:
    """A whole number under ``key``, found in text that needn't be valid JSON."""
    return F.nullif(F.regexp_extract(raw, rf'"{key}"\s*:\s*"?([0-9]+)"?', 1), F.lit("")).try_cast("int")


def json_object_text(raw: Column) -> Column:
    """The text from the first brace to the last, without code fences around it; null without braces."""
    plain = F.regexp_replace(raw, r"(?m)^\s*```[A-Za-z]*\s*$", "")
    return F.nullif(F.regexp_extract(plain, r"(?s)(\{.*\})", 1), F.lit(""))


def utc_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def text_only(c: Column) -> Column:
    """Booleans as lower-case text, for CSV manifests."""
    return F.lower(c.cast("string"))


def try_last(items: Column) -> Column:
    """The last element, or null for an empty array."""
    return F.try_element_at(items, F.lit(-1))
