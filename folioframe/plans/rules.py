"""Mechanical rules over English text: findings with their place, the text around it, and a note.

A rule is a row of a table: a pattern, whether each match counts or the first alone, and a pattern whose presence anywhere in the
text silences the rule. Names with a settled form, titles that must be set off, and the absence of any text are all of this kind.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import readers
from ..workspace import pieces

#: Characters shown on both sides of a match, and of a malformed row.
REACH, ROW_SHOWN = 24, 60


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches what the rule finds; ``unless`` silences it; ``every`` counts all matches, else the first; ``note`` may hold {hit}."""

    name: str
    pattern: str
    note: str
    every: bool = True
    unless: str | None = None


#: Words of an older register.
ARCHAIC = ["vouchsafed", "thee", "thou", "thy", "thine", "verily", "whereunto", "whilst", "betwixt", "hath", "doth", "saith", "wherefore", "behold,", "ye", "twixt", "ere"]
#: Names as some print them, and their settled form.
NAMES = {"Boadicia": "Boudica", "Boadicea": "Boudica", "Caesariis": "Caesar", "Aethiopas": "Ethiopians", "Aethiopibus": "Ethiopians", "Antiocheni": "Antiochenes", "Theodoretus": "Theodoret"}
#: Titles of works that must be in italics or quotes.
TITLES = ["Adversus Haereses", "Adversus Iudaeos", "Adversus Judaeos", "Historia Ecclesiastica", "Britannicarum Ecclesiarum Antiquitates", "De Civitate Dei", "De Praescriptione Haereticorum", "De Trinitate"]
#: Lexica that must not be quoted.
LEXICA = ["Forcellini", "Du Cange", "DuCange", "Lampe", "LSJ", "Liddell-Scott", "Lewis & Short", "Sophocles"]
#: What sets a title off, on its left and right.
SET_OFF = [("*", "*"), ("_", "_"), ('"', '"'), ("'", "'"), ("“", "”")]


def _any_of(words: list[str]) -> str:
    return r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


RULES = [
    Rule("archaism", f"(?i){_any_of(ARCHAIC)}", "older register: {hit}"),
    *[Rule("proper_noun", re.escape(form), f"{form} is {settled} here", every=False, unless=re.escape(settled)) for form, settled in NAMES.items()],
    *[Rule("title_unformatted", re.escape(t), f"neither italics nor quotes: {t}", every=False, unless="|".join(re.escape(a + t + b) for a, b in SET_OFF)) for t in TITLES],
    Rule("lexicon_leak", _any_of(LEXICA), "a lexicon is named: {hit}"),
    Rule("code_fence", "```|~~~", "a code fence", every=False),
    Rule("caret_in_english", r"\^[A-Za-z0-9]{1,2}", "a marker that is placed later: {hit}"),
    Rule("empty_english", r"\A\s*\Z", "no text"),
]


def around(text: str, start: int, end: int, reach: int = REACH) -> str:
    """One line with what stands around a place; dots where more was cut off."""
    cut = text[max(0, start - reach) : end + reach].replace("\n", " ")
    return ("…" if start > reach else "") + cut + ("…" if end + reach < len(text) else "")


def matches(text: str, compiled: list[tuple[Rule, re.Pattern, re.Pattern | None]]) -> Iterator[tuple[str, int, int, str, str]]:
    """(rule, start, end, snippet, note) of one text, in the rules' order, places counted in characters."""
    for rule, pattern, unless in compiled:
        silent = None
        for m in pattern.finditer(text):
            if silent is None:
                silent = bool(unless and unless.search(text))
            if silent:
                break
            yield rule.name, m.start(), m.end(), around(text, *m.span()) if m.group() else "", rule.note.replace("{hit}", m.group())
            if not rule.every:
                break


def english_text(history: Column, final: Column) -> Column:
    """Trimmed text of a history's last entry, or if that is blank the final one."""
    bare = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.nullif(bare(F.try_element_at(history, F.lit(-1))["english"]), F.lit("")), bare(final), F.lit(""))


def findings(rows: DataFrame, keys: list[str], text: str, rules: list[Rule] = RULES) -> DataFrame:
    """(keys, rule, start, end, snippet, note): a row a finding; null texts count as empty ones.

    Spark's functions give a pattern's first place only, and places found by cutting a text at each match cost the square of
    the matches, so each batch of texts goes through Python's matcher once, whatever the number of rules.
    """
    keyed = rows.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[: len(keys)])
    return keyed.mapInArrow(_finding(keys, rules), f"{kinds}, rule string, start int, end int, snippet string, note string")


def _finding(keys: list[str], rules: list[Rule]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (keys, text): :func:`findings`, a batch for each piece of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(r.pattern), re.compile(r.unless) if r.unless else None) for r in rules]
        for whole in batches:
            for p in pieces(pc.binary_length(whole.column(len(keys))).to_numpy(zero_copy_only=False)):
                b = whole.slice(p.start, p.stop - p.start)
                at, found = [], []
                for i, t in enumerate(b.column(len(keys)).to_pylist()):
                    new = list(matches(t, compiled))
                    found += new
                    at += [i] * len(new)
                names, starts, ends, snippets, notes = zip(*found, strict=True) if found else ((),) * 5
                where = pa.array(at, pa.int32())
                cols = [*(b.column(k).take(where) for k in range(len(keys))), pa.array(names, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(snippets, pa.string()), pa.array(notes, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "rule", "start", "end", "snippet", "note"])

    return run


def run_findings(spark: SparkSession, path: str, schema: StructType, key: str, text: Column, rules: list[Rule] = RULES) -> DataFrame:
    """Findings of a run's JSON lines. A row that is no JSON is a finding ``malformed_record`` without a key over the whole row, which shows its beginning."""
    good, bad = readers.jsonl_counting(spark, path, schema)
    found = findings(good.withColumn("_english", text), [key], "_english", rules)
    row = F.regexp_replace(bad["detail"], r"(?U)^\s+|\s+$", "")
    kind = found.schema[key].dataType
    lost = bad.select(F.lit(None).cast(kind).alias(key), "rule", F.lit(0).alias("start"), F.length(row).alias("end"), F.left(row, F.lit(ROW_SHOWN)).alias("snippet"), F.lit("not JSON").alias("note"))
    return found.unionByName(lost)


def rule_counts(found: DataFrame, version: str | None = None) -> DataFrame:
    """Findings of each rule, and of each version if given."""
    return found.groupBy(*([version] if version else []), "rule").agg(F.count("*").alias("findings"))
