"""Python works on pieces of a batch, and patterns over whole texts: results are the same, and what is held at once stays small."""

import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from folioframe import queries as Q
from folioframe import workspace
from folioframe.functions import pages as P
from folioframe.plans import mining, rules
from folioframe.sources import ocr

TEXTS = [f"Thee \u00e6ther &{i} " * 4000 for i in range(40)] + [None, "", "hath"]


def parts_of(batches, longest):
    parts = list(batches)
    assert len(parts) > 2 and max(longest(p) for p in parts) <= workspace.PIECE + 100
    return parts


def test_pieces():
    assert [(p.start, p.stop) for p in workspace.pieces([workspace.PIECE, 1, 0, 3 * workspace.PIECE, 5])] == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(workspace.pieces([])) == []


def test_folding_in_pieces():
    """tokenize_fold"""
    got = parts_of(P.fold_tokens.func(iter([pd.Series(TEXTS)])), lambda s: sum(len(x) * 2 for x in s))
    assert pd.concat(got).tolist() == [P.folded(t) for t in TEXTS] and P.folded("A&b_C 1") == ["a", "and", "b", "c", "1"]


def test_accents_in_pieces():
    got = parts_of(P.strip_accents.func(iter([pd.Series([t and t + "\u00e9" for t in TEXTS])])), lambda s: sum(len(x or "") for x in s))
    assert pd.concat(got).tolist() == [t and t + "e" for t in TEXTS]


def test_rules_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array([t or "" for t in TEXTS])], names=["k", "t"])
    got = parts_of(rules._finding(["k"], rules.RULES)(iter([batch])), lambda b: b.num_rows)
    compiled = [(r, rules.re.compile(r.pattern), rules.re.compile(r.unless) if r.unless else None) for r in rules.RULES]
    want = [(k, *f) for k, t in enumerate(TEXTS) for f in rules.matches(t or "", compiled)]
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == want


def test_images_in_pieces():
    images = pd.DataFrame({"path": range(len(TEXTS)), "content": [t if t is None else t.encode() for t in TEXTS]})
    got = parts_of(ocr._reading(lambda image: (image.decode(), 1.0, 1.0, None))(iter([images])), lambda b: sum(len(t or "") for t in b["text"]))
    got = pd.concat(got)
    assert got["path"].tolist() == list(range(len(TEXTS))) and got["text"].tolist() == TEXTS


def test_english_is_folded_once_before_windows(spark, small):
    """greek_validator: Python runs below the windows that repeat each text."""
    plan = Q.greek_validator(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Window [collect_list") < plan.index("ArrowEvalPython")


def seconds(df):
    df.count()
    began = time.time()
    df.count()
    return time.time() - began


def test_sentence_patterns_look_behind_at_blanks_only(spark):
    """split_sentences_abbrev"""
    rows = spark.createDataFrame([("He saw St. Peter and then went to the river. " * 20000,)], "t string").cache()
    cut = seconds(rows.where(F.size(P.split_sentences(F.col("t"))) > 1))
    assert cut < 10 * seconds(rows.where(F.size(F.split("t", r"(?iU)(?<=[.!?])\s+")) > 1)) + 0.5
    assert rows.select(F.size(P.split_sentences(F.col("t")))).first()[0] == 20000


def test_clause_patterns_run_over_clauses(spark):
    """clause_tokens: no pattern a word, and the words are cut once, not once for a filter and again for the result."""
    rows = spark.createDataFrame([(1, "a.5.Annoque que quisque \U0001d4b3aque XIV vi, . x\u0159ab")], "p int, t string")
    got = mining.latin_clauses(rows, "p", "t")
    assert [(r.pos, r.surfaces) for r in got.orderBy("pos").collect()] == [(2, ["Anno", "que", "que", "quisque", "que", "vi"]), (4, ["xab"])]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "m{0,4}" in plan and "RLIKE" not in plan
