"""Mechanical rules against a plain scan, and rows that are no JSON."""

import re

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from folioframe import queries as Q
from folioframe.plans import rules as R


def scan(text):
    """(rule, start, end) of a text, each kind of rule by its own search."""
    out = [("archaism", *m.span()) for w in R.ARCHAIC for m in re.finditer(rf"\b{re.escape(w)}\b", text, re.I)]
    out += [("proper_noun", text.index(a), text.index(a) + len(a)) for a, b in R.NAMES.items() if a in text and b not in text]
    for t in R.TITLES:
        if t in text and not any(a + t + b in text for a, b in R.SET_OFF):
            out.append(("title_unformatted", text.index(t), text.index(t) + len(t)))
    out += [("lexicon_leak", *m.span()) for w in R.LEXICA for m in re.finditer(rf"\b{re.escape(w)}\b", text)]
    fences = [text.find(f) for f in ("```", "~~~") if f in text]
    out += [("code_fence", min(fences), min(fences) + 3)] if fences else []
    out += [("caret_in_english", *m.span()) for m in re.finditer(r"\^[A-Za-z0-9]{1,2}", text)]
    return out + ([("empty_english", 0, 0)] if not text else [])


def test_all_documents(spark, small):
    texts = {r.doc_id: r.t for r in Q._shaped(spark, small, Q._RULED).collect()}
    found = Q.rule_findings(spark, small).collect()
    want = sorted((k, *f) for k, t in texts.items() for f in scan(t))
    assert sorted((r.doc_id, r.rule, r.start, r.end) for r in found) == want
    assert {w[1] for w in want} == {"archaism", "proper_noun", "title_unformatted", "lexicon_leak", "code_fence", "caret_in_english", "empty_english"}
    for r in found:
        t = texts[r.doc_id]
        assert r.snippet.strip("…") == t[max(0, r.start - 24) : r.end + 24].replace("\n", " ").strip("…") or not t
        assert t[r.start : r.end] in r.note or r.rule == "code_fence"


def test_hard_texts(spark):
    rows = [(1, None), (2, "Boadicea and Boudica; 'De Trinitate'"), (3, "“De Trinitate” De Trinitate"), (4, "ſaith théé thee-ye\nYE"), (5, "thee " * 30_000), (6, "Du Cange, DuCange, Lampert, behold, x"), (2, "😀 thee")]
    got = R.findings(spark.createDataFrame([(*r, 7) for r in rows], "id int, t string, rule int").drop("rule"), ["id"], "t").collect()
    of = lambda k: sorted((r.rule, r.start, r.end) for r in got if r.id == k)
    assert of(1) == [("empty_english", 0, 0)] and of(2) == [("archaism", 2, 6)] and of(3) == [] and len(of(5)) == 30_000
    assert of(4) == sorted(scan(rows[3][1])) and ("lexicon_leak", 0, 8) in of(6)
    assert R.findings(spark.createDataFrame([], "id int, t string"), ["id"], "t").count() == 0
    first = next(r for r in got if r.id == 5)
    assert first.snippet == "thee " * 5 + "the…" and first.note == "older register: thee"


def test_runs_with_malformed_rows(spark, tmp_path):
    bad = '  {"segment_id": "s9", "translation_history": [' + "x" * 80
    lines = ['{"segment_id": "s1", "translation_history": [{"english": "fine"}, {"english": " thee \\n"}], "final_english": "verily"}', "", bad, '{"segment_id": "s2", "translation_history": [{"english": "  "}], "final_english": " ^ab"}', '{"segment_id": "s3"}']
    (tmp_path / "run.jsonl").write_text("\n".join(lines))
    entry = StructType([StructField("english", StringType())])
    kind = StructType([StructField("segment_id", StringType()), StructField("translation_history", ArrayType(entry)), StructField("final_english", StringType())])
    found = R.run_findings(spark, str(tmp_path), kind, "segment_id", R.english_text(F.col("translation_history"), F.col("final_english")))
    got = sorted(((r.segment_id or "", r.rule, r.start, r.end, r.snippet) for r in found.collect()))
    assert got == [("", "malformed_record", 0, len(bad.strip()), bad.strip()[:60]), ("s1", "archaism", 0, 4, "thee"), ("s2", "caret_in_english", 0, 3, "^ab"), ("s3", "empty_english", 0, 0, "")]
    assert {r.rule: r.findings for r in R.rule_counts(found).collect()}["archaism"] == 1
