import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.functions import records as R
from folioframe.functions import text as T
from folioframe.plans import alignment, mining


def one(spark, column, **values):
    row = spark.range(1).select(*[(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).head()[0]


def test_roman_numerals(spark):
    rows = spark.range(1, 4000).select("id", T.int_to_roman(F.col("id")).alias("r"))
    assert rows.where((T.roman_to_int(F.col("r")) != F.col("id")) | (T.roman_to_int_strict(F.col("r")) != F.col("id"))).count() == 0
    assert one(spark, T.roman_to_int(F.col("a")), a="IIX") == 8
    assert one(spark, T.roman_to_int_strict(F.col("a")), a="IIX") is None
    assert one(spark, T.roman_to_int(F.col("a")), a="ABC") is None
    assert one(spark, T.int_to_roman(F.lit(4000))) is None


def test_numerals(spark):
    latin = one(spark, T.latin_numerals(F.col("a")), a="anno 36 octavum non XIV nonus decem")
    assert {(x["value"], x["token"]) for x in latin} == {(36, "36"), (8, "octavum"), (14, "XIV"), (9, "nonus"), (10, "decem")}
    english = one(spark, T.english_numerals(F.col("a")), a="the twenty-third and forty one, XX times 7th, ninetieth")
    assert set(english) == {23, 20, 3, 41, 40, 1, 7, 90}
    assert set(one(spark, T.english_numerals(F.col("a"), compound_parts=False), a="twenty-third")) == {23}
    assert one(spark, T.expected_forms(F.lit(23))) == ["23", "twenty-three", "twenty-third", "XXIII"]


@pytest.mark.parametrize(("line", "ends"), [("dixit.", True), ("cap.", False), ("XIV.", False), ("A.", False), ('dixit."', True), ("hyphen-", False), ("quid?", True), ("", False)])
def test_sentence_ends(spark, line, ends):
    assert one(spark, T.sentence_ends(F.col("a")), a=line) is ends


def test_latest_values(spark):
    h = F.array(F.struct(F.lit("one").alias("english"), F.lit(1).alias("version")), F.struct(F.lit("  ").alias("english"), F.lit(4).alias("version")))
    empty = F.array().cast("array<struct<english:string,version:int>>")
    assert one(spark, R.latest_value(h, F.lit("final"))) == "final"
    assert one(spark, R.latest_nonempty_value(h)) == "one"
    assert one(spark, R.latest_value(empty, F.lit(None).cast("string"))) == ""
    assert one(spark, R.next_version(h)) == 5
    assert one(spark, R.next_version(empty)) == 1


def test_markers(spark):
    ms = F.array(F.struct(F.lit(3).alias("offset"), F.lit("a").alias("symbol")), F.struct(F.lit(99).alias("offset"), F.lit("b").alias("symbol")))
    assert one(spark, T.inject_markers(F.lit("abcdef"), ms)) == "abc^adef^b"
    assert one(spark, T.strip_carets(F.col("a")), a="x^ab y^c") == "x y"


def test_greek_and_scripts(spark):
    assert one(spark, T.greek_spans(F.col("a")), a="λόγος et αβ ἀρχή, τέλος") == ["λόγος", "αβ ἀρχή, τέλος"]
    assert one(spark, T.script_kind(F.col("a"), F.col("b")), a="12", b="x") == "PUNCT_ONLY"
    assert one(spark, T.script_kind(F.col("a"), F.col("b")), a="λόγος", b="x") == "GREEK_ONLY"
    assert one(spark, T.script_kind(F.col("a"), F.col("b")), a="Ab  c", b="ab c") == "LATIN_VERBATIM"
    assert one(spark, T.script_kind(F.col("a"), F.col("b")), a="real", b="ab c") is None


def test_paths_and_choices(spark):
    assert one(spark, R.to_wsl(F.col("a")), a="C:\\x\\y") == "/mnt/c/x/y"
    assert one(spark, R.to_windows(F.col("a")), a="/mnt/c/x/y") == "C:\\x\\y"
    assert one(spark, R.decode_choice(F.col("a"), F.lit(True)), a=" a ") == "v1"
    assert one(spark, R.decode_choice(F.col("a"), F.lit(True)), a="z") is None
    assert one(spark, R.json_score(F.col("a"), "cf"), a='{"cf": "4", broken') == 4


def span_score(unit, sentences):
    words = set().union(*sentences)
    if not unit or not words:
        return 0.0
    return len(unit & words) / len(unit | words) * (0.5 + 0.5 * min(len(unit), len(words)) / max(len(unit), len(words)))


def brute(units, sentences, most, skip=0.05):
    """The best total over all ways to give each unit the next sentences or none."""

    def best(u, at):
        if u == len(units):
            return 0.0
        spans = [span_score(units[u], sentences[at:end]) + best(u + 1, end) for end in range(at + 1, min(len(sentences), at + most) + 1)]
        return max([best(u + 1, at) - skip, *spans])

    return best(0, 0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.sampled_from("abcdefgh"), max_size=5), max_size=4), st.lists(st.sets(st.sampled_from("abcdefghij"), max_size=4), max_size=6), st.integers(1, 4))
def test_align_spans(units, sentences, most):
    spans = alignment.align_spans([alignment.span_scores(u, sentences, most) for u in units], len(sentences))
    at, total = 0, 0.0
    for u, (a, b) in zip(units, spans, strict=True):
        assert a == at and a <= b <= len(sentences) and b - a <= most
        total += span_score(u, sentences[a:b]) if b > a else -0.05
        at = b
    assert abs(total - brute(units, sentences, most)) < 1e-9


def test_a_span_ends_where_other_words_begin():
    one = alignment._words("the archbishop crossed the river")
    assert one == {"archbishop", "crossed", "river"}
    table = [alignment.span_scores(one, [{"archbishop", "crossed", "river"}, {"quite", "other", "words", "river"}])]
    assert alignment.align_spans(table, 2) == [(0, 1)]
    assert alignment.align_spans([alignment.span_scores(set(), [{"x"}])], 1) == [(0, 1)]  # 0 for a span is more than -0.05 for none


def test_bridge():
    assert alignment.bridge_lines([["a", "b"], ["x"], ["c"]], [["a"], ["b", "c"]]) == [(0, 2), (1, 0), (1, 1)]
    assert alignment.bridge_lines([["x"], ["y"]], [["a"]]) == [(0, 0), (0, 0)] == alignment.bridge_lines([["a"], ["b"]], [])
    assert alignment.bridge_lines([["q"], ["a"], ["q"], ["q"], ["d"], ["q"]], [["a"], ["z"], ["z"], ["d"]]) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 1), (3, 0)]


def test_latin_clauses(spark):
    text = "Annoque^a 12 Cæsar XIV venit, mi “vel” atque—quinque lib."
    rows = spark.createDataFrame([(1, text), (2, None)], "p int, t string")
    got = [(r.surfaces, r.tokens) for r in mining.latin_clauses(rows, "p", "t").orderBy("pos").collect()]
    assert [t for _, t in got] == [["anno", "que", "caesar", "venit"], ["mi"], ["vel"], ["atque"], ["quinque", "lib"]]
    assert got[0][0] == ["Anno", "que", "Caesar", "venit"]
