import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from folioframe.operators import changes, joins, sets, windows
from folioframe.plans import decisions, validators
from folioframe.sources import readers
from folioframe.streaming import incremental

SEGMENT = "segment_id string, page_id string, seq int, latin string, english string"


def segments(spark, rows):
    return validators.prepared(spark.createDataFrame(rows, SEGMENT))


def flags(df, *columns):
    return sorted(tuple(r) for r in df.select("segment_id", *columns).collect())


def test_numerals(spark):
    s = segments(spark, [("p0001_l1", "p0001", 1, "anno octavum", "in the year"), ("p0001_l2", "p0001", 2, "x", "eighth"), ("p0001_l3", "p0001", 3, "XIV XIV libri", "books"), ("p0002_l1", "p0002", None, "Secundus", "Secundus of Abula"), ("p0001_fn_1", "p0001", 4, "   ", "")])
    assert flags(validators.numerals(s), "latin_value", "latin_token") == [("p0001_l3", 14, "xiv")]


def test_citations(spark):
    s = segments(spark, [("p1_1", "p1", 1, "Matth. cap. 4.", "the gospel, chapter 4"), ("p2_1", "p2", 1, "Rom. imperium lib. 3", "Roman rule"), ("p3_1", "p3", 1, "Psal. 97. ver. 1.", "Psalm 97:1")])
    assert flags(validators.citations(s, validators.citation_rules(spark)), "flag", "rule") == [("p1_1", "BIBLICAL_BOOK_DROPPED", "Matth."), ("p2_1", "CITATION_KEYWORD_DROPPED", "lib.")]


def test_markers(spark):
    s = segments(spark, [("p1_1", "p1", 1, "a^a b^b", "one^a"), ("p1_2", "p1", 2, "c", "two^z two^z")])
    assert flags(validators.markers(s), "flag", "marker_id") == [("p1_1", "MARKER_DROPPED", "b"), ("p1_2", "MARKER_DUPLICATED", "z"), ("p1_2", "MARKER_HALLUCINATED", "z")]


def test_greek_and_glossary(spark):
    s = segments(spark, [("p1_1", "p1", 1, "dixit λόγος", "he said"), ("p2_1", "p2", 1, "ecclesia", "the temple"), ("p3_1", "p3", 1, "ecclesia", "the church"), ("p4_1", "p4", 1, "ecclesia", "an assembly")])
    assert flags(validators.greek(s), "flag", "span") == [("p1_1", "GREEK_DROPPED", "λόγος")]
    terms = readers.glossary(spark.createDataFrame([("ecclesia", r"\becclesia\b", ["church", "assembly"], ["temple"]), ("", "x", [], [])], "term string, latin_pattern string, approved array<string>, banned array<string>"))
    assert flags(validators.glossary(s, terms), "flag", "detail") == [("", "DRIFT", "assembly=1|church=1"), ("p2_1", "BANNED", "temple")]
    assert validators.glossary_drift(s, terms).head()["uses"] == {"church": 1, "assembly": 1}


def test_glossary_findings(spark):
    s = segments(spark, [("p1_1", "p1", 1, "ec^accle^b x", "nothing"), ("p2_1", "p2", 1, "verbum", "the old temple"), ("p2_2", "p2", 2, "alia", "he saith unto thee"), ("p3_fn_1", "p3", 1, "x", "thou hath"), ("p4_1", "p4", 1, "deus", "lord")])
    rows = [("ecclesia", r"\beccle", ["church"], [], None), ("verbum", "verbum", ["word"], ["shrine", "temple"], "scripture"), ("deus", "deus", [], ["idol"], None)]
    terms = readers.glossary(spark.createDataFrame(rows, "term string, latin_pattern string, approved array<string>, banned array<string>, category string"))
    got = flags(validators.glossary(s, terms), "flag", "severity", "detail", "english")
    assert ("p2_1", "SCRIPTURE_SUBSTITUTION", "high", "temple", "the old temple he saith unto thee") in got
    assert ("p2_2", "ARCHAISM", "medium", "saith|thee|unto", "he saith unto thee") in got
    assert {x[0] for x in got} <= {"p1_1", "p2_1", "p2_2"}


def test_greek_accents_cues_and_glosses(spark):
    s = segments(spark, [("p1_1", "p1", 1, "dixit λόγος ille", "he said λογος"), ("p2_1", "p2", 1, "dixit λόγος id est verbum", "λογος"), ("p3_1", "p3", 1, "dixit λόγος", "λόγος [word"), ("p4_1", "p4", 1, "λόγος", "λόγος"), ("p5_1", "p5", 1, "dixit λόγος", "[word] λόγος")])
    assert flags(validators.greek(s, glosses=True), "flag", "severity", "letters") == [("p1_1", "BRACKET_GLOSS_MISSING", "info", 5), ("p5_1", "BRACKET_GLOSS_MISSING", "info", 5)]


def test_structured_markers(spark):
    s = segments(spark, [("p1_1", "p1", 1, "x^q", "a^a")]).withColumn("markers", F.expr("array(named_struct('marker_id', 'A'), named_struct('marker_id', 'b'), named_struct('marker_id', '12'))"))
    assert flags(validators.markers(s), "flag", "marker_id") == [("p1_1", "MARKER_DROPPED", "b")]
    assert flags(validators.markers(s.withColumn("markers", F.col("markers").isNull().cast("string")).drop("markers")), "flag", "marker_id") == [("p1_1", "MARKER_DROPPED", "q"), ("p1_1", "MARKER_HALLUCINATED", "a")]


def test_rewrites_survive_a_crash(spark, tmp_path):
    from folioframe.sources import writers

    path = f"file://{tmp_path}/out"
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    writers.sorted_jsonl(one, path, [F.col("a")])
    writers.sorted_jsonl(two, path, [F.col("a")])
    assert [r.a for r in spark.read.json(path).collect()] == [2] and not (tmp_path / "out.old").exists()
    (tmp_path / "out").rename(tmp_path / "out.old")  # as after a crash between the renames
    writers.recover(spark, path)
    assert [r.a for r in spark.read.json(path).collect()] == [2]


def test_scans(spark, tmp_path):
    schema = StructType([StructField("k", StringType()), StructField("v", LongType())])
    f = tmp_path / "a.jsonl"
    f.write_text("\n".join([json.dumps({"k": "a", "v": 1}), "", json.dumps({"k": "a", "v": 2, "other": 3}), json.dumps({"k": "b", "v": 3}), '{"k": "c", "v']))
    assert sorted(map(tuple, readers.jsonl_lenient(spark, str(f), schema, "k").select("k", "v").collect())) == [("a", 2), ("b", 3)]
    good, bad = readers.jsonl_counting(spark, str(f), schema)
    assert (good.count(), bad.count()) == (3, 1)
    with pytest.raises(Exception, match="malformed row"):
        readers.jsonl_strict(spark, str(f), schema, "k").collect()


def test_which_row_counts(spark):
    rows = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True), ("a", 4, False), ("b", 1, False), ("b", 2, False)], "k string, pos int, ok boolean").withColumn("at", F.col("pos"))
    assert sorted(map(tuple, windows.latest_success(rows, ["k"], F.col("ok"), ["pos"]).select("k", "at").collect())) == [("a", 3)]
    assert sorted(map(tuple, windows.success_else_first_error(rows, ["k"], F.col("ok"), "pos").select("k", "at").collect())) == [("a", 3), ("b", 1)]


def test_fragments(spark):
    rows = spark.createDataFrame([("p", 1, 5, False), ("p", 2, 5, False), ("p", 3, 6, True), ("p", 4, 7, True), ("p", 5, None, False)], "page string, pos int, anchor int, cont boolean")
    assert [r["fragment_group"] for r in windows.fragment_groups(rows, "page", "pos", "anchor", "cont").orderBy("pos").collect()] == [1, 1, 1, 2, 3]


def test_changes(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q")], "id int, t string, u string")
    b = spark.createDataFrame([(1, "x", ""), (3, "n", None)], "id int, t string, u string")
    got = {(r["id"], r["field"], r["before"], r["after"]) for r in changes.diff(a, b, ["id"], ["t", "u"]).collect()}
    assert got == {(1, "u", None, ""), (2, "_deleted", None, None), (3, "_added", None, None), (3, "t", None, "n")}
    rows = [("a b c", "a ^m b\n c", "^m"), ("ab", "ab ^m ^m", "^m"), ("ab c", "a ^m b c", "^m"), ("ab", None, "^m"), ("ab", "ab", "^m"), ("ab", "^mab ", "^m"), (None, "^m", "^m"), ("a ", "b^m", "^m")]
    x = spark.createDataFrame(rows, "o string, r string, t string")
    got = x.select(changes.placed(F.col("o"), F.col("r"), F.col("t")), changes.place_or_append(F.col("o"), F.col("r"), F.col("t"))).collect()
    # White space counts as one blank, so a token may not part a word.
    assert [tuple(r) for r in got] == [(True, "a ^m b\n c"), (False, "ab^m"), (False, "ab c^m"), (False, "ab^m"), (False, "ab^m"), (True, "^mab"), (False, "^m"), (False, "a^m")]


def test_subgrams_and_tiles(spark):
    g = spark.createDataFrame([("a b c", 3), ("a b", 3), ("b c", 4), ("a b c d", 3)], "phrase string, count long")
    assert {r[0] for r in sets.without_subgrams(g).collect()} == {"a b c d", "b c"}
    big = spark.createDataFrame([("s", [1, 2, 3]), ("t", [4, 5])], "b string, items array<int>")
    small = spark.createDataFrame([("x", [1]), ("y", [2, 3]), ("z", [4])], "f string, items array<int>")
    assert [tuple(r) for r in joins.tiled_exactly(big, small, "b", "f", "items").collect()] == [("s", 2)]


def test_verdicts(spark):
    rows = [("v1", "A"), ("v1", "B"), ("v0", "A"), ("v1", "B")]
    assert decisions.ab_verdict(spark.createDataFrame(rows, "w string, p string"), "w", "p").head()["verdict"] == "PASS"
    assert decisions.ab_verdict(spark.createDataFrame([], "w string, p string"), "w", "p").head()["verdict"] == "INSUFFICIENT"
    assert decisions.ab_verdict(spark.createDataFrame([*rows, (None, "A")], "w string, p string"), "w", "p").head()["verdict"] == "INSUFFICIENT"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"k": "a"}\n{"k": "b"}\n')
    out = str(tmp_path / "out")
    schema = StructType([StructField("k", StringType())])
    for _ in range(2):  # the second run finds nothing new
        q = incremental.upsert_batches(incremental.event_log(spark, str(tmp_path / "in"), schema), str(tmp_path / "cp"), lambda df, n: df.write.mode("append").json(out))
        q.awaitTermination(60)
    assert spark.read.json(out).count() == 2


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "ok"

    assert incremental.with_retries(flaky, wait=0) == "ok"
    with pytest.raises(ValueError):
        incremental.with_retries(lambda: (_ for _ in ()).throw(ValueError()), stop=lambda e: True, wait=0)
