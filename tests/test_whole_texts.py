"""Queries over whole texts and tables, against plain Python."""

import pytest

from folioframe import queries as Q

LONG = "a" * 90 + " the end"


@pytest.fixture(scope="module")
def talks(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("talks"))
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", LONG + "!"), (1, 2, "user", LONG[:-1] + "D"), (2, 0, "user", "short")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


def test_lines_keep_whole_texts(spark, talks):
    got = [(r.text, r.n_markers, r.at) for r in Q.scan_to_annotation(spark, talks).orderBy("line_id").collect()]
    assert got == [(LONG, 1, 40), (LONG[:-1] + "D", 1, 40), (LONG + "!", 1, 40), ("short", 1, 5)]
    assert {len(line["text_raw_ocr"]) for r in Q._records(spark, talks).collect() for line in r.lines} == {len(LONG) + 2, len(LONG) + 3, 7}


def test_each_turn_is_held_against_the_next(spark, talks):
    turns = {(1, 0): LONG, (1, 1): LONG + "!", (1, 2): LONG[:-1] + "D", (2, 0): "short"}

    def rate(a, b):
        return round(100 * (max(len(a), len(b)) - sum(x == y for x, y in zip(a, b, strict=False))) / max(len(a), len(b)), 6)

    want = {(c, t): rate(a, turns.get((c, t + 1), "")) for (c, t), a in turns.items()}
    assert {(r.conv_id, r.turn): r.rate for r in Q.char_diff_rate(spark, talks).collect()} == want
    assert want[1, 0] == round(100 / (len(LONG) + 1), 6)

    words = {k: set(v.replace("!", " ").lower().split()) - {"the"} for k, v in turns.items()}
    shared = {k: len(w & words.get((k[0], k[1] + 1), set())) / len(w | words.get((k[0], k[1] + 1), set())) for k, w in words.items()}
    assert {(r.conv_id, r.turn): r.jaccard for r in Q.set_jaccard(spark, talks).collect()} == {k: round(v, 9) for k, v in shared.items()}
    errors = {(r.conv_id, r.turn): r.error for r in Q.external_scorer(spark, talks).collect()}
    assert errors == {(1, 0): None, (1, 1): None, (1, 2): "missing_translation", (2, 0): "missing_translation"}


def test_hyphens_at_line_ends_are_fused(spark, tmp_path):
    texts = ["frei- \n  heit und", "soft\u00adly tied\nknots ", "no break-here", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in Q.join_dehyphenate(spark, tmp_path).collect()}
    # The shape breaks "en", "re", "ti" and "is" with a hyphen, which joining takes out again.
    assert got == {0: "freiheit und", 1: "soft\u00adly tied knots", 2: "no break-here", 3: ""}


@pytest.fixture(scope="module")
def keys(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("keys"))
    spark.range(1, 2501).selectExpr("id AS c_custkey", "id % 5 AS c_nationkey").write.parquet(f"{d}/customer.parquet")
    spark.range(1, 2401).selectExpr("id AS s_suppkey", "id % 7 AS s_nationkey").write.parquet(f"{d}/supplier.parquet")
    return d


def test_clashes_of_all_customers(spark, keys):
    hits = [k for k in range(1, 2401) if k % 5 != k % 7]
    want = {u: (sum(k % 5 == u for k in hits), len({k % 7 for k in hits if k % 5 == u})) for u in range(5)}
    assert {r.unit: (r.n_lines, r.n_owners) for r in Q.self_overlap_clash(spark, keys).collect()} == want


def test_plan_reaches_the_last_key(spark, keys):
    got = {r.page_num: r.action for r in Q.work_plan_scan(spark, keys).collect()}
    assert got == {n: "skip" if n <= 2400 else "run" for n in range(1, 2501)}


def test_hard_rows_are_kept(spark, tmp_path):
    texts = ["Æther & cœur Élan 12", "He saw St. Peter. Then Dr. No left! Was it 3?", "x" * 400 + " end."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {r.doc_id: r.tokens for r in Q.tokenize_fold(spark, tmp_path).collect()}
    assert tokens == {0: "aether and coeur elan 12", 1: "he saw st peter then dr no left was it 3", 2: "x" * 400 + " end"}
    assert {r.doc_id: r.n for r in Q.split_sentences_abbrev(spark, tmp_path).where("doc_id > 0").collect()} == {1: 3, 2: 1}
    assert {r.doc_id: r.placed for r in Q.placement_validator(spark, tmp_path).collect()} == {0: True, 1: True, 2: False}
