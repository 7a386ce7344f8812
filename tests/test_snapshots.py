"""Nested diffs on hard rows; the whole result of the query has a twin."""

from folioframe import queries as Q
from folioframe.operators import snapshots as S

LINE = "struct<line_id:string,text_gold:string,marker_id:string,notes:string,markers:array<struct<number:int>>>"
SCHEMA = f"page_id string, page_num int, other string, meta struct<reviewer:string,notes:string>, regions struct<body:array<{LINE}>,catchword:array<{LINE}>>, footnotes array<struct<footnote_id:string,text_gold:string,marker_number:int>>"


def line(i, text, marks=None, notes=None):
    return (i, text, None, notes, None if marks is None else [(m,) for m in marks])


def changes(spark, old, new):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    return sorted(((r.scope, r.target_id, r.field, r.before, r.after) for r in S.nested_diff(frame(old), frame(new)).collect()), key=str)


def test_scopes(spark):
    old = [("p1", 1, "x", ("r0", None), ([line("a", "one", [1]), line("b", "two", []), line("gone", "x", [9]), line("", "no id"), line(None, "no id")], [line("c", 'q"\n')]), [("f1", "n", 1), ("f2", "m", None), ("", "z", 0)])]
    new = [("p1", None, "y", ("r1", "hm"), ([line("a", "one", [2, 1]), line("b", None, None), line("d", "new", [3])], [line("c", 'q"\n'), line("c", "last counts")]), [("f1", "n", 2), ("f3", "k", None)])]
    want = [
        ("page", "p1", "page_num", "1", None), ("page_meta", "p1", "notes", None, '"hm"'),
        ("body_marker", "a", "markers", '[{"number":1}]', '[{"number":2},{"number":1}]'), ("line", "b", "text_gold", '"two"', None),
        ("line", "d", "text_gold", None, '"new"'), ("body_marker", "d", "markers", None, '[{"number":3}]'), ("line", "c", "text_gold", '"q\\"\\n"', '"last counts"'),
        ("footnote", "f1", "marker_number", "1", "2"), ("footnote", "f2", "_deleted", '{"footnote_id":"f2","text_gold":"m"}', None),
        ("footnote", "f3", "text_gold", None, '"k"'), ("footnote", "f3", "_added", None, '{"footnote_id":"f3","text_gold":"k"}'),
    ]
    assert sorted(changes(spark, old, new), key=str) == sorted(want, key=str)


def test_exact_entries(spark):
    old = [("p1", 1, "x", ("r0", None), ([line("a", "one", [1]), line("gone", "x", [9])], None), [("f1", "n", 1)])]
    new = [("p1", 2, "x", ("r1", None), ([line("a", "two", [1])], []), None)]
    assert changes(spark, old, new) == [("footnote", "f1", "_deleted", '{"footnote_id":"f1","text_gold":"n","marker_number":1}', None), ("line", "a", "text_gold", '"one"', '"two"'), ("page", "p1", "page_num", "1", "2")]
    frame = spark.createDataFrame(new, SCHEMA)
    assert {r.reviewer for r in S.nested_diff(spark.createDataFrame(old, SCHEMA), frame).collect()} == {"r1"}
    assert S.nested_diff(frame, frame).count() == 0 and S.nested_diff(frame.limit(0), frame.limit(0)).count() == 0


def test_pages_of_one_side(spark):
    page = [("p1", 1, "x", None, None, [("f", "n", None)])]
    assert changes(spark, [], page) == [("footnote", "f", "_added", None, '{"footnote_id":"f","text_gold":"n"}'), ("footnote", "f", "text_gold", None, '"n"'), ("page", "p1", "page_num", None, "1")]
    assert changes(spark, page, []) == [("footnote", "f", "_deleted", '{"footnote_id":"f","text_gold":"n"}', None), ("page", "p1", "page_num", "1", None)]


def test_missing_parts_and_types(spark):
    """A schema without some parts compares what there is; 1 and "1" differ."""
    a = spark.createDataFrame([("p", 1)], "page_id string, page_num int")
    b = spark.createDataFrame([("p", "1")], "page_id string, page_num string")
    assert [(r.field, r.before, r.after) for r in S.nested_diff(a, b).collect()] == [("page_num", "1", '"1"')]


def test_one_shuffle(spark, small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old, new = (x.checkpoint() for x in Q._snapshots(spark, small))
        plan = S.nested_diff(old, new)._jdf.queryExecution().executedPlan().toString()
        n = plan.count("Exchange ")
        assert n == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
