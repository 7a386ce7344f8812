"""OCR sources with engines of the test's own, and what the page service answers, on rows made up here."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from folioframe.plans import pages as PP
from folioframe.plans import service
from folioframe.sources import ocr

CHECKED = ["path", "text", "avg_confidence", "min_confidence", "error"]


@pytest.fixture
def images(spark):
    rows = [("a", b"one two", 1), ("b", b"", 2), ("c", None, 3)]
    return spark.createDataFrame(rows, "path string, content binary, lines int")


def got(df):
    return {r["path"]: tuple(r[1:]) for r in df.select(CHECKED).collect()}


def test_words(images):
    x = got(ocr.from_words(images, lambda b: (b.decode(), [90, "81.5", "-1", -1] if b else [-1])))
    assert x == {"a": ("one two", 85.75, 81.5, None), "b": ("", 0.0, 0.0, None), "c": (None, 0.0, 0.0, "no image")}


def test_lines_of_characters_and_bare_texts(images):
    x = got(ocr.from_lines(images, lambda b: [("one", [0.5, 0.75, -1]), "two", ("three", [])] if b else [], scale=100.0))
    assert x["a"] == ("one\ntwo\nthree", 62.5, 50.0, None) and x["b"] == ("", 0.0, 0.0, None)


def test_process(images):
    say = "import sys; b = open(sys.argv[1], 'rb').read(); print(' ' + b.decode().upper()); sys.exit(0 if b else 3)"
    x = got(ocr.from_process(images, [sys.executable, "-c", say, "{image}"]))
    assert x == {"a": ("ONE TWO", 0.0, 0.0, None), "b": ("", 0.0, 0.0, "exit 3"), "c": (None, 0.0, 0.0, "no image")}
    late = ocr.from_process(images.limit(1), [sys.executable, "-c", "import time; time.sleep(20)"], timeout=0.5)
    assert got(late)["a"] == ("", 0.0, 0.0, "timeout")


def test_vision(spark, images):
    page = {"page_summary": "s", "lines": [{"text": "x^0", "confidence": 0.5, "line_index": 4}, 7, {"region": "footnote", "text": "n", "confidence": "0.25", "marker_id": 0, "marginalia_anchor_index": 4.0}, {"text": None, "confidence": 0.1, "illegible": True, "marginalia_anchor_index": "4"}]}
    x = ocr.from_vision(images, lambda b: f"```json\n{json.dumps(page)}\n```" if b else "[]")
    assert got(x) == {"a": ("x^0\nn\n", 37.5, 25.0, None), "b": (None, 0.0, 0.0, "not an object"), "c": (None, 0.0, 0.0, "no image")}
    a = x.where("path = 'a'").first()
    assert a["page_summary"] == "s"
    assert [tuple(line) for line in a["lines"]] == [("body", 4, "x^0", 0.5, False, "", None), ("footnote", 1, "n", 0.25, False, "0", 4), ("body", 2, "", 0.1, True, "", None)]
    lines = PP.scan_lines(ocr.as_records(x, F.col("path"), F.lit(1)))
    assert {(r["region"], r["text"], r["marker_id"]) for r in lines.collect()} == {("body", "x", ""), ("marginalia", "n", "0"), ("body", "", "")}


def test_vision_asks_again(images):
    def engine(image, asked=[]):  # noqa: B006
        asked.append(1)
        return '{"lines": 1}' if len(asked) < 3 else '{"lines": []}'

    one = images.where("path = 'a'").coalesce(1)
    assert got(ocr.from_vision(one, engine, retries=1))["a"][3] == "lines is not a list"
    assert got(ocr.from_vision(one, engine, retries=2))["a"][3] is None
    assert ocr.from_vision(images.limit(0), engine).count() == 0


def test_one_page(spark):
    pages = spark.createDataFrame([(1, "p1"), (2, "p2")], "page_num int, page_id string")
    assert [r["page_id"] for r in service.get_page(pages, "2").collect()] == ["p2"]
    assert service.get_page(pages, "9").count() == 0
    for bad in ("", "two", "1.5"):
        with pytest.raises(ValueError):
            service.get_page(pages, bad)


LINES = "page_id string, line_id string, text_gold string, marker_id string, notes string, review_status string"


def test_save(spark):
    stored = spark.createDataFrame([("p1", "a", "x", "", None, "draft"), ("p1", "b", "y", "", None, "draft"), ("p2", "c", "z", "", None, "draft"), ("p4", "e", "w", "", None, None)], LINES)
    rows = [("p1", "a", "X", "", None, "draft", ["n1", ""]), ("p1", "d", "new", "", None, None, []), ("p2", "c", "Z", "", None, "final", ["n9"]), ("p3", "q", "", "", None, "draft", None)]
    posted = spark.createDataFrame(rows, LINES + ", note_ids array<string>")
    notes = spark.createDataFrame([("p1", "n1", None), ("p2", "n2", "joke"), ("p3", "n9", "gloss")], "page_id string, footnote_id string, kind string")
    faults = service.line_faults(posted, notes)
    assert {tuple(r) for r in faults.collect()} == {("p2", "c: invalid review_status 'final'"), ("p2", "footnotes[n2]: invalid kind 'joke'"), ("p2", "c.markers[0]: footnote_id 'n9' not in footnotes[]")}
    after, edits, outcome = service.save_pages(stored, posted, faults)
    assert {tuple(r) for r in outcome.collect()} == {("p1", "saved"), ("p2", "invalid"), ("p3", "missing")}
    assert {(r["line_id"], r["text_gold"]) for r in after.collect()} == {("a", "X"), ("d", "new"), ("c", "z"), ("e", "w")}
    assert {(r["line_id"], r["field"], r["before"], r["after"]) for r in edits.collect()} == {("a", "text_gold", "x", "X"), ("d", "text_gold", None, "new"), ("d", "marker_id", None, "")}
    after, edits, outcome = service.save_pages(stored, posted.limit(0), faults.limit(0))
    assert (after.count(), edits.count(), outcome.count()) == (4, 0, 0)


def test_jobs(spark):
    asked = [
        ("1", "a.pdf", "3", None, None), ("2", "a.pdf", "7", "", None), ("3", "a.pdf", "7", "first", True), ("4", " ", "1", None, None), ("5", "a.pdf", "x", None, None),
        ("6", "a.pdf", "0", None, None), ("7", "no.pdf", "1", None, None), ("8", "a.txt", "1", None, None), ("9", "a.pdf", "1", "third", None), ("10", "a.pdf", "7", "second", None), ("11", "a.pdf", None, None, None),
    ]
    requests = spark.createDataFrame(asked, "job_id string, pdf string, page string, edition string, overwrite boolean")
    files = spark.createDataFrame([("a.pdf",), ("a.txt",)], "pdf string")
    pages = spark.createDataFrame([("first", "p0007")], "edition string, page_id string")
    x = {r["job_id"]: r for r in service.start_jobs(requests, files, pages, ("first", "second")).collect()}
    assert {k: r["code"] for k, r in x.items()} == {"1": 202, "2": 409, "3": 202, "4": 400, "5": 400, "6": 400, "7": 404, "8": 404, "9": 400, "10": 202, "11": 400}
    assert x["1"]["page_id"] == "p0003" and x["1"]["error"] is None and x["2"]["error"] == "annotation_exists"
    log = spark.createDataFrame([("1", 1, "queued"), ("1", 2, "running"), ("2", 1, "queued"), ("1", 2, "done")], "job_id string, at int, state string")
    assert {tuple(r) for r in service.job_status(log, "job_id", "at", "state").collect()} == {("1", "running"), ("2", "queued")}
