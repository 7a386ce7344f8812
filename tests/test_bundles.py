"""Page bundles against plain Python, over shaped conversations and on hard rows."""

import html
import re

import pytest

from folioframe import queries as Q
from folioframe.plans import bundles as B

SCHEMA = "segment_id string, page_id string, segment_type string, seq int, latin string, english string, marker_id string, body_segment_id string, spans_pages array<string>, source_line_ids array<string>"


def expected(rows):
    """page -> (body ids, note ids, page that its first lines belong to), one rule after the other."""
    bare = lambda x: (x or "").removeprefix("seg_")
    home = lambda r: r["spans_pages"][0] if r["spans_pages"] else r["page_id"] or ""
    body = [r for r in rows if r["segment_type"] != "footnote"]
    reading = sorted(body, key=lambda r: (home(r), 1 << 30 if r["seq"] is None else r["seq"], r["segment_id"]))
    claimed, carried, later = {}, {}, {}
    for place, r in enumerate(reading):
        lines = r["source_line_ids"] or [r["segment_id"]]
        for k, line in enumerate(lines):
            claimed.setdefault(bare(line), (home(r), (place, k)))
        for page in {*(r["spans_pages"] or []), r["page_id"] or "", *re.findall(r"(p\d+)_", " ".join(lines))} - {""}:
            for symbol in re.findall(r"\^([A-Za-z0-9]{1,2})", r["latin"] or ""):
                carried.setdefault((page, symbol), home(r))
        for page in (r["spans_pages"] or [])[1:]:
            later.setdefault(page, home(r))

    def place_on_page(r, end):
        m = re.search(end, r["segment_id"])
        return (0, r["seq"], r["segment_id"]) if r["seq"] is not None else (1, int(m[1]), r["segment_id"]) if m else (2, 0, r["segment_id"])

    pages = {}
    for r in sorted(body, key=lambda r: place_on_page(r, r"_l(\d+)$")):
        if r["page_id"]:
            pages.setdefault(r["page_id"], ([], []))[0].append(r["segment_id"])
    rank = lambda r: claimed.get(bare(r["body_segment_id"]), (None, None))[1]
    notes = [r for r in rows if r["segment_type"] == "footnote"]
    for r in sorted(notes, key=lambda r: (0, rank(r), r["segment_id"]) if rank(r) else (1, *place_on_page(r, r"_fn_(\d+)$"))):
        line = bare(r["body_segment_id"])
        to = carried.get((r["page_id"], r["marker_id"])) or (claimed.get(line) or ("",))[0] or r["page_id"]
        if to:
            pages.setdefault(to, ([], []))[1].append(r["segment_id"])
    return {p: (b, n, later.get(p)) for p, (b, n) in pages.items()}


def got(x):
    ids = lambda c: [s.segment_id for s in c]
    return {r.page_id: (ids(r.body), ids(r.notes), r.continued and r.continued.from_page) for r in x.collect()}


def test_whole_conversations(spark, small):
    segments = Q._spanning_segments(spark, small)
    rows = [r.asDict(recursive=True) for r in segments.collect()]
    want = expected(rows)
    assert got(B.bundled(segments)) == want
    moved = {n for p, (_, notes, _) in want.items() for n in notes if not n.startswith(p)}
    assert moved and any(c for *_, c in want.values()) and len(rows) > 80


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        ("p1_l1", "p1", "body", 2, "uno^a <b>", "one^a & two", None, None, ["p1", "p2", "p3"], ["p1_body_l1", "p2_body_l1"]),
        ("p1_l2", "p1", None, 1, None, None, None, None, None, None),  # no type is body, no texts are empty ones
        ("p2_l9", "p2", "body", None, "tres^a^zz", "x", None, None, [], ["seg_p2_body_l1", "p2_body_l2"]),  # a seam: its first line is p1's
        ("p2_l10", "p2", "body", None, "", "", None, None, None, []),
        ("x", "", "body", 1, "nowhere^q", "", None, None, None, None),
        ("p2_fn_1", "p2", "footnote", 1, "nota^a", "note^a", "a", "seg_p2_body_l2", None, None),  # the caret a of p2 is read on p1 first
        ("p2_fn_2", "p2", "footnote", 2, "nota", 'a "note"', "zz", "p2_body_l1", None, None),
        ("p2_fn_3", "p2", "footnote", 3, "n", "n", "m", "seg_p2_body_l1", None, None),  # no caret: the line's first claimant, p1
        ("p4_fn_4", "p4", "footnote", None, "n", "n", None, None, None, None),  # nothing known: its own page
        ("fn", "", "footnote", None, "n", "n", "k", None, None, None),  # no page at all
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_hard_rows(odd):
    rows = [r.asDict(recursive=True) for r in odd.collect()]
    x = got(B.bundled(odd))
    assert x == expected(rows)
    assert x == {"p1": (["p1_l2", "p1_l1"], ["p2_fn_3", "p2_fn_1"], None), "p2": (["p2_l9", "p2_l10"], ["p2_fn_2"], "p1"), "p4": ([], ["p4_fn_4"], None)}
    assert got(B.bundled(odd.limit(0))) == {}


def test_markdown(spark, odd):
    polished = spark.createDataFrame([("p2", "First^zz.\n\n\nSecond. "), ("p9", "none")], "page_id string, english string")
    text = {r.page_id: r.markdown for r in B.markdown(B.bundled(odd), polished).collect()}
    assert set(text) == {"p1", "p2", "p4"}
    assert text["p2"].startswith("# Page p2\n\n## Interlinear\n\n*⟵ First lines: the end of the last sentence of p1 (p1_l1). This page's own text begins at l0001.*\n\n<a id=\"line-p2-l0009\"></a>**LA**  tres")
    assert '<sup id="fnref-p2-zz"><a href="#fn-p2_fn_2">zz</a></sup>' in text["p2"] and '<sup id="fnref-p2-a">a</sup>' in text["p2"]  # a's note went to p1
    assert text["p2"].endswith('## Reading\n\nFirst<sup><a href="#fn-p2_fn_2">zz</a></sup>.\n\nSecond.\n')
    assert "⟶ Runs on to p2, p3; translated whole here." in text["p1"] and "**LA**  uno<sup" in text["p1"] and "## Reading" not in text["p1"]
    assert '**<a href="#fnref-p1-a">^a</a>**  *LA:* nota\n\n**EN:** note' in text["p1"]


def test_html(spark, odd):
    text = {r.page_id: r.html for r in B.html(B.bundled(odd), spark.createDataFrame([("p1", "a < b")], "page_id string, english string")).collect()}
    assert html.escape("<b>") in text["p1"] and "<b>" not in text["p1"] and "one<sup>" in text["p1"] and "a &lt; b" in text["p1"]
    assert 'id="fn-p2_fn_2"' in text["p2"] and "a &quot;note&quot;" in text["p2"] and '<dl id="line-p2-l0009">' in text["p2"]
    targets = {p: set(re.findall(r'href="#([^"]+)"', t)) - set(re.findall(r'id="([^"]+)"', t)) for p, t in text.items()}
    assert targets["p1"] == {"fnref-p1-m"} and not targets["p2"]  # m has no caret anywhere
