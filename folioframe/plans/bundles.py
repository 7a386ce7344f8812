"""Page bundles: segments under the page where they are read, with the footnotes that belong there, as Markdown or HTML.

A sentence may run over pages; it stands on the first of them, its home. A footnote goes where its marker is read: to the home of the
sentence whose Latin carries the marker's caret (markers begin anew on each printed page, so carets are keyed by every page that a sentence
touches), else to the home of the first sentence in reading order that claims the anchor line, else to the page it is printed on.
Both claims are aggregations by key; a page's bundle is the only thing collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CARET = r"\^([A-Za-z0-9]{1,2})"
LAST = 1 << 30


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _line(c: Column) -> Column:
    """A line id without the prefix that segments put before it."""
    return F.regexp_replace(c, "^seg_", "")


def _order(digits: str) -> Column:
    """Order on a page: by seq, then without one by the number at the end of the id, then the rest by id."""
    n = F.nullif(F.regexp_extract("segment_id", digits, 1), F.lit("")).try_cast("int")
    return F.struct(F.when(F.col("seq").isNotNull(), 0).when(n.isNotNull(), 1).otherwise(2).alias("k"), F.coalesce("seq", n, F.lit(0)).alias("n"), F.col("segment_id").alias("i"))


def prepared(segments: DataFrame) -> DataFrame:
    """Segments with ``home``, ``is_note``, ``later`` (pages after the home page), ``claims`` (line ids) and their place in reading order."""
    spans = F.coalesce("spans_pages", F.array().cast("array<string>"))
    own = F.coalesce("source_line_ids", F.array().cast("array<string>"))
    x = segments.withColumns({"segment_id": _text("segment_id"), "page_id": _text("page_id"), "latin": _text("latin"), "english": _text("english"), "marker_id": _text("marker_id"), "body_segment_id": _text("body_segment_id")})
    x = x.withColumns({"is_note": F.coalesce(F.col("segment_type") == "footnote", F.lit(False)), "home": F.coalesce(F.get(spans, F.lit(0)), "page_id"), "later": F.slice(spans, F.lit(2), F.greatest(F.size(spans) - 1, F.lit(0)))})
    x = x.withColumn("claims", F.when(F.size(own) > 0, own).otherwise(F.array("segment_id")))
    touched = F.filter(F.array_distinct(F.concat(spans, F.array("page_id"), F.flatten(F.transform("claims", lambda c: F.regexp_extract_all(c, F.lit("(p[0-9]+)_"), F.lit(1)))))), lambda p: p != "")
    return x.withColumns({"touched": touched, "reading": F.struct("home", F.coalesce("seq", F.lit(LAST)).alias("n"), F.col("segment_id").alias("i"))})


def line_claims(x: DataFrame) -> DataFrame:
    """(line, claimed_by, rank): for each line the home of the first sentence in reading order that holds it, and its place in that order."""
    each = x.where("not is_note").select("reading", F.posexplode("claims").alias("p", "line"))
    first = each.select(_line(F.col("line")).alias("line"), F.struct("reading", "p").alias("rank")).where("line <> ''")
    return first.groupBy("line").agg(F.min("rank").alias("rank")).select("line", F.col("rank.reading.home").alias("claimed_by"), "rank")


def caret_claims(x: DataFrame) -> DataFrame:
    """(page, symbol, carried_to): for each caret of a page the home of the first sentence in reading order whose Latin has it."""
    each = x.where("not is_note").select("reading", F.explode("touched").alias("page"), F.regexp_extract_all("latin", F.lit(CARET), F.lit(1)).alias("s"))
    each = each.select("reading", "page", F.explode(F.array_distinct("s")).alias("symbol"))
    return each.groupBy("page", "symbol").agg(F.min("reading").alias("r")).select("page", "symbol", F.col("r.home").alias("carried_to"))


def note_homes(x: DataFrame) -> DataFrame:
    """Footnotes with the page they go to, and the rank of their anchor line; those without any page are left out."""
    notes = x.where("is_note").withColumn("_anchor", _line(F.col("body_segment_id")))
    c = caret_claims(x).select(F.col("page").alias("page_id"), F.col("symbol").alias("marker_id"), "carried_to")
    out = notes.join(c, ["page_id", "marker_id"], "left").join(line_claims(x).withColumnRenamed("line", "_anchor"), "_anchor", "left")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return out.withColumn("goes_to", F.coalesce(blank("carried_to"), blank("claimed_by"), blank("page_id"))).where("goes_to is not null")


def bundled(segments: DataFrame) -> DataFrame:
    """(page_id, body, notes, continued): a row a page that has any of a body or footnotes.

    ``segments`` has segment_id, page_id, segment_type, seq, latin, english, marker_id, body_segment_id, spans_pages and source_line_ids.
    ``body`` in order of the page, ``notes`` in the order of the lines they hang on, those without such a line last. ``continued``
    names, where an earlier page's sentence takes this page's first lines, the home page and that sentence; of several the first in reading order.
    """
    x = prepared(segments)
    body = x.where("not is_note and page_id <> ''")
    of_page = F.struct(_order(r"_l([0-9]+)$").alias("o"), "segment_id", "latin", "english", "later", F.coalesce(F.get("source_line_ids", F.lit(0)), F.lit("")).alias("first_line"))
    bodies = body.groupBy("page_id").agg(F.array_sort(F.collect_list(of_page)).alias("body"))
    free = F.col("rank").isNull()
    of_note = F.struct(free.alias("free"), F.col("rank").alias("r"), F.when(free, _order(r"_fn_([0-9]+)$")).alias("o"), "segment_id", "marker_id", "latin", "english")
    notes = note_homes(x).groupBy(F.col("goes_to").alias("page_id")).agg(F.array_sort(F.collect_list(of_note)).alias("notes"))
    runs_on = body.select("reading", F.explode("later").alias("page_id")).groupBy("page_id").agg(F.min("reading").alias("r"))
    out = bodies.join(notes, "page_id", "full_outer").join(runs_on.select("page_id", F.struct(F.col("r.home").alias("from_page"), F.col("r.i").alias("sentence_id")).alias("continued")), "page_id", "left")
    none = lambda c: F.coalesce(F.col(c), F.array().cast(out.schema[c].dataType))
    return out.select("page_id", none("body").alias("body"), none("notes").alias("notes"), "continued")


def _escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def linked(text: Column, notes: Column, page: Column, back: bool) -> Column:
    """Carets as superscripts that lead to the page's last note of their symbol, if there is one; with ``back``, notes can lead back to them."""
    parts, symbols = F.split(text, CARET, -1), F.regexp_extract_all(text, F.lit(CARET), F.lit(1))
    own = lambda s: F.try_element_at(F.filter(notes, lambda n: (n["marker_id"] == s) & (n["segment_id"] != "")), F.lit(-1))["segment_id"]
    link = lambda s: F.coalesce(F.concat(F.lit('<a href="#fn-'), own(s), F.lit('">'), s, F.lit("</a>")), s)
    anchor = lambda s: F.concat(F.lit(' id="fnref-'), page, F.lit("-"), s, F.lit('"')) if back else F.lit("")
    up = F.transform(symbols, lambda s: F.concat(F.lit("<sup"), anchor(s), F.lit(">"), link(s), F.lit("</sup>")))
    return F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(up, i), F.lit("")))), "")


def _plain(c: Column) -> Column:
    return F.regexp_replace(c, CARET, "")


def _line_number(c: Column) -> Column:
    n = F.nullif(F.regexp_extract(c, r"_l([0-9]+)$", 1), F.lit("")).try_cast("int")
    return F.format_string("l%04d", n)


def _has_number(c: Column) -> Column:
    return c.rlike(r"_l[0-9]+$")


def continued_cue() -> Column:
    """What a reader is told on a page whose first lines belong to an earlier page's sentence; null elsewhere."""
    first = F.get("body", F.lit(0))["first_line"]
    of = F.when(F.col("continued.sentence_id") != "", F.concat(F.lit(" ("), F.col("continued.sentence_id"), F.lit(")"))).otherwise("")
    begins = F.when(_has_number(first), F.concat(F.lit(" at "), _line_number(first))).otherwise("")
    rest = F.when(F.size("body") == 0, "No sentence begins on this page.").otherwise(F.concat(F.lit("This page's own text begins"), begins, F.lit(".")))
    return F.when(F.col("continued").isNotNull(), F.concat(F.lit("⟵ First lines: the end of the last sentence of "), F.col("continued.from_page"), of, F.lit(". "), rest))


def _onward(later: Column) -> Column:
    return F.concat(F.lit("⟶ Runs on to "), F.array_join(later, ", "), F.lit("; translated whole here."))


def markdown(bundles: DataFrame, polished: DataFrame | None = None) -> DataFrame:
    """(page_id, markdown): Latin above English, then footnotes, then the polished reading (page_id, english), if any."""
    x, page, notes = _with_reading(bundles, polished), F.col("page_id"), F.col("notes")
    target = lambda b: F.when(_has_number(b["segment_id"]), F.concat(F.lit('<a id="line-'), page, F.lit("-"), _line_number(b["segment_id"]), F.lit('"></a>'))).otherwise("")
    row = lambda b: F.concat(target(b), F.lit("**LA**  "), linked(b["latin"], notes, page, True), F.lit("\n\n**EN**  "), linked(b["english"], notes, page, False), F.when(F.size(b["later"]) > 0, F.concat(F.lit("\n\n*"), _onward(b["later"]), F.lit("*"))).otherwise(""))
    name = lambda n: F.when(n["marker_id"] != "", F.concat(F.lit('<a href="#fnref-'), page, F.lit("-"), n["marker_id"], F.lit('">^'), n["marker_id"], F.lit("</a>"))).otherwise("")
    note = lambda n: F.concat(F.lit('<a id="fn-'), n["segment_id"], F.lit('"></a>**'), name(n), F.lit("**  *LA:* "), _plain(n["latin"]), F.lit("\n\n**EN:** "), _plain(n["english"]))
    blocks = [
        F.array(F.concat(F.lit("# Page "), page), F.lit("## Interlinear")),
        F.when(F.col("continued").isNotNull(), F.array(F.concat(F.lit("*"), continued_cue(), F.lit("*")))).otherwise(F.array().cast("array<string>")),
        F.transform("body", row),
        F.when(F.size(notes) > 0, F.concat(F.array(F.lit("## Footnotes")), F.transform(notes, note))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("_reading").isNotNull(), F.concat(F.array(F.lit("## Reading")), _paragraphs(linked(F.col("_reading"), notes, page, False)))).otherwise(F.array().cast("array<string>")),
    ]
    return x.select("page_id", F.concat(F.rtrim(F.array_join(F.concat(*blocks), "\n\n")), F.lit("\n")).alias("markdown"))


def _paragraphs(c: Column) -> Column:
    bare = lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")
    return F.filter(F.transform(F.split(c, r"(?U)\n\s*\n+"), bare), lambda p: p != "")


def _with_reading(bundles: DataFrame, polished: DataFrame | None) -> DataFrame:
    if polished is None:
        return bundles.withColumn("_reading", F.lit(None).cast("string"))
    return bundles.join(polished.select("page_id", F.col("english").alias("_reading")), "page_id", "left")


def html(bundles: DataFrame, polished: DataFrame | None = None) -> DataFrame:
    """(page_id, html): the same as a document of its own, with links between carets and footnotes; all text is escaped."""
    x, page = _with_reading(bundles, polished), _escaped(F.col("page_id"))
    notes = F.transform("notes", lambda n: F.struct(_escaped(n["segment_id"]).alias("segment_id"), _escaped(n["marker_id"]).alias("marker_id"), _escaped(_plain(n["latin"])).alias("latin"), _escaped(_plain(n["english"])).alias("english")))
    x = x.withColumn("_n", notes)
    notes = F.col("_n")
    target = lambda b: F.when(_has_number(b["segment_id"]), F.concat(F.lit(' id="line-'), page, F.lit("-"), _line_number(b["segment_id"]), F.lit('"'))).otherwise("")
    pair = lambda kind, text: F.concat(F.lit(f'<dt>{kind.upper()}</dt><dd class="{kind}">'), text, F.lit("</dd>"))
    cue = lambda text: F.concat(F.lit('<p class="cue">'), _escaped(text), F.lit("</p>"))
    row = lambda b: F.concat(F.lit("<dl"), target(b), F.lit(">"), pair("la", linked(_escaped(b["latin"]), notes, page, True)), pair("en", linked(_escaped(b["english"]), notes, page, False)), F.lit("</dl>"), F.when(F.size(b["later"]) > 0, cue(_onward(b["later"]))).otherwise(""))
    back = lambda n: F.when(n["marker_id"] != "", F.concat(F.lit('<dt><a href="#fnref-'), page, F.lit("-"), n["marker_id"], F.lit('">'), n["marker_id"], F.lit("</a></dt>"))).otherwise("")
    note = lambda n: F.concat(F.lit('<dl class="note" id="fn-'), n["segment_id"], F.lit('">'), back(n), pair("la", n["latin"]), pair("en", n["english"]), F.lit("</dl>"))
    none = F.array().cast("array<string>")
    blocks = F.concat(
        F.array(F.concat(F.lit('<!DOCTYPE html>\n<html>\n<head><meta charset="utf-8"><title>'), page, F.lit("</title></head>\n<body>\n<h1>Page "), page, F.lit("</h1>")), F.lit("<h2>Interlinear</h2>")),
        F.when(F.col("continued").isNotNull(), F.array(cue(continued_cue()))).otherwise(none),
        F.transform("body", row),
        F.when(F.size(notes) > 0, F.concat(F.array(F.lit("<h2>Footnotes</h2>")), F.transform(notes, note))).otherwise(none),
        F.when(F.col("_reading").isNotNull(), F.concat(F.array(F.lit("<h2>Reading</h2>")), F.transform(_paragraphs(linked(_escaped(F.col("_reading")), notes, page, False)), lambda p: F.concat(F.lit("<p>"), p, F.lit("</p>"))))).otherwise(none),
        F.array(F.lit("</body>\n</html>\n")),
    )
    return x.select("page_id", F.array_join(blocks, "\n").alias("html"))
