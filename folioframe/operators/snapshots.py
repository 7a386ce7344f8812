"""Differences of nested page snapshots, as flat entries of an edit log.

A snapshot is a row a page: fields of its own, a struct of metadata, a struct of regions that hold arrays of lines, and an array of
footnotes. The two rows of a page meet by one shuffle; its nodes (scope, target, values by field) are then grouped by page, scope and
target, which the pages' partitioning already satisfies, whatever the number of scopes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

ENTRY = "array<struct<scope:string,target_id:string,pos:int,node:string,fields:array<struct<field:string,value:string>>>>"


@dataclass(frozen=True)
class PageShape:
    """Names of a snapshot's parts, and the fields that are compared (fixed values); what a schema lacks counts as missing."""

    page: str = "page_id"
    meta: str = "meta"
    regions: str = "regions"
    line_id: str = "line_id"
    markers: str = "markers"
    footnotes: str = "footnotes"
    footnote_id: str = "footnote_id"
    reviewer: str = "reviewer"
    page_fields: list[str] = field(default_factory=lambda: ["page_num", "printed_page_num", "reading_order_index", "section_id", "source_pdf", "edition"])
    meta_fields: list[str] = field(default_factory=lambda: ["annotation_status", "review_status", "notes", "ocr_page_summary"])
    line_fields: list[str] = field(default_factory=lambda: ["text_gold", "marker_id", "notes", "review_status"])
    footnote_fields: list[str] = field(default_factory=lambda: ["text_gold", "kind", "marker_number", "body_line_id", "notes", "review_status"])


def json_text(c: Column) -> Column:
    """A value as JSON text, null for null."""
    whole = F.to_json(F.struct(c.alias("v")))
    return F.when(c.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))


def _values(owner: Column, kind: StructType, names: list[str]) -> Column:
    """The fields that the struct has, each with its value as JSON."""
    there = [n for n in names if n in kind.fieldNames()]
    return F.array(*[F.struct(F.lit(n).alias("field"), json_text(owner[n]).alias("value")) for n in there]).cast("array<struct<field:string,value:string>>")


def _nodes(pages: DataFrame, s: PageShape) -> Column:
    """All nodes of a page as one array."""
    kind = pages.schema
    own = F.struct(*pages.columns)
    one = lambda scope, target, pos, node, fields: F.struct(F.lit(scope).alias("scope"), target.cast("string").alias("target_id"), pos.cast("int").alias("pos"), node.alias("node"), fields.alias("fields"))
    none, no_fields = F.lit(None).cast("string"), F.array().cast("array<struct<field:string,value:string>>")

    def of_lines(lines: Column, kind: StructType, first: int) -> list[Column]:
        out = [F.transform(lines, lambda x, i: one("line", x[s.line_id], i + first, none, _values(x, kind, s.line_fields)))]
        if s.markers in kind.fieldNames():
            # An empty list is none.
            out.append(F.transform(lines, lambda x, i: one("body_marker", x[s.line_id], i + first, F.when(F.size(x[s.markers]) > 0, json_text(x[s.markers])), no_fields)))
        return out

    parts = [F.array(one("page", F.col(s.page), F.lit(0), none, _values(own, kind, s.page_fields)))]
    if s.meta in pages.columns:
        meta = F.col(s.meta)
        parts.append(F.array(one("page_meta", F.col(s.page), F.lit(0), none, _values(meta, kind[s.meta].dataType, s.meta_fields))))
    if s.regions in pages.columns:
        regions = kind[s.regions].dataType
        for place, region in enumerate(regions.fieldNames()):
            lines, line = F.coalesce(F.col(s.regions)[region], F.array()), regions[region].dataType.elementType
            known = F.filter(lines, lambda x: F.coalesce(x[s.line_id].cast("string"), F.lit("")) != "")
            parts += of_lines(known, line, place * 1_000_000)
    if s.footnotes in pages.columns and isinstance(kind[s.footnotes].dataType, ArrayType):
        note = kind[s.footnotes].dataType.elementType
        known = F.filter(F.coalesce(F.col(s.footnotes), F.array()), lambda x: F.coalesce(x[s.footnote_id].cast("string"), F.lit("")) != "")
        parts.append(F.transform(known, lambda x, i: one("footnote", x[s.footnote_id], i, F.to_json(x), _values(x, note, s.footnote_fields))))
    return F.concat(*[p.cast(ENTRY) for p in parts])


def nested_diff(old: DataFrame, new: DataFrame, shape: PageShape | None = None) -> DataFrame:
    """(page_id, scope, target_id, field, before, after, reviewer) of what a save changed, values as JSON text.

    Scopes: ``page`` and ``page_meta`` field by field; ``line`` field by field over all regions, lines that went give nothing;
    ``body_marker`` one entry for a line's whole list, null and empty being alike; ``footnote`` field by field, besides ``_added``
    or ``_deleted`` with the whole footnote. Null and missing are one value. Of equal ids on a page the last counts, nodes without an id
    don't. A snapshot has a row a page; a page that only one has is compared with an empty one. ``reviewer`` is the new page's.
    """
    s = shape or PageShape()

    has = s.meta in new.columns and s.reviewer in new.schema[s.meta].dataType.fieldNames()
    who = F.coalesce(F.col(s.meta)[s.reviewer].cast("string"), F.lit("")) if has else F.lit("")
    before = old.select(F.col(s.page).alias("page_id"), _nodes(old, s).alias("_old"))
    after = new.select(F.col(s.page).alias("page_id"), _nodes(new, s).alias("_new"), who.alias("reviewer"))
    sided = lambda c, is_new: F.transform(F.coalesce(F.col(c), F.array().cast(ENTRY)), lambda n: F.struct(F.lit(is_new).alias("is_new"), n.alias("n")))
    pages = before.unionByName(after, allowMissingColumns=True).groupBy("page_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_old", "_new", "reviewer")])
    nodes = pages.select("page_id", F.coalesce("reviewer", F.lit("")).alias("reviewer"), F.explode(F.concat(sided("_old", False), sided("_new", True))).alias("x"))
    pick = lambda side: F.max_by(F.when(F.col("x.is_new") == side, F.col("x.n")), F.when(F.col("x.is_new") == side, F.col("x.n.pos")))
    both = nodes.groupBy("page_id", F.col("x.n.scope").alias("scope"), F.col("x.n.target_id").alias("target_id")).agg(F.first("reviewer").alias("reviewer"), pick(False).alias("b"), pick(True).alias("a"))
    b, a = F.col("b"), F.col("a")
    of = lambda node, f: F.try_element_at(F.filter(node["fields"], lambda x: x["field"] == f), F.lit(1))["value"]
    entry = lambda f, before, after: F.struct(f.alias("field"), before.alias("before"), after.alias("after"))
    names = F.array_union(*[F.coalesce(F.transform(n["fields"], lambda x: x["field"]), F.array().cast("array<string>")) for n in (b, a)])
    every = F.filter(F.transform(names, lambda f: entry(f, of(b, f), of(a, f))), lambda x: ~x["before"].eqNullSafe(x["after"]))
    no_entry = F.array().cast("array<struct<field:string,before:string,after:string>>")
    marks = F.when(~b["node"].eqNullSafe(a["node"]), F.array(entry(F.lit("markers"), b["node"], a["node"]))).otherwise(no_entry)
    none = F.lit(None).cast("string")
    added, deleted = F.array(entry(F.lit("_added"), none, a["node"])), F.array(entry(F.lit("_deleted"), b["node"], none))
    changes = (
        F.when(F.col("scope").isin("page", "page_meta"), every)
        .when(F.col("scope") == "footnote", F.when(a.isNull(), deleted).when(b.isNull(), F.concat(every, added)).otherwise(every))
        .when(a.isNull(), no_entry)
        .when(F.col("scope") == "line", every)
        .otherwise(marks)
    )
    return both.select("page_id", "scope", "target_id", "reviewer", F.explode(changes).alias("x")).select("page_id", "scope", "target_id", "x.field", "x.before", "x.after", "reviewer")
