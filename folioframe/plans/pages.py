"""Pages as normalised tables: lines, footnotes, bundles, text reports, fixes, scores, prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions import records as R

REGIONS = ("header", "body", "marginalia", "catchword")


def scan_lines(records: DataFrame) -> DataFrame:
    """OCR records (page_id, page_num, lines) as a table of lines: unknown regions are body, footnotes marginalia, ids and seq by place."""
    x = records.select("page_id", "page_num", F.posexplode("lines").alias("_pos", "l"))
    region = F.when(F.col("l.region") == "footnote", "marginalia").when(F.col("l.region").isin(*REGIONS), F.col("l.region")).otherwise("body")
    x = x.withColumns({"region": region, "_m": P.inline_markers(F.coalesce("l.text_raw_ocr", F.lit("")))})
    x = x.withColumn("seq", F.row_number().over(Window.partitionBy("page_id", "region").orderBy("_pos")))
    return x.select("page_id", "page_num", "region", F.format_string("%s_%s_l%04d", "page_id", "region", "seq").alias("line_id"), "seq", F.col("_m.text").alias("text"), F.col("_m.markers").alias("markers"), F.col("l.marker_id").alias("marker_id"), F.col("l.marginalia_anchor_index").alias("anchor_index"), F.col("l.line_index").alias("line_index"))


def anchored_notes(lines: DataFrame) -> DataFrame:
    """Footnotes of marginal lines: the body line they anchor to, and numbers by place in the body, orphans last."""
    body = lines.where("region = 'body'").select("page_id", F.col("line_index").alias("anchor_index"), F.col("line_id").alias("body_line_id"), F.col("seq").alias("_body"))
    x = lines.where("region = 'marginalia'").join(body, ["page_id", "anchor_index"], "left")
    n = F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("_body").asc_nulls_last(), "seq"))
    return x.select("page_id", F.format_string("%s_fn%04d", "page_id", "seq").alias("footnote_id"), "body_line_id", "marker_id", "text", n.alias("marker_number"))


def marker_symbols(lines: DataFrame, notes: DataFrame) -> DataFrame:
    """Inline markers joined with the notes of their page and symbol; those without a note are dropped."""
    m = lines.select("page_id", "line_id", F.explode("markers").alias("m")).select("page_id", "line_id", F.col("m.symbol").alias("marker_id"), F.col("m.offset").alias("offset"))
    return m.join(notes.select("page_id", "marker_id", "footnote_id"), ["page_id", "marker_id"])


def locked(lines: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Lines that are locked, or lie on a locked page."""
    ok = F.col("review_status") == "locked"
    if pages is None:
        return lines.where(ok)
    p = pages.where("page_status = 'locked'").select("page_id").distinct().withColumn("_p", F.lit(True))
    return lines.join(p, "page_id", "left").where(ok | F.col("_p")).drop("_p")


def note_homes(notes: DataFrame, carets: DataFrame, lines: DataFrame) -> DataFrame:
    """A note's page: that of the first caret with its marker, else of its anchor line, else its own."""
    c = carets.groupBy("marker_id").agg(F.min_by("page_id", "pos").alias("_c"))
    home = lines.select(F.col("line_id").alias("body_line_id"), F.col("page_id").alias("_l"))
    return notes.join(c, "marker_id", "left").join(home, "body_line_id", "left").select(*notes.columns, F.coalesce("_c", "_l", "page_id").alias("home"))


def bundles(segments: DataFrame, heading: str = "## ") -> DataFrame:
    """A Markdown text a page: body segments in order, then footnotes, each with Latin above English."""
    kind = F.col("segment_id").contains("_fn_")
    block = F.concat(F.when(kind, F.lit("> ")).otherwise(""), F.col("latin"), F.lit("\n\n"), F.coalesce("english", F.lit("")))
    x = segments.select("page_id", F.struct(kind.alias("k"), R.order_key(F.col("seq"), F.col("segment_id")).alias("o"), "segment_id", block.alias("b")).alias("s"))
    out = x.groupBy("page_id").agg(F.array_sort(F.collect_list("s")).alias("p"))
    return out.select("page_id", F.concat(F.lit(heading), F.col("page_id"), F.lit("\n\n"), F.array_join(F.transform("p", lambda y: y["b"]), "\n\n")).alias("markdown"))


def report(table: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table; more than ``most`` rows are refused, not cut."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report holds {most} rows at most")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(table.columns), line(["---"] * len(table.columns)), *map(line, rows)]) + "\n"


def apply_fixes(segments: DataFrame, fixes: DataFrame, most: int | None = 3) -> DataFrame:
    """Append a fidelity_fix version for each selected fix: it changes something, and its fidelity score is at most ``most``."""
    ok = ~F.coalesce("no_change", F.lit(False)) & F.col("error").isNull()
    if most is not None:
        ok = ok & F.coalesce(F.col("score").try_cast("int") <= most, F.lit(False))
    f = fixes.where(ok).select("segment_id", "proposed")
    entry = F.struct(R.max_version(F.col("history")).alias("version"), F.lit("fidelity_fix").alias("stage"), F.col("proposed").alias("english"))
    out = segments.join(f, "segment_id", "left")
    return out.withColumn("history", F.when(F.col("proposed").isNotNull(), F.concat("history", F.array(entry))).otherwise(F.col("history"))).drop("proposed")


def repair_queue(scores: DataFrame, inputs: DataFrame, unit: str, most: int) -> DataFrame:
    """Units without error whose fidelity is at most ``most`` and that the inputs have, worst first."""
    x = scores.where(F.col("error").isNull() & F.coalesce(F.col("score").try_cast("int") <= most, F.lit(False)))
    return x.join(inputs, unit).orderBy(F.col("score").try_cast("int"), unit)


def coverage(scores: DataFrame, findings: DataFrame, unit: str) -> DataFrame:
    """Per score: units, and units that some validator flagged."""
    f = findings.select(unit).distinct().withColumn("_f", F.lit(True))
    return scores.join(f, unit, "left").groupBy("score").agg(F.count("*").alias("units"), F.count_if(F.col("_f")).alias("flagged"))


def external_scores(rows: DataFrame, score: Callable[[list[str], list[str], list[str]], list[float]], unit: str | list[str], src: str, mt: str, ref: str, reference_free: bool = False) -> DataFrame:
    """Call a scorer on batches of rows; rows that can't be scored keep a null score and their error."""
    units = [unit] if isinstance(unit, str) else unit
    x = rows.select(*units, src, mt, ref).withColumn("error", R.scorable_error(F.col(src), F.col(mt), None if reference_free else F.col(ref)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            good = b["error"].isna()
            b["score"] = float("nan")
            if good.any():
                b.loc[good, "score"] = score(list(b.loc[good, src]), list(b.loc[good, mt]), list(b.loc[good, ref].fillna("")))
            yield b[[*units, "score", "error"]]

    kinds = "".join(f"`{u}` {rows.schema[u].dataType.simpleString()}, " for u in units)
    return x.mapInPandas(run, f"{kinds}score double, error string").withColumn("score", F.when(F.isnan("score"), None).otherwise(F.col("score")))


def prompt(parts: dict[str, Column]) -> Column:
    """Sections ``[name]`` and their text, empty ones left out."""
    return F.concat_ws("\n\n", *[F.when(~R.blank(c), F.concat(F.lit(f"[{k}]\n"), c)) for k, c in parts.items()])


def recognise(images: DataFrame, engine: Callable[[bytes], tuple[str, float]]) -> DataFrame:
    """Run an OCR engine, given by the caller, over a ``binaryFile`` table; (path, text, confidence)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [engine(bytes(x)) for x in b["content"]]
            yield pd.DataFrame({"path": b["path"], "text": [t for t, _ in got], "confidence": [c for _, c in got]})

    return images.select("path", "content").mapInPandas(run, "path string, text string, confidence double")


def next_ordinal(lines: DataFrame, region: str) -> DataFrame:
    """Per page: one more than the largest ordinal of the region's line ids, a line without one counting by its place."""
    n = F.nullif(F.regexp_extract("line_id", rf"_{region}_l([0-9]{{4}})$", 1), F.lit("")).try_cast("int")
    return lines.where(F.col("region") == region).groupBy("page_id").agg((F.max(F.coalesce(n, F.col("seq"))) + 1).alias("next_ordinal"))


def translate(units: DataFrame, model: Callable[[str], str], unit: str, text: str) -> DataFrame:
    """Ask a model, given by the caller, for each unit; its JSON gives english, notes and uncertain, with defaults; what isn't JSON is an error."""
    asked = units.select(F.col(unit), prompt({"text": F.col(text)}).alias("_p"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({unit: b[unit], "raw": [model(p) for p in b["_p"]]})

    out = asked.mapInPandas(run, f"{unit} {units.schema[unit].dataType.simpleString()}, raw string")
    x = F.from_json(R.json_object_text(F.col("raw")), "english string, notes string, uncertain boolean")
    return out.select(unit, F.coalesce(x["english"], F.lit("")).alias("english"), F.coalesce(x["notes"], F.lit("")).alias("notes"), F.coalesce(x["uncertain"], F.lit(False)).alias("uncertain"), F.when(x["english"].isNull(), "no english").alias("error"))
