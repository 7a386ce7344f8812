"""What a page service answers, as tables: page lists, one page, reports, saving with checks, and OCR jobs.

There is no server here; a handler calls one of these and sends the rows. All of them work on whole tables, so that many pages are
saved, or many jobs asked for, at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import changes as C

# Fixed values.
REVIEW_STATUS = ("draft", "reviewed", "locked")
FOOTNOTE_KIND = ("citation", "gloss", "cross_ref", "not_a_note", "other")
LINE_FIELDS = ("text_gold", "marker_id", "notes", "review_status")


def list_pages(pages: DataFrame) -> DataFrame:
    """Number, id, confidences and status of all pages."""
    return pages.select("page_num", "page_id", "raw_confidence_avg", "raw_confidence_min", "qc_status")


def get_page(pages: DataFrame, number: str) -> DataFrame:
    """The page whose number the request's text names; no row if there is none (404), ValueError if it isn't an integer (400)."""
    if not number:
        raise ValueError("page id required")
    try:
        n = int(number)
    except ValueError:
        raise ValueError("page id must be integer") from None
    return pages.where(F.col("page_num") == n)


def line_faults(lines: DataFrame, notes: DataFrame) -> DataFrame:
    """(page_id, error) of posted lines and notes: unknown status or kind, and markers that name a note their page lacks.

    ``lines``: page_id, line_id, review_status, note_ids (those its markers name, empty ones being no reference); ``notes``:
    page_id, footnote_id, kind. A null status is a draft, a null kind a citation.
    """
    status, kind = F.coalesce("review_status", F.lit("draft")), F.coalesce("kind", F.lit("citation"))
    bad = lines.where(~status.isin(*REVIEW_STATUS)).select("page_id", F.format_string("%s: invalid review_status '%s'", "line_id", status).alias("error"))
    odd = notes.where(~kind.isin(*FOOTNOTE_KIND)).select("page_id", F.format_string("footnotes[%s]: invalid kind '%s'", "footnote_id", kind).alias("error"))
    named = lines.select("page_id", "line_id", F.posexplode("note_ids").alias("at", "footnote_id")).where("footnote_id <> ''")
    lost = named.join(notes.select("page_id", "footnote_id"), ["page_id", "footnote_id"], "left_anti")
    gone = lost.select("page_id", F.format_string("%s.markers[%d]: footnote_id '%s' not in footnotes[]", "line_id", "at", "footnote_id").alias("error"))
    return bad.unionByName(odd).unionByName(gone)


def save_pages(stored: DataFrame, posted: DataFrame, faults: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Save posted pages of lines: (all lines after it, edits for the log, outcome of each posted page).

    A page goes in as a whole or not at all: one that isn't stored is "missing" (404), one with a fault "invalid" (400), all others
    are "saved". Edits are the changed fields of lines that the posted page has. ``posted`` has the columns of ``stored``.
    """
    known, bad = stored.select("page_id").distinct().withColumn("_k", F.lit(True)), faults.select("page_id").distinct().withColumn("_f", F.lit(True))
    asked = posted.select("page_id").distinct().join(known, "page_id", "left").join(bad, "page_id", "left")
    outcome = asked.select("page_id", F.when(F.col("_k").isNull(), "missing").when(F.col("_f"), "invalid").otherwise("saved").alias("outcome"))
    good = outcome.where("outcome = 'saved'").select("page_id")
    new = posted.join(good, "page_id", "left_semi")
    after = stored.join(good, "page_id", "left_anti").unionByName(new.select(*stored.columns))
    old = stored.join(good, "page_id", "left_semi")
    edits = C.diff(old, new, ["page_id", "line_id"], list(LINE_FIELDS), deletions=False).where("field <> '_added'")
    return after, edits, outcome


def start_jobs(requests: DataFrame, files: DataFrame, pages: DataFrame, editions: tuple[str, ...]) -> DataFrame:
    """Each request (job_id, pdf, page, edition, overwrite) with page_id, code (202, 400, 404, 409) and error.

    ``files`` holds the names of the source files (pdf), ``pages`` those already annotated (edition, page_id). The first rule that
    a request breaks is its error. Null or empty editions are the first of ``editions``, and a null overwrite is false.
    """
    x = requests.withColumns({
        "pdf": F.trim(F.coalesce("pdf", F.lit(""))), "_n": F.coalesce(F.col("page").cast("string"), F.lit("0")).try_cast("int"),
        "edition": F.coalesce(F.nullif(F.trim("edition"), F.lit("")), F.lit(editions[0])), "overwrite": F.coalesce("overwrite", F.lit(False)),
    }).withColumn("page_id", F.format_string("p%04d", "_n"))
    x = x.join(files.select("pdf").distinct().withColumn("_pdf", F.lit(True)), "pdf", "left")
    x = x.join(pages.select("edition", "page_id").distinct().withColumn("_old", F.lit(True)), ["edition", "page_id"], "left")
    rules = [
        (F.col("_n").isNull(), 400, "page must be an integer"),
        (F.col("pdf") == "", 400, "pdf is required"),
        (F.col("_n") < 1, 400, "page must be >= 1"),
        (~F.col("edition").isin(*editions), 400, "edition must be one of " + ", ".join(sorted(editions))),
        (F.col("_pdf").isNull() | ~F.lower("pdf").endswith(".pdf"), 404, "PDF not found"),
        (F.col("_old") & ~F.col("overwrite"), 409, "annotation_exists"),
    ]
    verdict = F.struct(F.lit(202).alias("code"), F.lit(None).cast("string").alias("error"))
    for when, code, error in reversed(rules):
        verdict = F.when(when, F.struct(F.lit(code).alias("code"), F.lit(error).alias("error"))).otherwise(verdict)
    return x.withColumn("_v", verdict).select("job_id", "page_id", "_v.code", "_v.error")


def job_status(log: DataFrame, key: str, at: str | Column, state: str) -> DataFrame:
    """The last state of each job in a log of states; of equal times the greatest state."""
    last = F.max_by(F.col(state), F.struct(F.col(at) if isinstance(at, str) else at, F.col(state)))
    return log.groupBy(key).agg(last.alias(state))
