"""Column functions over scanned pages: OCR repairs, inline markers, headings, headers, footnotes, sentences, token folding."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..workspace import in_pieces
from . import records as R
from . import text as T

#: OCR readings of ae and their repairs, in order.
AE_REPAIRS = [(r"\b([Pp])rzedix", "$1raedix"), (r"\b([Pp])rz", "$1rae"), (r"\b([Pp])redic", "$1raedic"), (r"\b([Pp])refulg", "$1raefulg"), (r"\b([Pp])racept", "$1raecept"), (r"\b([Qq])use\b", "$1uae"), (r"\b([Zz])tern", "aetern"), (r"terr[eé]\b", "terrae"), ("praeedix", "praedix")]
#: Readings of open-C numerals.
OPEN_C = [(r"\b(?:CID|C1D)\b", "CIƆ"), (r"\b(?:I2C|I2G)\b", "IƆC")]
#: Abbreviations after which a sentence goes on.
ABBREVIATIONS = "st mr mrs dr revd rev cap lib vol ch chap viz cf vid no eccl hist specul i.e e.g a.d b.c".split()
#: Ordinals of headings, Latin in the spellings of the prints.
HEADING_ORDINALS = {
    "PRIMVM": 1, "PRIMUM": 1, "PRIMA": 1, "PRIMUS": 1,
    "SECVNDVM": 2, "SECUNDVM": 2, "SECUNDUM": 2, "SECUNDA": 2,
    "TERTIVM": 3, "TERTIUM": 3, "TERTIA": 3,
    "QVARTVM": 4, "QUARTVM": 4, "QUARTUM": 4, "QUARTA": 4,
    "QVINTVM": 5, "QUINTVM": 5, "QUINTUM": 5, "QUINTA": 5,
    "SEXTVM": 6, "SEXTUM": 6, "SEXTA": 6,
    "SEPTIMVM": 7, "SEPTIMUM": 7,
    "OCTAVVM": 8, "OCTAVUM": 8,
    "NONVM": 9, "NONUM": 9,
    "DECIMVM": 10, "DECIMUM": 10,
}
ENGLISH_ORDINALS = {"FIRST": 1, "SECOND": 2, "THIRD": 3, "FOURTH": 4, "FIFTH": 5, "SIXTH": 6, "SEVENTH": 7, "EIGHTH": 8, "NINTH": 9, "TENTH": 10}
SCRIPTURE = r"^((?:[123])?\s?[A-Z][a-z]{1,7}\.?)\s+([0-9]+)(?:[.,:]\s*([0-9]+(?:[-–][0-9]+)?))?"
INLINE = r"\^([A-Za-z0-9*†‡§])"


def _chain(c: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, with_ in rules:
        c = F.regexp_replace(c, f"(?U){pattern}", with_)
    return c


def normalize_ae(c: Column) -> Column:
    return _chain(c, AE_REPAIRS)


def normalize_open_c(c: Column) -> Column:
    return _chain(c, OPEN_C)


def inline_markers(c: Column) -> Column:
    """(text, markers): the text without ``^X``, and (symbol, offset) of each in the cleaned text."""
    parts, symbols = F.split(c, INLINE, -1), F.regexp_extract_all(c, F.lit(INLINE), F.lit(1))
    step = lambda a, x: F.struct((a["at"] + F.length(x["p"])).alias("at"), F.concat(a["out"], F.array(F.struct(x["s"].alias("symbol"), (a["at"] + F.length(x["p"])).alias("offset")))).alias("out"))
    pairs = F.arrays_zip(F.slice(parts, F.lit(1), F.size(symbols)).alias("p"), symbols.alias("s"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<symbol:string,offset:int>>").alias("out"))
    return F.struct(F.array_join(parts, "").alias("text"), F.aggregate(F.transform(pairs, lambda x: F.struct(x["p"].alias("p"), x["s"].alias("s"))), start, step, lambda a: a["out"]).alias("markers"))


#: How a note at the foot of a page begins, signs that scanners leave, most characters of a line of them, and most digits of a page number.
NOTE_BEGINS = r"^[a-z]\s+[A-Z“”\"'(]"
STRAY_SIGNS, STRAY_MOST, PAGE_DIGITS = "\"“”<>'‘’", 3, 3


def _kind(line: Column) -> Column:
    """What a line without blanks at its ends is."""
    size = F.length(line)
    return (
        F.when(size == 0, "blank")
        .when((size <= PAGE_DIGITS) & (F.translate(line, "0123456789", "") == ""), "number")
        .when((size <= STRAY_MOST) & (F.translate(line, STRAY_SIGNS, "") == ""), "stray")
        .when(line.rlike(NOTE_BEGINS), "note")
        .otherwise("text")
    )


def _up_to_last_other(lines: Column, kind: str) -> Column:
    """Lines without those of the kind that stand together at the end."""
    places = F.transform(lines, lambda x, i: F.when(x["kind"] != kind, i + 1))
    return F.slice(lines, F.lit(1), F.coalesce(F.array_max(places), F.lit(0)))


def stitch_pages(pages: Column) -> Column:
    """Array of page texts -> one text on one line.

    At the foot of a page its number goes, then the notes above it; lines of stray signs go anywhere. A word that a hyphen parts at
    the end of a line is fused, and no blank stands before punctuation.
    """
    edge = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    classed = lambda p: F.filter(F.transform(F.split(p, r"\r?\n"), lambda x: F.struct(_kind(edge(x)).alias("kind"), F.regexp_replace(x, r"\s+$", "").alias("line"))), lambda x: x["kind"] != "blank")
    body = lambda p: F.filter(_up_to_last_other(_up_to_last_other(classed(p), "number"), "note"), lambda x: x["kind"] != "stray")
    lines = F.transform(F.flatten(F.transform(pages, body)), lambda x: x["line"])
    fused = F.regexp_replace(F.array_join(lines, "\n"), r"(?U)(?<=\w)-\s*\n\s*(?=\w)", "")
    return edge(F.regexp_replace(F.regexp_replace(fused, r"\s*\n\s*|\s{2,}", " "), r"\s+(?=[,.;:!?])", ""))


#: Where a text stands after an abbreviation and its marks, as a condition on what precedes.
_AFTER_ABBREVIATION = r"(?<![\w.])\.{0,9}(?:" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r")[.!?]{1,9}"


def split_sentences(c: Column) -> Column:
    """Sentences of a text: they end at . ! ? before white space, or at such a mark in a closing quote, but not after an abbreviation, behind which white space becomes a blank."""
    # What stands before is looked at only where white space follows a mark. A cut takes all its white space, so the text's own ends alone are trimmed.
    joined = F.regexp_replace(c, rf"(?iU)(?=\s)(?<=[.!?])(?<={_AFTER_ABBREVIATION})\s+", " ")
    trimmed = F.regexp_replace(joined, r"(?U)\A\s+|(?<!\s)\s+\z", "")
    parts = F.split(trimmed, rf"(?iU)(?=\s)(?:(?<=[.!?][\"'”’])|(?<=[.!?])(?<!{_AFTER_ABBREVIATION}))\s+")
    return F.filter(parts, lambda x: x != "")


#: Letters that are spelt out.
SPELT = str.maketrans({"ſ": "s", "æ": "ae", "Æ": "Ae", "œ": "oe", "Œ": "Oe", "&": " and "})


def folded(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits after compatibility decomposition without marks; ſ, ae, oe and & are spelt out."""
    import re
    import unicodedata

    # NFKD is not among Spark's functions; ASCII needs none.
    plain = (text or "").translate(SPELT)
    if not plain.isascii():
        plain = "".join(c for c in unicodedata.normalize("NFKD", plain) if unicodedata.category(c)[0] != "M")
    return re.findall(r"[^\W_]+", plain.lower())


@F.pandas_udf(ArrayType(StringType()))
def fold_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """:func:`folded` as a column function."""
    for s in texts:
        for part in in_pieces(s):
            yield part.map(folded)


@F.pandas_udf(StringType())
def strip_accents(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text without combining marks, after canonical decomposition."""
    import unicodedata

    def bare(t: str | None) -> str | None:
        return t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))

    for s in texts:
        for part in in_pieces(s):
            yield part.map(bare)


def classify_marginal(c: Column) -> Column:
    """(kind, citation): scripture with "Book c:v", or unknown."""
    t = F.trim(c)
    part = lambda i: F.trim(F.regexp_extract(t, SCRIPTURE, i))
    hit = t.rlike(SCRIPTURE)
    verse = F.when(part(3) != "", F.concat(F.lit(":"), part(3))).otherwise("")
    return F.struct(F.when(hit, "scripture").otherwise("unknown").alias("kind"), F.when(hit, F.concat(part(1), F.lit(" "), part(2), verse)).otherwise("").alias("citation"))


def _ordinal(word: Column, table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.upper(word)]


def detect_chapter(c: Column, english: Column) -> Column:
    latin = F.regexp_extract(c, r"(?iU)\bCAP[VU]T\s+(\w+)\b", 1)
    return F.when(english, T.roman_to_int_strict(F.regexp_extract(c, r"(?iU)\bCHAPTER\s+([IVXLCDM]+)\b", 1))).otherwise(F.coalesce(_ordinal(latin, HEADING_ORDINALS), T.roman_to_int_strict(latin)))


def detect_controversy(c: Column, english: Column) -> Column:
    return F.when(english, _ordinal(F.regexp_extract(c, r"(?iU)\bTHE\s+(\w+)\s+CONTROVERSY\b", 1), ENGLISH_ORDINALS)).otherwise(_ordinal(F.regexp_extract(c, r"(?iU)\bCONTROVERSIA\s+(\w+)\b", 1), HEADING_ORDINALS))


def header_meta(lines: Column, page: Column) -> dict[str, Column]:
    """Whether the header lines hold the page's number (as a substring) and a chapter, on which side, and whether that fits the parity.

    The first line of several is left, the last right; odd pages are expected right.
    """
    side = lambda i: F.when(F.size(lines) < 2, "").when(i == 0, "left").when(i == F.size(lines) - 1, "right").otherwise("")
    marked = lambda test: F.filter(F.transform(lines, lambda x, i: F.when(test(x), side(i))), lambda x: x.isNotNull())
    number, chapter = marked(lambda x: F.contains(x, page.cast("string"))), marked(lambda x: x.rlike(r"(?i)\bCAP\.?\s*[IVXLCDM]+\.?(?![A-Za-z])"))
    expected = F.when(page % 2 == 0, "left").otherwise("right")
    first = lambda s: F.coalesce(F.try_element_at(F.filter(s, lambda x: x != ""), F.lit(1)), F.lit(""))
    has = F.size(number) > 0
    page_side = F.when(has & (first(number) == ""), expected).otherwise(first(number))
    return {"has_page": has, "has_chapter": F.size(chapter) > 0, "page_side": page_side, "chapter_side": first(chapter), "parity_ok": has & (page_side == expected)}


def clean_note_marks(c: Column) -> Column:
    """``[x]`` becomes ``[fn-x]``."""
    return F.trim(F.regexp_replace(c, r"\[([A-Za-z0-9]+)\]\??", "[fn-$1]"))


#: Signs that mark notes besides digits, and most capitals of a marker.
NOTE_SIGNS, NOTE_CAPITALS = "?*!†‡", 3


def _is_marker(word: Column) -> Column:
    """A small letter alone; or signs and digits, or some capitals, with a bracket before and a bracket or dot after at most."""
    core = F.regexp_replace(word, r"^[\[(](?=.)|(?<=.)[\]).]$", "")
    capitals = core.rlike(f"^[A-Z]{{1,{NOTE_CAPITALS}}}$")
    return word.rlike("^[a-z]$") | capitals | ((core != "") & (F.regexp_replace(F.translate(core, NOTE_SIGNS, ""), r"(?U)\d+", "") == ""))


def relabel_notes(c: Column) -> Column:
    """Marker-led lines as numbered entries ``[fnNN|marker] text``; other lines continue the entry before them, or an entry ``?`` at the beginning."""
    bare = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\r?\n"), bare), lambda x: x != "")

    def parsed(line: Column) -> Column:
        parts = F.split(line, r"(?U)\s+", 2)
        leads = (F.size(parts) == 2) & _is_marker(parts[0])
        return F.struct(leads.alias("leads"), F.when(leads, parts[0]).otherwise("?").alias("marker"), F.when(leads, F.get(parts, F.lit(1))).otherwise(line).alias("text"))

    # Entries begin where a line leads, and at the first line; each takes the lines up to the next beginning.
    read = F.transform(lines, parsed)
    begins = F.filter(F.transform(read, lambda x, i: F.when(x["leads"] | (i == 0), i)), lambda i: i.isNotNull())
    upto = F.concat(F.slice(begins, F.lit(2), F.greatest(F.size(begins) - 1, F.lit(0))), F.array(F.size(read)))
    entry = lambda b, k: F.format_string("[fn%02d|%s] %s", k + 1, F.get(read, b)["marker"], F.array_join(F.transform(F.slice(read, b + 1, F.get(upto, k) - b), lambda x: x["text"]), " "))
    return F.when(F.size(lines) == 0, "").otherwise(F.array_join(F.transform(begins, entry), "\n"))


def target_flags(c: Column) -> dict[str, Column]:
    return {"has_ae": c.rlike("ae|AE|Æ|æ"), "has_marker": c.rlike(r"\[[^\]]+\]|^[?*!†‡]\s|\bfn[0-9]+\b")}


def page_status(lines: Column) -> Column:
    """Text of array<struct<text_gold, text_ocr_original>> lines, one below the other."""
    return F.array_join(F.transform(lines, lambda x: R.coalesce_text(x["text_gold"], x["text_ocr_original"])), "\n")
