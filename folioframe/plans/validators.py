"""Validators of translated segments: each returns findings with flag, severity, excerpts and details.

Segments have segment_id, page_id, seq, latin (text), english (latest text). Neighbours are those of the same page number and kind
(body or footnote), by order key; a page is a small group, so the windows stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import text as T
from ..functions.pages import strip_accents
from ..operators.windows import neighbour_set, neighbour_text

GROUP, ORDER = ["page_num", "kind"], ["ord", "segment_id"]


def prepared(segments: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Segments with page_num, kind and ord; those without Latin text are left out."""
    x = segments.withColumns({"page_num": R.page_number(F.col("page_id"), F.col("segment_id")), "kind": F.when(F.col("segment_id").contains("_fn_"), "fn").otherwise("body"), "ord": R.order_key(F.col("seq"), F.col("segment_id"))})
    return x.where(R.in_range(F.col("page_num"), low, high) & ~R.blank(F.col("latin")))


def _finding(rows: DataFrame, flag: Column, severity: Column, **details: Column) -> DataFrame:
    english = T.excerpt(F.coalesce("english", F.lit("")))
    return rows.select("segment_id", "page_id", flag.alias("flag"), severity.alias("severity"), *[c.alias(k) for k, c in details.items()], T.excerpt(F.col("latin")).alias("latin"), F.when(english == "", "(empty)").otherwise(english).alias("english"))


def numerals(segments: DataFrame, window: int = 1) -> DataFrame:
    """Latin numerals whose value isn't in the neighbours' English, unless the token stands there itself; one finding per value and token."""
    x = segments.withColumn("_en", neighbour_text(F.trim("english"), GROUP, ORDER, window)).withColumn("_values", T.english_numerals(F.col("_en")))
    x = x.withColumn("_n", F.explode(T.latin_numerals(F.col("latin")))).where(~F.array_contains("_values", F.col("_n.value")))
    there = F.rlike(F.col("_en"), F.concat(F.lit(r"(?U)\b\Q"), F.col("_n.token"), F.lit(r"\E\b")))
    x = x.where(~there).withColumn("_key", F.lower("_n.token")).withColumn("_value", F.col("_n.value")).dropDuplicates(["segment_id", "_value", "_key"])
    return _finding(x, F.lit("MISSING_NUMERAL"), F.lit("high"), latin_value=F.col("_n.value"), latin_token=F.lower("_n.token"))


#: Keywords of citations and what may stand for them in English.
CITATION_KEYWORDS = {
    "lib": r"\bbooks?\b|\bbk\.|\bvolumes?\b", "cap": r"\bchapters?\b|\bchap\.|\bchaps?\.|\d+\s*:\s*\d+", "ver": r"\bverses?\b|\blines?\b|\bv\.|\d+\s*:\s*\d+", "pag": r"\bpages?\b|\bpp?\.", "tom": r"\bvolumes?\b|\bvol\.|\btomes?\b",
    "edit": r"\beditions?\b|\bed\.", "epigram": r"\bepigrams?\b", "epist": r"\bepistles?\b|\bletters?\b|\bep\.", "part": r"\bparts?\b|\bsections?\b|\bsect\.", "op": r"\bworks\b|\bopera\b|\bop\.",
}
PROEM = (r"\bpro[œoe]+mi[oa]\b", r"\bproems?\b|\bprooemium\b|\bpreface\b|\bintroductions?\b")
#: Stems of biblical books and what stands for them in English.
BOOKS = {
    "matth": r"\bmatthew\b", "marc": r"\bmark\b", "luc": r"\bluke\b", "joh": r"\bjohn\b", "joan": r"\bjohn\b", "act": r"\bacts?\b", "rom": r"\bromans\b", "cor": r"\bcorinthians?\b", "gal": r"\bgalatians?\b",
    "ephes": r"\bephesians?\b", "phil": r"\bphilippians?\b", "coloss": r"\bcolossians?\b", "colos": r"\bcolossians?\b", "thess": r"\bthessalonians?\b", "tim": r"\btimothy\b", "tit": r"\btitus\b",
    "philem": r"\bphilemon\b", "hebr": r"\bhebrews?\b", "jac": r"\bjames\b", "pet": r"\bpeter\b", "apoc": r"\b(?:revelation|apocalypse)\b", "apocal": r"\b(?:revelation|apocalypse)\b", "esai": r"\bisaiah\b",
    "esa": r"\bisaiah\b", "isai": r"\bisaiah\b", "jer": r"\bjeremiah\b", "ezech": r"\bezekiel\b", "dan": r"\bdaniel\b", "psal": r"\bpsalms?\b", "prov": r"\bproverbs\b", "eccl": r"\becclesiastes\b",
    "cant": r"\b(?:song of songs|canticles?)\b", "gen": r"\bgenesis\b", "exod": r"\bexodus\b", "levit": r"\bleviticus\b", "num": r"\bnumbers\b", "deut": r"\bdeuteronomy\b", "jos": r"\bjoshua\b", "jud": r"\bjudges\b",
}
#: Fixed value: what follows a book in a real citation, within 15 characters.
BOOK_CONTEXT = r".{0,15}?(?:\bcap\b\.|\d+\s*\.\s*ver\b\.|\d+\s*:\s*\d+)"


def citation_rules(spark: SparkSession) -> DataFrame:
    """The rules as a table: rule, kind, latin and english patterns, flag, severity. A book must be cited at its first place."""
    rows = [(k + ".", "keyword", rf"(?iU)\b{k}\b\.", f"(?iU){en}", "CITATION_KEYWORD_DROPPED", "medium") for k, en in CITATION_KEYWORDS.items()]
    rows.append(("proœmio", "keyword", f"(?iU){PROEM[0]}", f"(?iU){PROEM[1]}", "CITATION_KEYWORD_DROPPED", "medium"))
    rows += [(k.capitalize() + ".", "book", rf"(?isU)^(?:(?!\b{k}\b\.).)*\b{k}\b\.{BOOK_CONTEXT}", f"(?iU){en}", "BIBLICAL_BOOK_DROPPED", "high") for k, en in BOOKS.items()]
    return spark.createDataFrame(rows, "rule string, rule_kind string, lat string, en string, flag string, severity string")


def citations(segments: DataFrame, rules: DataFrame, window: int = 1) -> DataFrame:
    """Citation words of the Latin without a counterpart in the neighbours' English."""
    from ..operators.joins import matching_rules

    x = segments.withColumn("_en", neighbour_text(F.trim("english"), GROUP, ORDER, window))
    hit = matching_rules(x, "latin", rules, "lat").where(~F.rlike("_en", "en"))
    return _finding(hit, F.col("flag"), F.col("severity"), rule=F.col("rule"))


def markers(segments: DataFrame, window: int = 1) -> DataFrame:
    """Markers of a body line's Latin missing in the neighbours' English, English ones nobody has, and repeated ones.

    The Latin's are those of the structured column ``markers`` (structs with marker_id, a letter each) where it is there and has some,
    otherwise ``^x`` in the text.
    """
    ids = lambda c: F.regexp_extract_all(c, F.lit(r"(?U)\^([a-z])\b"), F.lit(1))
    latin = ids(F.col("latin"))
    if "markers" in segments.columns:
        given = F.filter(F.transform(F.coalesce(F.col("markers"), F.array()), lambda m: F.lower(m["marker_id"])), lambda m: F.coalesce(m.rlike(r"^\p{L}$"), F.lit(False)))
        latin = F.when(F.size(given) > 0, given).otherwise(latin)
    x = segments.where("kind = 'body'").withColumns({"_lat": latin, "_own": ids(F.coalesce("english", F.lit("")))})
    x = x.withColumns({"_near_lat": neighbour_set(F.col("_lat"), ["page_num"], ORDER, window), "_near_en": neighbour_set(F.col("_own"), ["page_num"], ORDER, window)})
    row = lambda flag, severity: lambda m: F.struct(F.lit(flag).alias("flag"), F.lit(severity).alias("severity"), m.alias("marker_id"))
    dropped = F.transform(F.filter("_lat", lambda m: ~F.array_contains("_near_en", m)), row("MARKER_DROPPED", "high"))
    invented = F.transform(F.filter(F.array_distinct("_own"), lambda m: ~F.array_contains("_near_lat", m)), row("MARKER_HALLUCINATED", "high"))
    twice = F.transform(F.filter(F.array_distinct("_own"), lambda m: F.size(F.filter("_own", lambda y: y == m)) > 1), row("MARKER_DUPLICATED", "medium"))
    x = x.withColumn("_f", F.explode(F.concat(dropped, invented, twice)))
    return _finding(x, F.col("_f.flag"), F.col("_f.severity"), marker_id=F.col("_f.marker_id"))


def trivial(segments: DataFrame) -> DataFrame:
    """English that is empty, punctuation, Greek, or the Latin itself; the first that holds."""
    x = segments.withColumn("_flag", T.script_kind(F.coalesce("english", F.lit("")), F.col("latin"))).where("_flag is not null")
    return _finding(x, F.col("_flag"), F.lit("high"))


#: Fixed value: Latin words after Greek that say it again in Latin.
PARAPHRASE_CUE = r"(?iU)\b(?:hoc\s+est|id\s+est|nempe|videlicet|scilicet|vel|seu|sive|h\.\s*e\.|i\.\s*e\.|viz\.|sc\.)\b"
#: Characters after the Greek in which a cue counts, and Latin letters that make a line mixed prose.
CUE_REACH, MIXED_LETTERS = 30, 4


def greek(segments: DataFrame, window: int = 1, gloss_window: int = 5, glosses: bool = False) -> DataFrame:
    """Greek spans of the Latin that the neighbours' English lacks, accents aside; with ``glosses``, on lines that also hold Latin, spans
    that no Latin cue follows and after which no ``[`` opens in the English near by.
    """
    x = segments.withColumn("_spans", T.greek_spans(F.col("latin")))
    # Accents go letter by letter: each English is folded once, before it becomes its neighbours', and a line's spans as one text.
    x = x.withColumns({"_bare": strip_accents(F.coalesce("english", F.lit(""))), "_plains": F.split(strip_accents(F.array_join("_spans", "\n")), "\n")})
    near, far = (neighbour_text(F.col("_bare"), GROUP, ORDER, reach) for reach in (window, gloss_window))
    x = x.withColumns({"_en": near, "_far": far}).where(F.size("_spans") > 0)
    # Spans stand in order, so the tail of each is what follows it in the rest of the line.
    empty = F.array().cast("array<struct<span:string,plain:string,tail:string>>")
    rest = lambda text, span: F.substring(text, F.instr(text, span) + F.length(span), F.length(text))
    step = lambda a, s: F.struct(rest(a["left"], s["_spans"]).alias("left"), F.concat(a["out"], F.array(F.struct(s["_spans"].alias("span"), s["_plains"].alias("plain"), F.left(rest(a["left"], s["_spans"]), F.lit(CUE_REACH)).alias("tail")))).alias("out"))
    x = x.withColumn("_s", F.explode(F.aggregate(F.arrays_zip("_spans", "_plains"), F.struct(F.col("latin").alias("left"), empty.alias("out")), step, lambda a: a["out"])))
    x = x.withColumn("_plain", F.col("_s.plain"))
    at = F.instr("_far", F.col("_plain"))
    glossed = (at > 0) & (F.instr(F.substring("_far", at + F.length("_plain"), F.length("_far")), F.lit("[")) > 0)
    dropped = ~F.col("_en").contains(F.col("_plain"))
    mixed = T.alpha_breakdown(F.col("latin"))["latin"] >= MIXED_LETTERS
    bare = F.lit(glosses) & ~dropped & mixed & ~F.col("_s.tail").rlike(PARAPHRASE_CUE) & ~glossed
    flag = F.when(dropped, "GREEK_DROPPED").when(bare, "BRACKET_GLOSS_MISSING")
    x = x.withColumn("_flag", flag).where("_flag is not null")
    letters = F.regexp_count("_s.span", F.lit(T.GREEK)).cast("long")
    return _finding(x, F.col("_flag"), F.when(F.col("_flag") == "GREEK_DROPPED", "high").otherwise("info"), span=F.col("_s.span"), letters=letters)


#: Words of an older register.
ARCHAISMS = "thee thou thy thine ye hath doth dost saith shalt wilt cometh goeth whosoever verily thereof unto"


def _hits(segments: DataFrame, terms: DataFrame, window: int) -> DataFrame:
    """Segments with the terms of their Latin: ``_en`` (neighbours' English), ``_bad`` (first banned rendering), ``_good`` (approved ones)."""
    from ..operators.joins import matching_rules

    near = T.strip_carets(neighbour_text(F.coalesce("english", F.lit("")), GROUP, ORDER, window))
    x = matching_rules(segments.withColumns({"_en": near, "_la": T.strip_carets(F.col("latin"))}), "_la", terms, "matcher")
    word = lambda v: F.rlike("_en", F.concat(F.lit(r"(?iU)\b\Q"), v, F.lit(r"\E\b")))
    return x.withColumns({"_bad": F.get(F.filter("banned", word), F.lit(0)), "_good": F.filter("approved", word)})


def glossary(segments: DataFrame, terms: DataFrame, window: int = 1) -> DataFrame:
    """Findings of terms (term, matcher, approved, banned, and maybe category) that a segment's Latin holds, and of older diction.

    BANNED, or SCRIPTURE_SUBSTITUTION for the category scripture: the first banned rendering in the neighbours' English, which is the excerpt.
    MISSING_APPROVED: neither a banned nor an approved rendering there, of a term that has approved ones. ARCHAISM: words of an
    older register in a body segment's own English. DRIFT: a term with several approved renderings, no segment, the number of segments
    of each. Carets are no text on either side.
    """
    x = _hits(segments, terms, window)
    found = lambda rows, flag, severity, detail: _finding(rows, flag, F.lit(severity), term=F.col("term"), detail=detail)
    kind = F.when(F.col("category") == "scripture", "SCRIPTURE_SUBSTITUTION").otherwise("BANNED") if "category" in terms.columns else F.lit("BANNED")
    banned = found(x.where("_bad is not null").withColumn("english", F.col("_en")), kind, "high", F.col("_bad"))
    missing = found(x.where((F.size("_good") == 0) & F.col("_bad").isNull() & (F.size("approved") > 0)), F.lit("MISSING_APPROVED"), "medium", F.array_join("approved", "|"))
    older = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(T.strip_carets(F.coalesce("english", F.lit(""))), F.lit(rf"(?iU)\b(?:{'|'.join(ARCHAISMS.split())})\b"), F.lit(0)), F.lower)))
    body = segments.where("kind = 'body'").withColumns({"_old": older, "term": F.lit("(archaic register)")}).where(F.size("_old") > 0)
    archaic = found(body, F.lit("ARCHAISM"), "medium", F.array_join("_old", "|"))
    drift = glossary_drift(segments, terms, window)
    uses = F.array_join(F.transform(F.array_sort(F.map_keys("uses")), lambda k: F.concat(k, F.lit("="), F.element_at(F.col("uses"), k).cast("string"))), "|")
    blank = F.lit("")
    drifting = drift.select(blank.alias("segment_id"), blank.alias("page_id"), F.lit("DRIFT").alias("flag"), F.lit("info").alias("severity"), "term", uses.alias("detail"), blank.alias("latin"), blank.alias("english"))
    return banned.unionByName(missing).unionByName(archaic).unionByName(drifting)


def glossary_drift(segments: DataFrame, terms: DataFrame, window: int = 1) -> DataFrame:
    """Terms rendered by more than one approved variant near their segments, with the segments of each."""
    from ..operators.aggregates import variant_drift

    return variant_drift(_hits(segments, terms, window).withColumn("variant", F.explode("_good")), "term", "variant", "segment_id")


def marker_parity(body: Column, notes: Column) -> dict[str, Column]:
    """Markers of the body without a note, notes without a marker, clusters, and replacement characters."""
    return {"without_note": F.array_except(body, notes), "without_marker": F.array_except(notes, body)}


def trailing_cluster(english: Column) -> Column:
    """Whether a text ends in two markers or more side by side."""
    return F.coalesce(english.rlike(r"(?:\^[A-Za-z]{1,2}){2,}\s*$"), F.lit(False))


def repair_inputs(findings: DataFrame, segments: DataFrame, kinds: list[str]) -> DataFrame:
    """Findings of the kinds as repair inputs: a segment's flags joined, floor score 1."""
    f = findings.where(F.col("flag").isin(*kinds)).groupBy("segment_id").agg(F.array_join(F.array_sort(F.collect_set("flag")), "; ").alias("reason"), F.count("*").alias("findings"))
    return f.join(segments.select("segment_id", "latin", "english"), "segment_id").withColumn("floor_score", F.lit(1))


def pattern_findings(rows: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """(key, rule, match) of every match of each named pattern."""
    named = lambda n: lambda m: F.struct(F.lit(n).alias("rule"), m.alias("match"))
    each = [F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(0)), named(n)) for n, p in patterns.items()]
    return rows.select(key, F.explode(F.concat(*each)).alias("x")).select(key, "x.*")
