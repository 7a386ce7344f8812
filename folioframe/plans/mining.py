"""Phrase mining: tokens, n-grams, significance, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.sets import without_subgrams
from ..workspace import spread
from ..workspace import tightly as stored
from . import grams


def clauses(rows: DataFrame, page: str, text: str, token: str = r"\p{L}{2,}") -> DataFrame:
    """(page, pos, tokens): the lower-case tokens of each stretch between punctuation marks."""
    parts = spread(rows).select(page, F.posexplode(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[.,;:!?()\[\]\n]+")).alias("pos", "_c"))
    return parts.select(page, "pos", F.regexp_extract_all("_c", F.lit(token), F.lit(0)).alias("tokens")).where(F.size("tokens") > 0)


#: Words that look like numerals, and words whose -que isn't the enclitic.
NO_NUMERALS = ("vi", "di", "mi", "ci")
NO_ENCLITIC = tuple("""atque neque itaque utique usque undique denique quoque quinque cumque plerumque ubique uterque utraque utrumque namque absque
cunque unusquisque quisque quaeque quicunque quocunque peraeque susque oblique antique propinque seque torque quaque""".split())


def latin_clauses(rows: DataFrame, page: str, text: str) -> DataFrame:
    """(page, pos, surfaces, tokens): the words of each stretch between punctuation, quotes and dashes, as written and in lower case.

    Carets with their marker go, ligatures are spelt out, an enclitic -que is a word of its own; words of one letter, digits and
    Roman numerals are left out.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\^[A-Za-z0-9]{1,2}", " ")
    for letter, spelt in (("æ", "ae"), ("œ", "oe"), ("ſ", "s"), ("Æ", "Ae"), ("Œ", "Oe")):
        t = F.replace(t, F.lit(letter), F.lit(spelt))
    # Patterns go over whole texts and clauses, not word by word; within (?i) only ASCII letters have twins, as the fixed words have.
    mark, blank, letter = "[.,;:!?()\\[\\]“”\"'«»—–]", r"\p{IsWhite_Space}", "[A-Za-zÀ-ÿ]"
    edge = f"[{mark[1:-1]}{blank}]"
    t = F.regexp_replace(t, f"(?i)(?=que(?:{edge}|\\z))(?<=[^{mark[1:-1]}{blank}]{{2,4}})(?<!(?:\\A|{edge})(?:{'|'.join(w[:-3] for w in NO_ENCLITIC)}))", " ")
    roman = f"m{{0,4}}(?:cm|cd|d?c{{0,3}})(?:xc|xl|l?x{{0,3}})(?:ix|iv|v?i{{0,3}})(?!{letter})"
    word = f"(?i)(?<!{letter})(?:(?:{'|'.join(NO_NUMERALS)})(?!{letter})|(?!{roman}){letter}{{2,}})"
    # What is no letter goes from within words; the places count all clauses, so those without a word go last.
    words = lambda c: F.regexp_extract_all(F.regexp_replace(c, f"[^A-Za-zÀ-ÿ{blank}]+", ""), F.lit(word), F.lit(0))
    found = F.filter(F.transform(F.split(t, f"{mark}+"), lambda c, i: F.struct(i.alias("pos"), words(c).alias("surfaces"))), lambda c: F.size(c["surfaces"]) > 0)
    return rows.select(page, F.inline(found)).select(page, "pos", "surfaces", F.transform("surfaces", F.lower).alias("tokens"))


def surface_clauses(rows: DataFrame, page: str, text: str, token: str = r"\p{L}{2,}") -> DataFrame:
    """(page, pos, surfaces, tokens): as :func:`clauses`, with the words as written beside those in lower case."""
    parts = spread(rows).select(page, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"[.,;:!?()\[\]\n]+")).alias("pos", "_c"))
    return parts.select(page, "pos", F.regexp_extract_all("_c", F.lit(token), F.lit(0)).alias("surfaces")).where(F.size("surfaces") > 0).withColumn("tokens", F.transform("surfaces", F.lower))


def word_table(clause: DataFrame, page: str) -> DataFrame:
    """(word, count, pages)"""
    return clause.select(page, F.explode("tokens").alias("word")).groupBy("word").agg(F.count("*").alias("count"), F.countDistinct(page).alias("pages"))


def kept_phrases(clause: DataFrame, least: int = 2, most: int = 6, min_count: int = 3, found=None) -> DataFrame:
    """(phrase, n, count, pages, and example if there are surfaces) of ``grams.prepared`` clauses: frequent n-grams without those a longer one explains."""
    counted = stored(grams.frequent_grams(clause, least, most, min_count, found), "phrases")  # joined with itself below
    return without_subgrams(counted, "phrase", "count", least, most)


def phrase_table(clause: DataFrame, page: str, stopwords: list[str], least: int = 2, most: int = 6, min_count: int = 3) -> DataFrame:
    """(phrase, n, count, pages, loglik of pairs): n-grams without stopwords at their ends, without those a longer one explains; with ``example`` where the clauses have surfaces."""
    t, shown = F.col("tokens"), ["example"] if "surfaces" in clause.columns else []
    if "hashes" not in clause.columns:  # else prepared already
        clause = grams.prepared(clause, page, stopwords)
    kept = kept_phrases(clause, least, most, min_count)
    # A pair's marginals are how often its words have a right or a left neighbour.
    words = clause.select(F.size(t).alias("_n"), F.posexplode(t).alias("_i", "_w")).groupBy("_w").agg(F.count_if(F.col("_i") < F.col("_n") - 1).alias("row"), F.count_if(F.col("_i") > 0).alias("col"), F.count("*").alias("seen"))
    words = stored(words, "phrase-words")
    total = words.agg(F.sum("seen").alias("total"))
    two = kept.where("n = 2").withColumns({"_a": F.split("phrase", " ")[0], "_b": F.split("phrase", " ")[1]})
    two = two.join(words.select(F.col("_w").alias("_a"), "row"), "_a").join(words.select(F.col("_w").alias("_b"), "col"), "_b").join(F.broadcast(total))  # one row
    scored = two.select("phrase", F.round(T.log_likelihood(F.col("count"), F.col("row"), F.col("col"), F.col("total")), 2).alias("loglik"))
    return kept.join(scored, "phrase", "left").select("phrase", "n", "count", "pages", "loglik", *shown)


def ranked(phrases: DataFrame) -> DataFrame:
    return phrases.orderBy(F.coalesce("loglik", F.lit(0.0)).desc(), F.col("count").desc(), F.col("n").desc(), "phrase")


def loose_key(phrase: Column, endings: str = "ibus|orum|arum|ium|que|ing|ed|es|us|um|is|ae|am|as|os|em|s|a|o|i|e") -> Column:
    """Words without a common ending, to set like phrases side by side; words keep three letters at least."""
    return F.array_join(F.transform(F.split(phrase, " "), lambda w: F.regexp_replace(w, f"(?<=^.{{3,30}})(?:{endings})$", "")), " ")


def noun_evidence(tokens: DataFrame, word: str, surface: str, pos: str, least: int = 2, share: float = 0.6) -> DataFrame:
    """Words that are capitalised, where they don't begin a clause, at least ``share`` of at least ``least`` times."""
    inner = F.col(pos) > 0
    upper = inner & F.col(surface).rlike(r"^\p{Lu}")
    out = tokens.groupBy(word).agg(F.count_if(inner).alias("seen"), F.count_if(upper).alias("capital"))
    return out.where((F.col("seen") >= least) & (F.col("capital") >= share * F.col("seen")))


def page_metrics(rows: DataFrame, key: list[str], text: str, stems: str = "[0-9]+") -> DataFrame:
    """Characters, words, hits of a pattern and per thousand characters, and up to six different hits."""
    t = F.coalesce(text, F.lit(""))
    hits = F.regexp_extract_all(t, F.lit(stems), F.lit(0))
    return rows.select(*key, F.length(t).alias("chars"), F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"), F.size(hits).alias("hits"), F.coalesce(F.try_divide(1000.0 * F.size(hits), F.length(t)), F.lit(0.0)).alias("hits_per_kchar"), F.array_join(F.slice(F.array_distinct(hits), 1, 6), "|").alias("samples"))
