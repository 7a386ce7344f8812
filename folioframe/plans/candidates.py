"""Review lists: recurring names and terms of a corpus, an entry a concept, and the inert glossary rows that they may become.

Words show by their capitals inside clauses whether they are names; a phrase is a name if all its words are. Names, to which single
words that are names are added, and terms are clustered and ranked apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import tightly as stored
from . import grams, mining

#: Capitalised abbreviations of citations, which are no names.
ABBREVIATIONS = "ms mss jo io st cap lib pag tom ib ibid vid edit epist hist chron cod fol num seq ann".split()
#: Endings that inflect, taken off one after the other.
ENDINGS = ["ibus|arum|orum|erum|ium", "que", "is|es|em|um|us|as|os|ae|am|i|o|a|e|m|s"]


def inflection_key(phrase: Column) -> Column:
    """A phrase's words without their inflection, roughly, so that forms of one concept share it; a word may lose all of itself."""

    def bare(w: Column) -> Column:
        for e in ENDINGS:
            w = F.regexp_replace(w, f"(?:{e})$", "")
        return w

    return F.array_join(F.transform(F.split(phrase, " "), bare), " ")


def judged(phrases: DataFrame, names: DataFrame) -> DataFrame:
    """Phrases with ``proper``, whether all their words are among the ``names``' words; ``maybe`` by a filter first, so that few are joined."""
    admits = grams.filter_of(names.select(F.xxhash64("word").alias("h")))
    if admits is None:
        return phrases.withColumn("proper", F.lit(False))
    shared = phrases.sparkSession.sparkContext.broadcast(admits)

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(b.num_columns - 1)
            good = np.r_[0, np.cumsum(shared.value(h.flatten().to_numpy().view(np.uint64)))]
            ends = np.r_[0, np.cumsum(pc.list_value_length(h).to_numpy())]
            maybe = good[ends[1:]] - good[ends[:-1]] == np.diff(ends)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(maybe)], names=[*b.schema.names[:-1], "maybe"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)
    x = stored(phrases.withColumn("_h", F.transform(F.split("phrase", " "), lambda w: F.xxhash64(w))).mapInArrow(sifted, f"{kinds}, maybe boolean"), "candidate-phrases")
    each = x.where("maybe").select("phrase", F.explode(F.split("phrase", " ")).alias("word")).join(names.select("word", F.lit(True).alias("one")), "word", "left")
    proper = each.groupBy("phrase").agg(F.bool_and(F.coalesce("one", F.lit(False))).alias("proper"))
    return x.where("maybe").join(proper, "phrase").drop("maybe").unionByName(x.where("not maybe").withColumn("proper", F.lit(False)).drop("maybe"))


def clustered(rows: DataFrame) -> DataFrame:
    """(term, variants, total, pages) for rows (phrase, count, pages): the most frequent form stands for its concept, ties to the smaller one."""
    order = F.struct((-F.col("count")).alias("o"), "phrase")
    x = rows.groupBy(inflection_key(F.col("phrase")).alias("_key")).agg(F.array_sort(F.collect_list(order)).alias("m"), F.sum("count").alias("total"), F.max("pages").alias("pages"))
    return x.select(F.col("m")[0]["phrase"].alias("term"), F.transform("m", lambda v: v["phrase"]).alias("variants"), "total", "pages")


def review_candidates(clause: DataFrame, page: str, stopwords: list[str], min_count: int = 3, min_pages: int = 3, top_terms: int = 70, top_names: int = 60, abbreviations: list[str] = ABBREVIATIONS) -> DataFrame:
    """(category, rank, term, variants, total, pages, example) of the ``top_names`` names and ``top_terms`` terms that lie on ``min_pages`` pages.

    ``clause`` is (page, pos, surfaces, tokens). A concept's pages are those of its most widespread form. Rank is by total, then term.
    """
    clause = grams.prepared(clause, page, stopwords)
    found = grams.levels(clause, min_count=min_count)
    # A word is a name if inside clauses it is seen twice, in three of five such places with a capital.
    seen = stored(grams.frequent_words(clause, min_count, found).where((F.col("inner") >= 2) & (F.col("capital") >= 0.6 * F.col("inner"))), "candidate-names")
    phrases = judged(mining.kept_phrases(clause.drop("surfaces"), min_count=min_count, found=found).select("phrase", "count", "pages"), seen)
    single = seen.where((F.length("word") > 2) & ~F.col("word").isin(*abbreviations, *stopwords))
    names = phrases.where("proper").drop("proper").unionByName(single.select(F.col("word").alias("phrase"), "count", "pages"))

    def best(rows: DataFrame, category: str, most: int) -> DataFrame:
        top = clustered(rows).where(F.col("pages") >= min_pages).orderBy(F.desc("total"), "term").limit(most)
        packed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("o"), "term", "variants", "total", "pages"))).alias("all"))  # ``most`` rows
        return packed.select(F.lit(category).alias("category"), F.posexplode("all").alias("i", "c")).select("category", (F.col("i") + 1).alias("rank"), *[f"c.{k}" for k in ("term", "variants", "total", "pages")])

    top = stored(best(names, "proper_name", top_names).unionByName(best(phrases.where("not proper").drop("proper"), "term", top_terms)), "candidates")
    # How they are written is looked up for these few alone, so that no other phrase carries it along; a single word stands as it is.
    examples = grams.first_examples(clause, top.where(F.contains("term", F.lit(" "))).select(F.col("term").alias("phrase")))
    return top.join(examples.withColumnRenamed("phrase", "term"), "term", "left").select("category", "rank", "term", "variants", "total", "pages", F.coalesce("example", "term").alias("example"))


def glossary_seed(candidates: DataFrame) -> DataFrame:
    """Candidates as glossary rows that no validator acts on: nothing approved or banned, to be reviewed."""
    note = F.concat(F.lit("[REVIEW] variants: "), F.array_join("variants", ", "), F.lit("; "), F.col("total").cast("string"), F.lit("x over "), F.col("pages").cast("string"), F.lit(" pages"))
    none = F.array().cast("array<string>")
    return candidates.select("term", F.col("term").alias("latin_pattern"), none.alias("approved"), none.alias("banned"), note.alias("note"), "category", F.lit(True).alias("needs_review"))
