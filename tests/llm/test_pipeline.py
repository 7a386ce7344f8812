import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from folioframe.llm import mixing, ngram_join, quality_rules

from .test_ngram_join import brute
from .test_packing import check


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kinds = docs.dtypes
    tables = [docs]
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, small), f"test-{name}")
        tables.append(docs)
        assert name == "packing" or docs.dtypes == kinds
    start, good, single, clean, mixed, packed = tables
    ids = lambda t: sorted(r.doc_id for r in t.select("doc_id").collect())
    assert ids(good) == sorted(r.doc_id for r in quality_rules.judge(start).where("kept").collect())
    want = brute([tuple(r) for r in good.select("doc_id", "text").collect()])
    assert ids(single) == sorted(d for d, (_, c) in want.items() if c == d)
    assert ids(clean) == ids(single)
    assert clean.where(F.col("text").rlike(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{16}|token = .[0-9a-f]{40}")).count() == 0
    untouched = clean.join(single.withColumnRenamed("text", "was"), "doc_id").where("text <> was").collect()
    assert all("[SECRET]" in r.text for r in untouched)
    words = lambda t: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in t.collect())
    assert words(mixed) == sum(r.taken for r in mixing.plan(clean).collect())
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.agg(F.sum("length")).head()[0] == sum(len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())


def test_packing_of_distinct_documents(spark, small):
    docs = ngram_join.keep_one(spark.read.parquet(f"{small}/documents.parquet"))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = P.packing_stage(spark, docs, small).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], rows, lambda x: t.encode(x, add_special_tokens=False).ids)


def test_odd_rows_pass_every_stage(spark, small):
    """Null ids, sources and texts, copies, a very long text and columns named like own ones."""
    prose = lambda k, n=120: " ".join(f"{'abcdefghij'[(k * 7 + i * 3) % 10]}{'klmnopqrst'[(k + i * i) % 10]}o{'uvwxyz'[i % 6]}{'aeiou'[(k * 3 + i // 5) % 5]}{'bcdfgh'[(i * k) % 6]}" for i in range(n)) + "."
    rows = [(1, prose(1), "en", "a"), (2, prose(1), "en", "a"), (None, prose(2), None, None), (None, prose(2), None, None), (4, None, "en", "a"), (5, "", "en", None), (6, prose(3, 40_000), "en", "b"), (7, prose(4), "en", "b"), (7, prose(5), "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "map('a', 1) AS _id", "1 AS h", "2 AS kept", "3 AS size", "'q' AS _text")
    kinds, sizes = docs.dtypes, []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, small), f"odd-{name}")
        sizes.append(docs.count())
        assert name == "packing" or docs.dtypes == kinds
    assert sizes[0] >= 1 and sizes[1] == sizes[2] <= sizes[0]


def test_run_on_an_empty_table(spark, tmp_path, small):
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
