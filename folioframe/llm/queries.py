"""The registered queries of this subpackage: thin contracts over the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, embedding_whitening, language_mixture, mixing, ngram_join, packing, quality_classifier, quality_rules, secret_scan, sharding, source_divergence, token_counts, warc
from .common import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Arrivals that op1 makes of a table's files.
ARRIVALS = 8


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = sorted(docs.inputFiles())
    step = max(1, -(-len(files) // ARRIVALS))
    arrivals = [spark.read.schema(docs.schema).parquet(*files[i : i + step]) for i in range(0, len(files), step)] or [docs]
    store = sharding.ingest(arrivals, fresh_path(spark, "shards"))
    return store.read().select("doc_id", "lang", "source", "n_chars", F.octet_length("text").cast("long").alias("text_bytes"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    words = secret_scan.dictionary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.train(spark, words=words))
    return found.select("doc_id", "start", "length", "kind", "score", F.md5(F.encode("secret", "UTF-8")).alias("secret_md5"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), whole=True)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return quality_classifier.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_mixture.learn(docs.where(~held_out(F.col("doc_id"))))
    found = language_mixture.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    """DuckDB twins, where SQL expresses the operator; tests hold the others against brute force."""
    payload = "SELECT page_id, encode(coalesce(html, '')) AS p FROM pages"
    sized = f"SELECT page_id, octet_length(p) AS payload_bytes, sha1(p) AS payload_digest FROM ({payload})"
    small = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"regexp_extract_all({small}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
    share = lambda n, total: f"1 + (1000000000::HUGEINT * ({n} + 2)) // greatest(1, {total} + 2 * v)"
    apart = "((p - q) * (p - q)) // (p + q)"
    answer = "max(page_id) OVER (PARTITION BY payload_digest)"
    return {
        "op1_sharding": "SELECT doc_id, lang, source, n_chars, strlen(text) AS text_bytes, md5(text) AS text_md5 FROM documents",
        "op11_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {terms} AS ts FROM documents),
w AS (SELECT i, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, count(*) AS v, sum(total) AS words FROM kept GROUP BY lang),
own AS (SELECT lang, source, sum(n) AS words FROM n GROUP BY lang, source),
p AS (SELECT lang, g.source, term, coalesce(n.n, 0) AS n, {share("coalesce(n.n, 0)", "coalesce(own.words, 0)")} AS p, {share("total", "langs.words")} AS q
      FROM groups g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN n USING (lang, source, term) LEFT JOIN own USING (lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum({apart}) FROM (SELECT x.p AS p, y.p AS q FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source)), 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
found AS (SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
          UNION ALL SELECT lang, source, 'term', term, ({apart})::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found) WHERE part = 'pair' OR rank <= 10""",
        "op9_warc": f"SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < {answer} THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id < {answer} THEN {answer} END AS refers_to FROM ({sized})",
    }
