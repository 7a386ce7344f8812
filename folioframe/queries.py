"""Registered queries over the driver's tables, each beside its DuckDB twin where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .functions import records as R
from .functions import text as T
from .operators import aggregates as A
from .operators import changes as C
from .operators import joins as J
from .operators import sets as S
from .operators import windows as W
from .operators import snapshots as SN
from .plans import alignment, bundles, candidates, decisions, grams, mining, rules, service, validators
from .sources import ocr, readers, writers
from .streaming import resume
from .workspace import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scores(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """A "run": mean value of each user's events of one type."""
    return table(spark, d, "events").where(F.col("event_type") == kind).groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("score"))


_RUN = "(SELECT user_id, round(avg(value), 6) AS score FROM events WHERE event_type = '{}' GROUP BY user_id)"
_PAIRS = f"{_RUN.format('click')} a FULL JOIN {_RUN.format('view')} b USING (user_id)"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    a, b = _scores(spark, d, "click").withColumnRenamed("score", "a"), _scores(spark, d, "view").withColumnRenamed("score", "b")
    return a.join(b, "user_id", "full_outer")


_TURNS = "(SELECT conv_id, turn, max(text) AS text FROM conversations GROUP BY conv_id, turn)"
_NEXT_TURNS = f"(SELECT a.conv_id, a.turn, a.text AS a, b.text AS b FROM {_TURNS} a LEFT JOIN {_TURNS} b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"


def _next_turns(spark: SparkSession, d: str) -> DataFrame:
    """(conv_id, turn, a, b): each turn's text and the next one's, null after the last. One shuffle by both, so a long conversation spreads."""
    own = F.struct("turn", F.col("text").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(True).alias("here"))
    before = F.struct((F.col("turn") - 1).alias("turn"), F.lit(None).cast("string").alias("a"), F.col("text").alias("b"), F.lit(False).alias("here"))
    x = table(spark, d, "conversations").select("conv_id", F.inline(F.array(own, before)))
    return x.groupBy("conv_id", "turn").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.bool_or("here").alias("here")).where("here").drop("here")


# --- Sources -------------------------------------------------------------------------------------------------------

_TURN = StructType([StructField("key", StringType()), StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("text", StringType())])


def _jsonl(spark: SparkSession, d: str, torn: bool = False, by_conversation: bool = False) -> str:
    """The conversations as JSON lines, with rows of equal keys, and with a torn and a blank line if asked.

    The key is the role, or the conversation, whose turns then stand in one file in their order.
    """
    x = table(spark, d, "conversations").select(F.col("role").alias("key"), "conv_id", "turn", "text")
    if by_conversation:
        x = x.withColumn("key", F.col("conv_id").cast("string")).repartition("key").sortWithinPartitions("key", "turn")
    lines = x.select(F.to_json(F.struct(*x.columns)).alias("value"))
    if torn:
        lines = lines.union(spark.createDataFrame([('{"key": "torn", "conv_id": 1, "tu',), ("",)], "value string"))
    path = fresh_path(spark, "jsonl")
    lines.write.text(path)
    return path


@query("SELECT role AS key, conv_id, turn, text FROM conversations")
def jsonl_scan_ordered_list(spark, d):
    return readers.jsonl_ordered(spark, _jsonl(spark, d), _TURN).select("key", "conv_id", "turn", "text")


@query("SELECT conv_id::VARCHAR AS key, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def jsonl_scan_strict(spark, d):
    """The last turn of each conversation."""
    return readers.jsonl_strict(spark, _jsonl(spark, d, by_conversation=True), _TURN, "key").select("key", "turn", "text")


@query("SELECT conv_id::VARCHAR AS key, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def jsonl_scan_lenient(spark, d):
    """The last turn of each conversation."""
    return readers.jsonl_lenient(spark, _jsonl(spark, d, torn=True, by_conversation=True), _TURN, "key").select("key", "turn", "text")


@query("SELECT count(*) AS good, 1::BIGINT AS malformed FROM conversations")
def jsonl_scan_counting_corrupt(spark, d):
    good, bad = readers.jsonl_counting(spark, _jsonl(spark, d, torn=True), _TURN)
    return good.agg(F.count("*").alias("good")).join(bad.agg(F.count("*").alias("malformed")))


@query("SELECT conv_id, turn FROM conversations")
def jsonl_scan_warn_skip(spark, d):
    return readers.jsonl_counting(spark, _jsonl(spark, d, torn=True), _TURN)[0].select("conv_id", "turn")


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id")
def json_document_scan(spark, d):
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    path = fresh_path(spark, "json")
    x.write.json(path)
    back = spark.read.schema("conv_id long, turns array<struct<turn:long,role:string,text:string>>").json(path)
    return back.select("conv_id", F.size("turns").cast("long").alias("n"))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def tsv_csv_scan(spark, d):
    path = fresh_path(spark, "tsv")
    writers.tsv(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return readers.delimited(spark, path)


@query("SELECT printf('v%d', o_orderkey % 2) AS version, o_orderstatus AS run, count(*) AS n FROM orders GROUP BY 1, 2")
def run_discovery(spark, d):
    base = fresh_path(spark, "runs")
    x = table(spark, d, "orders").select(F.format_string("v%d", F.col("o_orderkey") % 2).alias("v"), "o_orderstatus", "o_orderkey")
    for v in ("v0", "v1"):
        x.where(F.col("v") == v).select("o_orderkey", F.col("o_orderstatus").alias("r")).write.partitionBy("r").json(f"{base}/{v}")
    rows = readers.runs(spark, base, StructType([StructField("o_orderkey", LongType())]), name="*.json")
    return rows.groupBy("version", F.regexp_replace("run", "^r=", "").alias("run")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN (SELECT min(o_orderkey) FROM orders) + 10 AND (SELECT max(o_orderkey) FROM orders) - 10")
def sentinel_slice_scan(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("id"))
    ends = x.agg(F.min("o_orderkey") + 10, F.max("o_orderkey") - 10).head()
    return readers.sentinel_slice(x, "id", "o_orderkey", str(ends[0]), str(ends[1])).select("o_orderkey")


@query("SELECT n AS page_num, CASE WHEN s_suppkey IS NULL THEN 'run' ELSE 'skip' END AS action, CASE WHEN s_suppkey IS NULL THEN '' ELSE 'target exists' END AS reason FROM (SELECT unnest(range(1, max(greatest(c, s)) + 1)) AS n FROM (SELECT max(c_custkey) AS c FROM customer), (SELECT max(s_suppkey) AS s FROM supplier)) LEFT JOIN supplier ON s_suppkey = n")
def work_plan_scan(spark, d):
    """The plan of all customers' and suppliers' keys."""
    done = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_num"))
    last = max(table(spark, d, "customer").agg(F.max("c_custkey")).head()[0] or 0, done.agg(F.max("page_num")).head()[0] or 0)
    return readers.work_plan(spark, 1, last, done)


@query("SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark WHERE item_id NOT IN (SELECT doc_id FROM documents)")
def path_fallback_resolve(spark, d):
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return readers.first_existing([table(spark, d, "documents").select("doc_id", "text"), b], "doc_id")


# --- Sinks ---------------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name FROM nation")
def sorted_atomic_jsonl_rewrite(spark, d):
    path = fresh_path(spark, "sorted")
    x = table(spark, d, "nation").select("n_nationkey", "n_name")
    for _ in range(2):
        writers.sorted_jsonl(x, path, [F.col("n_name").asc()])
    return spark.read.schema(x.schema).json(path)


@query("SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region")
def append_jsonl(spark, d):
    path = fresh_path(spark, "append")
    x = table(spark, d, "region").select("r_regionkey", "r_name")
    writers.append_jsonl(x, path)
    writers.append_jsonl(x, path)
    return spark.read.schema(x.schema).json(path)


@query("SELECT event_type, count(*)::VARCHAR AS n FROM events GROUP BY event_type")
def csv_metrics_sink(spark, d):
    path = fresh_path(spark, "csv")
    x = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    writers.metrics_csv(x, path, ["event_type", "n", "mean"])
    return readers.delimited(spark, path, ",").select("event_type", "n")


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS paid FROM supplier")
def manifest_csv_sink(spark, d):
    path = fresh_path(spark, "manifest")
    writers.manifest_csv(table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") > 0).alias("paid")), path, ["s_suppkey", "paid"])
    return readers.delimited(spark, path, ",")


@query("SELECT r_regionkey::VARCHAR AS page, string_agg(n_name, ' ' ORDER BY n_name) AS text FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey")
def file_per_group_sink(spark, d):
    path = fresh_path(spark, "pages")
    x = A.text_by_group(table(spark, d, "nation").select(F.col("n_regionkey").alias("page"), "n_name"), ["page"], "n_name", "n_name")
    writers.text_per_group(x, path, "page", "text")
    return spark.read.text(path).select(F.col("page").cast("string").alias("page"), F.col("value").alias("text"))


# --- Projections and predicates ------------------------------------------------------------------------------------


@query("SELECT event_id, CASE WHEN value < 5 THEN 'red' WHEN value < 20 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END AS band FROM events")
def range_bucket(spark, d):
    return table(spark, d, "events").select("event_id", R.confidence_band(F.col("value"), 5, 20).alias("band"))


@query("SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS INTEGER) AS page_num FROM pages")
def page_num_extract(spark, d):
    return table(spark, d, "pages").select("page_id", R.page_number(F.col("url")).alias("page_num"))


@query("SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(url, '([0-9]+)[^0-9]*$', 1), '') AS INTEGER), 0) AS ord FROM pages")
def order_key(spark, d):
    return table(spark, d, "pages").select("page_id", R.order_key(F.lit(None).cast("int"), F.col("url")).alias("ord"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 2000")
def page_range_filter(spark, d):
    return table(spark, d, "orders").where(R.in_range(F.col("o_orderkey"), 100, 2000)).select("o_orderkey")


@query("SELECT doc_id FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id) WHERE q IS NULL OR q BETWEEN 1 AND 1")
def page_range_filter_keep_unknown(spark, d):
    q = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return table(spark, d, "documents").select("doc_id").join(q, "doc_id", "left").where(R.in_range(F.col("q"), 1, 1, keep_unknown=True)).select("doc_id")


@query("SELECT event_id, coalesce(TRY_CAST(nullif(regexp_extract(props, '\"k\"\\s*:\\s*\"?([0-9]+)\"?', 1), '') AS INTEGER), -1) AS k FROM events")
def json_salvage(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(R.json_score(F.col("props"), "k"), F.lit(-1)).alias("k"))


@query("SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, 'draft' AS status FROM events")
def model_json_to_rows(spark, d):
    x = F.from_json("props", "k long, status string")
    return table(spark, d, "events").select("event_id", F.coalesce(x["k"], F.lit(0)).alias("k"), F.coalesce(x["status"], F.lit("draft")).alias("status"))


@query("SELECT conv_id, turn, CASE WHEN trim(text) = '' THEN 'missing_source' WHEN role = 'user' THEN 'missing_translation' END AS error FROM conversations")
def scorable_filter(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", R.scorable_error(F.col("text"), F.when(F.col("role") != "user", F.col("text"))).alias("error"))


@query("SELECT doc_id FROM documents WHERE length(text) <= 400 AND contains(lower(text), 'the')")
def quota_message_predicate(spark, d):
    return table(spark, d, "documents").where(R.short_with_marker(F.col("text"), "the")).select("doc_id")


@query("SELECT doc_id, coalesce(nullif(lang, ''), nullif(source, ''), '') AS value FROM documents")
def coalesce_text(spark, d):
    return table(spark, d, "documents").select("doc_id", R.coalesce_text(F.col("lang"), F.col("source")).alias("value"))


@query("SELECT conv_id, arg_max(text, turn) AS latest, count(*) + 1 AS next_version FROM conversations GROUP BY conv_id")
def latest_value(spark, d):
    h = F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("english"), (F.col("turn") + 1).alias("version"))))
    x = table(spark, d, "conversations").groupBy("conv_id").agg(h.alias("h"))
    return x.select("conv_id", R.latest_value(F.col("h"), F.lit("")).alias("latest"), (F.size("h") + 1).cast("long").alias("next_version"))


@query("SELECT conv_id, max(turn) + 1 AS version FROM conversations GROUP BY conv_id")
def version_increment(spark, d):
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("version")))).alias("h"))
    return x.select("conv_id", R.next_version(F.col("h")).alias("version"))


# --- Joins ---------------------------------------------------------------------------------------------------------


@query(f"SELECT user_id, a.score AS score_a, b.score AS score_b FROM {_RUN.format('click')} a JOIN {_RUN.format('view')} b USING (user_id)")
def equi_inner_shared(spark, d):
    return J.shared(_scores(spark, d, "click"), _scores(spark, d, "view"), "user_id", ["score"])


@query("""WITH a AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 7 <> 0)
SELECT c_custkey, CASE WHEN a.c_name IS NULL THEN '(missing)' ELSE a.c_name END AS a, CASE WHEN b.c_name IS NULL THEN '(missing)' ELSE b.c_name END AS b, coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment,
 a.c_name IS NOT NULL AND b.c_name IS NOT NULL AND a.c_mktsegment <> b.c_mktsegment AS source_differs FROM a FULL JOIN b USING (c_custkey)""")
def full_outer_pair(spark, d):
    c = table(spark, d, "customer")
    b = c.where("c_custkey % 7 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "X").otherwise(F.col("c_mktsegment")))
    return J.full_pair(c.where("c_custkey % 3 <> 0"), b, "c_custkey", "c_name", "c_mktsegment")


@query(f"SELECT user_id, a.score AS value_a, b.score AS value_b, CASE WHEN b.user_id IS NULL THEN 'a_only' ELSE 'compared' END AS status, round(b.score - a.score, 6) AS delta FROM {_RUN.format('click')} a LEFT JOIN {_RUN.format('purchase')} b USING (user_id)")
def left_outer_compare(spark, d):
    return J.left_compare(_scores(spark, d, "click"), _scores(spark, d, "purchase"), "user_id", "score").withColumn("delta", F.round("delta", 6))


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_join_anchor(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def anti_join_resume(spark, d):
    return C.remaining(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", F.col("quality") == 1)


@query("SELECT DISTINCT doc_id, 'missing' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def anti_join_missing_units(spark, d):
    return J.missing_and_unexpected(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


_BY_SUPP = "(SELECT l_suppkey, l_linenumber, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = '{}' GROUP BY 1, 2)"


@query(f"SELECT l_suppkey, l_linenumber, a.q AS v0, b.q AS v1, c.q AS v2 FROM {_BY_SUPP.format('N')} a LEFT JOIN {_BY_SUPP.format('R')} b USING (l_suppkey, l_linenumber) LEFT JOIN {_BY_SUPP.format('A')} c USING (l_suppkey, l_linenumber)")
def composite_key_paired_join(spark, d):
    x = table(spark, d, "lineitem")
    by = lambda f: x.where(F.col("l_returnflag") == f).groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    return J.paired_versions({"v0": by("N"), "v1": by("R"), "v2": by("A")}, ["l_suppkey", "l_linenumber"], "q")


@query("SELECT r_regionkey, string_agg(n_name, ' ' ORDER BY n_nationkey DESC) AS text FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey")
def concat_join_ordered(spark, d):
    n = table(spark, d, "nation")
    units = n.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.sort_array(F.collect_list("n_nationkey"), asc=False).alias("ids"))
    return J.concat_lines(units, n, "r_regionkey", "ids", "n_nationkey", "n_name")


@query("""WITH b AS (SELECT DISTINCT c_nationkey AS big, c_mktsegment AS x FROM customer), s AS (SELECT DISTINCT c_nationkey * 100 + floor(c_acctbal / 1000)::BIGINT + 10 AS small, c_mktsegment AS x FROM customer), n AS (SELECT small, count(*) AS n FROM s GROUP BY small)
SELECT big, small, count(*) AS n FROM b JOIN s USING (x) JOIN n USING (small) GROUP BY big, small, n.n HAVING count(*) = n.n""")
def set_containment_join(spark, d):
    """Segments of each nation's customers by balance, in the segments of whole nations."""
    c = table(spark, d, "customer")
    big = c.groupBy(F.col("c_nationkey").alias("big")).agg(F.collect_set("c_mktsegment").alias("items"))
    small = c.groupBy((F.col("c_nationkey") * 100 + F.floor(F.col("c_acctbal") / 1000) + 10).alias("small")).agg(F.collect_set("c_mktsegment").alias("items"))
    return J.contained_sets(big, small, "big", "small", "items")


@query("SELECT doc_id, rule FROM documents JOIN (VALUES ('the', '(?i)\\bthe [a-z]+tion\\b'), ('number', '[0-9]{4,}'), ('shout', '[A-Z]{6,}')) r(rule, pattern) ON regexp_matches(text, pattern)")
def regex_theta_join(spark, d):
    rules = spark.createDataFrame([("the", r"(?i)\bthe [a-z]+tion\b"), ("number", "[0-9]{4,}"), ("shout", "[A-Z]{6,}")], "rule string, pattern string")
    return J.matching_rules(table(spark, d, "documents"), "text", rules, "pattern").select("doc_id", "rule")


@query("""WITH a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, turn AS answer, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, answer FROM a JOIN b USING (conv_id, r)""")
def symbol_binding_join(spark, d):
    c = table(spark, d, "conversations")
    a, b = c.where("role = 'user'").select("conv_id", "turn"), c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("answer"))
    return J.bind_by_rank(a, b, ["conv_id"], "turn", "answer")


@query("SELECT c_nationkey AS unit, count(*) AS n_lines, count(DISTINCT s_nationkey) AS n_owners FROM (SELECT DISTINCT c_nationkey, c_custkey FROM customer) c JOIN (SELECT s_suppkey, s_nationkey FROM supplier) s ON c_custkey = s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY c_nationkey")
def self_overlap_clash(spark, d):
    new = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("u")).agg(F.collect_set("c_custkey").alias("ids"))
    old = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("u")).agg(F.collect_set("s_suppkey").alias("ids"))
    return J.ownership_clashes(new, old, "u", "ids").select("unit", F.size("lines").cast("long").alias("n_lines"), F.size("owners").cast("long").alias("n_owners"))


@query("SELECT doc_id, 'label' AS origin FROM labels UNION ALL SELECT doc_id, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def priority_union_join(spark, d):
    a, b = table(spark, d, "labels").select("doc_id", F.lit("label").alias("origin")), table(spark, d, "documents").select("doc_id", F.lit("document").alias("origin"))
    return J.prefer(a, b, "doc_id")


@query("""WITH w AS (SELECT conv_id, turn, coalesce(list_extract(regexp_extract_all(lower(text), '[a-z]+'), -1), '') AS caught, coalesce(list_extract(regexp_extract_all(lower(text), '[a-z]+'), 1), '') AS head FROM conversations),
x AS (SELECT conv_id, turn, caught, lead(head) OVER (PARTITION BY conv_id ORDER BY turn) AS found, lead(1) OVER (PARTITION BY conv_id ORDER BY turn) AS more FROM w)
SELECT conv_id, turn, caught, found, CASE WHEN caught = '' OR coalesce(found, '') = '' THEN 'missing' WHEN caught = found THEN 'match' ELSE 'mismatch' END AS status FROM x WHERE more = 1""")
def lead_join_catchword(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    at = lambda i: F.coalesce(F.try_element_at(words, F.lit(i)), F.lit(""))
    return J.lead_pairs(table(spark, d, "conversations"), ["conv_id"], "turn", at(-1), at(1))


# --- Aggregations --------------------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_key(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'error') AS errors, count(*) AS n FROM events GROUP BY user_id")
def conditional_counts(spark, d):
    is_type = lambda t: F.count_if(F.col("event_type") == t)
    return table(spark, d, "events").groupBy("user_id").agg(is_type("click").alias("clicks"), is_type("error").alias("errors"), F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT a.score AS a, b.score AS b, b.score - a.score AS d FROM {_PAIRS})
SELECT count(d) AS n, count(*) - count(d) AS n_errored, round(avg(a) FILTER (d IS NOT NULL), 6) AS mean_a, round(avg(b) FILTER (d IS NOT NULL), 6) AS mean_b, round(median(a) FILTER (d IS NOT NULL), 6) AS median_a, round(median(b) FILTER (d IS NOT NULL), 6) AS median_b, round(avg(d), 6) AS mean_delta,
count(*) FILTER (d > 0) AS wins, count(*) FILTER (d = 0) AS ties, count(*) FILTER (d < 0) AS losses, round(count(*) FILTER (d > 0) / count(d), 6) AS win_rate FROM p""")
def win_tie_loss_delta(spark, d):
    x = A.win_tie_loss(_pairs(spark, d), "a", "b")
    return x.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in x.dtypes])


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS stdev, min(value) AS min, max(value) AS max FROM events GROUP BY event_type")
def score_stats(spark, d):
    x = A.score_stats(table(spark, d, "events"), ["event_type"], "value")
    return x.withColumns({c: F.round(c, 6) for c in ("mean", "median", "stdev")})


@query("SELECT event_type AS run, user_id, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY 1, 2")
def per_run_stats(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("run"), "user_id").agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"))


@query("SELECT user_id, count(value) AS n, round(avg(value), 6) AS mean, round(coalesce(stddev_samp(value), 0), 5) AS stdev, round(max(value) - min(value), 6) AS spread FROM events GROUP BY user_id")
def cross_run_stability(spark, d):
    x = A.stability(table(spark, d, "events"), "user_id", "value")
    return x.select("user_id", "n", F.round("mean", 6).alias("mean"), F.round("stdev", 5).alias("stdev"), F.round("spread", 6).alias("spread"))


@query("SELECT user_id, round(max(value) - min(value), 6) AS spread, max(value) - min(value) >= 100 AS flagged FROM events GROUP BY user_id")
def spread_stats(spark, d):
    return A.stability(table(spark, d, "events"), "user_id", "value").select("user_id", F.round("spread", 6).alias("spread"), (F.col("spread") >= 100).alias("flagged"))


@query("""WITH m AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2), b AS (SELECT *, max(v) OVER (PARTITION BY user_id) AS best FROM m), w AS (SELECT user_id, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) ELSE 'tie' END AS winner FROM b WHERE v = best GROUP BY user_id)
SELECT winner, count(*) AS groups_won FROM w GROUP BY winner""")
def group_winner_count(spark, d):
    m = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    return A.group_winners(m, "user_id", "event_type", "v")


@query("SELECT event_type, round(avg(value), 6) AS mean FROM events GROUP BY event_type ORDER BY mean DESC, event_type LIMIT 1")
def best_group(spark, d):
    return A.best_group(table(spark, d, "events"), "event_type", "value").withColumn("mean", F.round("mean", 6))


@query("SELECT user_id, round(100 * avg(value) FILTER (event_type <> 'error' AND value > 0), 2) AS confidence_avg, round(100 * min(value) FILTER (event_type <> 'error' AND value > 0), 2) AS confidence_min FROM events GROUP BY user_id")
def mean_min_confidence(spark, d):
    return A.confidence(table(spark, d, "events"), ["user_id"], "value", F.col("event_type") == "error")


_LABEL_MAP = "unnest([{'rubric': 'quality', 'raw': quality::VARCHAR}, {'rubric': 'toxic', 'raw': CASE WHEN toxic = 1 THEN 'na' ELSE '0' END}], recursive := true)"


@query(f"WITH x AS (SELECT {_LABEL_MAP} FROM labels) SELECT rubric, round(avg(TRY_CAST(raw AS INTEGER)), 6) AS mean, min(TRY_CAST(raw AS INTEGER)) AS min, max(TRY_CAST(raw AS INTEGER)) AS max, count(TRY_CAST(raw AS INTEGER)) AS n, count(*) FILTER (raw = 'na') AS n_na, count(*) FILTER (raw IS NULL) AS n_err FROM x GROUP BY rubric")
def rubric_aggregate(spark, d):
    x = table(spark, d, "labels").select("doc_id", F.create_map(F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.when(F.col("toxic") == 1, "na").otherwise("0")).alias("scores"))
    return A.rubric_summary(x, "scores", ["quality", "toxic"]).withColumn("mean", F.round("mean", 6))


@query("SELECT l_returnflag, count(*) FILTER (l_linenumber = 1) AS n_1, count(*) FILTER (l_linenumber = 2) AS n_2, count(*) FILTER (l_linenumber = 3) AS n_3 FROM lineitem GROUP BY l_returnflag")
def histogram_fixed(spark, d):
    return A.histogram(table(spark, d, "lineitem"), "l_returnflag", "l_linenumber", [1, 2, 3])


@query("SELECT lang, round(avg(n_chars), 6) AS mean, count(*) AS n FROM documents GROUP BY lang")
def per_page_means(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.round(F.avg("n_chars"), 6).alias("mean"), F.count("*").alias("n"))


@query("WITH s AS (SELECT event_type, count(*) AS segments, count(*) FILTER (value > 50) AS findings FROM events GROUP BY event_type) SELECT event_type, findings, segments, round(findings / segments, 9) AS rate FROM s")
def pooled_rate(spark, d):
    e = table(spark, d, "events")
    return A.pooled_rate(e.where("value > 50"), e, "event_type").withColumn("rate", F.round("rate", 9))


@query("""WITH n AS (SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS n FROM customer GROUP BY 1, 2) SELECT c_nationkey, count(*) AS variants, sum(n)::BIGINT AS segments FROM n GROUP BY c_nationkey HAVING count(*) > 1""")
def distinct_variant_drift(spark, d):
    return A.variant_drift(table(spark, d, "customer"), "c_nationkey", "c_mktsegment", "c_custkey").drop("uses")


@query("""WITH w AS (SELECT p_type, p_brand, count(*) AS n, count(DISTINCT p_size) AS pages FROM part GROUP BY 1, 2), k AS (SELECT *, lower(split_part(p_type, ' ', 1)) AS cluster, p_type || '/' || p_brand AS name FROM w)
SELECT cluster, arg_min(name, {'c': -n, 'm': name}) AS representative, array_to_string(list_sort(list_distinct(list(name))), '|') AS variants, sum(n)::BIGINT AS total, max(pages) AS pages FROM k GROUP BY cluster""")
def cluster_by_key(spark, d):
    w = table(spark, d, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"), F.countDistinct("p_size").alias("pages")).withColumn("name", F.concat("p_type", F.lit("/"), "p_brand"))
    return A.clusters(w, F.lower(F.split("p_type", " ")[0]), "name", "n", "pages")


@query("SELECT conv_id, string_agg(coalesce(text, ''), ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def group_string_agg(spark, d):
    return A.text_by_group(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query(f"""WITH k AS (SELECT conv_id, turn, regexp_extract_all(lower(coalesce(a, '')), '[^\\x20\\x09-\\x0D]+') AS p, regexp_extract_all(lower(coalesce(b, '')), '[^\\x20\\x09-\\x0D]+') AS r FROM {_NEXT_TURNS}),
a AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(p) AS w FROM k) GROUP BY 1, 2, 3), b AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(r) AS w FROM k) GROUP BY 1, 2, 3), h AS (SELECT conv_id, turn, sum(least(a.n, b.n)) AS h FROM a JOIN b USING (conv_id, turn, w) GROUP BY 1, 2)
SELECT conv_id, turn, round(CASE WHEN len(p) = 0 OR len(r) = 0 THEN 0 ELSE coalesce(h, 0) / len(p) * CASE WHEN len(p) >= len(r) THEN 1 ELSE pow(2.718281828, 1 - len(r) / len(p)) END END, 9) AS score FROM k LEFT JOIN h USING (conv_id, turn)""")
def multiset_overlap(spark, d):
    """Each turn as a prediction of the next one."""
    x = _next_turns(spark, d).select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in "ab"])
    return A.multiset_overlap(x, ["conv_id", "turn"], "a", "b").withColumn("score", F.round("score", 9))


@query("SELECT a.doc_id, (CASE WHEN trim(a.lang) = trim(b.lang) THEN 1.0 ELSE 0.0 END)::DOUBLE AS score FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1")
def exact_match_score(spark, d):
    a = table(spark, d, "documents").select("doc_id", "lang")
    b = a.select((F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("other"))
    return a.join(b, "doc_id").select("doc_id", (F.trim("lang") == F.trim("other")).cast("double").alias("score"))


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS n_a, count(*) FILTER (o_orderstatus = 'O') AS n_b, round(abs(count(*) FILTER (o_orderstatus = 'F') / (count(*) FILTER (o_orderstatus IN ('F', 'O'))) - 0.5), 9) AS bias FROM orders")
def position_bias(spark, d):
    x = table(spark, d, "orders").withColumn("pick", F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B"))
    return A.position_bias(x, "pick").withColumn("bias", F.round("bias", 9))


@query("""SELECT doc_id, length(text) AS chars, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, len(h) AS hits, round(1000.0 * len(h) / length(text), 6) AS hits_per_kchar, array_to_string(list_filter(h, lambda x, i: list_position(h, x) = i)[1:6], '|') AS samples
FROM (SELECT doc_id, text, regexp_extract_all(text, '[0-9]+') AS h FROM documents)""")
def page_metrics(spark, d):
    x = mining.page_metrics(table(spark, d, "documents"), ["doc_id"], "text").withColumn("hits_per_kchar", F.round("hits_per_kchar", 6))
    return x.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("chars", "words", "hits")], "hits_per_kchar", "samples")


# --- Windows -------------------------------------------------------------------------------------------------------


@query("SELECT conv_id, turn, string_agg(coalesce(text, ''), ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM conversations")
def neighbour_text_window(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", W.neighbour_text(F.col("text"), ["conv_id"], ["turn"]).alias("near"))


@query("SELECT conv_id, turn, length(string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) AS near, length(string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) AS far FROM conversations")
def neighbour_text_window_dual(spark, d):
    n = lambda k: F.length(W.neighbour_text(F.col("text"), ["conv_id"], ["turn"], k)).cast("long")
    return table(spark, d, "conversations").select("conv_id", "turn", n(1).alias("near"), n(5).alias("far"))


@query("SELECT conv_id, turn, array_to_string(list_sort(list_distinct(flatten(list(regexp_extract_all(text, '[A-Z][a-z]+')) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)))), ' ') AS near FROM conversations")
def neighbour_set_window(spark, d):
    ids = F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.array_sort(W.neighbour_set(ids, ["conv_id"], ["turn"])), " ").alias("near"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS seq FROM conversations")
def row_number_dense_seq(spark, d):
    return W.dense_sequence(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], [F.col("turn")])


@query("""WITH s AS (SELECT *, coalesce(sum((role = 'assistant')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS session FROM conversations)
SELECT conv_id, session, count(*) AS lines, string_agg(coalesce(text, ''), ' ' ORDER BY turn) AS text FROM s GROUP BY conv_id, session""")
def sentence_sessionize(spark, d):
    return W.sessions(table(spark, d, "conversations"), F.col("role") == "assistant", ["conv_id"], ["turn"], "text")


@query("""WITH s AS (SELECT *, coalesce(sum((text LIKE '%.')::INT) OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS session FROM conversations)
SELECT min(conv_id) AS home, session, count(*) AS lines, length(string_agg(coalesce(text, ''), ' ' ORDER BY conv_id, turn)) AS chars FROM s GROUP BY session""")
def sentence_sessionize_cross_page(spark, d):
    out = W.sessions_across(table(spark, d, "conversations"), F.col("text").endswith("."), "conv_id", ["turn"], "text")
    return out.select("home", "session", "lines", F.length("text").cast("long").alias("chars"))


@query("SELECT event_id, user_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS section FROM events")
def carry_forward_section(spark, d):
    v = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return table(spark, d, "events").select("event_id", "user_id", W.carry_forward(v, ["user_id"], ["ts", "event_id"], F.lit(-1)).alias("section"))


@query("""WITH k AS (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER p AS xa, last_value(v IGNORE NULLS) OVER p AS ya, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER f AS xb, first_value(v IGNORE NULLS) OVER f AS yb FROM k
WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, ya + (yb - ya) * (i - xa) / (xb - xa), ya, yb), 6) AS filled FROM n""")
def gap_fill_interpolate(spark, d):
    x = W.dense_sequence(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "i")
    v = F.when(F.col("event_type") == "view", F.col("value"))
    return x.select("event_id", F.round(W.interpolate(v, F.col("i"), ["user_id"], ["i"]), 6).alias("filled"))


@query("SELECT event_id, max(least(round_even(value, 0)::BIGINT, 80)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mapped FROM events")
def monotone_clamp(spark, d):
    return table(spark, d, "events").select("event_id", W.monotone(F.col("value"), ["user_id"], ["ts", "event_id"], F.lit(80)).alias("mapped"))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events), c AS (SELECT user_id, i // 8 AS c, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM k GROUP BY 1, 2)
SELECT user_id, first, last, n, row_number() OVER (PARTITION BY user_id ORDER BY c)::INTEGER AS chunk FROM c""")
def fixed_size_chunks(spark, d):
    x = W.dense_sequence(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "i").withColumn("i", F.col("i") - 1)
    return W.fixed_chunks(x, "i", "event_id", 8, ["user_id"])


@query("""SELECT a.conv_id, a.turn, coalesce(right(p.text, 240), '') AS previous, coalesce(left(n.text, 240), '') AS following FROM conversations a LEFT JOIN conversations p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1 LEFT JOIN conversations n ON n.conv_id = a.conv_id AND n.turn = a.turn + 1""")
def prev_next_context(spark, d):
    return W.page_context(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("SELECT user_id, arg_max(event_id, {'t': ts, 'e': event_id}) AS event_id FROM events GROUP BY user_id")
def last_write_wins(spark, d):
    return readers.last_write(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT user_id, arg_max(event_id, {'t': ts, 'e': event_id}) AS event_id FROM events WHERE event_type <> 'error' GROUP BY user_id")
def latest_success_wins(spark, d):
    return W.latest_success(table(spark, d, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], F.col("event_type") != "error", ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT user_id, coalesce(max(event_id) FILTER (event_type = 'purchase'), min(event_id)) AS event_id FROM events GROUP BY user_id")
def latest_success_else_first_error(spark, d):
    x = table(spark, d, "events").select("user_id", "event_type", "event_id", F.col("event_id").alias("pos"))
    return W.success_else_first_error(x, ["user_id"], F.col("event_type") == "purchase", "pos").select("user_id", "event_id")


@query("SELECT user_id, arg_min(event_type, {'t': ts, 'e': event_id}) AS event_type FROM events GROUP BY user_id")
def keep_first_per_key(spark, d):
    return W.first_per_key(table(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"])


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END, 1000000000000), o_orderkey)::INTEGER AS marker_number FROM orders")
def per_key_ordinal(spark, d):
    anchored = F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), F.lit(10**12))
    return W.dense_sequence(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], [anchored, F.col("o_orderkey")], "marker_number").drop("o_orderstatus")


@query("""WITH RECURSIVE e AS (SELECT user_id AS page, event_id AS pos, (event_id // 50)::INTEGER AS a, event_type = 'view' AS c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
g AS (SELECT page, pos, r, a AS head, 1 AS fragment_group FROM e WHERE r = 1
UNION ALL SELECT page, pos, r, CASE WHEN joins THEN head ELSE a END, fragment_group + CASE WHEN joins THEN 0 ELSE 1 END FROM (SELECT e.*, g.head, g.fragment_group, coalesce(e.a = g.head OR (e.c AND e.a - g.head BETWEEN 0 AND 1), false) AS joins FROM g JOIN e ON e.page = g.page AND e.r = g.r + 1))
SELECT page, pos, fragment_group FROM g""")
def group_consecutive_fragments(spark, d):
    x = table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("pos"), F.floor(F.col("event_id") / 50).cast("int").alias("anchor"), (F.col("event_type") == "view").alias("continues"))
    return W.fragment_groups(x, "page", "pos", "anchor", "continues")


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{L}+')) AS w, generate_subscripts(regexp_extract_all(text, '\\p{L}+'), 1) AS i FROM documents)
SELECT lower(w) AS word, count(*) FILTER (i > 1) AS seen, count(*) FILTER (i > 1 AND regexp_matches(w, '^\\p{Lu}')) AS capital FROM t GROUP BY 1 HAVING seen >= 2 AND capital >= 0.6 * seen""")
def proper_noun_evidence(spark, d):
    t = table(spark, d, "documents").select(F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("pos", "surface")).withColumn("word", F.lower("surface"))
    return mining.noun_evidence(t, "word", "surface", "pos")


# --- Sorts and limits ----------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def multi_key_sort(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal - 4500) DESC, c_custkey LIMIT 20")
def topk_abs_with_tiebreak(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.abs(F.col("c_acctbal") - 4500).desc(), "c_custkey").limit(20)


@query("SELECT event_id, value FROM events WHERE value <= 1 ORDER BY value, event_id")
def threshold_queue(spark, d):
    return table(spark, d, "events").where("value <= 1").select("event_id", "value").orderBy("value", "event_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY sha1('7:' || doc_id::VARCHAR), doc_id LIMIT 25")
def seeded_sample(spark, d):
    return decisions.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 25, 7, table(spark, d, "labels"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) >= 3 ORDER BY n DESC, p_brand LIMIT 10")
def filter_then_limit(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")).where("n >= 3").orderBy(F.col("n").desc(), "p_brand").limit(10)


# --- Sets ----------------------------------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def intersect_keys(spark, d):
    return S.intersect_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_keys(spark, d):
    return S.except_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query(f"SELECT user_id, score, 'click' AS run FROM {_RUN.format('click')} UNION ALL SELECT user_id, score, 'view' FROM {_RUN.format('view')}")
def union_runs(spark, d):
    return S.union_runs({k: _scores(spark, d, k) for k in ("click", "view")})


@query("SELECT doc_id, array_to_string(list_filter(h, lambda x, i: list_position(h, x) = i), ' ') AS tokens FROM (SELECT doc_id, regexp_extract_all(lower(text), '[0-9]+') AS h FROM documents)")
def ordered_distinct(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[0-9]+"), F.lit(0))), " ").alias("tokens"))


_WORD_SET = "list_distinct(list_filter(regexp_extract_all(lower(coalesce({0}, '')), '\\p{{L}}{{3,}}'), lambda x: x NOT IN ('the', 'and'))) AS {0}"


@query(f"SELECT conv_id, turn, round(CASE WHEN len(list_distinct(a || b)) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(a || b)) END, 9) AS jaccard FROM (SELECT conv_id, turn, {_WORD_SET.format('a')}, {_WORD_SET.format('b')} FROM {_NEXT_TURNS})")
def set_jaccard(spark, d):
    """Shared words of each turn and the next one."""
    a, b = (T.content_words(F.coalesce(c, F.lit("")), ["the", "and"]) for c in "ab")
    return _next_turns(spark, d).select("conv_id", "turn", F.round(T.jaccard(a, b), 9).alias("jaccard"))


# --- Scalar functions ----------------------------------------------------------------------------------------------


@query("SELECT doc_id, trim(regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text FROM documents")
def normalize_ws(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_ws(F.col("text")).alias("text"))


@query("SELECT doc_id, CASE WHEN length(x) > 160 THEN left(x, 160) || '…' ELSE x END AS excerpt FROM (SELECT doc_id, trim(regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS x FROM documents)")
def excerpt(spark, d):
    return table(spark, d, "documents").select("doc_id", T.excerpt(F.col("text")).alias("excerpt"))


@query("SELECT doc_id, regexp_replace(regexp_replace(list_extract(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1), '^[\\p{P}\\p{S}]+', ''), '[\\p{P}\\p{S}]+$', '') AS token FROM documents")
def first_token(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_token(F.col("text")).alias("token"))


@query("SELECT conv_id, turn, (sha1('s:' || conv_id::VARCHAR)[1:2] = '' OR list_contains(['1','3','5','7','9','b','d','f'], sha1('s:' || conv_id::VARCHAR)[2:2])) AS swapped FROM conversations")
def stable_swap(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", R.stable_swap(F.col("conv_id"), "s").alias("swapped"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 1 THEN 'v1' ELSE 'v0' END WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 1 THEN 'v0' ELSE 'v1' END WHEN 'P' THEN 'tie' END AS winner FROM orders")
def decode_ab(spark, d):
    pick = F.when(F.col("o_orderstatus") == "F", " a").when(F.col("o_orderstatus") == "O", "B").when(F.col("o_orderstatus") == "P", "tie")
    return table(spark, d, "orders").select("o_orderkey", R.decode_choice(pick, F.col("o_orderkey") % 2 == 1).alias("winner"))


@query(f"""WITH c AS (SELECT conv_id, turn, coalesce(a, '') AS a, coalesce(b, '') AS b FROM {_NEXT_TURNS})
SELECT conv_id, turn, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 0 ELSE 100.0 * (greatest(length(a), length(b)) - len(list_filter(list_zip(string_split(a, ''), string_split(b, '')), lambda p: p[1] = p[2] AND p[1] <> ''))) / greatest(length(a), length(b)) END, 6) AS rate FROM c""")
def char_diff_rate(spark, d):
    """Each turn against the next one."""
    a, b = (F.coalesce(c, F.lit("")) for c in "ab")
    return _next_turns(spark, d).select("conv_id", "turn", F.round(T.char_diff_rate(a, b), 6).alias("rate"))


@query("SELECT o_orderkey, printf('p%04d', o_orderkey) AS page_id FROM orders")
def id_builders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", R.page_id(F.col("o_orderkey")).alias("page_id"))


@query("SELECT page_id, '/mnt/c/' || replace(url, '\\', '/') AS wsl FROM pages")
def path_windows_wsl(spark, d):
    return table(spark, d, "pages").select("page_id", R.to_wsl(F.concat(F.lit("C:\\"), F.col("url"))).alias("wsl"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def iso_now(spark, d):
    return table(spark, d, "events").select("event_id", R.utc_second(F.col("ts")).alias("at"))


@query("SELECT p_partkey, p_size, list_extract(['I','II','III','IV','V','VI','VII','VIII','IX'], (p_size % 9 + 1)::INTEGER) AS roman, (p_size % 9 + 1)::INTEGER AS back FROM part")
def int_to_roman(spark, d):
    x = table(spark, d, "part").select("p_partkey", "p_size", T.int_to_roman(F.col("p_size") % 9 + 1).alias("roman"))
    return x.withColumn("back", T.roman_to_int(F.col("roman")))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\p{Latin}')) AS latin, len(regexp_extract_all(text, '[\\x{0370}-\\x{03FF}\\x{1F00}-\\x{1FFF}]')) AS greek FROM documents")
def alpha_breakdown(spark, d):
    b = T.alpha_breakdown(F.col("text"))
    return table(spark, d, "documents").select("doc_id", b["latin"].cast("long").alias("latin"), b["greek"].cast("long").alias("greek"))


@query("SELECT doc_id, regexp_matches(text, '[\\x{0370}-\\x{03FF}\\x{1F00}-\\x{1FFF}]') AS greek FROM documents")
def contains_greek(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text").rlike(T.GREEK).alias("greek"))


#: Lines that end with a hyphen of each kind, with blanks before and after the break.
_HYPHENATED = "replace(replace(replace(replace(text, 'en', 'e-' || chr(10) || 'n'), 're', 'r\u00ac ' || chr(10) || ' e'), 'ti', 't\u2014' || chr(10) || 'i'), 'is', 'i\u00ad  ' || chr(10) || 's')"


@query(f"SELECT doc_id, trim(replace(regexp_replace(array_to_string(list_transform(string_split(t, chr(10)), lambda x: trim(x)), chr(10)), '[\\-\u00ac\u2014\u00ad]\\n', '', 'g'), chr(10), ' ')) AS text FROM (SELECT doc_id, {_HYPHENATED} AS t FROM documents)")
def join_dehyphenate(spark, d):
    return _shaped(spark, d, _HYPHENATED).select("doc_id", T.join_dehyphenate(F.split("t", "\n")).alias("text"))


@query("SELECT conv_id, turn, regexp_matches(text, '[!?]$') OR (text LIKE '%.' AND NOT regexp_matches(text, '(^|[^\\pL\\pN_])([\\pL\\pN_]|[IVXLCDMivxlcdm]+|cap|lib|pag|ver|tom|edit|epist|part|op|num|vid|etc|seq|ibid|fol|sect|art)\\.$', 'i')) AS ends FROM conversations")
def is_sentence_end(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.sentence_ends(F.col("text")).alias("ends"))


# --- Incremental ---------------------------------------------------------------------------------------------------


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as pages before and after a save: lines and footnotes come and go, fields, metadata and markers change."""
    turn, body = F.col("turn"), F.col("role") == "user"

    def side(new: bool) -> DataFrame:
        text = F.when((turn % 3 == 1) & F.lit(new), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
        status = F.when((turn % 4 == 2) & F.lit(new), "locked").otherwise("draft")
        marks = F.when(turn % 2 == 1, F.array(F.struct(F.lit(1).alias("number"), F.when(F.lit(new), 10 + turn % 3).otherwise(10).alias("char_offset"))))
        marks = marks if new else F.coalesce(marks, F.array().cast("array<struct<number:int,char_offset:bigint>>"))
        line = F.struct(F.concat(F.lit("l"), turn).alias("line_id"), text.alias("text_gold"), F.when((turn % 6 == 5) & F.lit(new), "n").alias("notes"), status.alias("review_status"), marks.alias("markers"))
        note = F.struct(F.concat(F.lit("fn"), turn).alias("footnote_id"), F.col("role").alias("text_gold"), F.when((turn % 8 == 1) & F.lit(new), "gloss").otherwise("citation").alias("kind"), turn.alias("marker_number"))
        there = turn % 5 != (3 if new else 4)
        of = lambda x, when: F.array_sort(F.collect_list(F.when(when, x)))
        regions = F.struct(of(line, body & there).alias("body"), of(line, ~body & there).alias("marginalia"))
        pages = table(spark, d, "conversations").where(F.col("conv_id") % 10 != (8 if new else 9)).groupBy("conv_id").agg(regions.alias("regions"), of(note, ~body & (turn != (5 if new else 3))).alias("footnotes"))
        c = F.col("conv_id")
        meta = F.struct(F.when((c % 2 == 0) & F.lit(new), "locked").otherwise("draft").alias("review_status"), F.concat(F.lit("r"), c % 3).alias("reviewer"))
        own = [R.page_id(c).alias("page_id"), c.alias("page_num"), F.when((c % 4 == 1) & F.lit(new), "s2").otherwise("s1").alias("section_id"), F.when((c % 3 == 0) & F.lit(new), "1687").alias("edition")]
        return pages.select(*own, meta.alias("meta"), "regions", "footnotes")

    return side(False), side(True)


def _snapshot_sql() -> str:
    def side(new: bool) -> str:
        """Fields of one side as (page_id, scope, target_id, field, v), and its footnotes as (page_id, target_id, node)."""
        then = lambda when, x, y: f"CASE WHEN {when} THEN {x} ELSE {y} END" if new else y
        c = f"(SELECT *, printf('p%04d', conv_id) AS page_id FROM conversations WHERE conv_id % 10 <> {8 if new else 9})"
        page = {"page_num": "conv_id::VARCHAR", "section_id": then("conv_id % 4 = 1", "'\"s2\"'", "'\"s1\"'"), "edition": then("conv_id % 3 = 0", "'\"1687\"'", "NULL")}
        line = {"text_gold": f"to_json({then('turn % 3 = 1', "text || '!'", 'text')})::VARCHAR", "notes": then("turn % 6 = 5", "'\"n\"'", "NULL"), "review_status": then("turn % 4 = 2", "'\"locked\"'", "'\"draft\"'")}
        note = {"text_gold": "to_json(role)::VARCHAR", "kind": then("turn % 8 = 1", "'\"gloss\"'", "'\"citation\"'"), "marker_number": "turn::VARCHAR"}
        lines, notes = f"turn % 5 <> {3 if new else 4}", f"role <> 'user' AND turn <> {5 if new else 3}"
        rows = [f"SELECT DISTINCT page_id, 'page', page_id, '{f}', {v} FROM {c}" for f, v in page.items()]
        rows.append(f"SELECT DISTINCT page_id, 'page_meta', page_id, 'review_status', {then('conv_id % 2 = 0', "'\"locked\"'", "'\"draft\"'")} FROM {c}")
        rows += [f"SELECT page_id, 'line', 'l' || turn, '{f}', {v} FROM {c} WHERE {lines}" for f, v in line.items()]
        rows.append(f"SELECT page_id, 'body_marker', 'l' || turn, 'markers', CASE WHEN turn % 2 = 1 THEN '[{{\"number\":1,\"char_offset\":' || {'10 + turn % 3' if new else '10'} || '}}]' END FROM {c} WHERE {lines}")
        rows += [f"SELECT page_id, 'footnote', 'fn' || turn, '{f}', {v} FROM {c} WHERE {notes}" for f, v in note.items()]
        node = "'{{\"footnote_id\":\"fn' || turn || '\",\"text_gold\":' || {} || ',\"kind\":' || {} || ',\"marker_number\":' || turn || '}}'".format(note["text_gold"], note["kind"])
        n = "n" if new else "o"
        return f"f{n}(page_id, scope, target_id, field, v) AS ({' UNION ALL '.join(rows)}), x{n} AS (SELECT page_id, 'fn' || turn AS target_id, {node} AS node FROM {c} WHERE {notes})"

    return f"""WITH {side(False)}, {side(True)}, p AS (SELECT printf('p%04d', conv_id) AS page_id, 'r' || any_value(conv_id % 3) AS reviewer FROM conversations WHERE conv_id % 10 <> 8 GROUP BY conv_id),
changed AS (SELECT page_id, scope, target_id, field, fo.v AS before, fn.v AS after FROM fo FULL JOIN fn USING (page_id, scope, target_id, field) WHERE fo.v IS DISTINCT FROM fn.v),
kept AS (SELECT * FROM changed WHERE scope IN ('page', 'page_meta') OR (page_id, scope, target_id) IN (SELECT (page_id, scope, target_id) FROM fn)
UNION ALL SELECT page_id, 'footnote', target_id, '_added', NULL, node FROM xn ANTI JOIN xo USING (page_id, target_id) UNION ALL SELECT page_id, 'footnote', target_id, '_deleted', node, NULL FROM xo ANTI JOIN xn USING (page_id, target_id))
SELECT kept.*, coalesce(reviewer, '') AS reviewer FROM kept LEFT JOIN p USING (page_id)"""


@query(_snapshot_sql())
def cdc_diff(spark, d):
    return SN.nested_diff(*_snapshots(spark, d))


@query("""WITH b AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0), a AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 15 <> 0),
j AS (SELECT c_custkey, b.c_name AS bn, a.c_name AS an, b.c_mktsegment AS bm, a.c_mktsegment AS am, b.c_name IS NULL AS new, a.c_name IS NULL AS gone FROM b FULL JOIN a USING (c_custkey))
SELECT c_custkey, 'c_name' AS field, bn AS before, an AS after FROM j WHERE NOT gone AND bn IS DISTINCT FROM an UNION ALL SELECT c_custkey, 'c_mktsegment', bm, am FROM j WHERE NOT gone AND bm IS DISTINCT FROM am UNION ALL SELECT c_custkey, '_added', NULL, NULL FROM j WHERE new UNION ALL SELECT c_custkey, '_deleted', NULL, NULL FROM j WHERE gone""")
def cdc_diff_flat(spark, d):
    c = table(spark, d, "customer")
    after = c.where("c_custkey % 15 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, "MOVED").otherwise(F.col("c_mktsegment")))
    return C.diff(c.where("c_custkey % 10 <> 0"), after, ["c_custkey"], ["c_name", "c_mktsegment"])


@query("SELECT conv_id, count(*) + 1 AS versions, CASE WHEN conv_id % 2 = 0 THEN 'machine_draft' ELSE 'final' END AS status FROM conversations GROUP BY conv_id")
def append_history_version(spark, d):
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("h")).withColumn("status", F.when(F.col("conv_id") % 2 == 0, "pending").otherwise("final"))
    x = C.append_history(x, "h", F.struct((R.try_last(F.col("h"))["turn"] + 1).alias("turn"), F.lit("new").alias("text")), "status")
    return x.select("conv_id", F.size("h").cast("long").alias("versions"), "status")


@query("SELECT s_suppkey, s_name, CASE WHEN c_custkey IS NOT NULL THEN c_acctbal ELSE s_acctbal END AS s_acctbal FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey AND c_custkey % 2 = 0")
def metadata_refresh(spark, d):
    new = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_acctbal").alias("s_acctbal"))
    return C.refresh(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), new, "s_suppkey", ["s_acctbal"])


_LOGGED = "(SELECT DISTINCT doc_id FROM labels WHERE {})"


@query(f"""SELECT 'complete_only' AS policy, doc_id FROM documents WHERE doc_id NOT IN {_LOGGED.format("toxic <> 1 AND quality = 1 AND doc_id % 7 <> 0")}
UNION ALL SELECT 'any_row', doc_id FROM documents WHERE doc_id NOT IN {_LOGGED.format("toxic <> 1")}""")
def idempotent_resume(spark, d):
    """Labels as the log of an earlier run: good ones are done, bad ones errors, some results are empty, toxic ones are torn lines; what is left under both policies."""
    kind = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("error", StringType())])
    row = F.to_json(F.struct("doc_id", F.when(F.col("doc_id") % 7 != 0, "x").otherwise(" ").alias("text"), F.when(F.col("quality") != 1, "late").alias("error")))
    path = fresh_path(spark, "log")
    table(spark, d, "labels").select(F.when(F.col("toxic") == 1, F.left(row, F.length(row) - 3)).otherwise(row)).write.text(path)
    log, work = resume.load(spark, path, kind, "doc_id", result="text"), table(spark, d, "documents").select("doc_id")
    left = [resume.remaining(work, log, "doc_id", p).select(F.lit(p).alias("policy"), "doc_id") for p in resume.POLICIES]
    return left[0].union(left[1])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlogged_work(spark, d):
    return C.remaining(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", F.lit(True))


@query("SELECT doc_id FROM documents WHERE doc_id % 4 = 3")
def detect_and_rerun(spark, d):
    asked = iter((0, 1, 2))
    docs = table(spark, d, "documents").select("doc_id")
    return C.rerun_missing(docs, "doc_id", lambda left, a=asked: (lambda k: left.where(F.col("doc_id") % 4 == k))(next(a)))[1]


@query("SELECT o_orderkey, 'o_orderstatus' AS field, o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT o_orderkey, 'o_custkey', o_custkey::VARCHAR FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 50 <> 0)")
def payload_validator(spark, d):
    o = table(spark, d, "orders")
    return C.violations(o, "o_orderkey", {"o_orderstatus": ["F", "O"]}).union(C.dangling(o, "o_orderkey", "o_custkey", table(spark, d, "customer").where("c_custkey % 50 <> 0"), "c_custkey"))


# --- Composite analytics -------------------------------------------------------------------------------------------


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as segments: a turn's text as Latin, the next turn's as English."""
    nxt = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    x = table(spark, d, "conversations").select(F.format_string("p%04d_%d", "conv_id", "turn").alias("segment_id"), F.format_string("p%04d", "conv_id").alias("page_id"), F.col("turn").cast("int").alias("seq"), F.col("text").alias("latin"), nxt.alias("english"))
    return validators.prepared(x)


_SEG = "(SELECT printf('p%04d_%d', conv_id, turn) AS segment_id, conv_id, turn, text AS latin, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS english FROM conversations)"


@query(f"SELECT segment_id, CASE WHEN trim(coalesce(english, '')) = '' THEN 'EMPTY' ELSE 'LATIN_VERBATIM' END AS flag FROM {_SEG} WHERE trim(latin) <> '' AND (trim(coalesce(english, '')) = '' OR lower(english) = lower(latin))")
def trivial_output_validator(spark, d):
    return validators.trivial(_segments(spark, d)).select("segment_id", "flag")


@query()
def numeral_validator(spark, d):
    return validators.numerals(_segments(spark, d))


@query()
def citation_validator(spark, d):
    return validators.citations(_segments(spark, d), validators.citation_rules(spark))


#: Segments with markers on both sides, of which some are lost, invented or said twice.
_MARKED_LA, _MARKED_EN = "replace(replace(latin, 'er ', 'er^a '), 'en ', 'en^b ')", "replace(replace(english, 'er ', 'er^a '), 'un', 'un^c ')"
#: Segments with Greek on both sides, accents kept or lost, with a cue after it or a bracket near by, or neither.
_GREEK_LA = "replace(replace(replace(latin, 'er ', 'er λόγος id est '), 'en ', 'en ἀρχή '), 'is ', 'is τοῦ θεοῦ ')"
_GREEK_EN = "replace(replace(replace(english, 'er ', 'er λογος '), 'on ', 'on αρχη '), 'ta', 't[a')"


@query(f"""WITH s AS (SELECT segment_id, conv_id, turn, regexp_extract_all({_MARKED_LA}, '\\^([a-z])\\b', 1) AS l, regexp_extract_all(coalesce({_MARKED_EN}, ''), '\\^([a-z])\\b', 1) AS e FROM {_SEG} WHERE trim(latin) <> ''),
n AS (SELECT *, flatten(list(l) OVER w) AS nl, flatten(list(e) OVER w) AS ne FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT segment_id, 'MARKER_DROPPED' AS flag, 'high' AS severity, unnest(list_filter(l, lambda x: NOT list_contains(ne, x))) AS marker_id FROM n
UNION ALL SELECT segment_id, 'MARKER_HALLUCINATED', 'high', unnest(list_filter(list_distinct(e), lambda x: NOT list_contains(nl, x))) FROM n
UNION ALL SELECT segment_id, 'MARKER_DUPLICATED', 'medium', unnest(list_filter(list_distinct(e), lambda x: len(list_filter(e, lambda y: y = x)) > 1)) FROM n""")
def marker_validator(spark, d):
    x = _segments(spark, d).withColumns({"latin": F.expr(_MARKED_LA), "english": F.expr(_MARKED_EN)})
    return validators.markers(x).select("segment_id", "flag", "severity", "marker_id")


@query()
def greek_validator(spark, d):
    x = _segments(spark, d).withColumns({"latin": F.expr(_GREEK_LA), "english": F.expr(_GREEK_EN)})
    return validators.greek(x, glosses=True)


def _terms(spark: SparkSession) -> DataFrame:
    rows = [("the", r"\bthe\b", ["with", "from"], ["hated"], None), ("and", r"\band\b", ["this", "that"], ["worthless"], "scripture")]
    return readers.glossary(spark.createDataFrame(rows, "term string, latin_pattern string, approved array<string>, banned array<string>, category string"))


@query()
def glossary_validator(spark, d):
    return validators.glossary(_segments(spark, d), _terms(spark))


_AS_WORD = "'(?i)(^|[^\\p{{L}}\\p{{N}}_])' || {0} || '($|[^\\p{{L}}\\p{{N}}_])'"


@query(f"""WITH s AS (SELECT segment_id, latin, array_to_string(list(coalesce(english, '')) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), ' ') AS en FROM {_SEG} WHERE trim(latin) <> ''),
h AS (SELECT segment_id, term, v FROM s JOIN (VALUES ('the', 'with'), ('the', 'from'), ('and', 'this'), ('and', 'that')) t(term, v) ON regexp_matches(latin, {_AS_WORD.format('term')}) AND regexp_matches(en, {_AS_WORD.format('v')})),
n AS (SELECT term, v, count(DISTINCT segment_id) AS n FROM h GROUP BY 1, 2)
SELECT term, count(*) AS variants, sum(n)::BIGINT AS segments FROM n GROUP BY 1 HAVING count(*) > 1""")
def glossary_drift(spark, d):
    return validators.glossary_drift(_segments(spark, d), _terms(spark)).select("term", "variants", "segments")


@query("SELECT doc_id, 'digits' AS rule, unnest(regexp_extract_all(text, '[0-9]{3,}')) AS match FROM documents UNION ALL SELECT doc_id, 'marks', unnest(regexp_extract_all(text, '[!?]{2,}')) FROM documents")
def pattern_findings(spark, d):
    return validators.pattern_findings(table(spark, d, "documents"), "doc_id", "text", {"digits": "[0-9]{3,}", "marks": "[!?]{2,}"})


#: Texts in which the mechanical rules find something, and in which they are silenced.
_RULED = """CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat(replace(replace(replace(replace(replace(text, ' the ', ' Thee '), ' de ', ' Boadicea '), ' und ', ' De Trinitate '), ' and ', '^ab '), ' la ', ' LSJ '),
CASE WHEN doc_id % 13 = 0 THEN '```x~~~' ELSE '' END, CASE WHEN doc_id % 7 = 0 THEN ' Boudica *De Trinitate*' ELSE '' END) END"""


def _rules_sql() -> str:
    """Every rule as SQL; letters beyond ASCII become a q, so that word ends mean the same, and places stay."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    shaped = f"(SELECT doc_id, t, regexp_replace(t, '{_WIDE}', 'q', 'g') AS w FROM (SELECT doc_id, {_RULED} AS t FROM documents))"
    parts = []
    for r in rules.RULES:
        p = quoted(r.pattern.replace("\\Z", "\\z"))
        note = " || hit || ".join(quoted(x) for x in r.note.split("{hit}"))
        hits = f"SELECT doc_id, t, regexp_extract_all(w, {p}) AS m, regexp_split_to_array(w, {p}) AS s FROM {shaped} WHERE regexp_matches(w, {p})"
        if r.unless:
            hits += f" AND NOT regexp_matches(w, {quoted(r.unless)})"
        each = f"SELECT doc_id, t, m[i] AS hit, (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::INTEGER AS a FROM (SELECT *, unnest({'range(1, len(m) + 1)' if r.every else '[1]'}) AS i FROM ({hits}))"
        if r.name == "empty_english":
            each = f"SELECT doc_id, t, '' AS hit, 0 AS a FROM {shaped} WHERE t = ''"
        parts.append(f"SELECT doc_id, '{r.name}' AS rule, a, hit, t, {note} AS note FROM ({each})")
    cut = "replace(t[greatest(a - 24, 0) + 1 : a + length(hit) + 24], chr(10), ' ')"
    return f"""SELECT doc_id, rule, a AS start, (a + length(hit))::INTEGER AS "end", CASE WHEN hit = '' THEN '' ELSE (CASE WHEN a > 24 THEN '…' ELSE '' END) || {cut} || (CASE WHEN a + length(hit) + 24 < length(t) THEN '…' ELSE '' END) END AS snippet, note FROM ({' UNION ALL '.join(parts)})"""


def rule_findings(spark, d):
    return rules.findings(_shaped(spark, d, _RULED), ["doc_id"], "t")


_STOP = ["the", "and", "of", "to", "in"]


@query("""WITH c AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[.,;:!?()\\[\\]\\n]+')) AS c FROM documents), t AS (SELECT doc_id, unnest(regexp_extract_all(c, '\\p{L}{2,}')) AS word FROM c)
SELECT word, count(*) AS count, count(DISTINCT doc_id) AS pages FROM t GROUP BY word""")
def word_mining(spark, d):
    return mining.word_table(mining.clauses(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


@query("""WITH c AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[.,;:!?()\\[\\]\\n]+')) AS c FROM documents), t AS (SELECT doc_id, regexp_extract_all(c, '\\p{L}{2,}') AS t FROM c),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS phrase FROM t), a AS (SELECT split_part(phrase, ' ', 1) AS a, count(*) AS r FROM g GROUP BY 1), b AS (SELECT split_part(phrase, ' ', 2) AS b, count(*) AS k FROM g GROUP BY 1), n AS (SELECT sum(len(t)) AS n FROM t),
p AS (SELECT phrase, split_part(phrase, ' ', 1) AS a, split_part(phrase, ' ', 2) AS b, count(*) AS count, count(DISTINCT doc_id) AS pages FROM g GROUP BY 1 HAVING count(*) >= 2),
x AS (SELECT phrase, count, pages, count::DOUBLE AS o1, (r - count)::DOUBLE AS o2, (k - count)::DOUBLE AS o3, greatest(n - r - k + count, 0)::DOUBLE AS o4 FROM p JOIN a USING (a) JOIN b USING (b), n WHERE a NOT IN ('the','and','of','to','in') AND b NOT IN ('the','and','of','to','in')),
y AS (SELECT *, o1 + o2 + o3 + o4 AS s FROM x)
SELECT phrase, 2 AS n, count, pages, round(2 * (o1 * ln(o1 * s / ((o1 + o2) * (o1 + o3))) + CASE WHEN o2 > 0 THEN o2 * ln(o2 * s / ((o1 + o2) * (o2 + o4))) ELSE 0 END + CASE WHEN o3 > 0 THEN o3 * ln(o3 * s / ((o3 + o4) * (o1 + o3))) ELSE 0 END + CASE WHEN o4 > 0 THEN o4 * ln(o4 * s / ((o3 + o4) * (o2 + o4))) ELSE 0 END), 2) AS loglik FROM y""")
def log_likelihood_g2(spark, d):
    return mining.phrase_table(mining.clauses(table(spark, d, "documents"), "doc_id", "text"), "doc_id", _STOP, 2, 2, 2)


@query()
def phrase_mining(spark, d):
    return mining.phrase_table(mining.clauses(table(spark, d, "documents"), "doc_id", "text"), "doc_id", _STOP)


#: Texts in which some words are written as names are.
_NAMED = "replace(replace(replace(replace(text, ' and ', ' Arimathia '), ' is ', ' Josephus '), ' of ', ' Josepho '), ' und ', ' Glastonia ')"


@query()
def review_candidates(spark, d):
    shaped = table(spark, d, "documents").select("doc_id", F.expr(_NAMED).alias("t"))
    return candidates.review_candidates(mining.surface_clauses(shaped, "doc_id", "t"), "doc_id", _STOP)


@query()
def glossary_seed(spark, d):
    return candidates.glossary_seed(review_candidates(spark, d))


_WINNER = "CASE o_orderstatus WHEN 'F' THEN 'v1' WHEN 'O' THEN 'v0' WHEN 'P' THEN 'tie' END"


@query(f"""WITH j AS (SELECT o_orderpriority, {_WINNER} AS w, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS pick FROM orders), x AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (w = 'v0') AS v0_wins, count(*) FILTER (w = 'v1') AS v1_wins, count(*) FILTER (w = 'tie') AS ties, count(*) FILTER (w IS NULL) AS invalid, count(*) FILTER (pick = 'A') AS n_a, count(*) FILTER (pick = 'B') AS n_b FROM j GROUP BY 1),
y AS (SELECT *, v0_wins + v1_wins AS decided, v1_wins / (v0_wins + v1_wins) AS wr, ties / (v0_wins + v1_wins + ties) AS tr, invalid / n AS ir, abs(n_a / (n_a + n_b) - 0.5) AS pb FROM x)
SELECT o_orderpriority, n, v0_wins, v1_wins, ties, CASE WHEN decided = 0 OR ir >= 0.1 OR n_a + n_b = 0 THEN 'INSUFFICIENT' WHEN wr < 0.55 OR tr >= 0.4 OR pb >= 0.1 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM y""")
def ab_verdict(spark, d):
    s = F.col("o_orderstatus")
    x = table(spark, d, "orders").select("o_orderpriority", F.when(s == "F", "v1").when(s == "O", "v0").when(s == "P", "tie").alias("w"), F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B").alias("pick"))
    return decisions.ab_verdict(x, "w", "pick", ["o_orderpriority"]).select("o_orderpriority", "n", "v0_wins", "v1_wins", "ties", "verdict")


@query(f"SELECT count(*) AS n, round(avg(a.score), 6) AS score_a, round(avg(b.score), 6) AS score_b, round(avg(b.score) - avg(a.score), 6) AS score_delta, avg(b.score) - avg(a.score) >= 0.1 AS accepted FROM {_RUN.format('click')} a JOIN {_RUN.format('view')} b USING (user_id)")
def ablation_verdict(spark, d):
    x = decisions.ablation(_scores(spark, d, "click"), _scores(spark, d, "view"), "user_id", ["score"])
    return x.select("n", *[F.round(c, 6).alias(c) for c in ("score_a", "score_b", "score_delta")], "accepted")


@query("SELECT event_type, abs(avg(value) - 20) <= 5 AS passed FROM events GROUP BY event_type")
def generalization_gate(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(decisions.within(F.avg("value"), 20.0, 5.0).alias("passed"))


@query("SELECT count(*) FILTER ((c_acctbal - 4500) * (c_custkey % 7 - 3) > 0) AS agree, count(*) FILTER ((c_acctbal - 4500) * (c_custkey % 7 - 3) < 0) AS disagree, round(count(*) FILTER ((c_acctbal - 4500) * (c_custkey % 7 - 3) > 0) / count(*) FILTER ((c_acctbal - 4500) * (c_custkey % 7 - 3) <> 0), 9) AS rate FROM customer")
def judge_agreement(spark, d):
    x = table(spark, d, "customer").select((F.col("c_acctbal") - 4500).alias("a"), (F.col("c_custkey") % 7 - 3).alias("b"))
    return decisions.agreement(x, "a", "b").withColumn("rate", F.round("rate", 9))


@query(f"SELECT o_custkey, count(*) AS pairings, count(*) FILTER (o_orderstatus = 'O') AS v0, count(*) FILTER (o_orderstatus = 'F') AS v1, count(*) FILTER (o_orderstatus = 'P') AS equal, sum(o_orderkey % 5)::BIGINT AS swing FROM (SELECT *, {_WINNER} AS w FROM orders) GROUP BY o_custkey")
def spot_check_pools(spark, d):
    s = F.col("o_orderstatus")
    x = table(spark, d, "orders").select("o_custkey", F.when(s == "F", "v1").when(s == "O", "v0").when(s == "P", "tie").alias("w"), (F.col("o_orderkey") % 5).alias("swing"))
    return decisions.spot_check(x, "o_custkey", "w", "swing")


@query()
def monotone_span_alignment(spark, d):
    c = table(spark, d, "conversations").select("conv_id", F.when(F.col("role") == "user", "unit").otherwise("sentence").alias("side"), F.col("turn").alias("pos"), "text")
    return alignment.align(c, "conv_id", "side", "pos", "text")


@query("SELECT doc_id, coalesce(regexp_matches(text, '[0-9]{3,}$'), false) AS cluster FROM documents")
def trailing_cluster_detector(spark, d):
    text = F.regexp_replace("text", r"[0-9]{3,}$", "^a^b")
    return table(spark, d, "documents").select("doc_id", validators.trailing_cluster(text).alias("cluster"))


#: Answers of a placement pass: the token put where the text has its first blank, at the end, twice, into a changed text, or nowhere.
_ANSWER = """CASE doc_id % 5 WHEN 0 THEN concat(' ', substring(text, 1, strpos(concat(text, ' '), ' ') - 1), ' ^z  ', substring(text, strpos(concat(text, ' '), ' ') + 1)) WHEN 1 THEN concat(text, '^z')
WHEN 2 THEN concat('^z ', text, '^z') WHEN 3 THEN concat(upper(text), '^z') ELSE text END"""
_SPACED = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query(f"""WITH a AS (SELECT doc_id, text, {_ANSWER} AS r FROM documents), b AS (SELECT *, strpos(r, '^z') AS k FROM a), c AS (SELECT *, k > 0 AND {_SPACED.format("r[1 : k - 1] || r[k + 2 :]")} = {_SPACED.format("text")} AS placed FROM b)
SELECT doc_id, placed, md5(CASE WHEN placed THEN trim(r, chr(32) || chr(10)) ELSE rtrim(text, chr(32) || chr(10)) || '^z' END) AS text_md5 FROM c""")
def placement_validator(spark, d):
    x = table(spark, d, "documents").select("doc_id", "text", F.expr(_ANSWER.replace("strpos(concat(text, ' '), ' ')", "instr(concat(text, ' '), ' ')")).alias("r"))
    return x.select("doc_id", C.placed(F.col("text"), F.col("r"), F.lit("^z")).alias("placed"), F.md5(C.place_or_append(F.col("text"), F.col("r"), F.lit("^z"))).alias("text_md5"))


# --- More scans, filters, joins and page operators -----------------------------------------------------------------


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def json_array_scan(spark, d):
    path = fresh_path(spark, "array")
    x = table(spark, d, "nation").select("n_nationkey", "n_name")
    x.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("value")).write.text(path)
    return readers.json_array(spark, path, x.schema, "n_nationkey")


@query("SELECT r_regionkey AS page_num, r_name FROM region WHERE r_regionkey BETWEEN 1 AND 3")
def dir_scan_page_range(spark, d):
    path = fresh_path(spark, "pages")
    x = table(spark, d, "region").select("r_regionkey", "r_name")
    x.write.partitionBy("r_regionkey").json(path)
    schema = StructType([StructField("r_name", StringType())])
    rows = spark.read.schema(schema).json(path).withColumn("page_num", F.regexp_extract("_metadata.file_path", r"r_regionkey=([0-9]+)/", 1).try_cast("int"))
    return rows.where(R.in_range(F.col("page_num"), 1, 3)).select("page_num", "r_name")


@query("SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 100 - n_nationkey END, n_nationkey) AS place FROM nation ORDER BY place, n_nationkey")
def dir_scan_reading_order(spark, d):
    x = table(spark, d, "nation").withColumn("reading_order_index", F.when(F.col("n_nationkey") % 2 == 0, 100 - F.col("n_nationkey"))).withColumn("page_num", F.col("n_nationkey"))
    return readers.reading_order(x).select("n_nationkey", F.coalesce("reading_order_index", "page_num").alias("place"))


@query("SELECT r_name AS text FROM region WHERE r_regionkey <> 2")
def text_file_scan(spark, d):
    path = fresh_path(spark, "texts")
    x = table(spark, d, "region").select("r_regionkey", "r_name")
    writers.text_per_group(x, path, "r_regionkey", "r_name")
    rows = spark.read.text(path, wholetext=True).where("r_regionkey <> 2")
    return rows.select(F.trim(F.regexp_replace("value", "\n", "")).alias("text"))


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def alignment_load(spark, d):
    units = table(spark, d, "labels").groupBy("quality").agg(F.collect_set("doc_id").alias("ids"))
    return readers.needed_lines(units, table(spark, d, "documents").select("doc_id"), "ids", "doc_id")


@query("SELECT conv_id, turn FROM conversations")
def stale_file_guarded_read(spark, d):
    rows = spark.read.schema("key string, conv_id long, turn long, text string").json(_jsonl(spark, d))
    return readers.fresh_files(rows, F.current_timestamp() - F.expr("interval 1 hour")).select("conv_id", "turn")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_custkey % 5 = 0")
def page_or_line_locked_filter(spark, d):
    from .plans import pages as PP

    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("page_id"), F.when(F.col("o_orderstatus") == "F", "locked").alias("review_status"))
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("page_id"), F.when(F.col("c_custkey") % 5 == 0, "locked").alias("page_status"))
    return PP.locked(o, p).select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def locked_gate_filter(spark, d):
    from .plans import pages as PP

    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "locked").alias("review_status"))
    return table(spark, d, "lineitem").join(PP.locked(o), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_orderkey", "l_linenumber")


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user'")
def region_filter(spark, d):
    return table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn")


@query("SELECT doc_id, coalesce(max(quality) <= 0, false) OR coalesce(max(CASE WHEN toxic = 1 THEN NULL ELSE 3 END) <= 0, false) AS low FROM labels GROUP BY doc_id")
def rubric_threshold_any(spark, d):
    x = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").cast("string").alias("q"), F.max(F.when(F.col("toxic") == 1, None).otherwise("3")).alias("t"))
    m = F.create_map(F.lit("cf"), F.col("q"), F.lit("rf"), F.coalesce("t", F.lit("na")))
    return x.select("doc_id", R.any_rubric_at_most(m, 0).alias("low"))


@query("SELECT doc_id, coalesce(lang, source) AS unit FROM documents WHERE trim(text) <> '' AND doc_id IS NOT NULL")
def empty_row_filter(spark, d):
    x = table(spark, d, "documents").where(~R.blank(F.col("text")) & F.col("doc_id").isNotNull())
    return x.select("doc_id", F.coalesce("lang", "source").alias("unit"))


@query("SELECT item_id AS unit_id, text FROM benchmark UNION ALL SELECT doc_id, text FROM documents")
def column_rename_normalize(spark, d):
    both = table(spark, d, "benchmark").select(F.col("item_id").alias("chunk_id"), "text").unionByName(table(spark, d, "documents").select(F.col("doc_id").alias("unit_id"), "text"), allowMissingColumns=True)
    return both.select(F.coalesce("unit_id", "chunk_id").alias("unit_id"), "text")


@query("SELECT page_id, TRY_CAST(nullif(regexp_extract(url, 'p([0-9]+)', 1), '') AS INTEGER) AS page FROM pages")
def page_of_unit(spark, d):
    return table(spark, d, "pages").select("page_id", R.page_of_unit(F.col("url")).alias("page"))


@query("SELECT o_orderkey, coalesce(c_name, '') AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def left_lookup(spark, d):
    c = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, d, "orders").join(c, "o_custkey", "left").select("o_orderkey", F.coalesce("c_name", F.lit("")).alias("name"))


def _records(spark: SparkSession, d: str, most: int | None = None) -> DataFrame:
    """Conversations as OCR records: user turns as body, the others as footnotes anchored to the turn before. The marker stands at character 40; ``most`` keeps so many characters after it."""
    line = F.struct(
        F.col("turn").cast("int").alias("line_index"), F.when(F.col("role") == "user", "body").when(F.col("role") == "assistant", "footnote").otherwise("odd").alias("region"),
        F.concat(F.left("text", F.lit(40)), F.lit("^0"), F.substring("text", F.lit(41), F.length("text") if most is None else F.lit(most))).alias("text_raw_ocr"),
        F.lit("0").alias("marker_id"), (F.col("turn") - 1).cast("int").alias("marginalia_anchor_index"),
    )
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return x.select(R.page_id(F.col("conv_id")).alias("page_id"), F.col("conv_id").cast("int").alias("page_num"), "lines")


_LINES = """(SELECT printf('p%04d', conv_id) AS page_id, conv_id, turn, CASE role WHEN 'user' THEN 'body' WHEN 'assistant' THEN 'marginalia' ELSE 'body' END AS region, text, row_number() OVER (PARTITION BY conv_id, CASE role WHEN 'assistant' THEN 1 ELSE 0 END ORDER BY turn)::INTEGER AS seq FROM conversations)"""


@query(f"SELECT page_id, printf('%s_%s_l%04d', page_id, region, seq) AS line_id, text, 1 AS n_markers, length(left(text, 40))::INTEGER AS at FROM {_LINES}")
def scan_to_annotation(spark, d):
    from .plans import pages as PP

    x = PP.scan_lines(_records(spark, d))
    return x.select("page_id", "line_id", "text", F.size("markers").alias("n_markers"), F.col("markers")[0]["offset"].alias("at"))


@query(f"""WITH l AS {_LINES}, b AS (SELECT conv_id, turn, printf('%s_body_l%04d', page_id, seq) AS body_line_id, seq AS bs FROM l WHERE region = 'body'), m AS (SELECT l.*, b.body_line_id, b.bs FROM l LEFT JOIN b ON b.conv_id = l.conv_id AND b.turn = l.turn - 1 WHERE region = 'marginalia')
SELECT printf('%s_fn%04d', page_id, seq) AS footnote_id, body_line_id, row_number() OVER (PARTITION BY page_id ORDER BY bs NULLS LAST, seq)::INTEGER AS marker_number FROM m""")
def anchor_lookup_join(spark, d):
    from .plans import pages as PP

    return PP.anchored_notes(PP.scan_lines(_records(spark, d))).select("footnote_id", "body_line_id", "marker_number")


@query(f"""WITH l AS {_LINES}, n AS (SELECT page_id, count(*) AS notes FROM l WHERE region = 'marginalia' GROUP BY page_id) SELECT page_id, count(*) * any_value(notes) AS pairs FROM l JOIN n USING (page_id) GROUP BY page_id""")
def marker_lookup_join(spark, d):
    from .plans import pages as PP

    lines = PP.scan_lines(_records(spark, d))
    return PP.marker_symbols(lines, PP.anchored_notes(lines)).groupBy("page_id").agg(F.count("*").alias("pairs"))


@query("SELECT conv_id, printf('## p%04d', conv_id) || chr(10) || chr(10) || string_agg(text || chr(10) || chr(10) || role, chr(10) || chr(10) ORDER BY turn) AS markdown FROM conversations GROUP BY conv_id")
def page_markdown(spark, d):
    from .plans import pages as PP

    s = table(spark, d, "conversations").select(R.page_id(F.col("conv_id")).alias("page_id"), F.format_string("p%04d_l%04d", "conv_id", "turn").alias("segment_id"), F.col("turn").cast("int").alias("seq"), F.col("text").alias("latin"), F.col("role").alias("english"))
    return PP.bundles(s).select(F.regexp_extract("page_id", "([0-9]+)", 1).cast("long").alias("conv_id"), "markdown")


def _spanning_segments(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as sentences that share lines at their seams and may run over pages, and as footnotes on their markers, some without one."""
    c, t = F.col("conv_id"), F.col("turn")
    last = t == F.max(F.when(F.col("role") == "user", t)).over(Window.partitionBy("conv_id"))
    page, following, body = R.page_id(c), R.page_id(c + 1), F.col("role") == "user"
    line = lambda p, n: F.format_string("%s_body_l%04d", p, n)
    letter = lambda n: F.char(97 + n % 26)
    over = last & (c % 3 != 1)
    x = table(spark, d, "conversations").withColumns({"_over": over, "_next": following})
    return x.select(
        F.when(body, F.format_string("%s_l%04d", page, t)).otherwise(F.format_string("%s_fn_%02d", page, t)).alias("segment_id"), page.alias("page_id"), F.when(body, "body").otherwise("footnote").alias("segment_type"),
        F.when(c % 7 != 0, t.cast("int")).alias("seq"), F.concat("text", F.when(body, F.concat(F.lit("^"), letter(t))).otherwise("")).alias("latin"), F.concat("role", F.lit("^"), letter(t)).alias("english"),
        F.when(~body, F.when(c % 5 == 0, "9").otherwise(letter(t - 1))).alias("marker_id"), F.when(~body, F.concat(F.lit("seg_"), line(F.when(c % 10 == 5, "p9999").otherwise(page), t - 1))).alias("body_segment_id"),
        F.when(body & F.col("_over"), F.array(page, "_next")).alias("spans_pages"),
        F.when(body, F.concat(F.array(line(page, t)), F.when(F.col("_over"), F.array(line(F.col("_next"), F.lit(0)))).otherwise(F.array(line(page, t + 1))))).alias("source_line_ids"),
    )


def _bundle_sql() -> str:
    """Bundles as SQL: claims of carets and lines by rank, then texts in order."""
    page = "printf('p%04d', {})".format
    line = lambda c, t: f"printf('p%04d_body_l%04d', {c}, {t})"
    link = "[n.segment_id FOR n IN notes IF n.marker_id = s][-1]"
    up = lambda text, back: (
        f"(SELECT string_agg(p || coalesce('<sup' || {back} || '>' || coalesce('<a href=\"#fn-' || {link} || '\">' || s || '</a>', s) || '</sup>', ''), '' ORDER BY i) FROM (SELECT i, regexp_split_to_array({text}, '\\^[A-Za-z0-9]{{1,2}}')[i] AS p, regexp_extract_all({text}, '\\^([A-Za-z0-9]{{1,2}})', 1)[i] AS s FROM (SELECT unnest(range(1, len(regexp_split_to_array({text}, '\\^[A-Za-z0-9]{{1,2}}')) + 1)) AS i)))"
    )
    back = "' id=\"fnref-' || page_id || '-' || s || '\"'"
    plain = lambda c: f"regexp_replace({c}, '\\^[A-Za-z0-9]{{1,2}}', '', 'g')"
    return f"""WITH c AS (SELECT *, {page('conv_id')} AS page_id, role = 'user' AS body, role = 'user' AND conv_id % 3 <> 1 AND turn = max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS over FROM conversations),
b AS (SELECT page_id, conv_id, turn, over, printf('%s_l%04d', page_id, turn) AS segment_id, CASE WHEN conv_id % 7 <> 0 THEN turn ELSE 1073741824 END AS n, text || '^' || chr(97 + (turn % 26)::INTEGER) AS latin, role || '^' || chr(97 + (turn % 26)::INTEGER) AS english, {line('conv_id', 'turn')} AS l1, CASE WHEN over THEN {line('conv_id + 1', '0')} ELSE {line('conv_id', 'turn + 1')} END AS l2, CASE WHEN over THEN {page('conv_id + 1')} END AS later FROM c WHERE body),
f AS (SELECT page_id, turn, conv_id, printf('%s_fn_%02d', page_id, turn) AS segment_id, CASE WHEN conv_id % 5 = 0 THEN '9' ELSE chr(97 + ((turn - 1) % 26)::INTEGER) END AS marker_id, {line("CASE WHEN conv_id % 10 = 5 THEN 9999 ELSE conv_id END", 'turn - 1')} AS anchor, text AS latin, role || '^' || chr(97 + (turn % 26)::INTEGER) AS english FROM c WHERE NOT body),
claims AS (SELECT l1 AS line, {{'h': page_id, 'n': n, 'i': segment_id, 'p': 0}} AS r FROM b UNION ALL SELECT l2, {{'h': page_id, 'n': n, 'i': segment_id, 'p': 1}} FROM b), lines AS (SELECT line, min(r) AS r FROM claims GROUP BY line),
touched AS (SELECT page_id AS page, regexp_extract_all(latin, '\\^([A-Za-z0-9]{{1,2}})', 1) AS s, {{'h': page_id, 'n': n, 'i': segment_id}} AS r FROM b UNION ALL SELECT later, regexp_extract_all(latin, '\\^([A-Za-z0-9]{{1,2}})', 1), {{'h': page_id, 'n': n, 'i': segment_id}} FROM b WHERE later IS NOT NULL),
carets AS (SELECT page, symbol, min(r).h AS home FROM (SELECT page, r, unnest(s) AS symbol FROM touched) GROUP BY page, symbol),
homes AS (SELECT f.*, r, coalesce(home, r.h, f.page_id) AS goes_to FROM f LEFT JOIN carets ON page = f.page_id AND symbol = marker_id LEFT JOIN lines ON line = anchor),
notes AS (SELECT goes_to AS page_id, list({{'segment_id': segment_id, 'marker_id': marker_id, 'latin': latin, 'english': english}} ORDER BY r IS NULL, r, CASE WHEN conv_id % 7 <> 0 THEN 0 ELSE 1 END, turn, segment_id) AS notes FROM homes GROUP BY goes_to),
cont AS (SELECT later AS page_id, min({{'h': page_id, 'n': n, 'i': segment_id}}) AS k FROM b WHERE later IS NOT NULL GROUP BY later),
pages AS (SELECT DISTINCT page_id FROM b UNION SELECT page_id FROM notes), j AS (SELECT pages.page_id, coalesce(notes, []) AS notes, k FROM pages LEFT JOIN notes USING (page_id) LEFT JOIN cont USING (page_id)),
rows AS (SELECT b.page_id, CASE WHEN conv_id % 7 <> 0 THEN 0 ELSE 1 END AS o, turn, segment_id, l1, '<a id=\"line-' || b.page_id || '-' || printf('l%04d', turn) || '\"></a>**LA**  ' || {up('latin', back)} || chr(10) || chr(10) || '**EN**  ' || {up('english', "''")} || CASE WHEN later IS NOT NULL THEN chr(10) || chr(10) || '*⟶ Runs on to ' || later || '; translated whole here.*' ELSE '' END AS md FROM b JOIN j USING (page_id)),
text AS (SELECT page_id, list(segment_id ORDER BY o, turn) AS ids, string_agg(md, chr(10) || chr(10) ORDER BY o, turn) AS md, arg_min(l1, turn) AS first FROM rows GROUP BY page_id),
feet AS (SELECT page_id, list(n.segment_id ORDER BY i) AS ids, string_agg('<a id=\"fn-' || n.segment_id || '\"></a>**<a href=\"#fnref-' || page_id || '-' || n.marker_id || '\">^' || n.marker_id || '</a>**  *LA:* ' || {plain('n.latin')} || chr(10) || chr(10) || '**EN:** ' || {plain('n.english')}, chr(10) || chr(10) ORDER BY i) AS md FROM (SELECT page_id, unnest(notes) AS n, generate_subscripts(notes, 1) AS i FROM j) GROUP BY page_id)
SELECT j.page_id, coalesce(array_to_string(text.ids, ' '), '') AS body, coalesce(array_to_string(feet.ids, ' '), '') AS notes, k.h AS from_page,
rtrim(concat_ws(chr(10) || chr(10), '# Page ' || j.page_id, '## Interlinear', CASE WHEN k IS NOT NULL THEN '*⟵ First lines: the end of the last sentence of ' || k.h || ' (' || k.i || '). ' || CASE WHEN text.md IS NULL THEN 'No sentence begins on this page.' ELSE 'This page''s own text begins at ' || regexp_extract(first, '_(l[0-9]+)$', 1) || '.' END || '*' END, text.md, CASE WHEN feet.md IS NOT NULL THEN '## Footnotes' END, feet.md), ' ') || chr(10) AS markdown
FROM j LEFT JOIN text USING (page_id) LEFT JOIN feet USING (page_id)"""


@query(_bundle_sql())
def page_bundle_renderer(spark, d):
    x = bundles.bundled(_spanning_segments(spark, d))
    ids = lambda c: F.array_join(F.transform(c, lambda s: s["segment_id"]), " ")
    return x.select("page_id", ids("body").alias("body"), ids("notes").alias("notes"), F.col("continued.from_page").alias("from_page")).join(bundles.markdown(x), "page_id")


@query("SELECT doc_id, max(quality) AS score, CASE WHEN max(quality) = 0 THEN 2 ELSE 1 END AS versions FROM labels GROUP BY doc_id")
def fix_application(spark, d):
    from .plans import pages as PP

    s = table(spark, d, "labels").groupBy(F.col("doc_id").alias("segment_id")).agg(F.max("quality").alias("score"))
    h = F.array(F.struct(F.lit(1).alias("version"), F.lit("draft").alias("stage"), F.lit("x").alias("english")))
    fixes = s.select("segment_id", F.lit("y").alias("proposed"), F.lit(False).alias("no_change"), F.lit(None).cast("string").alias("error"), "score")
    out = PP.apply_fixes(s.withColumn("history", h), fixes, 0)
    return out.select(F.col("segment_id").alias("doc_id"), "score", F.size("history").alias("versions"))


@query("SELECT q AS score, count(*) AS units, count(*) FILTER (f) AS flagged FROM (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) LEFT JOIN (SELECT DISTINCT doc_id, true AS f FROM documents WHERE regexp_matches(text, '[0-9]{16}')) USING (doc_id) GROUP BY q")
def validator_coverage_join(spark, d):
    from .plans import pages as PP

    s = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("score"))
    return PP.coverage(s, table(spark, d, "documents").where(F.col("text").rlike("[0-9]{16}")), "doc_id")


@query("SELECT doc_id, max(quality) AS score FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id HAVING max(quality) <= 0 ORDER BY score, doc_id")
def repair_queue(spark, d):
    from .plans import pages as PP

    s = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("score")).withColumn("error", F.lit(None).cast("string"))
    return PP.repair_queue(s, table(spark, d, "documents").select("doc_id"), "doc_id", 0).select("doc_id", "score")


@query(f"SELECT conv_id, turn, CASE WHEN e IS NULL THEN length(a) / 100.0 END::DOUBLE AS score, e AS error FROM (SELECT *, CASE WHEN coalesce(trim(a), '') = '' THEN 'missing_source' WHEN coalesce(trim(b), '') = '' THEN 'missing_translation' END AS e FROM {_NEXT_TURNS})")
def external_scorer(spark, d):
    """The next turn stands for each turn's translation; last turns have none and are errors."""
    from .plans import pages as PP

    x = _next_turns(spark, d).withColumn("ref", F.col("b"))
    return PP.external_scores(x, lambda src, mt, ref: [len(s) / 100 for s in src], ["conv_id", "turn"], "a", "b", "ref")


@query("SELECT conv_id, turn, '[source]' || chr(10) || text || chr(10) || chr(10) || '[role]' || chr(10) || role AS prompt FROM conversations WHERE trim(text) <> ''")
def prompt_builders(spark, d):
    from .plans import pages as PP

    x = table(spark, d, "conversations").where(~R.blank(F.col("text")))
    return x.select("conv_id", "turn", PP.prompt({"source": F.col("text"), "none": F.lit(" "), "role": F.col("role")}).alias("prompt"))


@query("SELECT page_id, max(seq) + 1 AS next_ordinal FROM " + _LINES + " WHERE region = 'body' GROUP BY page_id")
def client_next_ordinal(spark, d):
    from .plans import pages as PP

    return PP.next_ordinal(PP.scan_lines(_records(spark, d)), "body")


@query()
def split_sentences_abbrev(spark, d):
    from .functions import pages as FP

    return table(spark, d, "documents").select("doc_id", F.size(FP.split_sentences(F.col("text"))).cast("long").alias("n"))


@query("""SELECT doc_id, array_to_string(regexp_extract_all(lower(strip_accents(replace(replace(replace(replace(replace(replace(coalesce(text, ''), 'ſ', 's'), 'æ', 'ae'), 'Æ', 'Ae'), 'œ', 'oe'), 'Œ', 'Oe'), '&', ' and '))), '[\\p{L}\\p{N}]+'), ' ') AS tokens FROM documents""")
def tokenize_fold(spark, d):
    from .functions import pages as FP

    return table(spark, d, "documents").select("doc_id", F.array_join(FP.fold_tokens(F.col("text")), " ").alias("tokens"))


@query("SELECT doc_id, strip_accents(text) AS text FROM documents")
def accent_strip(spark, d):
    from .functions import pages as FP

    return table(spark, d, "documents").select("doc_id", FP.strip_accents(F.col("text")).alias("text"))


@query("SELECT doc_id, regexp_matches(text, 'ae|AE|Æ|æ') AS has_ae, regexp_matches(text, '\\[[^\\]]+\\]|^[?*!†‡]\\s|\\bfn[0-9]+\\b') AS has_marker FROM documents")
def has_target_flags(spark, d):
    from .functions import pages as FP

    return table(spark, d, "documents").select("doc_id", *[c.alias(k) for k, c in FP.target_flags(F.col("text")).items()])


@query("""WITH t AS (SELECT regexp_extract_all(lower(text), '\\p{L}+') AS t FROM documents), g AS (SELECT n, unnest([array_to_string(t[i:i + n - 1], ' ') FOR i IN range(1, len(t) - n + 2)]) AS phrase FROM t, range(2, 7) r(n)), c AS (SELECT n, phrase, count(*) AS count FROM g GROUP BY n, phrase),
x AS (SELECT regexp_replace(phrase, ' [^ ]+$', '') AS phrase, count FROM c WHERE n > 2 UNION SELECT substr(phrase, strpos(phrase, ' ') + 1), count FROM c WHERE n > 2)
SELECT phrase, count FROM c WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.phrase = c.phrase AND x.count = c.count)""")
def maximal_repeat_dedup(spark, d):
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    return grams.maximal_repeats(table(spark, d, "documents").select(tokens.alias("t")), "t", 6)


@query("WITH t AS (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS t FROM documents), w AS (SELECT doc_id, unnest(t) AS s, generate_subscripts(t, 1) AS i FROM t) SELECT lower(s) AS word, arg_min(s, {'p': doc_id, 'i': i}) AS example FROM w GROUP BY 1")
def first_example(spark, d):
    w = table(spark, d, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("i", "example"))
    return W.first_per_key(w.withColumn("word", F.lower("example")), ["word"], "example", ["doc_id", "i"])


@query("SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 0 THEN p_size END, TRY_CAST(nullif(regexp_extract(p_name, '([0-9]+)[^0-9]*$', 1), '') AS INTEGER), 0) AS seq FROM part")
def seq_backfill_legacy(spark, d):
    return table(spark, d, "part").select("p_partkey", R.order_key(F.when(F.col("p_size") % 2 == 0, F.col("p_size")), F.col("p_name")).alias("seq"))


@query("SELECT status, count(*) AS n, count(*) FILTER (NOT no_change) AS n_real, count(*) FILTER (no_change) AS n_no_change FROM (SELECT o_orderstatus AS status, o_orderkey % 3 = 0 AS no_change FROM orders) GROUP BY status")
def report_totals(spark, d):
    x = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 3 == 0).alias("no_change"))
    return x.groupBy("status").agg(F.count("*").alias("n"), F.count_if(~F.col("no_change")).alias("n_real"), F.count_if("no_change").alias("n_no_change"))


@query("SELECT round(avg(a.score), 6) AS a, round(avg(b.score), 6) AS b, count(*) AS n FROM " + _RUN.format("click") + " a JOIN " + _RUN.format("purchase") + " b USING (user_id)")
def compared_averages(spark, d):
    x = J.left_compare(_scores(spark, d, "click"), _scores(spark, d, "purchase"), "user_id", "score").where("status = 'compared'")
    return x.agg(F.round(F.avg("value_a"), 6).alias("a"), F.round(F.avg("value_b"), 6).alias("b"), F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 4 <> c_nationkey % 4")
def stale_derivation_check(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey", (F.col("o_orderkey") % 4).alias("v")).agg(F.count("*")).select("o_custkey", F.create_map(F.col("o_custkey"), F.col("v").cast("long")).alias("used"))
    now = table(spark, d, "customer").select(F.col("c_custkey").alias("source"), (F.col("c_nationkey") % 4).cast("long").alias("version"))
    return C.stale(o, "used", now, "o_custkey", "source", "version")


@query(f"WITH s AS {_SEG} SELECT segment_id, 'EMPTY' AS reason, 1 AS floor_score FROM s WHERE english IS NULL AND trim(latin) <> ''")
def flag_bridge(spark, d):
    s = _segments(spark, d)
    return validators.repair_inputs(validators.trivial(s), s, ["EMPTY"]).select("segment_id", "reason", "floor_score")


@query("SELECT doc_id, row_number() OVER (ORDER BY length(text) DESC, doc_id)::INTEGER AS rank, length(text) AS chars FROM documents")
def page_profiling(spark, d):
    m = mining.page_metrics(table(spark, d, "documents"), ["doc_id"], "text").select("doc_id", F.col("chars").cast("long").alias("chars"))
    return W.rank_by_ranges(m, [F.col("chars").desc(), F.col("doc_id")]).select("doc_id", F.col("rank").cast("int").alias("rank"), "chars")


# --- Functions over whole tables, shaped so that what they look for occurs; tests hold them on literal rows ---------------


def _shaped(spark: SparkSession, d: str, shape: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """A table's key and ``t``, the text that ``shape``, which means the same in both engines, makes of its columns."""
    return table(spark, d, name).select(key, F.expr(shape).alias("t"))


def _twin(result: str, shape: str, name: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, {result} AS x FROM (SELECT {key}, {shape} AS t FROM {name})"


#: Shapes of texts: with carets, OCR readings, enclitics, numerals, Greek, notes.
_MARKED = "replace(replace(replace(text, 'e ', 'e^ab '), 't ', 't^9 '), ' de ', '^d de ')"
_MISREAD = "replace(replace(text, ' th', ' prz'), 'que ', 'quse ')"
_OPEN_C = "replace(replace(text, ' the ', ' CID '), ' de ', ' I2C, ')"
_ENCLITIC = "replace(text, 's ', 'que ')"
_NUMERAL_LA = "replace(replace(replace(text, ' the ', ' octavum '), ' de ', ' viginti '), ' and ', ' XIV ')"
_NUMERAL_EN = "replace(replace(replace(text, ' the ', ' twenty-third '), ' de ', ' seven '), ' and ', ' IIX ')"
_GREEKED = "replace(replace(text, ' the ', ' λόγος, ἀρχή '), ' de ', ' αβ ')"
_NOTED = "replace(text, ' the ', ' a[b]? ')"
_FOOTED = "replace(text, ' and ', '[FOOTNOTES]')"
#: Shapes of keys as numerals, headings, headers, citations and paths.
_LETTERS = "translate(CAST(o_orderkey AS STRING), '0123456789', 'IVXLCDMIVX')"
_SMALL = "translate(CAST(o_orderkey AS STRING), '0123456789', 'ivxlcdmivx')"
_HEADING = f"CASE WHEN o_orderkey % 3 = 0 THEN concat('CHAPTER ', {_LETTERS}, '.') WHEN o_orderkey % 3 = 1 THEN concat('CAPVT ', {_LETTERS}) WHEN o_orderkey % 2 = 0 THEN 'CAPVT SECVNDVM' ELSE 'text' END"
_HEADER = "CASE WHEN p_partkey % 3 = 0 THEN concat(p_size, ' ', p_name) WHEN p_partkey % 3 = 1 THEN concat(p_type, ' ', p_size) ELSE translate(CAST(p_size AS STRING), '0123456789', 'IVXLCDMIVX') END"
_CITATION = "concat(l_returnflag, lower(l_linestatus), '. ', l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN concat('.', l_suppkey) ELSE '' END)"
_PATH = "concat('/', p_brand, '/p', lpad(CAST(p_partkey % 10000 AS STRING), 4, '0'), CASE WHEN p_size % 2 = 0 THEN '/' ELSE '' END, 'f.json')"
_FENCED = "CASE WHEN event_id % 5 = 0 THEN 'none' ELSE concat('```json', chr(10), props, chr(10), '```') END"
#: A letter, mark or digit of no ASCII, for word ends of the twins, which see ASCII only.
_WIDE = "[\\x{00AA}\\x{00B5}\\x{00BA}\\x{00C0}-\\x{00D6}\\x{00D8}-\\x{00F6}\\x{00F8}-\\x{1FFF}\\x{2C00}-\\x{2DFF}\\x{3040}-\\x{D7FF}]"


query(_rules_sql())(rule_findings)


def _roman(s: str) -> str:
    """Value of Roman letters, as SQL."""
    value = lambda i: f"[1, 5, 10, 50, 100, 500, 1000][strpos('IVXLCDM', ({s})[{i}])]"
    later = f"list_max(list_transform(range(i, length({s}) + 1), lambda j: {value('j')}))"
    total = f"list_sum(list_transform(range(1, length({s}) + 1), lambda i: CASE WHEN {value('i')} < {later} THEN -{value('i')} ELSE {value('i')} END))"
    return f"(CASE WHEN regexp_matches({s}, '^[IVXLCDM]+$') AND {total} > 0 THEN {total}::INTEGER END)"


def _roman_strict(s: str) -> str:
    return f"(CASE WHEN {s} <> '' AND regexp_matches(upper({s}), '^M{{0,3}}(CM|CD|D?C{{0,3}})(XC|XL|L?X{{0,3}})(IX|IV|V?I{{0,3}})$') THEN {_roman(f'upper({s})')} END)"


def _map(values: dict[str, int]) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v}" for k, v in values.items()) + "}"


def _latin_sql() -> str:
    stems, names = "|".join(T.LATIN_ORDINALS), {w: v for v, ws in T.LATIN_CARDINALS.items() for w in ws.split()}
    t = f"regexp_replace(t, '{_WIDE}', 'q', 'g')"
    ordinal = f"list_transform(regexp_extract_all({t}, '(?i)\\b(?:{stems})(?:{T.ORDINAL_ENDINGS})\\b'), lambda x: {_map(T.LATIN_ORDINALS)}[regexp_extract(lower(x), '^({stems})(?:{T.ORDINAL_ENDINGS})$', 1)])"
    cardinal = f"list_transform(regexp_extract_all({t}, '(?i)\\b(?:{'|'.join(names)})\\b'), lambda x: {_map(names)}[lower(x)])"
    digits = f"list_transform(regexp_extract_all({t}, '\\b[0-9]{{1,9}}'), lambda x: x::INTEGER)"
    romans = f"list_transform(regexp_extract_all({t}, '\\b[IVXLCDM]{{2,}}\\b'), lambda x: {_roman('x')})"
    return f"array_to_string(list_sort({digits} || {romans} || {ordinal} || {cardinal}), ' ')"


def _english_sql(parts: bool) -> str:
    t = f"regexp_replace(t, '{_WIDE}', 'q', 'g')"
    compound = f"(?i)\\b(?:{'|'.join(T.TENS)})[-\\s](?:{'|'.join([*T.ORDINAL_ONES, *T.ONES])})\\b"
    values = f"list_transform(regexp_extract_all(lower(c), '[a-z]+'), lambda w: {_map(T.WORD_VALUE)}[w])"
    sums = f"flatten(list_transform(regexp_extract_all({t}, '{compound}'), lambda c: [list_sum({values})::INTEGER]{f' || {values}' if parts else ''}))"
    single = f"list_transform(regexp_extract_all(regexp_replace({t}, '{compound}', ' ', 'g'), '(?i)\\b(?:{'|'.join(T.WORD_VALUE)})\\b'), lambda x: {_map(T.WORD_VALUE)}[lower(x)])"
    digits = f"list_transform(regexp_extract_all({t}, '\\b[0-9]{{1,9}}'), lambda x: x::INTEGER)"
    romans = f"list_transform(regexp_extract_all({t}, '\\b[IVXLCDM]{{2,}}\\b'), lambda x: {_roman('x')})"
    return f"array_to_string(list_sort(list_distinct({digits} || {romans} || {sums} || {single})), ' ')"


def _forms_sql(n: str) -> str:
    """Digits, cardinal, ordinal and Roman numeral of a number, as SQL."""
    tens = f"{T.TENS}[{n} // 10 - 1]"
    cardinal = f"CASE WHEN {n} < 10 THEN {T.ONES}[{n}] WHEN {n} < 20 THEN {T.TEENS}[{n} - 9] WHEN {n} < 100 AND {n} % 10 = 0 THEN {tens} WHEN {n} < 100 THEN {tens} || '-' || {T.ONES}[{n} % 10] END"
    ordinal = f"CASE WHEN {n} < 10 THEN {T.ORDINAL_ONES}[{n}] WHEN {n} < 20 THEN {T.ORDINAL_TEENS}[{n} - 9] WHEN {n} < 100 AND {n} % 10 = 0 THEN {T.ORDINAL_TENS}[{n} // 10 - 1] WHEN {n} < 100 THEN {tens} || '-' || {T.ORDINAL_ONES}[{n} % 10] END"
    digits = [(1000, "M", "", ""), (100, "C", "D", "M"), (10, "X", "L", "C"), (1, "I", "V", "X")]
    place = lambda d, a, b, c: f"['', '{a}', '{a * 2}', '{a * 3}', '{a}{b}', '{b}', '{b}{a}', '{b}{a * 2}', '{b}{a * 3}', '{a}{c}'][{n} // {d} % 10 + 1]"
    roman = f"CASE WHEN {n} BETWEEN 1 AND 3999 THEN {' || '.join(place(*p) for p in digits)} END"
    return f"concat_ws(' ', {n}::VARCHAR, {cardinal}, {ordinal}, {roman})"


@query("SELECT doc_id, replace(replace(replace(replace(text, 'Æ', 'AE'), 'Ǣ', 'AE'), 'æ', 'ae'), 'ǣ', 'ae') AS x FROM documents")
def normalize_ligatures(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_ligatures(F.col("text")).alias("x"))


def _misread_sql() -> str:
    """The repairs one by one; word ends are a character that is no letter, mark or digit, or an end of the text."""
    edge, x = "[^\\p{L}\\p{M}\\p{N}_]", "t"
    for p, with_ in (("([Pp])rzedix", "\\2raedix"), ("([Pp])rz", "\\2rae"), ("([Pp])redic", "\\2raedic"), ("([Pp])refulg", "\\2raefulg"), ("([Pp])racept", "\\2raecept")):
        x = f"regexp_replace({x}, '(^|{edge}){p}', '\\1{with_}', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, '(^|{edge})([Qq])use({edge}|$)', '\\1\\2uae\\3', 'g')"
    x = f"regexp_replace(regexp_replace({x}, '(^|{edge})[Zz]tern', '\\1aetern', 'g'), 'terr[eé]({edge}|$)', 'terrae\\1', 'g')"
    return f"replace({x}, 'praeedix', 'praedix')"


@query(_twin(_misread_sql(), _MISREAD))
def normalize_ae_heuristics(spark, d):
    from .functions import pages as FP

    return _shaped(spark, d, _MISREAD).select("doc_id", FP.normalize_ae(F.col("t")).alias("x"))


@query(_twin("regexp_replace(regexp_replace(t, '\\b(?:CID|C1D)\\b', 'CIƆ', 'g'), '\\b(?:I2C|I2G)\\b', 'IƆC', 'g')", _OPEN_C))
def normalize_open_c_numerals(spark, d):
    from .functions import pages as FP

    return _shaped(spark, d, _OPEN_C).select("doc_id", FP.normalize_open_c(F.col("t")).alias("x"))


@query("SELECT doc_id, trim(regexp_replace(replace(replace(text, 'Æ', 'AE'), 'æ', 'ae'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS x FROM documents")
def compose_transforms(spark, d):
    return table(spark, d, "documents").select("doc_id", T.compose(T.normalize_ligatures, T.normalize_ws)(F.col("text")).alias("x"))


@query(_twin("regexp_replace(t, '\\^[A-Za-z0-9]{1,2}', '', 'g')", _MARKED))
def strip_carets(spark, d):
    return _shaped(spark, d, _MARKED).select("doc_id", T.strip_carets(F.col("t")).alias("x"))


@query(f"""WITH m AS (SELECT doc_id, {_MARKED} AS t FROM documents), p AS (SELECT doc_id, t, regexp_split_to_array(t, '\\^[A-Za-z0-9*†‡§]') AS p, regexp_extract_all(t, '\\^([A-Za-z0-9*†‡§])', 1) AS s FROM m),
e AS (SELECT doc_id, unnest(s) AS s, unnest(list_transform(p[1:len(s)], lambda x: length(x))) AS n, generate_subscripts(s, 1) AS i FROM p), o AS (SELECT doc_id, i, s || sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS m FROM e),
g AS (SELECT doc_id, string_agg(m, '|' ORDER BY i) AS markers FROM o GROUP BY doc_id) SELECT doc_id, array_to_string(p, '') AS x, coalesce(markers, '') AS markers FROM p LEFT JOIN g USING (doc_id)""")
def extract_inline_markers(spark, d):
    from .functions import pages as FP

    x = _shaped(spark, d, _MARKED).select("doc_id", FP.inline_markers(F.col("t")).alias("m"))
    return x.select("doc_id", F.col("m.text").alias("x"), F.array_join(F.transform("m.markers", lambda k: F.concat(k["symbol"], k["offset"].cast("string"))), "|").alias("markers"))


@query("SELECT doc_id, substring(text, 1, 3) || '^a' || substring(text, 4, 96) || '^b' || substring(text, 100) AS x FROM documents")
def inject_markers(spark, d):
    ms = F.array(F.struct(F.lit(3).alias("offset"), F.lit("a").alias("symbol")), F.struct(F.lit(99).alias("offset"), F.lit("b").alias("symbol")))
    return table(spark, d, "documents").select("doc_id", T.inject_markers(F.col("text"), ms).alias("x"))


@query(_twin("regexp_replace(t, '\\^([A-Za-z0-9*†‡§])', '<sup><a href=\"#fn-\\1\">\\1</a></sup>', 'g')", _MARKED))
def carets_to_anchors(spark, d):
    return _shaped(spark, d, _MARKED).select("doc_id", T.caret_links(F.col("t")).alias("x"))


@query("""WITH s AS (SELECT doc_id, text, greatest(instr(text, ' and ') - 25, 0) AS lo, least(greatest(instr(text, ' and ') - 1, 0) + 29, length(text)) AS hi FROM documents)
SELECT doc_id, CASE WHEN lo > 0 THEN '…' ELSE '' END || substring(text, lo + 1, greatest(hi - lo, 0)) || CASE WHEN hi < length(text) THEN '…' ELSE '' END AS x FROM s""")
def clip_around(spark, d):
    start = F.greatest(F.instr("text", " and ") - 1, F.lit(0))
    return table(spark, d, "documents").select("doc_id", T.clip_around(F.col("text"), start, start + 5).alias("x"))


@query(_twin("regexp_replace(replace(lower(string_split(t, ' ')[-1]), 'ſ', 's'), '^[\\p{P}\\p{S}\\x20\\x09-\\x0D]+|[\\p{P}\\p{S}\\x20\\x09-\\x0D]+$', '', 'g')", "text"))
def normalize_catchword(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_catchword(F.substring_index("text", " ", -1)).alias("x"))


@query(_twin(f"array_to_string(flatten(list_transform(string_split(t, ' '), lambda w: CASE WHEN w LIKE '%que' AND w NOT IN ({', '.join(repr(w) for w in mining.NO_ENCLITIC)}) AND length(w) > 4 THEN [left(w, length(w) - 3), 'que'] ELSE [w] END)), ' ')", _ENCLITIC))
def split_enclitic_que(spark, d):
    cut = F.flatten(F.transform(F.split("t", " "), lambda w: T.split_enclitic(w, exceptions=tuple(mining.NO_ENCLITIC))))
    return _shaped(spark, d, _ENCLITIC).select("doc_id", F.array_join(cut, " ").alias("x"))


@query(_twin("array_to_string(list_transform(string_split(trim(regexp_replace(t, '[\\x20\\x09-\\x0D]+', ' ', 'g')), ' '), lambda w: regexp_replace(w, '^(.{3,30}?)(?:ibus|orum|arum|ae|us|um|es)$', '\\1')), ' ')", "text"))
def loose_key(spark, d):
    return table(spark, d, "documents").select("doc_id", mining.loose_key(T.normalize_ws(F.col("text")), "ibus|orum|arum|ae|us|um|es").alias("x"))


@query("SELECT doc_id, len(t) - 1 + greatest(len(t) - 2, 0) AS grams FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS t FROM documents) WHERE len(t) >= 2")
def ngrams(spark, d):
    t = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    return table(spark, d, "documents").select("doc_id", t.alias("t")).where(F.size("t") >= 2).select("doc_id", F.size(T.ngrams(F.col("t"), 2, 3)).cast("long").alias("grams"))


@query("WITH w AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}{3,}') AS w FROM documents)), f AS (SELECT doc_id, w, min(i) AS i FROM w WHERE w NOT IN ('the', 'and') GROUP BY 1, 2), g AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words FROM f GROUP BY 1) SELECT doc_id, coalesce(words, '') AS words FROM documents LEFT JOIN g USING (doc_id)")
def content_words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(T.content_words(F.col("text"), ["the", "and"]), " ").alias("words"))


@query(_twin(_roman("t"), _LETTERS, "orders", "o_orderkey"))
def roman_to_int(spark, d):
    return _shaped(spark, d, _LETTERS, "orders", "o_orderkey").select("o_orderkey", T.roman_to_int(F.col("t")).alias("x"))


@query(_twin(_roman_strict("t"), _SMALL, "orders", "o_orderkey"))
def roman_to_int_strict(spark, d):
    return _shaped(spark, d, _SMALL, "orders", "o_orderkey").select("o_orderkey", T.roman_to_int_strict(F.col("t")).alias("x"))


def _sorted_values(values: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(values), lambda v: v.cast("string")), " ")


@query(_twin(_latin_sql(), _NUMERAL_LA))
def extract_numerals_latin(spark, d):
    return _shaped(spark, d, _NUMERAL_LA).select("doc_id", _sorted_values(F.transform(T.latin_numerals(F.col("t")), lambda n: n["value"])).alias("x"))


@query(_twin(_english_sql(True), _NUMERAL_EN))
def extract_numerals_english(spark, d):
    return _shaped(spark, d, _NUMERAL_EN).select("doc_id", _sorted_values(T.english_numerals(F.col("t"), True)).alias("x"))


@query(_twin(_english_sql(False), _NUMERAL_EN))
def extract_numerals_english_v2(spark, d):
    return _shaped(spark, d, _NUMERAL_EN).select("doc_id", _sorted_values(T.english_numerals(F.col("t"), False)).alias("x"))


@query(f"SELECT p_partkey, {_forms_sql('p_partkey')} AS x FROM part")
def expected_forms(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(T.expected_forms(F.col("p_partkey")), " ").alias("x"))


_GREEK = "\\x{0370}-\\x{03FF}\\x{1F00}-\\x{1FFF}"


@query(_twin(f"array_to_string(list_filter(regexp_extract_all(t, '[{_GREEK}](?:[{_GREEK} ,''’ʼ]*[{_GREEK}])?'), lambda x: length(regexp_replace(x, '[^{_GREEK}]', '', 'g')) >= 3), '|')", _GREEKED))
def greek_spans(spark, d):
    return _shaped(spark, d, _GREEKED).select("doc_id", F.array_join(T.greek_spans(F.col("t")), "|").alias("x"))


_SCRIPTURE = "^((?:[123])?\\s?[A-Z][a-z]{1,7}\\.?)\\s+([0-9]+)(?:[.,:]\\s*([0-9]+(?:[-–][0-9]+)?))?"


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(t, '{_SCRIPTURE}') THEN 'scripture ' || regexp_extract(t, '{_SCRIPTURE}', 1) || ' ' || regexp_extract(t, '{_SCRIPTURE}', 2) || CASE WHEN regexp_extract(t, '{_SCRIPTURE}', 3) <> '' THEN ':' || regexp_extract(t, '{_SCRIPTURE}', 3) ELSE '' END ELSE 'unknown ' END AS x
FROM (SELECT l_orderkey, l_linenumber, {_CITATION} AS t FROM lineitem)""")
def classify_marginal(spark, d):
    from .functions import pages as FP

    c = FP.classify_marginal(F.expr(_CITATION))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws(" ", c["kind"], c["citation"]).alias("x"))


@query(_twin(f"CASE WHEN t = 'CAPVT SECVNDVM' THEN 2 WHEN t <> 'text' THEN {_roman_strict("regexp_extract(t, '^[A-Z]+ ([A-Z]+)', 1)")} END", _HEADING, "orders", "o_orderkey"))
def detect_heading(spark, d):
    from .functions import pages as FP

    return _shaped(spark, d, _HEADING, "orders", "o_orderkey").select("o_orderkey", FP.detect_chapter(F.col("t"), F.col("t").startswith("CH")).alias("x"))


@query(_twin("coalesce(nullif(regexp_extract(t, '^\\s*([0-9]{1,4})\\b', 1), ''), nullif(regexp_extract(t, '\\b([0-9]{1,4})\\s*$', 1), ''), CASE WHEN regexp_matches(trim(t), '(?i)^[ivxlcdm]+$') THEN lower(trim(t)) END)", _HEADER, "part", "p_partkey"))
def printed_page(spark, d):
    return _shaped(spark, d, _HEADER, "part", "p_partkey").select("p_partkey", T.printed_page(F.col("t")).alias("x"))


@query(_twin("CASE WHEN instr(t, '[FOOTNOTES]') > 0 THEN left(t, instr(t, '[FOOTNOTES]') - 1) || '/' || substring(t, instr(t, '[FOOTNOTES]') + 11) ELSE t END", _FOOTED))
def split_body_footnotes(spark, d):
    s = T.split_body_notes(F.col("t"))
    return _shaped(spark, d, _FOOTED).select("doc_id", F.concat_ws("/", s["body"], s["notes"]).alias("x"))


@query(_twin("trim(regexp_replace(t, '\\[([A-Za-z0-9]+)\\]\\??', '[fn-\\1]', 'g'))", _NOTED))
def clean_footnote_markers(spark, d):
    from .functions import pages as FP

    return _shaped(spark, d, _NOTED).select("doc_id", FP.clean_note_marks(F.col("t")).alias("x"))


@query(_twin("nullif(regexp_extract(regexp_replace(t, '(?m)^\\s*```[A-Za-z]*\\s*$', '', 'g'), '(?s)(\\{.*\\})', 1), '')", _FENCED, "events", "event_id"))
def json_extract_balanced(spark, d):
    return _shaped(spark, d, _FENCED, "events", "event_id").select("event_id", R.json_object_text(F.col("t")).alias("x"))


@query(_twin("nullif(regexp_extract(t, '.*(?:^|/)(p[0-9]{4})/', 1), '')", _PATH, "part", "p_partkey"))
def infer_page_from_path(spark, d):
    return _shaped(spark, d, _PATH, "part", "p_partkey").select("p_partkey", R.page_from_path(F.col("t")).alias("x"))


_FOUND = "list_transform(regexp_extract_all(t, '\\^[A-Za-z0-9]{1,2}'), lambda m: m[2:3])"


@query(f"""SELECT doc_id, array_to_string(list_filter(['ab', '9', 'z'], lambda m: NOT list_contains(f, m)), '') || '/' || array_to_string(list_filter(['ab', '9', 'z'], lambda m: len(list_filter(f, lambda x: x = m)) > 1), '') || '/' || array_to_string(list_filter(list_distinct(f), lambda m: m NOT IN ('ab', '9', 'z')), '') AS x
FROM (SELECT doc_id, {_FOUND} AS f FROM (SELECT doc_id, {_MARKED} AS t FROM documents))""")
def polish_validator(spark, d):
    c = C.once_each(F.col("t"), F.array(F.lit("ab"), F.lit("9"), F.lit("z")))
    return _shaped(spark, d, _MARKED).select("doc_id", F.concat_ws("/", *[F.array_join(v, "") for v in c.values()]).alias("x"))


@query(f"""SELECT doc_id, array_to_string(list_filter(list_distinct(b), lambda m: m NOT IN ('a', 'z')), '') || '/' || array_to_string(list_filter(['a', 'z'], lambda m: NOT list_contains(b, m)), '') AS x
FROM (SELECT doc_id, regexp_extract_all(t, '\\^([a-z])', 1) AS b FROM (SELECT doc_id, {_MARKED} AS t FROM documents))""")
def marker_parity_gate(spark, d):
    body = F.regexp_extract_all("t", F.lit(r"\^([a-z])"), F.lit(1))
    p = validators.marker_parity(body, F.array(F.lit("a"), F.lit("z")))
    return _shaped(spark, d, _MARKED).select("doc_id", F.concat_ws("/", *[F.array_join(v, "") for v in p.values()]).alias("x"))


# --- Operators on literal rows: their inputs (scanned pages, headers, settings) have no like in the test tables ------------


def _rows(spark: SparkSession, *values, schema: str = "t string") -> DataFrame:
    return spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)


def _is(*pairs) -> str:
    """A twin that states what each text must become."""
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float, bool)) else "'" + v.replace("'", "''") + "'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, p)) + ")" for p in pairs) + ") v(t, x)"


@query(r"""WITH s AS (SELECT conv_id, turn, replace(coalesce(text, ''), ' the ', '-' || chr(10) || 'the ') || chr(10) || '  "' || chr(10) || 'a  See ' || turn || chr(10) || 'b  Also' || chr(10) || chr(10) || turn || ' ' AS t FROM conversations),
l AS (SELECT conv_id, turn, array_to_string(list_filter(list_transform(regexp_split_to_array(t, '\r?\n'), lambda v: rtrim(v)), lambda v: trim(v) <> ''), chr(10)) AS t FROM s),
n AS (SELECT conv_id, turn, regexp_replace(chr(10) || t, '(\n\s*[0-9]{1,3}\s*)+$', '') AS t FROM l),
f AS (SELECT conv_id, turn, substr(regexp_replace(t, '(\n\s*[a-z]\s+[A-Z“”"''(][^\n]*)+$', ''), 2) AS t FROM n),
c AS (SELECT conv_id, string_agg(regexp_replace(t, '(?m)^\s*["“”<>''‘’]{1,3}\s*$\n?', '', 'g'), chr(10) ORDER BY turn) AS t FROM f GROUP BY conv_id),
h AS (SELECT conv_id, regexp_replace(regexp_replace(t, '([\p{L}\p{M}\p{Nd}_])-\s*\n\s*([\p{L}\p{M}\p{Nd}_])', '\1\2', 'g'), '\s*\n\s*', ' ', 'g') AS t FROM c)
SELECT conv_id, trim(regexp_replace(regexp_replace(t, '\s{2,}', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g')) AS x FROM h""")
def stitch_pages(spark, d):
    """Conversations as books: each turn is a page with broken words, a line of noise, notes and a number at its foot."""
    from .functions import pages as FP

    n = F.col("turn").cast("string")
    page = F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit(" the "), F.lit("-\nthe ")), F.lit('\n  "\na  See '), n, F.lit("\nb  Also\n\n"), n, F.lit(" "))
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", page.alias("t")))).alias("p"))
    return x.select("conv_id", FP.stitch_pages(F.transform("p", lambda p: p["t"])).alias("x"))


_NO_ENCLITIC = ", ".join(f"'{w}'" for w in mining.NO_ENCLITIC)


@query(f"""WITH t AS (SELECT doc_id, replace(replace(replace(replace(replace(regexp_replace(text, '\\^[A-Za-z0-9]{{1,2}}', ' ', 'g'), 'æ', 'ae'), 'œ', 'oe'), 'ſ', 's'), 'Æ', 'Ae'), 'Œ', 'Oe') AS t FROM documents),
c AS (SELECT doc_id, unnest(regexp_split_to_array(t, '[.,;:!?()\\[\\]“”"''«»—–]+')) AS c FROM t),
w AS (SELECT doc_id, flatten(list_transform(regexp_split_to_array(c, '\\s+'), lambda w: CASE WHEN lower(w) LIKE '%que' AND lower(w) NOT IN ({_NO_ENCLITIC}) AND length(w) > 4 THEN [left(w, length(w) - 3), right(w, 3)] ELSE [w] END)) AS w FROM c),
k AS (SELECT doc_id, list_filter(list_transform(w, lambda x: lower(regexp_replace(x, '[^A-Za-zÀ-ÿ]+', '', 'g'))), lambda x: length(x) >= 2 AND (x IN ('vi', 'di', 'mi', 'ci') OR NOT regexp_matches(x, '^m{{0,4}}(cm|cd|d?c{{0,3}})(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})$'))) AS k FROM w)
SELECT doc_id, count(*) AS clauses, sum(len(k))::BIGINT AS tokens, sum(len(array_to_string(k, '')))::BIGINT AS letters FROM k WHERE len(k) > 0 GROUP BY doc_id""")
def clause_tokens(spark, d):
    c = mining.latin_clauses(table(spark, d, "documents"), "doc_id", "text")
    return c.groupBy("doc_id").agg(F.count("*").alias("clauses"), F.sum(F.size("tokens")).alias("tokens"), F.sum(F.length(F.array_join("tokens", ""))).alias("letters"))


@query(r"""WITH x AS (SELECT o_orderkey, (o_orderkey // 10)::VARCHAR AS page, string_split(CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE concat(CASE WHEN o_orderkey % 2 = 0 THEN 'CAP. IV.' ELSE o_orderkey::VARCHAR END, '|middle|', CASE WHEN o_orderkey % 3 = 0 THEN 'cap xi' ELSE (o_orderkey // 10)::VARCHAR END) END, '|') AS l FROM orders),
y AS (SELECT *, o_orderkey // 10 % 2 = 0 AS even, contains(l[1], page) AS p1, coalesce(contains(l[3], page), false) AS p3, regexp_matches(l[1], '(?i)\bCAP') AS c1, coalesce(l[3] = 'cap xi', false) AS c3 FROM x),
z AS (SELECT *, CASE WHEN p1 AND len(l) > 1 THEN 'left' WHEN p3 THEN 'right' WHEN p1 THEN CASE WHEN even THEN 'left' ELSE 'right' END ELSE '' END AS page_side FROM y)
SELECT o_orderkey, p1 OR p3 AS has_page, c1 OR c3 AS has_chapter, page_side, CASE WHEN c1 THEN 'left' WHEN c3 THEN 'right' ELSE '' END AS chapter_side, (p1 OR p3) AND page_side = CASE WHEN even THEN 'left' ELSE 'right' END AS parity_ok FROM z""")
def header_meta(spark, d):
    """Header lines made of order keys: chapter or number on the left, something between, number or chapter on the right."""
    from .functions import pages as FP

    page = F.expr("o_orderkey div 10")
    left = F.when(F.col("o_orderkey") % 2 == 0, "CAP. IV.").otherwise(F.col("o_orderkey").cast("string"))
    right = F.when(F.col("o_orderkey") % 3 == 0, "cap xi").otherwise(page.cast("string"))
    lines = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("x"))).otherwise(F.array(left, F.lit("middle"), right))
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(k) for k, c in FP.header_meta(lines, page).items()])


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '[fn01|?] lead [b] tail' || chr(10) ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN '[fn02|*] ' ELSE '[fn01|*] ' END || CASE WHEN doc_id % 2 = 0 THEN 'note ' ELSE '' END || doc_id || ' more' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '[fn03|2.] ' ELSE '[fn02|2.] ' END || coalesce(lang, 'none') || ' x (a) not a marker' AS x FROM documents""")
def relabel_footnotes(spark, d):
    """Note blocks made of documents' columns: lines with markers, without, and before the first marker."""
    from .functions import pages as FP

    lead, note = F.when(F.col("doc_id") % 3 == 0, "lead [b]\n\n tail \r\n").otherwise(""), F.when(F.col("doc_id") % 2 == 0, "note ").otherwise("")
    t = F.concat(lead, F.lit("* "), note, F.col("doc_id").cast("string"), F.lit("\nmore\n2. "), F.coalesce("lang", F.lit("none")), F.lit("  \n x \n(a) not a marker"))
    return table(spark, d, "documents").select("doc_id", FP.relabel_notes(t).alias("x"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as histories, odd turns blank."""
    e = F.struct("turn", F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(" ").alias("english"))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(e)).alias("h"))


_LAST = "SELECT conv_id, arg_max(CASE WHEN turn % 2 = 0 THEN text ELSE ' ' END, turn) AS last, coalesce(arg_max(text, turn) FILTER (turn % 2 = 0), '') AS filled FROM conversations GROUP BY conv_id"


@query(f"SELECT conv_id, last AS x FROM ({_LAST})")
def latest_value_no_fallback(spark, d):
    return _history(spark, d).select("conv_id", R.last_value(F.col("h")).alias("x"))


@query(f"SELECT conv_id, filled AS x FROM ({_LAST})")
def latest_nonempty_value(spark, d):
    return _history(spark, d).select("conv_id", R.latest_nonempty_value(F.col("h")).alias("x"))


@query(f"SELECT conv_id, CASE WHEN trim(last) = '' THEN 'final' ELSE trim(last) END AS x FROM ({_LAST})")
def latest_value_trimmed(spark, d):
    return _history(spark, d).select("conv_id", R.latest_value_trimmed(F.col("h"), F.lit(" final ")).alias("x"))


@query("SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 0 AND doc_id BETWEEN 10 AND 100000")
def fix_selection(spark, d):
    x = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").cast("string").alias("cf"))
    return x.where(R.any_rubric_at_most(F.create_map(F.lit("cf"), F.col("cf")), 0, ("cf",)) & R.in_range(F.col("doc_id"), 10, 100_000)).select("doc_id")


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND props IS NOT NULL")
def completed_filter(spark, d):
    return table(spark, d, "events").where((F.col("event_type") == "purchase") & F.col("props").isNotNull()).select("user_id").distinct()


@query("SELECT l_orderkey AS note, CASE WHEN c.o IS NOT NULL THEN 'caret' WHEN o_orderkey IS NOT NULL THEN 'line' ELSE 'own' END AS home FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (SELECT o_orderkey AS o FROM orders WHERE o_orderkey % 3 = 0) c ON c.o = l_orderkey LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0) ON o_orderkey = l_orderkey")
def footnote_home_join(spark, d):
    from .plans import pages as PP

    notes = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("marker_id")).distinct().withColumns({"body_line_id": F.col("marker_id"), "page_id": F.lit("own")})
    o = table(spark, d, "orders")
    carets = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("marker_id"), F.lit("caret").alias("page_id"), F.lit(1).alias("pos"))
    lines = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("line_id"), F.lit("line").alias("page_id"))
    return PP.note_homes(notes, carets, lines).select(F.col("marker_id").alias("note"), "home")


@query("SELECT doc_id, count(*) AS flags, any_value(lang) AS lang FROM labels JOIN documents USING (doc_id) GROUP BY doc_id")
def flag_to_segment_join(spark, d):
    f = table(spark, d, "labels").groupBy("doc_id").agg(F.count("*").alias("flags"))
    return f.join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")


@query("SELECT labels.doc_id, quality, lang FROM labels LEFT JOIN documents USING (doc_id)")
def score_latin_lookup(spark, d):
    return table(spark, d, "labels").select("doc_id", "quality").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "left")


@query("SELECT p_brand, count(DISTINCT p_type) AS pages FROM part GROUP BY p_brand")
def distinct_count_pages(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.countDistinct("p_type").alias("pages"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INTEGER AS seq FROM orders")
def running_per_home_seq(spark, d):
    x = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.dense_sequence(x, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "seq")


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 5")
def topk_list(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", "s_acctbal").orderBy("s_acctbal", "s_suppkey").limit(5)


@query("SELECT p_type AS phrase, count(*) AS count, round(coalesce(avg(CASE WHEN p_size > 10 THEN p_size END), 0), 6) AS loglik FROM part GROUP BY p_type ORDER BY loglik DESC, count DESC, phrase")
def phrase_rank(spark, d):
    p = table(spark, d, "part").groupBy(F.col("p_type").alias("phrase")).agg(F.count("*").alias("count"), F.avg(F.when(F.col("p_size") > 10, F.col("p_size"))).alias("loglik")).withColumn("n", F.lit(2))
    return mining.ranked(p).select("phrase", "count", F.round(F.coalesce("loglik", F.lit(0.0)), 6).alias("loglik"))


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name DESC")
def order_preserving_rewrite(spark, d):
    path = fresh_path(spark, "ordered")
    x = W.rank_by_ranges(table(spark, d, "nation").select("n_nationkey", "n_name"), [F.col("n_name").desc()], "_pos")
    writers.ordered_jsonl(x, path)
    return spark.read.schema("n_nationkey int, n_name string").json(path)


@query("SELECT p_brand, count(*)::VARCHAR AS n FROM part GROUP BY p_brand")
def tsv_sink(spark, d):
    path = fresh_path(spark, "tsv")
    writers.tsv(table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")), path)
    return readers.delimited(spark, path)


@query("SELECT n_nationkey::VARCHAR AS line, n_name AS text FROM nation")
def file_per_row_sink(spark, d):
    path = fresh_path(spark, "rows")
    writers.text_per_group(table(spark, d, "nation").select(F.col("n_nationkey").alias("line"), "n_name"), path, "line", "n_name")
    return spark.read.text(path).select(F.col("line").cast("string").alias("line"), F.col("value").alias("text"))


@query("SELECT '| ' || event_type || ' | ' || count(*) || ' |' AS line FROM events GROUP BY event_type")
def report_sink(spark, d):
    from .plans import pages as PP

    text = PP.report(table(spark, d, "events").groupBy("event_type").count().orderBy("event_type"), "Events")
    return spark.createDataFrame([(x,) for x in text.splitlines()[4:]], "line string")


@query("SELECT printf('v%d', o_orderkey % 2) AS pairing, count(*) AS n FROM orders GROUP BY 1")
def judgment_scan(spark, d):
    base = fresh_path(spark, "judged")
    table(spark, d, "orders").select(F.format_string("v%d", F.col("o_orderkey") % 2).alias("pairing"), "o_orderkey").write.partitionBy("pairing").json(base)
    return spark.read.schema("o_orderkey long, pairing string").json(base).groupBy("pairing").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name AS term, '(?iU)' || p_brand AS matcher FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AND p_name <> '' AND p_brand <> ''")
def glossary_load(spark, d):
    """Parts as entries, some without a term and some without a pattern."""
    some = lambda c, n: F.when(F.col("p_partkey") % n != 0, F.col(c)).otherwise(F.when(F.col("p_partkey") % 2 == 0, ""))
    entries = table(spark, d, "part").select("p_partkey", some("p_name", 3).alias("term"), some("p_brand", 5).alias("latin_pattern"))
    return readers.glossary(entries).select("p_partkey", "term", "matcher")


@query("""WITH p AS (SELECT conv_id AS page_num, printf('p%04d', conv_id) AS page_id, avg(length(text) % 100) AS raw_confidence_avg, min(length(text) % 100)::DOUBLE AS raw_confidence_min FROM conversations GROUP BY conv_id),
q AS (SELECT *, CASE WHEN raw_confidence_min >= 10 THEN 'ok' ELSE 'review' END AS qc_status FROM p)
SELECT 'pages' AS answer, * FROM q UNION ALL SELECT 'page' AS answer, * FROM q WHERE page_num = 3""")
def http_read_api(spark, d):
    """What the service's GET would return: the list of all pages, and one page by its number."""
    sure = F.length("text") % 100
    p = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("page_num")).agg(F.avg(sure).alias("raw_confidence_avg"), F.min(sure).cast("double").alias("raw_confidence_min"))
    p = p.withColumns({"page_id": F.format_string("p%04d", "page_num"), "qc_status": F.when(F.col("raw_confidence_min") >= 10, "ok").otherwise("review")})
    return service.list_pages(p).select(F.lit("pages").alias("answer"), "*").unionByName(service.list_pages(service.get_page(p, "3")).select(F.lit("page").alias("answer"), "*"))


@query("""WITH x AS (SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'missing' WHEN conv_id % 5 = 0 OR (conv_id % 11 = 0 AND bool_or(turn = 0)) THEN 'invalid' ELSE 'saved' END AS outcome,
count(*) + count(CASE WHEN turn % 2 = 0 THEN text END) AS n FROM conversations WHERE conv_id % 3 <> 0 GROUP BY conv_id)
SELECT CASE WHEN conv_id % 7 = 0 THEN 'new-' ELSE '' END || printf('p%04d', conv_id) AS page_id, outcome, CASE WHEN outcome = 'saved' THEN n ELSE 0 END AS edits, CASE WHEN outcome = 'saved' THEN (SELECT count(*) FROM conversations c WHERE c.conv_id = x.conv_id) ELSE 0 END AS reviewed FROM x""")
def http_annotation_api(spark, d):
    """Two thirds of the pages are posted: some aren't stored, some have an unknown status or a marker without a note, the rest are saved.

    Per page: what came of it, the edits logged, and the lines that are reviewed afterwards.
    """
    c = table(spark, d, "conversations")
    line = lambda page, text, status: [page.alias("page_id"), F.format_string("l%04d", "turn").alias("line_id"), text.alias("text_gold"), F.lit("").alias("marker_id"), F.col("role").alias("notes"), status.alias("review_status")]
    page = F.format_string("p%04d", "conv_id")
    stored = c.select(*line(page, F.col("text"), F.lit("draft")))
    sent = c.where("conv_id % 3 <> 0").withColumn("_page", F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit("new-"), page)).otherwise(page))
    text = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    status = F.when(F.col("conv_id") % 5 == 0, "odd").otherwise("reviewed")
    posted = sent.select(*line(F.col("_page"), text, status), F.when(F.col("turn") == 0, F.array(F.lit("n1"))).otherwise(F.array(F.lit(""))).alias("note_ids"))
    notes = sent.where("conv_id % 11 <> 0").select(F.col("_page").alias("page_id"), F.lit("n1").alias("footnote_id"), F.lit("gloss").alias("kind")).distinct()
    after, edits, outcome = service.save_pages(stored, posted, service.line_faults(posted, notes))
    done = after.where("review_status = 'reviewed'").groupBy("page_id").agg(F.count("*").alias("reviewed"))
    logged = edits.groupBy("page_id").agg(F.count("*").alias("edits"))
    return outcome.join(logged, "page_id", "left").join(done, "page_id", "left").select("page_id", "outcome", F.coalesce("edits", F.lit(0)).alias("edits"), F.coalesce("reviewed", F.lit(0)).alias("reviewed"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def append_event_log(spark, d):
    """The events, appended as a log and read back as a stream of batches."""
    from .streaming import incremental

    src, out = fresh_path(spark, "log"), fresh_path(spark, "log-out")
    x = table(spark, d, "events").select("event_id", "event_type")
    writers.append_jsonl(x, src)
    stream = incremental.event_log(spark, src, x.schema)
    incremental.upsert_batches(stream, fresh_path(spark, "log-state"), lambda df, n: df.write.mode("append").parquet(out)).awaitTermination()
    return spark.read.schema(x.schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM region")
def retry_with_backoff(spark, d):
    from .streaming import incremental

    left = iter((True, True, False))

    def once() -> DataFrame:
        if next(left):
            raise TimeoutError("try again")
        return table(spark, d, "region").agg(F.count("*").alias("n"))

    return incremental.with_retries(once, wait=0.0)


@query("SELECT c_nationkey AS unit FROM (SELECT DISTINCT c_nationkey FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey <> s_nationkey)")
def optimistic_guard(spark, d):
    new = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("u")).agg(F.collect_set("c_custkey").alias("ids"))
    old = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("u")).agg(F.collect_set("s_suppkey").alias("ids"))
    return J.ownership_clashes(new, old, "u", "ids").select("unit")


@query("""WITH w AS (SELECT conv_id, turn, coalesce(list_extract(regexp_extract_all(lower(text), '[a-z]+'), -1), '') AS caught, coalesce(list_extract(regexp_extract_all(lower(text), '[a-z]+'), 1), '') AS head FROM conversations),
x AS (SELECT caught, lead(head) OVER (PARTITION BY conv_id ORDER BY turn) AS found, lead(1) OVER (PARTITION BY conv_id ORDER BY turn) AS more FROM w)
SELECT CASE WHEN caught = '' OR coalesce(found, '') = '' THEN 'missing' WHEN caught = found THEN 'match' ELSE 'mismatch' END AS status, count(*) AS n FROM x WHERE more = 1 GROUP BY 1""")
def catchword_verifier(spark, d):
    return lead_join_catchword(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(f"SELECT page_id, count(*) AS refs, min(turn - 1) AS first_anchor FROM {_LINES} WHERE region = 'marginalia' GROUP BY page_id")
def marginalia_index(spark, d):
    from .plans import pages as PP

    x = PP.scan_lines(_records(spark, d)).where("region = 'marginalia'").withColumn("anchor", F.coalesce("anchor_index", F.lit(-1)))
    return x.groupBy("page_id").agg(F.count("*").alias("refs"), F.min("anchor").cast("long").alias("first_anchor"))


@query()
def token_bridge_mapping(spark, d):
    """Assistant turns against the user turns of their conversation."""
    c = table(spark, d, "conversations").select("conv_id", F.when(F.col("role") == "user", "reference").otherwise("bridge").alias("side"), "turn", "text")
    return alignment.bridge(c, "conv_id", "side", "turn", "text")


@query("SELECT r_regionkey, upper(r_name) || '!' AS x FROM region")
def udf_text_transform(spark, d):
    return table(spark, d, "region").select("r_regionkey", T.compose(F.upper, lambda c: F.concat(c, F.lit("!")))(F.col("r_name")).alias("x"))


@query(f"""WITH x AS (SELECT conv_id, turn, a AS s, b AS r, list_distinct(string_split(a, ' ')) AS p, list_distinct(string_split(b, ' ')) AS q FROM {_NEXT_TURNS})
SELECT conv_id, turn, CASE WHEN e IS NULL THEN len(list_intersect(p, q)) / len(list_distinct(list_concat(p, q))) END::DOUBLE AS score, e AS error FROM (SELECT *, CASE WHEN coalesce(trim(s), '') = '' THEN 'missing_source' WHEN coalesce(trim(r), '') = '' THEN 'missing_reference' END AS e FROM x)""")
def udf_metric(spark, d):
    """An injected metric, called on batches: shared words of each turn and the next one."""
    from .plans import pages as PP

    def overlap(_, mt, ref):
        sides = [(set(a.split(" ")), set(b.split(" "))) for a, b in zip(mt, ref, strict=True)]
        return [len(a & b) / len(a | b) for a, b in sides]

    x = _next_turns(spark, d).withColumn("m", F.col("a"))
    return PP.external_scores(x, overlap, ["conv_id", "turn"], "a", "m", "b").select("conv_id", "turn", "score", "error")


@query("SELECT r_name AS text, 1.0::DOUBLE AS confidence FROM region")
def udf_ocr_engine(spark, d):
    """An injected engine over binary files; here it reads the bytes as text."""
    from .plans import pages as PP

    path = fresh_path(spark, "scans")
    table(spark, d, "region").select(F.col("r_name").alias("value")).repartition(5, "value").write.option("maxRecordsPerFile", 1).text(path)
    images = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return PP.recognise(images, lambda b: (b.decode().strip(), 1.0)).where("text <> ''").select("text", "confidence")


@query("SELECT doc_id FROM documents WHERE doc_id % 4 = 3")
def udf_injected_callable(spark, d):
    return detect_and_rerun(spark, d)


@query(f"""WITH l AS {_LINES}, b AS (SELECT conv_id, turn, seq AS bs FROM l WHERE region = 'body'), m AS (SELECT l.page_id, l.seq, b.bs FROM l LEFT JOIN b ON b.conv_id = l.conv_id AND b.turn = l.turn - 1 WHERE region = 'marginalia')
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY bs NULLS LAST, seq)::INTEGER AS marker_number FROM m""")
def client_renumber(spark, d):
    from .plans import pages as PP

    return PP.anchored_notes(PP.scan_lines(_records(spark, d))).select("page_id", "marker_number")


@query(_is(("size", 5), ("debug", 1)))
def layered_config(spark, d):
    c = readers.layered_config({"size": "3", "debug": "no"}, {"size": "5"}, {"debug": "TRUE"}, types={"size": int, "debug": bool})
    return spark.createDataFrame([(k, int(v)) for k, v in c.items()], "t string, x int")


@query("SELECT n_nationkey, 'N:' || n_name AS english, '' AS notes, false AS uncertain, NULL::VARCHAR AS error FROM nation")
def translation_source(spark, d):
    """An injected model answers in a code fence, as models do."""
    import json

    from .plans import pages as PP

    return PP.translate(table(spark, d, "nation"), lambda p: "```json\n" + json.dumps({"english": "N:" + p.removeprefix("[text]\n")}) + "\n```", "n_nationkey", "n_name")


def _images(spark: SparkSession, d: str) -> DataFrame:
    """Documents' bytes in place of page images."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))


def _word_engine(image: bytes) -> tuple[str, list]:
    n, b = len(image.decode()), len(image)
    return image.decode(), [n % 97, str(n // 97 % 89), "-1", -1, b % 79, (n + b) % 83]


def _line_engine(image: bytes) -> list:
    return [(x, [len(x) % 97 if i < 4 else -1]) for i, x in enumerate(image.decode().split("\n"))]


def _vision_model(image: bytes) -> str:
    import json

    found = image.decode().split("\n")
    lines = [{"text": x, "confidence": len(x) % 128 / 128 if i < 4 else 0, "marker_id": None, "illegible": False} | ({"region": "footnote"} if i % 7 == 6 else {}) for i, x in enumerate(found)]
    return "```json\n" + json.dumps({"page_summary": f"{len(found)} lines", "lines": ["not a line", *lines]}) + "\n```"


@query("""WITH x AS (SELECT doc_id, text, length(text) AS n, strlen(text) AS b FROM documents),
y AS (SELECT *, [n % 97, n // 97 % 89, b % 79, (n + b) % 83] AS c FROM x)
SELECT doc_id AS path, text, CASE WHEN text IS NULL THEN 0 ELSE list_sum(c) / 4.0 END::DOUBLE AS avg_confidence, CASE WHEN text IS NULL THEN 0 ELSE list_min(c) END::DOUBLE AS min_confidence,
CASE WHEN text IS NULL THEN 'no image' END AS error FROM y""")
def ocr_source_tesseract(spark, d):
    """An injected engine over all documents: its text, and confidences a word of which some mark no word."""
    return ocr.from_words(_images(spark, d), _word_engine)


@query("""WITH x AS (SELECT doc_id, text, list_transform(string_split(text, chr(10))[1:4], lambda v: length(v) % 97) AS c FROM documents)
SELECT doc_id AS path, text, CASE WHEN text IS NULL THEN 0 ELSE round(list_sum(c) / len(c), 2) END::DOUBLE AS avg_confidence, CASE WHEN text IS NULL THEN 0 ELSE list_min(c) END::DOUBLE AS min_confidence,
CASE WHEN text IS NULL THEN 'no image' END AS error FROM x""")
def ocr_source_kraken(spark, d):
    """An injected engine over all documents: lines with confidences, unknown ones among them."""
    return ocr.from_lines(_images(spark, d), _line_engine)


@query("""WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
y AS (SELECT doc_id, l, list_filter(list_transform(l[1:4], lambda v: (length(v) % 128) / 128.0::DOUBLE), lambda v: v > 0) AS c FROM x),
z AS (SELECT doc_id, len(l) || ' lines' AS page_summary, CASE WHEN len(c) = 0 THEN 0 ELSE round_even(list_sum(c) / len(c) * 100, 2) END::DOUBLE AS avg_confidence, CASE WHEN len(c) = 0 THEN 0 ELSE round_even(list_min(c) * 100, 2) END::DOUBLE AS min_confidence,
unnest(l) AS text, generate_subscripts(l, 1) - 1 AS i FROM y)
SELECT doc_id AS path, page_summary, avg_confidence, min_confidence, i::INTEGER AS line_index, CASE WHEN i % 7 = 6 THEN 'footnote' ELSE 'body' END AS region, text, CASE WHEN i < 4 THEN (length(text) % 128) / 128.0::DOUBLE ELSE 0 END AS confidence FROM z""")
def ocr_source_vision_llm(spark, d):
    """An injected model over all documents, whose fenced JSON becomes lines beside the page's summary and confidences."""
    x = ocr.from_vision(_images(spark, d), _vision_model).select("path", "page_summary", "avg_confidence", "min_confidence", F.explode("lines").alias("l"))
    return x.select("path", "page_summary", "avg_confidence", "min_confidence", "l.line_index", "l.region", "l.text", "l.confidence")
