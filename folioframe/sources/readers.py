"""Scans: JSON lines under three policies for malformed rows, JSON documents, folders of pages, text, tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def with_position(lines: DataFrame) -> DataFrame:
    """``_pos``: the order of a file's lines, by file and place. It holds for one read; store it with the rows."""
    return lines.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return with_position(spark.read.text(path)).where(F.trim("value") != "")


def _parsed(spark: SparkSession, path: str, schema: StructType, mode: str) -> DataFrame:
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    row = F.from_json("value", full, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})
    return _lines(spark, path).select(row.alias("r"), "_file", "_pos").select("r.*", "_file", "_pos")


def jsonl_ordered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows with ``_pos``; blank lines are skipped, a malformed one fails the query with its text."""
    rows = _parsed(spark, path, schema, "PERMISSIVE")
    return rows.withColumn("_pos", F.when(F.col(CORRUPT).isNull(), F.col("_pos")).otherwise(F.raise_error(F.concat(F.lit("malformed row: "), F.col(CORRUPT))))).drop(CORRUPT)


def jsonl_strict(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """As :func:`jsonl_ordered`, the last row of each key."""
    return last_write(jsonl_ordered(spark, path, schema), [key], ["_pos"])


def jsonl_lenient(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """Malformed rows are skipped; the last row of each key."""
    return last_write(_parsed(spark, path, schema, "PERMISSIVE").where(F.col(CORRUPT).isNull()).drop(CORRUPT), [key], ["_pos"])


def jsonl_counting(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, a ``malformed_record`` finding for each malformed row)."""
    rows = _parsed(spark, path, schema, "PERMISSIVE")
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(F.lit("malformed_record").alias("rule"), F.col(CORRUPT).alias("detail"), "_file", "_pos")
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def last_write(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. One aggregation, so copies of a key meet after partial aggregation only."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*").select(*rows.columns)


def json_array(spark: SparkSession, path: str, schema: StructType | None = None, order: str | None = None) -> DataFrame:
    """Files that each hold one array of records."""
    reader = spark.read.option("multiLine", True)
    rows = (reader.schema(schema) if schema else reader).json(path)
    return rows.orderBy(order) if order else rows


def json_documents(spark: SparkSession, path: str, schema: StructType, required: list[str]) -> DataFrame:
    """One object a file; a file without a required key fails the query."""
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    for k in required:
        rows = rows.withColumn(k, F.when(F.col(k).isNotNull(), F.col(k)).otherwise(F.raise_error(F.concat(F.lit(f"no {k} in "), F.input_file_name())).cast(schema[k].dataType)))
    return rows


def page_files(spark: SparkSession, folder: str, schema: StructType, low: int | None = None, high: int | None = None, pattern: str = r"page_p([0-9]+)\.json$") -> DataFrame:
    """Page files by the number in their name, inclusive range."""
    rows = spark.read.option("multiLine", True).schema(schema).json(folder).withColumn("page_num", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("int"))
    if low is not None:
        rows = rows.where(F.col("page_num") >= low)
    return rows.where(F.col("page_num") <= high) if high is not None else rows.where(F.col("page_num").isNotNull())


def reading_order(rows: DataFrame, index: str = "reading_order_index", physical: str = "page_num") -> DataFrame:
    return rows.orderBy(F.coalesce(index, physical), physical)


def first_existing(layouts: list[DataFrame], key: str) -> DataFrame:
    """Union of layouts; of a key that several have, the earliest layout's row."""
    tagged = [x.withColumn("_layout", F.lit(i)) for i, x in enumerate(layouts)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in rows.columns if c not in (key, "_layout")]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), "_layout").alias("_r")).select(key, "_r.*")


def text_pages(spark: SparkSession, path: str, skip: DataFrame | None = None, pattern: str = r"page_([0-9]{4})_raw\.txt$") -> DataFrame:
    """Whole text files as (page_id, text), without the page ids in ``skip``."""
    rows = spark.read.text(path, wholetext=True).select(F.concat(F.lit("p"), F.regexp_extract("_metadata.file_name", pattern, 1)).alias("page_id"), F.col("value").alias("text"))
    return rows.join(skip.select("page_id"), "page_id", "left_anti") if skip is not None else rows


def delimited(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table with a header, all columns as text."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def runs(spark: SparkSession, base: str, schema: StructType, versions: tuple[str, ...] = ("v0", "v1"), name: str = "segments*.jsonl") -> DataFrame:
    """``<base>/<version>/<run>/segments*.jsonl`` of the versions, tagged with version and run."""
    rows = spark.read.schema(schema).json([f"{base}/{v}/*/{name}" for v in versions])
    return rows.withColumn("version", F.regexp_extract("_metadata.file_path", r"/(v[0-9]+)/[^/]+/[^/]+$", 1)).withColumn("run", F.regexp_extract("_metadata.file_path", r"/v[0-9]+/([^/]+)/[^/]+$", 1))


def judgements(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Judgement files; the file's stem names the pairing."""
    return spark.read.schema(schema).json(path).withColumn("pairing", F.regexp_extract("_metadata.file_name", r"^(.*)\.jsonl$", 1))


def sentinel_slice(lines: DataFrame, id_col: str, order: str, first: str, last: str) -> DataFrame:
    """Rows from id ``first`` to id ``last``; fails the query where one is missing."""
    ends = lines.agg(F.min(F.when(F.col(id_col) == first, F.col(order))).alias("_a"), F.min(F.when(F.col(id_col) == last, F.col(order))).alias("_b"))
    ends = ends.select(*[F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"no line {x}")).cast("long")).alias(c) for c, x in (("_a", first), ("_b", last))])
    return lines.join(F.broadcast(ends)).where(F.col(order).between(F.col("_a"), F.col("_b"))).drop("_a", "_b")  # one row by construction


def glossary(rows: DataFrame) -> DataFrame:
    """Entries with a term and a pattern, the pattern made case-insensitive and Unicode-aware."""
    ok = (F.coalesce("term", F.lit("")) != "") & (F.coalesce("latin_pattern", F.lit("")) != "")
    return rows.where(ok).withColumn("matcher", F.concat(F.lit("(?iU)"), F.col("latin_pattern")))


def needed_lines(units: DataFrame, lines: DataFrame, ids: str, line_id: str = "line_id") -> DataFrame:
    """The lines that some unit's id array names."""
    return lines.join(units.select(F.explode(ids).alias(line_id)).distinct(), line_id, "left_semi")


def fresh_files(rows: DataFrame, started: Column) -> DataFrame:
    """Rows of files changed no earlier than a second before ``started``."""
    return rows.where(F.col("_metadata.file_modification_time") >= started - F.expr("interval 1 second"))


def work_plan(spark: SparkSession, low: int, high: int, done: DataFrame, key: str = "page_num") -> DataFrame:
    """Every number of the range with action run or skip; skip where ``done`` has it."""
    have = done.select(F.col(key).cast("long").alias("page_num")).distinct().withColumn("_have", F.lit(True))
    plan = spark.range(low, high + 1).withColumnRenamed("id", "page_num").join(have, "page_num", "left")
    return plan.select("page_num", F.when(F.col("_have"), "skip").otherwise("run").alias("action"), F.when(F.col("_have"), "target exists").otherwise("").alias("reason"))


def layered_config(*layers: dict[str, str], types: dict[str, type] | None = None) -> dict:
    """Later layers win; values are coerced to their type, booleans from 1, true, yes and on."""
    merged = {k: v for layer in layers for k, v in layer.items() if v is not None}
    as_type = lambda k, v: (str(v).strip().lower() in ("1", "true", "yes", "on")) if (types or {}).get(k) is bool else (types or {}).get(k, str)(v)
    return {k: as_type(k, v) for k, v in merged.items()}


def file_order(rows: DataFrame, file: str = "_file", pos: str = "_pos") -> Column:
    return F.row_number().over(Window.partitionBy(file).orderBy(pos))
