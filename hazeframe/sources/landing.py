"""Landing-zone CSV loading: routing, typed coercion, lineage."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe import fixed_values as fv
from hazeframe.functions.naming import lookup
from hazeframe.sources.schemas import RAW_SCHEMAS, SEED_SCHEMAS


def _struct(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def route_expr(path: Column, root: str, routes=fv.LANDING_ROUTES, prefixes=fv.LANDING_PREFIXES) -> Column:
    """Target table of a file path: by folder below ``root``, else by name prefix."""
    plain = F.regexp_replace(path, r"^file:/*", "/")
    below = F.substring_index(plain, root.rstrip("/") + "/", -1)
    folder = F.regexp_replace(below, r"/?[^/]*$", "")
    prefix = F.regexp_extract(F.regexp_extract(path, r"([^/]+)$", 1), r"^([^_]*_[^_]*)", 1)
    prefix = F.regexp_replace(prefix, r"\.csv$", "")
    return F.coalesce(lookup(folder, routes), lookup(prefix, prefixes))


def coerce_column(text: Column, kind: T.DataType) -> Column:
    """Text to a column type: '' is NULL, times become whole UTC seconds, booleans 0/1."""
    value = F.nullif(text, F.lit(""))
    if isinstance(kind, T.TimestampType):
        return F.date_trunc("second", F.try_to_timestamp(F.trim(value)))
    if isinstance(kind, T.ShortType):  # small unsigned columns also carry booleans
        word = F.lower(F.trim(value))
        return (F.when(word.isin("true", "t", "yes", "y"), 1).when(word.isin("false", "f", "no", "n"), 0)
                .otherwise(word.try_cast("double").try_cast("int"))).cast("smallint")
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return value.try_cast("double").try_cast(kind.simpleString())
    if isinstance(kind, T.StringType):
        return value
    return value.try_cast(kind.simpleString())


def coerce(df: DataFrame, schema) -> DataFrame:
    """Known columns of a text frame in their target types; unknown columns are dropped."""
    fields = {f.name: f.dataType for f in _struct(schema).fields}
    return df.select(*[coerce_column(F.col(c), fields[c]).alias(c) for c in df.columns if c in fields])


def stamp_lineage(df: DataFrame, run_id: str, started_at, file_path: Column | None = None) -> DataFrame:
    """Add sync-run and source-file columns."""
    path = F.col("_metadata.file_path") if file_path is None else file_path
    return df.withColumns({
        "raw_sync_run_id": F.lit(run_id), "raw_sync_started_at": F.lit(started_at).cast("timestamp"),
        "raw_source_file_name": F.regexp_extract(path, r"([^/]+)$", 1), "raw_source_file_id": F.sha2(path, 256)})


def stamp_batch(df: DataFrame, batch_id: str, ingest_time, source: str) -> DataFrame:
    """Add batch columns; an existing ``source`` is kept."""
    out = df.withColumns({"ingest_time": F.lit(ingest_time).cast("timestamp"), "ingest_batch_id": F.lit(batch_id)})
    return out if "source" in df.columns else out.withColumn("source", F.lit(source))


def list_files(spark: SparkSession, root: str, routes=fv.LANDING_ROUTES, prefixes=fv.LANDING_PREFIXES) -> DataFrame:
    """CSV files below ``root`` with their target table (NULL = unroutable) and header line."""
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                     F.monotonically_increasing_id().alias("line_no"), "value"))
    first = lines.filter(F.col("at") == 0).groupBy("path").agg(F.min_by("value", "line_no").alias("header"))
    return first.withColumn("table", route_expr(F.col("path"), root, routes, prefixes))


def header_names(header: str) -> list[str]:
    """Column names of a header line; quoted names may hold commas."""
    return [n.strip().lstrip("\ufeff") for n in next(csv.reader([header.lstrip("\ufeff")]))]


def _text_groups(spark: SparkSession, files: DataFrame):
    """(table, its rows as text with ``_path``) for every distinct header."""
    groups = files.filter(F.col("table").isNotNull()).groupBy("table", "header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    for g in groups:
        text = T.StructType([T.StructField(n, T.StringType()) for n in header_names(g["header"])])
        yield g["table"], (spark.read.schema(text).option("header", True).option("multiLine", True).option("escape", '"')
                           .csv(g["paths"]).select("*", F.col("_metadata.file_path").alias("_path")))


def rejects(raw: DataFrame, schema, path: str = "_path") -> DataFrame:
    """``path, column, text`` of every value that is not blank and cannot be read in its column's type."""
    bad = []
    for f in _struct(schema).fields:
        if f.name in raw.columns:
            text = F.col(f"`{f.name}`")
            bad.append(F.when((F.trim(text) != "") & coerce_column(text, f.dataType).isNull(), F.struct(F.lit(f.name).alias("column"), text.alias("text"))))
    if not bad:
        return raw.sparkSession.createDataFrame([], "path string, column string, text string")
    return raw.select(F.col(path).alias("path"), F.explode(F.array_compact(F.array(*bad))).alias("bad")).select("path", "bad.column", "bad.text")


def landing_rejects(spark: SparkSession, root: str, routes=fv.LANDING_ROUTES, prefixes=fv.LANDING_PREFIXES, schemas=RAW_SCHEMAS) -> DataFrame:
    """``table, path, column, text`` of everything that ``load_landing`` reads as NULL although it is not blank."""
    out = spark.createDataFrame([], "table string, path string, column string, text string")
    for table, raw in _text_groups(spark, list_files(spark, root, routes, prefixes)):
        out = out.unionByName(rejects(raw, schemas[table]).select(F.lit(table).alias("table"), "*"))
    return out


def load_landing(spark: SparkSession, root: str, run_id: str, started_at, routes=fv.LANDING_ROUTES,
                 prefixes=fv.LANDING_PREFIXES, schemas=RAW_SCHEMAS) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load every routable file -> ({table: typed rows}, unroutable files).

    The driver sees file names and headers only.  Files of a table are read
    together per distinct header, so columns match by name even when exports
    differ in column order.
    """
    files = list_files(spark, root, routes, prefixes)
    tables: dict[str, DataFrame] = {}
    for table, raw in _text_groups(spark, files):
        known = coerce(raw, schemas[table])
        if not known.columns:
            continue
        typed = raw.select("_path", *[
            coerce_column(F.col(f"`{n}`"), t).alias(n)
            for n, t in ((f.name, f.dataType) for f in _struct(schemas[table]).fields) if n in raw.columns])
        part = stamp_lineage(typed, run_id, started_at, F.col("_path")).drop("_path")
        seen = tables.get(table)
        tables[table] = part if seen is None else seen.unionByName(part, allowMissingColumns=True)
    unrouted = files.filter(F.col("table").isNull()).select("path", F.lit("NO_TABLE_MAPPING").alias("reason"))
    return tables, unrouted


def read_seed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Reference CSV with declared column types."""
    return spark.read.schema(_struct(SEED_SCHEMAS.get(schema, schema) if isinstance(schema, str) else schema)).option("header", True).csv(path)
