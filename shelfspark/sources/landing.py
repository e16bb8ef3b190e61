"""Landing JSON discovery and bronze projection.

A landing root holds one folder per entity with dated JSON files, e.g.
``root/orders_data/orders_2024-06-01.json``.  Files are either JSON arrays
(``layout='array'``) or one object per line (``layout='lines'``); a folder may
hold both (``layout='auto'``).
"""

from __future__ import annotations

import datetime as _dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.clean import blank_to_null, landing_table_name

#: ``.json`` in any case.
JSON_GLOB = "*.[jJ][sS][oO][nN]"
_GLOB_CHARS = re.compile(r"([\[\]{}*?\\])")


def discover_landing(spark: SparkSession, root: str) -> DataFrame:
    """Distinct entity folders holding ``.json`` files, with their table names.

    Only file metadata is read (``binaryFile`` with a path glob, content column
    pruned), so listing stays cheap for large landing areas.
    """
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", JSON_GLOB)
             .load(root)
             .select("path"))
    folder = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    return (files.select(folder.alias("folder")).distinct()
                 .withColumn("table_name", landing_table_name("folder")))


def _records_by_line(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_GLOB).text(path)
            .select(F.col("value").alias("raw_json"), F.col("_metadata.file_path").alias("_source_file"))
            .filter(F.trim("raw_json") != ""))


def _records_by_array(spark: SparkSession, paths: list[str]) -> DataFrame:
    # text() has its own wholetext parameter, which overrides an option of that name
    whole = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_GLOB).text(paths, wholetext=True)
             .select(F.col("value"), F.col("_metadata.file_path").alias("_source_file")))
    return whole.select(F.explode(F.from_json(F.regexp_replace("value", r"^\x{FEFF}", ""), "array<string>")).alias("raw_json"), "_source_file")


def _array_files(spark: SparkSession, path: str) -> list[str]:
    """The folder's files whose first character that is no blank opens a JSON array, as ``_metadata`` names them.

    Partial minima per file, so one row per file and task is shuffled; the list is as long as the folder's listing,
    which the driver holds to plan the read anyway.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_GLOB).text(path)
             .select(F.substring(F.regexp_replace("value", r"^[\s\x{FEFF}]+", ""), 1, 1).alias("first"),
                     F.col("_metadata.file_path").alias("file"),
                     F.struct(F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("line")).alias("place")))
    opened = lines.where("first <> ''").groupBy("file").agg(F.min_by("first", "place").alias("first"))
    return sorted(r["file"] for r in opened.where("first = '['").select("file").collect())


def read_landing(spark: SparkSession, root: str, folder: str, layout: str = "lines") -> DataFrame:
    """``(value VARIANT, raw_json STRING, _source_file STRING)`` for one folder.

    ``lines``: every non-blank line is one record.  ``array``: every file is a
    JSON array and each element becomes one record.  ``auto``: the first
    character of each file that is no blank decides for that file; this reads
    the folder once more, in a job of its own.  An empty file has no record.
    Reading as text keeps the raw JSON alongside the parsed VARIANT (a VARIANT
    cannot be a grouping key).
    """
    path = f"{root.rstrip('/')}/{folder}"
    if layout == "lines":
        raw = _records_by_line(spark, path)
    elif layout == "array":
        raw = _records_by_array(spark, [path])
    elif layout == "auto":
        arrays = _array_files(spark, path)
        raw = _records_by_line(spark, path)
        if arrays:
            named = spark.createDataFrame([(a,) for a in arrays], "_source_file string")
            raw = raw.join(named, "_source_file", "left_anti").select("raw_json", "_source_file")
            raw = raw.unionByName(_records_by_array(spark, [_GLOB_CHARS.sub(r"\\\1", unquote(a)) for a in arrays]))
    else:
        raise ValueError("layout must be 'lines', 'array' or 'auto'")
    return raw.select(F.try_parse_json("raw_json").alias("value"), "raw_json", "_source_file")


def to_bronze(landing: DataFrame, key_path: str, key_name: str, run_id: str,
              loaded_at: Column | _dt.datetime | None = None) -> DataFrame:
    """Natural key from a JSON path, raw payload, file, load time, run id.

    ``loaded_at`` defaults to the query's current timestamp; pass a value for
    reproducible output.
    """
    if loaded_at is None:
        ts = F.current_timestamp()
    elif isinstance(loaded_at, Column):
        ts = loaded_at
    else:
        ts = F.lit(loaded_at).cast("timestamp")
    key = F.try_variant_get(F.col("value"), key_path, "string")
    return landing.select(
        key.alias(key_name),
        F.col("raw_json").alias("raw_payload"),
        "_source_file",
        ts.alias("_loaded_at"),
        F.lit(run_id).alias("_batch_id"),
    )


def payload(df: DataFrame, raw_col: str = "raw_payload") -> Column:
    """Parsed VARIANT of a bronze payload column."""
    return F.try_parse_json(F.col(raw_col))


def key_from_payload(raw: Column | str, path: str) -> Column:
    c = F.col(raw) if isinstance(raw, str) else raw
    return blank_to_null(F.get_json_object(c, path))
