"""Incremental landing -> bronze ingestion as a Structured Streaming query.

The reference loads bronze by repeated batch runs that append only unseen
(key, file) rows.  Here the file source tracks which landing files were
already read (in the checkpoint), and each micro-batch is written through
``foreachBatch`` as a load of its own (``load=<query>-<epoch>``), so a replayed
micro-batch overwrites what its first try left.  Which rows are new is asked of
the log of loaded files (``_load_log``, which readers of the target don't see):
a micro-batch of new files reads no row of the target.  ``trigger(availableNow=True)`` gives the batch
"run now, process everything new, stop" behaviour; a processing-time trigger
turns it into a continuous feed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators.load_log import LOG_SCHEMA, log_entries, new_rows_logged
from shelfspark.sources.landing import JSON_GLOB, to_bronze
from shelfspark.sources.sinks import cut_lineage


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def landing_stream(spark: SparkSession, landing_root: str, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming ``(raw_json, _source_file)`` over the line-delimited JSON files of one folder."""
    return (spark.readStream.format("text")
            .option("pathGlobFilter", JSON_GLOB)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(f"{landing_root.rstrip('/')}/{folder}")
            .select(F.col("value").alias("raw_json"), F.col("_metadata.file_path").alias("_source_file"))
            .filter(F.trim("raw_json") != ""))


def start_bronze_ingest(spark: SparkSession, landing_root: str, folder: str, key_path: str, key_name: str,
                        target_path: str, checkpoint_path: str, run_id: str, available_now: bool = True,
                        processing_time: str = "1 minute"):
    """Start the landing -> bronze query; returns the ``StreamingQuery``.

    ``target_path`` and ``checkpoint_path`` must be on shared storage on a cluster.
    """

    keys, base = [key_name, "_source_file"], target_path.rstrip("/")
    query = hashlib.md5(checkpoint_path.encode()).hexdigest()[:8]  # epochs count anew in another checkpoint

    def append_new(batch: DataFrame, epoch_id: int) -> None:
        landing = batch.select(F.try_parse_json("raw_json").alias("value"), "raw_json", "_source_file")
        bronze = cut_lineage(to_bronze(landing, key_path, key_name, f"{run_id}-{epoch_id}"))
        load, log_path = f"{query}-{epoch_id}", f"{base}/_load_log"
        log = None
        if _exists(spark, log_path):
            log = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log_path).where(F.col("load") != load)

        def rows_of(loads: list[str]) -> DataFrame:
            return spark.read.schema(bronze.schema).parquet(*[f"{base}/load={x}" for x in loads])

        new_rows_logged(bronze, log, rows_of, keys, "_source_file").write.mode("overwrite").parquet(f"{base}/load={load}")
        log_entries(rows_of([load]), keys, "_source_file", load).write.mode("overwrite").parquet(f"{log_path}/{load}")

    writer = (landing_stream(spark, landing_root, folder).writeStream
              .foreachBatch(append_new)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
