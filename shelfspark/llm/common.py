"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a fresh local one only where the setting is absent (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="corpus-ckpt-")
        spark.sparkContext.setCheckpointDir(found)
    return found


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="corpus-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors.
    ``options`` are the Parquet writer's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rest() -> None:
    """Give freed memory back to the system; a task calls it at its end, as its worker may stay idle for long."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def held_out(doc_id: Column) -> Column:
    """True for the documents that no classifier may learn from: crc32(doc_id as text) mod 4 is 2.
    A null id is never learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that columns with clashing names never meet the operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def kept_rows(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` that evaluates the columns behind the condition once: a filter is not pushed below a
    projection that numbers rows, where it would repeat every expression that its columns stand for."""
    return df.withColumn("_at", F.monotonically_increasing_id()).where(condition & (F.col("_at") >= 0)).drop("_at")


def keyed(docs: DataFrame) -> DataFrame:
    """``key`` (long, unique), ``row`` (struct of all columns) and ``text``; columns of the table can't clash with them.
    The key depends on how the scan is split, which follows the cores of the moment: it holds within one job.  Where
    several jobs use it, they must read the rows as ``stored`` once."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.monotonically_increasing_id().alias("key"), row.alias("row"), F.col("`text`").alias("text"))
