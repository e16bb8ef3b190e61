"""Tables whose runs write only what they change: part folders behind a manifest (I4, I5, schema evolution).

A table is a folder with

* ``loads/load=<id>/_part=<value>/``: Parquet files, written once and never touched again;
* ``manifests/<id>/``: the version of the table that a run left: which load holds each part, and the schema.

``append`` adds a load.  ``merge`` reads the parts that the delivery touches, and no others, joins them with the
delivery by key, and writes these parts anew; the other parts stay with the loads that hold them.  So a run reads and
writes in proportion to its delivery's parts.  A run's last act is to write a manifest: readers of older manifests, and
runs that fail half-way, see the table as it was.

The part must follow from the key columns (a hash bucket of the key, or a date that belongs to it); otherwise an old row
of a key could stand in a part that the merge doesn't read.  A NULL part is a part of its own.

Schemas may grow between runs (``sync_all_columns``): a new column is NULL in older rows, a column that a delivery
lacks is NULL in its rows, and a widened type (byte to long, float to double, decimals with more digits) is read so from
the older files.  A change to a type that can't hold the old values is an error before anything is written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.sources.sinks import cut_lineage

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_NULL_PART = "none"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A part by key hash, for tables whose key holds no date."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both, if Parquet files of either can be read as it."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def reconcile(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of the old schema, widened where needed, then those that only the new one has; all nullable."""
    fields = [T.StructField(f.name, wider(f.dataType, new[f.name].dataType) if f.name in new.names else f.dataType) for f in old]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name not in old.names])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the schema's columns; those that it lacks are NULL."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


class PartitionedTable:
    """One version of a table; ``append`` and ``merge`` return the next one."""

    def __init__(self, spark: SparkSession, base: str, manifest: str | None = None):
        self.spark, self.base, self.manifest = spark, base.rstrip("/"), manifest
        self.parts: dict[str, list[str]] = {}  # part -> the loads that hold its rows
        self.schema: T.StructType | None = None
        if manifest is not None:
            # one row per part and load: as many as the folders that the table's files lie in
            for row in spark.read.schema("part string, load string").json(f"{manifest}/parts").collect():
                self.parts.setdefault(row.part, []).append(row.load)
            held = spark.read.schema("schema string").json(f"{manifest}/schema").first()
            self.schema = T.StructType.fromJson(json.loads(held["schema"]))

    @classmethod
    def open(cls, spark: SparkSession, manifest: str) -> PartitionedTable:
        return cls(spark, manifest.rstrip("/").rsplit("/manifests/", 1)[0], manifest)

    def read(self, parts: Sequence[str] | None = None, loads: Sequence[str] | None = None) -> DataFrame:
        """The table's rows, or those of some parts or loads; other folders are neither listed nor read."""
        wanted, held = None if parts is None else set(parts), None if loads is None else set(loads)
        paths = [
            f"{self.base}/loads/load={load}/_part={part}"
            for part, all_loads in self.parts.items()
            if wanted is None or part in wanted
            for load in all_loads
            if held is None or load in held
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema or T.StructType([]))
        return self.spark.read.schema(self.schema).parquet(*paths)

    def loads(self) -> list[str]:
        """The loads that hold rows of this version."""
        return sorted({load for all_loads in self.parts.values() for load in all_loads})

    def append(self, rows: DataFrame, part: Column, load: str | None = None) -> PartitionedTable:
        """Add rows as they are; nothing that is there is read."""
        schema = rows.schema if self.schema is None else reconcile(self.schema, rows.schema)
        return self._written(conform(rows, schema), part, schema, load, keep=True)

    def merge(self, incoming: DataFrame, keys: Sequence[str], part: Column) -> PartitionedTable:
        """MERGE by key: rows whose key is delivered again give way to the delivery, all others stay.

        A NULL in a key matches nothing.  The delivery is read once and kept in the checkpoint folder.
        """
        if self.schema is None:
            return self.append(incoming, part)
        schema = reconcile(self.schema, incoming.schema)
        fresh = cut_lineage(conform(incoming, schema))
        touched = [r["_part"] for r in fresh.select(_part(part)).distinct().collect()]  # parts of the delivery
        old = conform(self.read(touched), schema)
        kept = old.join(fresh.select(*keys).distinct(), on=list(keys), how="left_anti")
        return self._written(kept.unionByName(fresh), part, schema, None, keep=False)

    def _written(self, rows: DataFrame, part: Column, schema: T.StructType, load: str | None, keep: bool) -> PartitionedTable:
        load = load or uuid.uuid4().hex
        path = f"{self.base}/loads/load={load}"
        # rebalance: rows of a part meet in few files, a part with many rows is dealt over several tasks
        rows.withColumn("_part", _part(part)).hint("rebalance", "_part").write.partitionBy("_part").mode("overwrite").parquet(path)
        found = [r["_part"] for r in self.spark.read.option("basePath", path).schema("_part string").parquet(path).select("_part").distinct().collect()]
        nxt = PartitionedTable(self.spark, self.base)
        nxt.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        nxt.parts = {p: list(v) for p, v in self.parts.items()}
        for p in found:
            nxt.parts[p] = [x for x in nxt.parts.get(p, []) if keep and x != load] + [load]
        nxt.manifest = f"{self.base}/manifests/{uuid.uuid4().hex}"
        self.spark.createDataFrame([(nxt.schema.json(),)], "schema string").coalesce(1).write.json(f"{nxt.manifest}/schema")
        listed = [(p, x) for p, v in nxt.parts.items() for x in v]
        self.spark.createDataFrame(listed, "part string, load string").coalesce(1).write.json(f"{nxt.manifest}/parts")
        return nxt


def _part(part: Column) -> Column:
    """The part's folder name: signs that a path can't hold become ``_`` (two parts in one folder do no harm)."""
    name = F.regexp_replace(part.cast("string"), "[^A-Za-z0-9_-]", "_")
    return F.when(name != "", name).otherwise(F.lit(_NULL_PART)).alias("_part")

