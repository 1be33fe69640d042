"""Tables as versioned Parquet snapshots, and merges into them.

Parquet tables know no MERGE. A merge is a join that makes the next snapshot; the snapshot is written to a folder of its own
and then named by an empty pointer file whose name has the next number and the snapshot. The highest number counts, and no pointer is
ever replaced, so readers see the old or the new table, never a part and never nothing, wherever a writer stops.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], update: list[str], rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows of changes by key: new ones come in, known ones change in the ``update`` columns only. rules: for a column, an
    expression over ``old`` and ``new`` (aliases of the two rows). changes has one row for each key."""
    rules = rules or {}
    old, new = target.alias("old"), changes.alias("new")
    on = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    both = old.withColumn("_old", F.lit(True)).alias("old").join(new.withColumn("_new", F.lit(True)).alias("new"), cond, "full")
    is_old, is_new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    def value(c: str) -> Column:
        if c not in changes.columns:
            return F.col(f"old.{c}")
        fresh = rules.get(c, F.col(f"new.{c}"))
        if c in keys:
            return F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}"))
        kept = F.when(is_old & is_new, fresh if c in update else F.col(f"old.{c}"))
        return F.when(is_old & ~is_new, F.col(f"old.{c}")).when(~is_old, F.col(f"new.{c}")).otherwise(kept)

    return both.select(*[value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not there yet, each key once; what is there stays as it is."""
    fresh = rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]))


def replace_where(target: DataFrame, drop: Column, rows: DataFrame) -> DataFrame:
    """Without the rows that ``drop`` says, and with the new ones."""
    return target.where(~F.coalesce(drop, F.lit(False))).unionByName(rows.select(target.columns))


def uuid_of(*parts: str | Column) -> Column:
    """A UUID that depends on its parts, so that a replay makes the same rows."""
    h = F.sha2(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


class Store:
    """The engine's tables under one folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda name: path(f"{folder}/{name}")
        self.fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _pointers(self, table: str) -> list[str]:
        folder = self._path(table)
        if not self.fs.exists(folder):
            return []
        names = sorted(f.getPath().getName() for f in self.fs.listStatus(folder))
        return [n for n in names if n.startswith("current-")]

    def _version(self, table: str) -> str | None:
        found = self._pointers(table)
        return found[-1].split("-", 2)[2] if found else None

    def read(self, table: str) -> DataFrame:
        version = self._version(table)
        kind = schema.TABLES[table]
        return self.spark.read.schema(kind).parquet(f"{self.folder}/{table}/{version}") if version else self.spark.createDataFrame([], kind)

    def write(self, table: str, df: DataFrame) -> None:
        """The next snapshot. The pointer's name holds its number and its version, so it is whole as soon as it exists; of
        two writers that read the same snapshot the later one is refused."""
        found = self._pointers(table)
        number = int(found[-1].split("-")[1]) + 1 if found else 1
        version = f"v-{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.TABLES[table]]).write.parquet(f"{self.folder}/{table}/{version}")
        if len(self._pointers(table)) != len(found):
            raise RuntimeError(f"{table} was written meanwhile; read it again")
        self.fs.create(self._path(f"{table}/current-{number:012d}-{version}"), False).close()
