"""Vault tables as plain Spark tables under one shared folder.

Every table has one of four layouts, and every write is one of Spark's own:

* ``append``: hub and rejects only grow. Bucketed by a key, they are joined on it where they lie.
* ``versions``: a satellite is appended to as well, whole rows with a running number; the newest row of a
  key counts. A load writes only the rows it changes, and in a bucketed table neither the join of a load
  nor the choice of the newest row moves the satellite.
* ``partitions``: snapshots (by batch), process log, batch control and watermarks are replaced partition by
  partition with dynamic partition overwrite; a rerun of a batch touches the files of that batch alone.
  The history is appended to, in partitions by a prefix of the hash diff, so that a load reads only the
  prefixes of the versions it archives.
* ``replace``: marts are written anew.

There is no commit log: a table is what its folder holds. A write becomes visible when Spark commits its
job, table by table. A load writes its tables in an order that a rerun completes (hub, history,
satellite, watermark, log), as the statements of a warehouse procedure do. One writer at a time per
appended table; partitions of different loads do not touch. The bucket count stands in the folder's name.
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultkit.operators.dedupe import latest_by
from vaultkit.operators.delta import SEQ


class VaultStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # --- folders ------------------------------------------------------------------------------
    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(sc._jsc.hadoopConfiguration())

    def folder(self, table: str) -> tuple[str, int] | None:
        """(folder, bucket count or 0) of a table, None if it has never been written."""
        root, fs = self._fs(self.base)
        best = None
        for s in fs.listStatus(root) if fs.exists(root) else ():
            m = re.fullmatch(re.escape(table) + r"(?:-b(\d+))?(?:\.g(\d+))?", s.getPath().getName())
            if not m:
                continue
            path, generation = f"{self.base}/{s.getPath().getName()}", int(m[2] or 0)
            whole = not generation or fs.exists(self._fs(f"{path}/_SUCCESS")[0])       # a rewrite that did not end does not count
            if whole and (best is None or generation > best[2]):
                best = path, int(m[1] or 0), generation
        return best and best[:2]

    def exists(self, table: str) -> bool:
        return self.folder(table) is not None

    def buckets(self, table: str) -> int:
        found = self.folder(table)
        return found[1] if found else 0

    def files(self, table: str) -> list[str]:
        """Data files of a table."""
        found = self.folder(table)
        if found is None:
            return []
        path, fs = self._fs(found[0])
        it, out = fs.listFiles(path, True), []
        while it.hasNext():
            name = it.next().getPath().toString()
            if name.endswith(".parquet"):
                out.append(name)
        return sorted(out)

    # --- reads --------------------------------------------------------------------------------
    def rows(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """Everything in the table, without choosing newest rows; a bucketed table with its layout.

        ``schema`` conforms files of other shapes (columns they lack are NULL, others are left out); without
        it the table's noted shape does, or else the columns of all files are merged."""
        found = self.folder(table)
        if found is None:
            return None
        path, n = found
        if n:
            return self._bucketed(path, "hashkey", n, schema or self.shape(table) or self._merged(path).schema)
        schema = schema or self.shape(table)
        if schema is None:
            return self._merged(path)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)     # partition columns in their place

    def _merged(self, path: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(path)

    def _bucketed(self, path: str, key: str, n: int, schema: T.StructType) -> DataFrame:
        return self.spark.table(self._declared(path, key, n, schema))

    def _declared(self, path: str, key: str, n: int, schema: T.StructType) -> str:
        """Name of the folder as a table of this session's catalog, with its bucket layout."""
        name = "vk_" + uuid.uuid5(uuid.NAMESPACE_URL, f"{path} {schema.simpleString()}").hex
        if self.spark.catalog.tableExists(name):
            self.spark.catalog.refreshTable(name)
        else:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                           f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'")
        return name

    def current(self, table: str, schema: T.StructType) -> DataFrame | None:
        """The newest row per hashkey of a ``versions`` table."""
        found = self.rows(table, versioned(schema))
        return None if found is None else latest_by(found, ["hashkey"], [SEQ]).drop(SEQ)

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The table's current rows; a satellite by its usual name (``sat_...``) is a ``versions`` table."""
        if schema is not None and table.startswith("sat_") and not table.endswith(("_hist", "_seen")):
            return self.current(table, schema)
        return self.rows(table, schema)

    def shape(self, table: str) -> T.StructType | None:
        """The columns a table has now, if its writer notes them (``note_shape``)."""
        path, fs = self._fs(f"{self.base}/{table}.shape")
        return self.spark.read.parquet(f"{self.base}/{table}.shape").schema if fs.exists(path) else None

    def note_shape(self, table: str, df: DataFrame) -> None:
        """From now on the table has the columns of ``df``: rows of older files get NULL in columns they lack,
        and columns that are gone are no longer read. Files are not rewritten."""
        df.limit(0).write.mode("overwrite").parquet(f"{self.base}/{table}.shape")

    def read_batch(self, table: str, batch_id: str, schema: T.StructType | None = None) -> DataFrame | None:
        """One partition of a table by batch: only its files are listed and read."""
        found = self.rows(table, schema)
        return None if found is None else found.where(F.col("etl_batch_id") == batch_id)

    # --- writes -------------------------------------------------------------------------------
    def append(self, table: str, df: DataFrame, buckets: int | None = None, partition_by: tuple[str, ...] = ()) -> int:
        """Add rows; returns their number. ``buckets`` counts for a table that is new: bucketed by hashkey, sorted within."""
        path, n = self.folder(table) or (self._new(table, buckets), int(buckets or 0))
        return self._append(path, n, df, partition_by)

    def _new(self, table: str, buckets: int | None, generation: int = 0) -> str:
        return f"{self.base}/{table}" + (f"-b{int(buckets)}" if buckets else "") + (f".g{generation}" if generation else "")

    def _append(self, path: str, n: int, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        if n:
            folder, fs = self._fs(path)
            fs.mkdirs(folder)
            name = self._declared(path, "hashkey", n, df.schema)
            return counted(df.repartition(n, "hashkey"), lambda rows: rows.write.insertInto(name))
        return counted(df, lambda rows: (rows.write.mode("append").partitionBy(*partition_by) if partition_by else rows.write.mode("append")).parquet(path))

    def append_synced(self, table: str, df: DataFrame) -> int:
        """Append ``df`` and give the table its columns."""
        n = self.append(table, df)
        self.note_shape(table, df)
        return n

    def add_versions(self, table: str, df: DataFrame, buckets: int | None = None) -> int:
        """Append whole rows that count from now on for their keys."""
        return self.append(table, df.withColumn(SEQ, F.lit(time.time_ns())), buckets)

    def replace_partitions(self, table: str, df: DataFrame, partition_by: tuple[str, ...]) -> int:
        """Dynamic partition overwrite: the partitions that ``df`` has rows for are replaced, no other file is touched."""
        return counted(df, lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                       .partitionBy(*partition_by).parquet(f"{self.base}/{table}"))

    def replace(self, table: str, df: DataFrame) -> int:
        return counted(df, lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.base}/{table}"))

    def rewrite(self, table: str, df: DataFrame, buckets: int | None = None) -> None:
        """Put ``df``, which may be computed from the table itself, in place of its files: a new folder is
        written whole, then the old one goes. Not for use beside readers or writers of the table."""
        old = self.folder(table)
        m = re.search(r"\.g(\d+)$", old[0]) if old else None
        self._append(self._new(table, buckets, int(m[1]) + 1 if m else 1), int(buckets or 0), df)
        if old is not None:
            path, fs = self._fs(old[0])
            fs.delete(path, True)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that ``write`` wrote, observed by the write itself: no job only counts."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def versioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SEQ, T.LongType())])


def scratch_store(spark: SparkSession, name: str = "vault") -> VaultStore:
    """A store under the session's checkpoint folder (shared storage on a cluster)."""
    from vaultkit.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return VaultStore(spark, os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}"))
