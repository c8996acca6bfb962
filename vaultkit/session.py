"""SparkSession helpers: a session tuned for the vault loads, checkpoint folder, landed intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "vaultkit", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass the cluster's own session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VAULTKIT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, or None (e.g. a Spark Connect session)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names (``spark.checkpoint.dir``).

    Uses the session setting, else a folder already set on the SparkContext. With neither, a local
    master gets a scratch folder; any other master raises, as its executors share no local folder.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir() if sc is not None else None
    if existing:
        return existing
    if sc is not None and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="vaultkit-ckpt-")    # one machine, as in tests
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame, name: str = "table", key: str | None = None, buckets: int | None = None, table: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input a single time (an eager
    checkpoint of an unpersisted frame computes it twice). The folder is on the storage the
    cluster names in ``spark.checkpoint.dir``, so the result survives executor loss.

    With ``buckets`` it is written bucketed by ``key`` and sorted within, and read back with that layout:
    joins and aggregates on the key need no exchange of it. The layout stands in the session's catalog under
    the name ``table``, which the caller drops when the rows are no longer needed.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    tag = uuid.uuid4().hex
    path = os.path.join(base, "materialized", f"{name}-{tag}")
    if buckets:
        table = table or f"landed_{tag}"
        df.write.mode("errorifexists").bucketBy(int(buckets), key).sortBy(key).option("path", path).saveAsTable(table)
        delete_at_end(spark, path)
        return spark.table(table)
    df.write.mode("errorifexists").parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the driver delete an intermediate folder when the application ends."""
    sc = _context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
