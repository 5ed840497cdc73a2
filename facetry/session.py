"""Session helpers: checkpoints in the shared folder, size checks before broadcasts."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when a count over it (already materialised) shows it
# fits both bounds; otherwise the caller takes its shuffle plan.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def local_session(app: str = "facetry", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you have."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application.

    The operators that run Python in tasks call this, so nothing has to be installed on the
    executors.
    """
    application = spark.sparkContext.applicationId
    package = Path(__file__).resolve().parent
    if application in _shipped or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="facetry-package-")) / "facetry"
    spark.sparkContext.addPyFile(
        shutil.make_archive(str(target), "zip", str(package.parent), package.name)
    )
    _shipped.add(application)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="facetry-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it from there afterwards.

    Cuts the lineage, so later steps neither recompute it nor depend on the executors
    that produced it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Spark removes an action's shuffle files at its end instead of when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize_released(df: DataFrame) -> DataFrame:
    """``materialize`` that leaves only the result on the disks: the shuffle files it needed go with it.

    The setting holds for the plan made here; ``df`` and the session's other frames are as before.
    """
    spark = df.sparkSession
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        return materialize(df.select("*"))
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


SPREAD_MAX_BYTES = 1 << 30


def read_spread(spark: SparkSession, path: str, key: str, *columns: str) -> DataFrame:
    """Read some columns of a Parquet table, a small one with at least one task per core.

    Parquet is split by row group, so a small table arrives as one task. Only then, and only
    up to ``SPREAD_MAX_BYTES`` of files, is it hash-partitioned on ``key``; any other table is read
    as it is, unshuffled (lower ``spark.sql.files.maxPartitionBytes`` for more tasks).
    """
    whole = spark.read.parquet(path)
    df = whole.select(*columns) if columns else whole
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    size = int(str(whole._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size <= SPREAD_MAX_BYTES else df


def fits_broadcast(
    lookup: DataFrame,
    text_column: str | None = None,
    row_bytes: int = 16,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> bool:
    """Measure a materialised lookup table against the broadcast bounds."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    text = F.sum(F.octet_length(text_column)) if text_column else F.lit(0)
    row = lookup.agg(F.count(F.lit(1)).alias("n"), F.coalesce(text, F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] + row["n"] * row_bytes <= max_bytes


def hot_limit(
    lookup: DataFrame, rank: str, most: int, text_column: str | None = None, row_bytes: int = 16
) -> int:
    """The largest rank, ``most`` or a fraction of it, up to which the rows may be broadcast."""
    hot = most
    while hot and not fits_broadcast(lookup.where(F.col(rank) <= hot), text_column, row_bytes, max_rows=most):
        hot //= 4
    return hot
