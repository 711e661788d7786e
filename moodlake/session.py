"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}

#: Rows that a Python worker holds at once, at most.
ARROW_ROWS = 1000


def build_session(master: str | None = None, app: str = "moodlake", **conf: str) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A text may be 100 KB and more; this bounds what a Python worker holds at once.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        # Deduplication state may outgrow the heap; RocksDB keeps it on disk.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every date in the library is a UTC date."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_batches(spark: SparkSession) -> SparkSession:
    """A session made elsewhere gives its Python workers no larger batches than one made here."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may do without: it takes a
    folder of its own. On a cluster the setting is required, and a folder of the local file
    system is refused, since other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    if root:
        if root.startswith("file:") and not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is {root}, which other machines cannot reach")
        return root.rstrip("/")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="moodlake-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder; it does not exist yet."""
    return f"{scratch_root(spark)}/moodlake/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and gives Spark the real
    size, so that it broadcasts the result only if it is under the threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
