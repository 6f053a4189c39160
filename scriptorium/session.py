"""Session helpers.

The library never creates its own cluster settings beyond what a job needs: it reads
``spark.checkpoint.dir`` from the session and only sets a folder when none is configured
(local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "scriptorium") -> SparkSession:
    """Session for local runs and tests: AQE on, UI off, Arrow on, UTC."""
    master = master or "local[{}]".format(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or int(os.environ.get("SCRIPTORIUM_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SCRIPTORIUM_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Only a local-mode session (tests, a laptop) with
    none configured gets a scratch folder; on a cluster the setting must name shared storage."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a local SparkContext, e.g. Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if configured or current:
        if sc is not None and not current:
            sc.setCheckpointDir(configured)
        return configured or current
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if master != "local" and not master.startswith("local["):
        # a machine-local folder is not shared by the executors of a cluster
        raise ValueError("spark.checkpoint.dir is not set: point it at a folder shared by the cluster "
                         "(HDFS, object store) before using operators that write intermediate tables")
    local = tempfile.mkdtemp(prefix="scriptorium-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    else:
        spark.conf.set("spark.checkpoint.dir", local)
    return local


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# rows of one Arrow batch of whole documents: a batch has to fit in a worker's memory whatever
# the session's default (10,000 rows) is
ARROW_ROWS = 512


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that operators on whole documents read."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


# folders written by materialize() / scratch_path(), per application id
_SCRATCH: dict[str, list[str]] = {}


def _remember(spark, path: str) -> str:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        app = "session"
    _SCRATCH.setdefault(app, []).append(path)
    return path


def scratch_folders(spark) -> list[str]:
    """The intermediate folders this application has written so far."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        app = "session"
    return list(_SCRATCH.get(app, []))


def drop_scratch(spark) -> int:
    """Delete the intermediate tables this application wrote under the checkpoint folder
    (through the Hadoop FileSystem of each path, so HDFS and object stores work). Call it
    when the results that read them have been written or collected. Returns the number of
    folders removed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for path in scratch_folders(spark):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p) and fs.delete(p, True):
            removed += 1
    try:
        _SCRATCH.pop(spark.sparkContext.applicationId, None)
    except Exception:  # noqa: BLE001
        _SCRATCH.pop("session", None)
    return removed


def materialize(df, tag: str = "table", codec: str | None = None):
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back.

    Used where two branches of a plan must see exactly the same rows in the same
    partitions (e.g. the range-partitioned ranks): the written table cuts the lineage, so a
    lost executor re-reads files instead of re-deriving partition boundaries. ``codec``: another compression than the session's.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = _remember(spark, f"{base}/scriptorium-{tag}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)


def release(df) -> int:
    """Delete the tables that ``materialize`` wrote and ``df`` reads: for rows that nothing will read again, neither ``df``
    nor what is derived from it and not written yet. Returns the number of folders removed."""
    spark = df.sparkSession
    read = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    conf, removed = spark._jsc.hadoopConfiguration(), 0
    for path in scratch_folders(spark):
        if path.rsplit("/", 1)[-1] in read:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            removed += bool(p.getFileSystem(conf).delete(p, True))
    return removed


def scratch_path(spark, tag: str) -> str:
    """A fresh folder name under the session's checkpoint folder (shared on a cluster)."""
    import uuid

    return _remember(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/scriptorium-{tag}-{uuid.uuid4().hex}")
