"""Session construction and the few session-level settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import threading
import time

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings every job in this package assumes.  AQE re-plans joins from real
# shuffle sizes (runtime broadcast of small sides, skew-join splitting,
# partition coalescing), which is what keeps the plans healthy when one
# device, app or category holds a large share of the rows.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # post-shuffle partitions are coalesced towards this size, so a high
    # spark.sql.shuffle.partitions (set for the largest stage) costs little
    # on the small stages
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # independent fits are submitted side by side; none waits for all others
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, app_name: str = "profila",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session.  On a cluster pass ``master=None`` and let
    spark-submit decide; tests pass ``local[N]``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("PROFILA_DRIVER_MEMORY", "16g"))
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for key, value in BASE_CONF.items():
        if spark.conf.isModifiable(key):  # static settings stay as the session was built
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Only when it is unset (tests, a bare local
    session) is a folder of our own chosen."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(HDFS, object store); a machine-local folder cannot hold shared tables")
        configured = tempfile.mkdtemp(prefix="profila-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def tables_folder(spark: SparkSession) -> str:
    """Where this application's written tables lie."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/profila-tables/{spark.sparkContext.applicationId}"


def remove_tables(spark: SparkSession) -> None:
    """Remove this application's written tables, at the end of a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(tables_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


GIVE_BACK_S = 20
_given = {"lock": threading.Lock(), "at": 0.0}


def give_back(spark: SparkSession) -> bool:
    """Let the driver drop what ended passes and plans left behind (its cleaner frees
    their broadcasts and shuffles with the collected handles) and its heap shrink
    again: at most every ``GIVE_BACK_S`` seconds, whoever asks."""
    with _given["lock"]:
        if time.monotonic() - _given["at"] < GIVE_BACK_S:
            return False
        _given["at"] = time.monotonic()
    spark.sparkContext._jvm.System.gc()
    return True


def durable(df, read_as=None):
    """Write ``df`` once as a parquet table under the shared checkpoint
    folder (``spark.checkpoint.dir``) and return the table read back.

    This cuts the lineage like ``checkpoint()``: later jobs, and any task
    re-run after an executor is lost, read the written files instead of
    re-deriving them.  A columnar table is written and read far faster than
    the row-serialised files of an RDD checkpoint, and it is computed once
    (an unpersisted RDD checkpoint computes its plan twice).  ``read_as``: the
    schema to read the table back with."""
    import uuid
    spark = df.sparkSession
    path = f"{tables_folder(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    give_back(spark)
    return (spark.read.schema(read_as) if read_as else spark.read).parquet(path)


def run_concurrently(tasks: dict, workers: int = 4) -> dict:
    """Run independent driver-side stage builders (each submits its own
    Spark jobs) from a small thread pool, each in a scheduler pool of its own,
    so that under fair scheduling none waits for all others.  ``tasks``: name →
    zero-argument callable; returns name → result."""
    from concurrent.futures import ThreadPoolExecutor
    if workers <= 1 or len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    sc = SparkContext.getOrCreate()

    def pooled(name, task):
        sc.setLocalProperty("spark.scheduler.pool", str(name))
        return task()
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futs = {k: pool.submit(pooled, k, f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futs.items()}


def once(build):
    """A zero-argument callable that builds its value at the first call only,
    whichever of several threads makes it."""
    import threading
    lock, made = threading.Lock(), []

    def get():
        with lock:
            if not made:
                made.append(build())
            return made[0]
    return get
