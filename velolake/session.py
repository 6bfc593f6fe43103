"""Session helpers: a tuned local/cluster session and the shared lake folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import SparkSession

# SQL settings every velolake plan relies on, applied to any session it runs in:
# event-time logic (hour truncation, calendar parts, window bounds) is defined in UTC.
REQUIRED_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

BASE_CONF = {
    **REQUIRED_SQL_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits follow the data (row groups of up to 128 MB); a small open cost lets a table of
    # many small files use all cores.
    "spark.sql.files.openCostInBytes": "1m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "velolake",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  rocksdb_state: bool = False) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    ``shuffle_partitions`` should follow the cluster: roughly total input bytes of the
    widest shuffle / 128 MB; AQE coalesces small partitions at run time.  A stream's
    state-store partition count is fixed at its checkpoint's first run, from this value
    unless the stream is started with ``state_partitions`` (see ``append_sink``).
    ``rocksdb_state`` keeps streaming state (mart windows, ``state``-mode dimensions) in
    RocksDB on local disk instead of the executor heap, for large state.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def per_context(fn):
    """Cache a zero-argument builder of Column expressions per live SparkContext.

    Column trees are unresolved expressions, independent of any DataFrame, so a rule set
    or payload struct built once can be reused by every plan; rebuilding one costs
    hundreds of Python-to-JVM calls.  The cache is keyed by the context, so a new
    session after ``stop()`` rebuilds.
    """
    cache: dict = {}

    def wrapper():
        sc = SparkContext._active_spark_context
        key = id(sc._jsc) if sc is not None else None
        if key not in cache:
            cache.clear()
            cache[key] = fn()
        return cache[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@contextmanager
def scoped_conf(spark: SparkSession, key: str, value):
    """Set a runtime SQL conf for the duration of the block, then restore it."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def apply_required_conf(spark: SparkSession) -> None:
    """Set :data:`REQUIRED_SQL_CONF` on a session created elsewhere (runtime SQL confs)."""
    for k, v in REQUIRED_SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where neither is
    set, a session that runs in one process (``local[...]``, as in tests) gets a folder of
    its own, registered as the checkpoint dir; on a cluster that is an error, as executors
    would each write to their own disk.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        return ctx_dir.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that the whole cluster shares (master {master})")
    local = tempfile.mkdtemp(prefix="velolake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_lake_root(spark: SparkSession, label: str = "lake") -> str:
    """A fresh lake folder under the shared dir, so a run never resumes an old checkpoint."""
    return f"{shared_dir(spark)}/velolake/{label}-{uuid.uuid4().hex[:12]}"
