"""Session construction and the shared checkpoint folder.

Every job in the package is a plain DataFrame / SQL / Structured Streaming
plan; this module only pins the settings those plans rely on.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The state store of the streams.  Spark's own default (HDFSBackedStateStoreProvider)
# can't run transformWithState.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each commit uploads only the batch's changes; full snapshots are written
    # in the background.  Same recovery guarantees, much cheaper micro-batches.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings the plans assume.  Time arithmetic is done on TIMESTAMP_NTZ values
# and is zone independent, but file names and JSON output are defined in UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    **STATE_STORE_CONF,
}


def build_session(master: str | None = None, app: str = "topicscope",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; the
    shuffle partition count should then be sized to the input (about
    128-256 MB of shuffle data per partition), AQE coalesces the rest.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started within have the package's state store, whoever built the session; a
    query keeps the settings it was started with.  The session's own come back at the end."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE_CONF}
    try:
        for key, value in STATE_STORE_CONF.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever launches the job (a shared
    file system or object store); without it a cluster run is refused.  Only
    local runs and tests get a fresh scratch folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="topicscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    jsc = spark.sparkContext._jsc
    if jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), *[p.strip("/") for p in parts]])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (globs allowed), from file
    system metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        matches = fs.globStatus(hp) or []
        for st in matches:
            # a file's length comes with the listing; only folders need a summary
            total += st.getLen() if st.isFile() else \
                fs.getContentSummary(st.getPath()).getLength()
    return int(total)


def size_shuffle(spark: SparkSession, paths, shuffle_fraction: float = 0.02,
                 target_bytes: int = 128 << 20) -> int:
    """Raise the initial shuffle partition count so that the expected shuffle
    (``shuffle_fraction`` of the input; counting names per day shuffles about
    1.5% of it) lands in partitions of about ``target_bytes``; AQE coalesces
    downwards from there.  Never lowers a larger setting.  Returns the count."""
    want = int(input_bytes(spark, paths) * shuffle_fraction / target_bytes) + 1
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")
    n = max(int(current), want)
    spark.conf.set(key, str(n))
    return n


def size_scan(spark: SparkSession, paths, waves: int = 4, low: int = 128 << 20,
              high: int = 1 << 30, total_bytes: int | None = None) -> int:
    """Raise ``spark.sql.files.maxPartitionBytes`` so that a scan of ``paths``
    runs in about ``waves`` waves of tasks over the cluster's cores, between
    ``low`` and ``high`` bytes per task.  At 100 TB the default 128 MB makes
    about 800,000 tasks, and scheduling them costs more than the larger splits
    do.  The scan streams its split, so a larger split does not need more
    memory.  Never lowers a larger setting.  Returns the value in bytes."""
    total = input_bytes(spark, paths) if total_bytes is None else total_bytes
    cores = max(int(spark.sparkContext.defaultParallelism), 1)
    want = min(max(total // (cores * waves), low), high)
    key = "spark.sql.files.maxPartitionBytes"
    current = _bytes(spark, spark.conf.get(key, None) or f"{low}b")
    n = max(current, int(want))
    spark.conf.set(key, str(n))
    return n


def _bytes(spark: SparkSession, value: str) -> int:
    """A size setting (``128MB``, ``134217728``) in bytes, parsed by the JVM."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
               .byteStringAsBytes(value))
