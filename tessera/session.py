"""Session construction and the shared folder used for checkpoints and staged files.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system such as HDFS or an object store). A machine-local folder is only ever
created when that setting is unset *and* the master is local, as in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = "local[8]", app: str = "tessera", shuffle_partitions: int | None = 8,
                  extra: dict | None = None) -> SparkSession:
    """A session configured for these operators: AQE on (partition coalescing and
    skew-join splitting), UTC, UI off. ``extra`` overrides any setting.

    With ``master=None`` and ``shuffle_partitions=None`` the cluster's own master, memory
    and shuffle partitions hold (spark-submit, spark-defaults)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWNED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged files.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the context).
    Only when neither is set and the master is local does it make a folder of its
    own, and it registers that as the checkpoint directory.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset is the common case
            base = None
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tessera-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder.

    All paths of one application lie in one folder that belongs to it. The folder is
    registered with the file system to be deleted when the application ends; an
    application may delete a path of its own earlier."""
    folder = f"{shared_dir(spark)}/tessera-scratch/{spark.sparkContext.applicationId}"
    if folder not in _OWNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _OWNED.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder (eager)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str = "stored"):
    """``df`` written to parquet in the shared folder and read back: for tables that are read
    several times, at a fraction of a checkpoint's bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df):
    """Round-robin ``df`` over the cluster's cores when it arrives in fewer
    partitions than that -- a small input stored as one parquet row group is
    read by a single task, and heavy per-row work after the scan (splitting texts,
    feature arithmetic, iterations over cached points) would run on one core.
    A large input already has more partitions than cores: then this is a no-op
    and adds no shuffle. Apply it to a scan or a narrow projection/filter of one:
    reading the partition count of an input that contains a shuffle would run
    that shuffle's first stage."""
    if _SHUFFLING.search(df._jdf.queryExecution().optimizedPlan().toString()):
        return df  # already spread by its own exchange; do not run it to find out
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


# Logical operators that plan an exchange (their output has shuffle parallelism).
_SHUFFLING = re.compile(r"(^|[\s+:-])(Aggregate|Join|Repartition\w*|Sort|Window|Deduplicate\w*|Distinct)\b",
                        re.MULTILINE)
