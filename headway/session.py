"""Session defaults and the one place that decides where durable intermediates go."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Feed timestamps carry no zone and are read as UTC, so the session must be UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep pre-shuffle splits small enough for a reducer to hold its partition in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Durable intermediates go away with the frames that read them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


GIB = 1 << 30
MAX_SHUFFLE_PARTITIONS = 100_000
ARROW_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH = "4m"


def sizing(
    input_bytes: int,
    least: int = 200,
    most: int = MAX_SHUFFLE_PARTITIONS,
    partition_bytes: int = GIB,
    long_splits_from: int = 10_000 * GIB,
) -> dict[str, str]:
    """Settings for a job that reads about this much.

    Adaptive execution merges shuffle partitions but never splits them (other than skewed joins and
    rebalances), so their initial number has to fit the largest shuffle: ``partition_bytes`` each, which
    the sorting and aggregating operators here can spill, within ``least`` and ``most`` partitions. Reads
    of ``long_splits_from`` bytes take longer splits, since the shuffle has a block for every pair of map
    and reduce task.
    """
    partitions = min(max(-(-input_bytes // partition_bytes), least), most)
    split = "128m" if input_bytes < long_splits_from else "1g"
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": split,
    }


def get_session(
    app_name: str = "headway", master: str | None = None, input_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with this package's defaults; ``conf`` keys use ``__`` for dots.

    Give ``input_bytes``, a rough size of what the job reads, on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **(sizing(input_bytes) if input_bytes else {})}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_session(df: DataFrame, **bounds) -> int:
    """Size the shuffles of ``df``'s session for a job that reads it all; returns its size in bytes.

    The size is the one that Spark plans with: that of the files, or of the table's statistics. Settings
    that the application was started with stay, and there are never fewer than the session's own partitions.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())
    bounds.setdefault("least", int(spark.conf.get("spark.sql.shuffle.partitions")))
    given = spark.sparkContext.getConf()
    for key, value in sizing(size, **bounds).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return size


def shuffle_tasks(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def small_arrow_batches(spark: SparkSession) -> None:
    """From now on rows go to Python tasks in Arrow batches of ``ARROW_BATCH`` bytes, unless a size was set.

    A batch is held by the JVM, outside its heap, and by the Python worker, for each running task. The session's
    default, 10,000 rows up to 64 MB, gives whole texts the most of an executor's memory beside the heap.
    """
    if spark.conf.get(ARROW_BATCH_KEY, None) is None:
        spark.conf.set(ARROW_BATCH_KEY, ARROW_BATCH)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: the configured one, or a temporary one in local mode.

    The temporary one goes when the process ends.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="headway-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the files.

    Used where two readers must see the very same partitioning of a frame. Runs a job at once; the
    files live in shared storage, so losing an executor loses nothing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
