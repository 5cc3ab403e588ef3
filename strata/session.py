"""Session set-up and the shared scratch area.

Only runtime SQL confs are touched on an existing session, so ``configure`` is
safe to call on a session somebody else built (the driver's, a cluster's).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime confs every strata job relies on. UTC pins the meaning of zone-less
# timestamp text (the source writes UTC without an offset); AQE re-plans joins
# from measured sizes (broadcast only when the built side is measured small,
# skew split otherwise) and coalesces small shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with strata's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    tests use ``local[*]`` with a handful of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **RUNTIME_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 512 << 20,
               executor_cores: int | None = None) -> dict[str, str]:
    """Partition sizing for a job reading about ``input_bytes``.

    Scans split files into ``partition_bytes`` pieces; shuffles start with one
    partition per ``partition_bytes`` of input (AQE then coalesces small ones and
    splits skewed ones towards the same advisory size), so a partition's working
    set stays a fixed size however large the data grows. At 100 TB and 512 MB
    that is ~200k initial shuffle partitions.
    """
    n = max(1, -(-input_bytes // partition_bytes))
    if executor_cores:
        n = max(n, 2 * executor_cores)
    size = str(partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs strata needs to an existing session."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set and the master is local — tests, a notebook — a private folder is created
    and registered, so every later ``checkpoint()`` lands there too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context;
        sc = None      # checkpoint() there reads spark.checkpoint.dir itself
    if not root and sc is not None:
        current = sc.getCheckpointDir()
        if current:
            # the context appends a random sub-folder; its parent is the shared root
            root = os.path.dirname(current.rstrip("/"))
    if not root:
        if sc is not None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared checkpoint root for written intermediates."""
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{checkpoint_root(spark)}/strata/{leaf}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files go when the query that wrote them ends, not when the driver collects garbage. A
    frame that is run twice makes its stages twice, so this is for steps that run each once. Spark
    before 4.1 doesn't know the setting and keeps the files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def in_passes(df: DataFrame, by: Sequence[str], passes: int) -> list[DataFrame]:
    """``df`` in disjoint pieces by a hash of the columns ``by``. Where these are the keys that ``df``
    is grouped or joined by, the condition reaches the scans, and a piece shuffles its own rows only."""
    if passes <= 1:
        return [df]
    piece = F.pmod(F.xxhash64(*by), F.lit(passes))
    return [df.filter(piece == F.lit(i)) for i in range(passes)]


@contextmanager
def written(df: DataFrame, name: str, by: Sequence[str] = (), passes: int = 1):
    """The rows of ``df``, computed once: written to the shared scratch area as compressed columns and
    read back, so a lost executor re-reads them. With ``passes`` it is written piece by piece (see
    ``in_passes``). The folder goes when the block ends, so what was made of the rows has to be
    written by then."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        for piece in in_passes(df, by, passes):
            piece.write.mode("append").option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - a Spark Connect session has no JVM at hand: the folder stays
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)
