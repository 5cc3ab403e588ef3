"""What the operators share: table reading, written intermediates, shared binary files.

Intermediates are Parquet under ``spark.checkpoint.dir`` (``session.checkpoint_root``), so a
lost executor costs a reread and not a recomputation, and nothing depends on a local disk.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_root, configure, scratch_path

#: Rows and bytes of one Arrow batch that goes to a Python task: bounds its memory.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def _ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python once per application: they need not have it
    installed and share no folder with the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._strata_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on (small Arrow batches, AQE)."""
    configure(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A column by its literal name (dots and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(df: DataFrame, keep: bool = True):
    """All columns of a frame as one struct ``row``: names inside can't clash with added ones."""
    names = df.columns if keep else [c for c in ("doc_id", "text") if c in df.columns]
    return F.struct(*[col(c) for c in names]).alias("row")


def unpack(df: DataFrame, names: list[str], *more):
    """The columns of ``row`` again, then ``more``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in names], *more)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    for written in _WRITTEN:
        written.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[list[str]] = []


@contextlib.contextmanager
def intermediates():
    """The folders that ``materialise`` writes in this block, in their order. A caller who has
    written out what was made of them may ``remove`` them."""
    written: list[str] = []
    _WRITTEN.append(written)
    try:
        yield written
    finally:
        _WRITTEN[:] = [w for w in _WRITTEN if w is not written]


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of the shared scratch area; others are refused."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for f in folders:
        if not f.startswith(checkpoint_root(spark) + "/strata/llm-"):
            raise ValueError(f"not an intermediate: {f}")
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, True)


def fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


# --- files in the shared folder -----------------------------------------------------------

def arrow_uri(uri: str) -> str:
    """A Hadoop URI by the name that pyarrow knows its store under: s3a and s3n are s3, wasb(s) of a
    blob endpoint is abfs(s) of the same account; gs, abfs(s), hdfs and viewfs are the same."""
    scheme, _, rest = uri.partition("://")
    if scheme in ("s3a", "s3n"):
        return f"s3://{rest}"
    if scheme in ("wasb", "wasbs"):
        host, _, path = rest.partition("/")
        return f"abfs{scheme[4:]}://{host.replace('.blob.', '.dfs.')}/{path}"
    return uri


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI or a plain path."""
    uri = arrow_uri(uri)
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if urlparse(uri).scheme == "file":
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, chunks) -> int:
    """Write chunks to a new file; the name must be unique per attempt."""
    fs, path = open_fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    n = 0
    with fs.open_output_stream(path) as out:
        for c in chunks:
            c = memoryview(c).cast("B")
            out.write(c)
            n += len(c)
    return n


def map_file(uri: str, dtype) -> np.ndarray:
    """A file as a read-only array: memory-mapped in place where the shared folder is mounted;
    from an object store it is first fetched to an unnamed task-local file."""
    fs, path = open_fs(uri)
    if fs.get_file_info(path).size == 0:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with tempfile.TemporaryFile() as tmp, fs.open_input_stream(path) as src:
        while block := src.read(8 << 20):
            tmp.write(block)
        tmp.flush()
        return np.memmap(tmp, dtype, mode="r")


def tidy() -> None:
    """Give freed memory back to the system: Python workers are used again by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


# --- Arrow helpers ------------------------------------------------------------------------

def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column, or the text field of ``row``, as an Arrow string array."""
    i = batch.schema.get_field_index(name)
    return batch.column(i) if i >= 0 else batch.column("row").field(name)


def with_columns(batch: pa.RecordBatch, names: list[str], more: dict) -> pa.RecordBatch:
    """``names`` of a batch plus new columns."""
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(more.values()), names=[*names, *more])


def list_array(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    """Arrow list column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
