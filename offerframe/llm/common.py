"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import json
import os
import tempfile
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# Bytes of text a task works on at a time: bounds the numpy temporaries.
SLICE_BYTES = 1 << 20


_SHIPPED: set[str] = set()


# Texts are handed to Python in batches of at most this: it bounds what a batch takes in the
# JVM's Arrow buffers and in the worker, however long the texts (the default is 64 MB).
ARROW_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that they need no installation of it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = Path(__file__).resolve().parents[1]
        name = Path(tempfile.mkdtemp(prefix="offerframe-code-"), f"{root.name}.zip")
        with zipfile.ZipFile(name, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(name))


_KEPT_BYTES = 256 << 20  # a Python worker that holds more gives back what it has freed


def release_memory() -> None:
    """Give a large worker's freed memory back to the system, so that it waits for its next task with little."""
    try:
        with open("/proc/self/statm") as f:
            if int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") < _KEPT_BYTES:
                return
        gc.collect()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another system: it decides itself
        pass


def lean(run):
    """`run` for mapInArrow, releasing the worker's freed memory at the end of every task."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


# --- fixed values: how the public word vocabulary's tokenizer prepares a text ----------
_WORD_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ------------------------------------------------------------------------------------------


def drops_white_space(coder) -> bool:
    """Whether a tokenizer splits texts at white space and drops it, as its own definition says: then the ids of a
    text are those of its parts between white space."""
    made = json.loads(coder.to_str())
    normal, pre = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers") or []
    return ([n.get("type") for n in normal.get("normalizers", [])] == _WORD_NORMALIZER
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0].get("pattern") == {"Regex": _WORD_SPLIT} and steps[0].get("invert") is True
            and steps[0].get("behavior") == "Removed" and not steps[1].get("add_prefix_space")
            and made["model"].get("end_of_word_suffix") == "</w>")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """`df` written once as Parquet (with `options`) below spark.checkpoint.dir and read back.

    Used where several steps read one costly result: a lost executor then
    re-reads files that all executors share instead of repeating the work.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose result is written: it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (id, text) of a frame: other columns, whatever their names, stay out."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold_of(column: str, folds: int):
    """crc32 of the id's decimal text, modulo `folds` (NULL ids: NULL)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def crc_fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and each text's start (n + 1 offsets).

    NULL counts as empty.  No copy is made of the texts themselves.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("" if not pa.types.is_binary(column.type) else b"", column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """(first, last) row ranges of at most `limit` bytes each (one row at least)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row, bytes, offsets) of a text column, slice by slice."""
    data, offs = text_bytes(column)
    for a, b in slices(offs, limit):
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
