"""File-system metadata through Hadoop's FileSystem API (driver side).

Only names, sizes and times are read here -- listing a folder, finding the
newest entry -- so any Hadoop file system (HDFS, object stores, local)
works and no data passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    mtime: int
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def list_entries(spark: SparkSession, folder: str) -> list[Entry]:
    fs, hpath = _fs(spark, folder)
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        p = st.getPath()
        out.append(Entry(p.toString(), p.getName(), int(st.getModificationTime()), bool(st.isDirectory())))
    return out


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def create_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a tiny file.  Fails if it exists: of two writers one wins."""
    fs, hpath = _fs(spark, path)
    stream = fs.create(hpath, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def read_small_text(spark: SparkSession, path: str) -> str | None:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return None if line is None else str(line)
    finally:
        stream.close()


def newest(entries: list[Entry]) -> Entry:
    """Newest by modification time; equal times -> the greatest path."""
    if not entries:
        raise FileNotFoundError("no matching files in the folder")
    return max(entries, key=lambda e: (e.mtime, e.path))
