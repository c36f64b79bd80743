"""JSON maps of any size and layout, read by many tasks.

An offer map may be one indented object of many gigabytes, one object on a
single line, or JSON Lines.  None of these is told apart here: a file is read in
byte ranges by Spark's text source with `}` as the separator, so that a piece is
what stands before a closing brace, mostly one entry.

A range cannot know whether it starts inside a string or how deep it is nested.
So every piece is turned into its effect (state and depth after it) for both
possible states before it, and a range into the effect of its pieces one after
the other.  A prefix scan over the ranges of a file, one small row each, then
gives the true state and depth at every range's start, and so at every piece.  A
piece that begins and ends an entry is one; the few others (a brace inside a
string, a nested value, an entry cut by the end of a range) are put together by
the place at which their entry starts.

Defined results: a line feed ends a string, which JSON allows nowhere else, and a
line that begins with `{` starts a new object, so a damaged line costs no other
line.  In an object whose own braces do not balance, entries after the damage may
be lost for the table.  Nothing is dropped: what is no entry is returned as
rejects, piece by piece where it never ends or is over `ENTRY_BYTES` long.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rank import sent_if_small
from ..session import shared_dir, ship_code

ENTRY_BYTES = 16 << 20  # no entry of an offer map is longer; what is goes to the rejects in pieces

# Place of a piece: time, path, size of its file and the range of the file it was read in.
_SOURCE = {"mtime": "_metadata.file_modification_time", "file": "_metadata.file_path", "size": "_metadata.file_size",
           "start": "_metadata.file_block_start"}


def with_place(text: DataFrame) -> DataFrame:
    """Rows of a text source read with `}` as separator -> (value and its place)."""
    return text.select("value", *[F.col(c).alias(name) for name, c in _SOURCE.items()])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return with_place(spark.read.option("lineSep", "}").text(path))


# --- the effect of a piece ----------------------------------------------------------------

_STRING = '"[^"\n]*(?:"|\n|\\z)'
_REST_OF_STRING = '^[^"\n]*(?:"|\n|\\z)'


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _effects(raw: DataFrame) -> DataFrame:
    """Pieces with the state after them (`end0`, `end1`: 1 inside a string) and the change of depth
    (`d0`, `d1`) for either state before them."""
    # A line that begins with `{` starts anew: such a piece is several.
    lines = raw.withColumn("lines", F.split("value", "\n(?=\\{)"))
    rows = lines.select("mtime", "file", "size", "start", F.size("lines").alias("n"), F.posexplode("lines").alias("k", "value"))
    rows = rows.withColumn("closed", F.col("k") == F.col("n") - 1).withColumn("fresh", F.col("k") > 0)
    rows = rows.withColumn("bare", F.regexp_replace("value", "(?s)\\\\.", ".."))  # escaped quotes are no quotes
    last = F.substring_index("bare", "\n", -1)
    rows = rows.withColumn("quotes", _count(last, '"') % 2).withColumn("line", F.col("bare").contains("\n"))
    outside = {0: F.regexp_replace("bare", _STRING, ""),
               1: F.regexp_replace(F.regexp_replace("bare", _REST_OF_STRING, ""), _STRING, "")}
    rows = rows.withColumn("end0", F.col("quotes")).withColumn(
        "end1", F.when(F.col("line"), F.col("quotes")).otherwise(1 - F.col("quotes")))
    for s, text in outside.items():
        closes = F.when(F.col("closed") & (F.col(f"end{s}") == 0), 1).otherwise(0)
        rows = rows.withColumn(f"d{s}", _count(text, "{[") - _count(text, "]") - closes)
    return rows.select("mtime", "file", "size", "start", "value", "closed", "fresh", "end0", "end1", "d0", "d1",
                       (F.octet_length("value") + 1).alias("bytes"))


_PIECES = ("mtime timestamp, file string, size long, start long, seq long, value string, closed boolean, bytes int, fixed boolean, "
           "s0 int, x0 int, s1 int, x1 int, t0 int, y0 int, t1 int, y1 int")


def _follow(batches):
    """Pieces in order -> each with its number in its range, and for either state at the range's start the state and
    depth before it (s, x) and after it (t, y).  `fixed`: the depth is known, else it counts from the range's start."""
    at, seq, fixed = None, 0, False
    for batch in batches:
        col = {name: batch.column(name) for name in batch.schema.names}
        rows = zip(*(col[c].to_pylist() for c in ("file", "start", "fresh", "end0", "end1", "d0", "d1")))
        out = []
        for file, start, fresh, end0, end1, d0, d1 in rows:
            if (file, start) != at:
                at, seq, fixed = (file, start), 0, False
                s, x, t, y = 0, 0, 1, 0
            if fresh:
                s, x, t, y, fixed = 0, 0, 0, 0, True
            s2, x2 = (end1, x + d1) if s else (end0, x + d0)
            t2, y2 = (end1, y + d1) if t else (end0, y + d0)
            out.append((seq, fixed, s, x, t, y, s2, x2, t2, y2))
            s, x, t, y, seq = s2, x2, t2, y2, seq + 1
        if out:
            seqs, fixeds, *states = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [col["mtime"], col["file"], col["size"], col["start"], pa.array(seqs, pa.int64()), col["value"], col["closed"],
                 col["bytes"], pa.array(fixeds, pa.bool_()), *[pa.array(v, pa.int32()) for v in states]],
                names=["mtime", "file", "size", "start", "seq", "value", "closed", "bytes", "fixed",
                       "s0", "x0", "s1", "x1", "t0", "y0", "t1", "y1"])


# --- prefix scan over the ranges of a file ------------------------------------------------

_STARTS = "at_file string, at_start long, state int, depth int, open long"


def _scan(batches):
    """Ranges sorted by file and start -> the state and depth each starts with; `open`: the file's last piece, if no brace follows it."""
    held, out = None, []

    def done(file_bytes):
        file, start, s, depth, size, seq = held
        out.append((file, start, s, depth, seq if file_bytes > size else None))

    for batch in batches:
        for r in batch.to_pylist():
            if held is not None and held[0] != r["file"]:
                done(total)
                held = None
            if held is None:
                s, depth, total = 0, 0, 0
            else:
                out.append((*held[:4], None))
            held = (r["file"], r["start"], s, depth, r["size"], r["seq"])
            end = r["y1"] if s else r["y0"]
            s, depth, total = (r["t1"] if s else r["t0"]), (end if r["fixed"] else depth + end), total + r["bytes"]
    if held is not None:
        done(total)
    names = [c.split()[0] for c in _STARTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names=names)


def _range_starts(pieces: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("fixed", "t0", "y0", "t1", "y1", "seq"), "seq")
    ranges = (pieces.groupBy("file", "start").agg(last.alias("last"), F.sum("bytes").alias("bytes"), F.first("size").alias("size"))
              .select("file", "start", "last.*", "bytes", "size"))
    return ranges.repartition("file").sortWithinPartitions("file", "start").mapInArrow(_scan, _STARTS)


# --- entries ------------------------------------------------------------------------------

@dataclass(frozen=True)
class SplitMap:
    """Entries (seq, body: a JSON map) and rejects (raw) of a set of files; `seq` orders entries by file time, path and place."""

    entries: DataFrame
    rejects: DataFrame


def _glued(loose: DataFrame) -> DataFrame:
    """Pieces that are no entry of their own -> entries, by the place their entry starts at, and pieces of none."""
    inside = Window.partitionBy("file", "start").orderBy("seq")
    numbered = loose.withColumn("nth", F.sum(F.col("starts").cast("int")).over(inside))
    # Pieces before a range's first start belong to the last entry that started before the range.
    ranges = numbered.groupBy("file", "start").agg(F.max("nth").alias("last"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("last") > 0, F.struct("start", "last")), ignorenulls=True).over(before)
    ranges = ranges.select(F.col("file").alias("of"), F.col("start").alias("of_start"), owner.alias("owner"))
    own = numbered.join(ranges, (F.col("file") == F.col("of")) & (F.col("start") == F.col("of_start")))
    key = F.when(F.col("nth") > 0, F.struct(F.col("start"), F.col("nth").alias("last"))).otherwise(F.col("owner"))
    own = own.withColumn("entry", key).drop("of", "of_start", "owner", "nth")
    sizes = own.groupBy(F.col("file").alias("of"), F.col("entry").alias("whole")).agg(
        F.max("ends").alias("ended"), F.sum("bytes").alias("long"))
    own = own.join(sizes, (F.col("file") == F.col("of")) & F.col("entry").eqNullSafe(F.col("whole"))).drop("of", "whole")
    entire = F.col("ended") & (F.col("long") <= ENTRY_BYTES) & F.col("entry").isNotNull()
    part = F.struct("start", "seq", "value", "depth", "after", "ends", "mtime")
    whole = (own.where(entire).groupBy("file", "entry").agg(F.array_sort(F.collect_list(part)).alias("p"))
             .select("file", F.col("p")[0]["mtime"].alias("mtime"), F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"),
                     F.array_join(F.transform("p", lambda r: r["value"]), "}").alias("value"),
                     F.col("p")[0]["depth"].alias("depth"), F.element_at("p", -1)["after"].alias("after"), F.lit(True).alias("ends"),
                     F.lit(True).alias("closed")))
    pieces = own.where(~entire).select("file", "mtime", "start", "seq", "value", "depth", "after", F.lit(False).alias("ends"), "closed")
    return whole.unionByName(pieces)


def split_map(raw: DataFrame, work: str | None = None) -> SplitMap:
    """Entries and rejects of the files behind `raw` (see `with_place`).

    The pieces are written once, to `work` or a new folder of the shared checkpoint folder; all steps read that."""
    spark = raw.sparkSession
    ship_code(spark)
    work = work or shared_dir(spark, "map-pieces")
    _effects(raw).mapInArrow(_follow, _PIECES).write.mode("overwrite").parquet(work)
    pieces = spark.read.schema(_PIECES).parquet(work)
    starts = sent_if_small(_range_starts(pieces), "map-ranges")
    rows = pieces.join(starts, (F.col("file") == F.col("at_file")) & (F.col("start") == F.col("at_start")))
    pick = lambda name: F.when(F.col("state") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    base = F.when(F.col("fixed"), 0).otherwise(F.col("depth"))
    rows = rows.select("file", "mtime", "start", "seq", "value", "bytes", (F.col("closed") & ~F.col("seq").eqNullSafe(F.col("open"))).alias("closed"),
                       pick("s").alias("before"), (base + pick("x")).alias("depth"), pick("t").alias("then"), (base + pick("y")).alias("after"))
    rows = (rows.withColumn("starts", (F.col("before") == 0) & (F.col("depth") <= 1))
            .withColumn("ends", F.col("closed") & (F.col("then") == 0) & (F.col("after") <= 1)))
    rows = rows.where(F.col("closed") | ~F.col("starts") | (F.trim(F.translate("value", "\n\r\t,", "    ")) != ""))
    names = ["file", "mtime", "start", "seq", "value", "depth", "after", "ends", "closed"]
    single = F.col("starts") & F.col("ends")
    every = rows.where(single).select(*names).unionByName(_glued(rows.where(~single)))
    # The text without what separates it from the entry before; at depth 0 an object opens first.
    body = F.regexp_replace("value", "^[\\s,]+", "")
    body = F.when(F.col("depth") <= 0, F.regexp_replace(body, "^\\{\\s*", "")).otherwise(body)
    # The brace behind the text closes the entry's value, or (at depth 0 after it) the object.
    every = every.withColumn("body", F.concat(body, F.when(F.col("ends") & (F.col("after") == 1), F.lit("}")).otherwise(F.lit(""))))
    raw_text = F.regexp_replace(F.concat("value", F.when(F.col("closed"), F.lit("}")).otherwise(F.lit(""))), "^[\\s,]+|\\s+$", "")
    every = every.where(~F.col("ends") | (F.trim("body") != "")).select(
        F.struct("mtime", "file", "start", "seq").alias("seq"), "ends", F.concat(F.lit("{"), F.col("body"), F.lit("}")).alias("body"),
        raw_text.alias("raw"))
    return SplitMap(every.where("ends").select("seq", "body"), every.where(~F.col("ends")).where("raw <> ''").select("raw"))
