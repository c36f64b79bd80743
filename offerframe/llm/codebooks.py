"""Vector code compression: product codebooks by Lloyd rounds with resident members.

A vector's components become integers floor(scale * x) and are cut into
`parts` equal consecutive parts.  Every part position has a codebook of
`entries` entries.  A part belongs to the entry nearest to it; its owner is
the group (position, entry, salt), and salts keep an owner small however many
parts one entry attracts.

Members stay where their owner wrote them.  Generation 0 holds every part,
shuffled to the owner of its first entry.  In a round every member compares
itself, in place, with the new entries.  Members whose entry stays are not
written, read into a shuffle or moved; the owner sums them up where they lie.
Only members that change entry are shuffled, to their new owner, and written
there as the next generation.  The files of a generation are never changed: a
row that has left its owner is known by the codebooks since its generation,
which the tasks hold, because the arithmetic is exact and so repeatable.  Lost
executors read the files again.

The codebooks are parts x entries x width integers, whatever the table; they
are all that the driver sees.

Defined results: rows whose vector is NULL or holds NULL or non-finite
components are left out, and so are rows whose vector has another length than
that of the smallest kept vec_id.  A length that `parts` does not divide is
filled up with zeros.  Integers beyond +-2**26 are set to that bound.  Fewer
than `entries` rows make as many entries.  Repeated vec_ids are rows of their
own (first entries then ordered by vector too); a NULL vec_id comes last.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import sent_if_small
from .common import lean, ship, written

_LIMIT = 1 << 26  # squares of differences then fit 64 bits in any sum over a part


@dataclass(frozen=True)
class Params:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    owner_rows: int = 4096  # an owner holds about this many parts even if all belong to one entry


def to_integers(vectors: np.ndarray, p: Params) -> np.ndarray:
    """(rows, dim) doubles -> (rows, parts, width) integers."""
    whole = np.clip(np.floor(p.scale * vectors), -_LIMIT, _LIMIT).astype(np.int64)
    short = -whole.shape[1] % p.parts
    whole = np.pad(whole, ((0, 0), (0, short)))
    return whole.reshape(len(whole), p.parts, whole.shape[1] // p.parts)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every row of x (ties: the lower one) and its squared distance."""
    best, least = np.zeros(len(x), np.int64), None
    for k, entry in enumerate(book):
        far = ((x - entry) ** 2).sum(1)
        if least is None:
            least = far
            continue
        nearer = far < least
        best[nearer] = k
        least = np.where(nearer, far, least)
    return best, least


def _vectors(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _ints(column) -> np.ndarray:
    """Binary column of equally long 32-bit integer rows -> matrix."""
    raw = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    return raw.reshape(len(column), -1).astype(np.int64)


_MEMBER = "gen int, position int, entry int, salt int, part binary"
_MEMBER_TYPES = pa.schema([("gen", pa.int32()), ("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()),
                           ("part", pa.binary())])
_SUMS = ", n long, sums binary"
_ROUND_TYPES = pa.schema([*_MEMBER_TYPES, ("n", pa.int64()), ("sums", pa.binary())])


def _members(gen: int, position, entry, salt, x: np.ndarray) -> list:
    raw = np.ascontiguousarray(x, "<i4").tobytes()
    width = 4 * x.shape[1]
    parts = [raw[at:at + width] for at in range(0, len(raw), width)] if width else [b""] * len(x)
    return [pa.array(np.full(len(x), gen, np.int32)), pa.array(position, pa.int32()), pa.array(entry, pa.int32()),
            pa.array(salt, pa.int32()), pa.array(parts, pa.binary())]


class Sums:
    """Count and componentwise sum of the members of every (position, entry) a task sees."""

    def __init__(self):
        self.held: dict[tuple[int, int], list] = {}

    def add(self, position: int, entry: np.ndarray, x: np.ndarray) -> None:
        for k in np.unique(entry).tolist():
            own = x[entry == k]
            self.add_one(position, k, len(own), own.sum(0))

    def add_one(self, position: int, entry: int, n: int, total: np.ndarray) -> None:
        old = self.held.get((position, entry))
        self.held[position, entry] = [n, total] if old is None else [old[0] + n, old[1] + total]

    def batch(self, schema) -> pa.RecordBatch:
        keys = list(self.held)
        known = {"position": pa.array([k[0] for k in keys], pa.int32()), "entry": pa.array([k[1] for k in keys], pa.int32()),
                 "n": pa.array([self.held[k][0] for k in keys], pa.int64()),
                 "sums": pa.array([self.held[k][1].astype("<i8").tobytes() for k in keys], pa.binary())}
        return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(len(keys), f.type)) for f in schema], schema=schema)


def _settle(books: list[np.ndarray], p: Params, salts: int):
    """Base rows -> their parts as members of generation 0."""
    def run(batches):
        for batch in batches:
            x = to_integers(_vectors(batch.column("vector")), p)
            salt = (batch.column("row").to_numpy() * 0x9E3779B1 >> 7) % salts
            for position in range(p.parts):
                own = x[:, position]
                entry, _ = nearest(own, books[0][position])
                yield pa.RecordBatch.from_arrays(
                    _members(0, np.full(len(own), position), entry, salt, own), schema=_MEMBER_TYPES)

    return run


def _move(books: list[np.ndarray], p: Params):
    """Members of all generations -> those that change entry under the last codebook, and sums of those that stay.

    A row of generation g is a member of its owner only if it has stayed with
    it under every codebook from g + 1 on; else a later generation holds it."""
    last = len(books) - 1

    def run(batches):
        stay = Sums()
        for batch in batches:
            gen, position, entry, salt = (batch.column(c).to_numpy() for c in ("gen", "position", "entry", "salt"))
            x = _ints(batch.column("part"))
            live, new = np.ones(len(x), bool), entry.astype(np.int64)
            for j in range(1, last + 1):
                for q in np.unique(position).tolist():
                    at = np.flatnonzero(live & (position == q) & (gen < j))
                    if len(at):
                        new[at] = nearest(x[at], books[j][q])[0]
                if j < last:
                    live &= new == entry
            for q in np.unique(position).tolist():
                at = np.flatnonzero(live & (position == q) & (new == entry))
                stay.add(q, new[at], x[at])
            gone = np.flatnonzero(live & (new != entry))
            if len(gone):
                none = [pa.nulls(len(gone), pa.int64()), pa.nulls(len(gone), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    _members(last, position[gone], new[gone], salt[gone], x[gone]) + none, schema=_ROUND_TYPES)
        if stay.held:
            yield stay.batch(_ROUND_TYPES)

    return run


_SUM_TYPES = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])
_SUM = "position int, entry int, n long, sums binary"


def _arrived(batches):
    """Members of one generation -> their sums."""
    total = Sums()
    for batch in batches:
        position, entry, x = batch.column("position").to_numpy(), batch.column("entry").to_numpy(), _ints(batch.column("part"))
        for q in np.unique(position).tolist():
            total.add(q, entry[position == q], x[position == q])
    if total.held:
        yield total.batch(_SUM_TYPES)


def _added(batches):
    """Sums of all tasks -> one row per (position, entry)."""
    total = Sums()
    for batch in batches:
        for q, k, n, s in zip(*(batch.column(c).to_pylist() for c in ("position", "entry", "n", "sums"))):
            total.add_one(q, k, n, np.frombuffer(s, "<i8"))
    if total.held:
        yield total.batch(_SUM_TYPES)


def _updated(book: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The codebooks with every used entry replaced by the floored mean of its members."""
    new = book.copy()
    # One row per (position, entry): as many as the codebooks have entries.
    for r in sums.repartition("position", "entry").mapInArrow(lean(_added), _SUM).collect():
        new[r["position"], r["entry"]] = np.frombuffer(r["sums"], "<i8") // r["n"]
    return new


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    return (df.where(F.col(vector_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
                    F.col(vector_col).cast("array<double>").alias("vector")))


def train(base: DataFrame, p: Params) -> np.ndarray | None:
    """Codebooks (parts, entries, width) after all rounds; None for an empty table.

    `base` holds (row, vec_id, vector), all vectors of one length."""
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(p.entries).select("vector").collect()
    if not first:
        return None
    start = to_integers(np.array([r["vector"] for r in first], np.float64).reshape(len(first), -1), p)
    books = [np.ascontiguousarray(start.transpose(1, 0, 2))]
    salts = 1 + base.count() // p.owner_rows
    owner = ["position", "entry", "salt"]
    gens = [written(base.select("row", "vector").mapInArrow(lean(_settle(books, p, salts)), _MEMBER).repartition(*owner), "gen-0")]
    books.append(_updated(books[0], gens[0].mapInArrow(lean(_arrived), _SUM)))
    for r in range(1, p.rounds):
        members = gens[0]
        for gen in gens[1:]:
            members = members.unionAll(gen)
        turn = written(members.mapInArrow(lean(_move(books, p)), _MEMBER + _SUMS), f"round-{r}")
        movers = turn.where("n IS NULL").select("gen", *owner, "part")
        gens.append(written(movers.repartition(*owner), f"gen-{r}"))
        stayed = turn.where("n IS NOT NULL").select("position", "entry", "n", "sums")
        books.append(_updated(books[-1], stayed.unionAll(gens[-1].mapInArrow(lean(_arrived), _SUM))))
    return books[-1]


def encode(base: DataFrame, books: np.ndarray, p: Params) -> DataFrame:
    """(row, code, error): code as hexadecimal entry numbers, error as the summed squared distance."""
    def run(batches):
        for batch in batches:
            x = to_integers(_vectors(batch.column("vector")), p)
            codes, error = np.zeros((len(x), p.parts), np.uint8), np.zeros(len(x), np.int64)
            for q in range(p.parts):
                codes[:, q], far = nearest(x[:, q], books[q])
                error += far
            raw = codes.tobytes().hex()
            step = 2 * p.parts
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([raw[a:a + step] for a in range(0, len(raw), step)], pa.string()),
                 pa.array(error)], names=["vec_id", "label", "code", "error"])

    kind = base.schema["label"].dataType.simpleString()
    return base.select("vec_id", "label", "vector").mapInArrow(lean(run), f"vec_id long, label {kind}, code string, error long")


def compress(df: DataFrame, params: Params = Params(), id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str | None = "label") -> tuple[DataFrame, np.ndarray | None]:
    """((vec_id, label, code, error) per kept row, codebooks)."""
    p = params
    if not 1 <= p.entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    ship(df.sparkSession)
    kept = kept_vectors(df, id_col, vector_col, label_col)
    lead = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).first()
    kept = kept.where(F.size("vector") == (lead["n"] if lead else 0))
    base = written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    books = train(base, p)
    if books is None:
        return base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    return encode(base, books, p), books


def codebooks_digest(books: np.ndarray | None) -> str:
    flat = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` with label_error: the error summed over the rows of equal label."""
    coded = written(coded, "codes")
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    total = sent_if_small(total, "label-error")
    return coded.join(total, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def oracle_sql(p: Params) -> str:
    """DuckDB SQL of the registered query: every round as three common table expressions."""
    near = """
        d{i} AS MATERIALIZED (
            SELECT p.r, p.q, b.k, CAST(coalesce(list_sum(list_transform(range(1, len(p.x) + 1),
                       lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))), 0) AS BIGINT) AS far
            FROM p JOIN b{i} b USING (q)),
        a{i} AS MATERIALIZED (
            SELECT r, q, min(far) AS far, min(k) FILTER (WHERE far = least) AS k
            FROM (SELECT *, min(far) OVER (PARTITION BY r, q) AS least FROM d{i}) GROUP BY r, q)"""
    mean = """,
        s{i} AS MATERIALIZED (
            SELECT q, k, list(m ORDER BY pos) AS x FROM (
                SELECT q, k, pos, CAST(floor(CAST(sum(x[pos]) AS DOUBLE) / count(*)) AS BIGINT) AS m
                FROM (SELECT q, k, x, unnest(range(1, len(x) + 1)) AS pos FROM a{i} JOIN p USING (r, q)) GROUP BY q, k, pos)
            GROUP BY q, k),
        b{j} AS MATERIALIZED (SELECT b.q, b.k, coalesce(s.x, b.x) AS x FROM b{i} b LEFT JOIN s{i} s USING (q, k)),"""
    rounds = "".join(near.format(i=i) + mean.format(i=i, j=i + 1) for i in range(p.rounds)) + near.format(i=p.rounds)
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding
            FROM embeddings WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT r, q, list_transform(embedding[q * (len(embedding) // {p.parts}) + 1:(q + 1) * (len(embedding) // {p.parts})],
                                        lambda x: CAST(floor({p.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM v, range({p.parts}) t(q)),
        b0 AS MATERIALIZED (SELECT q, r - 1 AS k, x FROM p WHERE r <= {p.entries}),{rounds},
        books AS (SELECT sha256(string_agg(CAST(x[pos] AS VARCHAR), ',' ORDER BY q, k, pos)) AS codebooks_sha256
                  FROM (SELECT q, k, x, unnest(range(1, len(x) + 1)) AS pos FROM b{p.rounds})),
        c AS (SELECT r, string_agg(printf('%02x', k), '' ORDER BY q) AS code, CAST(sum(far) AS BIGINT) AS error
              FROM a{p.rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM v JOIN c USING (r), books"""
