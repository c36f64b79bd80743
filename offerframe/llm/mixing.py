"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source).  A token budget flows down the tree:
among siblings it is shared by weight, but no node gets more than its leaves
can give (their tokens times `max_epochs`).  What a node cannot take goes to
its siblings by their weights; only when all of them are full does their
parent's own limit bind, and the rest moves to the parent's siblings.

With siblings ordered by capacity / weight, the common level at which the
budget is used up is the largest of (budget - capacities before) / (weights
from here on); every node gets min(capacity, weight * level).  So one window
over the tree's few nodes solves a tree level.

A leaf takes its budget from seeded epochs: all its documents for every full
epoch, and of the next one the prefix, in the order of a seeded hash, whose
tokens fit.  The prefix needs no sort of a leaf: hash ranges (buckets) are
summed first, all but the range at the edge are decided as a whole, and only
that range's rows are ordered.  A source with a third of all rows is spread
over all its buckets.

DataFrame functions only.  Tokens are words [^\\x20\\x09-\\x0D]+.

Defined results: documents without tokens (empty or NULL text) are never
selected; NULL language or source count as ''; a node without a weight has
weight 1, a weight of 0 excludes its leaves; copies of one doc_id share their
place in the order and are taken or left together (copies in another leaf are
chosen there on their own).  Other columns are not read.

A leaf's prefix ends at the first document that does not fit, so a leaf stays below
its quota by less than that one document; this rest is not passed on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import bloom
from .common import release_shuffles, written

LEVELS = ("domain", "lang", "source")
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Params:
    weights: dict = field(default_factory=lambda: {
        "domain": {"web": 30, "books": 40, "code": 20, "forum": 10},
        "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
        "source": {}})
    budget: float = 0.9       # tokens to select, as a share of the corpus' tokens
    max_epochs: int = 2       # times a document may be selected
    seed: int = 17
    bucket_digits: int = 4    # hex digits of the hash that name a bucket: 16**digits buckets per leaf


def domain_of(source: Column) -> Column:
    """Default domain of a source: by the number its name ends with."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    kind = F.when(number == "", 0).otherwise(number.cast("long") % 4)
    return F.element_at(F.array(*[F.lit(d) for d in ("web", "books", "code", "forum")]), (kind + 1).cast("int"))


def _weight(level: str, p: Params) -> Column:
    out = F.lit(1.0)
    for name, w in p.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str], budget: str, level: str, p: Params) -> DataFrame:
    """Split each parent's `budget` among its children (`level`, `capacity`) into `share`."""
    w = F.when(F.col("capacity") > 0, _weight(level, p)).otherwise(1.0)
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("w"), level)
    nodes = (nodes.withColumn("w", w)
             .withColumn("before", F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             .withColumn("rest", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("at", (F.col(budget) - F.col("before")) / F.col("rest"))
             .withColumn("full_at", F.max("at").over(Window.partitionBy(*parent))))
    return nodes.withColumn("share", F.least("capacity", F.col("w") * F.col("full_at")))


def budgets(leaves: DataFrame, p: Params) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with `quota`, the tokens to take from each leaf."""
    usable = (_weight("domain", p) > 0) & (_weight("lang", p) > 0) & (_weight("source", p) > 0)
    leaves = leaves.withColumn("capacity", F.when(usable, F.col("tokens") * F.lit(float(p.max_epochs))).otherwise(0.0))
    domains = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    domains = domains.withColumn("root", F.lit(0))
    root = Window.partitionBy("root")  # one row per domain
    domains = domains.withColumn("total", F.least(
        F.floor(F.sum("tokens").over(root) * F.lit(p.budget)).cast("double"), F.sum("capacity").over(root)))
    domains = _share(domains, ["root"], "total", "domain", p)
    domains = domains.select("domain", F.col("share").alias("d_share"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).join(domains, "domain")
    langs = _share(langs, ["domain"], "d_share", "lang", p).select("domain", "lang", F.col("share").alias("l_share"))
    out = _share(leaves.join(langs, ["domain", "lang"]), ["domain", "lang"], "l_share", "source", p)
    return out.select(*LEVELS, "tokens", F.floor(F.col("share") + F.lit(1e-6)).cast("long").alias("quota"))


def worded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", domain: Column | None = None) -> DataFrame:
    """The documents with tokens: doc_id, lang, source, domain, n_tokens."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        (domain if domain is not None else domain_of(F.coalesce(F.col(source_col).cast("string"), F.lit("")))).alias("domain"),
        F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(_WORD)).cast("long").alias("n_tokens"))
    # Narrow rows; written once, because counts, buckets and the selection read them.
    return written(rows.where("n_tokens > 0"), "tokens")


def mix(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", **columns) -> DataFrame:
    """The selected copies: doc_id, domain, lang, source, n_tokens, epoch (from 0)."""
    return selected(worded(docs, id_col, **columns), p)


def selected(rows: DataFrame, p: Params) -> DataFrame:
    """The selected copies of `worded` rows: their columns and epoch."""
    quotas = written(budgets(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), p), "quotas")
    plan = quotas.where("quota > 0").select(
        *LEVELS, F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("whole"),
        (F.col("quota") % F.col("tokens")).alias("rest"))
    planned = rows.join(plan, list(LEVELS))
    whole = planned.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))

    # The epoch begun but not finished: a prefix in the order of a seeded hash.
    place = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.col("whole").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    part = (planned.where("rest > 0").withColumn("place", place)
            .withColumn("bucket", F.substring("place", 1, p.bucket_digits)))
    key = [*LEVELS, "bucket"]
    sums = part.groupBy(*key).agg(F.sum("n_tokens").alias("held"), F.max("rest").alias("room"))
    before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
            .where("before < room").select(*key, "before", (F.col("before") + F.col("held") > F.col("room")).alias("edge")))
    part = part.join(sums, key)
    inside = part.where("NOT edge")
    running = Window.partitionBy(*key).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    edge = (part.where("edge").withColumn("until", F.col("before") + F.sum("n_tokens").over(running))
            .where("until <= rest"))
    columns = ["doc_id", *("domain", "lang", "source"), "n_tokens"]
    return (whole.select(*columns, "epoch")
            .unionByName(inside.select(*columns, F.col("whole").alias("epoch")))
            .unionByName(edge.select(*columns, F.col("whole").alias("epoch"))))


def mixed(docs: DataFrame, p: Params = Params(max_epochs=1), id_col: str = "doc_id", **columns) -> DataFrame:
    """The rows of `docs`, all columns, that a mixture without repeats selects.

    Texts stay where they lie: a Bloom filter over the leaves and ids that are not selected is sent to the scan, and
    only rows that it lets pass are shuffled for the exact join."""
    if p.max_epochs != 1:
        raise ValueError("a filter cannot repeat documents: use mix()")
    # Rows of one leaf with one id are taken or left together, so leaf and id name what is chosen; rows without
    # tokens are in no leaf.
    names = {"text_col": "text", "lang_col": "lang", "source_col": "source", "domain": None, **columns}
    source = F.coalesce(F.col(names["source_col"]).cast("string"), F.lit(""))
    own = {"doc_id": F.col(id_col).cast("long"), "lang": F.coalesce(F.col(names["lang_col"]).cast("string"), F.lit("")),
           "source": source, "domain": names["domain"] if names["domain"] is not None else domain_of(source)}
    free = "_"
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    keys = [free + c for c in own]
    rows = worded(docs, id_col, **columns)
    chosen = selected(rows, p).select(*own).toDF(*[f"c_{c}" for c in own])
    same = F.lit(True)
    for c in own:
        same = same & rows[c].eqNullSafe(chosen[f"c_{c}"])
    gone = written(rows.join(chosen, same, "left_anti").select(*own).distinct().toDF(*keys), "gone")
    release_shuffles(docs.sparkSession)
    keyed = docs.where(F.col(names["text_col"]).cast("string").rlike(_WORD)).withColumns({free + c: v for c, v in own.items()})
    return bloom.without(keyed, gone, keys).select(*docs.columns)


def oracle_sql(p: Params) -> str:
    """The same in DuckDB SQL over `documents` (default domains)."""
    def weight(level: str) -> str:
        arms = " ".join(f"WHEN {level} = '{k}' THEN {float(v)}" for k, v in p.weights.get(level, {}).items())
        return f"CASE {arms} ELSE 1.0 END" if arms else "1.0"

    def share(source: str, parent: str, budget: str, level: str) -> str:
        return f"""(SELECT *, least(capacity, w * max(fill) OVER (PARTITION BY {parent})) AS share FROM (
            SELECT *, ({budget} - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY capacity / w, {level}
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (PARTITION BY {parent} ORDER BY capacity / w, {level}
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill
            FROM (SELECT *, CASE WHEN capacity > 0 THEN {weight(level)} ELSE 1.0 END::DOUBLE AS w FROM {source})))"""

    usable = " AND ".join(f"{weight(level)} > 0" for level in LEVELS)
    return f"""
        WITH named AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n_tokens,
                   regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS number FROM documents),
        worded AS (
            SELECT doc_id, lang, source, n_tokens, CASE WHEN number = '' THEN 'web' ELSE
                   ['web', 'books', 'code', 'forum'][number::BIGINT % 4 + 1] END AS domain
            FROM named WHERE n_tokens > 0),
        leaves AS (
            SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens,
                   CASE WHEN {usable} THEN sum(n_tokens)::DOUBLE * {p.max_epochs} ELSE 0 END AS capacity
            FROM worded GROUP BY domain, lang, source),
        total AS (SELECT least(floor(sum(tokens)::DOUBLE * {p.budget}::DOUBLE), sum(capacity)) AS total FROM leaves),
        d AS (SELECT domain, share AS d_share FROM {share(
            "(SELECT domain, sum(capacity) AS capacity, any_value(total.total) AS total, 0 AS root FROM leaves, total GROUP BY domain)",
            "root", "total", "domain")}),
        l AS (SELECT domain, lang, share AS l_share FROM {share(
            "(SELECT domain, lang, sum(capacity) AS capacity, any_value(d_share) AS d_share FROM leaves JOIN d USING (domain) "
            "GROUP BY domain, lang)", "domain", "d_share", "lang")}),
        q AS (SELECT domain, lang, source, tokens, floor(share + 1e-6)::BIGINT AS quota FROM {share(
            "(SELECT * FROM leaves JOIN l USING (domain, lang))", "domain, lang", "l_share", "source")}),
        planned AS (
            SELECT r.*, (quota // tokens)::INTEGER AS whole, quota % tokens AS rest
            FROM worded r JOIN q USING (domain, lang, source) WHERE quota > 0),
        part AS (
            SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY
                   md5('{p.seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))) AS until FROM planned WHERE rest > 0)
        SELECT doc_id, domain, lang, source, n_tokens, e::INTEGER AS epoch
        FROM (SELECT *, unnest(range(whole)) AS e FROM planned WHERE whole > 0)
        UNION ALL SELECT doc_id, domain, lang, source, n_tokens, whole FROM part WHERE until <= rest"""
