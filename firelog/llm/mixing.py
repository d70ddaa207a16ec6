"""Mixing sources to target weights by a splitting tree of block quotas (operator 5).

Every source's documents are dealt by hash into ``BLOCKS`` blocks, and the
blocks stand in a hashed (permuted) order. A source's target fixes how often
all of its blocks are drawn and how many words of one more pass are taken: the
blocks of that pass up to a cut, and inside the cut block the documents up to
a cut. Both cuts are hash values, so a document's number of copies follows
from its own hashes and one small row per source: no document is looked up in
a table, and a hot source is spread over its blocks.

The number of block draws of each source is then split among the output
shards: a binary tree over the shards, each node dividing its vector of
quotas between its halves by a multivariate hypergeometric draw. A leaf holds
the exact number of blocks that its shard takes from each source, as a run of
the permuted order, so the shards' draws are disjoint and cover all.

The driver holds one row per source (and per source and shard), never
documents or blocks.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firelog.llm.common import stored

BLOCKS = 4096
SHARDS = 16
WEIGHTS = (3, 1, 2)
TOTAL = Fraction(3, 2)
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, total: Fraction = TOTAL,
            most: int = MOST) -> dict[str | None, Fraction]:
    """Target words of each source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``total`` of all words; a share above ``most`` times the source stops
    there and the excess is shared again by weight.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weigh = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, open_, out = total * sum(size.values()), set(size), {}
    while open_:
        unit = left / sum(weigh[s] for s in open_)
        above = {s for s in open_ if unit * weigh[s] > most * size[s]}
        if not above:
            out |= {s: unit * weigh[s] for s in open_}
            break
        for s in above:
            out[s] = Fraction(most * size[s])
            left -= out[s]
        open_ -= above
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Draws of each shard from each source (shards x sources).

    A node's draws are divided among its two halves in proportion to their
    shards; which sources they come from is a multivariate hypergeometric draw.
    """
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    n = int(quotas.sum()) * left // shards
    part = rng.multivariate_hypergeometric(quotas, n, method="marginals") if len(quotas) else quotas
    return np.concatenate([split_tree(part, left, rng), split_tree(quotas - part, shards - left, rng)])


def _hash(seed: int, *cols) -> Column:
    return F.xxhash64(*cols, F.lit(seed))


def _with_keys(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with its words, block key (place of its block in the permuted order) and own order in a struct ``__mix``."""
    text, source = docs[text_col], docs[source_col].cast("string")
    block = F.pmod(_hash(seed, docs[id_col]), F.lit(BLOCKS))
    return docs.withColumn("__mix", F.struct(
        source.alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _hash(seed + 1, source, block).alias("key"),
        _hash(seed + 2, docs[id_col], text).alias("place")))


def plan(docs: DataFrame, seed: int = 11, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """One row per source: its size, target, full passes, cuts of the last pass and shard borders.

    ``borders`` holds, for each shard after the first, the (pass, key) at
    which its run of the permuted blocks begins.
    """
    spark = docs.sparkSession
    keyed = _with_keys(docs, seed, id_col, text_col, source_col)
    narrow = keyed.select("__mix.*")
    blocks = stored(narrow.groupBy("source", "key").agg(F.sum("size").alias("words")), "mix-blocks")
    sizes = [(r["source"], r["words"], r["n"]) for r in
             blocks.groupBy("source").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n")).collect()]
    goal = targets([(s, w) for s, w, _ in sizes])
    passes = {s: int(goal[s] // w) if w else 0 for s, w, _ in sizes}
    rest = {s: round(goal[s] - passes[s] * w) for s, w, _ in sizes}
    wanted = spark.createDataFrame([(s, rest[s]) for s, _, _ in sizes], "source_ string, rest long")
    by_key = Window.partitionBy("source").orderBy("key")
    ranked = (blocks.join(wanted, F.col("source").eqNullSafe(F.col("source_"))).select(
        "source", "key", "words", "rest", F.row_number().over(by_key).alias("rank"),
        F.sum("words").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("upto")))
    cuts = {r["source"]: r for r in ranked.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
            .select("source", "key", "rank", (F.col("rest") - F.col("upto") + F.col("words")).alias("need")).collect()}
    # inside the cut block: documents in hashed order up to the nearest to what is needed
    cut_rows = spark.createDataFrame([(s, c["key"], c["need"]) for s, c in cuts.items()],
                                     "source_ string, key_ long, need long")
    # equal rows share a place and go together, so that the cut is the same on every run
    in_cut = (narrow.join(cut_rows, F.col("source").eqNullSafe(F.col("source_")) & (F.col("key") == F.col("key_")))
              .groupBy("source", "place", "need").agg(F.sum("size").alias("size")))
    by_place = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    filled = in_cut.withColumn("upto", F.sum("size").over(by_place))
    before = F.col("upto") - F.col("size")
    taken = filled.where((F.col("upto") <= F.col("need")) | ((before < F.col("need")) & (F.col("upto") - F.col("need") < F.col("need") - before)))
    last = {r["source"]: r["place"] for r in taken.groupBy("source").agg(F.max("place").alias("place")).collect()}
    quotas = np.array([passes[s] * n + (cuts[s]["rank"] if s in cuts else 0) for s, _, n in sizes], np.int64)
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i][0] is None, sizes[i][0] or ""))
    share = split_tree(quotas[order], shards, np.random.default_rng(seed)) if sizes else np.zeros((shards, 0), np.int64)
    starts = np.cumsum(share, axis=0)[:-1]  # first draw of each later shard, from each source
    lookup = [(sizes[i][0], s, int(starts[s, j]) // sizes[i][2], int(starts[s, j]) % sizes[i][2] + 1)
              for j, i in enumerate(order) for s in range(shards - 1)]
    found = {}
    if lookup:
        at = spark.createDataFrame(lookup, "source_ string, shard int, pass int, rank_ int")
        found = {(r["source_"], r["shard"]): (r["pass"], r["key"]) for r in
                 at.join(ranked, F.col("source_").eqNullSafe(F.col("source")) & (F.col("rank_") == F.col("rank")))
                 .select("source_", "shard", "pass", "key").collect()}
    rows = [(s, w, float(goal[s]), passes[s], cuts[s]["key"] if s in cuts else None, last.get(s),
             [found[s, k] for k in range(shards - 1)]) for s, w, _ in sizes]
    return _small(spark, rows, "m_source string, source_size long, target double, passes int, cut_key long, cut_place long, "
                               "borders array<struct<draw_pass: int, key: long>>")


def _small(spark, rows: list, schema: str) -> DataFrame:
    """A table of one row per source whose size the planner knows (it may choose to broadcast it)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = spark.createDataFrame([], schema).schema
    names = kind.names
    records = [dict(zip(names, r, strict=True)) for r in rows]
    for r in records:
        r["borders"] = [dict(draw_pass=p, key=k) for p, k in r["borders"]]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(kind)), kind)


def _decided(docs: DataFrame, sources: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with ``__mix`` and the plan's columns, ``copies`` and ``shards`` in a struct ``__plan``."""
    keyed = _with_keys(docs, seed, id_col, text_col, source_col)
    s = sources.select(F.struct(*sources.columns).alias("__plan"))
    both = keyed.join(s, F.col("__mix.source").eqNullSafe(F.col("__plan.m_source")))
    key, cut = F.col("__mix.key"), F.col("__plan.cut_key")
    more = (cut.isNotNull() & ((key < cut) | ((key == cut) & (F.col("__mix.place") <= F.coalesce(F.col("__plan.cut_place"), F.lit(-2**63))))))
    copies = F.col("__plan.passes") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    shard_of = lambda p: F.size(F.filter(
        F.col("__plan.borders"), lambda b: (b["draw_pass"] < p) | ((b["draw_pass"] == p) & (b["key"] <= key))))
    both = both.withColumn("__copies", copies)
    numbers = F.when(F.col("__copies") > 0, F.sequence(F.lit(0), F.col("__copies") - 1)).otherwise(F.array().cast("array<int>"))
    return both.withColumn("__shards", F.transform(numbers, shard_of))


def mix(docs: DataFrame, seed: int = 11, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies, shards)`` of every row.

    ``taken`` is ``copies`` times the size; ``shards`` names the output shard
    of each copy. A null text has size 0; null sources are one source, the
    last; repeated rows share their fate; a source without words has target 0;
    an empty table gives an empty result. The same rows give the same mix.
    """
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[source_col].alias("source"))
    sources = plan(narrow, seed, shards)
    d = _decided(narrow, sources, seed, "doc_id", "text", "source")
    return d.select("doc_id", F.col("__mix.size").alias("size"), F.col("__plan.source_size").alias("source_size"),
                    F.col("__plan.target").alias("target"), (F.col("__mix.size") * F.col("__copies")).alias("taken"),
                    F.col("__copies").alias("copies"), F.col("__shards").alias("shards"))


def mixed_rows(docs: DataFrame, seed: int = 11, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, once per copy, gathered by shard and shuffled inside it."""
    # the row's own columns travel in a struct, so that no name of theirs meets one of the plan's
    keyed = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[source_col].alias("source"),
                        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    d = _decided(keyed, plan(keyed, seed, shards), seed, "doc_id", "text", "source")
    one = d.select("row", "__mix", F.posexplode("__shards").alias("__pass", "__shard"))
    # a shard's rows are spread over several tasks by their hash, so that none grows with the corpus
    spread = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = F.pmod(_hash(seed + 3, "__mix.place", "__pass"), F.lit(spread))
    return (one.repartition("__shard", parts)
            .sortWithinPartitions("__shard", _hash(seed + 4, "__mix.place", "__pass"), "__mix.place")
            .select("row.*"))
