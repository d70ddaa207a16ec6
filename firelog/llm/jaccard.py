"""N-gram Jaccard join (operator 9): size-aware heavy-light join and its connected components.

A text's set holds 64-bit hashes of its five-word shingles; texts with equal
sets form one class, and the join runs on classes. Two sets of sizes n <= m
link only if they share ``need(n, m)`` shingles.

* Light sets (sizes up to a boundary): every subset of that fixed size is
  enumerated, for each partner size that is possible; linked sets meet in a
  subset key.
* Heavy sets: inverted lists over the shingles of a prefix. All sets are
  sorted by one order, shingles seen often in a task last, and linked sets
  share a shingle among their first ``n - ceil(0.8 n) + 1``. Frequent
  shingles (lines and passages of many texts) so stay out of the lists of
  texts that have anything else to show. The order speeds the join up; the
  result does not depend on it. An entry keeps its place in the set's order:
  sets whose first common shingle stands at places i and j share
  ``min(n - i, m - j)`` shingles at most, so a pair meets in a list only if
  that is as many as it needs, and entries that no member of the list is
  small enough for leave it.
* The boundary is the largest size whose subsets cost no more rows than its
  list entries and their checks (``light_boundary``).

A list is never expanded into pairs. Its members are checked against one
leader, the one in whose set the shingle comes earliest; whoever links joins the leader's component, and only lists that
still hold several components go on: small ones pair the members of different
components, large ones take further leaders, until every pair of members is
either checked or inside one component. Two sets that share several lists are
paired in the first of them only: an entry carries the small lists that its
set is in just before (``EARLIER``), and a list passes over pairs that have
one of these in common, as that one pairs all its members. A check first compares the parity
sketches of two sets (their difference is at least the number of differing
bits, so what it rejects cannot link) and then intersects the whole sets.
Lists of frequent shingles are split by a salt, and joined again by their
shingle in the later rounds; an entry of such a list carries its shingle.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firelog.llm.common import RangeHash, code_points, list_array, map_slices, mix, release_memory, runs, sliced, small_batches, stored, unused

WIDTH = 5
# Similarity 0.8 as a fraction.
NUM, DEN = 4, 5
# A list entry costs one row and, over the join, about this many more in checks.
CHECK_COST = 8
# Entries of the frequency order; a bound on what is broadcast, not on what is joined.
MAX_FREQUENT = 100_000
# A shingle counts as frequent from so many texts of one slice of this many bytes.
FREQUENT, FREQUENT_SLICE = 3, 8 << 20
# Entries of a frequent shingle's list per salt.
SALT_ROWS = 2000
# Lists up to this size pair their members at once; in larger ones so many leaders per round.
SMALL_LIST = 48
LEADERS = 16
# Small lists before an entry in its set's order that it carries; a pair without a common one among them is paired again.
EARLIER = 8
# Least number of cells of a parity sketch; larger sets have the next power of two of their size.
CELLS = 512
_NO_ID = -(1 << 63)


def need(n: int, m: int) -> int:
    """Least intersection of linked sets of sizes n and m."""
    return -(-NUM * (n + m) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def partner_sizes(n: int) -> range:
    return range(-(-NUM * n // DEN), n * DEN // NUM + 1)


def subset_rows(n: int, boundary: int) -> int:
    """Subsets that a set of size n enumerates under a boundary."""
    return sum(comb(n, need(min(n, m), max(n, m))) for m in partner_sizes(n) if min(n, m) <= boundary)


def light_boundary() -> int:
    """Largest size up to which enumerating subsets costs no more than list entries with their checks."""
    x = 0
    while subset_rows(x + 1, x + 1) <= (1 + CHECK_COST) * prefix_length(x + 1):
        x += 1
    return x


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A-Z is lower-cased, words are runs of other characters than blanks and
    tabs to carriage returns; 1 to 4 words are one shingle.
    """
    points, starts, _ = code_points(texts)
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    a, b = runs(~((points == 32) | ((points >= 9) & (points <= 13))))
    words = RangeHash(points).of(a, b)
    owner = np.searchsorted(starts, a, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        rolled = words.copy()
        for k in range(1, min(WIDTH, len(words))):
            rolled[: len(words) - k] = rolled[: len(words) - k] * factor + words[k:]
        rolled = mix(rolled + np.uint64(WIDTH))
        out = []
        for i, n in enumerate(count.tolist()):
            if n >= WIDTH:
                out.append(np.unique(rolled[first[i]:first[i] + n - WIDTH + 1]))
            elif n:
                h = np.uint64(n)
                for w in words[first[i]:first[i] + n]:
                    h = mix(h * factor + w)
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def class_id(tokens: np.ndarray) -> int:
    """64-bit identity of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity_sketch(tokens: np.ndarray) -> list[int]:
    """Parity of the number of shingles in each of ``CELLS`` or more cells, as 64-bit words.

    A sketch of twice the cells is folded to this one by joining its halves.
    """
    n = max(CELLS, 1 << (len(tokens) - 1).bit_length())
    cells = np.bincount((tokens & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64).tolist()


def subset_keys(tokens: np.ndarray, boundary: int) -> list[int]:
    n, keys = len(tokens), []
    for m in partner_sizes(n):
        lo, hi = min(n, m), max(n, m)
        if lo <= boundary:
            for part in combinations(tokens.tolist(), need(lo, hi)):
                raw = np.array([lo, hi, *part], np.uint64).tobytes()
                keys.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
    return keys


def salted(token: np.ndarray, salt: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.where(salt > 0, mix(token + salt.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), token)


def frequent_shingles(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent shingles, ``MAX_FREQUENT`` at most."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s for part in sliced(batch, 0) for s in shingle_sets([t or "" for t in part.column(0).to_pylist()])]
        h, n = np.unique(np.concatenate(sets), return_counts=True)
        often = n >= FREQUENT
        return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])

    parts = map_slices(docs.select(docs[text_col].alias("text")), "text", count, "h long, n long", max_bytes=FREQUENT_SLICE)
    top = parts.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).collect()
    h = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["n"] for r in top], np.int64)[order]


def _sets_table(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], boundary: int) -> DataFrame:
    """``(doc_id, n, cid, sketch, keys, salted)``: class, set size, and the class's sketch and keys (once per task, else null).

    ``keys`` are its list keys by their place in the set's order, then its
    subset keys; ``salted``, where a list is split, the shingles of those
    keys that have a salt (null at the others). Columns of ``docs`` (doc_id, text, ...) after the text, all long, follow.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MAX_FREQUENT entries

    more = docs.columns[2:]

    def run(batches):
        seen: set[int] = set()  # classes of this task
        often, weight = shared.value
        for whole in batches:
            for batch in sliced(whole, 1):
                sets = shingle_sets([t or "" for t in batch.column(1).to_pylist()])
                cids, keys, sketches, shingles = [], [], [], []
                for s in sets:
                    n = len(s)
                    if not n:
                        cids.append(None)
                        keys.append(None)
                        sketches.append(None)
                        shingles.append(None)
                        continue
                    c = class_id(s)
                    cids.append(c)
                    if c in seen:
                        keys.append(None)
                        sketches.append(None)
                        shingles.append(None)
                        continue
                    seen.add(c)
                    sketches.append(parity_sketch(s))
                    own, of = subset_keys(s, boundary) if partner_sizes(n)[0] <= boundary else [], None
                    if n > boundary:
                        if len(often):
                            at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                            w = np.where(often[at] == s, weight[at], 0)
                        else:
                            w = np.zeros(n, np.int64)
                        pick = np.lexsort((s, w))[:prefix_length(n)]
                        salts = -(-w[pick] // SALT_ROWS)
                        salt = np.where(salts > 1, np.int64(c & 0x7FFFFFFF) % np.maximum(salts, 1) + 1, 0)
                        own = salted(s[pick], salt).view(np.int64).tolist() + own
                        if salt.any():
                            of = [t if k else None for t, k in zip(s[pick].view(np.int64).tolist(), salt.tolist(), strict=True)]
                    keys.append(own)
                    shingles.append(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(cids, pa.int64()),
                     pa.array(sketches, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(shingles, pa.list_(pa.int64())), *batch.columns[2:]],
                    names=["doc_id", "n", "cid", "sketch", "keys", "salted", *more])
            release_memory()

    small_batches(docs.sparkSession)
    schema = ", ".join(["doc_id long, n long, cid long, sketch array<long>, keys array<long>, salted array<long>", *(f"{c} long" for c in more)])
    return stored(docs.mapInArrow(run, schema), "jaccard-sets")


def _fits(a: str, b: str):
    """Sizes of two sets that can link."""
    return (F.col(a) * DEN >= F.col(b) * NUM) & (F.col(b) * DEN >= F.col(a) * NUM)


def _may_share(n: str, place: str, m: str, other: str):
    """Whether sets of sizes n and m, with a list's shingle at these places, can have it as their first common one and link."""
    return F.least(F.col(n) - F.col(place), F.col(m) - F.col(other)) * (NUM + DEN) >= (F.col(n) + F.col(m)) * NUM


def _has_partner(least: str):
    """Whether an entry (n, place) of a list whose smallest set has size ``least`` can meet any member in it."""
    return (F.col("n") - F.col("place")) * (NUM + DEN) >= (F.col("n") + F.greatest(F.col(least), F.ceil(F.col("n") * NUM / DEN))) * NUM


def _near_sketches(sa: str, na: str, sb: str, nb: str):
    """Whether two sketches differ in no more bits than linked sets of these sizes can."""
    few = f"least(size({sa}), size({sb}))"
    folded = lambda s: f"({s}[i] ^ if(size({s}) > {few}, {s}[i + {few}], 0L))"
    apart = f"aggregate(sequence(0, {few} - 1), 0, (n, i) -> n + bit_count({folded(sa)} ^ {folded(sb)}))"
    return F.expr(f"{apart} <= {na} + {nb} - 2 * ceil(({na} + {nb}) * {NUM} / {NUM + DEN})")


def _pairs_in_lists(ranked: DataFrame, leaders: int) -> DataFrame:
    """Pairs (a, b) of members of different components: all of a small list, those with a leader of a large one.

    A pair that shares an earlier small list of both (``met``) is left to it: there
    both places are smaller, so it can still link, and all members are paired.
    """
    first = ranked.where((F.col("k") <= SMALL_LIST) | (F.col("turn") <= leaders)).select(
        "key", F.col("cid").alias("a_"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("turn").alias("ta"),
        F.col("place").alias("pa"), F.col("met").alias("ma"))
    both = ranked.join(first, "key").where((F.col("turn") > F.col("ta")) & (F.col("label") != F.col("la")) & _fits("n", "na")
                                           & _may_share("n", "place", "na", "pa") & ~F.arrays_overlap("met", "ma"))
    return both.select(F.least("a_", "cid").alias("a"), F.greatest("a_", "cid").alias("b"))


class _Checker:
    """Exact checks of candidate pairs of classes."""

    def __init__(self, docs: DataFrame, classes: DataFrame, sketches: DataFrame):
        self.docs, self.classes, self.sketches = docs, classes, sketches

    def possible(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) whose sketches allow a link."""
        own = self.sketches
        both = (pairs.join(own.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
                .join(own.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b"))
        return both.where(_near_sketches("sa", "na", "sb", "nb")).select("a", "b")

    def links(self, pairs: DataFrame) -> DataFrame | None:
        """The linked ones of ``pairs`` (a, b); some may be repeated."""
        pairs = stored(self.possible(pairs), "jaccard-possible")
        if pairs.limit(1).count() == 0:
            return None
        ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(self.classes, "cid").select("rep").distinct(),
                     "jaccard-ids")

        def sets_of(batches):
            seen: set[int] = set()
            for whole in batches:
                for batch in sliced(whole, 0):
                    new = []
                    for s in shingle_sets([t or "" for t in batch.column(0).to_pylist()]):
                        if len(s) and (c := class_id(s)) not in seen:
                            seen.add(c)
                            new.append((c, s))
                    lengths = np.array([len(s) for _, s in new], np.int64)
                    flat = np.concatenate([s for _, s in new]).view(np.int64) if new else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c for c, _ in new], pa.int64()), list_array(flat, lengths, pa.int64())], names=["cid", "tokens"])
            release_memory()

        named = self.docs.select("text", F.coalesce("doc_id", F.lit(_NO_ID)).alias("rep"))
        small_batches(pairs.sparkSession)
        sets = named.join(ids, "rep", "left_semi").select("text").mapInArrow(sets_of, "cid long, tokens array<long>")
        # both sides read one shuffle of the sets
        both = (pairs.join(sets.alias("y"), F.col("b") == F.col("y.cid")).select("a", "b", F.col("y.tokens").alias("tb"))
                .join(sets.alias("x"), F.col("a") == F.col("x.cid")))
        common = F.size(F.array_intersect("x.tokens", "tb"))
        ok = common * (NUM + DEN) >= (F.size("x.tokens") + F.size("tb")) * NUM
        return stored(both.where(ok).select("a", "b"), "jaccard-links")


def components(links: DataFrame) -> DataFrame:
    """``(cid, label)`` of every class with a link: the smallest class id it can reach.

    Labels spread along the links and are followed to their own labels
    (pointer jumping), so that rounds grow with the logarithm of the longest
    chain; each round is written to the shared folder.
    """
    near = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-near")
    labels = stored(near.groupBy(F.col("a").alias("cid")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "jaccard-labels")
    while True:
        spread = (near.join(labels.select(F.col("cid").alias("b"), "label"), "b").groupBy(F.col("a").alias("cid"))
                  .agg(F.min("label").alias("seen")))
        new = labels.join(spread, "cid").select("cid", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("cid").alias("label"), F.col("label").alias("beyond"))
        new = stored(new.join(jump, "label").select("cid", "old", F.least("label", "beyond").alias("label")), "jaccard-labels")
        done = new.where("label <> old").limit(1).count() == 0
        labels = new.select("cid", "label")
        if done:
            return labels


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("cid"))
    return rows.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))


def _linked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets of ``rows`` (doc_id, text, ...) and their classes with the label of each class's component."""
    boundary = light_boundary()
    frequent = frequent_shingles(rows, "text")
    table = _sets_table(rows, frequent, boundary)
    classes = stored(table.where("cid is not null").groupBy("cid").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"),
        F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("rep")), "jaccard-classes")
    at, prefix = F.col("at"), F.expr(f"n - ceil(n * {NUM} / {DEN}) + 1")
    entries = (table.where("keys is not null").select(F.posexplode("keys").alias("at", "key"), "cid", "n", "salted")
               .select("key", "cid", F.col("n").cast("int").alias("n"), F.get("salted", at).alias("shingle"),
                       F.when((F.col("n") > boundary) & (at < prefix), at).otherwise(0).alias("place"))
               .repartition("key").dropDuplicates(["key", "cid"]))
    # lists with the same members have the same name and are kept once, at their first shingle's places; a shingle's salted lists share its name
    in_list = Window.partitionBy("key")
    lists = stored(entries.withColumn("k", F.count(F.lit(1)).over(in_list)).withColumn("least", F.min("n").over(in_list))
                   .withColumn("lead", F.min(F.struct("place", "n", "cid")).over(in_list))
                   .withColumn("name", F.coalesce("shingle", F.bit_xor(F.xxhash64("cid")).over(in_list)))
                   .where(F.col("shingle").isNotNull() | ((F.col("k") > 1) & _has_partner("least")))
                   .select("name", "cid", "n", "place", F.col("lead.cid").alias("lead"), F.col("lead.n").alias("lead_n"),
                           F.col("lead.place").alias("lead_place")), "jaccard-lists")
    sketches = table.where("sketch is not null").select("cid", "n", "sketch").dropDuplicates(["cid"])
    checker = _Checker(rows, classes, stored(sketches, "jaccard-sketches"))
    order = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    tested = stored(lists.where((F.col("cid") != F.col("lead")) & _fits("n", "lead_n") & _may_share("n", "place", "lead_n", "lead_place"))
                    .select(F.col("lead").alias("a"), F.col("cid").alias("b")).select(*order).distinct(), "jaccard-pairs")
    links = checker.links(tested)
    labels = None if links is None else components(links)
    open_ = lists.groupBy(F.col("name").alias("key"), "cid", "n").agg(F.min("place").alias("place"))
    before = Window.partitionBy("cid").orderBy("place", "key").rowsBetween(-EARLIER, -1)
    leaders = LEADERS
    while True:
        named = _labelled(open_, labels)
        several = (named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k"),
                                            F.min("n").alias("least")).where("lo <> hi"))
        open_ = stored(named.join(several.select("key", "k", "least"), "key").where(_has_partner("least")).drop("least")
                       .withColumn("met", F.collect_list(F.when(F.col("k") <= SMALL_LIST, F.col("key"))).over(before)), "jaccard-open")
        if open_.limit(1).count() == 0:
            break
        ranked = open_.withColumn("turn", F.row_number().over(Window.partitionBy("key").orderBy("place", "n", "cid")))
        pairs = _pairs_in_lists(ranked, leaders).distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "jaccard-pairs")
        open_ = stored(ranked.where((F.col("k") > SMALL_LIST) & (F.col("turn") > leaders)).select("key", "cid", "n", "place"), "jaccard-open")
        leaders *= 4
        if pairs.limit(1).count() == 0:
            continue
        tested = tested.unionByName(pairs)
        more = checker.links(pairs)
        if more is not None and more.limit(1).count():
            links = more if links is None else links.unionByName(more)
            labels = components(links)
    return table, _labelled(classes, labels)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, cid, copies)``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links (a null id only
    where no other is reachable), ``cid`` identifies the text's set (null for
    a text without words), ``copies`` counts the rows of its class. A null or
    empty text has no shingles and is linked with nothing. Rows that repeat
    an id are separate documents with one name; repeated rows are copies.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    table, smallest = _linked(rows)
    whole = smallest.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = smallest.join(whole, "label").select("cid", "copies", "component_id")
    return table.join(of_class, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "cid", F.when(F.col("n") == 0, F.lit(1)).otherwise(F.col("copies")).alias("copies"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: one row of each.

    It is the one with the smallest id (null ids last), then by class, text
    and row hash; ids need not be unique, and rows are found again by id and
    text hash. Rows without words are linked with nothing and all stay.
    """
    key, h = docs[id_col].cast("long"), F.xxhash64(docs[text_col])
    table, classes = _linked(docs.select(key.alias("doc_id"), docs[text_col].alias("text"), h.alias("h")))
    worded = table.where("cid is not null")
    in_class = worded.groupBy("cid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("r"))
    best = (in_class.join(classes.select("cid", "label"), "cid").groupBy("label")
            .agg(F.min(F.struct("r.none", "r.doc_id", "cid", "r.h")).alias("r")).select("r.doc_id", "r.h"))
    repeats = worded.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    named = best.alias("b").join(repeats.alias("t"), F.col("b.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("b.h") == F.col("t.h")), "left")
    keep_id, keep_h, many = (unused(docs, c) for c in ("keep_id", "keep_h", "several"))
    keep = stored(named.select(F.col("b.doc_id").alias(keep_id), F.col("b.h").alias(keep_h), F.col("t.k").isNotNull().alias(many)),
                  "jaccard-kept")
    once, several = keep.where(~F.col(many)), keep.where(F.col(many))
    has_words = F.coalesce(docs[text_col].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = (h == F.col(keep_h)) & key.eqNullSafe(F.col(keep_id))
    out = docs.where(~has_words).unionByName(docs.where(has_words).join(once, same, "left_semi"))
    if several.limit(1).count() == 0:
        return out
    # equal (id, text) rows: the least by the hash of all columns that can be hashed, combined per task
    fields = [F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    row_hash = F.xxhash64(*fields, *(f.isNull() for f in fields))
    repeated = docs.where(has_words).join(several, same, "left_semi")
    first = (repeated.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.xxhash64(f"`{text_col}`").alias("h"), row_hash.alias("o"),
                             F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
             .groupBy("i", "h").agg(F.min_by("row", "o").alias("row")))
    return out.unionByName(first.select("row.*"))
