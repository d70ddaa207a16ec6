"""Periodic runs of words by descending-LCP Kruskal (operator 11).

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends. If it is ``e`` periods long, e >= 2, its first
suffix and the one q words later share exactly ``length - q >= (e - 1) * q``
words, and no suffix between them shares as many with either (a smaller
period would follow). So the two stand next to each other in the ordered set
of their class at the very level at which they meet.

The words of a slice of texts are ranked by prefix doubling; a text's number
comes before its words, so that no suffix class spans two texts. Neighbours in
the order of suffixes are edges weighted by their common prefix; edges are
taken by decreasing weight (Kruskal), classes are united by union-find, and
the positions of the smaller are dealt into the ordered positions of the
larger. Two positions that become neighbours at level ``l`` and lie ``d``
apart, ``(e - 1) * d <= l``, seed the run of period d that begins at the first
of them if the words before them differ; it ends where their common prefix
does. No run has its first level below ``least_level``: edges under it are
not made, so a text without long repeats costs its ranking only.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelog.llm.common import map_slices

MIN_WORDS = 24
MIN_PERIODS = 3
WORD = r"([^\x20\x09-\x0D]+)"

_RUN = "start: bigint, length: bigint, period: bigint"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_level(min_words: int, min_periods: int) -> int:
    """Least common prefix of the first two periods of any run: ``max(min_words - q, (e - 1) * q)`` over all q."""
    return -(-min_words * (min_periods - 1) // min_periods)


def suffix_ranks(words: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their owner and their next 1, 2, 4, ... words, until all differ.

    ``owner`` ascends. A rank is the number of positions that sort before its
    group. The end of an owner's words sorts before all words.
    """
    n = len(words)
    left = np.searchsorted(owner, owner, side="right") - np.arange(n)  # words up to the owner's end
    pos, base = np.arange(n), np.zeros(n, np.int64)
    key = owner.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    out, width = [], 0
    while len(pos):
        rank = out[-1].copy() if out else np.zeros(n, np.int32)
        if width:
            base = rank[pos].astype(np.int64)
            follow = np.where(left[pos] == width, 0, out[-1][np.minimum(pos + width, n - 1)] + 1)
            key = base * (n + 1) + follow
        order = np.argsort(key)
        pos, base, key, at = pos[order], base[order], key[order], np.arange(len(pos))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(np.concatenate([[True], base[1:] != base[:-1]]), at, 0))
        rank[pos] = base + np.maximum.accumulate(np.where(new, at, 0)) - first
        out.append(rank)
        size = np.diff(np.append(np.flatnonzero(new), len(pos)))
        pos = np.sort(pos[np.repeat(size > 1, size)])
        width = width * 2 or 1
    return out


def repeat_edges(ranks: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of suffixes that share ``least`` words or more, by decreasing common prefix."""
    known = min(len(ranks), least.bit_length()) - 1
    if known < 0 or 2 << known <= least:
        return (np.zeros(0, np.int64),) * 3  # no two positions share so many words
    n = len(ranks[0])
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    same = np.flatnonzero(ranks[known][order[:-1]] == ranks[known][order[1:]])
    x, y = order[same], order[same + 1]
    shared = np.zeros(len(x), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = x + shared, y + shared
        inside = (i < n) & (j < n)
        i, j = np.where(inside, i, 0), np.where(inside, j, 0)
        shared += np.where(inside & (ranks[k][i] == ranks[k][j]), 1 << k, 0)
    keep = shared >= least
    x, y, shared = x[keep], y[keep], shared[keep]
    order = np.argsort(-shared, kind="stable")
    return x[order], y[order], shared[order]


def find_runs(words: np.ndarray, owner: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of every run of every owner, positions in the whole array, sorted by start and period."""
    if min_periods < 2:
        raise ValueError("a run must be two periods long at least")
    x, y, level = repeat_edges(suffix_ranks(words, owner), least_level(min_words, min_periods))
    if not len(x):
        return []
    nodes, flat = np.unique(np.concatenate([x, y]), return_inverse=True)
    members = [[p] for p in nodes.tolist()]
    root = list(range(len(nodes)))
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    begins = set(first.tolist())
    found: dict[tuple[int, int], int] = {}

    def neighbours(i: int, j: int, shared: int) -> None:
        d = j - i
        if (min_periods - 1) * d <= shared and d + shared >= min_words and (i in begins or words[i - 1] != words[j - 1]):
            # a multiple of the period can show up before the period itself: the least stays
            found[i, j + shared] = min(d, found.get((i, j + shared), d))

    for a, b, shared in zip(flat[: len(x)].tolist(), flat[len(x):].tolist(), level.tolist(), strict=True):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        if small[0] > large[-1]:
            neighbours(large[-1], small[0], shared)
            large += small
        else:
            before = -1
            for k, p in enumerate(small):
                at = bisect_left(large, p)
                if at and large[at - 1] != before:
                    neighbours(large[at - 1], p, shared)
                if at < len(large) and (k + 1 == len(small) or small[k + 1] > large[at]):
                    neighbours(p, large[at], shared)
                large.insert(at, p)
                before = p
        root[b], members[b] = a, []
    return sorted((i, j, d) for (i, j), d in found.items())


def _batch_runs(texts: list[bytes], min_words: int, min_periods: int) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """Words of each text and its runs ``(start, length, period)`` in word numbers."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]  # bytes are split at blanks and tabs to carriage returns, at nothing else
    count = np.array([len(w) for w in split], np.int64)
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64, int(count.sum()))
    owner = np.repeat(np.arange(len(texts)), count)
    offset = np.concatenate([[0], np.cumsum(count)])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, j, d in find_runs(words, owner, min_words, min_periods):
        runs[owner[i]].append((int(i - offset[owner[i]]), int(j - i), int(d)))
    return split, runs


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay: of each run its first period."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        stay = np.cumsum(drop[:-1]) == 0
        words = [words[i] for i in np.flatnonzero(stay).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per row of ``docs``.

    ``runs`` lists (start, length, period) of every run of ``min_words`` words
    and ``min_periods`` periods or more, by start and period, in word numbers
    from 0; ``collapsed`` is the text's words, joined by single blanks,
    without those that any run holds after its first period. Words are
    stretches of other characters than blanks and tabs to carriage returns,
    compared byte by byte. A null or empty text has no words, no runs and an
    empty ``collapsed``; null ids, repeated rows and ties stay as they are;
    other columns are ignored, whatever their names; an empty table gives an
    empty result. A text is ranked whole, in about 100 bytes of memory a word.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        split, runs = _batch_runs(texts, min_words, min_periods)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w in split], pa.int64()),
             pa.array([[dict(start=s, length=n, period=q) for s, n, q in r] for r in runs], pa.list_(_RUN_TYPE)),
             pa.array([_kept(w, r) for w, r in zip(split, runs, strict=True)], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(narrow, "text", run, f"doc_id bigint, n_words bigint, runs array<struct<{_RUN}>>, collapsed string")


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """``text`` with a periodic tail where 10 divides the id's crc32: the words from one on repeat the first of them.

    The first of the tail and the period follow from the crc32 and the number
    of words; other texts, also those without words or id, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def edited(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, F.nullif(n, F.lit(0)))
        p = F.floor((n - a) / (g % 8 + 3)).cast("long") + 1
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))), " ")

    # the lambda binds the words, so that they are split once
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(1))
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, edited(w))), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(changed, text)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Runs of each text as a report: the longest by periods, and hashes of all runs and of the collapsed text.

    The longest is the run with the greatest length / period; ties go to the
    smaller start, then period. Without runs its four columns are null.
    """
    def by_periods(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a > b, -1).when(a < b, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", by_periods), F.lit(0))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
