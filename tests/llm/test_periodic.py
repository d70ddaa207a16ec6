"""Periodic runs against brute force over all periods and positions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firelog.llm import periodic, queries


def brute(words, min_words=24, min_periods=3):
    """Every run, from the stretches on which words q apart are equal."""
    n, out = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, min_periods * q) and j > i:
                out.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def random_words(rng):
    kind, n = rng.randrange(5), rng.randrange(1, 200)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:  # nested periods
        unit = [rng.choice("ab") for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 12) + [rng.choice("abc")]
        return unit * rng.randrange(1, 9)
    if kind == 2:  # several stretches
        out = []
        while len(out) < n:
            out += [rng.choice("abcd") for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 14)
        return out
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    return [f"w{rng.randrange(50)}" for _ in range(n)] + ["z"] * rng.randrange(60)


def test_runs_against_brute_force():
    rng = random.Random(5)
    for k in range(60):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 6))] + [[]]
        texts += texts[:2]
        least, periods = [(24, 3), (24, 3), (2, 2), (7, 2), (12, 4)][k % 5]
        split, runs = periodic._batch_runs([" ".join(t).encode() for t in texts], least, periods)
        assert [[w.decode() for w in ws] for ws in split] == texts
        assert runs == [brute(t, least, periods) for t in texts]


def test_a_long_run_and_a_long_text_take_little_time():
    words = (["a"] * 60_000) + [f"w{i}" for i in range(60_000)] + ["a", "b", "c"] * 20_000
    (_, runs) = periodic._batch_runs([" ".join(words).encode()], 24, 3)
    assert runs == [[(0, 60_000, 1), (120_000, 60_000, 3)]]


SCHEMA = "doc_id long, text string, runs string, n_words long, best long, words string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "one", "a " * 24, "a " * 23, "A a " * 30, "x y  z " * 12, "\x1c b\x0bc\n" * 30, "é 中 😀\r\n" * 9]
    texts += [" ".join(random_words(rng)) for _ in range(80)] + [" ".join(f"w{i}" for i in range(rng.randrange(1, 400))) for _ in range(60)]
    rows = [(i, t, "r", 1, 2, "w") for i, t in enumerate(texts)] + [(None, "c " * 40, None, None, None, None)] * 2 + [(3, "one", "r", 1, 2, "w")]
    return spark.createDataFrame(rows, SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def edited(doc_id, words):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(docs, spark, tmp_path):
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=str)
    want = []
    for r in docs.collect():
        words = edited(r["doc_id"], words_of(r["text"]))
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        keep = np.ones(len(words), bool)
        for s, n, q in runs:
            keep[s + q:s + n] = False
        kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r["doc_id"], len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=str) and sum(w[1] > 0 for w in want) > 40


def test_interface(docs, spark):
    found = periodic.periodic_runs(docs)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[0]["collapsed"] == rows[2]["collapsed"] == "" and rows[0]["runs"] == []
    assert [tuple(r) for r in rows[4]["runs"]] == [(0, 24, 1)] and rows[4]["collapsed"] == "a" and rows[5]["runs"] == []
    assert [tuple(r) for r in rows[6]["runs"]] == [(0, 60, 2)] and rows[6]["collapsed"] == "A a"
    assert found.count() == docs.count() and periodic.periodic_runs(docs.limit(0)).count() == 0
    short = periodic.periodic_runs(docs.where(F.col("doc_id") == 4), min_words=25)
    assert short.first()["runs"] == []
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(3, np.int64), np.zeros(3, np.int64), 3, 1)
