"""The corpus pipeline on a small table, stage by stage, against brute force."""

import re
from itertools import combinations

import pytest

import corpus_pipeline as P

WORDS = [w + e for w in "ban dor fel gim hut kal lom nir pos rud".split() for e in ("a", "e", "ik", "om", "us", "et")]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def passage(seed, n=60):
    return [WORDS[(seed * 31 + i * i * 7 + i * (seed % 11)) % len(WORDS)] for i in range(n)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = [(i, " ".join(passage(i)), "xx", "s" + str(i % 3), 0) for i in range(40)]
    near = passage(5)
    near[59] = "changed"
    rows += [(100, " ".join(near), "xx", "s0", 0), (101, " ".join(passage(7)), "xx", "s1", 0),
             (102, " ".join(passage(9)) + " mail anna@example.org now", "xx", None, 0),
             (103, None, "xx", "s0", 0), (104, "", None, "s0", 0), (105, "12 34 !!", "xx", "s0", 0)]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").coalesce(2).write.parquet(
        f"{folder}/documents.parquet")
    return folder


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_brute_force(rows):
    """Ids of one row per component: the smallest; rows without words all stay."""
    sets = {r.doc_id: shingles(r.text or "") for r in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a, b in combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return sorted(i for i in sets if label[i] == i)


def test_stages(spark, table):
    docs, steps = spark.read.parquet(f"{table}/documents.parquet"), {}
    for name, stage in P.STAGES:
        before, docs = docs, P.stored(stage(spark, docs, table), f"test-{name}")
        steps[name] = (before.collect(), docs.collect(), docs.columns)
    for name in list(steps)[:-1]:
        assert sorted(steps[name][2]) == sorted(COLUMNS)
    # texts without a letter have no language; every other document stays
    before, after, _ = steps["language_id"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if any(c.isalpha() for c in r.text or ""))
    before, after, _ = steps["near_duplicates"]
    assert sorted(r.doc_id for r in after) == kept_by_brute_force(before)
    assert {100, 101}.isdisjoint(r.doc_id for r in after)
    before, after, _ = steps["pii"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    assert not any("anna@example.org" in r.text for r in after)
    before, after, _ = steps["mixing"]
    texts = {r.doc_id: r.text for r in before}
    assert after and all(r.text == texts[r.doc_id] for r in after)
    assert max(sum(r.doc_id == i for r in after) for i in texts) <= 2
    before, after, _ = steps["sentencepiece"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    assert all(r.n_ids == len(r.ids) > 0 for r in after)
    assert P.run(spark, table).count() == len(after)
