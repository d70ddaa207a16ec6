"""Merkle manifest and its audit against a plain computation over the whole table."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from firelog.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree long, pos string, hash string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(levels, pos):
    """Siblings of a place, level by level."""
    out = []
    for level in levels[:-1]:
        a = pos // 16 * 16
        out.append((level[a:pos], level[pos + 1:a + 16]))
        pos //= 16
    return out


def levels_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        group = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, bytes.fromhex(leaf_of(r, r["text"]))))
        trees[s] = (group, levels_of([leaf_of(r, r["text"]) for r in group]))
    top = levels_of([trees[s][1][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        group, levels = trees[s]
        for i, r in enumerate(group):
            path = climb(levels, i) + climb(top, number)
            told = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            text = r["text"]
            if told and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            h = leaf_of(r, text)
            for left, right in path:
                h = sha("".join(left) + h + "".join(right))
            proof = sha("".join(itertools.chain(*(a + b for a, b in path))))
            out.append((r["doc_id"], levels[0][i], levels[-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(out, key=str)


def table(rng, counts):
    rows = []
    for source, n in counts.items():
        for _ in range(n):
            i = len(rows) * 3 % 1009
            text = rng.choice([None, "", "Ab cÉ", "no capitals", "X" * rng.randrange(2000), "é中😀 Q", "12:-", f"Text {i}"])
            rows.append((i, text, rng.choice(["en", None, "de"]), source, rng.choice([None, 0, -5, 10**12]), 1, "p", "h"))
    rows += [rows[0]] * 3 + [rows[-1]] + [(None, "N A", "en", "s1", 1, 1, "p", "h")] * 2 + [(None, "z", None, "s1", None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counts", [
    {"s1": 300, None: 17, "é": 1, "Z": 16, "": 2, "a": 33, **{f"u{i}": 1 for i in range(14)}},
    {"s1": 1},
    {f"u{i:03d}": 1 + i % 2 for i in range(300)},
])
def test_query_against_brute_force(spark, tmp_path, counts):
    import duckdb

    rows = table(random.Random(3), counts)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).select(names).collect()), key=str)
    assert got == brute(docs.collect()) and {g[-1] for g in got} <= {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op12_merkle_manifest"])
    assert [c[0] for c in sql.description] == names and sorted(sql.fetchall(), key=str) == got


def test_empty_table_and_hot_nodes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"T{i}", "en", "one", i, 0, "", "") for i in range(700)], SCHEMA)
    none = merkle.audit(merkle.build(merkle.leaves(docs.limit(0), ["doc_id", "text"])))
    assert none.count() == 0 and none.columns[:2] == ["doc_id", "leaf"]
    monkeypatch.setattr(merkle, "CLIMBERS", 4)  # every upper node lies in several copies
    told = merkle.leaves(docs, ["doc_id", "text"], altered={"text": F.lit("x")}, where=F.col("doc_id") % 7 == 0)
    manifest = merkle.build(told)
    rows = merkle.audit(manifest).collect()
    assert len(rows) == 700 and all(r["verified"] == (r["doc_id"] % 7 != 0) for r in rows)
    assert manifest.nodes.where("up_tree is null").count() == 1 and manifest.nodes.count() == 44 + 3 + 1


def test_order_of_input_changes_nothing(spark):
    docs = spark.createDataFrame([(i % 50, f"T{i % 60}", None, None if i % 3 else "s", None, 0, "", "") for i in range(120)], SCHEMA)
    roots = {merkle.build(merkle.leaves(d, ["doc_id", "text"])).root for d in (docs, docs.repartition(7), docs.orderBy(F.desc("text")))}
    assert len(roots) == 1
