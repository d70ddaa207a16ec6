"""Archives written and read back, by ranges of every size."""

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from firelog.llm import queries, warc

SCHEMA = "page_id long, url string, html string, digest string, size string, payload string, path string"


def table(rng):
    texts = [None, "", "short", "x" * 999, "é" * 500, "y" * 1000, "".join(rng.choice("ab<>é😀") for _ in range(300_000))]
    texts += ["".join(rng.choice("abcdef <p>") for _ in range(rng.randrange(3000))) for _ in range(60)]
    rows = [(i * 7 % 101, rng.choice([None, "", "http://a/é b", "u\r\nX: y"]), t, "d", "s", "p", "q") for i, t in enumerate(texts)]
    rows += [(200 + i, "u", rng.choice([texts[5], texts[6], "x" * 999, "z" * 5000, None]), None, None, None, None) for i in range(40)]
    return rows + [(None, None, "z" * 5000, "", "", "", ""), (None, "u", "only null ids " * 100, "", "", "", ""),
                   (None, "u", "only null ids " * 100, "", "", "", ""), rows[6], (239, "u", "z" * 5000, "", "", "", "")]


def brute(rows):
    out, top = [], {}
    for n, r in enumerate(rows):
        p = (r[2] or "").encode()
        if len(p) >= 1000:
            key = (r[0] is not None, r[0] or 0, n)
            top[p] = max(top.get(p, key), key)
    for n, r in enumerate(rows):
        p = (r[2] or "").encode()
        first = len(p) < 1000 or top[p][2] == n
        out.append((r[0], len(p), hashlib.sha1(p).hexdigest(), "response" if first else "revisit",
                    None if first or not top[p][0] else top[p][1]))
    return sorted(out, key=str)


def test_query_against_brute_force_and_sql(spark, tmp_path):
    import duckdb

    rows = table(random.Random(2))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = sorted((tuple(r) for r in queries.op13_warc(spark, str(tmp_path)).select(names).collect()), key=str)
    assert got == brute(rows) and sum(g[3] == "revisit" for g in got) > 20
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op13_warc"])
    assert [c[0] for c in sql.description] == names
    assert sorted(sql.fetchall(), key=str) == got
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "a b")
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * i % 700), "", "", "", "") for i in range(300)] + [(i, None, "same " * 400, "", "", "", "") for i in range(300, 320)]
    files = warc.write_warc(warc.page_records(spark.createDataFrame(rows, SCHEMA).repartition(2)), folder, roll_bytes=20_000)
    return folder, rows, files


def test_ranges_of_one_byte(written):
    path = written[2].first()["path"]
    with open(path, "rb") as f:
        raw = f.read()
    read = lambda p: raw[p:p + 61]
    whole = list(warc.members(read, 0, len(raw)))
    assert len(whole) > 2
    for width in (1, 2, 3, 97):
        assert [m for a in range(0, len(raw), width) for m in warc.members(read, a, min(a + width, len(raw)))] == whole


@pytest.mark.parametrize("split", [3000, 1 << 30])
def test_ranges_of_any_size_give_every_record_once(spark, written, split):
    folder, rows, files = written
    assert files.count() > 2
    got = warc.read_warc(files, split_bytes=split).cache()
    pages = got.where("record_type <> 'warcinfo'")
    assert pages.count() == files.agg(F.sum("records")).first()[0] and got.where("record_type = 'warcinfo'").count() == files.count()
    text = {r[0]: r[2] for r in rows}
    for r in pages.withColumn("page_id", warc.page_id_of("record_id")).collect():
        want = text[r["page_id"]].encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(want), hashlib.sha1(want).hexdigest())
        assert r["payload"] == (want if r["record_type"] == "response" else None)
        assert r["url"] == (f"http://h/{r['page_id']}" if r["page_id"] < 300 else None)
    holder = pages.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"))
    assert pages.where("record_type = 'revisit'").join(holder, "refers_to").count() == 19
    got.unpersist()


def test_archives_are_plain_gzip_and_read_from_their_folder(spark, written):
    folder, rows, files = written
    listed = warc.archives(spark, folder)
    assert listed.count() == files.count()
    assert warc.read_warc(listed, with_payload=False).where("record_type in ('response', 'revisit')").count() == len(rows)
    for r in files.collect():
        with gzip.open(r["path"]) as f:
            text = f.read()
        assert text.count(b"WARC/1.1\r\n") >= r["records"] + 1 and text.endswith(b"\r\n\r\n")


def test_false_magic_nested_archives_and_damaged_members(spark, tmp_path):
    rng = random.Random(1)
    inner = b"".join(warc.page_record("response", f"urn:x-page:{900 + i}:0", None, "u", 5, hashlib.sha1(b"inner").hexdigest(), b"inner", warc.DATE) for i in range(40))
    noise = bytes(rng.randrange(256) for _ in range(3000))
    payloads = [b"plain", inner, noise + warc.MAGIC + noise, inner + noise, b"", warc.MAGIC * 500, gzip.compress(b"WARC/1.0 but no header end")]
    raw = b""
    for i, p in enumerate(payloads):
        raw += warc.page_record("response", f"urn:x-page:{i}:0", None, "u", len(p), hashlib.sha1(p).hexdigest(), p, warc.DATE)
        if i == 3:
            raw += gzip.compress(b"no record at all") + b"\0\0" + warc.MAGIC
    cut = warc.page_record("response", "urn:x-page:99:0", None, "u", 9, hashlib.sha1(noise).hexdigest(), noise, warc.DATE)[:-200]
    (tmp_path / "x.warc.gz").write_bytes(raw + cut)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    for split in (700, 1 << 20):
        got = warc.read_warc(warc.archives(spark, str(tmp_path)), split_bytes=split).select(warc.page_id_of("record_id"), "payload").collect()
        assert sorted((r[0], bytes(r[1])) for r in got) == list(enumerate(payloads))
    read = lambda p: raw[p:p + 50]
    assert [m[0] for m in warc.members(read, 0, len(raw))][:1] == [0] and list(warc.members(io.BytesIO(b"").read, 0, 0)) == []


def test_a_payload_that_differs_from_its_digest_is_an_error(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(warc.page_record("response", "urn:x-page:1:0", None, "u", 3, "00" * 20, b"abc", warc.DATE))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_warc(warc.archives(spark, str(tmp_path)))
