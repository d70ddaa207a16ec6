"""The bucketed store and its ledger, replays, growing files."""

import os
import re

import pytest
from pyspark.sql import functions as F

from firelog.operators import ingest as I
from firelog.plans import batch as B
from firelog.sources import growing as GR
from firelog.sources import store as ST
from firelog.streaming.ingest_stream import run_ingest_stream

LINE = "{ts} fw: action=DROP reason=PORTSCAN SRC={src} DST=198.51.100.9 LEN=60 TTL=61 PROTO=UDP SPT={spt} DPT=53"


def flagged(second, src="192.0.2.7", spt=5000, day=3):
    return LINE.format(ts=f"2025-02-0{day}T00:00:{second:02d}Z", src=src, spt=spt)


BAD = LINE.format(ts="2025-02-30T00:00:00Z", src="192.0.2.8", spt=1)


def lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "line_no long, line string")


def stored(spark, path):
    return sorted(tuple(r) for r in ST.read_log_store(spark, path).collect())


def test_stored_keys_are_not_shuffled(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    B.ingest_lines(spark, lines(spark, [flagged(i % 60, spt=i, day=1 + i % 5) for i in range(300)]), store, buckets=6)
    again = I.accepted(I.store_rows_from_lines(lines(spark, [flagged(i % 60, spt=i, day=1 + i % 5) for i in range(200, 400)])))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        new = I.insert_if_absent(again, ST.read_log_store(spark, store), buckets=6)
        assert new.count() == 100
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    right = plan.split("+- == Initial Plan ==")[0]
    right = right[right.index("LeftAnti"):]
    assert "Exchange hashpartitioning" in right, plan  # the batch's side
    scan = right.index("FileScan parquet", right.index("LeftAnti"))
    scan = next(m.start() for m in re.finditer("FileScan parquet [^\n]*firelog_store_", right) if m.start() >= scan)
    assert "Exchange" not in right[right.rindex("Sort [", 0, scan):scan], plan
    assert "Bucketed: true" in right[scan:right.index("\n", scan)], plan


def test_uncommitted_batches_are_not_read(spark, tmp_dir, monkeypatch):
    store, rejects = f"{tmp_dir}/store", f"{tmp_dir}/rejects"
    first, second = lines(spark, [flagged(1), BAD]), lines(spark, [flagged(1), flagged(2), flagged(3), BAD, BAD])
    B.ingest_lines(spark, first, store, rejects_path=rejects, batch="a")
    commit = ST.commit

    def fail(*args, **kw):
        raise RuntimeError("stopped before the commit")

    monkeypatch.setattr(ST, "commit", fail)
    with pytest.raises(RuntimeError):
        B.ingest_lines(spark, second, store, rejects_path=rejects, batch="b")
    monkeypatch.setattr(ST, "commit", commit)
    # the files of the failed batch are there, but no reader sees them
    assert os.path.isdir(f"{store}/batch=b") and os.path.isdir(f"{rejects}/batch=b")
    assert len(stored(spark, store)) == 1 and ST.rejects(spark, rejects, store).count() == 1
    assert ST.read_day_index(spark, store).agg(F.sum("rows")).first()[0] == 1
    counts, _ = B.ingest_lines(spark, second, store, rejects_path=rejects, batch="b")
    assert (counts["inserted"], counts["duplicates"], counts["errors"]) == (2, 1, 2)
    # equal bad lines are rows of their own, under their batch
    assert ST.rejects(spark, rejects, store).groupBy("batch").count().orderBy("batch").collect() == [("a", 1), ("b", 2)]
    before = sorted(os.listdir(f"{rejects}/batch=a"))
    again, _ = B.ingest_lines(spark, second, store, rejects_path=rejects, batch="b")
    assert again == counts and len(stored(spark, store)) == 3 and sorted(os.listdir(f"{rejects}/batch=a")) == before
    totals = ST.committed(spark, store).agg(F.sum("counters.lines_read"), F.sum("counters.errors")).first()
    assert tuple(totals) == (7, 3)


def test_compaction_keeps_rows_and_counters(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    assert ST.compact(spark, store, "c0") == [] and ST.read_log_store(spark, store) is None
    for k in range(3):
        B.ingest_lines(spark, lines(spark, [flagged(i, spt=k, day=1 + i % 2) for i in range(20)]), store, batch=f"b{k}", buckets=3)
    rows, days = stored(spark, store), sorted(map(tuple, ST.read_day_index(spark, store).collect()))
    files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(store))
    assert ST.compact(spark, store, "c1") == ["b0", "b1", "b2"] and ST.compact(spark, store, "c1") == []
    assert stored(spark, store) == rows and sorted(map(tuple, ST.read_day_index(spark, store).collect())) == days and len(rows) == 60
    assert ST.remove_replaced(spark, store) == ["b0", "b1", "b2"]
    assert stored(spark, store) == rows
    assert sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(store)) <= 6 < files
    counts, _ = B.ingest_lines(spark, lines(spark, [flagged(i, spt=1, day=1 + i % 2) for i in range(21)]), store, batch="b3")
    assert (counts["inserted"], counts["duplicates"]) == (1, 20)
    assert ST.ledger(spark, store).agg(F.sum("counters.inserted")).first()[0] == 61


def test_a_second_session_sees_the_store(spark, tmp_dir):
    store = f"{tmp_dir}/sto're"
    B.ingest_lines(spark, lines(spark, [flagged(1)]), store, buckets=2)
    other = spark.newSession()
    assert len(stored(other, store)) == 1
    B.ingest_lines(other, lines(other, [flagged(2)]), store)
    assert len(stored(spark, store)) == 2


def test_lines_of_any_split_are_read_once(tmp_path):
    text = b"first\n\n" + b"x" * 50 + b"\r\nlast\n" + b"no end"
    (tmp_path / "a").write_bytes(text)
    fs, _ = GR.open_fs(str(tmp_path))
    with fs.open_input_file(str(tmp_path / "a")) as f:
        end = GR.last_line_end(f, len(text))
        assert end == len(text) - 6 and GR.last_line_end(f, 0) == 0
        want = list(GR.lines_between(f, 0, 0, end, end))
        assert [v for _, v in want] == [b"first", b"", b"x" * 50 + b"\r", b"last"] and [text[a:a + len(v)] for a, v in want] == [v for _, v in want]
        for chunk in (3, 7, GR.CHUNK):
            GR.CHUNK, kept = chunk, GR.CHUNK
            for width in (1, 2, 5, 64):
                assert [r for a in range(0, end, width) for r in GR.lines_between(f, 0, a, min(a + width, end), end)] == want
            assert list(GR.lines_between(f, 7, 7, end, end)) == want[2:]
            GR.CHUNK = kept


def test_growing_file_is_read_from_its_old_end(spark, tmp_dir):
    src, store, ckpt, rejects = (f"{tmp_dir}/{n}" for n in ("src", "store", "ckpt", "rejects"))
    os.makedirs(src)

    def write(mode, *texts):
        with open(f"{src}/fw.log", mode) as f:
            f.write("".join(texts))

    def run():
        return run_ingest_stream(spark, src, store, checkpoint_location=ckpt, rejects_path=rejects, follow=True)

    write("w", flagged(1) + "\n", BAD + "\n", flagged(2)[:30])
    assert [(c["lines_read"], c["inserted"], c["errors"]) for c in run()] == [(2, 1, 1)]
    write("a", flagged(2)[30:] + "\n", flagged(3) + "\n")
    assert [(c["lines_read"], c["inserted"]) for c in run()] == [(2, 2)]
    assert sum(c["lines_read"] for c in run()) == 0
    with open(f"{src}/second.log", "w") as f:
        f.write(flagged(4) + "\r\n")
    assert sum(c["lines_read"] for c in run()) == 1
    # written anew under the same name: read from its start
    write("w", flagged(5) + "\n", flagged(1) + "\n")
    assert [(c["lines_read"], c["inserted"], c["duplicates"]) for c in run()] == [(2, 1, 1)]
    assert len(stored(spark, store)) == 5 and ST.rejects(spark, rejects, store).count() == 1
