"""Physical-plan properties the design relies on at scale."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import ingest as I
from firelog.operators import reads as R
from firelog.operators import report as RP

LINE = ("2025-01-0{d}T00:00:0{s}Z SRC=10.0.0.{s} DST=192.0.2.2 PROTO=TCP SPT=1 DPT=80 action=DROP "
        "reason=PORTSCAN LEN=500 TTL=64")


def lines(spark, n=40):
    return spark.createDataFrame([(i, LINE.format(d=1 + i % 7, s=i % 10)) for i in range(n)],
                                 "line_no long, line string").repartition(4)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df):
    # the adaptive plan before execution (stages not yet materialised)
    return df._jdf.queryExecution().sparkPlan().toString()


def test_dedupe_combines_before_shuffle(spark):
    p = initial_plan(I.dedupe_batch(I.accepted(I.store_rows_from_lines(lines(spark)))))
    # the partial aggregate runs before the shuffle
    assert "partial_max_by" in p


def test_anti_join_reuses_dedupe_partitioning(spark):
    store = I.ingest(lines(spark))["new_rows"]
    new = I.insert_if_absent(I.accepted(I.store_rows_from_lines(lines(spark, 60))), store)
    p = new._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in p
    # one hash exchange per aggregate (batch winner, store keys); the join adds none
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2, p


def test_summary_aggregates_before_join(spark):
    store = I.ingest(lines(spark))["new_rows"]
    geo = spark.createDataFrame([], S.GEO_SCHEMA)
    p = initial_plan(RP.ip_summary(store, geo))
    join_pos = p.find("Join")
    agg_pos = p.find("Aggregate", join_pos)
    assert join_pos >= 0 and agg_pos > join_pos   # the aggregate is below (inside) the join input


def test_page_is_top_k_not_sort(spark):
    store = I.ingest(lines(spark))["new_rows"]
    p = plan_of(R.logs_page(store, 5, 3))
    assert "TakeOrderedAndProject(limit=8, offset=3" in p


def test_runtime_partition_pruning(spark, tmp_dir):
    store = I.ingest(lines(spark))["new_rows"]
    store.write.partitionBy(S.LOG_PARTITION).parquet(f"{tmp_dir}/s")
    batch = I.ingest(lines(spark, 3))["accepted"]
    batch.write.parquet(f"{tmp_dir}/b")
    pruned = I.restrict_store_to(spark.read.parquet(f"{tmp_dir}/s"), spark.read.parquet(f"{tmp_dir}/b"))
    buf = io.StringIO()
    with redirect_stdout(buf):
        pruned.explain("formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*Subquery", buf.getvalue())
    assert pruned.select(F.countDistinct(S.LOG_PARTITION)).first()[0] == 3


def test_hot_address_join_is_split_when_not_broadcast(spark):
    import datetime as dt

    from firelog.operators.report import enriched_logs

    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        rows = [(dt.datetime(2025, 1, 1) + dt.timedelta(seconds=i),
                 "10.0.0.1" if i % 3 == 0 else f"10.1.{(i // 256) % 256}.{i % 256}",
                 "192.0.2.2", "TCP", i % 60000, 80, "DROP", "PORTSCAN", 40, 64, dt.date(2025, 1, 1))
                for i in range(n)]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.LOG_SCHEMA.fields) + ", log_date date"
        store = spark.createDataFrame(rows, schema).repartition(8)
        geo = spark.createDataFrame([("10.0.0.1", "US", "", "A", "", 0.0, 0.0, None)]
                                    + [(f"10.1.{j // 256}.{j % 256}", "X", "", "", "", 0.0, 0.0, None)
                                       for j in range(256 * 4)], S.GEO_SCHEMA)
        out = enriched_logs(store, geo)
        got = out.collect()
        assert len(got) == n
        assert sum(r.city == "A" for r in got) == (n + 2) // 3
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
