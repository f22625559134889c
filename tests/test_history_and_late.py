from datetime import datetime

import pytest
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.operators import late, scd2
from retailmill.sources import feeds
import samples

RUN_1, RUN_2, RUN_3 = "2025-03-11T09:00:00Z", "2025-03-12T09:00:00Z", "2025-03-13T09:00:00Z"


def crm(spark, values, as_of, legacy=False):
    return feeds.good_rows(feeds.parse_crm(samples.lines(spark, values), as_of, legacy))


def counts(metrics):
    row = metrics.first()
    return row.records_processed, row.metadata


def test_first_second_and_repeated_run(spark):
    day_1 = crm(spark, samples.CRM_DAY_1, RUN_1)
    both = day_1.unionByName(crm(spark, samples.CRM_DAY_2, RUN_2))
    dim_1, m_1 = scd2.scd2_upsert(scd2.empty_dim(spark), day_1, RUN_1)
    assert counts(m_1) == (4, '{"records_inserted":4,"records_updated":0}')
    dim_2, m_2 = scd2.scd2_upsert(dim_1, both, RUN_2)
    assert counts(m_2) == (5, '{"records_inserted":3,"records_updated":2}')
    rows = dim_2.collect()
    assert len(rows) == 7 and sum(r.is_current for r in rows) == 5
    c1 = sorted((r for r in rows if r.customer_id == "M-1"), key=lambda r: r.effective_from)
    assert c1[0].effective_to == c1[1].effective_from and c1[1].effective_to is None
    assert [r.is_current for r in c1] == [False, True]
    c3 = [r for r in rows if r.customer_id == "M-2"]
    assert len(c3) == 1 and c3[0].is_current  # absent on day 2: left alone
    dim_3, m_3 = scd2.scd2_upsert(dim_2, both, RUN_3)
    assert counts(m_3) == (5, '{"records_inserted":0,"records_updated":0}')
    assert sorted(map(str, dim_3.collect())) == sorted(map(str, rows))
    assert dim_2.schema.names == schemas.CUSTOMER_DIM.names
    assert len({r.customer_sk for r in rows}) == 7


def test_without_tier_only_new_customers_change(spark):
    day_1 = crm(spark, samples.CRM_DAY_1, RUN_1, legacy=True)
    both = day_1.unionByName(crm(spark, samples.CRM_DAY_2, RUN_2, legacy=True))
    dim_1, _ = scd2.scd2_upsert(scd2.empty_dim(spark), day_1, RUN_1)
    dim_2, metrics = scd2.scd2_upsert(dim_1, both, RUN_2)
    assert counts(metrics) == (5, '{"records_inserted":1,"records_updated":0}') and dim_2.count() == 5


def test_row_hash_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("Anna", "Lopez", "anna.lopez@example.com", "Gold", None, "New York", "USA"),
         ("Anna", "Lopez", "anna.lopez@example.com", "Gold", "Gold+", "New York", "USA")],
        ", ".join(f"{c} string" for c in scd2.ATTRIBUTES),
    )
    assert [r[0] for r in df.select(scd2.attributes_hash(scd2.ATTRIBUTES)).collect()] == [
        "0cfb49e3c4bc388beb01de98ffecfc48", "04d39682a31d131c8d4dbea5c616281c",
    ]


def test_source_rules(spark):
    base = crm(spark, ["C1,New,,,,,,2025-03-11T08:00:00Z"], "2025-03-11T08:30:00Z")
    older_load = crm(spark, ["C1,Old,,,,,,2025-03-11T08:00:00Z"], "2025-03-11T08:10:00Z")
    invalid = crm(spark, ["C2,x,,,,,,2025-03-11T08:00:00Z"], RUN_1).withColumn("dq_status", F.lit("INVALID"))
    unknown = crm(spark, ["C3,x,,,,,,2025-03-11T08:00:00Z"], RUN_1).withColumn("dq_status", F.lit(None).cast("string"))
    stale = crm(spark, ["C4,x,,,,,,2024-10-20T08:00:00Z"], RUN_1)
    undated = crm(spark, ["C5,x,,,,,,never"], RUN_1)
    raw = base.unionByName(older_load).unionByName(invalid).unionByName(unknown).unionByName(stale).unionByName(undated)
    got = {r.customer_id: r.first_name for r in scd2.source_snapshot(raw, RUN_1).collect()}
    assert got == {"C1": "New", "C3": "x"}


INGESTED = "2025-03-11T11:15:00Z"


def test_an_old_run_over_fuller_tables_sees_its_own_time(spark):
    both = crm(spark, samples.CRM_DAY_1, RUN_1).unionByName(crm(spark, samples.CRM_DAY_2, RUN_2))
    then = scd2.source_snapshot(both, RUN_1)
    assert {(r.customer_id, r.updated_at.day) for r in then.collect()} == {(k, 11) for k in ("M-1", "M-2", "M-3", "M-4")}


def late_pos(spark):
    values = [
        '{"transaction_id":"two_hours","timestamp":"2025-03-11T09:15:00Z"}',       # exactly 2 h
        '{"transaction_id":"almost","timestamp":"2025-03-11T09:15:01Z"}',          # 1 h 59 min 59 s
        '{"transaction_id":"day_before","timestamp":"2025-03-10T11:15:00Z"}',
        '{"transaction_id":"untimed"}',
    ]
    return {schemas.POS.name: feeds.good_rows(feeds.parse_pos(samples.lines(spark, values), INGESTED))}


def test_late_means_two_whole_hours(spark):
    rows = late.late_records(late_pos(spark), INGESTED, 7).collect()
    assert {r.record_key: r.arrival_delay_seconds for r in rows} == {"two_hours": 7200, "day_before": 86400}
    metrics = late.late_metrics(late.late_records(late_pos(spark), INGESTED, 7), INGESTED).first()
    assert metrics.metadata == '{"table_name_param":"all","avg_delay_seconds":46800,"max_delay_seconds":86400}'


def test_table_choice_and_lookback(spark):
    tables = late_pos(spark)
    assert late.late_records(tables, INGESTED, 7, None).count() == 2
    assert late.late_records(tables, INGESTED, 7, "raw_pos_transactions").count() == 2
    assert late.late_records(tables, "2025-04-20T00:00:00Z", 7).count() == 0
    with pytest.raises(ValueError):
        late.late_records(tables, INGESTED, 7, "raw_inventory_snapshots")


def test_rows_of_a_later_load_are_not_late_yet(spark):
    assert late.late_records(late_pos(spark), "2025-03-11T11:14:59Z", 7).count() == 0


def test_late_merge(spark):
    found = late.late_records(late_pos(spark), INGESTED, 7)
    empty = spark.createDataFrame([], schemas.LATE_ARRIVING)
    once = late.late_upsert(empty, found)
    assert once.schema.names == schemas.LATE_ARRIVING.names
    done = late.mark_processed(once, RUN_2)
    again = late.late_upsert(done, found)
    assert sorted(map(str, again.collect())) == sorted(map(str, done.collect()))
    assert {(r.processed, r.processed_timestamp) for r in again.collect()} == {(True, datetime(2025, 3, 12, 9))}
    longer = found.withColumn("arrival_delay_seconds", F.col("arrival_delay_seconds") + 5)
    assert {r.arrival_delay_seconds for r in late.late_upsert(again, longer).collect()} == {7205, 86405}
    shorter = found.withColumn("arrival_delay_seconds", F.lit(1).cast("bigint"))
    assert {r.arrival_delay_seconds for r in late.late_upsert(again, shorter).collect()} == {7200, 86400}


def test_backfill_dates(spark):
    tracking = late.late_upsert(
        spark.createDataFrame([], schemas.LATE_ARRIVING), late.late_records(late_pos(spark), INGESTED, 7)
    )
    pending = late.pending_dates(tracking, schemas.POS.name)
    assert {str(r.affected_date) for r in pending.collect()} == {"2025-03-10", "2025-03-11"}
    assert late.pending_dates(late.mark_processed(tracking, RUN_2), schemas.POS.name).count() == 0
    partly = late.mark_processed(tracking, RUN_2, "raw_ecom_orders")
    assert late.pending_dates(partly, schemas.POS.name).count() == 2
