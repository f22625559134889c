import hashlib

import pytest
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.operators import dedup
from retailmill.operators.latest import latest_per_key
from retailmill.sources import feeds, star
import samples

DAY_1, DAY_2 = "2025-03-11T10:00:00Z", "2025-03-12T10:00:00Z"


def bronze(spark, day_2=DAY_2):
    one = feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_1, "day1"), DAY_1))
    two = feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_2, "day2"), day_2))
    return one.unionByName(two)


def make_pos(spark, rows):
    """(transaction_id, event_ts, ingestion_ts, record_hash, source_file) as bronze rows."""
    df = spark.createDataFrame(rows, "transaction_id string, e string, i string, record_hash string, source_file string")
    df = df.select(
        "transaction_id", F.col("e").cast("timestamp").alias("event_ts"),
        F.col("i").cast("timestamp").alias("ingestion_ts"), "record_hash", "source_file",
    )
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schemas.RAW_POS.fields
        ]
    )


T1, T2, T3 = "2025-01-01 10:00:00", "2025-01-01 11:00:00", "2025-01-01 12:00:00"


def test_batch_dedup_keeps_the_latest(spark):
    rows = dedup.dedup_batch(bronze(spark), schemas.POS).collect()
    assert len(rows) == 6
    assert next(r for r in rows if r.transaction_id == "K-103").source_file == "day2"


def test_table_dedup_and_log(spark):
    survivors, log = dedup.deduplicate(bronze(spark), schemas.POS)
    assert {r.transaction_id: r.source_file for r in survivors.collect()}["K-103"] == "day2"
    row, = log.collect()
    assert row.record_hash == hashlib.md5(b"K-103|2025-03-11T08:20:30+00:00").hexdigest()
    assert (row.record_key, row["count"]) == ("K-103|2025-03-11 08:20:30+00", 1)
    assert row.first_seen == row.last_seen and row.first_seen.day == 11
    assert log.schema.names == schemas.DEDUPLICATION_LOG.names


def test_dedup_is_idempotent(spark):
    once = dedup.dedup_table(bronze(spark), schemas.POS)
    assert sorted(map(str, dedup.dedup_table(once, schemas.POS).collect())) == sorted(map(str, once.collect()))
    assert dedup.duplicate_log(once, schemas.POS).count() == 0


def test_exact_tie(spark):
    tied = bronze(spark, day_2=DAY_1)
    kept = dedup.dedup_table(tied, schemas.POS)
    assert kept.where("transaction_id = 'K-103'").count() == 1
    deleted = dedup.dedup_table(tied, schemas.POS, mode="reference_delete")
    assert deleted.where("transaction_id = 'K-103'").count() == 0 and deleted.count() == 5


def test_reference_delete_cases(spark):
    df = make_pos(spark, [
        ("a", T1, T1, "h", "old"), ("a", T1, T2, "h", "new"),
        ("b", T1, T1, "h", "old"), ("b", T1, T2, "h", "x"), ("b", T1, T2, "h", "y"),
        ("c", None, T1, "h", "n1"), ("c", None, T2, "h", "n2"),
        (None, T1, T1, "h", "k1"), (None, T1, T1, "h", "k2"),
        ("d", T1, T1, "h", "only"),
    ])
    kept = {r.source_file for r in dedup.dedup_table(df, schemas.POS, mode="reference_delete").collect()}
    assert kept == {"new", "n1", "n2", "k1", "k2", "only"}
    one = dedup.dedup_table(df, schemas.POS)
    assert one.count() == 5 and one.where("transaction_id = 'c'").first().source_file == "n2"


def test_null_times_lose(spark):
    df = make_pos(spark, [("a", T1, None, "h", "n"), ("a", T1, T1, "h", "t"), ("b", T1, None, "h", "z"), ("b", T1, None, "h", "y")])
    got = {r.transaction_id: r.source_file for r in latest_per_key(df, ["transaction_id"], "ingestion_ts").collect()}
    assert got == {"a": "t", "b": "y"}


def brute_force_log(rows):
    """Rank each group in Python and count what is not first."""
    groups = {}
    for t, e, i, h, s in rows:
        groups.setdefault((t, e), []).append((i, h))
    log = {}
    for (t, e), copies in groups.items():
        copies.sort(key=lambda c: (c[1] is None, c[1] or ""))
        copies.sort(key=lambda c: c[0], reverse=True)
        for i, h in copies[1:]:
            if h is not None:
                log.setdefault((t, e, h), []).append(i)
    return {k: (min(v), max(v), len(v)) for k, v in log.items()}


def test_log_matches_ranking(spark):
    rows = [
        ("a", T1, T1, "h", "1"), ("a", T1, T2, "h", "2"), ("a", T1, T3, "h", "3"),
        ("b", T1, T1, None, "1"), ("b", T1, T2, "h", "2"),
        ("c", T1, T2, None, "1"), ("c", T1, T1, "h", "2"),
        ("d", T1, T1, None, "1"), ("d", T1, T2, None, "2"),
        ("e", T1, T2, "h", "1"), ("e", T1, T2, "h", "2"),
        ("f", None, T1, "h", "1"), ("f", None, T2, "h", "2"),
        ("g", T1, T1, "h1", "1"), ("g", T1, T2, "h2", "2"), ("g", T1, T3, "h1", "3"),
        ("i", T1, T1, "h", "1"),
        ("j", T1, T2, None, "1"), ("j", T1, T2, "h", "2"),
    ] + [("hot", T2, f"2025-01-02 00:{n // 60:02d}:{n % 60:02d}", "hh", str(n)) for n in range(500)]
    log = dedup.duplicate_log(make_pos(spark, rows), schemas.POS).collect()
    got = {(r.record_key, r.record_hash): (str(r.first_seen), str(r.last_seen), r["count"]) for r in log}
    want = {(None if e is None else f"{t}|{e}+00", h): v for (t, e, h), v in brute_force_log(rows).items()}
    assert got == want


def test_keep_first_and_latest(spark):
    df = make_pos(spark, [("a", T1, T1, "h", "old"), ("a", T1, T2, "h", "new"), ("", None, T1, "h", "e"), (None, None, T2, "h", "n")])
    keys = schemas.POS.hash_keys
    first = {r.source_file for r in dedup.dedup_by_hash(df, keys, keep="first").collect()}
    latest = {r.source_file for r in dedup.dedup_by_hash(df, keys).collect()}
    # NULL and '' are one key for the fingerprint
    assert first == {"old", "e"} and latest == {"new", "n"}
    with pytest.raises(ValueError):
        dedup.dedup_by_hash(df, keys, keep="last")


def test_inventory_and_crm_batch_keys(spark):
    crm = feeds.good_rows(feeds.parse_crm(samples.lines(spark, samples.CRM_DAY_1 + samples.CRM_DAY_2), DAY_1))
    got = {r.customer_id: r.updated_at.day for r in dedup.dedup_batch(crm, schemas.CRM).collect()}
    assert got == {"M-1": 12, "M-2": 11, "M-3": 12, "M-4": 11, "M-5": 12}
    twice = samples.INVENTORY + ["B-1,PIER,Rope 20 m,9,18.9,2025-03-11T06:00:00Z", "B-1,DOCK,Rope 20 m,5,18.9,2025-03-10T00:00:00Z"]
    inv = feeds.good_rows(feeds.parse_inventory(samples.lines(spark, twice), DAY_1))
    rows = dedup.dedup_batch(inv, schemas.INVENTORY).collect()
    assert len(rows) == 4 and {r.quantity for r in rows if r.product_id == "B-1"} == {9, 5}


def test_registry():
    assert schemas.deduplication_keys("ns.raw_pos_transactions") == ["transaction_id", "event_ts"]
    assert schemas.deduplication_keys("raw_inventory_snapshots") == ["product_id", "store_id", "last_updated"]
    assert schemas.deduplication_keys("unknown") == []


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedup.dedup_table(bronze(spark), schemas.POS)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_customers_of_one_file_widen_in_many_tasks(spark, sf_dir):
    """The rows of a file of one row group multiply after they are dealt out."""
    people = star.raw_crm(spark, sf_dir).where("customer_id LIKE 'C%'")
    tasks = {r.p for r in people.select(F.spark_partition_id().alias("p")).distinct().collect()}
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
