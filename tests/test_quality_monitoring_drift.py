from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill import schemas
from retailmill.operators import drift, monitoring, quality
from retailmill.plans import analytics, marts
from retailmill.sources import feeds
from retailmill.streaming import pos as stream
import samples

NOW = "2025-03-11T11:15:00Z"


def tables(spark):
    return {
        schemas.POS.name: feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_1 + samples.POS_DAY_2), NOW)),
        schemas.ECOM.name: feeds.good_rows(feeds.parse_ecom(samples.lines(spark, samples.ECOM), NOW)),
        schemas.CRM.name: feeds.good_rows(feeds.parse_crm(samples.lines(spark, [
            "C1,,,a@b.c,,,,", "C2,,,a@b,,,,", "C3", "C4,,,x,,,,"]), NOW)),
        schemas.INVENTORY.name: feeds.good_rows(feeds.parse_inventory(samples.lines(spark, samples.INVENTORY + ["P1,S9,x,-4,1,"]), NOW)),
    }


def test_scorecard(spark):
    row = quality.dq_scorecard(tables(spark), "2025-03-11T08:59:30Z").first().asDict()
    assert len(row) == 17
    nonzero = {k: v for k, v in row.items() if v}
    assert nonzero == {
        "pos_negative_amount_count": 2, "pos_future_date_count": 2, "pos_duplicate_transaction_count": 1,
        "crm_invalid_email_count": 2, "inv_negative_quantity_count": 1,
    }


def test_quality_metrics(spark):
    rows = {r.table_name: r for r in monitoring.data_quality_metrics(tables(spark), NOW).collect()}
    pos = rows["raw_pos_transactions"]
    assert (pos.total_records, pos.unique_entities, pos.duplicate_entity_count, pos.negative_amounts) == (7, 6, 1, 2)
    assert rows["raw_inventory_snapshots"].unique_entities == 4 and rows["raw_crm_customers"].negative_amounts == 0
    later = monitoring.data_quality_metrics(tables(spark), "2026-01-01T00:00:00Z").collect()
    assert {r.total_records for r in later} == {0}


@pytest.mark.parametrize("value, two_sided, upper", [(89, False, True), (90, True, True), (110, True, True), (111, False, False), (0, False, True), (None, False, False)])
def test_value_check(spark, value, two_sided, upper):
    df = spark.createDataFrame([(value,)], "v bigint")
    assert monitoring.value_check(df, "v", 100, 0.1).first().passed is two_sided
    assert monitoring.value_check(df, "v", 100, 0.1, upper_bound_only=True).first().passed is upper


def test_freshness(spark):
    t = tables(spark)
    watched = {"pos": t[schemas.POS.name], "empty": t[schemas.ECOM.name].where("false")}
    def at(as_of):
        return {r.table_name: (r.minutes_since_last_ingestion, r.is_stale) for r in monitoring.freshness(watched, as_of).collect()}
    assert at("2025-03-11T13:15:59Z") == {"pos": (120, False), "empty": (None, False)}
    assert at("2025-03-11T13:16:00Z")["pos"] == (121, True)


def runs(spark):
    rows = [("a", "2025-03-11 11:00:00", "FAILED", 5, "e1"), ("a", "2025-03-11 10:30:00", "FAILED", 7, "e2"),
            ("b", "2025-03-11 11:00:00", "SUCCESS", 0, None), ("c", "2025-02-20 11:00:00", "FAILED", 1, "old")]
    df = spark.createDataFrame(rows, "pipeline_name string, t string, status string, records_failed bigint, error_message string")
    return df.select(
        "pipeline_name", F.to_date("t").alias("run_date"), F.col("t").cast("timestamp").alias("run_timestamp"), "status",
        F.lit(10).cast("bigint").alias("records_processed"), "records_failed",
        F.lit(3).cast("bigint").alias("execution_time_seconds"), "error_message", F.lit(None).cast("string").alias("metadata"))


def test_health(spark):
    r = runs(spark)
    week = {x.pipeline_name: x.failed_runs for x in monitoring.failed_runs_by_day(r, NOW).collect()}
    assert week == {"a": 2}
    hour = monitoring.failed_runs_recent(r, NOW).collect()
    assert [(x.pipeline_name, x.failed_runs, x.latest_error) for x in hour] == [("a", 2, "e2")]
    assert monitoring.recent_failures(r, NOW).first().total_failures == 12
    assert monitoring.recent_failures(r, "2026-01-01T00:00:00Z").first().total_failures is None
    summary = {x.pipeline_name: x for x in monitoring.execution_summary(r, NOW).collect()}
    assert (summary["a"].total_runs, summary["a"].failed_runs, summary["b"].successful_runs) == (2, 2, 1)
    report = monitoring.monitoring_report(r, tables(spark)[schemas.POS.name], NOW).first()
    assert report.metadata == '{"pipeline_failures":2,"stale_tables":0}'
    assert monitoring.monitoring_report(r, tables(spark)[schemas.POS.name], NOW).schema.names == schemas.PIPELINE_MONITORING.names


def test_recent_rows(spark):
    pos = tables(spark)[schemas.POS.name]
    assert monitoring.recent_rows(pos, "2025-03-11T12:00:00Z").first().recent_rows == 7
    assert monitoring.recent_rows(pos, "2025-03-11T12:30:00Z").first().recent_rows == 0
    live = monitoring.stream_liveness(pos, "2025-03-11T11:17:00Z").first()
    assert live.recent_transactions == 7 and live.latest_ingestion == datetime(2025, 3, 11, 11, 15)


def test_dead_letters_and_contract(spark):
    parsed = feeds.parse_pos(samples.lines(spark, ["{bad", "x", '{"transaction_id":"a"}'], "f1"), NOW)
    assert [tuple(r) for r in quality.dead_letter_summary(feeds.dead_letters(parsed)).collect()] == [("Missing transaction_id", "f1", 2)]
    broken = {r.column_name: r.violations for r in quality.contract_violations(parsed, schemas.RAW_POS).collect()}
    assert broken == {"transaction_id": 2, "ingestion_ts": 0}


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5)], "k string, v bigint")
    b = spark.createDataFrame([("x", 3), ("z", 4)], "k string, v bigint")
    got = {r.k: (r.source_v, r.target_v, r.v_difference) for r in quality.reconcile(a, b, ["k"], ["v"]).collect()}
    assert got == {"x": (3, 3, 0), "y": (5, 0, 5), "z": (0, 4, -4)}


def test_drift(spark):
    old = T.StructType.fromDDL("a string, b double, c int")
    new = T.StructType.fromDDL("a string, b string, d date")
    got = {tuple(r) for r in drift.schema_drift(spark, old, new).collect()}
    assert got == {("b", "type_changed", "double", "string"), ("c", "removed", "int", None), ("d", "added", None, "date")}
    assert drift.schema_drift(spark, old, old).count() == 0
    merged = drift.merge_schemas(old, T.StructType([T.StructField("d", T.DateType(), False), *new.fields[:1]]))
    assert merged.names == ["a", "b", "c", "d"] and merged["d"].nullable and merged["b"].dataType == T.DoubleType()


def test_handle_drift(spark):
    table = spark.createDataFrame([("1", 2.0)], "a string, b double")
    incoming = spark.createDataFrame([("3", "new")], "a string, d string")
    kept, updated = drift.handle_drift(table, incoming)
    assert not updated and kept.columns == ["a", "b"] and sorted(map(tuple, kept.collect())) == [("1", 2.0), ("3", None)]
    grown, updated = drift.handle_drift(table, incoming, auto_update=True)
    assert updated and grown.columns == ["a", "b", "d"]
    same, updated = drift.handle_drift(table, table, auto_update=True)
    assert not updated and same.count() == 2


def test_columns_are_never_retyped(spark):
    table = spark.createDataFrame([(1, 2.0)], "a int, b double")
    incoming = spark.createDataFrame([(5_000_000_000, "abc"), (7, "2.5"), (None, None)], "a bigint, b string")
    for auto in (False, True):
        rows, updated = drift.handle_drift(table, incoming, auto_update=auto)
        assert updated == auto and rows.schema == table.schema
        assert sorted(map(str, rows.collect())) == sorted(map(str, spark.createDataFrame(
            [(1, 2.0), (None, None), (7, 2.5), (None, None)], "a int, b double").collect()))
    lost = {r.column_name: r.misfits for r in drift.misfits(incoming, table.schema).collect()}
    assert lost == {"a": 1, "b": 1}
    listed = spark.createDataFrame([([1],)], "a array<int>")
    assert drift.conform(listed, table.schema).first().a is None and drift.misfits(listed, table.schema).first().misfits == 1
    assert drift.misfits(table, table.schema).count() == 0


def test_no_amount_stops_a_job(spark):
    values = ['{"transaction_id":"%s","store_id":"s","timestamp":"2025-03-11T09:00:00Z","amount":%s}' % x for x in
              (("a", "1e17"), ("b", "Infinity"), ("c", "NaN"), ("d", '"1e400"'), ("e", "2.5"))]
    rows = feeds.good_rows(feeds.parse_pos(samples.lines(spark, values), NOW))
    ecom = tables(spark)[schemas.ECOM.name].limit(0)
    got = {r.sale_id: r.amount for r in marts.sales_fact(rows, ecom).collect()}
    assert {k: v and float(v) for k, v in got.items()} == {"a": None, "b": None, "c": None, "d": None, "e": 2.5}
    count = quality.unfit_amounts({"pos": F.col("amount")}, {"pos": rows}).first()
    assert (count.amounts, count.unfit) == (5, 4)
    window = stream.windowed_sales(rows).first()
    assert (window.sales_count, float(window.total_amount), window.unfit_amounts) == (5, 2.5, 4)


def test_monitoring_of_an_earlier_time(spark):
    """An hour's figures do not change when later rows have come in."""
    early = feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_1), NOW))
    later = feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_2), "2025-03-11T13:00:00Z"))
    both = early.unionByName(later)
    for look in (monitoring.recent_rows, monitoring.recent_duplicates, monitoring.stream_liveness):
        assert look(both, NOW).collect() == look(early, NOW).collect()
    age = monitoring.freshness({"pos": both}, "2025-03-11T12:00:00Z").first()
    assert age.minutes_since_last_ingestion == 45
    assert monitoring.failed_runs_recent(runs(spark), "2025-03-11T10:45:00Z").first().failed_runs == 1


def test_feed_drift(spark):
    df = spark.createDataFrame([('{"a":"x","n":1,"extra":true}',), ('{"a":null,"n":2.5}',), ('{"a":"y","n":"bad"}',), ("{broken",)], "raw_payload string")
    declared = T.StructType.fromDDL("a string, n double, gone string")
    got = {tuple(r) for r in drift.feed_drift(df, declared).collect()}
    assert got == {("extra", "added", None, "boolean"), ("gone", "removed", "string", None), ("n", "type_changed", "double", "string")}


def test_normalize_crm(spark):
    df = spark.createDataFrame([("C1", "x", 5, None)], "customer_id string, email string, points int, note string")
    row = drift.normalize_crm(df).first()
    assert row.raw_extra_attributes == '{"points":5,"note":null}' and row.city is None
    plain = drift.normalize_crm(df.select("customer_id", "email")).first()
    assert plain.raw_extra_attributes is None


def sales(spark, rows):
    return spark.createDataFrame(
        [(*r[:4], date.fromisoformat(r[4]), r[5], datetime.fromisoformat(r[6])) for r in rows],
        "transaction_id string, customer_id string, product_id string, amount double, sale_date date, is_return boolean, ingestion_timestamp timestamp",
    ).withColumn("sale_amount", F.col("amount").cast("decimal(18,2)")).withColumn("quantity", F.lit(1).cast("bigint"))


def test_growth(spark):
    t = sales(spark, [("1", "c", "p", 0.0, "2024-01-05", False, "2024-01-05"), ("2", "c", "p", 10.0, "2024-02-05", False, "2024-02-05"),
                      ("3", "c", "p", 15.0, "2024-04-05", False, "2024-04-05"), ("4", "c", "p", 99.0, "2024-04-05", None, "2024-04-05"),
                      ("5", "c", "p", 99.0, "2024-04-05", True, "2024-04-05"), ("6", "c", "p", 99.0, "2023-04-05", False, "2023-04-05")])
    got = [(str(r.month), r.mom_pct_growth) for r in analytics.monthly_growth(t, 2024).collect()]
    assert got == [("2024-01-01", 0.0), ("2024-02-01", None), ("2024-04-01", 50.0)]


def test_lifetime_value(spark):
    t = sales(spark, [("1", "a", "p", 10.0, "2024-01-05", False, "2024-01-05"), ("1", "a", "p", 20.0, "2024-01-05", False, "2024-01-06"),
                      ("2", "a", "p", 5.0, "2024-01-06", None, "2024-01-06"), ("3", "b", "p", 7.0, "2024-01-06", True, "2024-01-06"),
                      ("4", "c", "p", 7.0, "2023-12-31", False, "2024-01-06")])
    profiles = spark.createDataFrame([(c, "NO", date(2024, 1, 1)) for c in "abc"] + [("d", "SE", None)], "customer_id string, country string, registration_date date")
    got = {r.customer_id: float(r.clv_amount) for r in analytics.customer_lifetime_value(profiles, analytics.latest_transactions(t)).collect()}
    assert got == {"a": 25.0, "b": -7.0, "c": 0.0, "d": 0.0}


def test_marts(spark):
    t = tables(spark)
    facts = marts.sales_fact(t[schemas.POS.name], t[schemas.ECOM.name])
    assert facts.count() == 10 and float(facts.agg(F.sum("amount")).first()[0]) == 151.75
    stores = {r.store_id: (r.sells_pos, r.sells_online, r.holds_inventory) for r in marts.store_dim(facts, t[schemas.INVENTORY.name]).collect()}
    assert stores["PIER"] == (True, False, True) and stores["WEB"] == (False, True, False) and "" not in stores
    kpi = {r.store_id: r.out_of_stock for r in marts.inventory_kpi(marts.inventory_snapshot_fact(t[schemas.INVENTORY.name])).collect()}
    assert kpi == {"PIER": 1, "DOCK": 0, "S9": 1}
    assert marts.date_dim(facts, "sale_date").count() == 2


def test_key_sketches_merge_and_stay_within_their_error(spark):
    """Sketches of loads and hours give the same estimate as one over all rows, within 3 % of the truth."""
    from retailmill.operators import monitoring

    rows = spark.range(0, 60_000).selectExpr(
        "concat('k', id % 40000) AS transaction_id", "timestamp'2025-03-11 00:00:00' + make_interval(0, 0, 0, 0, id % 24) AS ingestion_ts"
    )
    parts = [monitoring.key_sketches(rows.where(f"hash(transaction_id) % 3 = {k}"), "transaction_id") for k in (-2, -1, 0, 1, 2)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    at, whole = "2025-03-11T23:30:00Z", monitoring.key_sketches(rows, "transaction_id")
    day, same = (monitoring.estimated_duplicates(df, at, 24).first() for df in (merged, whole))
    assert day == same and day.row_count == 60_000 and abs(day.duplicate_count - 20_000) < 0.03 * 40_000
    hour = monitoring.estimated_duplicates(merged, at, 1).first()
    assert hour.row_count == 2_500 and hour.duplicate_count < 0.03 * 2_500
    assert tuple(monitoring.estimated_duplicates(merged, "2024-01-01T00:00:00Z", 5).first()) == (0, 0)
