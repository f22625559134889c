from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.operators import scd2
from retailmill.plans import marts, procedures
from retailmill.sources import feeds, landing, storage
from retailmill.streaming import pos as stream
import samples

NOW = "2025-03-11T11:15:00Z"


def pos(spark):
    return feeds.good_rows(feeds.parse_pos(samples.lines(spark, samples.POS_DAY_1 + samples.POS_DAY_2), NOW))


def test_layout_and_append(spark, tmp_path):
    path = str(tmp_path / "pos")
    storage.write_table(pos(spark), path, schemas.POS)
    storage.write_table(pos(spark), path, schemas.POS)
    assert sorted(p.name for p in Path(path).glob("event_date=*")) == ["event_date=2025-03-10", "event_date=2025-03-11"]
    table = storage.read_table(spark, path, schemas.POS)
    assert table.count() == 14 and table.columns == schemas.RAW_POS.names
    plan = table.where("event_date = DATE'2025-03-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_overwrite_replaces_only_the_days_written(spark, tmp_path):
    path = str(tmp_path / "pos")
    storage.write_table(pos(spark), path, schemas.POS)
    one_day = pos(spark).where("event_date = DATE'2025-03-10'").withColumn("currency", F.lit("NOK"))
    storage.write_table(one_day, path, schemas.POS, mode="overwrite")
    got = {(str(r.event_date), r.currency): r["count"] for r in storage.read_table(spark, path, schemas.POS).groupBy("event_date", "currency").count().collect()}
    assert got == {("2025-03-10", "NOK"): 1, ("2025-03-11", "EUR"): 6}


def test_a_day_with_most_rows_is_split(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") < 30_000, F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("date").alias("d"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"), "id",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        storage.clustered(rows, "d", ["id"]).write.partitionBy("d").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "d=2025-01-01").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_replace_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "pos")
    storage.write_table(pos(spark), path, schemas.POS)
    storage.write_table(pos(spark).where("event_date = DATE'2025-03-10'"), path, schemas.POS, mode="replace")
    assert storage.read_table(spark, path, schemas.POS).count() == 1


def test_history_lookback_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "crm")
    rows = feeds.good_rows(feeds.parse_crm(samples.lines(spark, samples.CRM_DAY_1 + samples.CRM_DAY_2), NOW))
    storage.write_table(rows, path, schemas.CRM)
    recent = scd2.source_snapshot(storage.read_table(spark, path, schemas.CRM), "2025-06-09T20:00:00Z")
    assert {r.customer_id for r in recent.collect()} == {"M-1", "M-3", "M-5"}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "updated_date" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_retention_and_archive(spark, tmp_path):
    df = pos(spark)
    assert storage.retained(df, schemas.POS, "2026-03-11T00:00:00Z").count() == 6
    assert storage.expired(df, schemas.POS, "2026-03-11T00:00:00Z").count() == 1
    undated = df.withColumn("event_date", F.lit(None).cast("date"))
    assert storage.retained(undated, schemas.POS, "2030-01-01T00:00:00Z").count() == 7
    for _ in range(2):
        storage.archive(df, str(tmp_path / "a"), schemas.POS, "2026-03-11T00:00:00Z")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1


def test_compaction(spark, tmp_path):
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    for _ in range(4):
        storage.write_table(pos(spark), path, schemas.POS)
    storage.compact(spark, path, target, schemas.POS)
    files = lambda p: len(list(Path(p).rglob("*.parquet")))
    assert files(target) == 2 < files(path)
    assert storage.read_table(spark, target, schemas.POS).count() == 28
    with pytest.raises(ValueError):
        storage.compact(spark, path, path + "/", schemas.POS)


def test_materialized_mart_refreshes_months(spark, tmp_path):
    ecom = feeds.good_rows(feeds.parse_ecom(samples.lines(spark, samples.ECOM), NOW))
    for _ in range(2):
        marts.materialize_daily_store_sales(marts.sales_fact(pos(spark), ecom), str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    assert stored.agg(F.sum("transaction_count")).first()[0] == 10


def land(root, day, values):
    names = {"pos": None, "ecom": None, "crm": None, "inv": None}
    for name in names:
        suffix, header, lines_ = values[name]
        samples.write_lines(root / day / f"{name}.{suffix}", lines_, header)
    return {
        schemas.POS.name: f"{root}/{day}/pos.json", schemas.ECOM.name: f"{root}/{day}/ecom.json",
        schemas.CRM.name: f"{root}/{day}/crm.csv", schemas.INVENTORY.name: f"{root}/{day}/inv.csv",
    }


def test_daily_chain(spark, tmp_path):
    day_1 = land(tmp_path, "d1", {
        "pos": ("json", None, samples.POS_DAY_1 + ["{bad"]), "ecom": ("json", None, samples.ECOM),
        "crm": ("csv", samples.CRM_8_HEADER, samples.CRM_DAY_1), "inv": ("csv", samples.INVENTORY_HEADER, samples.INVENTORY + ["P9"])})
    day_2 = land(tmp_path, "d2", {
        "pos": ("json", None, samples.POS_DAY_2), "ecom": ("json", None, samples.ECOM),
        "crm": ("csv", samples.CRM_9_HEADER, samples.CRM_DAY_2), "inv": ("csv", samples.INVENTORY_HEADER, samples.INVENTORY)})
    root, run_1, run_2 = str(tmp_path / "wh"), "2025-03-11T12:00:00Z", "2025-03-12T12:00:00Z"

    out = procedures.run_daily(spark, root, day_1, run_1)
    assert out["customer_dim_scd2"].count() == 4
    batch = {r.pipeline_name: (r.records_processed, r.records_failed) for r in out["pipeline_monitoring"].collect()}
    assert batch["raw_pos_transactions_batch"] == (4, 1) and batch["raw_inventory_snapshots_batch"] == (3, 1)

    for _ in range(2):  # the repeat changes nothing
        out = procedures.run_daily(spark, root, day_2, run_2, previous=run_1)
        dim = out["customer_dim_scd2"].collect()
        assert (len(dim), sum(r.is_current for r in dim)) == (7, 5)
        assert out[schemas.POS.name].count() == 6
        assert out[schemas.ECOM.name].count() == 3
        scores = out["dq_scorecard"].first()
        assert (scores.pos_duplicate_transaction_count, scores.pos_negative_amount_count) == (0, 1)
        keys = {(r.table_name, r.record_key) for r in out["late_arriving_data"].collect()}
        assert ("raw_pos_transactions", "K-101") in keys and ("raw_ecom_orders", "W-1") in keys
        assert out["late_arriving_data"].where("not processed").count() == 0
        mart = out["daily_store_sales"].agg(F.sum("transaction_count"), F.sum("total_amount")).first()
        assert (mart[0], float(mart[1])) == (9, 153.5)
        assert out["pipeline_monitoring"].count() == 12 and out["failed_runs"].count() == 0
    log = spark.read.parquet(f"{root}/log/deduplication_log")
    counts = {r.record_key: r["count"] for r in log.where("run = '20250312T120000'").collect()}
    assert counts == {"K-103|2025-03-11 08:20:30+00": 1, "W-1": 1, "W-2": 1, "W-3": 1}
    dead = spark.read.parquet(f"{root}/dead_letter/raw_pos_transactions")
    assert [r.line for r in dead.collect()] == ["{bad"]


def order(key, time, total=1.0):
    return '{"order_id":"%s","total_amount":%s,"timestamp":"%s"}' % (key, total, time)


def order_run(spark, warehouse):
    """Loads orders and deduplicates them: the table's rows and the run's log."""
    spec = schemas.ECOM

    def run(as_of, values):
        load = feeds.good_rows(feeds.parse_ecom(samples.lines(spark, values), as_of))
        storage.write_table(load, warehouse.load(spec.name, as_of), spec, mode="replace")
        table = procedures.run_dedup(spark, warehouse, spec, as_of)
        log = spark.read.parquet(warehouse.log("deduplication_log", as_of, spec.name))
        return (
            sorted((r.order_id, str(r.order_date), r.total_amount) for r in table.collect()),
            {r.record_key: r["count"] for r in log.collect()},
        )

    return run


FIRST, SECOND, THIRD = "2025-01-05T00:00:00Z", "2025-01-06T00:00:00Z", "2025-01-07T00:00:00Z"


def test_dedup_redoes_only_touched_days(spark, tmp_path):
    warehouse = procedures.Warehouse(str(tmp_path / "wh"))
    run, path = order_run(spark, warehouse), Path(warehouse.table(schemas.ECOM.name))
    rows, log = run(FIRST, [order("a", "2025-01-01T00:00:00Z"), order("b", "2025-01-02T00:00:00Z"), order("c", "2025-01-03T00:00:00Z"), order("u", "never")])
    assert len(rows) == 4 and log == {}
    untouched = {p for p in path.rglob("*.parquet") if "-01-01" in str(p) or "-01-03" in str(p)}
    # b moves to another day: its old day is left without rows
    for _ in range(2):
        rows, log = run(SECOND, [order("b", "2025-01-04T00:00:00Z", 2.0), order("u", "never", 3.0)])
        assert rows == [("a", "2025-01-01", 1.0), ("b", "2025-01-04", 2.0), ("c", "2025-01-03", 1.0), ("u", "None", 3.0)]
        assert log == {"b": 1, "u": 1}
    assert untouched <= set(path.rglob("*.parquet")) and not (path / "order_date=2025-01-02").exists()
    rows, log = run(THIRD, [order("c", "2025-01-03T00:00:00Z", 5.0)])
    assert ("c", "2025-01-03", 5.0) in rows and len(rows) == 4 and log == {"c": 1}


def test_days_are_replaced_in_one_write(spark, tmp_path):
    """Rows read from the table itself, a day left empty, a day not listed, rows without a day."""
    warehouse, spec = procedures.Warehouse(str(tmp_path / "wh")), schemas.ECOM
    run, path = order_run(spark, warehouse), warehouse.table(spec.name)
    run(FIRST, [order("a", "2025-01-01T00:00:00Z"), order("b", "2025-01-02T00:00:00Z"), order("c", "2025-01-03T00:00:00Z"), order("u", "never")])
    assert not list(Path(warehouse.root).rglob("*_staged*"))
    days = [date(2025, 1, 1), date(2025, 1, 2), date(2025, 2, 1), None]
    for _ in range(2):
        stored = storage.read_table(spark, path, spec)
        storage.replace_days(storage.on_days(stored, spec, days).where("order_id != 'b'"), days, path, spec, None)
        kept = storage.read_table(spark, path, spec)
        assert sorted(r.order_id for r in kept.collect()) == ["a", "c", "u"]
    assert not (Path(path) / "order_date=2025-01-02").exists()


def test_a_repeat_with_other_input_gives_what_the_first_would_have(spark, tmp_path):
    run = order_run(spark, procedures.Warehouse(str(tmp_path / "wh")))
    days = lambda got: [(k, d) for k, d, _ in got[0]]
    assert days(run(FIRST, [order("b", "2025-01-01T00:00:00Z"), order("c", "2025-01-09T00:00:00Z")])) == [("b", "2025-01-01"), ("c", "2025-01-09")]
    assert days(run(SECOND, [order("b", "2025-01-02T00:00:00Z")])) == [("b", "2025-01-02"), ("c", "2025-01-09")]
    assert days(run(SECOND, [order("b", "2025-01-03T00:00:00Z")])) == [("b", "2025-01-03"), ("c", "2025-01-09")]
    # without b, the first load's copy is back
    rows, log = run(SECOND, [order("d", "2025-01-03T00:00:00Z")])
    assert [(k, d) for k, d, _ in rows] == [("b", "2025-01-01"), ("c", "2025-01-09"), ("d", "2025-01-03")] and log == {}
    assert days(run(FIRST, [order("e", "2025-01-01T00:00:00Z")])) == [("d", "2025-01-03"), ("e", "2025-01-01")]


def test_a_run_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    """Lost between taking the old days away and putting the new ones in place."""
    warehouse = procedures.Warehouse(str(tmp_path / "wh"))
    run = order_run(spark, warehouse)
    run(FIRST, [order("b", "2025-01-01T00:00:00Z"), order("c", "2025-01-01T00:00:00Z")])
    whole = storage.replace_days

    def breaks_off(df, days, path, spec, staged):
        storage.drop_partitions(spark, path, [(spec.partition_column, d) for d in days])
        raise RuntimeError

    monkeypatch.setattr(storage, "replace_days", breaks_off)
    with pytest.raises(RuntimeError):
        run(SECOND, [order("b", "2025-01-02T00:00:00Z")])
    monkeypatch.setattr(storage, "replace_days", whole)
    rows, log = run(SECOND, [order("b", "2025-01-02T00:00:00Z")])
    assert [(k, d) for k, d, _ in rows] == [("b", "2025-01-02"), ("c", "2025-01-01")] and log == {"b": 1}


def test_order_ids_of_candidate_days_only_are_read(spark, tmp_path):
    warehouse, spec = procedures.Warehouse(str(tmp_path / "wh")), schemas.ECOM
    run = order_run(spark, warehouse)
    run(FIRST, [order(f"o{d}{k}", f"2025-01-{d:02d}T00:00:00Z") for d in range(1, 10) for k in range(3)])
    incoming = feeds.good_rows(feeds.parse_ecom(samples.lines(spark, [order("o41", "2025-02-01T00:00:00Z")]), SECOND))
    keys = warehouse.key_days(spec.name)
    assert [str(d) for d in storage.day_list(procedures.days_of_keys(spark, incoming, keys, spec))] == ["2025-01-04"]
    plan = procedures.days_of_keys(spark, incoming, keys, spec)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "ReadSchema: struct<key_hash:bigint,day:date>" in plan
    stored = storage.on_days(storage.read_table(spark, warehouse.table(spec.name), spec), spec, storage.day_list(procedures.days_of_keys(spark, incoming, keys, spec)))
    assert len(stored.inputFiles()) == 9 and stored.count() == 3
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-01-04" in plan or "20092" in plan
    for k in range(10):  # an entry for every run; compaction leaves one for each key and day
        procedures.note_key_days(incoming, keys, spec)
    before = procedures.read_key_days(spark, keys).count()
    assert procedures.compact_key_days(spark, keys, str(tmp_path / "staged"), spare_files=4) == 1
    assert before - procedures.read_key_days(spark, keys).count() == 9


def test_late_data_accumulates_and_repeats(spark, tmp_path):
    warehouse, as_of = procedures.Warehouse(str(tmp_path / "wh")), "2025-03-11T12:00:00Z"

    def run(values):
        rows = {schemas.POS.name: feeds.good_rows(feeds.parse_pos(samples.lines(spark, values), as_of))}
        return sorted(r.record_key for r in procedures.run_late(spark, warehouse, rows, as_of)[0].collect())

    for _ in range(2):
        assert run(samples.POS_DAY_1) == ["K-101", "K-102", "K-103", "K-104"]
    assert run(samples.POS_DAY_2) == ["K-101", "K-102", "K-103", "K-104", "K-105", "K-106"]


def test_sales_look_for_copies_on_days_nearby(spark):
    from datetime import date

    near = procedures._days_nearby([date(2025, 3, 11), None])
    assert [str(d) for d in near] == ["None", "2025-03-09", "2025-03-10", "2025-03-11", "2025-03-12", "2025-03-13"]


def test_maintenance(spark, tmp_path):
    warehouse, spec, loaded, now = procedures.Warehouse(str(tmp_path / "wh")), schemas.POS, "2025-03-11T12:00:00Z", "2026-03-11T00:00:00Z"
    storage.write_table(pos(spark), warehouse.load(spec.name, loaded), spec, mode="replace")
    samples.write_lines(tmp_path / "in" / "a.json", samples.POS_DAY_2)
    messages = landing.stream_text_lines(spark, str(tmp_path / "in"))
    stream.finish(stream.start_bronze(messages, warehouse.stream(spec.name), f"{tmp_path}/dead", f"{tmp_path}/ckpt", loaded))
    procedures.run_dedup(spark, warehouse, spec, loaded, streamed_since=procedures.FIRST)
    for k in range(6):  # small files on the day that is kept
        more = pos(spark).where("event_date = DATE'2025-03-11'").withColumn("transaction_id", F.lit(f"more{k}")).limit(1)
        storage.write_table(more, warehouse.table(spec.name), spec)
    done = procedures.run_maintenance(spark, warehouse, spec, now)
    assert {(r.action, str(r.partition_date), r.amount) for r in done.collect()} == {
        ("archived", "2025-03-10", 1), ("raw_dropped", "2025-03-10", 1), ("stream_dropped", "2025-03-10", 1), ("compacted", "2025-03-11", 7),
    }
    for path in (warehouse.table(spec.name), warehouse.bronze(spec.name), warehouse.stream(spec.name)):
        assert {str(r.event_date) for r in storage.read_table(spark, path, spec).collect()} == {"2025-03-11"}
    assert storage.read_table(spark, warehouse.table(spec.name), spec).count() == 11
    assert len(list(Path(warehouse.table(spec.name)).rglob("*.parquet"))) == 1
    assert spark.read.parquet(warehouse.archive(spec.name)).count() == 1
    again = procedures.run_maintenance(spark, warehouse, spec, "2026-03-11T01:00:00Z")
    assert again.count() == 0
    # stock has no deduplicated table: its raw loads are archived
    stock = feeds.good_rows(feeds.parse_inventory(samples.lines(spark, samples.INVENTORY), loaded))
    storage.write_table(stock, warehouse.load(schemas.INVENTORY.name, loaded), schemas.INVENTORY, mode="replace")
    gone = procedures.run_maintenance(spark, warehouse, schemas.INVENTORY, "2027-01-01T00:00:00Z")
    assert [(r.action, r.amount) for r in gone.collect()] == [("archived", 3)]
    assert storage.read_table(spark, warehouse.bronze(schemas.INVENTORY.name), schemas.INVENTORY).count() == 0
    assert spark.read.parquet(warehouse.archive(schemas.INVENTORY.name)).count() == 3


def test_compaction_leaves_days_of_few_files_alone(spark, tmp_path):
    path, spec = str(tmp_path / "t"), schemas.POS
    storage.write_table(pos(spark), path, spec)
    for _ in range(5):
        storage.write_table(pos(spark).where("event_date = DATE'2025-03-11'"), path, spec)
    alone = set(Path(path).rglob("event_date=2025-03-10/*.parquet"))
    planned = storage.compact_days(spark, path, spec, str(tmp_path / "staged"))
    assert [(str(r.day), r.file_count) for r in planned.collect()] == [("2025-03-11", 6)]
    assert set(Path(path).rglob("event_date=2025-03-10/*.parquet")) == alone
    assert {(str(r.day), r.file_count) for r in storage.file_sizes(spark, path, spec).collect()} == {("2025-03-10", 1), ("2025-03-11", 1)}
    assert storage.read_table(spark, path, spec).count() == 37


def test_command_line(spark, tmp_path):
    from retailmill import jobs

    samples.write_lines(tmp_path / "in" / "a.json", samples.POS_DAY_1 + ["{bad"])
    out = tmp_path / "out"
    jobs.main(["--as_of", NOW, "batch", "--feed", "raw_pos_transactions", "--input_pattern", f"{tmp_path}/in/*.json",
               "--output_table", f"{out}/pos", "--dead_letter_table", f"{out}/dead"])
    assert storage.read_table(spark, f"{out}/pos", schemas.POS).count() == 4
    jobs.main(["stream-pos", "--input_directory", f"{tmp_path}/in", "--output_table", f"{out}/s", "--dead_letter_table",
               f"{out}/sd", "--windows_table", f"{out}/w", "--checkpoint", f"{out}/c", "--once"])
    assert spark.read.parquet(f"{out}/s").count() == 4 and spark.read.parquet(f"{out}/sd").count() == 1
    assert stream.read_windowed_sales(spark, f"{out}/w").agg(F.sum("sales_count")).first()[0] == 4


def test_command_line_runs_of_a_warehouse(spark, tmp_path):
    """The stream, the daily chain, an hour of orders, monitoring and maintenance, from the shell."""
    from retailmill import jobs

    root = str(tmp_path / "wh")
    inputs = land(tmp_path, "d1", {
        "pos": ("json", None, samples.POS_DAY_1), "ecom": ("json", None, samples.ECOM),
        "crm": ("csv", samples.CRM_8_HEADER, samples.CRM_DAY_1), "inv": ("csv", samples.INVENTORY_HEADER, samples.INVENTORY)})
    samples.write_lines(tmp_path / "messages" / "a.json", samples.POS_DAY_2)
    jobs.main(["--as_of", NOW, "stream-pos", "--input_directory", f"{tmp_path}/messages", "--root", root, "--once"])
    daily = [f"--input={name}={path}" for name, path in inputs.items()]
    jobs.main(["--as_of", "2025-03-11T12:00:00Z", "daily", "--root", root, *daily])
    sales = storage.read_table(spark, f"{root}/silver/raw_pos_transactions", schemas.POS)
    assert {r.transaction_id for r in sales.collect()} == {f"K-10{k}" for k in range(1, 7)}
    mart = storage.read_table(spark, f"{root}/gold/daily_store_sales", schemas.DAILY_SALES)
    assert mart.agg(F.sum("transaction_count")).first()[0] == 9
    samples.write_lines(tmp_path / "shop/hourly/2025-03-11/13/x.json", [order("W-9", "2025-03-11T12:30:00Z")])
    jobs.main(["--as_of", "2025-03-11T13:00:00Z", "hourly-ecom", "--root", root, "--prefix", f"{tmp_path}/shop"])
    assert storage.read_table(spark, f"{root}/silver/raw_ecom_orders", schemas.ECOM).count() == 4
    jobs.main(["--as_of", "2025-03-11T14:00:00Z", "monitoring", "--root", root])
    jobs.main(["--as_of", "2026-03-12T00:00:00Z", "maintenance", "--root", root])
    assert storage.read_table(spark, f"{root}/silver/raw_pos_transactions", schemas.POS).count() == 0
    names = {r.pipeline_name for r in spark.read.parquet(f"{root}/log/pipeline_monitoring").collect()}
    assert {"hourly_ecommerce", "monitoring_report", "raw_pos_transactions_batch"} <= names
