from datetime import datetime

from pyspark.sql import functions as F

from retailmill.sources import feeds, landing
from retailmill.streaming import pos as stream
import samples

NOW = "2025-03-11T11:15:00Z"


def message(key, time, store="S1", amount=1.0):
    return '{"transaction_id":"%s","store_id":"%s","amount":%s,"timestamp":"%s"}' % (key, store, amount, time)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landed, out = tmp_path / "in", str(tmp_path / "out")
    samples.write_lines(landed / "1.json", samples.POS_DAY_1 + ["{bad", '{"amount":1}'])
    run = lambda: stream.finish(stream.start_bronze(
        landing.stream_text_lines(spark, str(landed)), f"{out}/rows", f"{out}/dead", f"{out}/ckpt", NOW
    ))
    run()
    samples.write_lines(landed / "2.json", samples.POS_DAY_2)
    run()
    run()  # nothing new
    batch = feeds.parse_pos(landing.read_json_lines(spark, f"{landed}/*.json"), NOW)
    columns = ["transaction_id", "store_id", "amount", "event_ts", "record_hash", "raw_payload", "source_file"]
    got = sorted(map(str, spark.read.parquet(f"{out}/rows").select(*columns).collect()))
    assert got == sorted(map(str, feeds.good_rows(batch).select(*columns).collect()))
    dead = spark.read.parquet(f"{out}/dead")
    assert sorted(r.line for r in dead.collect()) == sorted(["{bad", '{"amount":1}'])
    # day partitions, and a date filter prunes
    day = stream.read_bronze(spark, f"{out}/rows").where("event_date = DATE'2025-03-10'")
    assert [r.transaction_id for r in day.collect()] == ["K-105"]
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()


def test_a_replayed_batch_is_stored_once(spark, tmp_path):
    """The commit of the last batch is lost, so it runs again; the sink's log knows it."""
    landed, out = tmp_path / "in", tmp_path / "out"
    for k, values in enumerate((samples.POS_DAY_1, samples.POS_DAY_2)):
        samples.write_lines(landed / f"{k}.json", values)
        messages = landing.stream_text_lines(spark, str(landed))
        stream.finish(stream.start_bronze(messages, f"{out}/rows", f"{out}/dead", f"{out}/ckpt"))
    before = sorted(map(str, stream.read_bronze(spark, f"{out}/rows").collect()))
    for commit in (out / "ckpt" / "rows" / "commits").glob("*1*"):
        commit.unlink()
    messages = landing.stream_text_lines(spark, str(landed))
    stream.finish(stream.start_bronze(messages, f"{out}/rows", f"{out}/dead", f"{out}/ckpt"))
    assert sorted(map(str, stream.read_bronze(spark, f"{out}/rows").collect())) == before and len(before) == 7


def test_windows_refine_and_drop_what_is_too_late(spark, tmp_path):
    landed, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        rows = feeds.good_rows(stream.parse_messages(landing.stream_text_lines(spark, str(landed)), NOW))
        stream.finish(stream.start_windowed_sales(stream.windowed_sales(rows), f"{out}/w", f"{out}/ckpt"))

    def state():
        return {
            (r.window_start, r.store_id): (r.sales_count, float(r.total_amount))
            for r in stream.read_windowed_sales(spark, f"{out}/w").collect()
        }

    samples.write_lines(landed / "1.json", [message("a", "2025-03-11T10:00:10Z"), message("b", "2025-03-11T10:00:50Z", amount=2.5), message("c", "2025-03-11T10:01:00Z")])
    run()
    first, second = datetime(2025, 3, 11, 10, 0), datetime(2025, 3, 11, 10, 1)
    assert state() == {(first, "S1"): (2, 3.5), (second, "S1"): (1, 1.0)}
    # within the allowed lateness: the window is emitted again with the new total
    samples.write_lines(landed / "2.json", [message("d", "2025-03-11T10:00:20Z", amount=4.0), message("e", "2025-03-11T12:00:00Z")])
    run()
    assert state()[(first, "S1")] == (3, 7.5)
    # the watermark is now past 11:00, so 10:00 is closed
    samples.write_lines(landed / "3.json", [message("f", "2025-03-11T10:00:30Z", amount=9.0), message("g", "2025-03-11T11:30:00Z")])
    run()
    assert state()[(first, "S1")] == (3, 7.5) and state()[(datetime(2025, 3, 11, 11, 30), "S1")] == (1, 1.0)
    # final windows were stored once, and the state of open ones holds none that is long final
    closed = spark.read.parquet(f"{out}/w/closed")
    assert sorted(r.window_start for r in closed.collect()) == [first, second]
    samples.write_lines(landed / "4.json", [message("h", "2025-03-11T18:00:00Z")])
    run()
    assert len(state()) == 5 and len(list((tmp_path / "out" / "w" / "open").glob("batch=*"))) <= 2
    newest = max((tmp_path / "out" / "w" / "open").glob("batch=*"), key=lambda p: int(p.name[6:]))
    assert spark.read.parquet(str(newest)).count() == 1
    plan = stream.read_windowed_sales(spark, f"{out}/w")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.replace("window_", "")


def test_event_time_fallbacks(spark):
    df = spark.createDataFrame(
        [("2025-01-01 00:00:00", "2025-01-02 00:00:00"), (None, "2025-01-02 00:00:00"), (None, None)], "e string, i string"
    ).select(F.col("e").cast("timestamp").alias("event_ts"), F.col("i").cast("timestamp").alias("ingestion_ts"))
    got = [r.event_time.day for r in stream.with_event_time(df, "2025-01-03T00:00:00Z").collect()]
    assert got == [1, 2, 3]


def test_stream_dedup(spark, tmp_path):
    landed, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        rows = feeds.good_rows(stream.parse_messages(landing.stream_text_lines(spark, str(landed)), NOW))
        stream.start_append(stream.dedup_stream(rows), f"{out}/rows", f"{out}/ckpt").awaitTermination()

    samples.write_lines(landed / "1.json", [message("a", "2025-03-11T10:00:00Z"), message("a", "2025-03-11T10:00:00Z"), message("b", "2025-03-11T10:00:00Z")])
    run()
    samples.write_lines(landed / "2.json", [message("a", "2025-03-11T10:00:00Z"), message("a", "2025-03-11T10:05:00Z")])
    run()
    got = sorted((r.transaction_id, r.event_ts.minute) for r in spark.read.parquet(f"{out}/rows").collect())
    assert got == [("a", 0), ("a", 5), ("b", 0)]


def test_stream_dedup_of_a_hot_key(spark, tmp_path):
    """One transaction makes up half of a batch of many files: it is thinned out where it is read."""
    landed, out = tmp_path / "in", str(tmp_path / "out")
    for k in range(8):
        hot = [message("hot", "2025-03-11T10:00:00Z")] * 200
        samples.write_lines(landed / f"{k}.json", hot + [message(f"t{k}-{i}", "2025-03-11T10:00:00Z") for i in range(200)])
    rows = feeds.good_rows(stream.parse_messages(landing.stream_text_lines(spark, str(landed)), NOW))
    query = stream.start_append(stream.dedup_stream(rows), f"{out}/rows", f"{out}/ckpt")
    query.awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 1601
    first, second = sorted(query.lastProgress["stateOperators"], key=lambda o: -o["numRowsTotal"])
    assert second["numRowsTotal"] == 1601 <= first["numRowsTotal"] <= 1600 + stream.SALTS
