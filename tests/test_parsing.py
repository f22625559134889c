import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import iso_text, warehouse_text
from retailmill.functions.parsing import (
    csv_width, iso_canonical, iso_local_date, iso_timestamp, parse_csv, safe_float, safe_int, split_csv,
)
from retailmill.operators import drift
from retailmill.sources import feeds, landing
import samples

NOW = "2025-03-11T11:15:00+00:00"


def pos(spark, values):
    return feeds.parse_pos(samples.lines(spark, values), NOW)


def test_pos_sample(spark):
    parsed = pos(spark, samples.POS_DAY_1 + samples.POS_DAY_2)
    rows = feeds.good_rows(parsed).collect()
    assert len(rows) == 7 and feeds.dead_letters(parsed).count() == 0
    assert {r.dq_status for r in rows} == {"VALID"}
    odd = next(r for r in rows if r.transaction_id == "K-106")
    assert (odd.amount, odd.store_id, odd.customer_id) == (None, "", None)
    assert odd.raw_payload == samples.POS_DAY_2[2]
    assert feeds.good_rows(parsed).columns == [f.name for f in schemas.RAW_POS.fields]


@pytest.mark.parametrize(
    "line",
    ["{bad", "", "   ", "5", '"text"', "[1]", '[{"transaction_id":"a"}]', "null", "{'transaction_id':'a'}",
     '{"transaction_id":"a"} xyz', '{"transaction_id":"a",}', '{"transaction_id":"a"} {"transaction_id":"b"}',
     '{"transaction_id":"a"}{"transaction_id":"b"}', '{"transaction_id":"a"},{"transaction_id":"b"}',
     '{"transaction_id":"a"}]{}', '{"transaction_id":"a"}],[{}', '{"transaction_id":"a"},"y":{}',
     '{"transaction_id":"a"},"_end":1}{"_line":{}', '{"transaction_id":"a"}],{"x":{}', '{"transaction_id":"a","x":{}'],
)
def test_no_json_object_is_rejected(spark, line):
    parsed = pos(spark, [line])
    row = parsed.first()
    assert (row.dq_status, row.dq_errors) == ("INVALID", "JSON_PARSE_ERROR")
    dead = feeds.dead_letters(parsed).collect()
    assert [tuple(r) for r in dead] == [(line, "Missing transaction_id", "memory")]
    assert feeds.good_rows(parsed).count() == 0


def test_missing_or_null_id_is_rejected_but_empty_passes(spark):
    values = ['{"amount":1}', '{"transaction_id":null}', '{"transaction_id":""}', '{"transaction_id":7}']
    parsed = pos(spark, values)
    assert sorted(r.line for r in feeds.dead_letters(parsed).collect()) == sorted(values[:2])
    assert sorted(r.transaction_id for r in feeds.good_rows(parsed).collect()) == ["", "7"]


@pytest.mark.parametrize(
    "amount, expected",
    [('" 1.5 "', 1.5), ('""', None), ("true", 1.0), ("false", 0.0), ('"true"', None), ("null", None),
     ("10.00", 10.0), ("1e3", 1000.0), ('"1_000"', 1000.0), ('"1d"', None), ("[1]", None), ('{"a":1}', None),
     ('"inf"', float("inf")), ("Infinity", float("inf")), ("-Infinity", float("-inf")), ("1e17", 1e17), ('"NaN"', "nan"),
     ("NaN", "nan")],
)
def test_amount(spark, amount, expected):
    row = pos(spark, ['{"transaction_id":"a","amount":%s}' % amount]).first()
    assert (row.amount != row.amount if expected == "nan" else row.amount == expected) and row.dq_status == "VALID"


@pytest.mark.parametrize("more", ['{"b":[1,{"c":"}]"}]}', '[{},[{}]]', '"}{"', '"\\"}]{"'])
def test_braces_within_one_object_pass(spark, more):
    row = pos(spark, ['{"transaction_id":"a","more":%s}' % more]).first()
    assert (row.transaction_id, row.dq_status) == ("a", "VALID")


def test_absent_amount_and_time(spark):
    row = pos(spark, ['{"transaction_id":"a"}']).first()
    assert (row.amount, row.event_ts, row.event_date, row._error) == (None, None, None, None)


@pytest.mark.parametrize(
    "text, utc, day",
    [
        ("2025-03-11T09:12:34Z", datetime(2025, 3, 11, 9, 12, 34), date(2025, 3, 11)),
        ("2025-03-11T23:12:34-05:00", datetime(2025, 3, 12, 4, 12, 34), date(2025, 3, 11)),
        ("2025-03-11T09:12:34.5+0530", datetime(2025, 3, 11, 3, 42, 34, 500000), date(2025, 3, 11)),
        ("2025-03-11 09:12:34", datetime(2025, 3, 11, 9, 12, 34), date(2025, 3, 11)),
        ("2025-03-11", datetime(2025, 3, 11), date(2025, 3, 11)),
        ("2025-03-11T09", datetime(2025, 3, 11, 9), date(2025, 3, 11)),
        ("2025-03-11T09:12", datetime(2025, 3, 11, 9, 12), date(2025, 3, 11)),
        ("20250311T091234", datetime(2025, 3, 11, 9, 12, 34), date(2025, 3, 11)),
        ("20250311T0912", datetime(2025, 3, 11, 9, 12), date(2025, 3, 11)),
        ("20250311T0912+02:00", datetime(2025, 3, 11, 7, 12), date(2025, 3, 11)),
        ("2025-03-11T09:12Z", datetime(2025, 3, 11, 9, 12), date(2025, 3, 11)),
        ("2025-03-11T09-05:00", datetime(2025, 3, 11, 14), date(2025, 3, 11)),
        ("2025-03-11x09:12:34,25", datetime(2025, 3, 11, 9, 12, 34, 250000), date(2025, 3, 11)),
        ("2025-03-11T09:12:34+05", datetime(2025, 3, 11, 4, 12, 34), date(2025, 3, 11)),
        ("2025", None, None), ("2025-10", None, None), ("T09:12:34", None, None), ("garbage", None, None),
        ("", None, None), (" 2025-03-11", None, None), ("2025-03-11T9:12:34", None, None),
        ("2025-02-30", None, None), ("2025-03-11T24:30:00", None, None), ("2025-03-11T09:12:34 UTC", None, None),
    ],
)
def test_iso(spark, text, utc, day):
    canonical = spark.createDataFrame([(text,)], "t string").select(iso_canonical(F.col("t")).alias("c"))
    row = canonical.select(
        F.date_format(iso_timestamp(F.col("c")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        iso_local_date(F.col("c")).alias("d"),
    ).first()
    assert row.ts == (utc and utc.strftime("%Y-%m-%d %H:%M:%S.%f")) and row.d == day


def test_time_text(spark):
    df = spark.createDataFrame([(t,) for t in ("2025-03-11 09:12:34", "2025-03-11 09:12:34.25", "2025-03-11 09:12:34.123456")], "t string")
    ts = F.col("t").cast("timestamp")
    got = [tuple(r) for r in df.select(iso_text(ts), warehouse_text(ts)).collect()]
    assert got == [
        ("2025-03-11T09:12:34+00:00", "2025-03-11 09:12:34+00"),
        ("2025-03-11T09:12:34.250000+00:00", "2025-03-11 09:12:34.250+00"),
        ("2025-03-11T09:12:34.123456+00:00", "2025-03-11 09:12:34.123456+00"),
    ]


def test_integers(spark):
    df = spark.createDataFrame([(v,) for v in ("85", " 85 ", "85.0", "", "x", "1_000", "-3", "99999999999999999999")], "t string")
    assert [r[0] for r in df.select(safe_int(F.col("t"))).collect()] == [85, 85, None, None, None, 1000, -3, None]
    nan = spark.createDataFrame([("-nan",), ("nan",), (None,)], "t string").select(safe_float(F.col("t")).alias("f"))
    values = [r.f for r in nan.collect()]
    assert values[0] != values[0] and values[1] != values[1] and values[2] is None


def test_record_hash(spark):
    rows = {r.transaction_id: r.record_hash for r in pos(spark, samples.POS_DAY_1 + ['{"transaction_id":"K-101x"}']).collect()}
    assert rows["K-101"] == hashlib.md5(b"K-101|2025-03-11T06:05:00+00:00").hexdigest()
    assert rows["K-101x"] == hashlib.md5(b"K-101x|").hexdigest()


def test_ecom_sample(spark):
    rows = feeds.good_rows(feeds.parse_ecom(samples.lines(spark, samples.ECOM), NOW)).collect()
    assert sum(r.total_amount for r in rows) == 91.5
    assert {r.order_date for r in rows} == {date(2025, 3, 11)}


def test_crm_layouts(spark):
    parsed = feeds.parse_crm(samples.lines(spark, samples.CRM_DAY_1 + samples.CRM_DAY_2), NOW)
    by_day = {(r.customer_id, r.updated_at.day): r.membership_tier for r in parsed.collect()}
    assert by_day[("M-1", 11)] is None and by_day[("M-1", 12)] == "Plus"
    legacy = feeds.parse_crm(samples.lines(spark, samples.CRM_DAY_2), NOW, legacy=True)
    assert {r.membership_tier for r in legacy.collect()} == {None}


@pytest.mark.parametrize(
    "line, expected",
    [
        ('C1,"L, o ""q""",,x', ("C1", 'L, o "q"', "", "x", None)),
        ("C1", ("C1", None, None, None, None)),
        (",b", ("", "b", None, None, None)),
        ('C1,"a,b",c', ("C1", "a,b", "c", None, None)),
        ('C1,a "b" c,d,', ("C1", 'a "b" c', "d", "", None)),
        ("C1,x\\,y", ("C1", "x\\", "y", None, None)),
    ],
)
def test_crm_cells(spark, line, expected):
    row = feeds.parse_crm(samples.lines(spark, [line]), NOW).first()
    assert (row.customer_id, row.first_name, row.last_name, row.email, row.loyalty_status) == expected
    assert row.updated_at is None and row._error is None


def test_inventory_rules(spark):
    values = [*samples.INVENTORY, "B-9,PIER,x,85.0,abc,never", ",PIER,,,,", "B-7"]
    parsed = feeds.parse_inventory(samples.lines(spark, values), NOW)
    rows = {r.raw_payload: r for r in feeds.good_rows(parsed).collect()}
    assert sum(rows[v].quantity for v in samples.INVENTORY) == 17
    assert rows[samples.INVENTORY[1]].product_name == "Lamp, red"
    bad = rows[values[3]]
    assert (bad.quantity, bad.price, bad.last_updated, bad.dq_status) == (None, None, None, "VALID")
    assert rows[values[4]].product_id == ""
    assert [r.error for r in feeds.dead_letters(parsed).collect()] == ["Missing product_id or store_id"]


def test_csv_files_drop_one_header_each(spark, tmp_path):
    samples.write_lines(tmp_path / "a.csv", samples.CRM_DAY_1, samples.CRM_8_HEADER)
    samples.write_lines(tmp_path / "b.csv", ['C9,"x, ""y""",,,,,,2025-03-12T08:00:00Z'], samples.CRM_9_HEADER)
    read = landing.read_csv_lines(spark, f"{tmp_path}/*.csv")
    got = {r.value: r.source_file for r in read.collect()}
    assert set(got) == {*samples.CRM_DAY_1, 'C9,"x, ""y""",,,,,,2025-03-12T08:00:00Z'}
    assert got[samples.CRM_DAY_1[0]].endswith("/a.csv")


def test_no_csv_line_is_lost(spark, tmp_path):
    odd = ["", "   ", "C1,x\x01y,z", '"open', ",", "C2"]
    samples.write_lines(tmp_path / "a.csv", [*samples.CRM_DAY_1, *odd], samples.CRM_8_HEADER)
    samples.write_lines(tmp_path / "b.csv", [*odd, samples.CRM_9_HEADER], "\ufeff" + samples.CRM_9_HEADER.replace(",", ", ").upper())
    samples.write_lines(tmp_path / "c.csv", odd, "unheard,of")
    parsed = feeds.parse_crm(landing.read_csv_lines(spark, f"{tmp_path}/*.csv"), NOW)
    rows = parsed.collect()
    physical = sum(len(p.read_text(encoding="utf-8").splitlines()) for p in tmp_path.glob("*.csv"))
    assert len(rows) == physical - 2  # only first lines that are headers go
    marked = [r for r in rows if r.customer_id == "C1"]
    assert len(marked) == 3 and {(r.first_name, r.raw_payload) for r in marked} == {("x\x01y", "C1,x\x01y,z")}
    dead = feeds.dead_letters(parsed).collect()
    assert sorted((r.line, r.error) for r in dead) == [
        *[("", "Missing customer_id")] * 3, (samples.CRM_9_HEADER, "Repeated header"), ("unheard,of", "First line is no header"),
    ]
    assert feeds.good_rows(parsed).count() + len(dead) == len(rows)


@pytest.mark.parametrize("split", ["64", "500", "4096", "128MB"])
def test_the_first_line_goes_however_files_are_split(spark, tmp_path, split):
    body = [f"C{k},a,b,c,d,e,f,2025-03-12T08:00:00Z" for k in range(100)]
    for name in "abc":
        samples.write_lines(tmp_path / f"{name}.csv", [*body[:50], samples.CRM_8_HEADER, *body[50:]], samples.CRM_8_HEADER)
    samples.write_lines(tmp_path / "d.csv", [], samples.CRM_8_HEADER)
    (tmp_path / "e.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parsed = feeds.parse_crm(landing.read_csv_lines(spark, f"{tmp_path}/*.csv"), NOW)
        good, dead = feeds.good_rows(parsed).collect(), feeds.dead_letters(parsed).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.raw_payload for r in good) == sorted(body * 3)
    assert [(r.line, r.error) for r in dead] == [(samples.CRM_8_HEADER, "Repeated header")] * 3


def test_a_files_own_header_names_its_columns(spark, tmp_path):
    renamed = samples.CRM_8_HEADER.replace("city", "town")
    samples.write_lines(tmp_path / "a.csv", samples.CRM_DAY_1[:2], renamed)
    samples.write_lines(
        tmp_path / "b.csv", ['2025-03-12T08:00:00Z,"x, ""y""",7,C9,again', "2025-03-12T09:00:00Z", ",,,customer_id"],
        '"updated_at", Phone,email,CUSTOMER_ID,phone',
    )
    samples.write_lines(tmp_path / "c.csv", samples.CRM_DAY_1[2:], samples.CRM_8_HEADER)
    lines, headers = landing.read_csv(spark, f"{tmp_path}/*.csv", headers_path=str(tmp_path / "headers"))
    parsed = feeds.parse_crm(lines, NOW)
    rows = {r.customer_id: r for r in feeds.good_rows(parsed).collect()}
    assert set(rows) == {"M-1", "M-2", "M-3", "M-4", "C9"}
    assert (rows["M-1"].city, rows["M-1"].country, rows["M-1"].raw_extra_attributes) == (None, "DE", '{"town":"Kiel"}')
    assert (rows["C9"].email, rows["C9"].city, rows["C9"].updated_at.hour) == ("7", None, 8)
    assert rows["C9"].raw_extra_attributes == '{"phone":"x, \\"y\\""}'
    assert rows["M-3"].city == "Bergen" and rows["M-3"].raw_extra_attributes is None
    dead = {(r.line, r.error) for r in feeds.dead_letters(parsed).collect()}
    assert dead == {("2025-03-12T09:00:00Z", "Missing customer_id"), (",,,customer_id", "Repeated header")}
    found = {(r.field, r.change): r.file_count for r in drift.header_drift(headers, schemas.CSV_HEADERS[:2]).collect()}
    assert found[("town", "added")] == 1 and found[("city", "removed")] == 2 and found[("phone", "added")] == 1
    assert ("membership_tier", "removed") not in found
    stock = feeds.parse_inventory(
        spark.createDataFrame([("9,P1,S1", "f", ["quantity", "product_id", "store_id"], False)],
                              "value string, source_file string, header array<string>, unheaded boolean"), NOW
    ).first()
    assert (stock.product_id, stock.store_id, stock.quantity, stock.price) == ("P1", "S1", 9, None)


def test_split_csv_agrees_with_the_reader(spark):
    values = ['C1,"L, o ""q""",,x', "C1", ",b", 'C1,"a,b",c', 'C1,a "b" c,d,', "a,,", '"x","y"']
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(split_csv(F.col("v")).alias("n"), parse_csv(F.col("v"), 4).alias("c"), csv_width(F.col("v")).alias("w")).collect()
    for r in got:
        assert len(r.n) == r.w and r.n == [c or "" for c in r.c][: r.w]


def test_wrong_types_are_counted_and_set_aside_on_demand(spark):
    values = [samples.POS_DAY_1[0], samples.POS_DAY_2[2], '{"transaction_id":"a","amount":" ","timestamp":"noon"}', '{"amount":"x"}']
    parsed = pos(spark, values)
    assert {(r.field, r.rule, r.line_count) for r in feeds.misfits(parsed).collect()} == {("amount", "type", 2), ("event_ts", "type", 1)}
    assert feeds.good_rows(parsed).count() == 3 and feeds.good_rows(parsed, strict=True).count() == 1
    reasons = sorted(r.error for r in feeds.dead_letters(parsed, strict=True).collect())
    assert reasons == ["Missing transaction_id", "Wrong type of amount", "Wrong type of event_ts"]
    stock = feeds.parse_inventory(samples.lines(spark, ["B-9,PIER,x,85.0,abc,never", "B-9,PIER,x,,,"]), NOW)
    assert sorted(r.field for r in feeds.misfits(stock).collect()) == ["last_updated", "price", "quantity"]


def test_json_files_and_hourly_path(spark, tmp_path):
    assert landing.hourly_pattern("/in/", "2025-03-11T09:59:00Z") == "/in/hourly/2025-03-11/9/*.json"
    samples.write_lines(tmp_path / "hourly/2025-03-11/9/x.json", samples.ECOM)
    pattern = landing.hourly_pattern(str(tmp_path), "2025-03-11T09:00:00Z")
    assert landing.read_json_lines(spark, pattern).count() == 3


def test_each_line_is_parsed_once(spark):
    plan = feeds.good_rows(pos(spark, samples.POS_DAY_1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3  # the fields, and two looks at what follows the object
    crm = feeds.good_rows(feeds.parse_crm(samples.lines(spark, samples.CRM_DAY_1), NOW))
    assert crm._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1


def test_lines_of_one_csv_file_are_not_dealt_by_file(spark, tmp_path):
    """Dealt by file for a join, the lines of a file would all be one task's."""
    (tmp_path / "a.csv").write_text("customer_id,updated_at\n" + "C1,x\n" * 50)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lines = landing.read_csv_lines(spark, str(tmp_path))
        assert lines.count() == 50
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    "line, one",
    [('{"a":"}{"}', True), ('{"a":"\\\\"} {"a":"}"}', False), ('{"a":"\\"}"}{"b":1}', False), ('{"a":1}]{}', False),
     (' {"a":"x\\\\\\"}"}\t', True), ('{"a":1},{"a":1}', False), ('{"a":{}} {}', False), ('{"a":{"b":"}"}}', True),
     ('{"a":1}"}', False), ('{"a":1}\\\\}', False)],
)
def test_what_follows_an_object(spark, line, one):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(feeds._one_value(F.col("value"))).first()[0] in ((True,) if one else (False, None))


def test_a_flat_line_is_not_read_again(spark, monkeypatch):
    """Where a flat object ends is seen without the two wrappings."""
    real = F.from_json
    monkeypatch.setattr(feeds.F, "from_json", lambda c, schema, *rest: F.raise_error(F.lit("read again")) if schema == "array<string>" else real(c, schema, *rest))
    df = spark.createDataFrame([('{"a":"}"}',), ('{"a":1} {"a":1}',), ('{"a":1}]{}',)], "value string")
    assert [bool(r[0]) for r in df.select(feeds._one_value(F.col("value"))).collect()] == [True, False, False]
