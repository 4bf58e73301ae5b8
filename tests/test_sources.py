"""Fixed-width files, snapshots, exchange, hierarchy, messages, changes, validation edges."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardledger import codes, schemas as S
from cardledger.functions import dates, decode, money, text
from cardledger.operators import changes, filters, joins, paging, validate
from cardledger.plans import statements
from cardledger.sources import binary, exchange, fixed_width, hierarchy, load, messages, records, snapshots


def values(spark, items, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_decode_zoned(spark):
    got = values(spark, ["00000000194{", "00000000000}", "0000000001A", "12J", "99R", "1X", ""], decode.decode_zoned)
    assert got == [D("19.40"), D("0.00"), D("0.11"), D("-1.21"), D("-9.99"), None, None]


def test_decode_packed_and_binary(spark):
    raw = [bytes.fromhex(h) for h in ("12345C", "12345D", "12345F", "1A345C")]
    assert values(spark, raw, decode.decode_packed, "binary") == [D("123.45"), D("-123.45"), D("123.45"), None]
    raw = [bytes.fromhex(h) for h in ("FFFFFFFE", "00000100", "80000000")]
    assert values(spark, raw, lambda c: decode.decode_binary(c, 4), "binary") == [-2, 256, -(2**31)]


def test_numval(spark):
    got = values(spark, [" 1,234.50 ", "$5", "7-", "8 CR", "+.5", "", "1-2", "abc", None], money.numval)
    assert got == [D("1234.50"), D("5.00"), D("-7.00"), D("-8.00"), D("0.50"), None, None, None, None]


def test_edit_amount(spark):
    amounts = [D("0"), D("0.05"), D("-1234567.80"), D("999.99")]
    kind = "decimal(12,2)"
    assert values(spark, amounts, lambda c: money.edit_amount(c, "-ZZZ,ZZZ,ZZZ.ZZ"), kind) == [
        " " * 15, " " * 12 + ".05", "-  1,234,567.80", "         999.99"]
    assert values(spark, amounts, lambda c: money.edit_amount(c, "9(9).99-"), kind) == [
        "000000000.00 ", "000000000.05 ", "001234567.80-", "000000999.99 "]
    assert values(spark, amounts, lambda c: money.edit_amount(c, "Z(9).99-"), kind)[:3] == [
        "         .00 ", "         .05 ", "  1234567.80-"]


def test_interest_truncates_toward_zero(spark):
    df = spark.createDataFrame([(D("-100.01"), D("15.00")), (D("100.09"), D("15.00"))], "b decimal(12,2), r decimal(6,2)")
    assert [r[0] for r in df.select(money.trunc_cents(F.col("b"), F.col("r"))).collect()] == [D("-1.25"), D("1.25")]


def test_date_rules(spark):
    got = values(spark, ["19000229", "20000229", "20040229", "20010431", "20010230", "21000101", "2001AB01"], dates.date_rules)
    assert got == ["not a leap year", None, None, "31 days not in month", "30 days not in month", "century not valid", "month not 1-12"]


def test_date_forms(spark):
    assert values(spark, ["2001-02-03"], lambda c: dates.date_reformat(c, "2", "2")) == ["20010203"]
    with pytest.raises(ValueError):
        dates.date_reformat(F.lit("x"), "2", "1")
    assert values(spark, ["2001-02-03-04.05.06.120000"], dates.parse_ts26) == [dt.datetime(2001, 2, 3, 4, 5, 6, 120000)]


def test_people_rules(spark):
    assert values(spark, ["666123456", "900123456", "000123456", "123004567", "123450000", "123456789"], text.us_ssn) == [
        False, False, False, False, False, True]
    assert values(spark, [299, 300, 850, 851], text.fico_range, "int") == [False, True, True, False]
    assert values(spark, ["", None, "(212)555-0100", "(212)000-0100", "(911)555-0100", "x"], text.us_phone) == [
        True, True, True, False, False, False]


def test_code_tables():
    pairs, areas = codes.read_codes(codes.STATE_ZIP), codes.area_codes()
    assert len(joins.STATES) == 56 and len(set(pairs)) == len(pairs) == 240
    assert len(set(areas)) == len(areas) == 410
    assert {"201", "989"} <= set(areas) and not {"200", "221", "222", "800", "911"} & set(areas)


def test_area_codes_can_be_given(spark):
    people = spark.createDataFrame([("TX", "75001", "(212)555-0100", "(999)555-0100")], "state string, zip string, phone_1 string, phone_2 string")
    given = spark.createDataFrame([("999",)], "area_code string")
    row = joins.with_code_lists(people, given).first()
    assert (row.state_ok, row.state_zip_ok, row.area_1_ok, row.area_2_ok) == (True, True, False, True)


def test_fixed_width_quarantine(spark, tmp_path):
    good = "00000000001" + "Y" + "00000001940{" + "00000020200{" + "00000010200{" + "2014-11-20" + "2025-05-20" + "2025-05-20" + "00000000000{" + "00000000000}" + "A000000000" + " " * 10
    bad = good.replace("00000001940{", "0000000194X{").replace("2014-11-20", "2014-13-20")
    path = tmp_path / "acct.txt"
    path.write_bytes("\r\n".join([good.ljust(300), bad.ljust(300)]).encode() + b"\r\n")
    rows, quarantine = fixed_width.split_quarantine(fixed_width.scan_fixed_width(spark, str(path), S.ACCOUNT_FILE))
    row = rows.first()
    assert (row.acct_id, row.curr_bal, row.zip, row.group_id) == (1, D("194.00"), "A000000000", None)
    assert row.open_date == dt.date(2014, 11, 20) and rows.count() == 1
    assert quarantine.first().bad_fields == ["curr_bal", "open_date"]


def test_binary_records(spark, tmp_path):
    path = tmp_path / "records.bin"
    path.write_bytes(b"".join(i.to_bytes(4, "big", signed=True) + b"ab" for i in (-1, 5)))
    got = binary.scan_binary(spark, str(path), 6).select(decode.decode_binary(F.substring("record", 1, 4), 4))
    assert sorted(r[0] for r in got.collect()) == [-1, 5]


def test_snapshots_keep_the_last(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(7):
        snapshots.snapshot_write(spark.range(n + 1), root, keep=3)
    assert snapshots.snapshot_versions(spark, root) == [5, 6, 7]
    assert snapshots.snapshot_read(spark, root).count() == 7
    assert snapshots.snapshot_read(spark, root, -1).count() == 6
    waiting = snapshots.snapshot_write(spark.range(99), root, publish_now=False)
    assert snapshots.snapshot_read(spark, root).count() == 7
    snapshots.publish(spark, root, waiting, keep=3)
    assert snapshots.snapshot_read(spark, root).count() == 99
    with pytest.raises(FileNotFoundError):
        snapshots.snapshot_read(spark, str(tmp_path / "none"))


def test_load_refuses_repeated_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert load.replace_table(df, ["k"], str(tmp_path / "m")) == 1
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "m")).collect()) == [(1, "a"), (2, "c")]


def test_load_keeps_one_of_equal_and_null_rows(spark):
    rows = [(1, "b"), (1, None), (1, None), (None, "x"), (None, "y"), (3, "z"), (3, "z")]
    kept, refused = load.load_replace(spark.createDataFrame(rows, "k int, v string"), ["k"])
    assert sorted(map(str, kept.collect())) == sorted(["Row(k=1, v=None)", "Row(k=None, v='x')", "Row(k=3, v='z')"])
    assert sorted(map(str, refused.collect())) == sorted(["Row(k=1, v=None)", "Row(k=1, v='b')", "Row(k=None, v='y')", "Row(k=3, v='z')"])


def test_nothing_is_cut(spark):
    wide = [D("1718449733.99"), D("-123456789012.34")]
    assert values(spark, wide, lambda c: money.edit_amount(c, "+ZZZ,ZZZ,ZZZ.ZZ"), "decimal(18,2)") == ["+1,718,449,733.99", "-123,456,789,012.34"]
    assert values(spark, wide, lambda c: money.edit_amount(c, "9(9).99-"), "decimal(18,2)") == ["1718449733.99 ", "123456789012.34-"]
    assert values(spark, wide, lambda c: money.edit_amount(c, "Z(9).99-"), "decimal(18,2)") == ["1718449733.99 ", "123456789012.34-"]
    assert values(spark, wide, lambda c: money.edit_amount(c, "+9(10).99"), "decimal(18,2)") == ["+1718449733.99", "-123456789012.34"]
    assert values(spark, [123456789], lambda c: text.pad_key(c, 7), "bigint") == ["123456789"]
    for encode in (
        lambda c: decode.encode_packed(c, 11), lambda c: decode.encode_zoned(c, 11), lambda c: decode.encode_binary(c, 4, 2),
    ):
        with pytest.raises(Exception, match="does not fit"):
            values(spark, wide[1:], encode, "decimal(18,2)")


def test_code_page_both_ways(spark):
    raw = bytes(range(256))
    row = spark.createDataFrame([(raw,)], "b binary").select(records.ebcdic_text(F.col("b")).alias("t"))
    assert row.first().t == raw.decode("cp037")
    assert bytes(row.select(records.ebcdic_bytes(F.col("t"))).first()[0]) == raw


def test_exchange_round_trip_and_unknown_tag(spark):
    tables = {
        "customer": spark.createDataFrame([(2, ["a", "b"]), (1, ["c"])], "cust_id bigint, lines array<string>"),
        "xref": spark.createDataFrame([("c1", 1, 1)], "card_num string, cust_id bigint, acct_id bigint"),
    }
    export = exchange.export_union(tables, dt.datetime(2001, 1, 1))
    assert [(r.rec_type, r.seq_num) for r in export.orderBy("seq_num").collect()] == [("C", 1), ("C", 2), ("X", 3)]
    odd = export.where("seq_num = 3").withColumn("rec_type", F.lit("Z"))
    mixed = export.unionByName(odd)
    back = exchange.import_split(mixed)
    for name, df in tables.items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect()))
    assert back["errors"].first().line == "2001-01-01-00.00.00.000000|Z|0000003|" + "Unknown record type encountered".ljust(50)
    counts = dict(exchange.import_counts(mixed).collect())
    assert counts == {"C": 2, "X": 1, "?": 1} and sum(counts.values()) == mixed.count()


def test_hierarchy_load(spark):
    roots = spark.createDataFrame([(1, "r"), (1, "s"), (2, "t")], "acct_id bigint, v string")
    kids = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (9, 1, "z")], "root_key bigint, line bigint, v string")
    top, below, orphans = hierarchy.hier_load(roots, kids, ["line"])
    assert sorted(map(tuple, top.collect())) == [(1, "r"), (2, "t")]
    assert [tuple(r) for r in below.collect()] == [(1, 5, "x")] and [tuple(r) for r in orphans.collect()] == [(9, 1, "z")]


def test_request_message(spark):
    line = "240101,101500,4000,AUTH,0127,0100,POS,000000,+0000000012.50,5411,840,05,M1,SHOP,TOWN,TX,75001,T1"
    row = messages.auth_request_source(spark.createDataFrame([(line,), ("240101,1",)], "value string"))
    first, short = row.collect()
    assert (first.amt, first.transaction_id, first.card_num) == (D("12.50"), "T1", "4000")
    assert short.amt is None and short.card_num is None


def test_change_file(spark):
    table = spark.createDataFrame([("01", "a"), ("02", "b"), ("03", "c")], "type_cd string, d string")
    steps = spark.createDataFrame(
        [(1, "U", "01", "a2"), (2, "D", "02", ""), (3, "A", "02", "b2"), (4, "U", "02", "b3"), (5, "A", "01", "x"),
         (6, "D", "09", ""), (7, "*", "03", ""), (8, "Q", "03", ""), (9, "D", "03", ""), (10, "U", "03", "late")],
        "seq int, action string, type_cd string, d string",
    )
    kids = spark.createDataFrame([("03",)], "type_cd string")
    state, failed = changes.apply_changes(table, steps, "type_cd", children=kids)
    assert dict(state.collect()) == {"01": "a2", "02": "b3", "03": "late"}
    assert {r.seq: r.error for r in failed.collect()} == {
        5: "duplicate key", 6: "no such row", 8: "type not valid", 9: "child rows exist"}
    state, failed = changes.apply_changes(table, steps, "type_cd")
    assert dict(state.collect()) == {"01": "a2", "02": "b3"}
    assert {r.seq for r in failed.collect()} == {5, 6, 8, 10}


def test_upsert_twice_is_stable(spark):
    table = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    rows = spark.createDataFrame([(2, "b"), (3, None)], "k int, v string")
    once = changes.update_or_insert(table, rows, ["k"])
    twice = changes.update_or_insert(once, rows, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "b"), (3, None)]


def test_optimistic_update_conflicts(spark):
    table = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, v string, n int")
    ups = spark.createDataFrame(
        [(1, ("a", None), ("A", 1)), (2, ("x", 5), ("B", 6)), (3, ("q", 1), ("Q", 2))],
        "k int, before struct<v:string,n:int>, after struct<v:string,n:int>",
    )
    state, conflicts = changes.optimistic_update(table, ups, ["k"], ["v", "n"])
    assert sorted(map(tuple, state.collect())) == [(1, "A", 1), (2, "b", 5)]
    assert {r.k for r in conflicts.collect()} == {2, 3}


def test_periods():
    asof = dt.date(2024, 2, 10)
    assert filters.report_period("Monthly", asof) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert filters.report_period("Yearly", asof) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    with pytest.raises(ValueError):
        filters.report_period("Custom", asof, "2024-02-30", "2024-03-01")
    with pytest.raises(ValueError):
        filters.report_period("Custom", asof)


def test_pages(spark):
    df = spark.range(1, 26).withColumnRenamed("id", "k")
    page = paging.page_forward(df, "k", 11, 10).collect()
    assert [r.k for r in page] == list(range(11, 21)) and page[0].has_next
    assert not paging.page_forward(df, "k", 21, 10).first().has_next
    assert [r.k for r in paging.page_backward(df, "k", 11, 7).collect()] == list(range(4, 11))


def test_statements_have_no_limit(spark):
    cards = spark.createDataFrame([(f"c{i:02d}", 1, 1) for i in range(60)], "card_num string, cust_id bigint, acct_id bigint")
    people = spark.createDataFrame(
        [(1, "Al B", "M", "<Z>", "1 St", "", "TOWN X", "TX", "USA", "75001", 700)],
        "cust_id bigint, first_name string, middle_name string, last_name string, addr_line_1 string, addr_line_2 string, "
        "addr_line_3 string, state string, country string, zip string, fico int",
    )
    acct = spark.createDataFrame([(1, D("5.00"))], "acct_id bigint, curr_bal decimal(12,2)")
    tx = spark.createDataFrame([("c00", f"t{i:03d}", "buy", D("1.00")) for i in range(25)],
                               "card_num string, tran_id string, descr string, amt decimal(12,2)")
    stmt = statements.statements(cards, people, acct, tx)
    assert stmt.count() == 60 and stmt.where("tran_count = 0").count() == 59
    lines = statements.statement_lines(stmt, tx).where("card_num = 'c00'").orderBy("line_no").collect()
    assert [r.line_no for r in lines] == list(range(1, 16 + 25 + 3 + 1)) and {len(r.line) for r in lines} == {80}
    parts = statements.statement_html(stmt, tx, part_rows=10).where("card_num = 'c00'").orderBy("part_no").collect()
    assert [r.part_no for r in parts] == [0, 1, 2, 3, 4]
    page = "".join(r.html for r in parts)
    assert page.count("<p>t0") == 25 and "&lt;Z&gt;" in page and page.endswith("</html>")


def test_validation_of_blank_rows(spark):
    row = spark.createDataFrame([(None, None, None, None)], "user_id string, first_name string, last_name string, user_type string")
    assert validate.validate_user_batch(row).first().errors == ["first_name", "last_name", "user_id", "user_type"]


def test_binary_files_are_split_on_records(spark, tmp_path):
    records = [bytes([i % 256, i // 256]) * 5 for i in range(700)]
    df = spark.createDataFrame([(r,) for r in records], "record binary").repartition(3)
    path = str(tmp_path / "records")
    binary.write_binary(df, path, 10)
    got = binary.scan_binary(spark, path, 10, split_bytes=64)
    assert got.rdd.getNumPartitions() > 100 and sorted(bytes(r.record) for r in got.collect()) == sorted(records)
    binary.write_binary(df.limit(5), path, 10)
    assert binary.scan_binary(spark, f"file://{path}", 10).count() == 705
    with pytest.raises(Exception, match="behind the last record"):
        binary.scan_binary(spark, path, 11).count()
    for bad in (b"short", None):
        with pytest.raises(Exception):
            binary.write_binary(spark.createDataFrame([(bad,)], "record binary"), path, 10)
    assert binary.scan_binary(spark, path, 10).count() == 705  # what failed is not there


def test_refused_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(load, "COPIES", 16)
    rows = [(1, "a")] * 1000 + [(1, "b")] * 3 + [(2, "c"), (None, None), (None, None)]
    kept, refused = load.load_replace(spark.createDataFrame(rows, "k int, v string"), ["k"])
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([(1, "a"), (2, "c"), (None, None)], kept.schema).collect()))
    left = {(r.k, r.v): r["count"] for r in refused.groupBy("k", "v").count().collect()}
    assert left == {(1, "a"): 999, (1, "b"): 3, (None, None): 1}
