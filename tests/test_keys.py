"""Keys at the ends of their fields: printed whole, of one width, exported."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardledger.plans import reports, statements
from cardledger.plans.interest import running_number

LAST = 999_999 + 52 * 62**5


def test_running_numbers_have_one_width_and_order(spark):
    numbers = [0, 1, 999_999, 1_000_000, 1_000_001, 1_000_061, 1_000_062, 999_999 + 62**5, 1_000_000 + 62**5, 26 * 62**5 + 999_999,
               26 * 62**5 + 1_000_000, 4_000_000_000, LAST]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").withColumn("t", running_number(F.col("n")))
    got = [r.t for r in df.orderBy("n").collect()]
    assert got == sorted(got) and len(set(got)) == len(numbers) and {len(t) for t in got} == {6}
    assert got[:5] == ["000000", "000001", "999999", "A00000", "A00001"] and got[5:7] == ["A0000z", "A00010"] and got[-1] == "zzzzzz"
    with pytest.raises(Exception, match="no running number"):
        spark.createDataFrame([(LAST + 1,)], "n bigint").select(running_number(F.col("n"))).collect()


def test_long_keys_are_printed_whole(spark):
    day = dt.date(2001, 1, 5)
    rows = [(f"2001-01-05{i}", "01", 1, "System", D("1.50"), "c1", day) for i in ("999999", "A00000", "1000001")]
    tx = spark.createDataFrame(
        rows, "tran_id string, type_cd string, cat_cd int, source string, amt decimal(12,2), card_num string, proc_date date"
    )
    cards = spark.createDataFrame([("c1", 123456789012, 1)], "card_num string, acct_id bigint, cust_id bigint")
    types = spark.createDataFrame([("01", "Purchase")], "type_cd string, type_desc string")
    cats = spark.createDataFrame([("01", 1, "Sale")], "type_cd string, cat_cd int, cat_desc string")
    numbered = reports.report_rows(tx, day, day)
    detail = reports.report_detail(numbered, cards, types, cats)
    lines = [r.line for r in reports.report_lines(numbered, detail, day, day).where("part = 10").orderBy("sort_no").collect()]
    assert [x.split()[:2] for x in lines] == [[t, "123456789012"] for t in sorted(r[0] for r in rows)]
    assert {len(x) for x in lines} == {133}  # what is too long takes from the blanks behind the amount

    statement = spark.createDataFrame(
        [("c1", 123456789012, "N", "a", "b", "c", 700, D("5.00"), 3, D("4.50"))],
        "card_num string, acct_id bigint, name string, addr_line_1 string, addr_line_2 string, addr_line_3 string, fico int, "
        "curr_bal decimal(12,2), tran_count bigint, total_amt decimal(12,2)",
    )
    printed = [r.line for r in statements.statement_lines(statement, tx.withColumn("descr", F.lit("d"))).orderBy("line_no").collect()]
    assert sum("123456789012" in x for x in printed) == 1
    assert [x.split()[0] for x in printed if x.startswith("2001-01-05")] == sorted(r[0] for r in rows)
