"""Column functions over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.registry import INTEREST_SQL, Registry, Tables, edited
from cardledger.functions import dates as D
from cardledger.functions import decode, money
from cardledger.functions import text as X
from cardledger.plans import interest

REGISTRY = Registry()
add = REGISTRY.add

BAL = "CAST(c_acctbal AS DECIMAL(12,2))"


def balances(t: Tables):
    return t.customer.select("c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("bal"))


@add(
    "decode_zoned",
    f"SELECT c_custkey, CAST({BAL} AS DECIMAL(18,2)) AS bal FROM {{customer}}",
)
def _(t: Tables):
    text = balances(t).select("c_custkey", decode.encode_zoned(F.col("bal"), 12).alias("z"))
    return text.select("c_custkey", decode.decode_zoned(F.col("z")).alias("bal"))


@add("decode_packed", f"SELECT c_custkey, CAST({BAL} AS DECIMAL(18,2)) AS bal FROM {{customer}}")
def _(t: Tables):
    raw = balances(t).select("c_custkey", decode.encode_packed(F.col("bal"), 12).alias("z"))
    return raw.select("c_custkey", decode.decode_packed(F.col("z")).alias("bal"))


@add(
    "decode_binary",
    f"SELECT c_custkey, CAST({BAL} AS DECIMAL(18,2)) AS bal, c_custkey - 700 AS whole FROM {{customer}}",
)
def _(t: Tables):
    raw = balances(t).select(
        "c_custkey", decode.encode_binary(F.col("bal"), 8, 2).alias("z"),
        decode.encode_binary(F.col("c_custkey") - 700, 4).alias("w"),
    )
    return raw.select(
        "c_custkey", decode.decode_binary(F.col("z"), 8, 2).alias("bal"),
        decode.decode_binary(F.col("w"), 4).alias("whole"),
    )


@add(
    "trunc_cents",
    INTEREST_SQL + """SELECT acct_id, type_cd, cat_cd,
       CAST(CAST(int_cents AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS interest FROM interest""",
)
def _(t: Tables):
    looked = interest.balances_with_lookups(t.category_balance, t.account, t.xref, t.rate)
    return interest.monthly_interest(looked).select("acct_id", "type_cd", "cat_cd", "interest")


NUMBER_TEXT = """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS amt,
  CASE o_orderkey % 6 WHEN 0 THEN concat('  ', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), ' ')
    WHEN 1 THEN concat('$', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING))
    WHEN 2 THEN concat(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), '-')
    WHEN 3 THEN concat(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), 'CR')
    WHEN 4 THEN concat('1-', CAST(o_orderkey AS STRING)) ELSE concat('+ ', CAST(o_orderkey AS STRING)) END AS txt
FROM {orders}"""


@add(
    "numval",
    f"""WITH n AS ({NUMBER_TEXT}) SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN amt WHEN 1 THEN amt
       WHEN 2 THEN -amt WHEN 3 THEN -amt WHEN 5 THEN o_orderkey END AS DECIMAL(18,2)) AS number,
       o_orderkey % 6 <> 4 AS valid FROM n""",
)
def _(t: Tables):
    rows = t.spark.sql(NUMBER_TEXT, orders=t.orders)
    return rows.select(
        "o_orderkey", money.numval(F.col("txt")).alias("number"), money.is_number(F.col("txt")).alias("valid")
    )


MASKS = {
    "minus": "-ZZZ,ZZZ,ZZZ.ZZ", "plus": "+ZZZ,ZZZ,ZZZ.ZZ", "nines": "9(9).99-", "floating": "Z(9).99-",
    "signed": "+9(10).99",
}


@add(
    "edit_amount",
    "SELECT c_custkey, " + ", ".join(f"{edited(BAL, m)} AS {n}" for n, m in MASKS.items()) + " FROM {customer}",
)
def _(t: Tables):
    return balances(t).select(
        "c_custkey", *[money.edit_amount(F.col("bal"), m).alias(n) for n, m in MASKS.items()]
    )


@add(
    "date_reformat",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS dashed
       FROM {orders}""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    rows = rows.withColumn("compact", D.date_reformat(F.col("d"), "2", "2"))
    return rows.select("o_orderkey", "compact", D.date_reformat(F.col("compact"), "1", "1").alias("dashed"))


DATE_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '2023-13-01' WHEN 1 THEN '2023-02-30' WHEN 2 THEN '20AB-01-01'
  WHEN 3 THEN '2023-1' WHEN 4 THEN '2024-02-29' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS txt
FROM {orders}"""


@add(
    "date_valid",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Invalid month' WHEN 1 THEN 'Datevalue error'
       WHEN 2 THEN 'Nonnumeric data' WHEN 3 THEN 'Insufficient' ELSE 'Date is valid' END AS result FROM {orders}""",
)
def _(t: Tables):
    rows = t.spark.sql(DATE_TEXT, orders=t.orders)
    return rows.select("o_orderkey", D.date_valid(F.col("txt")).alias("result"))


RULE_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN '19000229' WHEN 1 THEN '20000229' WHEN 2 THEN '20010431'
  WHEN 3 THEN '18000101' WHEN 4 THEN '20010230' WHEN 5 THEN '20010145' WHEN 6 THEN '20019901' ELSE '    0101' END AS txt
FROM {orders}"""


@add(
    "date_rules",
    """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'not a leap year' WHEN 2 THEN '31 days not in month'
       WHEN 3 THEN 'century not valid' WHEN 4 THEN '30 days not in month' WHEN 5 THEN 'day not 1-31'
       WHEN 6 THEN 'month not 1-12' WHEN 7 THEN 'year missing' END AS failed
       FROM {orders}""",
)
def _(t: Tables):
    rows = t.spark.sql(RULE_TEXT, orders=t.orders)
    return rows.select("o_orderkey", D.date_rules(F.col("txt")).alias("failed"))


@add("month_end", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM {orders}")
def _(t: Tables):
    return t.orders.select("o_orderkey", D.month_end(F.to_date("o_orderdate")).alias("month_end"))


@add(
    "julian_and_complement",
    """SELECT event_id, CAST(strftime(ts, '%y%j') AS INT) AS yyddd, 99999 - CAST(strftime(ts, '%y%j') AS INT) AS day_key,
       999999999 - CAST(strftime(ts, '%H%M%S%g') AS INT) AS time_key, date_trunc('millisecond', ts) AS back
       FROM {events}""",
)
def _(t: Tables):
    rows = t.events.select(
        "event_id", D.julian(F.col("ts")).alias("yyddd"), D.day_complement(F.col("ts")).alias("day_key"),
        D.time_complement(F.col("ts")).alias("time_key"),
    )
    return rows.withColumn("back", D.from_complements(F.col("day_key"), F.col("time_key")))


@add(
    "ts26",
    """SELECT event_id, concat(strftime(ts, '%Y-%m-%d-%H.%M.%S.'), substr(strftime(ts, '%f'), 1, 2), '0000') AS ts_text
       FROM {events}""",
)
def _(t: Tables):
    return t.events.select("event_id", D.ts26(F.col("ts")).alias("ts_text"))


@add(
    "name_line",
    """SELECT cust_id, concat(split_part(first_name, ' ', 1), ' ', split_part(middle_name, ' ', 1), ' ',
       split_part(last_name, ' ', 1), ' ') AS name,
       concat(split_part(addr_line_3, ' ', 1), ' ', state, ' ', country, ' ', zip, ' ') AS addr FROM {customer_master}""",
)
def _(t: Tables):
    c = F.col
    return t.customer_master.select(
        "cust_id", X.name_line(c("first_name"), c("middle_name"), c("last_name")).alias("name"),
        X.address_line(c("addr_line_3"), c("state"), c("country"), c("zip")).alias("addr"),
    )


@add(
    "tokens",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS a, event_type AS b, '' AS c, CAST(event_id AS VARCHAR) AS d,
       CAST(NULL AS VARCHAR) AS e FROM {events}""",
)
def _(t: Tables):
    lines = t.events.select(
        "event_id",
        F.concat_ws(",", F.col("user_id").cast("string"), "event_type", F.lit(""), F.col("event_id").cast("string")).alias("line"),
    )
    return lines.select("event_id", *X.tokens(F.col("line"), ["a", "b", "c", "d", "e"]))


@add(
    "alpha_only",
    """SELECT doc_id, regexp_full_match(text, '[A-Za-z ]*') AND trim(text) <> '' AS alpha FROM {documents}""",
)
def _(t: Tables):
    return t.documents.select("doc_id", X.alpha_only(F.col("text")).alias("alpha"))


@add(
    "alnum_only",
    """SELECT p_partkey, regexp_full_match(p_name, '[A-Za-z0-9 ]*') AND trim(p_name) <> '' AS alnum FROM {part}""",
)
def _(t: Tables):
    return t.part.select("p_partkey", X.alnum_only(F.col("p_name")).alias("alnum"))


@add(
    "num_only",
    """SELECT cust_id, regexp_full_match(zip, '[0-9]+') AND NOT regexp_full_match(zip, '0+') AS zip_num,
       regexp_full_match(eft_account_id, '[0-9]+') AND NOT regexp_full_match(eft_account_id, '0+') AS eft_num
       FROM {customer_master}""",
)
def _(t: Tables):
    return t.customer_master.select(
        "cust_id", X.num_only(F.col("zip")).alias("zip_num"), X.num_only(F.col("eft_account_id")).alias("eft_num")
    )


@add(
    "us_phone",
    """SELECT cust_id, phone_1 IN ('', '(212)555-0100') AS ok_1, phone_2 = '(415)555-0199' AS ok_2
       FROM {customer_master}""",
)
def _(t: Tables):
    return t.customer_master.select(
        "cust_id", X.us_phone(F.col("phone_1")).alias("ok_1"), X.us_phone(F.col("phone_2")).alias("ok_2")
    )


@add("us_ssn", "SELECT cust_id, cust_id % 7 >= 5 AS ok FROM {customer_master}")
def _(t: Tables):
    return t.customer_master.select("cust_id", X.us_ssn(F.col("ssn")).alias("ok"))


@add("fico_range", "SELECT cust_id, fico BETWEEN 300 AND 850 AS ok FROM {customer_master}")
def _(t: Tables):
    return t.customer_master.select("cust_id", X.fico_range(F.col("fico")).alias("ok"))


@add(
    "status_decode",
    """SELECT req_id, CASE WHEN resp_code = '00' THEN 'A' ELSE 'D' END AS response,
       CASE WHEN fraud_flag IN ('F', 'R') THEN concat(fraud_flag, '-', strftime(fraud_date, '%m/%d/%y')) ELSE '-' END AS fraud
       FROM {auth_detail}""",
)
def _(t: Tables):
    return t.auth_detail.select(
        "req_id", X.response_letter(F.col("resp_code")).alias("response"),
        X.fraud_text(F.col("fraud_flag"), F.col("fraud_date")).alias("fraud"),
    )


@add("pad_key", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS padded FROM {customer}")
def _(t: Tables):
    return t.customer.select("c_custkey", X.pad_key(F.col("c_custkey"), 11).alias("padded"))


@add(
    "sql_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS dashed,
       o_orderkey % 6 IN (4, 5) AS ok FROM {orders}""",
)
def _(t: Tables):
    D.register_sql_functions(t.spark)
    rows = t.spark.sql(DATE_TEXT, orders=t.orders).join(
        t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")), "o_orderkey"
    )
    return rows.selectExpr(
        "o_orderkey", "ledger_date_compact(d) AS compact",
        "ledger_date_dashed(ledger_date_compact(d)) AS dashed", "ledger_date_ok(txt) AS ok",
    )
