"""Projections, filters, validation; also the report detail several checks share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cardledger.catalog.registry import AUTH_ASOF, Registry, Tables
from cardledger.operators import changes, filters, validate
from cardledger.plans import reports

REGISTRY = Registry()
add = REGISTRY.add

REPORT_START, REPORT_END = dt.date(1997, 3, 1), dt.date(1997, 9, 30)
DAILY = "tran_id, seq, type_cd, cat_cd, source, descr, amt, card_num, orig_date, proc_date"

REPORT_SQL = """
WITH detail AS (
  SELECT d.*, x.acct_id, t.type_desc, c.cat_desc,
    CASE WHEN x.card_num IS NULL THEN 'card' WHEN t.type_desc IS NULL THEN 'type'
         WHEN c.cat_desc IS NULL THEN 'category' END AS lookup_failed,
    row_number() OVER (ORDER BY d.card_num, d.tran_id) AS seq_no,
    (row_number() OVER (ORDER BY d.card_num, d.tran_id) - 1) // 20 + 1 AS page
  FROM {daily} d LEFT JOIN {xref} x ON x.card_num = d.card_num
       LEFT JOIN {tran_type} t ON t.type_cd = d.type_cd
       LEFT JOIN {tran_category} c ON c.type_cd = d.type_cd AND c.cat_cd = d.cat_cd
  WHERE d.proc_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30')
"""


def report_rows(t: Tables):
    return reports.report_rows(t.daily, REPORT_START, REPORT_END)


def report_detail(t: Tables, rows=None):
    rows = report_rows(t) if rows is None else rows
    return reports.report_detail(rows, t.xref, t.tran_type, t.tran_category)


@add(
    "filter_date_range",
    f"SELECT {DAILY} FROM {{daily}} WHERE proc_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'",
)
def _(t: Tables):
    return filters.filter_date_range(t.daily, REPORT_START, REPORT_END)


@add(
    "filter_cards",
    """SELECT card_num, acct_id, cvv, embossed_name, expiry_date, active_status FROM {card}
       WHERE acct_id = 14""",
)
def _(t: Tables):
    return filters.filter_cards(t.card, acct_id=14)


@add(
    "filter_types_like",
    """SELECT d.tran_id, t.type_cd, t.type_desc FROM {daily} d JOIN {tran_type} t ON t.type_cd = d.type_cd
       WHERE t.type_desc LIKE 'P%'""",
)
def _(t: Tables):
    chosen = filters.filter_types_like(t.tran_type, pattern="P%")
    return t.daily.select("tran_id", "type_cd").join(chosen, "type_cd").select(
        "tran_id", "type_cd", "type_desc"
    )


@add(
    "report_period_preset",
    """SELECT 'Monthly' AS kind, tran_id, proc_date FROM {daily}
         WHERE proc_date BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'
       UNION ALL SELECT 'Yearly', tran_id, proc_date FROM {daily}
         WHERE proc_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
       UNION ALL SELECT 'Custom', tran_id, proc_date FROM {daily}
         WHERE proc_date BETWEEN DATE '1998-05-05' AND DATE '1998-06-04'""",
)
def _(t: Tables):
    asof = dt.date(1996, 2, 10)
    out = None
    for kind, args in (("Monthly", ()), ("Yearly", ()), ("Custom", ("1998-05-05", "1998-06-04"))):
        start, end = filters.report_period(kind, asof, *args)
        part = filters.filter_date_range(t.daily, start, end).select(
            F.lit(kind).alias("kind"), "tran_id", "proc_date"
        )
        out = part if out is None else out.unionByName(part)
    return out


@add(
    "project_reformat",
    "SELECT card_num, tran_id, type_cd, cat_cd, source, descr, amt, orig_date, proc_date FROM {daily}",
)
def _(t: Tables):
    return t.daily.select(
        "card_num", "tran_id", "type_cd", "cat_cd", "source", "descr", "amt", "orig_date", "proc_date"
    )


ACCOUNT_UPDATE = """
SELECT c_custkey AS acct_id,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'X' ELSE 'Y' END AS active_status,
  CASE c_custkey % 6 WHEN 0 THEN '19000229' WHEN 1 THEN '20000229' WHEN 2 THEN '18991231'
       WHEN 3 THEN '20010431' WHEN 4 THEN '' ELSE '19991231' END AS open_date,
  CASE WHEN c_custkey % 4 = 0 THEN '20231301' ELSE '20231201' END AS expiry_date,
  CASE WHEN c_custkey % 7 = 0 THEN '2023AB01' ELSE '20230230' END AS reissue_date,
  CASE WHEN c_custkey % 3 = 0 THEN '1,500.00' ELSE CAST(c_custkey AS STRING) END AS credit_limit,
  CASE WHEN c_custkey % 8 = 0 THEN 'abc' ELSE '+100.5' END AS cash_credit_limit,
  CASE WHEN c_custkey % 9 = 0 THEN '12-34' ELSE '-12.50' END AS curr_bal,
  CASE WHEN c_custkey % 10 = 0 THEN '' ELSE '0' END AS cyc_credit,
  CASE WHEN c_custkey % 11 = 0 THEN '1.2.3' ELSE '7' END AS cyc_debit
FROM {customer}"""


def _update(t: Tables, text: str, **tables):
    return t.spark.sql(text, **tables)


@add(
    "validate_account_batch",
    f"""WITH u AS ({ACCOUNT_UPDATE})
    SELECT acct_id, concat_ws(';',
      CASE WHEN active_status NOT IN ('Y', 'N') THEN 'active_status' END,
      CASE WHEN open_date NOT IN ('20000229', '19991231') THEN 'open_date' END,
      CASE WHEN expiry_date <> '20231201' THEN 'expiry_date' END,
      'reissue_date',
      CASE WHEN cash_credit_limit = 'abc' THEN 'cash_credit_limit' END,
      CASE WHEN curr_bal = '12-34' THEN 'curr_bal' END,
      CASE WHEN cyc_credit = '' THEN 'cyc_credit' END,
      CASE WHEN cyc_debit = '1.2.3' THEN 'cyc_debit' END) AS errors FROM u""",
)
def _(t: Tables):
    checked = validate.validate_account_batch(_update(t, ACCOUNT_UPDATE, customer=t.customer))
    return checked.select("acct_id", F.array_join("errors", ";").alias("errors"))


_GOOD_AREA = "(phone_1 = '' OR phone_1 = '(212)555-0100')"
_ZIP_OK = (
    "((state = 'TX' AND substr(zip, 1, 2) = '75') OR (state = 'CA' AND substr(zip, 1, 2) = '90') "
    "OR (state = 'NY' AND substr(zip, 1, 2) = '10'))"
)


@add(
    "validate_customer_batch",
    f"""SELECT cust_id, concat_ws(';',
      CASE WHEN cust_id % 7 < 5 THEN 'ssn' END,
      CASE WHEN dob >= DATE '2001-09-01' THEN 'dob' END,
      CASE WHEN fico NOT BETWEEN 300 AND 850 THEN 'fico' END,
      'last_name',
      CASE WHEN state = 'ZZ' THEN 'state' END,
      CASE WHEN zip = '1000A' THEN 'zip' END,
      CASE WHEN NOT regexp_full_match(addr_line_3, '[A-Za-z ]+') THEN 'city' END,
      CASE WHEN NOT {_GOOD_AREA} THEN 'phone_1' END,
      CASE WHEN phone_2 <> '(415)555-0199' THEN 'phone_2' END,
      CASE WHEN eft_account_id = '0000000000' THEN 'eft_account_id' END,
      CASE WHEN primary_holder = 'X' THEN 'primary_holder' END,
      CASE WHEN state <> 'ZZ' AND zip <> '1000A' AND NOT {_ZIP_OK} THEN 'state_zip' END) AS errors
    FROM {{customer_master}}""",
)
def _(t: Tables):
    checked = validate.validate_customer_batch(t.customer_master, dt.date(2001, 9, 1))
    return checked.select("cust_id", F.array_join("errors", ";").alias("errors"))


CARD_UPDATE = """
SELECT card_num,
  CASE WHEN acct_id % 4 = 0 THEN embossed_name WHEN acct_id % 4 = 1 THEN '' ELSE 'ALICE SMITH' END AS embossed_name,
  CASE WHEN acct_id % 3 = 0 THEN 'Q' ELSE active_status END AS active_status,
  CAST(acct_id % 15 AS INT) AS expiry_month, CAST(1940 + acct_id % 200 AS INT) AS expiry_year
FROM {card}"""


@add(
    "validate_card_batch",
    f"""WITH u AS ({CARD_UPDATE})
    SELECT card_num, concat_ws(';',
      CASE WHEN NOT regexp_full_match(embossed_name, '[A-Za-z ]+') THEN 'embossed_name' END,
      CASE WHEN active_status NOT IN ('Y', 'N') THEN 'active_status' END,
      CASE WHEN expiry_month NOT BETWEEN 1 AND 12 THEN 'expiry_month' END,
      CASE WHEN expiry_year NOT BETWEEN 1950 AND 2099 THEN 'expiry_year' END) AS errors FROM u""",
)
def _(t: Tables):
    checked = validate.validate_card_batch(_update(t, CARD_UPDATE, card=t.card))
    return checked.select("card_num", F.array_join("errors", ";").alias("errors"))


TRANSACTION_ENTRY = """
SELECT seq,
  CASE WHEN seq % 6 = 0 THEN '' WHEN seq % 6 = 1 THEN '12A' ELSE '77' END AS acct_id,
  CASE WHEN seq % 4 = 0 THEN '' ELSE card_num END AS card_num,
  type_cd, CASE WHEN seq % 5 = 0 THEN 'x' ELSE CAST(cat_cd AS STRING) END AS cat_cd, source,
  CASE WHEN seq % 7 = 0 THEN '  ' ELSE descr END AS descr,
  CASE WHEN seq % 3 = 0 THEN '12.5' WHEN seq % 11 = 0 THEN '' ELSE '+00000012.50' END AS amt,
  CASE WHEN seq % 8 = 0 THEN '2023-02-30' ELSE '2023-02-28' END AS orig_date,
  CASE WHEN seq % 9 = 0 THEN '20230228' ELSE '2023-02-28' END AS proc_date,
  '123' AS merchant_id, 'SHOP' AS merchant_name, 'TOWN' AS merchant_city, '75001' AS merchant_zip
FROM {daily}"""


@add(
    "validate_transaction_batch",
    f"""WITH u AS ({TRANSACTION_ENTRY})
    SELECT seq, concat_ws(';',
      CASE WHEN acct_id = '' AND card_num = '' THEN 'key missing' END,
      CASE WHEN acct_id = '12A' THEN 'acct_id' END,
      CASE WHEN trim(descr) = '' THEN 'descr missing' END,
      CASE WHEN amt = '' THEN 'amt missing' END,
      CASE WHEN cat_cd = 'x' THEN 'cat_cd' END,
      CASE WHEN amt = '12.5' THEN 'amt' END,
      CASE WHEN orig_date = '2023-02-30' THEN 'orig_date' END,
      CASE WHEN proc_date = '20230228' THEN 'proc_date' END) AS errors FROM u""",
)
def _(t: Tables):
    checked = validate.validate_transaction_batch(_update(t, TRANSACTION_ENTRY, daily=t.daily))
    return checked.select("seq", F.array_join("errors", ";").alias("errors"))


USER_ENTRY = """
SELECT CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE concat('USR', CAST(s_suppkey AS STRING)) END AS user_id,
  s_suppkey AS row_id, CASE WHEN s_suppkey % 3 = 0 THEN ' ' ELSE s_name END AS first_name,
  'LAST' AS last_name, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'U' END AS user_type
FROM {supplier}"""


@add(
    "validate_user_batch",
    f"""WITH u AS ({USER_ENTRY})
    SELECT row_id, concat_ws(';',
      CASE WHEN trim(first_name) = '' THEN 'first_name' END,
      CASE WHEN user_id = '' THEN 'user_id' END,
      CASE WHEN user_type IS NULL THEN 'user_type' END) AS errors FROM u""",
)
def _(t: Tables):
    checked = validate.validate_user_batch(_update(t, USER_ENTRY, supplier=t.supplier))
    return checked.select("row_id", F.array_join("errors", ";").alias("errors"))


CARD_NEW = """
SELECT card_num, CASE WHEN acct_id % 3 = 0 THEN upper(embossed_name)
       WHEN acct_id % 3 = 1 THEN concat(' ', embossed_name, ' ') ELSE concat(embossed_name, ' Jr') END AS embossed_name,
  CASE WHEN acct_id % 5 = 0 THEN 'N' ELSE active_status END AS active_status
FROM {card}"""


@add(
    "detect_changes",
    f"""WITH n AS ({CARD_NEW})
    SELECT n.card_num, concat_ws(';',
      CASE WHEN upper(trim(n.embossed_name)) <> upper(trim(c.embossed_name)) THEN 'embossed_name' END,
      CASE WHEN n.active_status <> c.active_status THEN 'active_status' END) AS changed_columns,
      upper(trim(n.embossed_name)) <> upper(trim(c.embossed_name)) OR n.active_status <> c.active_status AS changed
    FROM n JOIN {{card}} c ON c.card_num = n.card_num""",
)
def _(t: Tables):
    new = _update(t, CARD_NEW, card=t.card)
    out = changes.detect_changes(new, t.card, ["card_num"], ["embossed_name", "active_status"])
    return out.select("card_num", F.array_join("changed_columns", ";").alias("changed_columns"), "changed")


@add(
    "filter_expired_auth",
    """SELECT acct_id, auth_ts, req_id, tran_amt FROM {auth_detail}
       WHERE date_diff('day', CAST(auth_ts AS DATE), DATE '2024-01-20') >= 5""",
)
def _(t: Tables):
    return filters.filter_expired(t.auth_detail, AUTH_ASOF).select("acct_id", "auth_ts", "req_id", "tran_amt")


@add("filter_payable", "SELECT acct_id, curr_bal FROM {account} WHERE curr_bal > 0")
def _(t: Tables):
    return filters.filter_payable(t.account).select("acct_id", "curr_bal")
