"""Projection of the given tables into card-ledger entities.

Every projection is one SELECT that Spark and the checking SQL engine both run unchanged, so a
query and its check start from the same rows.  ``{name}`` refers to another projection or to a
given table.  Amounts become ``DECIMAL(12,2)`` before anything else.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cardledger.literals import values_sql

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RATE_GROUPS = {"BUILDING": 1500, "HOUSEHOLD": 1875, "MACHINERY": 0, "DEFAULT": 2500}


# Descriptions of transaction types and categories.
TRAN_TYPES = [
    ("01", "Purchase"), ("02", "Payment"), ("03", "Credit"), ("04", "Authorization"),
    ("05", "Refund"), ("06", "Reversal"), ("07", "Adjustment"),
]
TRAN_CATEGORIES = [
    ("01", 1, "Regular Sales Draft"), ("01", 2, "Regular Cash Advance"),
    ("01", 3, "Convenience Check Debit"), ("01", 4, "ATM Cash Advance"),
    ("01", 5, "Interest Amount"), ("02", 1, "Cash payment"), ("02", 2, "Electronic payment"),
    ("02", 3, "Check payment"), ("03", 1, "Credit to Account"),
    ("03", 2, "Credit to Purchase balance"), ("03", 3, "Credit to Cash balance"),
    ("04", 1, "Zero dollar authorization"), ("04", 2, "Online purchase authorization"),
    ("04", 3, "Travel booking authorization"), ("05", 1, "Refund credit"),
    ("06", 1, "Fraud reversal"), ("06", 2, "Non-fraud reversal"),
    ("07", 1, "Sales draft credit adjustment"),
]


def _category_fixture() -> list[tuple]:
    """Types 01-05 by categories 1-3 without (05, 3), which stays missing on purpose."""
    known = {(t, c): d for t, c, d in TRAN_CATEGORIES}
    keys = [(f"0{t}", c) for t in range(1, 6) for c in range(1, 4) if (t, c) != (5, 3)]
    return [(t, c, known.get((t, c), f"Category {t}-{c}")) for t, c in keys]


def _rate_fixture() -> list[tuple]:
    """Per group: its base rate, 0.25 more per category step; payments (02) of DEFAULT are free."""
    rows = []
    for group, base in RATE_GROUPS.items():
        for t in range(1, 6):
            for c in range(1, 4):
                free = base == 0 or (group == "DEFAULT" and t == 2)
                rate = 0 if free else base + 25 * (c - 1) + 10 * (t - 1)
                rows.append((group, f"0{t}", c, f"{rate // 100}.{rate % 100:02d}"))
    return rows


def _card(custkey: str, last: str = "0", first: str = "'4'") -> str:
    return f"concat({first}, lpad(CAST({custkey} AS STRING), 14, '0'), '{last}')"


# Every twentieth customer has cards that no transaction names, and every twentieth an account under
# another number, so that cards and accounts of some transactions are unknown.
_FIRST = "CASE WHEN c_custkey % 20 = 0 THEN '5' ELSE '4' END"


def _account(custkey: str) -> str:
    return f"CASE WHEN {custkey} % 20 = 1 THEN 900000000 + {custkey} ELSE {custkey} END"


VIEWS: dict[str, str] = {
    "account": f"""
        SELECT {_account("c_custkey")} AS acct_id,
               CASE WHEN c_custkey % 10 = 0 THEN 'N' ELSE 'Y' END AS active_status,
               CAST(c_acctbal AS DECIMAL(12,2)) AS curr_bal,
               CAST(500000 + 100000 * (c_custkey % 10) AS DECIMAL(12,2)) AS credit_limit,
               CAST(100000 AS DECIMAL(12,2)) AS cash_credit_limit,
               DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS open_date,
               DATE '2000-01-01' + CAST(c_custkey % 700 AS INT) AS expiry_date,
               DATE '1999-01-01' + CAST(c_custkey % 300 AS INT) AS reissue_date,
               CAST(0 AS DECIMAL(12,2)) AS cyc_credit,
               CAST(0 AS DECIMAL(12,2)) AS cyc_debit,
               lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS zip,
               c_mktsegment AS group_id
        FROM {{customer}}""",
    "xref": f"""
        SELECT {_card('c_custkey', '0', _FIRST)} AS card_num, c_custkey AS cust_id, c_custkey AS acct_id
        FROM {{customer}}
        UNION ALL
        SELECT {_card('c_custkey', '1', _FIRST)} AS card_num, c_custkey AS cust_id, c_custkey AS acct_id
        FROM {{customer}} WHERE c_custkey % 7 = 0""",
    "card": """
        SELECT card_num, acct_id, CAST(acct_id % 1000 AS INT) AS cvv,
               concat('Holder ', CAST(cust_id AS STRING)) AS embossed_name,
               DATE '2002-01-01' + CAST(acct_id % 500 AS INT) AS expiry_date,
               CASE WHEN acct_id % 9 = 0 THEN 'N' ELSE 'Y' END AS active_status
        FROM {xref}""",
    "customer_master": """
        SELECT c.c_custkey AS cust_id,
               split_part(c.c_name, '#', 1) AS first_name, c.c_mktsegment AS middle_name,
               split_part(c.c_name, '#', 2) AS last_name,
               concat('Unit ', CAST(c.c_custkey % 97 AS STRING)) AS addr_line_1,
               n.n_name AS addr_line_2, r.r_name AS addr_line_3,
               CASE c.c_custkey % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY'
                    ELSE 'ZZ' END AS state,
               'USA' AS country,
               CASE c.c_custkey % 5 WHEN 0 THEN '75001' WHEN 1 THEN '90210' WHEN 2 THEN '10001'
                    WHEN 3 THEN '75001' ELSE '1000A' END AS zip,
               CASE c.c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '(212)555-0100'
                    WHEN 2 THEN '(000)555-0100' WHEN 3 THEN '(212)000-0100'
                    WHEN 4 THEN '(911)555-0100' ELSE '2125550100' END AS phone_1,
               CASE WHEN c.c_custkey % 3 = 0 THEN '(415)555-0000' WHEN c.c_custkey % 9 = 4 THEN '(221)555-0199'
                    WHEN c.c_custkey % 9 = 7 THEN '(800)555-0199' ELSE '(415)555-0199' END AS phone_2,
               CASE c.c_custkey % 7 WHEN 0 THEN '666123456' WHEN 1 THEN '000123456'
                    WHEN 2 THEN '900123456' WHEN 3 THEN '123004567' WHEN 4 THEN '123450000'
                    ELSE lpad(CAST(100000001 + c.c_custkey * 7919 % 600000000 AS STRING), 9, '0')
                    END AS ssn,
               concat('G', lpad(CAST(c.c_custkey AS STRING), 9, '0')) AS govt_id,
               DATE '1950-01-01' + CAST(c.c_custkey * 37 % 32000 AS INT) AS dob,
               CASE WHEN c.c_custkey % 11 = 0 THEN '0000000000'
                    ELSE lpad(CAST(c.c_custkey AS STRING), 10, '1') END AS eft_account_id,
               CASE c.c_custkey % 8 WHEN 0 THEN 'X' WHEN 1 THEN 'N' ELSE 'Y' END AS primary_holder,
               CAST(290 + c.c_custkey % 570 AS INT) AS fico
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
             JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "daily": f"""
        SELECT lpad(CAST(o_orderkey AS STRING), 16, '0') AS tran_id, o_orderkey AS seq,
               concat('0', substr(o_orderpriority, 1, 1)) AS type_cd,
               CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS INT) AS cat_cd,
               CASE WHEN o_custkey % 3 = 0 THEN 'POS TERM' ELSE 'OPERATOR' END AS source,
               concat('Order ', CAST(o_orderkey AS STRING)) AS descr,
               CAST(CASE WHEN o_orderkey % 4 = 0 THEN -CAST(o_totalprice AS DECIMAL(12,2))
                    ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS amt,
               CASE WHEN o_custkey % 7 = 0 AND o_orderkey % 2 = 1
                    THEN {_card('o_custkey', '1')} ELSE {_card('o_custkey')} END AS card_num,
               CAST(o_orderdate AS DATE) AS orig_date, CAST(o_orderdate AS DATE) AS proc_date
        FROM {{orders}}""",
    "tran_type": values_sql(TRAN_TYPES[:5], ["type_cd", "type_desc"], ["STRING", "STRING"]),
    "tran_category": values_sql(
        _category_fixture(), ["type_cd", "cat_cd", "cat_desc"], ["STRING", "INT", "STRING"]
    ),
    "rate": values_sql(
        _rate_fixture(), ["group_id", "type_cd", "cat_cd", "rate"],
        ["STRING", "STRING", "INT", "DECIMAL(6,2)"],
    ),
    "category_balance": f"""
        SELECT {_account("o_custkey")} AS acct_id, concat('0', substr(o_orderpriority, 1, 1)) AS type_cd,
               CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS INT) AS cat_cd,
               CAST(sum(CASE WHEN o_orderkey % 4 = 0 THEN -CAST(o_totalprice AS DECIMAL(12,2))
                        ELSE CAST(o_totalprice AS DECIMAL(12,2)) END) AS DECIMAL(12,2)) AS balance
        FROM {{orders}} GROUP BY 1, 2, 3""",
    "auth_account": """
        SELECT acct_id, curr_bal, CAST(500 + 100 * (acct_id % 10) AS DECIMAL(12,2)) AS credit_limit,
               cash_credit_limit
        FROM {account}""",
    "auth_request": f"""
        SELECT event_id AS req_id, ts, {_card('user_id')} AS card_num, event_type AS auth_type,
               CAST(value AS DECIMAL(12,2)) AS amt
        FROM {{events}}""",
    # Decided authorizations for the jobs that start from stored ones: every fifth is declined.
    "auth_detail": f"""
        SELECT user_id AS acct_id, ts AS auth_ts, event_id AS req_id, {_card('user_id')} AS card_num,
               event_type AS auth_type,
               CASE WHEN event_id % 5 = 0 THEN '05' ELSE '00' END AS resp_code,
               CASE WHEN event_id % 5 = 0 THEN '4100' ELSE '0000' END AS resp_reason,
               CAST(value AS DECIMAL(12,2)) AS tran_amt,
               CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DECIMAL(12,2))
                    ELSE CAST(value AS DECIMAL(12,2)) END AS approved_amt,
               CASE WHEN event_id % 5 = 0 THEN 'D' ELSE 'P' END AS match_status,
               CASE WHEN event_id % 11 = 0 THEN 'F' WHEN event_id % 13 = 0 THEN 'R' END AS fraud_flag,
               CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN DATE '2024-02-01' END AS fraud_date
        FROM {{events}}""",
    "auth_summary": """
        SELECT d.acct_id, d.acct_id AS cust_id,
               CAST(500 + 100 * (d.acct_id % 10) AS DECIMAL(12,2)) AS credit_limit,
               CAST(100000 AS DECIMAL(12,2)) AS cash_limit,
               CAST(sum(approved_amt) AS DECIMAL(12,2)) AS credit_balance,
               CAST(0 AS DECIMAL(12,2)) AS cash_balance,
               CAST(sum(CASE WHEN resp_code = '00' THEN 1 ELSE 0 END) AS BIGINT) AS approved_cnt,
               CAST(sum(CASE WHEN resp_code <> '00' THEN 1 ELSE 0 END) AS BIGINT) AS declined_cnt,
               CAST(sum(approved_amt) AS DECIMAL(12,2)) AS approved_amt,
               CAST(sum(CASE WHEN resp_code <> '00' THEN tran_amt ELSE 0 END) AS DECIMAL(12,2))
                    AS declined_amt
        FROM {auth_detail} d GROUP BY d.acct_id""",
}

_REF = re.compile(r"\{(\w+)\}")


def _order(name: str, seen: list[str]) -> list[str]:
    for ref in _REF.findall(VIEWS[name]):
        if ref in VIEWS and ref not in seen:
            _order(ref, seen)
    if name not in seen:
        seen.append(name)
    return seen


def table(
    spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A given table or a projection, as a lazy DataFrame; ``known`` keeps those already made."""
    known = {} if known is None else known
    if name not in known:
        if name in BASE_TABLES:
            known[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        else:
            refs = {r: table(spark, sf_dir, r, known) for r in set(_REF.findall(VIEWS[name]))}
            known[name] = spark.sql(VIEWS[name], **refs)
    return known[name]


def check_sql(body: str, recursive: bool = False) -> str:
    """The checking SQL: ``body`` with the projections it mentions as leading CTEs."""
    names: list[str] = reduce(
        lambda seen, ref: _order(ref, seen) if ref in VIEWS else seen, _REF.findall(body), []
    )
    ctes = [f"{n} AS ({_REF.sub(r'\1', VIEWS[n])})" for n in names]
    main = _REF.sub(r"\1", body).strip()
    if not ctes:
        return main.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else main
    head = "WITH RECURSIVE " if recursive else "WITH "
    if main[:5].upper() == "WITH ":
        return head + ",\n".join(ctes) + ",\n" + main[5:]
    return head + ",\n".join(ctes) + "\n" + main
