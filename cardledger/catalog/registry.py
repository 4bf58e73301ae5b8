"""Registration of queries and the SQL fragments several checks share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardledger.fixtures import check_sql, table
from cardledger.session import configure

RUN_DATE = dt.date(2001, 9, 1)
RUN_TS = dt.datetime(2001, 9, 1, 12, 30, 15)
AUTH_ASOF = dt.date(2024, 1, 20)


class Tables:
    """The projections by attribute: ``t.account`` and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.known = configure(spark), sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name, self.known)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.checks: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, recursive: bool = False):
        def wrap(fn: Callable[[Tables], DataFrame]):
            self.queries[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
            if sql is not None:
                self.checks[name] = check_sql(sql, recursive)
            return fn

        return wrap


# Reason per daily transaction, stepping row by row through each account with the two cycle sums.
DECIDED_SQL = """
WITH placed AS (
  SELECT d.*, x.acct_id, a.acct_id AS found, a.credit_limit, a.expiry_date, a.cyc_credit, a.cyc_debit,
         row_number() OVER (PARTITION BY x.acct_id ORDER BY d.seq) AS rn
  FROM {daily} d LEFT JOIN {xref} x ON d.card_num = x.card_num
       LEFT JOIN {account} a ON a.acct_id = x.acct_id),
fold AS (
  SELECT acct_id, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS seq,
         CAST(cyc_credit AS DECIMAL(18,2)) AS cc, CAST(cyc_debit AS DECIMAL(18,2)) AS cd, 0 AS reason
  FROM account
  UNION ALL
  SELECT p.acct_id, p.rn, p.seq,
    CAST(f.cc + CASE WHEN p.amt >= 0 AND p.expiry_date >= p.orig_date
         AND p.credit_limit >= f.cc - f.cd + p.amt THEN p.amt ELSE 0 END AS DECIMAL(18,2)),
    CAST(f.cd + CASE WHEN p.amt < 0 AND p.expiry_date >= p.orig_date
         AND p.credit_limit >= f.cc - f.cd + p.amt THEN p.amt ELSE 0 END AS DECIMAL(18,2)),
    CASE WHEN p.expiry_date < p.orig_date THEN 103
         WHEN p.credit_limit < f.cc - f.cd + p.amt THEN 102 ELSE 0 END
  FROM fold f JOIN placed p ON p.acct_id = f.acct_id AND p.rn = f.rn + 1 AND p.found IS NOT NULL),
decided AS (
  SELECT p.tran_id, p.seq, p.type_cd, p.cat_cd, p.source, p.descr, p.amt, p.card_num, p.orig_date,
         p.proc_date, p.acct_id,
         CAST(CASE WHEN p.acct_id IS NULL THEN 100 WHEN p.found IS NULL THEN 101
              ELSE f.reason END AS INT) AS reason
  FROM placed p LEFT JOIN fold f ON f.acct_id = p.acct_id AND f.seq = p.seq)
"""

# Decision per authorization request, stepping through each account with its credit balance.
AUTH_SQL = """
WITH placed AS (
  SELECT q.*, x.acct_id, x.cust_id, a.acct_id AS found, a.credit_limit, a.cash_credit_limit, a.curr_bal,
         c.cust_id AS cust_found,
         row_number() OVER (PARTITION BY x.acct_id ORDER BY q.ts, q.req_id) AS rn
  FROM {auth_request} q LEFT JOIN {xref} x ON q.card_num = x.card_num
       LEFT JOIN {auth_account} a ON a.acct_id = x.acct_id
       LEFT JOIN {customer_master} c ON c.cust_id = x.cust_id),
fold AS (
  SELECT acct_id, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS req_id,
         CAST(0 AS DECIMAL(18,2)) AS used, false AS ok
  FROM auth_account
  UNION ALL
  SELECT p.acct_id, p.rn, p.req_id,
    CAST(f.used + CASE WHEN p.amt <= p.credit_limit - (CASE WHEN p.rn = 1 THEN p.curr_bal ELSE f.used END)
         THEN p.amt ELSE 0 END AS DECIMAL(18,2)),
    p.amt <= p.credit_limit - (CASE WHEN p.rn = 1 THEN p.curr_bal ELSE f.used END)
  FROM fold f JOIN placed p ON p.acct_id = f.acct_id AND p.rn = f.rn + 1 AND p.found IS NOT NULL),
decided AS (
  SELECT p.req_id, p.ts, p.card_num, p.auth_type, p.amt, p.acct_id, p.cust_id, p.credit_limit,
         p.cash_credit_limit,
         CASE WHEN coalesce(f.ok, false) THEN '00' ELSE '05' END AS resp_code,
         CASE WHEN coalesce(f.ok, false) THEN '0000'
              WHEN p.acct_id IS NULL OR p.found IS NULL OR p.cust_found IS NULL THEN '3100'
              ELSE '4100' END AS resp_reason,
         CAST(CASE WHEN coalesce(f.ok, false) THEN p.amt ELSE 0 END AS DECIMAL(12,2)) AS approved_amt
  FROM placed p LEFT JOIN fold f ON f.acct_id = p.acct_id AND f.req_id = p.req_id)
"""

FIRST_CARD = "first_card AS (SELECT acct_id, min(card_num) AS card_num FROM {xref} GROUP BY acct_id)"

# Interest per category balance, in integer cents.
INTEREST_SQL = (
    "WITH " + FIRST_CARD + """,
looked AS (
  SELECT b.*, a.acct_id AS found, a.group_id, f.card_num, coalesce(o.rate, d.rate) AS rate
  FROM {category_balance} b LEFT JOIN {account} a ON a.acct_id = b.acct_id
       LEFT JOIN first_card f ON f.acct_id = b.acct_id
       LEFT JOIN {rate} o ON o.group_id = a.group_id AND o.type_cd = b.type_cd AND o.cat_cd = b.cat_cd
       LEFT JOIN {rate} d ON d.group_id = 'DEFAULT' AND d.type_cd = b.type_cd AND d.cat_cd = b.cat_cd),
good AS (SELECT * FROM looked WHERE found IS NOT NULL AND card_num IS NOT NULL AND rate IS NOT NULL),
interest AS (
  SELECT *, CAST((CAST(balance * 100 AS BIGINT) * CAST(rate * 100 AS BIGINT)) // 120000 AS BIGINT) AS int_cents
  FROM good WHERE rate <> 0)
"""
)


def edited(expr: str, mask: str) -> str:
    """Check-SQL text of an amount under a print mask."""
    plain = f"CAST(CAST(abs({expr}) AS DECIMAL(18,2)) AS VARCHAR)"
    tail = f"CASE WHEN {expr} < 0 THEN '-' ELSE ' ' END"

    def wide(text: str, width: int, fill: str) -> str:
        # Filled up to the width by counting, so that a longer amount is not cut.
        return f"concat(repeat('{fill}', greatest(0, {width} - length({text}))), {text})"

    if mask == "9(9).99-":
        return f"concat({wide(plain, 12, '0')}, {tail})"
    if mask == "Z(9).99-":
        return f"concat({wide(f'CASE WHEN abs({expr}) < 1 THEN substr({plain}, 2) ELSE {plain} END', 12, ' ')}, {tail})"
    if mask == "+9(10).99":
        return f"concat(CASE WHEN {expr} < 0 THEN '-' ELSE '+' END, {wide(plain, 13, '0')})"
    plus = "+" if mask[0] == "+" else " "
    grouped = f"format('{{:,}}', CAST(floor(abs({expr})) AS BIGINT))"
    body = (
        f"concat(CASE WHEN abs({expr}) < 1 THEN '' ELSE {grouped} END, right({plain}, 3))"
    )
    return (
        f"CASE WHEN {expr} = 0 THEN repeat(' ', 15) ELSE "
        f"concat(CASE WHEN {expr} < 0 THEN '-' ELSE '{plus}' END, {wide(body, 14, ' ')}) END"
    )
