"""Whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.ingest import LISTING_SQL, STATEMENT_SQL, exchange_tables, statement_rows
from cardledger.catalog.lookups import VIEW_SQL
from cardledger.catalog.order import INTEREST_TX, SHORT, COLS, system_transactions
from cardledger.catalog.registry import (
    AUTH_ASOF, DECIDED_SQL, INTEREST_SQL, RUN_DATE, RUN_TS, Registry, Tables,
)
from cardledger.catalog.rows import REPORT_SQL, report_detail, report_rows
from cardledger.catalog.totals import PURGE_SQL
from cardledger.plans import authorization as AU
from cardledger.plans import combine, interest, posting, purge, reports
from cardledger.session import scratch_path
from cardledger.sources import exchange, snapshots

REGISTRY = Registry()
add = REGISTRY.add


@add(
    "post_daily",
    DECIDED_SQL + """, delta AS (
      SELECT acct_id, sum(amt) AS total, coalesce(sum(amt) FILTER (amt >= 0), 0) AS credit,
             coalesce(sum(amt) FILTER (amt < 0), 0) AS debit FROM decided WHERE reason = 0 GROUP BY 1)
    SELECT a.acct_id, CAST(a.curr_bal + coalesce(d.total, 0) AS DECIMAL(12,2)) AS curr_bal,
           CAST(a.cyc_credit + coalesce(d.credit, 0) AS DECIMAL(12,2)) AS cyc_credit,
           CAST(a.cyc_debit + coalesce(d.debit, 0) AS DECIMAL(12,2)) AS cyc_debit
    FROM account a LEFT JOIN delta d ON d.acct_id = a.acct_id""",
    recursive=True,
)
def _(t: Tables):
    job = posting.post_daily(t.daily, t.xref, t.account, t.category_balance, RUN_TS, store=False)
    return job.accounts.select("acct_id", "curr_bal", "cyc_credit", "cyc_debit")


def posting_job(t: Tables) -> posting.Posting:
    """The job as it runs in production: decided once, stored, and read by every output."""
    return posting.post_daily(t.daily, t.xref, t.account, t.category_balance, RUN_TS)


@add(
    "post_daily_ledger",
    DECIDED_SQL + "SELECT tran_id, acct_id, type_cd, cat_cd, amt, card_num FROM decided WHERE reason = 0",
    recursive=True,
)
def _(t: Tables):
    return posting_job(t).ledger.select("tran_id", "acct_id", "type_cd", "cat_cd", "amt", "card_num")


@add(
    "post_daily_rejects",
    DECIDED_SQL + """SELECT tran_id, card_num, amt, reason, CASE reason WHEN 100 THEN 'INVALID CARD NUMBER FOUND'
         WHEN 101 THEN 'ACCOUNT RECORD NOT FOUND' WHEN 102 THEN 'OVERLIMIT TRANSACTION'
         ELSE 'TRANSACTION RECEIVED AFTER ACCT EXPIRATION' END AS reason_text
       FROM decided WHERE reason <> 0""",
    recursive=True,
)
def _(t: Tables):
    return posting_job(t).rejects.select("tran_id", "card_num", "amt", "reason", "reason_text")


@add("post_daily_counts", DECIDED_SQL + "SELECT reason, count(*) AS rows FROM decided GROUP BY 1", recursive=True)
def _(t: Tables):
    return posting_job(t).counts


@add(
    "post_daily_balances",
    DECIDED_SQL + """, delta AS (
      SELECT acct_id, type_cd, cat_cd, sum(amt) AS d FROM decided WHERE reason = 0 GROUP BY 1, 2, 3)
    SELECT coalesce(o.acct_id, n.acct_id) AS acct_id, coalesce(o.type_cd, n.type_cd) AS type_cd,
      coalesce(o.cat_cd, n.cat_cd) AS cat_cd, CAST(coalesce(o.balance, 0) + coalesce(n.d, 0) AS DECIMAL(12,2)) AS balance
    FROM {category_balance} o
    FULL JOIN delta n ON o.acct_id = n.acct_id AND o.type_cd = n.type_cd AND o.cat_cd = n.cat_cd""",
    recursive=True,
)
def _(t: Tables):
    return posting_job(t).category_balances.select("acct_id", "type_cd", "cat_cd", "balance")


@add(
    "interest_calc",
    INTEREST_SQL + f"""SELECT x.*, 'System' AS source,
       concat('Int. for a/c ', lpad(CAST(x.acct AS VARCHAR), 11, '0')) AS descr
       FROM (SELECT acct_id AS acct, {INTEREST_TX.strip()[7:]}) x""",
)
def _(t: Tables):
    return system_transactions(t).select(
        F.col("acct_id").alias("acct"), "tran_id", "type_cd", "cat_cd", "amt", "card_num", "source", "descr"
    )


@add("combine", INTEREST_SQL + f"SELECT {COLS} FROM {{daily}} UNION ALL {INTEREST_TX}")
def _(t: Tables):
    ledger, _ = combine.combine_transactions(t.daily.select(*SHORT), system_transactions(t))
    root = scratch_path(t.spark, "ledger")
    snapshots.snapshot_write(combine.sort_combined(ledger), root)
    return snapshots.snapshot_read(t.spark, root)


@add("statements", STATEMENT_SQL + "SELECT * FROM stmt")
def _(t: Tables):
    return statement_rows(t)


@add(
    "transaction_report",
    REPORT_SQL + """
    SELECT 'detail' AS kind, seq_no AS sort_no, page, card_num, tran_id, acct_id, type_desc, cat_desc,
           CAST(amt AS DECIMAL(18,2)) AS amt FROM detail
    UNION ALL SELECT 'page', max(seq_no), page, NULL, NULL, NULL, NULL, NULL, CAST(sum(amt) AS DECIMAL(18,2))
      FROM detail GROUP BY page
    UNION ALL SELECT 'account', max(seq_no), NULL, card_num, NULL, NULL, NULL, NULL, CAST(sum(amt) AS DECIMAL(18,2))
      FROM detail GROUP BY card_num
    UNION ALL SELECT 'grand', max(seq_no), NULL, NULL, NULL, NULL, NULL, NULL, CAST(sum(amt) AS DECIMAL(18,2))
      FROM detail""",
)
def _(t: Tables):
    rows = report_rows(t)
    return reports.transaction_report(rows, report_detail(t, rows))


@add("category_balance_report", LISTING_SQL)
def _(t: Tables):
    return reports.category_balance_listing(t.category_balance)


@add(
    "export_import_roundtrip",
    "SELECT cust_id, first_name, last_name, addr_line_2, state, zip, ssn, dob, fico FROM {customer_master}",
)
def _(t: Tables):
    back = exchange.import_split(exchange.export_union(exchange_tables(t), RUN_TS))["customer"]
    return back.select("cust_id", "first_name", "last_name", "addr_line_2", "state", "zip", "ssn", "dob", "fico")


@add(
    "purge_auth",
    PURGE_SQL + """SELECT acct_id, credit_limit, credit_balance, approved_cnt, declined_cnt, approved_amt, declined_amt
       FROM judged WHERE NOT (approved_cnt <= 0 AND declined_cnt <= 0)""",
)
def _(t: Tables):
    return purge.purge_auth(t.auth_summary, t.auth_detail, AUTH_ASOF).summaries.select(
        "acct_id", "credit_limit", "credit_balance", "approved_cnt", "declined_cnt", "approved_amt", "declined_amt"
    )


@add(
    "auth_account_view",
    f"""SELECT v.acct_id, v.cust_id, v.last_name, v.not_found, coalesce(s.approved_cnt, 0) AS approved_cnt,
       coalesce(s.declined_cnt, 0) AS declined_cnt, CAST(coalesce(s.credit_balance, 0) AS DECIMAL(12,2)) AS credit_balance
       FROM ({VIEW_SQL}) v LEFT JOIN {{auth_summary}} s ON s.acct_id = v.acct_id""",
)
def _(t: Tables):
    asked = t.customer.select(F.col("c_custkey").alias("acct_id"))
    view = AU.auth_account_view(
        asked, t.xref, t.account.select("acct_id", "curr_bal"),
        t.customer_master.select("cust_id", "last_name", "fico"), t.auth_summary,
    )
    return view.select(
        "acct_id", "cust_id", "last_name", "not_found", "approved_cnt", "declined_cnt", "credit_balance"
    )


@add(
    "interest_accounts",
    INTEREST_SQL + """, t AS (
      SELECT g.acct_id, CAST(coalesce(sum(i.int_cents), 0) AS BIGINT) AS c FROM (SELECT DISTINCT acct_id FROM good) g
      LEFT JOIN interest i ON i.acct_id = g.acct_id GROUP BY 1)
    SELECT a.acct_id, CAST(a.curr_bal + CAST(coalesce(t.c, 0) AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS curr_bal,
           a.cyc_credit, a.cyc_debit
    FROM {account} a LEFT JOIN t ON t.acct_id = a.acct_id""",
)
def _(t: Tables):
    job = interest.interest_calc(t.category_balance, t.account, t.xref, t.rate, RUN_DATE, RUN_TS)
    return job.accounts.select("acct_id", "curr_bal", "cyc_credit", "cyc_debit")
