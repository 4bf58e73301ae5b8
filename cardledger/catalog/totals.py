"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.ingest import exchange_tables
from cardledger.catalog.registry import (
    AUTH_ASOF, AUTH_SQL, DECIDED_SQL, INTEREST_SQL, RUN_TS, Registry, Tables,
)
from cardledger.catalog.rows import REPORT_END, REPORT_SQL, REPORT_START, report_detail
from cardledger.operators import aggregates as A
from cardledger.operators import filters
from cardledger.plans import authorization as AU
from cardledger.plans import interest, posting, purge
from cardledger.sources import exchange

REGISTRY = Registry()
add = REGISTRY.add


def posted(t: Tables):
    """Posted rows with the columns that the balances need."""
    rows = t.daily.select("seq", "type_cd", "cat_cd", "amt", "card_num", "orig_date")
    return posting.posted_rows(posting.decide(rows, t.xref, t.account), RUN_TS)


@add(
    "agg_category_balance",
    DECIDED_SQL + """SELECT acct_id, type_cd, cat_cd, CAST(sum(amt) AS DECIMAL(18,2)) AS balance
       FROM decided WHERE reason = 0 GROUP BY 1, 2, 3""",
    recursive=True,
)
def _(t: Tables):
    return A.category_balance(posted(t))


@add(
    "agg_cycle_amounts",
    DECIDED_SQL + """SELECT acct_id, CAST(sum(amt) AS DECIMAL(18,2)) AS total_amt,
       CAST(coalesce(sum(amt) FILTER (amt >= 0), 0) AS DECIMAL(18,2)) AS credit_amt,
       CAST(coalesce(sum(amt) FILTER (amt < 0), 0) AS DECIMAL(18,2)) AS debit_amt
       FROM decided WHERE reason = 0 GROUP BY 1""",
    recursive=True,
)
def _(t: Tables):
    return A.cycle_amounts(posted(t))


@add(
    "agg_posting_counts",
    DECIDED_SQL + "SELECT reason, count(*) AS rows FROM decided GROUP BY 1",
    recursive=True,
)
def _(t: Tables):
    rows = t.daily.select("seq", "amt", "card_num", "orig_date")
    return A.posting_counts(posting.decide(rows, t.xref, t.account))


@add(
    "agg_interest_by_account",
    INTEREST_SQL + """SELECT acct_id, CAST(CAST(sum(int_cents) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS total_interest
       FROM interest GROUP BY 1""",
)
def _(t: Tables):
    looked = interest.balances_with_lookups(t.category_balance, t.account, t.xref, t.rate)
    return A.interest_by_account(interest.monthly_interest(looked))


@add(
    "report_rollup",
    """SELECT card_num, CAST(sum(amt) AS DECIMAL(18,2)) AS total_amt, count(*) AS rows, CAST(0 AS INT) AS level
         FROM {daily} WHERE proc_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30' GROUP BY 1
       UNION ALL SELECT NULL, CAST(sum(amt) AS DECIMAL(18,2)), count(*), 1
         FROM {daily} WHERE proc_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'""",
)
def _(t: Tables):
    return A.report_rollup(filters.filter_date_range(t.daily, REPORT_START, REPORT_END))


@add(
    "agg_page_totals",
    REPORT_SQL + """SELECT page, CAST(sum(amt) AS DECIMAL(18,2)) AS page_total, count(*) AS rows
       FROM detail GROUP BY 1""",
)
def _(t: Tables):
    return A.page_totals(
        filters.filter_date_range(t.daily, REPORT_START, REPORT_END), ["card_num", "tran_id"]
    )


@add(
    "agg_statement_total",
    """SELECT x.card_num, CAST(coalesce(sum(d.amt), 0) AS DECIMAL(18,2)) AS total_amt, count(d.tran_id) AS tran_count
       FROM {xref} x LEFT JOIN {daily} d ON d.card_num = x.card_num GROUP BY 1""",
)
def _(t: Tables):
    return A.statement_totals(t.xref, t.daily).select("card_num", "total_amt", "tran_count")


@add(
    "count_filtered",
    """SELECT count(*) AS rows FROM {part} WHERE p_name LIKE '%1%' AND p_size = 10""",
)
def _(t: Tables):
    parts = t.part.select(F.col("p_size").cast("string").alias("type_cd"), F.col("p_name").alias("type_desc"))
    return filters.filter_types_like(parts, "10", "%1%").agg(F.count("*").alias("rows"))


@add(
    "agg_auth_summary",
    AUTH_SQL + """SELECT acct_id, count(*) FILTER (resp_code = '00') AS approved_cnt,
       count(*) FILTER (resp_code <> '00') AS declined_cnt,
       CAST(sum(approved_amt) AS DECIMAL(18,2)) AS approved_amt,
       CAST(coalesce(sum(amt) FILTER (resp_code <> '00'), 0) AS DECIMAL(18,2)) AS declined_amt,
       CAST(sum(approved_amt) AS DECIMAL(18,2)) AS credit_balance
       FROM decided WHERE acct_id IS NOT NULL GROUP BY 1""",
    recursive=True,
)
def _(t: Tables):
    return A.auth_summary(AU.details(AU.decide(t.auth_request, t.xref, t.auth_account, t.customer_master)))


@add("agg_max_key", "SELECT CAST(coalesce(max(CAST(tran_id AS BIGINT)), 0) AS BIGINT) AS max_id FROM {daily}")
def _(t: Tables):
    return A.max_key(t.daily)


@add(
    "agg_import_counts",
    """SELECT 'C' AS rec_type, count(*) AS rows FROM {customer_master} UNION ALL
       SELECT 'A', count(*) FROM {account} UNION ALL SELECT 'X', count(*) FROM {xref} UNION ALL
       SELECT 'T', count(*) FROM {daily} UNION ALL SELECT 'D', count(*) FROM {card}""",
)
def _(t: Tables):
    return exchange.import_counts(exchange.export_union(exchange_tables(t), RUN_TS))


PURGE_SQL = """
WITH gone AS (
  SELECT acct_id, count(*) FILTER (resp_code = '00') AS a, count(*) FILTER (resp_code <> '00') AS d,
    coalesce(sum(approved_amt) FILTER (resp_code = '00'), 0) AS aa,
    coalesce(sum(tran_amt) FILTER (resp_code <> '00'), 0) AS da
  FROM {auth_detail} WHERE date_diff('day', CAST(auth_ts AS DATE), DATE '2024-01-20') >= 5 GROUP BY 1),
judged AS (
  SELECT s.acct_id, s.credit_limit, s.credit_balance, s.approved_cnt - coalesce(a, 0) AS approved_cnt,
    s.declined_cnt - coalesce(d, 0) AS declined_cnt,
    CAST(s.approved_amt - coalesce(aa, 0) AS DECIMAL(12,2)) AS approved_amt,
    CAST(s.declined_amt - coalesce(da, 0) AS DECIMAL(12,2)) AS declined_amt
  FROM {auth_summary} s LEFT JOIN gone g ON g.acct_id = s.acct_id)
"""


@add(
    "agg_purge_counts",
    PURGE_SQL + """SELECT (SELECT count(*) FROM judged) AS summaries_read,
       (SELECT count(*) FROM judged WHERE approved_cnt <= 0 AND declined_cnt <= 0) AS summaries_deleted,
       (SELECT count(*) FROM {auth_detail}) AS details_read,
       (SELECT count(*) FROM {auth_detail}
         WHERE date_diff('day', CAST(auth_ts AS DATE), DATE '2024-01-20') >= 5) AS details_deleted""",
)
def _(t: Tables):
    return purge.purge_auth(t.auth_summary, t.auth_detail, AUTH_ASOF).counts
