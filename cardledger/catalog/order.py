"""Order-dependent operators, sorts, pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.registry import AUTH_SQL, DECIDED_SQL, INTEREST_SQL, RUN_DATE, RUN_TS, Registry, Tables
from cardledger.operators import paging, sequence
from cardledger.plans import authorization as AU
from cardledger.plans import combine, interest, posting
from cardledger.sources import seeds

REGISTRY = Registry()
add = REGISTRY.add

SHORT = ["tran_id", "type_cd", "cat_cd", "amt", "card_num"]
COLS = ", ".join(SHORT)


@add(
    "post_sequential",
    DECIDED_SQL + "SELECT tran_id, acct_id, amt, reason FROM decided",
    recursive=True,
)
def _(t: Tables):
    rows = t.daily.select("tran_id", "seq", "amt", "card_num", "orig_date")
    return posting.decide(rows, t.xref, t.account).select("tran_id", "acct_id", "amt", "reason")


@add(
    "auth_sequential",
    AUTH_SQL + "SELECT req_id, acct_id, amt, resp_code, resp_reason, approved_amt FROM decided",
    recursive=True,
)
def _(t: Tables):
    decided = AU.decide(t.auth_request, t.xref, t.auth_account, t.customer_master)
    return decided.select("req_id", "acct_id", "amt", "resp_code", "resp_reason", "approved_amt")


@add("run_sequence", "SELECT tran_id, card_num, row_number() OVER (ORDER BY card_num, tran_id) AS seq_no FROM {daily}")
def _(t: Tables):
    return sequence.run_sequence(t.daily.select("tran_id", "card_num"), ["card_num", "tran_id"])


@add(
    "page_number",
    "SELECT tran_id, (row_number() OVER (ORDER BY card_num, tran_id) - 1) // 20 + 1 AS page FROM {daily}",
)
def _(t: Tables):
    placed = sequence.run_sequence(t.daily.select("tran_id", "card_num"), ["card_num", "tran_id"])
    return placed.select("tran_id", sequence.page_number(F.col("seq_no"), 20).alias("page"))


@add(
    "control_break",
    """SELECT card_num, tran_id, amt FROM (SELECT *, row_number() OVER (PARTITION BY card_num ORDER BY tran_id) AS n
       FROM {daily}) WHERE n = 1""",
)
def _(t: Tables):
    return sequence.first_of_group(t.daily.select("card_num", "tran_id", "amt"), ["card_num"], ["tran_id"])


@add(
    "next_key",
    """SELECT event_id, (SELECT max(o_orderkey) FROM {orders}) + row_number() OVER (ORDER BY ts, event_id) AS new_id
       FROM {events}""",
)
def _(t: Tables):
    highest = t.orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0))).first()[0]
    return sequence.next_key(t.events.select("event_id", "ts"), ["ts", "event_id"], highest).select(
        "event_id", "new_id"
    )


def newest_first(t: Tables):
    """Details with ascending keys whose order is newest first."""
    return t.auth_detail.select("acct_id", "auth_ts", "req_id", "tran_amt").withColumns(
        {"_t": -F.unix_micros(F.col("auth_ts").cast("timestamp")), "_r": -F.col("req_id")}
    )


@add(
    "latest_auth_first",
    """SELECT acct_id, auth_ts, req_id, tran_amt,
       row_number() OVER (PARTITION BY acct_id ORDER BY auth_ts DESC, req_id DESC) AS place FROM {auth_detail}""",
)
def _(t: Tables):
    return sequence.group_sequence(newest_first(t), ["acct_id"], ["_t", "_r"], "place").drop("_t", "_r")


@add(
    "next_auth",
    """SELECT acct_id, req_id, lead(req_id) OVER w AS next_req_id, lead(tran_amt) OVER w AS next_amt
       FROM {auth_detail} WINDOW w AS (PARTITION BY acct_id ORDER BY auth_ts DESC, req_id DESC)""",
)
def _(t: Tables):
    out = sequence.next_in_group(newest_first(t), ["acct_id"], ["_t", "_r"], ["req_id", "tran_amt"], "nxt")
    return out.select(
        "acct_id", "req_id", F.col("nxt.req_id").alias("next_req_id"), F.col("nxt.tran_amt").alias("next_amt")
    )


@add("sort_combined", f"SELECT {COLS} FROM {{daily}} ORDER BY tran_id")
def _(t: Tables):
    return combine.sort_combined(t.daily.select(*SHORT))


@add("sort_by_card", f"SELECT {COLS} FROM {{daily}} ORDER BY card_num, tran_id")
def _(t: Tables):
    return t.daily.select(*SHORT).orderBy("card_num", "tran_id")


@add("sort_statement", f"SELECT card_num, tran_id, descr, amt FROM {{daily}} ORDER BY card_num, tran_id")
def _(t: Tables):
    return t.daily.select("card_num", "tran_id", "descr", "amt").orderBy("card_num", "tran_id")


@add(
    "sort_category_balance",
    "SELECT acct_id, type_cd, cat_cd, balance FROM {category_balance} ORDER BY 1, 2, 3",
)
def _(t: Tables):
    return t.category_balance.orderBy("acct_id", "type_cd", "cat_cd")


@add(
    "page_forward",
    """SELECT tran_id, amt, card_num, (SELECT count(*) FROM {daily} WHERE tran_id >= '0000000000000500') > 10 AS has_next
       FROM {daily} WHERE tran_id >= '0000000000000500' ORDER BY tran_id LIMIT 10""",
)
def _(t: Tables):
    return paging.page_forward(t.daily.select("tran_id", "amt", "card_num"), "tran_id", "0000000000000500", 10)


@add(
    "page_backward",
    """SELECT tran_id, amt, card_num FROM {daily} WHERE tran_id < '0000000000000500'
       ORDER BY tran_id DESC LIMIT 7""",
)
def _(t: Tables):
    return paging.page_backward(t.daily.select("tran_id", "amt", "card_num"), "tran_id", "0000000000000500", 7)


# Fixed expression: an interest transaction's id, amount and card.
INTEREST_TX = """
SELECT concat('2001-09-01', lpad(CAST(row_number() OVER (ORDER BY acct_id, type_cd, cat_cd) AS VARCHAR), 6, '0')) AS tran_id,
  '01' AS type_cd, 5 AS cat_cd, CAST(CAST(int_cents AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS amt, card_num
FROM interest"""


def system_transactions(t: Tables):
    job = interest.interest_calc(t.category_balance, t.account, t.xref, t.rate, RUN_DATE, RUN_TS)
    return job.transactions


@add(
    "combine_transactions",
    INTEREST_SQL + f"""SELECT {COLS} FROM {{daily}} UNION ALL {INTEREST_TX}""",
)
def _(t: Tables):
    return combine.combine_transactions(t.daily.select(*SHORT), system_transactions(t))[0]


_LITERALS = " UNION ALL ".join(
    f"SELECT '{a}' AS type_cd, {b} AS cat_cd, '{d}' AS cat_desc" for a, b, d in seeds.TRAN_CATEGORIES
)


@add(
    "union_literals",
    f"""SELECT s.type_cd, s.cat_cd, s.cat_desc, count(d.tran_id) AS uses FROM ({_LITERALS}) s
        LEFT JOIN {{daily}} d ON d.type_cd = s.type_cd AND d.cat_cd = s.cat_cd GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    columns = {"type_cd": "STRING", "cat_cd": "INT", "cat_desc": "STRING"}
    rows = seeds.union_literals(t.spark, seeds.TRAN_CATEGORIES, columns)
    uses = t.daily.groupBy("type_cd", "cat_cd").agg(F.count("*").alias("_n"))
    return rows.join(uses, ["type_cd", "cat_cd"], "left").select(
        "type_cd", "cat_cd", "cat_desc", F.coalesce("_n", F.lit(0)).alias("uses")
    )
