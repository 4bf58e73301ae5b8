"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.ingest import STATEMENT_SQL, statement_rows
from cardledger.catalog.registry import FIRST_CARD, Registry, Tables
from cardledger.catalog.rows import REPORT_SQL, report_detail
from cardledger.operators import joins as J

REGISTRY = Registry()
add = REGISTRY.add


@add(
    "join_xref_inner",
    """SELECT d.tran_id, d.card_num, d.amt, x.acct_id, x.cust_id
       FROM {daily} d JOIN {xref} x ON x.card_num = d.card_num""",
)
def _(t: Tables):
    return J.join_xref(t.daily, t.xref).select("tran_id", "card_num", "amt", "acct_id", "cust_id")


@add(
    "reject_unknown_card",
    "SELECT tran_id, card_num, amt FROM {daily} WHERE card_num NOT IN (SELECT card_num FROM {xref})",
)
def _(t: Tables):
    return J.unknown_cards(t.daily, t.xref).select("tran_id", "card_num", "amt")


@add(
    "reject_unknown_account",
    """SELECT d.tran_id, d.card_num, x.acct_id FROM {daily} d JOIN {xref} x ON x.card_num = d.card_num
       WHERE x.acct_id NOT IN (SELECT acct_id FROM {account})""",
)
def _(t: Tables):
    return J.unknown_accounts(t.daily, t.xref, t.account).select("tran_id", "card_num", "acct_id")


@add(
    "verify_daily",
    """SELECT d.tran_id, x.acct_id, x.card_num IS NOT NULL AS card_verified, a.acct_id IS NOT NULL AS account_found
       FROM {daily} d LEFT JOIN {xref} x ON x.card_num = d.card_num
            LEFT JOIN {account} a ON a.acct_id = x.acct_id""",
)
def _(t: Tables):
    return J.verify_daily(t.daily, t.xref, t.account).select(
        "tran_id", "acct_id", "card_verified", "account_found"
    )


@add(
    "join_report_dims",
    REPORT_SQL + "SELECT tran_id, card_num, acct_id, type_desc, cat_desc, lookup_failed FROM detail",
)
def _(t: Tables):
    return report_detail(t).select("tran_id", "card_num", "acct_id", "type_desc", "cat_desc", "lookup_failed")


@add(
    "join_rate_with_default",
    """SELECT b.acct_id, b.type_cd, b.cat_cd, b.balance, a.group_id, coalesce(o.rate, d.rate) AS rate
       FROM {category_balance} b JOIN {account} a ON a.acct_id = b.acct_id
       LEFT JOIN {rate} o ON o.group_id = a.group_id AND o.type_cd = b.type_cd AND o.cat_cd = b.cat_cd
       LEFT JOIN {rate} d ON d.group_id = 'DEFAULT' AND d.type_cd = b.type_cd AND d.cat_cd = b.cat_cd""",
)
def _(t: Tables):
    grouped = t.category_balance.join(t.account.select("acct_id", "group_id"), "acct_id")
    return J.join_rate_with_default(grouped, t.rate).select(
        "acct_id", "type_cd", "cat_cd", "balance", "group_id", "rate"
    )


@add(
    "join_first_card",
    "WITH " + FIRST_CARD + """ SELECT a.acct_id, f.card_num, a.curr_bal
       FROM {account} a JOIN first_card f ON f.acct_id = a.acct_id""",
)
def _(t: Tables):
    return t.account.join(J.first_card(t.xref), "acct_id").select("acct_id", "card_num", "curr_bal")


VIEW_SQL = """
SELECT c.c_custkey AS acct_id, x.card_num, x.cust_id, a.curr_bal, m.last_name, m.fico,
  CASE WHEN x.card_num IS NULL THEN 'account not in cross reference'
       WHEN a.acct_id IS NULL THEN 'account not in account master'
       WHEN m.cust_id IS NULL THEN 'customer not in customer master' END AS not_found
FROM {customer} c
LEFT JOIN (SELECT acct_id, min(card_num) AS card_num, min(cust_id) AS cust_id FROM {xref} GROUP BY 1) x
  ON x.acct_id = c.c_custkey
LEFT JOIN {account} a ON a.acct_id = c.c_custkey
LEFT JOIN {customer_master} m ON m.cust_id = x.cust_id"""


@add("account_view", VIEW_SQL)
def _(t: Tables):
    asked = t.customer.select(F.col("c_custkey").alias("acct_id"))
    view = J.account_view(
        asked, t.xref, t.account.select("acct_id", "curr_bal"),
        t.customer_master.select("cust_id", "last_name", "fico"),
    )
    return view.select("acct_id", "card_num", "cust_id", "curr_bal", "last_name", "fico", "not_found")


@add(
    "statement_join",
    STATEMENT_SQL + "SELECT card_num, cust_id, acct_id, name, curr_bal, fico, total_amt, tran_count FROM stmt",
)
def _(t: Tables):
    return statement_rows(t).select(
        "card_num", "cust_id", "acct_id", "name", "curr_bal", "fico", "total_amt", "tran_count"
    )


@add(
    "join_code_lists",
    """SELECT cust_id, state <> 'ZZ' AS state_ok,
       (state = 'TX' AND zip = '75001') OR (state = 'CA' AND zip = '90210')
         OR (state = 'NY' AND substr(zip, 1, 2) = '10') AS state_zip_ok,
       phone_1 IN ('(212)555-0100', '(212)000-0100') AS area_1_ok,
       phone_2 NOT IN ('(221)555-0199', '(800)555-0199') AS area_2_ok
       FROM {customer_master}""",
)
def _(t: Tables):
    return J.with_code_lists(t.customer_master).select(
        "cust_id", "state_ok", "state_zip_ok", "area_1_ok", "area_2_ok"
    )


@add(
    "parent_child_auth",
    """SELECT s.acct_id, s.credit_limit, d.auth_ts, d.req_id, d.resp_code, d.tran_amt
       FROM {auth_summary} s JOIN {auth_detail} d ON d.acct_id = s.acct_id""",
)
def _(t: Tables):
    rows = t.auth_detail.select("acct_id", "auth_ts", "req_id", "resp_code", "tran_amt")
    return J.parents_with_children(t.auth_summary.select("acct_id", "credit_limit"), rows)


@add(
    "orphan_children",
    """SELECT acct_id, auth_ts, req_id FROM {auth_detail}
       WHERE acct_id NOT IN (SELECT acct_id FROM {account})""",
)
def _(t: Tables):
    return J.orphan_children(t.auth_detail, t.account).select("acct_id", "auth_ts", "req_id")


@add(
    "fk_restrict_delete",
    """SELECT c_custkey AS acct_id, c_custkey IN (SELECT o_custkey FROM {orders}) AS blocked FROM {customer}""",
)
def _(t: Tables):
    asked = t.customer.select(F.col("c_custkey").alias("acct_id"))
    used = t.orders.select(F.col("o_custkey").alias("acct_id"))
    allowed, blocked = J.restrict_delete(asked, used, "acct_id")
    return allowed.withColumn("blocked", F.lit(False)).unionByName(blocked.withColumn("blocked", F.lit(True)))


@add(
    "card_by_key",
    """SELECT q.card_num, c.acct_id, c.active_status, c.card_num IS NOT NULL AS found
       FROM (SELECT DISTINCT card_num FROM {daily}) q LEFT JOIN {card} c ON c.card_num = q.card_num""",
)
def _(t: Tables):
    asked = t.daily.select("card_num").distinct()
    return J.lookup(asked, t.card.select("card_num", "acct_id", "active_status"), ["card_num"])


@add(
    "transaction_by_key",
    """SELECT q.tran_id, d.amt, d.card_num, d.tran_id IS NOT NULL AS found
       FROM (SELECT DISTINCT lpad(CAST(l_orderkey * 2 AS VARCHAR), 16, '0') AS tran_id FROM {lineitem}) q
            LEFT JOIN {daily} d ON d.tran_id = q.tran_id""",
)
def _(t: Tables):
    asked = t.lineitem.select(
        F.lpad((F.col("l_orderkey") * 2).cast("string"), 16, "0").alias("tran_id")
    ).distinct()
    return J.lookup(asked, t.daily.select("tran_id", "amt", "card_num"), ["tran_id"])


@add(
    "decline_reason_lookup",
    """SELECT req_id, code AS resp_reason, CASE code WHEN '0000' THEN '0000-APPROVED' WHEN '4100' THEN '4100-INSUFFICNT FUND'
         WHEN '5100' THEN '5100-CARD FRAUD' ELSE '9999-ERROR' END AS reason_text
       FROM (SELECT req_id, CASE WHEN req_id % 7 = 0 THEN '5100' WHEN req_id % 9 = 0 THEN '1234'
                    ELSE resp_reason END AS code FROM {auth_detail})""",
)
def _(t: Tables):
    coded = t.auth_detail.select(
        "req_id",
        F.when(F.col("req_id") % 7 == 0, "5100").when(F.col("req_id") % 9 == 0, "1234")
        .otherwise(F.col("resp_reason")).alias("resp_reason"),
    )
    return J.with_decline_reason(coded).select("req_id", "resp_reason", "reason_text")


@add(
    "theta_expiry",
    """SELECT d.tran_id, a.acct_id, a.expiry_date, d.orig_date FROM {daily} d
       JOIN {xref} x ON x.card_num = d.card_num
       JOIN {account} a ON a.acct_id = x.acct_id AND a.expiry_date >= d.orig_date""",
)
def _(t: Tables):
    carded = J.join_xref(t.daily, t.xref)
    facts = t.account.select(F.col("acct_id").alias("_a"), "expiry_date")
    live = (F.col("acct_id") == F.col("_a")) & (F.col("expiry_date") >= F.col("orig_date"))
    return carded.join(facts, live).select("tran_id", "acct_id", "expiry_date", "orig_date")
