"""Table changes; each check compares the table after the change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cardledger.catalog.registry import (
    AUTH_ASOF, DECIDED_SQL, FIRST_CARD, INTEREST_SQL, RUN_TS, Registry, Tables,
)
from cardledger.catalog.rows import TRANSACTION_ENTRY
from cardledger.catalog.totals import posted
from cardledger.operators import aggregates as A
from cardledger.operators import changes, validate
from cardledger.plans import interest, purge
from cardledger.session import scratch_path
from cardledger.sources.buckets import BucketTable

REGISTRY = Registry()
add = REGISTRY.add

#: Rows of a bucket of a stored master.
BUCKET_ROWS = 2_000_000


def stored(t: Tables, table, keys: list[str], delta, merge):
    """The change made in a bucketed table: only the buckets of the delta's keys are rewritten."""
    kept = BucketTable(scratch_path(t.spark, "master"), tuple(keys), max(8, -(-table.count() // BUCKET_ROWS)))
    kept.write(table, 0)
    kept.change(delta, merge, 1, table.schema)
    return kept.read(t.spark)


UPSERT_SQL = DECIDED_SQL + """, delta AS (
      SELECT acct_id, type_cd, cat_cd + 1 AS cat_cd, sum(amt) AS d FROM decided WHERE reason = 0 GROUP BY 1, 2, 3),
    old AS (SELECT * FROM {category_balance})
    SELECT coalesce(o.acct_id, n.acct_id) AS acct_id, coalesce(o.type_cd, n.type_cd) AS type_cd,
      coalesce(o.cat_cd, n.cat_cd) AS cat_cd, CAST(coalesce(o.balance, 0) + coalesce(n.d, 0) AS DECIMAL(12,2)) AS balance
    FROM old o FULL JOIN delta n ON o.acct_id = n.acct_id AND o.type_cd = n.type_cd AND o.cat_cd = n.cat_cd"""


def further_balances(t: Tables):
    # Posted one category further on, so that some keys are stored and some are new.
    return A.category_balance(posted(t)).withColumn("cat_cd", F.col("cat_cd") + 1)


@add("upsert_category_balance", UPSERT_SQL, recursive=True)
def _(t: Tables):
    return changes.upsert_category_balance(t.category_balance, further_balances(t))


@add("upsert_category_balance_stored", UPSERT_SQL, recursive=True)
def _(t: Tables):
    keys = ["acct_id", "type_cd", "cat_cd"]
    table = t.category_balance.select(*keys, "balance")
    return stored(t, table, keys, further_balances(t), changes.upsert_category_balance)


POSTED_SQL = DECIDED_SQL + """, d AS (SELECT acct_id, sum(amt) AS s FROM decided WHERE reason = 0 GROUP BY 1)
    SELECT a.acct_id, CAST(a.curr_bal + coalesce(d.s, 0) AS DECIMAL(12,2)) AS curr_bal
    FROM account a LEFT JOIN d ON d.acct_id = a.acct_id"""


@add("apply_posting", POSTED_SQL, recursive=True)
def _(t: Tables):
    return changes.apply_posting(t.account, A.cycle_amounts(posted(t))).select("acct_id", "curr_bal")


@add("apply_posting_stored", POSTED_SQL, recursive=True)
def _(t: Tables):
    table = stored(t, t.account, ["acct_id"], A.cycle_amounts(posted(t)), changes.apply_posting)
    return table.select("acct_id", "curr_bal")


CREDITED_SQL = INTEREST_SQL + """, t AS (SELECT acct_id, sum(int_cents) AS c FROM interest GROUP BY 1)
    SELECT a.acct_id, CAST(a.curr_bal + CAST(coalesce(t.c, 0) AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS curr_bal
    FROM {account} a LEFT JOIN t ON t.acct_id = a.acct_id"""


def account_interest(t: Tables):
    looked = interest.balances_with_lookups(t.category_balance, t.account, t.xref, t.rate)
    return interest.interest_totals(looked)


@add("apply_interest", CREDITED_SQL)
def _(t: Tables):
    return changes.apply_interest(t.account, account_interest(t)).select("acct_id", "curr_bal")


@add("apply_interest_stored", CREDITED_SQL)
def _(t: Tables):
    table = stored(t, t.account, ["acct_id"], account_interest(t), changes.apply_interest)
    return table.select("acct_id", "curr_bal")


@add(
    "bill_payment",
    "WITH " + FIRST_CARD + """
    SELECT lpad(CAST((SELECT max(o_orderkey) FROM {orders}) + row_number() OVER (ORDER BY a.acct_id) AS VARCHAR), 16, '0') AS tran_id,
      '02' AS type_cd, 2 AS cat_cd, a.curr_bal AS amt, f.card_num, a.acct_id, CAST(999999999 AS BIGINT) AS merchant_id
    FROM {account} a JOIN first_card f ON f.acct_id = a.acct_id WHERE a.curr_bal > 0""",
)
def _(t: Tables):
    highest = A.max_key(t.daily).first()[0]
    payments, _ = changes.bill_payment(t.account, t.xref, highest, RUN_TS)
    return payments.select("tran_id", "type_cd", "cat_cd", "amt", "card_num", "acct_id", "merchant_id")


@add(
    "bill_payment_accounts",
    "WITH " + FIRST_CARD + """
    SELECT a.acct_id, CAST(CASE WHEN a.curr_bal > 0 AND f.card_num IS NOT NULL THEN 0 ELSE a.curr_bal END AS DECIMAL(12,2)) AS curr_bal
    FROM {account} a LEFT JOIN first_card f ON f.acct_id = a.acct_id""",
)
def _(t: Tables):
    _, accounts = changes.bill_payment(t.account, t.xref, A.max_key(t.daily).first()[0], RUN_TS)
    return accounts.select("acct_id", "curr_bal")


@add(
    "add_transactions",
    f"""WITH u AS ({TRANSACTION_ENTRY}),
    good AS (SELECT * FROM u WHERE NOT (acct_id = '' AND card_num = '') AND acct_id <> '12A' AND trim(descr) <> ''
             AND amt = '+00000012.50' AND cat_cd <> 'x' AND orig_date = '2023-02-28' AND proc_date = '2023-02-28')
    SELECT tran_id, descr, amt FROM {{daily}} UNION ALL
    SELECT lpad(CAST((SELECT max(seq) FROM {{daily}}) + row_number() OVER (ORDER BY seq) AS VARCHAR), 16, '0'), descr,
           CAST(12.50 AS DECIMAL(12,2)) FROM good""",
)
def _(t: Tables):
    entries = validate.validate_transaction_batch(t.spark.sql(TRANSACTION_ENTRY, daily=t.daily))
    good = entries.where(F.size("errors") == 0).withColumn("amt", F.col("amt").cast("decimal(12,2)"))
    ledger = t.daily.select("tran_id", "descr", "amt")
    return changes.add_transactions(ledger, good, ["seq"], A.max_key(t.daily).first()[0])[0]


@add(
    "add_transactions_taken",
    f"""WITH u AS ({TRANSACTION_ENTRY}),
    good AS (SELECT * FROM u WHERE NOT (acct_id = '' AND card_num = '') AND acct_id <> '12A' AND trim(descr) <> ''
             AND amt = '+00000012.50' AND cat_cd <> 'x' AND orig_date = '2023-02-28' AND proc_date = '2023-02-28'),
    placed AS (
      SELECT lpad(CAST((SELECT max(seq) FROM {{daily}}) - 10 + row_number() OVER (ORDER BY seq) AS VARCHAR), 16, '0') AS tran_id,
             descr, CAST(12.50 AS DECIMAL(12,2)) AS amt FROM good)
    SELECT * FROM placed WHERE tran_id IN (SELECT tran_id FROM {{daily}})""",
)
def _(t: Tables):
    # Ten more rows have come into the ledger since the highest id was read.
    entries = validate.validate_transaction_batch(t.spark.sql(TRANSACTION_ENTRY, daily=t.daily))
    good = entries.where(F.size("errors") == 0).withColumn("amt", F.col("amt").cast("decimal(12,2)"))
    ledger = t.daily.select("tran_id", "descr", "amt")
    return changes.add_transactions(ledger, good, ["seq"], A.max_key(t.daily).first()[0] - 10)[1]


# Changes per key in event order, on a table that has every other key.
CHANGES = """
SELECT user_id AS user_key, event_id AS seq,
  CASE event_type WHEN 'click' THEN 'U' WHEN 'view' THEN 'U' WHEN 'signup' THEN 'A' WHEN 'purchase' THEN 'D'
       ELSE CASE WHEN event_id % 2 = 0 THEN '*' ELSE 'Z' END END AS action,
  concat('v', CAST(event_id AS STRING)) AS val
FROM {events}"""
CHANGED_TABLE = "SELECT 2 * c_custkey AS user_key, c_name AS val FROM {customer}"

CHANGES_SQL = f"""
WITH ch AS ({CHANGES}), base AS ({CHANGED_TABLE}),
steps AS (SELECT *, row_number() OVER (PARTITION BY user_key ORDER BY seq) AS rn FROM ch WHERE action IN ('A', 'U', 'D')),
keys AS (SELECT user_key FROM base UNION SELECT user_key FROM steps),
walk AS (
  SELECT k.user_key, CAST(0 AS BIGINT) AS rn, b.user_key IS NOT NULL AS present, b.val, CAST(NULL AS VARCHAR) AS error,
         CAST(NULL AS BIGINT) AS seq
  FROM keys k LEFT JOIN base b ON b.user_key = k.user_key
  UNION ALL
  SELECT s.user_key, s.rn,
    CASE WHEN s.action = 'A' THEN true WHEN s.action = 'D' THEN false ELSE w.present END,
    CASE WHEN s.action = 'A' AND NOT w.present THEN s.val WHEN s.action = 'U' AND w.present THEN s.val
         WHEN s.action = 'D' THEN NULL ELSE w.val END,
    CASE WHEN s.action = 'A' AND w.present THEN 'duplicate key'
         WHEN s.action <> 'A' AND NOT w.present THEN 'no such row' END,
    s.seq
  FROM walk w JOIN steps s ON s.user_key = w.user_key AND s.rn = w.rn + 1),
final AS (SELECT *, row_number() OVER (PARTITION BY user_key ORDER BY rn DESC) AS back FROM walk)
"""


def change_job(t: Tables):
    stored = t.spark.sql(CHANGED_TABLE, customer=t.customer)
    steps = t.spark.sql(CHANGES, events=t.events)
    return changes.apply_changes(stored, steps, "user_key")


@add(
    "apply_changes",
    CHANGES_SQL + "SELECT user_key, val FROM final WHERE back = 1 AND present",
    recursive=True,
)
def _(t: Tables):
    return change_job(t)[0]


@add(
    "apply_changes_errors",
    CHANGES_SQL + """SELECT seq, user_key, error FROM walk WHERE error IS NOT NULL
       UNION ALL SELECT seq, user_key, 'type not valid' FROM ch WHERE action = 'Z'""",
    recursive=True,
)
def _(t: Tables):
    return change_job(t)[1].select("seq", "user_key", "error")


@add(
    "delete_expired",
    """SELECT acct_id, auth_ts, req_id, resp_code, tran_amt FROM {auth_detail}
       WHERE date_diff('day', CAST(auth_ts AS DATE), DATE '2024-01-20') < 5""",
)
def _(t: Tables):
    return purge.purge_auth(t.auth_summary, t.auth_detail, AUTH_ASOF).details.select(
        "acct_id", "auth_ts", "req_id", "resp_code", "tran_amt"
    )


REPLACED_SQL = """SELECT coalesce(n.k, o.k) AS acct_id, CASE WHEN n.k IS NOT NULL THEN n.bal ELSE o.bal END AS bal
       FROM (SELECT 2 * c_custkey AS k, CAST(c_acctbal AS DECIMAL(12,2)) AS bal FROM {customer}) o
       FULL JOIN (SELECT o_custkey AS k, CAST(max(o_totalprice) AS DECIMAL(12,2)) AS bal FROM {orders} GROUP BY 1) n
       ON n.k = o.k"""


def old_and_new(t: Tables):
    old = t.customer.select(
        (2 * F.col("c_custkey")).alias("acct_id"), F.col("c_acctbal").cast("decimal(12,2)").alias("bal")
    )
    new = t.orders.groupBy(F.col("o_custkey").alias("acct_id")).agg(
        F.max("o_totalprice").cast("decimal(12,2)").alias("bal")
    )
    return old, new


@add("update_or_insert", REPLACED_SQL)
def _(t: Tables):
    return changes.update_or_insert(*old_and_new(t), ["acct_id"])


@add("update_or_insert_stored", REPLACED_SQL)
def _(t: Tables):
    table, rows = old_and_new(t)
    return stored(t, table, ["acct_id"], rows, lambda old, new: changes.update_or_insert(old, new, ["acct_id"]))


@add(
    "optimistic_update",
    """SELECT acct_id, CASE WHEN acct_id % 3 <> 1 THEN 'X' ELSE active_status END AS active_status, curr_bal,
         acct_id % 3 = 1 AS conflict FROM {account}""",
)
def _(t: Tables):
    cols = ["active_status", "curr_bal"]
    stale = F.when(F.col("acct_id") % 3 == 1, F.col("curr_bal") + 1).otherwise(F.col("curr_bal"))
    updates = t.account.select(
        "acct_id",
        F.struct("active_status", stale.cast("decimal(12,2)").alias("curr_bal")).alias("before"),
        F.struct(F.lit("X").alias("active_status"), "curr_bal").alias("after"),
    )
    state, conflicts = changes.optimistic_update(t.account.select("acct_id", *cols), updates, ["acct_id"], cols)
    missed = conflicts.select("acct_id", F.lit(True).alias("conflict"))
    return state.join(missed, "acct_id", "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))


FRAUD_DATE = dt.date(2024, 2, 9)
FRAUD_COLUMNS = ["card_num", "auth_ts", "req_id", "acct_id", "tran_amt", "fraud_flag", "fraud_date"]


@add(
    "mark_fraud",
    """WITH state AS (
      SELECT card_num, auth_ts, req_id, acct_id, tran_amt, event.hit,
        CASE WHEN hit THEN CASE WHEN fraud_flag = 'F' THEN 'R' ELSE 'F' END ELSE fraud_flag END AS fraud_flag,
        CASE WHEN hit THEN DATE '2024-02-09' ELSE fraud_date END AS fraud_date
      FROM (SELECT *, resp_code <> '00' AS hit FROM {auth_detail}) event)
    SELECT card_num, auth_ts, req_id, acct_id, tran_amt, fraud_flag, fraud_date FROM state
    WHERE hit OR fraud_flag IS NOT NULL""",
)
def _(t: Tables):
    details = t.auth_detail
    fraud = details.where("fraud_flag IS NOT NULL").select(*FRAUD_COLUMNS)
    marks = details.where("resp_code <> '00'").select("card_num", "auth_ts", "req_id")
    return changes.mark_fraud(details, fraud, marks, FRAUD_DATE)[1]
