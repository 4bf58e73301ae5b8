"""Table changes.  Each returns the new state of the table; snapshots persist it.

Plain files have no MERGE, so a change is a full outer join on the key written as a new snapshot.  A large
master is kept as ``sources.buckets.BucketTable``: its ``change`` takes these functions and rewrites the
touched buckets only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions.text import blank_to_null, pad_key
from cardledger.operators.joins import first_card
from cardledger.operators.sequence import last_before, run_sequence


def upsert_category_balance(balances: DataFrame, delta: DataFrame) -> DataFrame:
    """Add to the stored balance, or create it."""
    keys = ["acct_id", "type_cd", "cat_cd"]
    kind = balances.schema["balance"].dataType
    new = delta.select(*keys, F.col("balance").alias("_delta"))
    total = F.coalesce("balance", F.lit(0)) + F.coalesce("_delta", F.lit(0))
    return balances.select(*keys, "balance").join(new, keys, "full").select(
        *keys, total.cast(kind).alias("balance")
    )


def _with_types_of(stored: DataFrame, changed: dict[str, Column]) -> list[Column]:
    return [
        changed[c].cast(stored.schema[c].dataType).alias(c) if c in changed else F.col(c)
        for c in stored.columns
    ]


def apply_posting(accounts: DataFrame, cycle: DataFrame) -> DataFrame:
    """Balance += all posted amounts; cycle credit and debit += their part."""
    zero = F.lit(0)
    joined = accounts.join(cycle, "acct_id", "left")
    return joined.select(
        *_with_types_of(
            accounts,
            {
                "curr_bal": F.col("curr_bal") + F.coalesce("total_amt", zero),
                "cyc_credit": F.col("cyc_credit") + F.coalesce("credit_amt", zero),
                "cyc_debit": F.col("cyc_debit") + F.coalesce("debit_amt", zero),
            },
        )
    )


def apply_interest(accounts: DataFrame, totals: DataFrame) -> DataFrame:
    """Balance += interest and a new cycle, for the accounts that have a total."""
    hit = F.col("total_interest").isNotNull()
    return accounts.join(totals, "acct_id", "left").select(
        *_with_types_of(
            accounts,
            {
                "curr_bal": F.col("curr_bal") + F.coalesce("total_interest", F.lit(0)),
                "cyc_credit": F.when(hit, F.lit(0)).otherwise(F.col("cyc_credit")),
                "cyc_debit": F.when(hit, F.lit(0)).otherwise(F.col("cyc_debit")),
            },
        )
    )


def bill_payment(
    accounts: DataFrame, xref: DataFrame, highest_tran_id: int, run_ts: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Pay every positive balance in full: payment transactions and the accounts after them."""
    payable = accounts.where(F.col("curr_bal") > 0).join(first_card(xref), "acct_id")
    stamp = F.lit(run_ts).cast("timestamp")
    # Type, category, merchant and texts of a bill payment.
    numbered = run_sequence(
        payable.select("acct_id", "card_num", "curr_bal"), ["acct_id"], "_n",
        start=highest_tran_id + 1, store=True,
    )
    payments = numbered.select(
        pad_key(F.col("_n"), 16).alias("tran_id"),
        F.lit("02").alias("type_cd"), F.lit(2).alias("cat_cd"), F.lit("POS TERM").alias("source"),
        F.lit("BILL PAYMENT - ONLINE").alias("descr"), F.col("curr_bal").alias("amt"),
        F.lit(999999999).cast("bigint").alias("merchant_id"),
        F.lit("BILL PAYMENT").alias("merchant_name"), F.lit("N/A").alias("merchant_city"),
        F.lit("N/A").alias("merchant_zip"), "card_num", "acct_id",
        stamp.alias("orig_ts"), stamp.alias("proc_ts"),
    )
    paid = payable.select("acct_id", F.lit(True).alias("_paid"))
    after = accounts.join(paid, "acct_id", "left").select(
        *_with_types_of(
            accounts, {"curr_bal": F.when(F.col("_paid"), F.lit(0)).otherwise(F.col("curr_bal"))}
        )
    )
    return payments, after


def split_new_keys(
    rows: DataFrame, stored: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is new, and rows whose key is already stored."""
    used = stored.select(*keys)
    return rows.join(used, keys, "left_anti"), rows.join(used, keys, "left_semi")


def add_transactions(
    ledger: DataFrame, entries: DataFrame, order: list[str], highest_tran_id: int
) -> tuple[DataFrame, DataFrame]:
    """The ledger with entries (already validated) under the next transaction ids, in entry order,
    and the entries whose id is already taken, as it is when ``highest_tran_id`` is out of date."""
    numbered = run_sequence(entries, order, "_n", start=highest_tran_id + 1)
    rows = numbered.withColumn("tran_id", pad_key(F.col("_n"), 16))
    new, taken = split_new_keys(rows.select(*ledger.columns), ledger, ["tran_id"])
    return ledger.unionByName(new), taken


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    key: str,
    action: str = "action",
    seq: str = "seq",
    children: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply a change file: A inserts, U updates, D deletes, ``*`` is a comment.

    Changes of one key take effect in ``seq`` order.  Inserting a row that is there and updating
    or deleting one that is not are errors and change nothing; so is an unknown action.  With
    ``children`` the delete of a key that has child rows is an error too.  Returns the new table
    and the failed changes with ``error``.
    """
    values = [c for c in table.columns if c != key]
    known = F.col(action).isin("A", "U", "D")
    stored = table.select(key).withColumn("_stored", F.lit(True))
    steps = changes.where(known).join(stored, key, "left")
    blocked = F.lit(False)
    if children is not None:
        used = children.select(key).distinct().withColumn("_child", F.lit(True))
        steps = steps.join(used, key, "left")
        blocked = F.col("_child").isNotNull() & (F.col(action) == "D")
    steps = steps.withColumn("_blocked", blocked)
    # An insert leaves the row there and a delete leaves it gone whether they worked or failed,
    # so the row's presence is settled by the last of them; a blocked delete settles nothing.
    settled = F.when(~F.col("_blocked") & F.col(action).isin("A", "D"), F.col(action))
    steps = last_before(steps, [key], [seq], settled, "_settled", store=True)
    present = F.when(F.col("_settled").isNull(), F.coalesce("_stored", F.lit(False))).otherwise(
        F.col("_settled") == "A"
    )
    error = (
        F.when(F.col("_blocked") & present, "child rows exist")
        .when((F.col(action) == "A") & present, "duplicate key")
        .when((F.col(action) != "A") & ~present, "no such row")
    )
    judged = steps.withColumn("error", error)
    good = judged.where(F.col("error").isNull())
    final = good.groupBy(key).agg(
        F.max(F.struct(seq, action, *values)).alias("_last"), F.lit(True).alias("_hit")
    )
    joined = table.join(final, key, "full")
    state = joined.where(F.col("_hit").isNull() | (F.col(f"_last.{action}") != "D")).select(
        *[
            F.col(c) if c == key
            else F.when(F.col("_hit"), F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c)
            for c in table.columns
        ]
    )
    unknown = changes.where(~known & (F.col(action) != "*")).withColumn("error", F.lit("type not valid"))
    failed = judged.where(F.col("error").isNotNull()).select(*changes.columns, "error")
    return state, failed.unionByName(unknown)


def update_or_insert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows replace stored rows of the same key and are added otherwise; ``rows`` keys are unique."""
    new = rows.select(*keys, F.struct(*[c for c in table.columns if c not in keys]).alias("_new"))
    hit = F.col("_new").isNotNull()
    return table.join(new, keys, "full").select(
        *[
            F.col(c) if c in keys
            else F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in table.columns
        ]
    )


def optimistic_update(
    table: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Apply an update only when the stored row still equals the row that was read.

    ``updates`` holds ``before`` and ``after`` structs of ``columns``.  Returns the new table and
    the conflicting updates (also those whose row is gone).
    """
    new = updates.select(*keys, "before", "after")
    same = F.struct(*columns).eqNullSafe(
        F.struct(*[F.col(f"before.{c}").alias(c) for c in columns])
    )
    joined = table.join(new, keys, "left")
    apply = F.col("after").isNotNull() & same
    state = joined.select(
        *[
            F.when(apply, F.col(f"after.{c}")).otherwise(F.col(c)).alias(c) if c in columns
            else F.col(c)
            for c in table.columns
        ]
    )
    seen = table.select(*keys, *columns, F.lit(True).alias("_found"))
    found = updates.join(seen, keys, "left")
    conflicts = found.where(~(F.coalesce("_found", F.lit(False)) & same)).select(*updates.columns)
    return state, conflicts


def detect_changes(
    new: DataFrame, stored: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Add ``changed`` and ``changed_columns``: text is compared trimmed and without case."""
    old = stored.select(*keys, F.struct(*columns).alias("_old"))

    def norm(col: Column) -> Column:
        return blank_to_null(F.upper(F.trim(col.cast("string"))))

    differs = F.array_compact(
        F.array(
            *[
                F.when(~norm(F.col(c)).eqNullSafe(norm(F.col(f"_old.{c}"))), F.lit(c))
                for c in columns
            ]
        )
    )
    out = new.join(old, keys, "left").withColumn("changed_columns", differs)
    return out.withColumn("changed", F.size("changed_columns") > 0).drop("_old")


def mark_fraud(
    details: DataFrame, fraud: DataFrame, marks: DataFrame, report_date: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Toggle the fraud mark of the named authorizations and write them to the fraud table.

    ``marks`` (card_num, auth_ts, req_id) is unique.  A confirmed mark (F) becomes removed (R),
    anything else becomes confirmed.  Returns the details and the fraud table after it.
    """
    keys = ["card_num", "auth_ts", "req_id"]
    hit = marks.select(*keys).withColumn("_hit", F.lit(True))
    toggled = F.when(F.col("fraud_flag") == "F", "R").otherwise("F")
    marked = details.join(hit, keys, "left")
    state = marked.select(
        *[
            F.when(F.col("_hit"), toggled).otherwise(F.col(c)).alias(c) if c == "fraud_flag"
            else F.when(F.col("_hit"), F.lit(report_date)).otherwise(F.col(c)).alias(c)
            if c == "fraud_date"
            else F.col(c)
            for c in details.columns
        ]
    )
    rows = state.join(marks.select(*keys), keys, "left_semi").select(*fraud.columns)
    return state, update_or_insert(fraud, rows, keys)
