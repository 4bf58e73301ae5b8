"""Authorization requests as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cardledger.functions.money import cents, from_cents
from cardledger.operators.changes import update_or_insert
from cardledger.operators.headroom import walk_keys
from cardledger.plans.authorization import auth_reason, enrich
from cardledger.sources.buckets import BucketTable
from cardledger.streaming.frames import PIECE, PIECE_KEY, SortedFrames
from cardledger.streaming.run import configure_state, run_batches

_STATE = T.StructType(
    [T.StructField(n, T.LongType()) for n in
     ("credit_balance", "approved_cnt", "declined_cnt", "approved_amt", "declined_amt")]
)

#: Groups that the accounts are dealt to by hash; fixed for a checkpoint.
STATE_GROUPS = 128
_GROUP = T.StructType([T.StructField("summaries", T.BinaryType())])

_OUT = T.StructType(
    [
        T.StructField("fold_key", T.LongType()), T.StructField("req_id", T.LongType()),
        T.StructField("ts", T.TimestampType()), T.StructField("card_num", T.StringType()),
        T.StructField("auth_type", T.StringType()), T.StructField("acct_id", T.LongType()),
        T.StructField("account_found", T.BooleanType()),
        T.StructField("customer_found", T.BooleanType()),
        T.StructField("transaction_id", T.StringType()), T.StructField("auth_id_code", T.StringType()),
        T.StructField("amt_c", T.LongType()), T.StructField("limit_c", T.LongType()),
        T.StructField("cash_limit_c", T.LongType()), T.StructField("approved", T.BooleanType()),
        *[T.StructField(f"s_{f.name}", T.LongType()) for f in _STATE],
    ]
)


class DecideRequests(StatefulProcessor):
    """Keeps the summaries of a group of accounts; an account's rows of one micro-batch are taken in
    (ts, req_id) order.

    Across micro-batches arrival order counts, as for a queue.  A group's rows come as frames of an
    Arrow batch's size and are decided frame by frame, all accounts at once; those of a group with many
    frames are sorted by way of the state, so the rows held in memory are bounded however many it
    brings.  The summaries are one value of 48 bytes an account, read and written once a micro-batch: a
    key of its own for each account costs some milliseconds whatever it brings.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._summaries = handle.getValueState("summaries", _GROUP)
        self._pieces = handle.getMapState("pieces", PIECE_KEY, PIECE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._summaries.get() if self._summaries.exists() else (b"",)
        known = np.frombuffer(held[0], np.int64).reshape(-1, 1 + len(_STATE))
        for pdf in SortedFrames(self._pieces, ["fold_key", "ts", "req_id"]).take(rows):
            out, known = self._decide(pdf, known)
            yield out
        self._summaries.update((known.tobytes(),))

    @staticmethod
    def _decide(pdf: pd.DataFrame, known: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        """Decisions of the next rows, and the summaries behind them: account and sums, by account."""
        keys = pdf["fold_key"].to_numpy(np.int64)
        begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        own = keys[begins]
        of = np.repeat(np.arange(len(own)), np.diff(np.append(begins, len(keys))))
        seen = np.isin(own, known[:, 0])
        before = np.zeros((len(own), len(_STATE)), np.int64)
        before[seen] = known[np.searchsorted(known[:, 0], own[seen]), 1:]
        amt, found = pdf["amt_c"].to_numpy(), pdf["account_found"].to_numpy(dtype=bool)
        # The headroom is what the limit leaves of the balance; limits are put on the amounts' side.
        gate = amt - pdf["limit_c"].to_numpy()
        fresh = begins[~seen]  # the first request is held against the account's own balance
        gate[fresh] += pdf["balance_c"].to_numpy()[fresh]
        flags = walk_keys(keys, -before[of, 0], gate, amt, found)
        taken, left = np.where(flags, amt, 0), np.where(flags, 0, amt)
        steps = np.column_stack([taken, flags, ~flags, taken, left])
        sums = steps.cumsum(axis=0)
        after = before[of] + sums - (sums - steps)[begins][of]
        out = pdf[[f.name for f in _OUT.fields if f.name in pdf.columns]].copy()
        out["approved"] = flags
        for f, column in zip(_STATE, after.T):
            out[f"s_{f.name}"] = column
        kept = own >= 0  # an unknown card has no summary
        ends = np.append(begins[1:], len(keys)) - 1
        new = np.column_stack([own, after[ends]])[kept]
        known = np.concatenate([known[~np.isin(known[:, 0], own)], new])
        return out, known[known[:, 0].argsort()]

    def close(self) -> None:
        pass


def auth_enrich_stream(requests: DataFrame, xref: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Stream of requests with what is known of card, account and customer (stream-static joins)."""
    return enrich(requests, xref, accounts, customers)


def auth_decide_stream(
    requests: DataFrame, xref: DataFrame, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    """Stream of decisions; the summary after each decision travels along as ``s_*`` columns.

    ``transaction_id`` and ``auth_id_code`` of the requests, if there, go through to the replies.
    """
    configure_state(requests.sparkSession)
    zero = F.lit(0).cast("bigint")
    given = {
        c: (F.col(c) if c in requests.columns else F.lit(None).cast("string")).alias(c)
        for c in ("transaction_id", "auth_id_code")
    }
    key = F.coalesce("fold_key", F.lit(-1).cast("bigint"))
    rows = enrich(requests, xref, accounts, customers).select(
        F.pmod(F.xxhash64(key), F.lit(STATE_GROUPS)).alias("state_group"), key.alias("fold_key"), "req_id", "ts", "card_num", "auth_type", "acct_id", "account_found",
        "customer_found", *given.values(), F.coalesce(cents(F.col("amt")), zero).alias("amt_c"),
        F.coalesce(cents(F.col("credit_limit")), zero).alias("limit_c"),
        F.coalesce(cents(F.col("cash_credit_limit")), zero).alias("cash_limit_c"),
        F.coalesce(cents(F.col("curr_bal")), zero).alias("balance_c"),
    )
    decided = rows.groupBy("state_group").transformWithStateInPandas(
        statefulProcessor=DecideRequests(), outputStructType=_OUT, outputMode="Update", timeMode="None"
    )
    card_found = F.col("acct_id").isNotNull()
    money = {f.name: from_cents(F.col(f"s_{f.name}")) for f in _STATE if not f.name.endswith("_cnt")}
    return decided.select(
        "req_id", "ts", "card_num", "auth_type", "acct_id", "transaction_id", "auth_id_code",
        from_cents(F.col("amt_c")).alias("amt"),
        F.when(F.col("approved"), "00").otherwise("05").alias("resp_code"),
        auth_reason(
            F.col("approved"), card_found, F.col("account_found"), F.col("customer_found"),
            F.col("account_found"),
        ).alias("resp_reason"),
        from_cents(F.when(F.col("approved"), F.col("amt_c")).otherwise(0)).alias("approved_amt"),
        F.when(F.col("account_found"), from_cents(F.col("limit_c"))).alias("credit_limit"),
        F.when(F.col("account_found"), from_cents(F.col("cash_limit_c"))).alias("cash_limit"),
        *[c.alias(f"s_{n}") for n, c in money.items()], "s_approved_cnt", "s_declined_cnt",
    )


def latest_summaries(decisions: DataFrame) -> DataFrame:
    """Current summary per account from the decisions written so far.

    Every decision raises one of the two counters, so the highest sum of them is the latest.
    """
    names = ["credit_limit", "cash_limit", "s_credit_balance", "s_approved_cnt", "s_declined_cnt",
             "s_approved_amt", "s_declined_amt"]
    last = decisions.where(F.col("acct_id").isNotNull()).groupBy("acct_id").agg(
        F.max_by(F.struct(*names), F.col("s_approved_cnt") + F.col("s_declined_cnt")).alias("_s")
    )
    return last.select("acct_id", *[F.col(f"_s.{n}").alias(n.removeprefix("s_")) for n in names])


def auth_detail_stream(decisions: DataFrame) -> DataFrame:
    """Rows for the detail store; an unknown card stores nothing."""
    return decisions.where(F.col("acct_id").isNotNull()).select(
        "acct_id", F.col("ts").alias("auth_ts"), "req_id", "card_num", "auth_type", "resp_code",
        "resp_reason", F.col("amt").alias("tran_amt"), "approved_amt",
        F.when(F.col("resp_code") == "00", "P").otherwise("D").alias("match_status"),
    )


#: Buckets of the stored summaries: one for about every million accounts.
SUMMARY_BUCKETS = 32


def _summary_table(store: str, buckets: int) -> BucketTable:
    return BucketTable(f"{store}/summaries", ("acct_id",), buckets)


def auth_store_stream(
    decided: DataFrame, store: str, checkpoint: str, buckets: int = SUMMARY_BUCKETS
) -> StreamingQuery:
    """Run the decisions into a store, batch by batch: ``decisions``, ``details`` and ``summaries``.

    A batch writes its decisions and details into folders of its own and rewrites the hash buckets of
    the summaries that its accounts fall into; so its cost follows the batch, not the history or the
    number of accounts, and a repeated batch writes the same again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{store}/decisions/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        written = spark.read.schema(batch.schema).parquet(path)
        auth_detail_stream(written).write.mode("overwrite").parquet(f"{store}/details/batch={batch_id}")
        _summary_table(store, buckets).change(
            latest_summaries(written), lambda old, new: update_or_insert(old, new, ["acct_id"]), batch_id
        )

    return run_batches(decided, write, checkpoint, "update")


def stored_summaries(spark: SparkSession, store: str, buckets: int = SUMMARY_BUCKETS) -> DataFrame:
    """The summaries after the last batch."""
    return _summary_table(store, buckets).read(spark)
