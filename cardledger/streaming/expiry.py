"""Expiry of stored authorizations by event-time timers.

The pending authorizations of a group of accounts are summed per account and day in keyed state.  The
first of a day sets a timer for the day's purge date; when the event time seen so far (the watermark)
reaches it, the day's sums leave as one row an account and the state of the day is cleared.  An authorization that arrives when its day has
already expired is not dropped as late: it leaves at once, as a row of its own sums, and is
reported in the error log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cardledger.functions.money import cents, from_cents
from cardledger.sources.error_log import append_errors, error_log
from cardledger.streaming.run import configure_state, run_batches

_DAY = T.StructType([T.StructField("day", T.DateType())])
_SUMS = ("approved_cnt", "declined_cnt", "approved_c", "declined_c")
#: The sums of a day's accounts: account, whether there is one, and the sums, 48 bytes each.
_STATE = T.StructType([T.StructField("sums", T.BinaryType())])
_KEYS = ("acct_id", "known")
#: Groups that the accounts are dealt to by hash; fixed for a checkpoint.  A key of its own for each account
#: costs some milliseconds whatever it brings.
STATE_GROUPS = 64
_OUT = T.StructType(
    [
        T.StructField("acct_id", T.LongType()), T.StructField("auth_date", T.DateType()),
        *[T.StructField(n, T.LongType()) for n in _SUMS],
        T.StructField("late_req_id", T.LongType()), T.StructField("late_ts", T.TimestampType()),
    ]
)
_EPOCH = dt.date(1970, 1, 1)


class ExpireDays(StatefulProcessor):
    """Sums of each day of a group of accounts until the day's timer."""

    def __init__(self, days: int) -> None:
        self._days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._sums = handle.getMapState("days", _DAY, _STATE)

    def _due(self, day: dt.date) -> int:
        """Milliseconds of the start of the purge date, UTC."""
        return ((day - _EPOCH).days + self._days) * 86_400_000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            expired = pdf["auth_date"].map(self._due) <= now
            if expired.any():
                late = pdf[expired]
                yield late.assign(acct_id=late["acct_id"].astype("Int64").where(late["known"] == 1), late_req_id=late["req_id"])[[f.name for f in _OUT]]
            for day, own in pdf[~expired].groupby("auth_date"):
                known = self._sums.containsKey((day,))
                held = [self._sums_of(day)] if known else []
                sums = pd.concat([*held, own[[*_KEYS, *_SUMS]]]).groupby(list(_KEYS), as_index=False).sum()
                self._sums.updateValue((day,), (sums.to_numpy(np.int64).tobytes(),))
                if not known:
                    self._handle.registerTimer(self._due(day))

    def _sums_of(self, day: dt.date) -> pd.DataFrame:
        held = np.frombuffer(self._sums.getValue((day,))[0], np.int64)
        return pd.DataFrame(held.reshape(-1, len(_KEYS) + len(_SUMS)), columns=[*_KEYS, *_SUMS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = _EPOCH + dt.timedelta(days=expiredTimerInfo.getExpiryTimeInMs() // 86_400_000 - self._days)
        if self._sums.containsKey((day,)):
            sums = self._sums_of(day)
            self._sums.removeKey((day,))
            out = sums.assign(acct_id=sums["acct_id"].astype("Int64").where(sums["known"] == 1), auth_date=day)
            out["late_req_id"] = pd.array([None] * len(out), "Int64")
            out["late_ts"] = pd.array([None] * len(out), "datetime64[us]")
            yield out[[f.name for f in _OUT]]

    def close(self) -> None:
        pass


def expired_days(details: DataFrame, days: int = 5) -> DataFrame:
    """Stream of expired sums per account and day from a stream of details; rows of late details carry
    their request."""
    configure_state(details.sparkSession)
    ok = F.col("resp_code") == "00"
    none = F.lit(0).cast("bigint")
    # The operator gets the time as a plain number and date: late rows must reach it, not be filtered.
    timed = details.withColumn("auth_ts", F.col("auth_ts").cast("timestamp")).withWatermark("auth_ts", "0 seconds")
    rows = timed.where(F.col("auth_ts").isNotNull()).select(
        F.pmod(F.xxhash64("acct_id"), F.lit(STATE_GROUPS)).alias("state_group"),
        F.coalesce("acct_id", none).alias("acct_id"), F.col("acct_id").isNotNull().cast("bigint").alias("known"), "req_id", F.to_date("auth_ts").alias("auth_date"),
        F.timestamp_micros(F.unix_micros("auth_ts")).alias("late_ts"),
        ok.cast("bigint").alias("approved_cnt"), (~ok).cast("bigint").alias("declined_cnt"),
        F.coalesce(cents(F.col("approved_amt")), none).alias("approved_c"),
        F.when(ok, none).otherwise(F.coalesce(cents(F.col("tran_amt")), none)).alias("declined_c"),
    )
    return rows.groupBy("state_group").transformWithStateInPandas(
        statefulProcessor=ExpireDays(days), outputStructType=_OUT, outputMode="Update", timeMode="EventTime"
    )


def auth_expiry_stream(details: DataFrame, store: str, checkpoint: str, days: int = 5) -> StreamingQuery:
    """Run over what is there; results are below ``store``: ``expired`` and the error log ``late``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        batch.select(
            "acct_id", "auth_date", "approved_cnt", "declined_cnt",
            from_cents(F.col("approved_c"), 18).alias("approved_amt"), from_cents(F.col("declined_c"), 18).alias("declined_amt"),
        ).write.mode("overwrite").parquet(f"{store}/expired/batch={batch_id}")
        late = batch.where(F.col("late_req_id").isNotNull())
        events = error_log(late, "EXP1", "W", "authorization older than the purge date", "late_req_id", F.col("late_ts"))
        append_errors(events, f"{store}/late", f"batch-{batch_id}")
        batch.unpersist()

    return run_batches(expired_days(details, days), write, checkpoint, "update")
