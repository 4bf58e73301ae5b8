"""Account extracts in three shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def _money(value: float | str) -> Column:
    return F.lit(str(value)).cast(MONEY)


def account_extract(accounts: DataFrame, default_debit: str = "2525.00") -> DataFrame:
    """Accounts with the reissue date as ``YYYYMMDD``; a zero cycle debit becomes the default."""
    return accounts.select(
        "acct_id", "active_status", "curr_bal", "credit_limit", "cash_credit_limit", "open_date",
        "expiry_date", F.date_format("reissue_date", "yyyyMMdd").alias("reissue_date"),
        "cyc_credit",
        F.when(F.col("cyc_debit") == 0, _money(default_debit)).otherwise(F.col("cyc_debit"))
        .alias("cyc_debit"),
        "group_id",
    )


# Debits of slots 1 and 2, then balance and debit of slot 3.
SLOT_DEBITS = ("1005.00", "1525.00")
SLOT_THREE = ("-1025.00", "-2500.00")


def account_array_extract(
    accounts: DataFrame, debits: tuple = SLOT_DEBITS, third: tuple = SLOT_THREE
) -> DataFrame:
    """Account id and five (balance, debit) slots; slots 4 and 5 are zero."""
    def slot(balance: Column, debit: Column) -> Column:
        return F.struct(balance.cast(MONEY).alias("balance"), debit.cast(MONEY).alias("debit"))

    zero = _money("0")
    slots = [slot(F.col("curr_bal"), _money(d)) for d in debits]
    slots += [slot(_money(third[0]), _money(third[1])), slot(zero, zero), slot(zero, zero)]
    return accounts.select("acct_id", F.array(*slots).alias("slots"))


def account_multi_layout_extract(accounts: DataFrame) -> DataFrame:
    """Two records per account: layout 1 (id, status) and layout 2 (id, balance, limit, year)."""
    none = F.lit(None)
    records = F.array(
        F.struct(
            F.lit(1).alias("layout"), F.col("active_status").alias("active_status"),
            none.cast(MONEY).alias("curr_bal"), none.cast(MONEY).alias("credit_limit"),
            none.cast("string").alias("reissue_year"),
        ),
        F.struct(
            F.lit(2).alias("layout"), none.cast("string").alias("active_status"),
            F.col("curr_bal").cast(MONEY).alias("curr_bal"),
            F.col("credit_limit").cast(MONEY).alias("credit_limit"),
            F.date_format("reissue_date", "yyyy").alias("reissue_year"),
        ),
    )
    return accounts.select("acct_id", F.inline(records))
