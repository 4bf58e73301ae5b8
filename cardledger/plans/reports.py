"""Transaction report with page, account and grand totals; category balance listing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import edit_amount
from cardledger.functions.text import pad_key, pad_right
from cardledger.operators.aggregates import WIDE, money_sum
from cardledger.operators.filters import filter_date_range
from cardledger.operators.joins import require_lookups, with_report_dimensions
from cardledger.operators.sequence import page_number, run_sequence

PAGE_SIZE = 20


def report_rows(tx: DataFrame, start: dt.date, end: dt.date, page_size: int = PAGE_SIZE) -> DataFrame:
    """Transactions of the period in (card, transaction) order with ``seq_no`` and ``page``.

    Numbered straight from the scan, since the lookups that follow neither drop nor add rows.  The
    numbering stores the ordered rows once; the detail lines and each kind of total read back only
    their columns.
    """
    numbered = run_sequence(filter_date_range(tx, start, end), ["card_num", "tran_id"])
    return numbered.withColumn("page", page_number(F.col("seq_no"), page_size))


def report_detail(
    rows: DataFrame, xref: DataFrame, types: DataFrame, categories: DataFrame, strict: bool = False
) -> DataFrame:
    """Report rows with account and descriptions; one with a missing card, type or category keeps
    its place with ``lookup_failed`` set, or raises when ``strict``."""
    detail = with_report_dimensions(rows, xref, types, categories)
    return require_lookups(detail) if strict else detail


def transaction_report(rows: DataFrame, detail: DataFrame) -> DataFrame:
    """Detail rows and the three kinds of totals in one result.

    ``kind`` is detail, page, account or grand; ``sort_no`` is the place of the row a total
    follows, so (sort_no, kind order) restores the printed order.
    """
    empty = F.lit(None)

    def totals(kind: str, grouped: DataFrame, card: Column, page: Column) -> DataFrame:
        return grouped.select(
            F.lit(kind).alias("kind"), "sort_no", page.cast("bigint").alias("page"),
            card.cast("string").alias("card_num"), empty.cast("string").alias("tran_id"),
            empty.cast("bigint").alias("acct_id"), empty.cast("string").alias("type_desc"),
            empty.cast("string").alias("cat_desc"), "amt",
        )

    sums = [money_sum("amt").alias("amt"), F.max("seq_no").alias("sort_no")]
    lines = detail.select(
        F.lit("detail").alias("kind"), F.col("seq_no").alias("sort_no"), "page", "card_num",
        "tran_id", "acct_id", "type_desc", "cat_desc", F.col("amt").cast(WIDE).alias("amt"),
    )
    return (
        lines.unionByName(totals("page", rows.groupBy("page").agg(*sums), empty, F.col("page")))
        .unionByName(
            totals("account", rows.groupBy("card_num").agg(*sums), F.col("card_num"), empty)
        )
        .unionByName(totals("grand", rows.agg(*sums).where("sort_no IS NOT NULL"), empty, empty))
    )


RULE = "-" * 133


def _headings(start: dt.date, end: dt.date) -> list[str]:
    # Titles and column headings of the printed report.
    title = (
        "DALYREPT".ljust(38) + "Daily Transaction Report".ljust(41) + "Date Range: "
        + f"{start.isoformat()} to {end.isoformat()}"
    )
    columns = (
        "Transaction ID".ljust(17) + "Account ID".ljust(12) + "Transaction Type".ljust(19)
        + "Tran Category".ljust(35) + "Tran Source".ljust(14) + " " + "        Amount".ljust(16)
    )
    return [title.ljust(133), " " * 133, columns.ljust(133), RULE]


def _fit(col: Column, width: int) -> Column:
    """A description in its field, cut there as the printed report does."""
    return F.rpad(F.coalesce(col, F.lit("")), width, " ")


def _key(col: Column, width: int) -> Column:
    """A key in its field; a longer one is printed whole and makes the line longer."""
    return pad_right(F.coalesce(col, F.lit("")), width)


def detail_line() -> Column:
    amount = F.col("amt")
    return pad_right(
        F.concat(
            _key(F.col("tran_id"), 16), F.lit(" "), _key(pad_key(F.col("acct_id"), 11), 11), F.lit(" "),
            _key(F.col("type_cd"), 2), F.lit("-"), _fit(F.col("type_desc"), 15), F.lit(" "),
            pad_key(F.col("cat_cd"), 4), F.lit("-"), _fit(F.col("cat_desc"), 29), F.lit(" "),
            _fit(F.col("source"), 10), F.lit("    "), edit_amount(amount, "-ZZZ,ZZZ,ZZZ.ZZ"),
        ),
        133,
    )


def _total_line(label: str, dots: int) -> Column:
    return pad_right(
        F.concat(F.lit(label + "." * dots), edit_amount(F.col("amt"), "+ZZZ,ZZZ,ZZZ.ZZ")), 133
    )


def report_lines(
    rows: DataFrame, detail: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Printed lines of 133 characters: (page, sort_no, part, line).

    Every page opens with the headings; a detail line is followed by the account total when it is
    the card's last, then by the page total when it is the page's last, then by the grand total.
    """
    heads = F.array(*[F.lit(line) for line in _headings(start, end)])
    openings = rows.groupBy("page").agg((F.min("seq_no")).alias("sort_no")).select(
        "page", "sort_no", F.posexplode(heads).alias("part", "line")
    )
    sums = [money_sum("amt").alias("amt"), F.max("seq_no").alias("sort_no"), F.max("page").alias("page")]
    # Label, number of dots, place of the line behind its detail line.
    totals = [
        (rows.groupBy("card_num").agg(*sums), "Account Total", 84, 20),
        (rows.groupBy(F.col("page").alias("_p")).agg(*sums), "Page Total ", 86, 30),
        (rows.agg(*sums).where("sort_no IS NOT NULL"), "Grand Total", 86, 40),
    ]
    out = openings.unionByName(
        detail.select("page", F.col("seq_no").alias("sort_no"), F.lit(10).alias("part"),
                      detail_line().alias("line"))
    )
    for sums_df, label, dots, part in totals:
        out = out.unionByName(
            sums_df.select("page", "sort_no", F.lit(part).alias("part"), _total_line(label, dots).alias("line"))
        )
        if part != 40:
            out = out.unionByName(
                sums_df.select("page", "sort_no", F.lit(part + 1).alias("part"), F.lit(RULE).alias("line"))
            )
    return out


def category_balance_listing(balances: DataFrame) -> DataFrame:
    """Category balances in key order with the amount printed."""
    return balances.orderBy("acct_id", "type_cd", "cat_cd").select(
        pad_key(F.col("acct_id"), 11).alias("acct_id"), "type_cd",
        pad_key(F.col("cat_cd"), 4).alias("cat_cd"),
        edit_amount(F.col("balance"), "9(9).99-").alias("balance"),
    )
