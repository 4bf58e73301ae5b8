"""Account statements per card: data, printed lines, HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import edit_amount
from cardledger.functions.text import address_line, name_line, pad_key, pad_right
from cardledger.operators.aggregates import statement_totals
from cardledger.operators.sequence import group_sequence

#: Transactions per HTML part; a statement of any length stays in bounded rows.
HTML_PART_ROWS = 500


def statements(
    xref: DataFrame, customers: DataFrame, accounts: DataFrame, tx: DataFrame
) -> DataFrame:
    """One row per card of the cross reference: name, address, balance, score, total.

    Transactions are summed per card before any join, so cards without transactions appear and a
    busy card costs nothing extra.
    """
    people = customers.select(
        "cust_id",
        name_line(F.col("first_name"), F.col("middle_name"), F.col("last_name")).alias("name"),
        "addr_line_1", "addr_line_2",
        address_line(F.col("addr_line_3"), F.col("state"), F.col("country"), F.col("zip")).alias(
            "addr_line_3"
        ),
        "fico",
    )
    return (
        statement_totals(xref, tx)
        .join(people, "cust_id", "left")
        .join(accounts.select("acct_id", "curr_bal"), "acct_id", "left")
    )


def _fit(col: Column, width: int) -> Column:
    return F.rpad(F.coalesce(col.cast("string"), F.lit("")), width, " ")


def _head_lines() -> list[Column]:
    # Texts of the statement head.
    rule = F.lit("-" * 80)

    def line(text: Column) -> Column:
        return _fit(text, 80)

    return [
        F.lit("*" * 31 + "START OF STATEMENT" + "*" * 31),
        line(F.col("name")), line(F.col("addr_line_1")), line(F.col("addr_line_2")),
        line(F.col("addr_line_3")), rule,
        F.lit(" " * 33 + "Basic Details".ljust(14) + " " * 33), rule,
        pad_right(F.concat(F.lit("Account ID         :"), pad_key(F.col("acct_id"), 11)), 80),
        line(F.concat(F.lit("Current Balance    :"),
                      edit_amount(F.coalesce("curr_bal", F.lit(0)), "9(9).99-"))),
        line(F.concat(F.lit("FICO Score         :"), pad_key(F.coalesce("fico", F.lit(0)), 3))),
        rule, F.lit(" " * 30 + "TRANSACTION SUMMARY " + " " * 30), rule,
        F.lit("Tran ID".ljust(16) + "Tran Details".ljust(51) + "  Tran Amount"), rule,
    ]


HEAD_LINES = 16


def _tail_lines() -> list[Column]:
    # Texts of the statement foot.
    return [
        F.lit("-" * 80),
        F.concat(F.lit("Total EXP:".ljust(66) + "$"), edit_amount(F.col("total_amt"), "Z(9).99-")),
        F.lit("*" * 32 + "END OF STATEMENT" + "*" * 32),
    ]


def _numbered(tx: DataFrame, xref: DataFrame) -> DataFrame:
    # Numbered straight from the scan; leaving out whole cards afterwards changes no number.
    placed = group_sequence(
        tx.select("card_num", "tran_id", "descr", "amt"), ["card_num"], ["tran_id"], "row_no"
    )
    return placed.join(xref.select("card_num"), "card_num", "left_semi")


def statement_lines(statement: DataFrame, tx: DataFrame) -> DataFrame:
    """Printed lines of 80 characters: (card_num, line_no, line).

    Lines stay rows: the number of a transaction line is its place within the card, so no task or
    row ever holds a whole statement.
    """
    head = statement.select("card_num", F.posexplode(F.array(*_head_lines())).alias("p", "line"))
    body = _numbered(tx, statement).select(
        "card_num", (F.col("row_no") + HEAD_LINES).alias("line_no"),
        F.concat(
            pad_right(F.coalesce("tran_id", F.lit("")), 16), F.lit(" "), _fit(F.col("descr"), 49), F.lit("$"),
            edit_amount(F.col("amt"), "Z(9).99-"),
        ).alias("line"),
    )
    tail = statement.select(
        "card_num", "tran_count", F.posexplode(F.array(*_tail_lines())).alias("p", "line")
    )
    return (
        head.select("card_num", (F.col("p") + 1).cast("bigint").alias("line_no"), "line")
        .unionByName(body)
        .unionByName(
            tail.select(
                "card_num", (F.col("p") + 1 + HEAD_LINES + F.col("tran_count")).alias("line_no"), "line"
            )
        )
    )


def html_text(col: Column) -> Column:
    """Escape a value for HTML."""
    out = F.coalesce(col.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


# Page frame, colours and fixed texts of the HTML statement.
_TABLE = (
    "<!DOCTYPE html>\n<html lang=\"en\">\n<head>\n<meta charset=\"utf-8\">\n"
    "<title>HTML Table Layout</title>\n</head>\n<body style=\"margin:0px;\">\n"
    "<table  align=\"center\" frame=\"box\" style=\"width:70%; font:12px Segoe UI,sans-serif;\">\n"
)
_BANK = ['<p style="font-size:16px">Bank of XYZ</p>', "<p>410 Terry Ave N</p>", "<p>Seattle WA 99999</p>"]
_END = "</table>\n</body>\n</html>"


def _band(colour: str, *lines: Column | str, centre: bool = False) -> Column:
    """One full-width table row."""
    extra = " text-align:center;" if centre else ""
    start = f'<tr>\n<td colspan="3" style="padding:0px 5px;background-color:{colour};{extra}">\n'
    parts = [F.lit(x) if isinstance(x, str) else x for x in lines]
    return F.concat(F.lit(start), F.concat_ws("\n", *parts), F.lit("\n</td>\n</tr>\n"))


def _cell(width: int, colour: str, align: str, text: Column) -> Column:
    start = (
        f'<td style="width:{width}%; padding:0px 5px; background-color:{colour}; text-align:{align};">\n'
    )
    return F.concat(F.lit(start), text, F.lit("\n</td>\n"))


def _row(colour: str, first: Column, second: Column, third: Column) -> Column:
    return F.concat(
        F.lit("<tr>\n"), _cell(25, colour, "left", first), _cell(55, colour, "left", second),
        _cell(20, colour, "right", third), F.lit("</tr>\n"),
    )


def _p(text: Column) -> Column:
    return F.concat(F.lit("<p>"), text, F.lit("</p>"))


def _big(text: str | Column) -> Column:
    inner = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit('<p style="font-size:16px">'), inner, F.lit("</p>"))


def statement_html(
    statement: DataFrame, tx: DataFrame, part_rows: int = HTML_PART_ROWS
) -> DataFrame:
    """The statement as HTML: (card_num, part_no, html); the parts in order are the document.

    Part 0 is the head, the last part the foot, and each part between holds at most ``part_rows``
    transactions.
    """
    balance = edit_amount(F.coalesce("curr_bal", F.lit(0)), "9(9).99-")
    head = F.concat(
        F.lit(_TABLE),
        _band("#1d1d96b3", F.concat(F.lit("<h3>Statement for Account Number: "),
                                    pad_key(F.col("acct_id"), 11), F.lit("</h3>"))),
        _band("#FFAF33", *_BANK),
        _band("#f2f2f2", _big(html_text(F.rtrim("name"))),
              *[_p(html_text(F.rtrim(f"addr_line_{i}"))) for i in (1, 2, 3)]),
        _band("#33FFD1", _big("Basic Details"), centre=True),
        _band("#f2f2f2", _p(F.concat(F.lit("Account ID         : "), pad_key(F.col("acct_id"), 11))),
              _p(F.concat(F.lit("Current Balance    : "), balance)),
              _p(F.concat(F.lit("FICO Score         : "), pad_key(F.coalesce("fico", F.lit(0)), 3)))),
        _band("#33FFD1", _big("Transaction Summary"), centre=True),
        _row("#33FF5E", _big("Tran ID"), _big("Tran Details"), _big("Amount")),
    )
    heads = statement.select("card_num", F.lit(0).cast("bigint").alias("part_no"), head.alias("html"))
    row = _row(
        "#f2f2f2", _p(html_text(F.col("tran_id"))), _p(html_text(F.col("descr"))),
        _p(edit_amount(F.col("amt"), "Z(9).99-")),
    )
    part = (F.floor((F.col("row_no") - 1) / part_rows) + 1).cast("bigint")
    bodies = (
        _numbered(tx, statement).select("card_num", part.alias("part_no"), "row_no", row.alias("row"))
        .groupBy("card_num", "part_no")
        .agg(F.sort_array(F.collect_list(F.struct("row_no", "row"))).alias("rows"))
        .select("card_num", "part_no", F.array_join(F.transform("rows", lambda r: r["row"]), "").alias("html"))
    )
    last = (F.ceil(F.col("tran_count") / part_rows) + 1).cast("bigint")
    foot = F.concat(_band("#1d1d96b3", "<h3>End of Statement</h3>"), F.lit(_END))
    feet = statement.select("card_num", last.alias("part_no"), foot.alias("html"))
    return heads.unionByName(bodies).unionByName(feet)
