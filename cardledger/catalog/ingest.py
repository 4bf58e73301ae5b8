"""Scans, sources, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger import schemas as S
from cardledger.catalog.registry import AUTH_SQL, DECIDED_SQL, RUN_TS, Registry, Tables, edited
from cardledger.functions import decode
from cardledger.plans import authorization as AU
from cardledger.plans import posting, reports, statements
from cardledger.session import scratch_path
from cardledger.sources import (
    binary, error_log as EL, exchange, extracts, fixed_width, hierarchy, load, messages, records, seeds, snapshots,
)
from cardledger.catalog.rows import REPORT_END, REPORT_SQL, REPORT_START, report_detail, report_rows

REGISTRY = Registry()
add = REGISTRY.add

ACCOUNT_COLUMNS = (
    "acct_id, active_status, curr_bal, credit_limit, cash_credit_limit, open_date, expiry_date, "
    "reissue_date, cyc_credit, cyc_debit, zip, group_id"
)


@add("scan_fixed_width", f"SELECT {ACCOUNT_COLUMNS} FROM {{account}}")
def _(t: Tables):
    path = scratch_path(t.spark, "account-file")
    fixed_width.write_lines(fixed_width.render_lines(t.account, S.ACCOUNT_FILE), path)
    good, _ = fixed_width.split_quarantine(fixed_width.scan_fixed_width(t.spark, path, S.ACCOUNT_FILE))
    return good


@add(
    "load_replace",
    """SELECT l_orderkey, l_linenumber, min(CAST(l_extendedprice AS DECIMAL(12,2))) AS price
       FROM {lineitem} GROUP BY 1, 2""",
)
def _(t: Tables):
    return _priced_lines(t)[0]


@add(
    "load_refused",
    """SELECT l_orderkey, l_linenumber, price FROM (
         SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY CAST(l_extendedprice AS DECIMAL(12,2))) AS n FROM {lineitem})
       WHERE n > 1""",
)
def _(t: Tables):
    return _priced_lines(t)[1]


def _priced_lines(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    return load.load_replace(rows, ["l_orderkey", "l_linenumber"])


@add("snapshot_write", "SELECT card_num, cust_id, acct_id FROM {xref}")
def _(t: Tables):
    root = scratch_path(t.spark, "xref-snapshots")
    snapshots.snapshot_write(t.xref.withColumn("acct_id", F.lit(0).cast("bigint")), root, keep=2)
    snapshots.snapshot_write(t.xref, root, keep=2)
    return snapshots.snapshot_read(t.spark, root)


def exchange_tables(t: Tables) -> dict:
    return {
        "customer": t.customer_master, "account": t.account, "xref": t.xref,
        "transaction": t.daily, "card": t.card,
    }


EXPORT_SQL = """
WITH parts AS (
  SELECT 'C' AS rec_type, 0 AS place, lpad(CAST(cust_id AS VARCHAR), 20, '0') AS k FROM {customer_master}
  UNION ALL SELECT 'A', 1, lpad(CAST(acct_id AS VARCHAR), 20, '0') FROM {account}
  UNION ALL SELECT 'X', 2, lpad(card_num, 20, '0') FROM {xref}
  UNION ALL SELECT 'T', 3, lpad(tran_id, 20, '0') FROM {daily}
  UNION ALL SELECT 'D', 4, lpad(card_num, 20, '0') FROM {card})
"""


@add(
    "export_union",
    EXPORT_SQL + """SELECT rec_type, '2001-09-01-12.30.15.000000' AS run_ts,
       row_number() OVER (ORDER BY place, k) AS seq_num, '0001' AS branch_id, 'NORTH' AS region_code,
       k AS record_key FROM parts""",
)
def _(t: Tables):
    out = exchange.export_union(exchange_tables(t), RUN_TS)
    key = F.coalesce(
        F.col("customer.cust_id").cast("string"), F.col("account.acct_id").cast("string"),
        F.col("xref.card_num"), F.col("transaction.tran_id"), F.col("card.card_num"),
    )
    return out.select(
        "rec_type", "run_ts", "seq_num", "branch_id", "region_code",
        F.lpad(key, 20, "0").alias("record_key"),
    )


@add(
    "import_split",
    """SELECT tran_id, seq, type_cd, cat_cd, source, descr, amt, card_num, orig_date, proc_date
       FROM {daily}""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "exchange")
    exchange.write_export(exchange.export_union(exchange_tables(t), RUN_TS), path)
    return exchange.import_split(t.spark.read.parquet(path))["transaction"]


def _register_split(name: str, table: str) -> None:
    @add(f"import_split_{name}", f"SELECT * FROM {{{table}}}")
    def _(t: Tables):
        path = scratch_path(t.spark, "exchange")
        exchange.write_export(exchange.export_union(exchange_tables(t), RUN_TS), path)
        return exchange.import_split(t.spark.read.parquet(path))[name]


for _name, _table in {"customer": "customer_master", "account": "account", "xref": "xref", "card": "card"}.items():
    _register_split(_name, _table)


@add(
    "import_split_errors",
    EXPORT_SQL + """SELECT rec_type, seq_num, 'Unknown record type encountered' AS message,
       concat('2001-09-01-12.30.15.000000|Z|', repeat('0', greatest(0, 7 - length(CAST(seq_num AS VARCHAR)))), seq_num,
              '|', rpad('Unknown record type encountered', 50, ' ')) AS line
     FROM (SELECT CASE rec_type WHEN 'A' THEN 'Z' ELSE rec_type END AS rec_type,
                  row_number() OVER (ORDER BY place, k) AS seq_num FROM parts) WHERE rec_type = 'Z'""",
)
def _(t: Tables):
    # Account records come with a tag that no table has.
    tag = F.when(F.col("rec_type") == "A", "Z").otherwise(F.col("rec_type"))
    export = exchange.export_union(exchange_tables(t), RUN_TS).withColumn("rec_type", tag)
    return exchange.import_split(export)["errors"].select("rec_type", "seq_num", "message", "line")


@add("import_records", f"SELECT {ACCOUNT_COLUMNS} FROM {{account}}")
def _(t: Tables):
    export = exchange.export_union({"account": t.account, "card": t.card}, RUN_TS)
    raw = records.export_records(export, "account").unionByName(records.export_records(export, "card"))
    return records.import_records(raw)["account"]


@add(
    "import_records_ebcdic",
    "SELECT card_num, acct_id, cvv, embossed_name, expiry_date, active_status FROM {card}",
)
def _(t: Tables):
    export = exchange.export_union({"card": t.card}, RUN_TS)
    raw = records.export_records(export, "card", charset="cp037")
    return records.import_records(raw, charset="cp037")["card"]


@add(
    "auth_segments",
    """SELECT acct_id, CAST(credit_limit AS DECIMAL(11,2)) AS credit_limit,
       CAST(credit_balance AS DECIMAL(11,2)) AS credit_balance, approved_cnt, declined_cnt,
       CAST(approved_amt AS DECIMAL(11,2)) AS approved_amt FROM {auth_summary}""",
)
def _(t: Tables):
    layout = records.AUTH_SUMMARY_SEGMENT
    have = t.auth_summary
    full = have.select(*have.columns, *[
        F.lit(None).alias(f.name) for f in layout.fields if f.name not in have.columns
    ])
    raw = full.select(records.render_records(full, layout).alias("record"))
    return records.parse_records(raw, layout).select(
        "acct_id", "credit_limit", "credit_balance", "approved_cnt", "declined_cnt", "approved_amt"
    )


@add(
    "auth_detail_file",
    """SELECT acct_id, strftime(auth_ts, '%y%m%d') AS orig_date, strftime(auth_ts, '%H%M%S') AS orig_time, card_num,
       left(auth_type, 4) AS auth_type, resp_code, resp_reason, tran_amt, approved_amt, match_status, fraud_flag
       FROM {auth_detail}""",
)
def _(t: Tables):
    """Authorization details unloaded with their account in front, and read from the files."""
    layout = records.AUTH_DETAIL_SEGMENT
    have = t.auth_detail.select(
        "acct_id", F.date_format("auth_ts", "yyMMdd").alias("orig_date"), F.date_format("auth_ts", "HHmmss").alias("orig_time"),
        "card_num", F.substring("auth_type", 1, 4).alias("auth_type"), "resp_code", "resp_reason", "tran_amt", "approved_amt",
        "match_status", "fraud_flag",
    )
    full = have.select("*", *[F.lit(None).alias(f.name) for f in layout.fields if f.name not in have.columns])
    key = decode.encode_packed(F.col("acct_id"), 11, 0)
    path = scratch_path(t.spark, "auth-details")
    length = 6 + layout.length
    binary.write_binary(full.select(F.concat(key, records.render_records(full, layout)).alias("record")), path, length)
    read = binary.scan_binary(t.spark, path, length)
    account = decode.decode_packed(F.substring("record", 1, 6), 0).cast("bigint").alias("acct_id")
    parsed = records.parse_records(read.select(account, "record"), layout, base=6, keep=["acct_id"])
    money = {c: F.col(c).cast("decimal(12,2)") for c in ("tran_amt", "approved_amt")}
    return parsed.withColumns(money).select(have.columns)


@add(
    "reject_sink",
    DECIDED_SQL + """SELECT *, CASE reason WHEN 100 THEN 'INVALID CARD NUMBER FOUND'
         WHEN 101 THEN 'ACCOUNT RECORD NOT FOUND' WHEN 102 THEN 'OVERLIMIT TRANSACTION'
         ELSE 'TRANSACTION RECEIVED AFTER ACCT EXPIRATION' END AS reason_text
       FROM decided WHERE reason <> 0""",
    recursive=True,
)
def _(t: Tables):
    return posting.reject_rows(posting.decide(t.daily, t.xref, t.account))


@add(
    "account_extract",
    """SELECT acct_id, active_status, curr_bal, credit_limit, cash_credit_limit, open_date, expiry_date,
       strftime(reissue_date, '%Y%m%d') AS reissue_date, cyc_credit,
       CAST(CASE WHEN cyc_debit = 0 THEN 2525.00 ELSE cyc_debit END AS DECIMAL(12,2)) AS cyc_debit,
       group_id FROM {account}""",
)
def _(t: Tables):
    return extracts.account_extract(t.account)


@add(
    "account_array_extract",
    """SELECT acct_id, CAST(s AS INT) AS slot,
       CAST(CASE s WHEN 1 THEN curr_bal WHEN 2 THEN curr_bal WHEN 3 THEN -1025 ELSE 0 END AS DECIMAL(12,2)) AS balance,
       CAST(CASE s WHEN 1 THEN 1005 WHEN 2 THEN 1525 WHEN 3 THEN -2500 ELSE 0 END AS DECIMAL(12,2)) AS debit
       FROM {account}, (SELECT unnest([1, 2, 3, 4, 5]) AS s)""",
)
def _(t: Tables):
    slots = extracts.account_array_extract(t.account).select("acct_id", F.posexplode("slots").alias("p", "s"))
    return slots.select("acct_id", (F.col("p") + 1).alias("slot"), "s.balance", "s.debit")


@add(
    "account_multi_layout_extract",
    """SELECT acct_id, 1 AS layout, active_status, CAST(NULL AS DECIMAL(12,2)) AS curr_bal,
       CAST(NULL AS DECIMAL(12,2)) AS credit_limit, CAST(NULL AS VARCHAR) AS reissue_year FROM {account}
       UNION ALL SELECT acct_id, 2, NULL, curr_bal, credit_limit, strftime(reissue_date, '%Y') FROM {account}""",
)
def _(t: Tables):
    return extracts.account_multi_layout_extract(t.account)


@add(
    "reftable_unload",
    """SELECT rpad(concat(lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey AS VARCHAR), 4, '0'),
            rpad(concat(r_name, ': ', n_name), 50, ' ')), 60, '0') AS line
       FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("type_cd"), F.col("n_nationkey").alias("cat_cd"),
        F.concat("r_name", F.lit(": "), "n_name").alias("cat_desc"),
    )
    return fixed_width.reftable_unload(named, S.TRAN_CATEGORY_FILE, ["type_cd", "cat_cd"])


_SEED = " UNION ALL ".join(
    f"SELECT '{c}' AS type_cd, '{d}' AS type_desc" for c, d in seeds.TRAN_TYPES
)


@add(
    "reftable_seed",
    f"""SELECT s.type_cd, s.type_desc, count(d.tran_id) AS uses FROM ({_SEED}) s
        LEFT JOIN {{daily}} d ON d.type_cd = s.type_cd GROUP BY 1, 2""",
)
def _(t: Tables):
    uses = t.daily.groupBy("type_cd").agg(F.count("*").alias("_n"))
    return seeds.type_seed(t.spark).join(uses, "type_cd", "left").select(
        "type_cd", "type_desc", F.coalesce("_n", F.lit(0)).alias("uses")
    )


@add(
    "hier_unload",
    """SELECT d.acct_id AS root_key, auth_ts, req_id, card_num, resp_code, tran_amt
       FROM {auth_detail} d WHERE d.acct_id IN (SELECT acct_id FROM {account})""",
)
def _(t: Tables):
    roots = t.account.select("acct_id", "credit_limit")
    rows = t.auth_detail.select("acct_id", "auth_ts", "req_id", "card_num", "resp_code", "tran_amt")
    return hierarchy.hier_unload(roots, rows)[1]


@add(
    "hier_load",
    """SELECT l_orderkey AS acct_id, l_linenumber AS line_no, min(CAST(l_extendedprice AS DECIMAL(12,2))) AS price,
              l_orderkey NOT IN (SELECT o_orderkey + o_orderkey // 2 FROM {orders}) AS orphan
       FROM {lineitem} GROUP BY 1, 2, 4""",
)
def _(t: Tables):
    # Keys spread out, so that every third line has no root.
    roots = t.orders.selectExpr("o_orderkey + o_orderkey div 2 AS acct_id", "o_orderdate")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("acct_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )
    _, good, orphans = hierarchy.hier_load(roots, lines, ["line_no"])
    return good.withColumn("orphan", F.lit(False)).unionByName(orphans.withColumn("orphan", F.lit(True)))


def request_lines(t: Tables):
    """Request lines written from the requests, two of their amounts in odd spellings."""
    amount = (
        F.when(F.col("req_id") % 3 == 0, F.concat(F.lit(" $ "), F.col("amt").cast("string")))
        .when(F.col("req_id") % 7 == 0, F.concat(F.col("amt").cast("string"), F.lit("-")))
        .otherwise(F.concat(F.lit("+"), F.lpad(F.col("amt").cast("string"), 13, "0")))
    )
    id_text = F.lpad(F.col("req_id").cast("string"), 15, "0")
    return t.auth_request.select(
        "req_id",
        F.concat_ws(
            ",", F.date_format("ts", "yyMMdd"), F.date_format("ts", "HHmmss"), "card_num",
            "auth_type", F.lit("0127"), F.lit("0100"), F.lit("POS"), F.lit("000000"),
            amount, F.lit("5411"), F.lit("840"), F.lit("05"), F.lit("MERCHANT"), F.lit("SHOP"),
            F.lit("TOWN"), F.lit("TX"), F.lit("75001"), id_text,
        ).alias("value"),
    )


@add(
    "auth_request_source",
    """SELECT req_id, strftime(ts, '%y%m%d') AS auth_date, strftime(ts, '%H%M%S') AS auth_time, card_num,
       auth_type, '5411' AS merchant_category_code,
       '05' AS pos_entry_mode, 'TX' AS merchant_state, lpad(CAST(req_id AS VARCHAR), 15, '0') AS transaction_id,
       CAST(CASE WHEN req_id % 3 <> 0 AND req_id % 7 = 0 THEN -amt ELSE amt END AS DECIMAL(12,2)) AS amt
       FROM {auth_request}""",
)
def _(t: Tables):
    return messages.auth_request_source(request_lines(t)).select(
        "req_id", "auth_date", "auth_time", "card_num", "auth_type", "merchant_category_code",
        "pos_entry_mode", "merchant_state", "transaction_id", "amt",
    )


REPLY_SQL = AUTH_SQL + f"""SELECT req_id AS correlation_id, concat(rpad(card_num, 16, ' '), ',',
       rpad(lpad(CAST(req_id AS VARCHAR), 15, '0'), 15, ' '), ',', strftime(ts, '%H%M%S'), ',',
       resp_code, ',', resp_reason, ',', {edited('approved_amt', '+9(10).99')}, ',') AS value FROM decided"""


@add("auth_reply_sink", REPLY_SQL, recursive=True)
def _(t: Tables):
    decided = AU.decide(t.auth_request, t.xref, t.auth_account, t.customer_master)
    return messages.auth_reply_lines(
        decided.withColumn("transaction_id", F.lpad(F.col("req_id").cast("string"), 15, "0"))
        .withColumn("auth_id_code", F.date_format("ts", "HHmmss"))
    )


STATEMENT_SQL = """
WITH sums AS (SELECT card_num, sum(amt) AS s, count(*) AS n FROM {daily} GROUP BY card_num),
stmt AS (
  SELECT x.card_num, x.cust_id, x.acct_id, CAST(coalesce(s.s, 0) AS DECIMAL(18,2)) AS total_amt,
    coalesce(s.n, 0) AS tran_count,
    concat(c.first_name, ' ', split_part(c.middle_name, ' ', 1), ' ', c.last_name, ' ') AS name,
    c.addr_line_1, c.addr_line_2,
    concat(split_part(c.addr_line_3, ' ', 1), ' ', c.state, ' ', c.country, ' ', c.zip, ' ') AS addr_line_3, c.fico, a.curr_bal
  FROM {xref} x LEFT JOIN sums s ON s.card_num = x.card_num
       LEFT JOIN {customer_master} c ON c.cust_id = x.cust_id
       LEFT JOIN {account} a ON a.acct_id = x.acct_id)
"""


def printed(key: str, width: int) -> str:
    """A key followed by as many blanks as its field has left; never cut."""
    return f"({key} || repeat(' ', greatest({width} - length({key}), 0)))"


def counted(key: str, width: int) -> str:
    """A number behind as many zeros as its field has left; never cut."""
    return f"(repeat('0', greatest({width} - length(CAST({key} AS VARCHAR)), 0)) || CAST({key} AS VARCHAR))"


_LINES = [
    "repeat('*', 31) || 'START OF STATEMENT' || repeat('*', 31)",
    "rpad(name, 80, ' ')", "rpad(addr_line_1, 80, ' ')", "rpad(addr_line_2, 80, ' ')",
    "rpad(addr_line_3, 80, ' ')", "repeat('-', 80)",
    "repeat(' ', 33) || 'Basic Details ' || repeat(' ', 33)", "repeat('-', 80)",
    printed(f"('Account ID         :' || {counted('acct_id', 11)})", 80),
    f"rpad('Current Balance    :' || {edited('coalesce(curr_bal, 0)', '9(9).99-')}, 80, ' ')",
    "rpad('FICO Score         :' || lpad(CAST(fico AS VARCHAR), 3, '0'), 80, ' ')",
    "repeat('-', 80)", "repeat(' ', 30) || 'TRANSACTION SUMMARY ' || repeat(' ', 30)",
    "repeat('-', 80)", "rpad('Tran ID', 16, ' ') || rpad('Tran Details', 51, ' ') || '  Tran Amount'",
    "repeat('-', 80)",
]
_HEAD_SQL = " UNION ALL ".join(
    f"SELECT card_num, CAST({i} AS BIGINT) AS line_no, {e} AS line FROM stmt"
    for i, e in enumerate(_LINES, 1)
)
_FOOT = [
    "repeat('-', 80)",
    f"rpad('Total EXP:', 66, ' ') || '$' || {edited('total_amt', 'Z(9).99-')}",
    "repeat('*', 32) || 'END OF STATEMENT' || repeat('*', 32)",
]
_FOOT_SQL = " UNION ALL ".join(
    f"SELECT card_num, 16 + tran_count + {i}, {e} FROM stmt" for i, e in enumerate(_FOOT, 1)
)


def statement_rows(t: Tables):
    return statements.statements(t.xref, t.customer_master, t.account, t.daily)


@add(
    "statement_lines",
    STATEMENT_SQL + f"""SELECT * FROM ({_HEAD_SQL} UNION ALL
      SELECT d.card_num, 16 + row_number() OVER (PARTITION BY d.card_num ORDER BY d.tran_id),
        {printed('d.tran_id', 16)} || ' ' || rpad(d.descr, 49, ' ') || '$' || {edited('d.amt', 'Z(9).99-')}
      FROM {{daily}} d WHERE d.card_num IN (SELECT card_num FROM xref)
      UNION ALL {_FOOT_SQL})""",
)
def _(t: Tables):
    return statements.statement_lines(statement_rows(t), t.daily)


def _sql_band(colour: str, inner: str, centre: bool = False) -> str:
    extra = " text-align:center;" if centre else ""
    return (
        f"'<tr>\n<td colspan=\"3\" style=\"padding:0px 5px;background-color:{colour};{extra}\">\n' || "
        f"{inner} || '\n</td>\n</tr>\n'"
    )


def _sql_row(colour: str, cells: list[str]) -> str:
    kinds = [(25, "left"), (55, "left"), (20, "right")]
    parts = " || ".join(
        f"'<td style=\"width:{w}%; padding:0px 5px; background-color:{colour}; text-align:{a};\">\n' || {c} || '\n</td>\n'"
        for (w, a), c in zip(kinds, cells)
    )
    return f"'<tr>\n' || {parts} || '</tr>\n'"


def _big(x: str) -> str:
    return f"'<p style=\"font-size:16px\">' || {x} || '</p>'"


def _par(x: str) -> str:
    return f"'<p>' || {x} || '</p>'"


_NL = " || '\n' || "
_HTML_HEAD = " || ".join(
    [
        "'<!DOCTYPE html>\n<html lang=\"en\">\n<head>\n<meta charset=\"utf-8\">\n<title>HTML Table Layout</title>\n"
        "</head>\n<body style=\"margin:0px;\">\n<table  align=\"center\" frame=\"box\" "
        "style=\"width:70%; font:12px Segoe UI,sans-serif;\">\n'",
        _sql_band("#1d1d96b3", "'<h3>Statement for Account Number: ' || lpad(CAST(acct_id AS VARCHAR), 11, '0') || '</h3>'"),
        _sql_band("#FFAF33", _NL.join([_big("'Bank of XYZ'"), "'<p>410 Terry Ave N</p>'", "'<p>Seattle WA 99999</p>'"])),
        _sql_band("#f2f2f2", _NL.join([_big("rtrim(name)"), _par("rtrim(addr_line_1)"), _par("rtrim(addr_line_2)"), _par("rtrim(addr_line_3)")])),
        _sql_band("#33FFD1", _big("'Basic Details'"), True),
        _sql_band("#f2f2f2", _NL.join([
            _par("'Account ID         : ' || lpad(CAST(acct_id AS VARCHAR), 11, '0')"),
            _par(f"'Current Balance    : ' || {edited('coalesce(curr_bal, 0)', '9(9).99-')}"),
            _par("'FICO Score         : ' || lpad(CAST(fico AS VARCHAR), 3, '0')")])),
        _sql_band("#33FFD1", _big("'Transaction Summary'"), True),
        _sql_row("#33FF5E", [_big("'Tran ID'"), _big("'Tran Details'"), _big("'Amount'")]),
    ]
)
_HTML_ROW = _sql_row("#f2f2f2", [_par("d.tran_id"), _par("d.descr"), _par(edited("d.amt", "Z(9).99-"))])
_HTML_FOOT = _sql_band("#1d1d96b3", "'<h3>End of Statement</h3>'") + " || '</table>\n</body>\n</html>'"


@add(
    "statement_html",
    STATEMENT_SQL + f""", body AS (
      SELECT d.card_num, d.tran_id, {_HTML_ROW} AS r,
             row_number() OVER (PARTITION BY d.card_num ORDER BY d.tran_id) AS n
      FROM {{daily}} d WHERE d.card_num IN (SELECT card_num FROM xref))
    SELECT card_num, CAST(0 AS BIGINT) AS part_no, {_HTML_HEAD} AS html FROM stmt
    UNION ALL SELECT card_num, (n - 1) // 500 + 1, string_agg(r, '' ORDER BY n) FROM body GROUP BY 1, 2
    UNION ALL SELECT card_num, (tran_count + 499) // 500 + 1, {_HTML_FOOT} FROM stmt""",
)
def _(t: Tables):
    return statements.statement_html(statement_rows(t), t.daily)


_TITLE = (
    "DALYREPT".ljust(38) + "Daily Transaction Report".ljust(41) + "Date Range: "
    + f"{REPORT_START.isoformat()} to {REPORT_END.isoformat()}"
).ljust(133)
_COLUMNS = (
    "Transaction ID".ljust(17) + "Account ID".ljust(12) + "Transaction Type".ljust(19)
    + "Tran Category".ljust(35) + "Tran Source".ljust(14) + " " + "        Amount"
).ljust(133)
_DETAIL = printed(
    f"({printed('tran_id', 16)} || ' ' || coalesce({counted('acct_id', 11)}, repeat(' ', 11)) || ' ' || "
    "type_cd || '-' || rpad(type_desc, 15, ' ') || ' ' || lpad(CAST(cat_cd AS VARCHAR), 4, '0') || '-' || "
    "rpad(coalesce(cat_desc, ''), 29, ' ') || ' ' || rpad(source, 10, ' ') || '    ' || "
    + edited("amt", "-ZZZ,ZZZ,ZZZ.ZZ") + ")", 133
)


def _sql_total(label: str, dots: int) -> str:
    return f"rpad('{label}' || repeat('.', {dots}) || {edited('total', '+ZZZ,ZZZ,ZZZ.ZZ')}, 133, ' ')"


@add(
    "report_lines",
    REPORT_SQL + f""",
    heads AS (SELECT page, min(seq_no) AS sort_no FROM detail GROUP BY page),
    cards AS (SELECT max(page) AS page, max(seq_no) AS sort_no, CAST(sum(amt) AS DECIMAL(18,2)) AS total FROM detail GROUP BY card_num),
    pages AS (SELECT page, max(seq_no) AS sort_no, CAST(sum(amt) AS DECIMAL(18,2)) AS total FROM detail GROUP BY page),
    grand AS (SELECT max(page) AS page, max(seq_no) AS sort_no, CAST(sum(amt) AS DECIMAL(18,2)) AS total FROM detail)
    SELECT page, sort_no, 0 AS part, '{_TITLE}' AS line FROM heads
    UNION ALL SELECT page, sort_no, 1, repeat(' ', 133) FROM heads
    UNION ALL SELECT page, sort_no, 2, '{_COLUMNS}' FROM heads
    UNION ALL SELECT page, sort_no, 3, repeat('-', 133) FROM heads
    UNION ALL SELECT page, seq_no, 10, {_DETAIL} FROM detail
    UNION ALL SELECT page, sort_no, 20, {_sql_total('Account Total', 84)} FROM cards
    UNION ALL SELECT page, sort_no, 21, repeat('-', 133) FROM cards
    UNION ALL SELECT page, sort_no, 30, {_sql_total('Page Total ', 86)} FROM pages
    UNION ALL SELECT page, sort_no, 31, repeat('-', 133) FROM pages
    UNION ALL SELECT page, sort_no, 40, {_sql_total('Grand Total', 86)} FROM grand""",
)
def _(t: Tables):
    rows = report_rows(t)
    return reports.report_lines(rows, report_detail(t, rows), REPORT_START, REPORT_END)


LISTING_SQL = f"""SELECT lpad(CAST(acct_id AS VARCHAR), 11, '0') AS acct_id, type_cd,
       lpad(CAST(cat_cd AS VARCHAR), 4, '0') AS cat_cd, {edited('balance', '9(9).99-')} AS balance
       FROM {{category_balance}}"""


@add("category_balance_listing", LISTING_SQL)
def _(t: Tables):
    return reports.category_balance_listing(t.category_balance)


@add(
    "error_log_sink",
    """SELECT strftime(ts, '%y%m%d') AS err_date, strftime(ts, '%H%M%S') AS err_time,
       'cardledger' AS application, 'decide' AS program, 'A001' AS location, 'W' AS level,
       'A' AS subsystem, auth_type AS code_1, '' AS code_2, 'card not in cross reference' AS message,
       card_num AS event_key
       FROM {auth_request} WHERE card_num NOT IN (SELECT card_num FROM {xref})""",
)
def _(t: Tables):
    unknown = t.auth_request.join(t.xref.select("card_num"), "card_num", "left_anti")
    return EL.error_log(
        unknown, "A001", "W", "card not in cross reference", "card_num", F.col("ts"),
        program="decide", code_1=F.col("auth_type"),
    )


@add(
    "error_log_append",
    """SELECT 'first' AS run, strftime(ts, '%y%m%d') AS err_date, card_num AS event_key FROM {auth_request} q
       WHERE card_num NOT IN (SELECT card_num FROM {xref}) AND req_id % 2 = 0
       UNION ALL SELECT 'second', strftime(ts, '%y%m%d'), card_num FROM {auth_request}
       WHERE card_num NOT IN (SELECT card_num FROM {xref}) AND req_id % 2 = 1""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "error-log")
    unknown = t.auth_request.join(t.xref.select("card_num"), "card_num", "left_anti")
    # The first run is repeated and is in the log once all the same.
    for run_id, rest in (("first", 0), ("first", 0), ("second", 1)):
        own = unknown.where(F.col("req_id") % 2 == rest)
        events = EL.error_log(own, "A001", "W", "card not in cross reference", "card_num", F.col("ts"))
        EL.append_errors(events, path, run_id)
    return EL.read_errors(t.spark, path).select("run", "err_date", "event_key")
