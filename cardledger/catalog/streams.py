"""Streaming jobs, run over the given tables as a stream until everything is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardledger.catalog.ingest import REPLY_SQL
from cardledger.catalog.registry import AUTH_SQL, Registry, Tables
from cardledger.fixtures import VIEWS
from cardledger.functions.money import edit_amount
from cardledger.plans import authorization as AU
from cardledger.operators.sequence import run_sequence
from cardledger.session import materialize, scratch_path
from cardledger.sources import messages
from cardledger.streaming import authorization as SA
from cardledger.streaming import expiry, inquiry, queue, run

REGISTRY = Registry()
add = REGISTRY.add


#: Events of a micro-batch, and the files that they come in.
EVENTS_PER_BATCH = 1_000_000
FILES_PER_BATCH = 8


def event_stream(t: Tables):
    """The events as files that came one after the other in the order of their time.

    A micro-batch is bounded, but large: each costs some seconds whatever it holds, and reads the
    masters that it is joined with.
    """
    inbox = scratch_path(t.spark, "events")
    numbered = materialize(run_sequence(t.events, ["ts", "event_id"], "no", start=0), "numbered")
    for begin in range(0, max(1, numbered.count()), EVENTS_PER_BATCH):
        # A bounded range of the numbers, found by the files' statistics.  All but the last fill their files.
        own = numbered.where(F.col("no").between(begin, begin + EVENTS_PER_BATCH - 1)).drop("no")
        own.repartition(FILES_PER_BATCH).write.mode("append").parquet(inbox)
    return run.read_files(t.spark, inbox, t.events.schema, files_per_batch=FILES_PER_BATCH)


def request_stream(t: Tables):
    return t.spark.sql(VIEWS["auth_request"], events=event_stream(t))


def finish(t: Tables, df, name: str, mode: str = "append"):
    path = scratch_path(t.spark, name)
    run.run_to_files(df, path, scratch_path(t.spark, f"{name}-checkpoint"), mode)
    return t.spark.read.parquet(path)


def decision_store(t: Tables) -> str:
    stream = SA.auth_decide_stream(request_stream(t), t.xref, t.auth_account, t.customer_master)
    store = scratch_path(t.spark, "decisions")
    SA.auth_store_stream(stream, store, scratch_path(t.spark, "decisions-checkpoint"))
    return store


@add(
    "auth_enrich_stream",
    """SELECT q.req_id, x.acct_id, x.cust_id, a.credit_limit, a.curr_bal, a.acct_id IS NOT NULL AS account_found,
         c.cust_id IS NOT NULL AS customer_found
       FROM {auth_request} q LEFT JOIN {xref} x ON x.card_num = q.card_num
       LEFT JOIN {auth_account} a ON a.acct_id = x.acct_id LEFT JOIN {customer_master} c ON c.cust_id = x.cust_id""",
)
def _(t: Tables):
    out = SA.auth_enrich_stream(request_stream(t), t.xref, t.auth_account, t.customer_master)
    return finish(
        t, out.select("req_id", "acct_id", "cust_id", "credit_limit", "curr_bal", "account_found", "customer_found"),
        "enriched",
    )


@add(
    "auth_decide_stream",
    AUTH_SQL + "SELECT req_id, acct_id, amt, resp_code, resp_reason, approved_amt FROM decided",
    recursive=True,
)
def _(t: Tables):
    stored = t.spark.read.parquet(f"{decision_store(t)}/decisions")
    return stored.select("req_id", "acct_id", "amt", "resp_code", "resp_reason", "approved_amt")


@add(
    "auth_reason",
    """SELECT req_id, CASE WHEN ok THEN '0000' WHEN NOT card OR NOT acct OR NOT cust THEN '3100'
         WHEN funds THEN '4100' ELSE '9000' END AS reason
       FROM (SELECT event_id AS req_id, event_id % 2 = 0 AS ok, event_id % 3 <> 0 AS card, event_id % 5 <> 0 AS acct,
             event_id % 7 <> 0 AS cust, event_id % 11 <> 0 AS funds FROM {events})""",
)
def _(t: Tables):
    def flag(n: int):
        return F.col("event_id") % n != 0

    return t.events.select(
        F.col("event_id").alias("req_id"),
        AU.auth_reason(~flag(2), flag(3), flag(5), flag(7), flag(11)).alias("reason"),
    )


@add(
    "auth_summary_stream",
    AUTH_SQL + """SELECT acct_id, max(credit_limit) AS credit_limit,
       CAST(sum(approved_amt) AS DECIMAL(12,2)) AS credit_balance,
       count(*) FILTER (resp_code = '00') AS approved_cnt, count(*) FILTER (resp_code <> '00') AS declined_cnt,
       CAST(sum(approved_amt) AS DECIMAL(12,2)) AS approved_amt,
       CAST(coalesce(sum(amt) FILTER (resp_code <> '00'), 0) AS DECIMAL(12,2)) AS declined_amt
       FROM decided WHERE acct_id IS NOT NULL GROUP BY 1""",
    recursive=True,
)
def _(t: Tables):
    return SA.stored_summaries(t.spark, decision_store(t)).select(
        "acct_id", "credit_limit", "credit_balance", "approved_cnt", "declined_cnt", "approved_amt", "declined_amt"
    )


@add(
    "auth_detail_stream",
    AUTH_SQL + """SELECT acct_id, ts AS auth_ts, req_id, card_num, resp_code, amt AS tran_amt, approved_amt,
       CASE WHEN resp_code = '00' THEN 'P' ELSE 'D' END AS match_status FROM decided WHERE acct_id IS NOT NULL""",
    recursive=True,
)
def _(t: Tables):
    return t.spark.read.parquet(f"{decision_store(t)}/details").select(
        "acct_id", "auth_ts", "req_id", "card_num", "resp_code", "tran_amt", "approved_amt", "match_status"
    )


def plain_lines(t: Tables):
    """One request message per request, amounts in the message's own form."""
    text = F.concat_ws(
        ",", F.date_format("ts", "yyMMdd"), F.date_format("ts", "HHmmss"), "card_num", "auth_type",
        F.lit("0127,0100,POS,000000"), edit_amount(F.col("amt"), "+9(10).99"),
        F.lit("5411,840,05,MERCHANT,SHOP,TOWN,TX,75001"), F.lpad(F.col("req_id").cast("string"), 15, "0"),
    )
    return t.auth_request.select("req_id", text.alias("value"))


@add("auth_reply_stream", REPLY_SQL, recursive=True)
def _(t: Tables):
    inbox, outbox = scratch_path(t.spark, "inbox"), scratch_path(t.spark, "outbox")
    lines = plain_lines(t)
    lines.write.parquet(inbox)
    asked = messages.requests_from_messages(
        messages.auth_request_source(run.read_files(t.spark, inbox, lines.schema, files_per_batch=8))
    )
    decided = SA.auth_decide_stream(asked, t.xref, t.auth_account, t.customer_master)

    def reply(df, batch_id: int) -> None:
        messages.auth_reply_lines(df).write.mode("overwrite").parquet(f"{outbox}/batch={batch_id}")

    run.run_batches(decided, reply, scratch_path(t.spark, "reply-checkpoint"), "update")
    return t.spark.read.parquet(outbox).drop("batch")


@add("bounded_run", "SELECT req_id, ts, card_num, auth_type, amt FROM {auth_request}")
def _(t: Tables):
    return finish(t, request_stream(t), "bounded")


#: Messages that one run takes at most.
MESSAGES_PER_RUN = 500


@add(
    "bounded_run_messages",
    f"""SELECT CAST(least((row_number() OVER (ORDER BY ts, req_id) - 1) // {MESSAGES_PER_RUN}, 1) AS INT) AS run_no,
       req_id, ts, card_num, auth_type, amt FROM {{auth_request}}""",
)
def _(t: Tables):
    """The first run ends after its number of messages, the second goes on and ends as nothing waits."""
    box, out, checkpoint = (scratch_path(t.spark, n) for n in ("queue", "taken", "queue-checkpoint"))
    queue.append_messages(t.auth_request, box, ["ts", "req_id"])
    for run_no, most in enumerate((MESSAGES_PER_RUN, 2**62)):

        def each(batch, batch_id: int, run_no: int = run_no) -> None:
            batch.withColumn("run_no", F.lit(run_no)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        queue.run_messages(t.spark, box, lambda asked: asked.drop(queue.OFFSET), each, checkpoint, most)
    stored = t.spark.read.parquet(out)
    return stored.select("run_no", "req_id", "ts", "card_num", "auth_type", "amt")


@add(
    "auth_second_run",
    AUTH_SQL + """SELECT acct_id, max(credit_limit) AS credit_limit,
       CAST(sum(approved_amt) AS DECIMAL(12,2)) AS credit_balance,
       count(*) FILTER (resp_code = '00') AS approved_cnt, count(*) FILTER (resp_code <> '00') AS declined_cnt,
       CAST(coalesce(sum(amt) FILTER (resp_code <> '00'), 0) AS DECIMAL(12,2)) AS declined_amt
       FROM decided WHERE acct_id IS NOT NULL GROUP BY 1""",
    recursive=True,
)
def _(t: Tables):
    """Requests in two runs by time; the second is held against the summaries that the first stored."""
    middle = t.auth_request.agg(F.expr("percentile_approx(unix_micros(CAST(ts AS TIMESTAMP)), 0.5)")).first()[0]
    early = F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(middle)
    stored = None
    for own in (t.auth_request.where(early), t.auth_request.where(~early)):
        decided = AU.decide(own, t.xref, t.auth_account, t.customer_master, stored)
        new = materialize(AU.details(decided), "details")
        before, stored = stored, AU.summaries(new, t.auth_account)
        stored = materialize(stored if before is None else AU.update_summaries(before, new, t.auth_account), "summaries")
    return stored.select("acct_id", "credit_limit", "credit_balance", "approved_cnt", "declined_cnt", "declined_amt")


@add(
    "account_inquiry_stream",
    """SELECT e.event_id AS req_id, a.acct_id, a.active_status, a.curr_bal,
         CASE WHEN a.acct_id IS NULL THEN concat('INVALID REQUEST PARAMETERS ACCT ID : ',
           lpad(CAST(e.user_id AS VARCHAR), 11, '0'),
           CASE WHEN e.event_type <> 'error' AND e.user_id > 0 THEN '' ELSE concat('FUNCTION : ',
             CASE WHEN e.event_type = 'error' THEN 'OTHR' ELSE 'INQA' END) END) END AS message
       FROM {events} e LEFT JOIN {account} a ON a.acct_id = e.user_id AND e.event_type <> 'error' AND e.user_id > 0""",
)
def _(t: Tables):
    asked = event_stream(t).select(
        F.col("event_id").alias("req_id"),
        F.when(F.col("event_type") == "error", "OTHR").otherwise("INQA").alias("func"),
        F.col("user_id").alias("acct_key"),
    )
    facts = t.account.select("acct_id", "active_status", "curr_bal")
    out = inquiry.account_inquiry_stream(asked, facts)
    return finish(t, out.select("req_id", "acct_id", "active_status", "curr_bal", "message"), "inquiry")


@add(
    "auth_expiry_stream",
    """SELECT acct_id, CAST(auth_ts AS DATE) AS auth_date, count(*) FILTER (resp_code = '00') AS approved_cnt,
         count(*) FILTER (resp_code <> '00') AS declined_cnt,
         CAST(sum(approved_amt) AS DECIMAL(18,2)) AS approved_amt,
         CAST(coalesce(sum(tran_amt) FILTER (resp_code <> '00'), 0) AS DECIMAL(18,2)) AS declined_amt
       FROM {auth_detail}
       WHERE date_diff('day', CAST(auth_ts AS DATE), (SELECT CAST(max(auth_ts) AS DATE) FROM {auth_detail})) >= 5
       GROUP BY 1, 2""",
)
def _(t: Tables):
    stream = t.spark.sql(VIEWS["auth_detail"], events=event_stream(t))
    store = scratch_path(t.spark, "auth-store")
    expiry.auth_expiry_stream(stream, store, scratch_path(t.spark, "expiry-checkpoint"), days=5)
    return t.spark.read.parquet(f"{store}/expired").drop("batch")
