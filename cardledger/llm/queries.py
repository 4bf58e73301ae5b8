"""Registered queries of the text operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.llm.common import store, table
from cardledger.llm.conversations import repair_conversations
from cardledger.llm.decontaminate import WINDOW, decontaminate
from cardledger.llm.exact import exact_dedup
from cardledger.llm.language import identify
from cardledger.llm.licenses import PHRASES, STRIDE, TEMPLATES, THRESHOLD, license_scan, needed
from cardledger.llm.lines import line_dedup
from cardledger.llm.pieces import piece_tokens
from cardledger.llm.quality import quality
from cardledger.llm.sharding import vector_shards
from cardledger.llm.simhash import simhash_components
from cardledger.llm.suffixes import remove_repeats
from cardledger.llm.urls import url_verdicts
from cardledger.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(name: str, check: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return wrap


def _words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license_sql() -> str:
    def row(label: str, text: str, exact: bool) -> str:
        tokens = sorted(set(text.split()))
        phrase = f"[{', '.join(repr(w) for w in text.split())}]" if exact else "NULL"
        return f"('{label}', {phrase}, {tokens}, {needed(len(tokens), THRESHOLD)})"

    known = [row(a, b, True) for a, b in PHRASES] + [row(a, b, False) for a, b in TEMPLATES]
    return f"""
WITH t AS (SELECT * FROM (VALUES {", ".join(known)}) AS v(label, phrase, tokens, need)),
d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(len(w))) AS s, w FROM d),
base AS (
  SELECT doc_id, s, label, phrase FROM p JOIN t ON phrase IS NOT NULL AND w[s + 1 : s + len(phrase)] = phrase),
b AS (SELECT doc_id, list_distinct(w[s + 1 : s + {2 * STRIDE}]) AS held FROM p WHERE s % {STRIDE} = 0),
met AS (
  SELECT doc_id, label, len(list_intersect(held, tokens)) AS n, len(tokens) AS size
  FROM b JOIN t ON len(list_intersect(held, tokens)) >= need),
places AS (
  SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
found AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(n / size) AS score
  FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS line, len(ls) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
h AS (
  SELECT *, i < n - 1 AND left(md5(concat(
           lag(md5(line), 2, '') OVER w, lag(md5(line), 1, '') OVER w, md5(line))), 1)
           IN ('0', '1', '2', '3') AS ends
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (
           PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM h),
c AS (
  SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM k GROUP BY doc_id, k),
m AS (SELECT *, n > 1 AND row_number() OVER (PARTITION BY chunk, n > 1 ORDER BY doc_id, k) > 1 AS gone FROM c)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, count(*) AS n_chunks,
       CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed,
       CAST(sum(CASE WHEN gone THEN n ELSE 0 END) AS BIGINT) AS n_removed_lines,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

LEAKS_SQL = rf"""
WITH i AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s + 1 : s + m], ' ') AS span
  FROM (SELECT item_id, w, m, unnest(range(len(w) - m + 1)) AS s
        FROM (SELECT *, least(len(w), {WINDOW}) AS m FROM i WHERE len(w) > 0))),
d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
hit AS (
  SELECT doc_id, s, m, item_id
  FROM (SELECT doc_id, w, m, unnest(range(len(w) - m + 1)) AS s
        FROM d, (SELECT DISTINCT m FROM v) WHERE len(w) >= m) JOIN v USING (m)
  WHERE array_to_string(w[s + 1 : s + m], ' ') = span),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

def _talk_sql() -> str:
    """Damage and repair row by row; a state of a conversation is (cost, edits, repaired lines)."""
    far = 1_000_000_000

    def offer(state: int, cost: str, edit: str, lines: str) -> str:
        own = f"s[{state}]"
        return f"{{'c': {own}.c + {cost}, 'a': {own}.a || '{edit}', 't': {own}.t || {lines}}}"

    def turns(states: list[int], before: str, initial: str, role: str) -> list[str]:
        edit, more, put = ("I", 3, f"'{before}:' || chr(10) || ") if before else ("", 0, "")
        keep = f"r.cut + {more} + CASE WHEN r.go OR r.initial <> '{initial}' THEN {far} ELSE 0 END"
        change = f"r.cut + {more} + 3 + CASE WHEN r.go THEN {far} ELSE 0 END"
        return [
            x for state in states for x in (
                offer(state, keep, edit + "K", f"{put}r.role || ':' || r.text || chr(10)"),
                offer(state, change, edit + "R", f"{put}'{role}:' || r.text || chr(10)"),
            )
        ]

    def roleless(states: list[int], insert: str = "") -> list[str]:
        cost = f"r.cut + {3 if insert else 0} + CASE WHEN r.go OR r.initial <> '' THEN {far} ELSE 0 END"
        put = f"'{insert}:' || chr(10) || " if insert else ""
        return [offer(state, cost, "IK" if insert else "K", f"{put}':' || r.text || chr(10)") for state in states]

    # Positions of the states: 1 nothing yet, 2 behind system, 3 behind user, 4 behind assistant.
    # A row without a role adds no initial and may stay anywhere.
    reached = [
        roleless([1]),
        [*roleless([2]), offer(1, f"r.cut + CASE WHEN r.go OR r.initial <> 's' THEN {far} ELSE 0 END", "K", "r.role || ':' || r.text || chr(10)")],
        turns([1, 2, 4], "", "u", "user") + turns([3], "assistant", "u", "user") + roleless([3]) + roleless([1, 2, 4], "user"),
        turns([3], "", "a", "assistant") + turns([1, 2, 4], "user", "a", "assistant") + roleless([4]) + roleless([3], "assistant"),
    ]
    step = ", ".join(f"list_sort([{', '.join([offer(i + 1, '4', 'D', chr(39) * 2), *own])}])[1]" for i, own in enumerate(reached))
    last = ", ".join(
        f"{{'c': s[{i}].c + {3 * len(tail)}, 'a': s[{i}].a || '{'I' * len(tail)}', 't': s[{i}].t || {chr(39) * 2}"
        + "".join(f" || '{r}:' || chr(10)" for r in tail) + "}"
        for i, tail in ((1, []), (2, ["user", "assistant"]), (3, ["assistant"]), (4, []))
    )
    start = f"[{{'c': 0, 'a': '', 't': ''}}, {', '.join([f'{{{chr(39)}c{chr(39)}: {far}, {chr(39)}a{chr(39)}: {chr(39) * 2}, {chr(39)}t{chr(39)}: {chr(39) * 2}}}'] * 3)}]"
    turn_over = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END"
    return f"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
d AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)),
              lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda v, i: {turn_over}, xor(c, b)),
              4294967295::BIGINT), 4294967295::BIGINT) % 20 AS code FROM k),
e AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d),
f AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') AS cut FROM e),
g AS (
  SELECT *, blank OR again AS go, NOT (blank OR again) AND cut AS short,
         lag(initial) OVER w AS before, row_number() OVER w AS place FROM f
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again)),
h AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (short) AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'initial': initial, 'go': go, 'cut': CASE WHEN short THEN 3 ELSE 0 END, 'role': role, 'text': text}}
              ORDER BY place) AS rows
  FROM g GROUP BY conv_id),
p AS (SELECT *, list_reduce(rows, lambda s, r: [{step}], {start}) AS s FROM h),
q AS (SELECT *, list_sort([{last}])[1] AS best FROM p),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(left(best.t, length(best.t) - 1), '')) AS repaired_sha256
FROM c LEFT JOIN q ON c.conv_id IS NOT DISTINCT FROM q.conv_id
"""


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


@_query("op1_license_scan", _license_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@_query("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@_query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@_query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens(table(spark, sf_dir, "documents"))


@_query("op5_line_dedup", LINES_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


@_query("op8_decontamination", LEAKS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


@_query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op7_exact_dedup", EXACT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@_query(
    "withdrawn_exact_dedup",
    r"""
WITH n AS (
  SELECT d.doc_id, length(coalesce(text, '')) AS points, coalesce(l.toxic, false) AS gone,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents d LEFT JOIN (SELECT doc_id, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id),
c AS (
  SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, text_sha256
  FROM n WHERE NOT gone WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM c
UNION ALL SELECT doc_id, NULL, NULL, false, text_sha256 FROM n WHERE gone
""",
)
def withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents are withdrawn from the index, so a copy that is not marked may stay in their place."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # Ids are stored first, so that Spark knows their size when it chooses how to join them to whole texts.
    toxic = store(labels.where("toxic = 1").select("doc_id").distinct(), "withdrawn").withColumn("gone", F.lit(True))
    return exact_dedup(docs.select("doc_id", "text").join(toxic, "doc_id", "left"), "gone")


@_query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@_query("op10_vector_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_shards(table(spark, sf_dir, "documents"))


@_query("op11_url_filter")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "words", "score")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults; dropped rows stay as ``present`` false."""
    space = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    code = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.col("code") != 0, F.when(F.col("code") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("present"))


@_query("op12_conversation_repair", _talk_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows, F.col("present"))


@_query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
