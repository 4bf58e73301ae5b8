"""Structure repair of conversations: cheapest edits that give role initials ``(s?(ua)+)?``.

Rows of a conversation are brought together by one shuffle and sorted by turn; a task reads them as
a stream of Arrow batches.  For each state of the pattern (nothing yet, behind system, user,
assistant) it carries the least cost, the order of the edit texts that lead there and the hash of
the repaired turns, so no conversation is ever held whole.  Edits: Keep costs 0, Rerole to
user or assistant 3, Delete 4, Insert of an empty turn 3; a kept or reroled truncated row adds 3;
blank and duplicate rows must go.  The least cost wins, then the ASCII-least text of edit initials.

Equal costs are settled by rank alone.  Two edit texts that end in the edit of one row have equally
many row edits, so neither begins with the other, and the pattern is deterministic: texts of two
states differ.  Whatever follows, the text that is less now stays less.

What leads to each state is one byte a row and state.  Up to ``BLOCK`` rows it is traced back where
it is; of longer conversations every ``BLOCK`` rows of these bytes leave the task as a row of the
result, which Spark writes to the shared folder, and a second stream reads the blocks from the
last to the first.  Both ways apply the same steps.

Odd rows: null roles and texts count as one space (such a text is blank); null turns come first;
an empty role adds no initial, so its row may stay anywhere; rows of one turn are taken by role, then text; rows without an id are one conversation.  The edit text
and the hash are values of one conversation and as long as it has rows (or one hash); a
conversation is read by one task, since its hash is one chain.  ``gaps`` ends at the bigint range.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.llm.common import store

BLOCK = 65_536
#: Not blank: any of these; a text whose last such character is none of ``.!?`` is cut off.
INK = r"[^\x20\x09-\x0D]"
RETURNED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {"su", "ua", "au"}
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
#: State behind an inserted or reroled turn: the pattern says which of the two roles it takes.
_NEXT = {_NOTHING: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_KEEP = {("s", _NOTHING): _SYSTEM, ("u", _NOTHING): _USER, ("u", _SYSTEM): _USER, ("a", _USER): _ASSISTANT, ("u", _ASSISTANT): _USER}


def _kept(initial: str, state: int) -> int | None:
    """State behind a kept turn; an empty role adds no initial."""
    return state if not initial else _KEEP.get((initial, state))


_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_TAIL = {_NOTHING: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}
_EDITS = "DKR"
_REROLE, _DELETE, _INSERT, _CUT = 3, 4, 3, 3


class _Conversation:
    """Everything a task knows of the conversation it is reading."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.blocks = 0
        self.rows = 0
        self.least = self.most = self.turn = None
        self.turns = 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None
        #: state -> (cost, rank, hash, whether it has a turn)
        self.states = {_NOTHING: (0, 0, hashlib.sha256(), False)}
        self.trail = bytearray()

    def take(self, turn: int | None, role: str, text: str, repeated: bool, blank: bool, cut: bool) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += turn != self.turn
            self.turn = turn
        initial = role[:1]
        if self.rows:
            self.illegal += self.initial + initial not in _LEGAL
        self.rows += 1
        self.initial = initial
        must_go = blank or repeated
        self.blank += blank
        self.duplicate += repeated and not blank
        cut = cut and not must_go
        self.truncated += cut
        self._edit(initial, role, text, must_go, _CUT if cut else 0)

    def _edit(self, initial: str, role: str, text: str, must_go: bool, extra: int) -> None:
        best: dict[int, tuple] = {}

        def offer(to: int, cost: int, rank: int, word: str, come_from: int) -> None:
            if to not in best or (cost, rank, word) < best[to][:3]:
                best[to] = (cost, rank, word, come_from)

        for state, (cost, rank, _, _) in self.states.items():
            offer(state, cost + _DELETE, rank, "D", state)
            if must_go:
                continue
            # Two inserts before an edit are never cheapest: neither is needed, or Delete of the system turn is cheaper.
            for inserts, at in ((0, state), (1, _NEXT[state])):
                before, word = cost + extra + inserts * _INSERT, "I" * inserts
                kept = _kept(initial, at)
                if kept is not None:
                    offer(kept, before, rank, word + "K", state)
                offer(_NEXT[at], before + _REROLE, rank, word + "R", state)
        byte = [0, 0, 0, 0]
        states = {}
        order = sorted(best, key=lambda s: (best[s][1], best[s][2]))
        for rank, state in enumerate(order):
            cost, _, word, come_from = best[state]
            byte[state] = 1 + (come_from | (len(word) - 1) << 2 | _EDITS.index(word[-1]) << 4)
            _, _, digest, begun = self.states[come_from]
            if word != "D":
                digest = digest.copy()
                at = come_from
                for _ in range(len(word) - 1):
                    at = _NEXT[at]
                    digest.update((f"\n{_ROLE[at]}:" if begun else f"{_ROLE[at]}:").encode())
                    begun = True
                own = role if word[-1] == "K" else _ROLE[state]
                digest.update((f"\n{own}:{text}" if begun else f"{own}:{text}").encode())
                begun = True
            states[state] = (cost, rank, digest, begun)
        self.states = states
        self.trail += bytes(byte)

    def end(self) -> tuple[int, int, str]:
        """Final state, cost and hash."""
        cost, _, inserts, state = min((c + _INSERT * _TAIL[s], rank, "I" * _TAIL[s], s) for s, (c, rank, _, _) in self.states.items())
        _, _, digest, begun = self.states[state]
        digest = digest.copy()
        at = state
        for _ in inserts:
            at = _NEXT[at]
            digest.update((f"\n{_ROLE[at]}:" if begun else f"{_ROLE[at]}:").encode())
            begun = True
        return state, cost, digest.hexdigest()


def _trace(trail: bytes, state: int) -> tuple[list[str], int]:
    """Edits of a stretch of rows that ends in ``state``, last first, and the state before them."""
    found = []
    for at in range(len(trail) - 4, -1, -4):
        byte = trail[at + state] - 1
        found.append("I" * (byte >> 2 & 3) + _EDITS[byte >> 4])
        state = byte & 3
    return found, state


_REPORT = ", ".join(f"{c} bigint" for c in RETURNED)


def _report(talk: _Conversation) -> dict:
    state, cost, digest = talk.end()
    gaps = 0 if talk.least is None else min(talk.most - talk.least + 1 - talk.turns, 2**63 - 1)
    return {
        "conv_id": talk.conv_id, "gaps": gaps, "blank": talk.blank, "duplicate": talk.duplicate,
        "truncated": talk.truncated, "illegal": talk.illegal, "cost": cost, "repaired_sha256": digest,
        "block": talk.blocks, "state": state, "trail": bytes(talk.trail), "audit": None,
    }


def _read(block: int, schema: pa.Schema) -> Callable:
    """Stream of sorted rows to reports, with blocks of back pointers before those of long conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: _Conversation | None = None
        out: list[dict] = []

        def close() -> None:
            report = _report(talk)
            if not talk.blocks:
                edits, _ = _trace(report["trail"], report["state"])
                report |= {"audit": "".join(reversed(edits)) + "I" * _TAIL[report["state"]], "trail": None, "block": None}
            out.append(report)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                conv_id, turn, role, text, present, repeated, blank, cut = row
                if talk is None or conv_id != talk.conv_id:
                    if talk is not None:
                        close()
                    talk = _Conversation(conv_id)
                if present:
                    talk.take(turn, role, text, repeated, blank, cut)
                    if len(talk.trail) >= 4 * block:
                        out.append(dict.fromkeys(schema.names) | {"conv_id": conv_id, "block": talk.blocks, "trail": bytes(talk.trail)})
                        talk.blocks += 1
                        talk.trail = bytearray()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if talk is not None:
            close()
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _walk_blocks(schema: pa.Schema) -> Callable:
    """Blocks of long conversations, last first, to reports."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, state, pieces = None, 0, []

        def close() -> pa.RecordBatch:
            report["audit"] = "".join(reversed(pieces)) + "I" * _TAIL[report["state"]]
            return pa.RecordBatch.from_pylist([report | {"trail": None}], schema)

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["state"] is not None:  # the last block has the report
                    if report is not None:
                        yield close()
                    report, state, pieces = row, row["state"], []
                edits, state = _trace(row["trail"], state)
                pieces.append("".join(reversed(edits)))
        if report is not None:
            yield close()

    return run


def repair_conversations(rows: DataFrame, present: Column | None = None, block: int = BLOCK) -> DataFrame:
    """A row for each conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``): counts of faults,
    least cost, the edits' initials (``audit``) and the hash of the repaired turns.

    Rows that are not ``present`` only make their conversation known.
    """
    here = F.lit(True) if present is None else present
    text = F.when(here, F.coalesce("text", F.lit(" "))).alias("text")
    role = F.when(here, F.coalesce("role", F.lit(" "))).alias("role")
    slim = rows.select("conv_id", F.when(here, F.col("turn")).alias("turn"), role, text, here.alias("present"))
    # One shuffle: the window and the sort both keep to the conversations of a partition.
    dealt = slim.repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    blank = ~F.col("text").rlike(INK)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = dealt.withColumn("repeated", F.row_number().over(same) > 1).withColumn("blank", blank).withColumn("cut", cut)
    read = marked.sortWithinPartitions("conv_id", "present", F.asc_nulls_first("turn"), "role", "text", "repeated")

    key = rows.schema["conv_id"].dataType
    out = T.StructType(
        [T.StructField("conv_id", key)]
        + [T.StructField(c, T.LongType()) for c in RETURNED]
        + [T.StructField(c, T.StringType()) for c in ("repaired_sha256", "audit")]
        + [T.StructField("block", T.LongType()), T.StructField("state", T.LongType()), T.StructField("trail", T.BinaryType())]
    )
    arrow = pa.schema(
        [("conv_id", _ARROW[key.simpleString()])]
        + [(c, pa.int64()) for c in RETURNED]
        + [("repaired_sha256", pa.string()), ("audit", pa.string()), ("block", pa.int64()), ("state", pa.int64()), ("trail", pa.binary())]
    )
    found = store(read.mapInArrow(_read(block, arrow), out), "reports")
    long = found.where(F.col("block").isNotNull()).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    traced = long.mapInArrow(_walk_blocks(arrow), out)
    whole = found.where(F.col("block").isNull()).unionByName(traced)
    return whole.select("conv_id", *RETURNED, "audit", "repaired_sha256")


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The turns after repair (conv_id, place, role, text) of ``rows``, by the ``audit`` of ``reports``.

    The edits travel as the first row of their conversation in the same kind of stream.
    """
    key = rows.schema["conv_id"].dataType
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    turns = rows.select("conv_id", F.lit(1).alias("kind"), "turn", role.alias("role"), text.alias("text"))
    edits = reports.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    read = turns.unionByName(edits).repartition("conv_id")
    read = read.sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "text")
    names = ["conv_id", "place", "role", "text"]
    arrow = pa.schema([("conv_id", _ARROW[key.simpleString()]), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, last, place, state = "", 0, 0, 0, _NOTHING
        for batch in batches:
            out: list[tuple] = []
            for conv_id, kind, _, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if kind == 0:
                    audit, at, last, place, state = text, 0, len(text.rstrip("I")), 0, _NOTHING
                    continue
                edit = "I"
                while at < len(audit) and (edit == "I" or at >= last):
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    state = _kept(role[:1], state) if edit == "K" else _NEXT[state]
                    out.append((conv_id, place, role if edit == "K" else _ROLE[state], "" if edit == "I" else text))
                    place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    return read.mapInArrow(run, T.StructType([T.StructField("conv_id", key)] + [T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
