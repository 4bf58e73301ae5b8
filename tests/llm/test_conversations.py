"""Conversation repair against plain searches over all edits."""

import hashlib
import itertools
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from cardledger.llm.conversations import _Conversation, _report, _trace, _TAIL, repair_conversations, repaired_turns
from cardledger.llm.queries import damaged

EXTRA = "present string, kind string, state string, audit string, block string"
BLANK = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["same"] * 5) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {EXTRA}")


def faults(rows):
    """(role, text, fault) in order; rows are (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        ink = text.rstrip(BLANK)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def every_repair(rows):
    """Least (cost, edits, turns) over all edits with up to three inserts at each place."""
    marked, best = faults(rows), None
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for _, _, f in marked]
    inserted = [x for n in range(4) for x in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*choices):
        slots = [inserted] * (len(marked) + 1)
        for puts in itertools.product(*slots) if len(marked) < 2 else few(marked, edits):
            cost, letters, turns = 0, "", []
            for i, put in enumerate(puts):
                for r in put:
                    cost, letters = cost + 3, letters + "I"
                    turns.append(("user" if r == "u" else "assistant", ""))
                if i < len(marked):
                    role, text, fault = marked[i]
                    edit = edits[i]
                    letters += edit if edit in "DK" else "R"
                    cost += 4 if edit == "D" else (3 if fault == "truncated" else 0) + (0 if edit == "K" else 3)
                    if edit != "D":
                        turns.append(({"K": role, "u": "user", "a": "assistant"}[edit], text))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns)) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, turns)
    return best


def few(marked, edits):
    """At most one insert a place (two at the end) is enough for more rows."""
    one = [(), ("u",), ("a",)]
    return itertools.product(*[one] * len(marked), [*one, ("u", "a")])


def hashed(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "u", " "])
TEXTS = st.sampled_from(["Hi.", "Hi", "What? \n", "", " \t", "so!", "a. b"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=4))
def test_least_edits(rows):
    talk = _Conversation(1)
    for i, (role, text, fault) in enumerate(faults(rows)):
        ink = text.rstrip(BLANK)
        talk.take(i, role, text, fault == "duplicate", fault == "blank", not ink or ink[-1] not in ".!?")
    report = _report(talk)
    edits, first = _trace(report["trail"], report["state"])
    audit = "".join(reversed(edits)) + "I" * _TAIL[report["state"]]
    cost, letters, turns = every_repair(rows)
    assert first == 0 and (report["cost"], audit) == (cost, letters)
    assert report["repaired_sha256"] == hashed(turns)
    assert report["truncated"] == sum(f == "truncated" for *_, f in faults(rows))


def by_rules(rows):
    """Least (cost, edits, turns) by a plain table over rows and states, texts of edits held whole."""
    after = {("n", "s"): "s", ("n", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"} | {(s, ""): s for s in "nsua"}
    table = {"n": (0, "", ())}

    def inserts(table):
        for _ in range(3):
            for state, (cost, letters, turns) in list(table.items()):
                for role in ("user", "assistant"):
                    to = after.get((state, role[0]))
                    new = (cost + 3, letters + "I", (*turns, (role, "")))
                    if to and (to not in table or new[:2] < table[to][:2]):
                        table[to] = new
        return table

    for role, text, fault in faults(rows):
        new = {}
        for inserted in (False, True):
            for state, (cost, letters, turns) in (inserts(dict(table)) if inserted else table).items():
                offers = [(state, cost + 4, letters + "D", turns)]
                extra = 3 if fault == "truncated" else 0
                if fault not in ("blank", "duplicate"):
                    offers += [(after.get((state, role[:1])), cost + extra, letters + "K", (*turns, (role, text)))]
                    offers += [(after.get((state, r[0])), cost + extra + 3, letters + "R", (*turns, (r, text))) for r in ("user", "assistant")]
                for to, *offer in offers:
                    if to and (to not in new or tuple(offer[:2]) < new[to][:2]):
                        new[to] = tuple(offer)
        table = new
    table = inserts(table)
    return min(table[s] for s in ("n", "a") if s in table)


def plain(rows):
    """conv_id -> result, rows being (conv_id, turn, role, text) after damage."""
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv_id))
        marked = faults([r[2:] for r in own])
        cost, letters, turns = by_rules([r[2:] for r in own])
        numbers = [t for known, t, *_ in own if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        count = lambda f: sum(x == f for *_, x in marked)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv_id] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, hashed(turns))
    return out


def found(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert df.columns == ["conv_id", *names] and len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


TALKS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "What is it?"), (1, 2, "assistant", "A cat."), (1, 3, "user", "Thanks!"),
    (2, 5, "assistant", "Late start."), (2, 9, "user", "cut of"), (2, None, "user", "No turn."), (2, None, None, None),
    (3, 1, "user", ""), (3, 2, "user", " \n"), (4, 1, "User", "Capital."), (4, 1, "user", "Same turn."), (4, 1, "user", "Same turn."),
    (None, 2, "user", "No id."), (None, 1, "system", "No id either."), (5, 1, "system", "Alone."),
    (6, -3, "user", "x" * 200_000 + "."), (6, 7, "assistant", "日本 𝔘。"), (6, 8, "tool", "ü?"), (7, 1, "", "Empty role."),
    (8, -(2**63), "user", "First."), (8, 2**63 - 1, "assistant", "Last."),
]


def test_odd_conversations(spark):
    want = plain(TALKS)
    want[8] = (2**63 - 1, *want[8][1:])
    assert found(repair_conversations(frame(spark, TALKS))) == want
    assert repair_conversations(frame(spark, [])).collect() == []


def test_long_conversations_in_blocks(spark):
    """A third of the rows in one conversation; back pointers leave in blocks of a few rows."""
    roles = ["user", "assistant", "user", "user", "system", "assistant", "tool"]
    texts = ["One.", "two", "three?", "", "four!", "One.", "f"]
    rows = [(0, i, roles[i * i % 7], f"{texts[i * 5 % 7]}{i % 40 if i % 3 else ''}{'.' if i % 2 else ''}") for i in range(600)]
    rows += [(1 + i % 100, i, roles[i % 7], texts[i % 5]) for i in range(1200)]
    want = plain(rows)
    assert found(repair_conversations(frame(spark, rows), block=16)) == want == found(repair_conversations(frame(spark, rows)))


def test_repaired_turns(spark):
    rows = frame(spark, TALKS)
    reports = repair_conversations(rows)
    turns = {}
    for r in repaired_turns(rows, reports).collect():
        turns.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    for r in reports.collect():
        own = sorted(turns.get(r["conv_id"], []))
        assert [p for p, *_ in own] == list(range(len(own)))
        assert hashed([t[1:] for t in own]) == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[1][:1] for t in own))


def test_damage(spark):
    rows = [(i, t, "assistant", f"Yes. No! {i}?") for i in range(40) for t in (0, 1, None)] + [(None, 1, None, None)] * 2
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        want += [(c, t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    df = damaged(frame(spark, rows))
    got = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.where("present").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    from pyspark.sql import functions as F

    known = found(repair_conversations(df, F.col("present")))
    gone = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert known == {c: gone for c, *_ in rows} | plain(want)
