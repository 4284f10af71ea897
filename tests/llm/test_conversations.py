from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from cartlake.llm import conversations, queries
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
ROWS = "conv_id bigint, turn bigint, role string, text string, fault int, piece string, at int"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, lines) by trying every edit that keeps the roles a beginning of a legal conversation.

    ``rows``: (role, text, fault), fault one of blank, duplicate, truncated, None.
    """
    best = None

    def go(i, roles, cost, audit, lines):
        nonlocal best
        if not re.fullmatch(r"s?(ua)*u?", roles) or best and cost > best[0] or audit.endswith("III"):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        for role in ("user", "assistant"):
            go(i, roles + role[0], cost + 3, audit + "I", lines + [role + ":"])
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, roles, cost + 4, audit + "D", lines)
        if fault in ("blank", "duplicate"):
            return
        extra = 3 if fault == "truncated" else 0
        go(i + 1, roles + (role[:1] or "-"), cost + extra, audit + "K", lines + [f"{role}:{text}"])
        for new in ("user", "assistant"):
            go(i + 1, roles + new[0], cost + extra + 3, audit + "R", lines + [f"{new}:{text}"])

    go(0, "", 0, "", [])
    return best


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        out.append((role, text, "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None))
        seen.add((role, text))
    return out


def plain(rows, solve):
    """The contract, conversation by conversation. ``rows``: (conv_id, turn, role, text) before damage."""
    out = {}
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        turns = {r[1] for r in own if r[1] is not None}
        found = faults([r[2:] for r in own])
        kinds = [f for _, _, f in found]
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, lines = solve(found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def quick(rows):
    """A plain dynamic program over whole audit strings."""
    best = {"": (0, "", [])}  # by the role said last: cost, audit, lines
    after = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def better(table, state, made):
        if state not in table or made[:2] < table[state][:2]:
            table[state] = made

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, lines) in list(table.items()):
                better(table, after[state][0], (cost + 3, audit + "I", lines + [after[state] + ":"]))
        return table

    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, lines) in inserted(dict(best)).items():
            better(new, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            to = after[state]
            better(new, to[0], (cost + extra + 3, audit + "R", lines + [f"{to}:{text}"]))
            if (state, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                better(new, role[0], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
        best = new
    return min(v for s, v in inserted(best).items() if s in ("", "a"))


def random_rows(rng, size):
    roles = ["system", "user", "assistant", "tool", "", "s", "uncle"]
    return [(rng.choices(roles, [1, 4, 4, 1, 1, 1, 1])[0], rng.choice(["a.", "b!", "c? ", "d", "", " \t", "ä。", "e.\n", f"{rng.random()}."])) for _ in range(size)]


def kinds_of(found):
    short = {"blank": "b", "duplicate": "d", "truncated": "t", None: " "}
    return [conversations._kind(r[:1] if r[:1] in ("s", "u", "a") else "-", short[f]) for r, _, f in found]


def test_audits_against_every_edit():
    rng = random.Random(4)
    for n in range(300):
        found = faults(random_rows(rng, n % 6))
        want = cheapest(found)
        assert quick(found) == want
        assert conversations.audit(kinds_of(found)) == want[:2]
        assert list(conversations.repaired_lines(want[1], iter([f[:2] for f in found]))) == want[2]


@pytest.mark.parametrize("prime", [2, 7, conversations.PRIME])
def test_colliding_hashes(monkeypatch, prime):
    made = conversations.Audits.__init__
    monkeypatch.setattr(conversations.Audits, "__init__", lambda self, order: made(self, order, prime))
    monkeypatch.setattr(conversations, "STRETCH", 16)
    rng = random.Random(6)
    for _ in range(40):
        found = faults(random_rows(rng, 90))
        assert conversations.audit(kinds_of(found)) == quick(found)[:2]


def test_standings_are_few():
    found, leads = conversations.standings()
    assert len(found) < 500 and all(len(v) == len(found) for v in leads.values())


def test_random_table(spark, monkeypatch):
    rng = random.Random(8)
    data = []
    for conv in [*range(60), None, -5, 2**40]:
        size = rng.choice([1, 2, 5, 12])
        data += [(conv, rng.choice([None, *range(size + 2)]), *(rng.choice([x, x, x, x, None]) for x in row)) for row in random_rows(rng, size)]
    # One conversation with most rows: it is cut into pieces.
    data += [(7, t, *row) for t, row in enumerate(random_rows(rng, 3000))]
    rng.shuffle(data)
    # Rows of one turn that differ are ordered, rows that repeat are too.
    data += data[:40]
    rows = spark.createDataFrame([(*r, 1, "x", 2) for r in data], ROWS).repartition(5)
    made = conversations.repaired(conversations.damaged(rows), rows)
    assert rows_of(made) == plain(data, quick)


def test_edges(spark):
    some = spark.createDataFrame([(1, None, None, None, 0, "", 0), (None, None, None, None, 0, "", 0), (3, 1, "user", "w " * 200_000 + ".", 0, "", 0)], ROWS)
    got = rows_of(conversations.repaired(some))
    text = "w " * 200_000 + "."
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1] == got[None] == (0, 1, 0, 0, 0, 4, "D", nothing)
    assert got[3] == (0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(f"user:{text}\nassistant:".encode()).hexdigest())
    none = some.where("conv_id > 9")
    assert rows_of(conversations.repaired(none)) == {}
    assert rows_of(conversations.repaired(none, some.where("conv_id = 1"))) == {1: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_query_against_a_plain_version(spark):
    data = [tuple(r) for r in table(spark, SF, "conversations").collect()]
    assert rows_of(queries.QUERIES["op13_conversation_repair"](spark, SF)) == plain(data, quick)
