"""Repair of conversation structure by a persistent dynamic program over audits.

An *audit* is the string of edits that turns a conversation's rows into ``(system? (user assistant)+)?``: Keep,
Rerole, Delete, Insert. After each row and for each of four states (nothing yet, system, user, assistant said last)
the program knows the cheapest audit, the ASCII-least among equals. Audits that begin alike share their beginning:
an edit is a node that points to the one before it, to its ancestors 2^k edits back, and carries a rolling hash of
all edits so far. Two audits that cost the same are compared where their longest common prefix ends, which the
ancestors find in logarithmic time. A hash only proposes that two prefixes are equal; their last edits and what
stands before them decide, so that equal prefixes are one node and a collision is two.

Audits that end with the edit of the same row are prefix-free, so a stretch of rows needs of everything before it
only the costs of the four states and the order of their audits. There are few such *standings*; a conversation of
any length is therefore cut by the range partitioning that sorts it: each piece says where every standing leads, the
pieces of a conversation are chained, and then all pieces run the program side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import row_id, settle

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: Who spoke last.
NOBODY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a rerole or an insertion: user and assistant take turns.
TURN = (USER, USER, ASSISTANT, USER)
#: The state after a kept row: (state, initial).
STAYS = {(NOBODY, "s"): SYSTEM, (NOBODY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
SPEAKER = {USER: "user", ASSISTANT: "assistant"}
#: Kinds of rows: initial (``-`` for another) and fault (`` ``, ``t`` truncated); ``x`` must be deleted.
KINDS = ["x", *(i + f for i in "sua-" for f in " t")]
#: Rows whose edits are held as nodes at once.
STRETCH = 4096
#: Conversations of so few rows are often of the same kinds; a worker remembers what became of them.
SHORT, KNOWN = 16, 65_536
BASE, PRIME = 1_000_003, 2**61 - 1
_SPACE = " \t\n\x0b\x0c\r"


class Audits:
    """Audits of a stretch as linked nodes; the first four are what stands before it, in their given order."""

    def __init__(self, order: tuple[int, ...], prime: int = PRIME):
        self.prime = prime
        self.edit, self.depth, self.hash = [""] * 4, [0] * 4, list(range(1, 5))
        self.above: list[list[int]] = [[], [], [], []]  # ancestors 1, 2, 4, ... edits back
        self.order = order
        self.alike: dict[int, list[int]] = {}

    def then(self, node: int, edit: str) -> int:
        """The audit of ``node`` and one more edit."""
        h = (self.hash[node] * BASE + ord(edit)) % self.prime
        for other in self.alike.setdefault(h, []):
            if self.edit[other] == edit and self.above[other][0] == node:
                return other
        above, k = [node], 0
        while k < len(self.above[above[k]]):
            above.append(self.above[above[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(h)
        self.above.append(above)
        self.alike[h].append(len(self.edit) - 1)
        return len(self.edit) - 1

    def lifted(self, node: int, depth: int) -> int:
        while (gap := self.depth[node] - depth) > 0:
            node = self.above[node][gap.bit_length() - 1]
        return node

    def compare(self, a: int, b: int) -> int:
        """Negative if audit a comes before b; of two that begin alike the shorter one."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, depth), self.lifted(b, depth)
        if x == y:
            return self.depth[a] - self.depth[b]
        for k in reversed(range(len(self.above[x]))):
            if k < len(self.above[x]) and self.above[x][k] != self.above[y][k]:
                x, y = self.above[x][k], self.above[y][k]
        if self.depth[x] == 0:
            return self.order[x] - self.order[y]
        return -1 if self.edit[x] < self.edit[y] else 1

    def text(self, node: int) -> tuple[int, str]:
        """The state that the audit began in, and its edits."""
        out = []
        while self.depth[node]:
            out.append(self.edit[node])
            node = self.above[node][0]
        return node, "".join(reversed(out))


#: Cost and node by state; states that cannot be reached are left out.
Best = dict[int, tuple[int, int]]


def _offer(audits: Audits, best: Best, state: int, cost: int, node: int, edit: str) -> None:
    if state not in best or cost <= best[state][0]:
        made = audits.then(node, edit)
        if state not in best or cost < best[state][0] or audits.compare(made, best[state][1]) < 0:
            best[state] = (cost, made)


def with_insertions(audits: Audits, best: Best) -> Best:
    """Up to two empty turns may stand before the next row; more lead to a state at a higher cost only."""
    out = dict(best)
    for state, (cost, node) in best.items():
        once = TURN[state]
        _offer(audits, out, once, cost + COST[INSERT], node, INSERT)
        _offer(audits, out, TURN[once], cost + 2 * COST[INSERT], audits.then(node, INSERT), INSERT)
    return out


def after_row(audits: Audits, best: Best, kind: str) -> Best:
    out: Best = {}
    for state, (cost, node) in with_insertions(audits, best).items():
        _offer(audits, out, state, cost + COST[DELETE], node, DELETE)
        if kind != "x":
            extra = cost + TRUNCATED * (kind[1] == "t")
            _offer(audits, out, TURN[state], extra + COST[REROLE], node, REROLE)
            if (kept := STAYS.get((state, kind[0]))) is not None:
                _offer(audits, out, kept, extra, node, KEEP)
    return _hopeful(out)


def _hopeful(best: Best) -> Best:
    """Without states that cost more than any way on from them can save; this keeps standings few.

    What follows nothing can follow an assistant if one kept system row is deleted; what follows a system row can as
    it is. An assistant costs one insertion after a user.
    """
    said = min((best[s][0] + COST[INSERT] * (s == USER) for s in (USER, ASSISTANT) if s in best), default=None)
    spare = {NOBODY: COST[DELETE], SYSTEM: 0}
    return best if said is None else {s: v for s, v in best.items() if s not in spare or v[0] <= said + spare[s]}


def at_end(audits: Audits, best: Best) -> tuple[int, int]:
    """Cost and node of the best audit that ends with nothing said or with an assistant."""
    closed = with_insertions(audits, best)
    ends = [closed[s] for s in (NOBODY, ASSISTANT) if s in closed]
    return min(ends, key=cmp_to_key(lambda a, b: a[0] - b[0] or audits.compare(a[1], b[1])))


#: Costs above the least one by state (None: cannot be reached), and places in the order of audits.
Standing = tuple[tuple[int | None, ...], tuple[int, ...]]
START: Standing = ((0, None, None, None), (0, 0, 0, 0))


def standing(audits: Audits, best: Best) -> Standing:
    ranked = sorted(best, key=cmp_to_key(lambda a, b: audits.compare(best[a][1], best[b][1])))
    least = min(cost for cost, _ in best.values())
    return tuple(best[s][0] - least if s in best else None for s in range(4)), tuple(ranked.index(s) if s in best else 0 for s in range(4))


def begun(at: Standing) -> tuple[Audits, Best]:
    return Audits(at[1]), {s: (cost, s) for s, cost in enumerate(at[0]) if cost is not None}


@lru_cache(maxsize=1)
def standings() -> tuple[list[Standing], dict[str, list[int]]]:
    """All standings that rows can lead to, and for each kind of row where each of them leads."""
    found, place, leads = [START], {START: 0}, {kind: [] for kind in KINDS}
    for at in found:
        for kind in KINDS:
            audits, best = begun(at)
            new = standing(audits, after_row(audits, best, kind))
            if new not in place:
                place[new] = len(found)
                found.append(new)
            leads[kind].append(place[new])
    return found, leads


class Piece:
    """The program over consecutive rows of a conversation, from a standing on."""

    def __init__(self, at: int):
        self.audits, self.best = begun(standings()[0][at])
        self.done: list[dict[int, tuple[int, str]]] = []  # of each finished stretch: by state, where it began and its edits
        self.rows = 0

    def _finish(self) -> None:
        self.done.append({s: self.audits.text(node) for s, (_, node) in self.best.items()})
        _, order = standing(self.audits, self.best)
        self.audits, self.best = Audits(order), {s: (cost, s) for s, (cost, _) in self.best.items()}

    def add(self, kind: str) -> None:
        self.best = after_row(self.audits, self.best, kind)
        self.rows += 1
        if self.rows % STRETCH == 0:
            self._finish()

    def traced(self, state: int, edits: str) -> tuple[int, str]:
        """Back through the finished stretches from ``state``: the state at the piece's begin, and all edits."""
        parts = [edits]
        for stretch in reversed(self.done):
            state, own = stretch[state]
            parts.append(own)
        return state, "".join(reversed(parts))

    def ended(self) -> tuple[int, int, str]:
        """The conversation ends here: cost, state at the piece's begin, edits."""
        cost, node = at_end(self.audits, self.best)
        return cost, *self.traced(*self.audits.text(node))

    def exits(self) -> tuple[int, dict[int, tuple[int, str]]]:
        """The least cost, which the next standing is without, and for each state at the end begin and edits."""
        return min(c for c, _ in self.best.values()), {s: self.traced(*self.audits.text(node)) for s, (_, node) in self.best.items()}


def audit(kinds: list[str]) -> tuple[int, str]:
    """Cost and edits of the cheapest audit of rows of these kinds."""
    piece = Piece(0)
    for kind in kinds:
        piece.add(kind)
    cost, _, edits = piece.ended()
    return cost, edits


@lru_cache(maxsize=KNOWN)
def known_audit(kinds: tuple[str, ...]) -> tuple[int, str]:
    return audit(list(kinds))


# -- rows ----------------------------------------------------------------------------------------------------


def _plain(rows: DataFrame) -> DataFrame:
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *said)


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults planted by crc32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.``, ``!`` and ``?`` out, 3 doubles it, 4 makes it a user's.
    A null is one space, in the key too; turns stay null. Rows that repeat ids and turns get the same fault.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    kept = _plain(rows).withColumn("fault", fault).where("fault <> 0")
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


#: Order of a conversation's rows. Rows of one turn follow their roles, then the digests of their texts.
ORDER = ["turn", "role", "digest"]


def _facts(rows: DataFrame) -> DataFrame:
    """``(at, conv_id, fault, initial)`` in the order of rows, which ``at`` numbers; its high bits name the piece."""
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    own = rows.select("conv_id", "turn", "role", _digest().alias("digest"), last.alias("last"), row_id().alias("source"))
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", *ORDER, "source")]
    placed = settle(own.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", row_id()), "conversation-rows")
    first = placed.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("last") == "", "b").when(F.col("new").isNull(), "d").when(~F.col("last").isin(".", "!", "?"), "t").otherwise(" ")
    initial = F.left("role", F.lit(1))
    return placed.join(first, "at", "left").select("at", F.shiftright("at", 33).alias("piece"), "conv_id", fault.alias("fault"), F.when(initial.isin(*"sua"), initial).otherwise("-").alias("initial"))


def _kind(initial: str, fault: str) -> str:
    return "x" if fault in "bd" else initial + fault


def _folded(facts: DataFrame, extra: list[str], fold, schema: str, fields: list) -> DataFrame:
    """``fold(piece, conv_id, *extra, rows)`` once for each piece of a conversation, its rows a stream in order."""
    lined = facts.repartition("piece").sortWithinPartitions("piece", "at").select("piece", "conv_id", *extra, "initial", "fault")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def lines() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[dict] = []
        for key, rows in groupby(lines(), key=lambda r: r[:-2]):
            out.append({"piece": key[0], "conv_id": key[1]} | fold(*key[2:], (r[-2:] for r in rows)))
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("piece", pa.int64()), ("conv_id", kind), *fields]))
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema([("piece", pa.int64()), ("conv_id", kind), *fields]))

    return lined.mapInArrow(run, f"piece bigint, conv_id {dict(facts.dtypes)['conv_id']}, " + schema)


def _where_to(rows: Iterator[tuple[str, str]]) -> dict:
    """For each standing at a piece's begin the one at its end."""
    leads, now = standings()[1], range(len(standings()[0]))
    for initial, fault in rows:
        step = leads[_kind(initial, fault)]
        now = [step[s] for s in now]
    return {"leads": list(now)}


_EXITS = "array<struct<state:int,entry:int,edits:string>>"
_EXIT = pa.list_(pa.struct([("state", pa.int32()), ("entry", pa.int32()), ("edits", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_MADE = {**dict.fromkeys(_COUNTS, pa.int64()), "first": pa.string(), "last": pa.string(), "entry": pa.int32(), "edits": pa.string(), "exits": _EXIT}


def _run(begin: int | None, ends: bool, rows: Iterator[tuple[str, str]]) -> dict:
    """The program over a piece: where it ends its conversation the edits, else for each state at its end."""
    head = list(islice(rows, SHORT + 1))
    short = ends and not begin and len(head) <= SHORT
    program, seen, illegal, first, before = None if short else Piece(begin or 0), dict.fromkeys("bdt ", 0), 0, None, None
    for initial, fault in chain(head, rows):
        if not short:
            program.add(_kind(initial, fault))
        seen[fault] += 1
        illegal += before is not None and before + initial not in LEGAL
        first, before = first or initial, initial
    out = {"blank": seen["b"], "duplicate": seen["d"], "truncated": seen["t"], "illegal": illegal, "first": first, "last": before}
    if ends:
        if short:
            (cost, edits), entry = known_audit(tuple(_kind(*r) for r in head)), NOBODY
        else:
            cost, entry, edits = program.ended()
        return out | {"cost": cost, "entry": entry, "edits": edits, "exits": []}
    least, exits = program.exits()
    return out | {"cost": least, "exits": [{"state": s, "entry": e, "edits": t} for s, (e, t) in exits.items()]}


def _chained(table: pa.Table) -> pa.Table:
    """The standing that each piece of a conversation begins with."""
    rows, at = sorted(table.select(["piece", "leads"]).to_pylist(), key=lambda r: r["piece"]), 0
    begin = []
    for row in rows:
        begin.append(at)
        at = row["leads"][at]
    pieces = pa.array([r["piece"] for r in rows], pa.int64())
    return pa.table({"own_piece": pieces, "own_id": table["conv_id"], "begin": pa.array(begin, pa.int32()), "ends": pa.array([r is rows[-1] for r in rows])})


def _gathered(table: pa.Table) -> pa.Table:
    """One conversation from the pieces it was cut into."""
    rows = sorted(table.drop_columns("conv_id").to_pylist(), key=lambda r: r["piece"])
    state, parts = rows[-1]["entry"], [rows[-1]["edits"]]
    for row in reversed(rows[:-1]):
        own = next(e for e in row["exits"] if e["state"] == state)
        state = own["entry"]
        parts.append(own["edits"])
    total = {c: sum(r[c] for r in rows) for c in _COUNTS}
    total["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows, rows[1:]))
    counts = {c: pa.array([n], pa.int64()) for c, n in total.items()}
    return pa.table({"conv_id": table["conv_id"].slice(0, 1), **counts, "audit": pa.array(["".join(reversed(parts))])})


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, blank, duplicate, truncated, illegal, cost, audit)`` for each conversation of ``rows``."""
    facts = settle(_facts(_plain(rows)), "conversation-facts")
    kind = dict(facts.dtypes)["conv_id"]
    # A piece shares its first and its last conversation with others at most, so few conversations are cut.
    pieces = facts.select("conv_id", "piece").distinct().groupBy("conv_id").agg(F.count("*").alias("n"))
    cut = facts.join(pieces.where("n > 1").select(F.col("conv_id").alias("own_id")), F.col("conv_id").eqNullSafe(F.col("own_id")), "left_semi")
    leads = _folded(cut, [], _where_to, "leads array<int>", [("leads", pa.list_(pa.int32()))])
    chained = settle(leads.groupBy("conv_id").applyInArrow(_chained, f"own_piece bigint, own_id {kind}, begin int, ends boolean"), "conversation-pieces")
    own = (F.col("piece") == F.col("own_piece")) & F.col("conv_id").eqNullSafe(F.col("own_id"))
    placed = facts.join(chained, own, "left").withColumn("ends", F.coalesce("ends", F.lit(True)))
    counts = "".join(f"{c} bigint, " for c in _COUNTS)
    made = _folded(placed, ["begin", "ends"], lambda *x: _run(*x) | {"cut": x[0] is not None}, f"{counts}first string, last string, entry int, edits string, exits {_EXITS}, cut boolean", [*_MADE.items(), ("cut", pa.bool_())])
    made = settle(made, "conversation-edits")
    joined = made.where("cut").drop("cut").groupBy("conv_id").applyInArrow(_gathered, f"conv_id {kind}, {counts}audit string")
    return made.where("NOT cut").select("conv_id", *_COUNTS, F.col("edits").alias("audit")).union(joined)


def repaired_lines(edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """``role:text`` of a conversation after its edits."""
    state, rows = NOBODY, iter(rows)
    for edit in edits:
        if edit == INSERT:
            state = TURN[state]
            yield f"{SPEAKER[state]}:"
            continue
        role, text = next(rows)
        if edit != DELETE:
            state = TURN[state] if edit == REROLE else STAYS[state, role[:1]]
            yield f"{SPEAKER[state] if edit == REROLE else role}:{text}"


def repaired(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults and the cheapest repair of each conversation of ``rows(conv_id, turn, role, text)``.

    A row for each conv_id, also for those of ``conversations(conv_id)`` without rows: ``gaps`` (turns missing between
    the least and the greatest), ``blank``, ``duplicate``, ``truncated`` (each row's first fault), ``illegal``
    (neighbours whose role initials are not su, ua, au), ``cost``, ``audit`` (initials of the edits), and
    ``repaired_sha256`` (lines ``role:text`` of the result). Without rows: zeros, an empty audit, nothing hashed.

    Rows go by turn, null first, rows of one turn by role and then digest of the text; rows that repeat are
    duplicates. A null role or text is one space; a role that begins with another letter cannot be kept. A null
    conv_id is a conversation. An empty table gives an empty table; other columns are ignored. Texts are hashed
    as a stream in order, one after the other within a conversation, as SHA-256 has it.
    """
    said = _plain(rows)
    ids = said.select("conv_id").union(conversations.select("conv_id")) if conversations is not None else said.select("conv_id")
    turns = said.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("gap_id")).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    found = audits(rows).withColumnRenamed("conv_id", "own_id")
    heads = ids.distinct().join(turns, F.col("conv_id").eqNullSafe(F.col("gap_id")), "left").join(found, F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS)]
    texts = said.select("conv_id", *(F.lit(None).cast("bigint").alias(c) for c in ("gaps", *_COUNTS)), F.lit(None).cast("string").alias("audit"), "turn", "role", _digest().alias("digest"), "text")
    blank = [F.lit(None).cast(kind).alias(c) for c, kind in texts.dtypes[-4:]]
    both = heads.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), *blank).union(texts)
    order = ["conv_id", F.col("audit").asc_nulls_last(), *(F.col(c).asc_nulls_first() for c in ORDER)]
    lined = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "gaps", *_COUNTS, "audit", "role", "text")
    given = lined.columns[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields: list = []

        def lines() -> Iterator[tuple]:
            nonlocal fields
            for batch in batches:
                fields = [batch.schema.field(c) for c in given]
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[dict] = []
        for _, own in groupby(lines(), key=lambda r: r[0]):
            head, digest, before = next(own), hashlib.sha256(), ""
            for line in repaired_lines(head[len(given) - 1], (r[-2:] for r in own)):
                digest.update(f"{before}{line}".encode())
                before = "\n"
            out.append(dict(zip(given, head)) | {"repaired_sha256": digest.hexdigest()})
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, pa.schema([*fields, ("repaired_sha256", pa.string())]))
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema([*fields, ("repaired_sha256", pa.string())]))

    schema = ", ".join(f"{c} {t}" for c, t in lined.dtypes[: len(given)])
    return lined.mapInArrow(run, schema + ", repaired_sha256 string")
