"""Repair of role sequences by generalised LR parsing with weighted edits.

A conversation's rows, in order of turn, are the input of an LR automaton
built from the role grammar. Its graph-structured stack holds, after every
row, one stack for each state on top: stacks with equal tops have the same
future, so only the one with the least (cost, audit) stays. A row is kept,
rerole'd, or deleted, rows may be inserted before it, and the back links of
the stack give the cheapest edits.

Audits grow with the rows, so they are never compared as strings: after a row no audit is the beginning of another, so the order of
those up to the row and the letters of the next row settle every tie. Costs
beyond the least by ``PRUNE`` cannot win any more (five buy the way from any
state to any other), so the stack takes few different forms, whose steps are
remembered.

Scale: text is grouped once by conversation and content (equal rows collapse
before the shuffle) and ranged once by conversation, turn and content. A
task streams its range: conversations inside it are finished at once, with a
bounded buffer. A conversation that reaches the end of a range, or exceeds
``BUFFER_ROWS``, is a chain of pieces: each piece is parsed from every state
on its own, and the pieces' state maps are composed per conversation. So
a conversation with a third of all rows is parsed by as many tasks as it fills
ranges. Only the digest of its repaired text is computed in order, by one
stream of bounded memory, as SHA-256 is a chain. What is gathered per
conversation (back links, a few bytes a row) is of the size of its audit.

Defined results: see the columns of :func:`repair`. A null conversation is a
conversation of its own; null turns come first; rows of one turn are ordered
by the digest of role and text, equal rows are adjacent; a null role or text
is one space; a role that starts with neither u, a nor s can be rerole'd or
deleted, not kept; an empty table gives an empty result; other columns are
ignored. An audit has a letter a row, so a conversation of more than 2**31
rows exceeds what a string can hold.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table

# The role grammar, the costs and letters of the edits, the legal pairs of neighbours.
GRAMMAR = (("S", ()), ("S", ("P",)), ("S", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEGAL_PAIRS = {"su", "ua", "au"}
#: A stack this much dearer than the cheapest cannot win; any bound of at least 6 is exact.
PRUNE = 16
#: Rows of a conversation that a task holds back; longer ones are finished from pieces.
BUFFER_ROWS = 4096


# -- the automaton ---------------------------------------------------------------------


class Automaton:
    """LR(0) states of the grammar with their shifts; reductions follow a shift at once."""

    def __init__(self, grammar=GRAMMAR, inserted=tuple(ROLES)):
        self.grammar, kinds = grammar, {head for head, _ in grammar}
        self.terminals = sorted({x for _, body in grammar for x in body} - kinds)
        start = self._closed({(k, 0) for k, (head, _) in enumerate(grammar) if head == "S"})
        self.items, stacks, todo = [start], [(0,)], [0]
        known = {start: 0}
        self.shift: list[dict[str, int]] = []
        while len(self.shift) < len(self.items):
            at = len(self.shift)
            self.shift.append({})
            for x in self.terminals:
                stack = self._push(stacks[at], x, known, stacks)
                if stack:
                    self.shift[at][x] = stack[-1]
        self.accepting = {k for k, state in enumerate(self.items) if any(grammar[r][0] == "S" and dot == len(grammar[r][1]) for r, dot in state)}
        # Only one role can be inserted anywhere: 0, 1, ... of them lead along a chain of states.
        self.chain: list[list[tuple[int, str]]] = []
        for k in range(len(self.items)):
            seen, way, at = {k}, [], k
            while (x := next((x for x in inserted if x in self.shift[at]), None)) and self.shift[at][x] not in seen:
                at = self.shift[at][x]
                seen.add(at)
                way.append((at, x))
            self.chain.append(way)

    def _closed(self, items):
        items = set(items)
        while True:
            more = {(k, 0) for r, dot in items if dot < len(self.grammar[r][1]) for k, (head, _) in enumerate(self.grammar) if head == self.grammar[r][1][dot]} - items
            if not more:
                return frozenset(items)
            items |= more

    def _goto(self, stack, x, known, stacks):
        moved = self._closed({(r, dot + 1) for r, dot in self.items[stack[-1]] if dot < len(self.grammar[r][1]) and self.grammar[r][1][dot] == x})
        if not moved:
            return None
        if moved not in known:
            known[moved] = len(self.items)
            self.items.append(moved)
            stacks.append((*stack, known[moved]))
        return (*stack, known[moved])

    def _push(self, stack, x, known, stacks):
        """The stack after a shift of ``x`` and the reductions that follow."""
        stack = self._goto(stack, x, known, stacks)
        while stack and (done := [r for r, dot in self.items[stack[-1]] if dot == len(self.grammar[r][1]) and self.grammar[r][0] != "S"]):
            head, body = self.grammar[done[0]]
            stack = self._goto(stack[: -len(body)], head, known, stacks)
        return stack


AUTOMATON = Automaton()
STATES = len(AUTOMATON.items)
#: States that can be on top after a whole row.
TOPS = sorted({0, *(to for shifts in AUTOMATON.shift for to in shifts.values())})
#: What one row can add to the audit, in ASCII order: its place in this list stands for it.
LETTERS = sorted({"I" * k + x for k in range(max(map(len, AUTOMATON.chain)) + 1) for x in "KR"} | {"D"})


@lru_cache(maxsize=None)
def row_moves(initial: str, forced: bool, truncated: bool) -> tuple:
    """By state: ``(next state, cost, letters)`` of every way to take one row."""
    out = []
    for state in range(STATES):
        moves = [(state, DELETE, LETTERS.index("D"))]
        if not forced:
            for k, at in enumerate([state, *(s for s, _ in AUTOMATON.chain[state])]):
                cost = k * INSERT + (TRUNCATED if truncated else 0)
                for x, to in AUTOMATON.shift[at].items():
                    if x == initial:
                        moves.append((to, cost + KEEP, LETTERS.index("I" * k + "K")))
                    if x in ROLES:
                        moves.append((to, cost + REROLE, LETTERS.index("I" * k + "R")))
        out.append(tuple(moves))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def stack_step(tops: tuple, initial: str, forced: bool, truncated: bool) -> tuple:
    """One row. ``tops`` has ``(cost, rank)`` or None by state, the least cost 0.
    Returns the new tops, what their costs were lowered by, and a back link a
    state: ``previous state * 16 + letters`` (255: none)."""
    moves = row_moves(initial, forced, truncated)
    best: list = [None] * STATES
    for state, top in enumerate(tops):
        if top is not None:
            for to, cost, letters in moves[state]:
                found = (top[0] + cost, top[1], letters, state)
                if best[to] is None or found < best[to]:
                    best[to] = found
    least = min(b[0] for b in best if b)
    best = [b if b and b[0] <= least + PRUNE else None for b in best]
    order = {b[1:3]: k for k, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
    links = bytes(255 if b is None else b[3] * 16 + b[2] for b in best)
    return tuple(None if b is None else (b[0] - least, order[b[1:3]]) for b in best), least, links


class Parse:
    """The stack from one state on: costs, ranks and back links."""

    def __init__(self, start: int):
        self.tops = tuple((0, 0) if k == start else None for k in range(STATES))
        self.cost, self.links = 0, bytearray()

    def take(self, initial: str, forced: bool, truncated: bool):
        self.tops, less, links = stack_step(self.tops, initial, forced, truncated)
        self.cost += less
        self.links += links

    def ends(self) -> dict[int, tuple[int, int]]:
        return {k: (t[0] + self.cost, t[1]) for k, t in enumerate(self.tops) if t is not None}


def closing(ends: dict[int, tuple[int, int]]) -> tuple[int, int, int]:
    """``(cost, state, inserts)`` of the cheapest way to an accepted end."""
    best = min(
        (cost + k * INSERT, rank, k, state)
        for state, (cost, rank) in ends.items()
        for k, at in enumerate([state, *(s for s, _ in AUTOMATON.chain[state])])
        if at in AUTOMATON.accepting
    )
    return best[0], best[3], best[2]


def audit_of(links: bytes, end: int) -> str:
    """The letters along the back links that lead to ``end``."""
    out = []
    for at in range(len(links) - STATES, -1, -STATES):
        link = links[at + end]
        out.append(LETTERS[link & 15])
        end = link >> 4
    return "".join(reversed(out))


class Repaired:
    """Takes an audit and rows in order; gives the digest of the repaired rows."""

    def __init__(self):
        self.state, self.digest, self.lines, self.sha = 0, None, 0, hashlib.sha256()

    def line(self, role: str, text: str, x: str):
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.state = AUTOMATON.shift[self.state][x]

    def insert(self):
        x = AUTOMATON.chain[self.state][0][1]
        self.line(ROLES[x], "", x)

    def rerole(self, text: str):
        x = next(x for x in ROLES if x in AUTOMATON.shift[self.state])
        self.line(ROLES[x], text, x)

    def apply(self, letter: str, row: tuple[str, str] | None):
        if letter == "I":
            self.insert()
        elif letter == "K":
            self.line(*row, row[0][:1])
        elif letter == "R":
            self.rerole(row[1])


def repaired_digest(audit: str, rows: list[tuple[str, str] | None]) -> str:
    out, k = Repaired(), 0
    for letter in audit:
        out.apply(letter, None if letter == "I" else rows[k])
        k += letter != "I"
    return out.sha.hexdigest()


# -- the faults, as columns ----------------------------------------------------------------


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text, copies)`` after the damage of the contract; dropped rows stay, with no copies."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")), F.lit(20))
    return df.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), kind.alias("kind")).select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


SPACE = r"\x20\x09-\x0D"


def occurrences(rows: DataFrame) -> DataFrame:
    """Rows of the stream: every different ``(conv, turn, content)`` with its number
    of copies, and before the first of a content its role and text. Dropped rows
    leave one row a conversation, without copies."""
    content = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256), 1, 32))
    there = rows.where("copies > 0").select(
        "conv", "turn", content.alias("content"), "role", "text", "copies", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")).alias("cut"),
    )
    narrow = there.groupBy("conv", "turn", "content").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.first(F.substring("role", 1, 1)).alias("initial")
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = there.where("not blank").groupBy("conv", "content").agg(F.min(when).alias("at"), F.first("role").alias("role"), F.first("text").alias("text"))
    nothing = lambda kind: F.lit(None).cast(kind)
    texts = first.select("conv", F.col("at.turn").alias("turn"), "content", F.lit(0).alias("kind"), "role", "text",
                         nothing("bigint").alias("copies"), nothing("boolean").alias("blank"), nothing("boolean").alias("cut"), nothing("string").alias("initial"))
    marks = narrow.select("conv", "turn", "content", F.lit(1).alias("kind"), nothing("string").alias("role"), nothing("string").alias("text"), "copies", "blank", "cut", "initial")
    gone = rows.where("copies = 0").select("conv").distinct().select(
        "conv", nothing("bigint").alias("turn"), nothing("binary").alias("content"), F.lit(1).alias("kind"), nothing("string").alias("role"),
        nothing("string").alias("text"), F.lit(0).cast("bigint").alias("copies"), nothing("boolean").alias("blank"), nothing("boolean").alias("cut"), nothing("string").alias("initial"),
    )
    return texts.unionByName(marks).unionByName(gone)


# -- the stream ------------------------------------------------------------------------------

STATS = ("rows", "distinct", "blank", "duplicate", "truncated", "illegal")
DONE = pa.schema([
    ("conv", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
DONE_DDL = "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
#: kind 0: a finished conversation; 1: a piece; 2: a row of a piece, for the digest.
OUT_DDL = f"kind int, {DONE_DDL}, piece int, place bigint, summary binary, role string, text string"


class Piece:
    """What a stretch of one conversation adds up to."""

    def __init__(self, starts):
        self.parses = {s: Parse(s) for s in starts}
        self.sums = dict.fromkeys(STATS, 0)
        self.turns: list = []  # first and last turn that is not null
        self.edges: list[str] = []  # first and last initial
        self.rows: list = []  # (role, text) or None for rows that must go; held back
        self.written = 0  # rows of the piece that have been written

    def take(self, turn, initial, copies, blank, cut, content):
        """``copies`` equal rows; ``content`` is (role, text) if the first is no duplicate."""
        sums = self.sums
        sums["rows"] += copies
        if turn is not None:
            if not self.turns:
                self.turns, sums["distinct"] = [turn, turn], 1
            elif self.turns[1] != turn:
                self.turns[1] = turn
                sums["distinct"] += 1
        if self.edges and self.edges[1] + initial not in LEGAL_PAIRS:
            sums["illegal"] += 1
        if initial + initial not in LEGAL_PAIRS:
            sums["illegal"] += copies - 1
        self.edges = [self.edges[0] if self.edges else initial, initial]
        fresh = content is not None
        sums["blank" if blank else "duplicate"] += copies - fresh
        sums["truncated"] += fresh and cut
        for k in range(copies):
            first = fresh and k == 0
            for parse in self.parses.values():
                parse.take(initial if first else "", not first, first and cut)
            self.rows.append(content if first else None)
            if len(self.rows) >= BUFFER_ROWS:
                yield

    def summary(self) -> bytes:
        import pickle

        state = {s: (p.ends(), bytes(p.links)) for s, p in self.parses.items()}
        return zlib.compress(pickle.dumps((state, self.sums, self.turns, self.edges)), 1)


def gaps(turns: list, distinct: int) -> int:
    return turns[1] - turns[0] + 1 - distinct if turns else 0


def stream(batches):
    """A sorted range of :func:`occurrences`: finished conversations, pieces, and rows of pieces."""
    here = TaskContext.get().partitionId()
    out: list[dict] = []
    piece, conv, opening, content, gone = None, None, True, None, False

    def write():
        schema = pa.schema([("kind", pa.int32()), *DONE, ("piece", pa.int32()), ("place", pa.int64()), ("summary", pa.binary()), ("role", pa.string()), ("text", pa.string())])
        batch = pa.RecordBatch.from_pylist(out, schema=schema)
        out.clear()
        return batch

    def write_rows():
        for row in piece.rows:
            out.append({"kind": 2, "conv": conv, "piece": here, "place": piece.written, "role": row and row[0], "text": row and row[1]})
            piece.written += 1
        piece.rows.clear()

    def end(last: bool):
        if opening or last or piece.written:
            write_rows()
            out.append({"kind": 1, "conv": conv, "piece": here, "summary": piece.summary()})
            return
        parse = piece.parses[0]
        cost, state, inserts = closing(parse.ends())
        audit = audit_of(bytes(parse.links), state) + "I" * inserts
        s = piece.sums
        out.append({"kind": 0, "conv": conv, "gaps": gaps(piece.turns, s["distinct"]), "blank": s["blank"], "duplicate": s["duplicate"], "truncated": s["truncated"],
                    "illegal": s["illegal"], "cost": cost, "audit": audit, "repaired_sha256": repaired_digest(audit, piece.rows)})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "content", "kind", "role", "text", "copies", "blank", "cut", "initial")]
        for c, turn, key, kind, role, text, copies, blank, cut, initial in zip(*columns):
            if piece is None or c != conv:
                if piece is not None:
                    end(False)
                    opening = False
                piece, conv = Piece(TOPS if opening else [0]), c
            if kind == 0:
                content = (turn, key, role, text)
            elif copies:
                first = content is not None and content[:2] == (turn, key)
                for _ in piece.take(turn, initial, copies, blank, cut, content[2:] if first else None):
                    write_rows()
                    if len(out) >= BUFFER_ROWS:
                        yield write()
                content = None
            if len(out) >= BUFFER_ROWS:
                yield write()
    if piece is not None:
        end(True)
    if out:
        yield write()


def compose(pieces: pa.Table) -> pa.Table:
    """One conversation's pieces in order: its row, and the audit of every piece."""
    import pickle

    rows = sorted(zip(pieces.column("piece").to_pylist(), pieces.column("summary").to_pylist()))
    conv = pieces.column("conv")[0].as_py()
    ends, sums, turns, last, chosen = {0: (0, 0)}, dict.fromkeys(STATS, 0), [], None, []
    for _, raw in rows:
        maps, own, own_turns, edges = pickle.loads(zlib.decompress(raw))
        best: dict[int, tuple] = {}
        for start, (cost, rank) in ends.items():
            for to, (more, inner) in maps[start][0].items():
                found = (cost + more, rank, inner, start)
                best[to] = min(best.get(to, found), found)
        order = {b[1:3]: k for k, b in enumerate(sorted(best.values(), key=lambda b: b[1:3]))}
        ends = {to: (b[0], order[b[1:3]]) for to, b in best.items()}
        chosen.append(({to: b[3] for to, b in best.items()}, {s: links for s, (_, links) in maps.items()}))
        if own_turns:
            sums["distinct"] -= bool(turns) and turns[1] == own_turns[0]
            turns = [turns[0] if turns else own_turns[0], own_turns[1]]
        if edges:
            sums["illegal"] += last is not None and last + edges[0] not in LEGAL_PAIRS
            last = edges[1]
        for k in STATS:
            sums[k] += own[k]
    cost, state, inserts = closing(ends)
    audits = []
    for back, links in reversed(chosen):
        audits.append(audit_of(links[back[state]], state))
        state = back[state]
    audits = audits[::-1]
    audits[-1] += "I" * inserts
    out = [{"conv": conv, "piece": piece, "place": -1, "audit": a} for (piece, _), a in zip(rows, audits)]
    out.append({"conv": conv, "piece": -1, "place": -1, "gaps": gaps(turns, sums["distinct"]), "cost": cost, "audit": "".join(audits), **{k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal")}})
    return pa.Table.from_pylist(out, schema=ORDERED)


ORDERED = pa.schema([*DONE, ("piece", pa.int32()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
ORDERED_DDL = f"{DONE_DDL}, piece int, place bigint, role string, text string"


def digests(batches):
    """The rows of split conversations with their audits, in order: finished rows with the digest."""
    done, repaired, letters = None, None, iter("")
    out: list[dict] = []

    def finish():
        for letter in letters:
            repaired.apply(letter, None)
        out.append({**done, "repaired_sha256": repaired.sha.hexdigest()})

    for batch in batches:
        for r in batch.to_pylist():
            if r["piece"] < 0:
                if done is not None:
                    finish()
                done, repaired, letters = {f.name: r[f.name] for f in DONE}, Repaired(), iter("")
            elif r["place"] < 0:
                for letter in letters:
                    repaired.apply(letter, None)
                letters = iter(r["audit"])
            else:
                row = None if r["text"] is None else (r["role"], r["text"])
                for letter in letters:
                    repaired.apply(letter, row)
                    if letter != "I":
                        break
        if len(out) >= BUFFER_ROWS:
            yield pa.RecordBatch.from_pylist(out, schema=DONE)
            out.clear()
    if done is not None:
        finish()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=DONE)


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows(conv, turn, role, text, copies)``: ``gaps``, the
    counts ``blank``, ``duplicate``, ``truncated`` (each row by its first fault) and
    ``illegal``, the least ``cost`` of edits, their ``audit`` and the digest of the
    repaired rows. A row without copies only names its conversation."""
    scratch = Scratch(rows.sparkSession)
    # Nulls first in both orders; copies of a key always share a range.
    order = ["conv", "turn", "content", "kind"]
    keyed = scratch.table(occurrences(rows), "repair-rows")
    ranges = keyed.repartitionByRange("conv", "turn", "content").sortWithinPartitions(*order)
    streamed = scratch.table(ranges.mapInArrow(stream, OUT_DDL), "repair-stream")
    pieces = streamed.where("kind = 1").select("conv", "piece", "summary").groupBy("conv").applyInArrow(compose, ORDERED_DDL)
    texts = streamed.where("kind = 2").select(*[f.name for f in ORDERED])
    split = pieces.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "piece", "place").mapInArrow(digests, DONE_DDL)
    return streamed.where("kind = 0").select(*[f.name for f in DONE]).unionByName(split)


def op13(spark, sf_dir):
    rows = damaged(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return repair(rows).withColumnRenamed("conv", "conv_id")
