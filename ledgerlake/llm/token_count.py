"""Exact token counts from a compiled finite-state tokenizer.

Two deterministic machines are built from the tokenizer's file.

*Splitter.* A transducer over character classes that writes the token-word
boundaries of the byte-level split pattern (contractions, letter runs, digit
runs, symbol runs, white space with one character of look-ahead). A batch of
texts is cut into chunks of equal length; each chunk becomes a map from entry
state to exit state, the maps are composed by a parallel prefix scan, and with
the entry state of every chunk known all chunks write their boundaries at
once. Text ends are a class of their own that leads back to the start.

Words are told apart by their bytes: a hash only says which ones to compare.

*Merger.* Byte-pair merging of a word, read byte by byte. A state holds, for
every place where a token may still be open, the token that ends there in the
encoding of the prefix and its count relative to the whole prefix; each
transition is annotated with the change of the token count (an encoding of a
longer prefix may have fewer tokens). Two tokens may stand side by side if
merging their joined bytes gives them back. States are compiled on first use
and kept in a bounded table.

Counts equal those of the library: no begin, end or added special tokens; the
file's special strings inside a text count as one token each.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
count alike; other columns are ignored. Rows never move; a task holds a few
arrays per chunk batch of about a million characters and the word table.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, utf8

LIMIT_TOKENS = 512
CHUNK = 128  # characters per chunk of the scan
SLICE = 1 << 20  # bytes of text handled at once
MAX_COMPILED = 800_000  # transitions and words kept per worker
REMEMBERED = 64  # bytes of the longest word kept
TOKENIZER = "byte_bpe_50k.json"

# Character classes. Letters that may end a contraction have classes of their own.
LETTER, NUMBER, BLANK, WHITE, QUOTE, OTHER, L_ONE, L_RV, L_E, L_L, END = range(11)
# States: at a start, in a run, after white space, and inside a contraction.
START, S_L, S_N, S_O, S_BLANK, S_WHITE, S_QUOTE, S_RV, S_LL, S_DONE = range(10)


def splitter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``next[state, class]`` and whether a boundary lies before this (``here``) or the previous character (``back``)."""
    letters = {LETTER, L_ONE, L_RV, L_E, L_L}
    nxt = np.zeros((10, 11), dtype=np.uint8)
    here = np.zeros((10, 11), dtype=bool)
    back = np.zeros((10, 11), dtype=bool)
    first = {NUMBER: S_N, BLANK: S_BLANK, WHITE: S_WHITE, QUOTE: S_QUOTE, OTHER: S_O, END: START, **dict.fromkeys(letters, S_L)}
    for s in range(10):
        for c in range(11):
            to, new, late = first[c], True, False
            if c == END:
                late = s in (S_RV, S_LL)
            elif s == S_L and c in letters or s == S_N and c == NUMBER or s == S_O and c in (OTHER, QUOTE):
                to, new = s, False
            elif s in (S_BLANK, S_WHITE) and c in (BLANK, WHITE):
                new = False  # one run of white space
            elif s == S_BLANK:  # the blank belongs to what follows
                new, late = False, True
                to = S_O if c == QUOTE else to
            elif s == S_WHITE:  # the last character of the run stands alone
                late = True
            elif s == S_QUOTE:
                if c == L_ONE:
                    to, new = S_DONE, False
                elif c == L_RV:
                    to, new = S_RV, False
                elif c == L_L:
                    to, new = S_LL, False
                elif c in (OTHER, QUOTE):
                    to, new = S_O, False
            elif s == S_RV and c == L_E or s == S_LL and c == L_L:
                to, new = S_DONE, False
            elif s in (S_RV, S_LL):  # no contraction: the letter began a word
                late, new = True, c not in letters
            nxt[s, c], here[s, c], back[s, c] = to, new, late
    return nxt, here, back


def class_table() -> np.ndarray:
    """The class of every code point."""
    points = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, points):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = np.where(out[a : b + 1] == OTHER, kind, out[a : b + 1])
    out[0xD800:0xE000] = OTHER
    for chars, kind in ((" ", BLANK), ("'", QUOTE), ("stmd", L_ONE), ("rv", L_RV), ("e", L_E), ("l", L_L)):
        out[[ord(c) for c in chars]] = kind
    return out


class Splitter:
    """Boundaries of token words by chunk maps and a prefix scan."""

    def __init__(self):
        self.next, self.here, self.back = splitter_tables()
        self.classes = class_table()

    def states(self, classes: np.ndarray) -> np.ndarray:
        """The state before every character, for a sequence of classes that starts at a text start."""
        n = len(classes)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, END, dtype=np.uint8)
        grid[:n] = classes
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        maps = np.tile(np.arange(10, dtype=np.uint8), (rows, 1))
        for column in grid:
            maps = self.next[maps, column[:, None]]
        # Prefix scan: after step k, maps[i] spans 2**k chunks that end with i.
        step = 1
        while step < rows:
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
            step *= 2
        state = np.zeros(rows, dtype=np.uint8)
        state[1:] = maps[:-1, START]
        out = np.empty((CHUNK, rows), dtype=np.uint8)
        for k, column in enumerate(grid):
            out[k] = state
            state = self.next[state, column]
        return out.T.reshape(-1)[:n]

    def boundaries(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """True where a token word starts. ``ends``: positions of the text-end marks among ``points``."""
        classes = self.classes[points]
        classes[ends] = END
        state = self.states(classes)
        out = self.here[state, classes]
        late = self.back[state, classes]
        out[:-1] |= late[1:]
        return out


class Merger:
    """Token counts of words by the compiled byte transducer."""

    def __init__(self, spec: dict):
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed rule of byte-level vocabularies
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        to_bytes = lambda t: bytes(byte[c] for c in t)
        model = spec["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.halves = [(to_bytes(a), to_bytes(b)) for a, b in pairs]
        self.ranks = {pair: r for r, pair in enumerate(self.halves)}
        self.made: dict[bytes, int] = {}
        for r, (a, b) in enumerate(self.halves):
            self.made.setdefault(a + b, r)
        self.own: dict[bytes, bool] = {}
        specials = {t["content"] for t in spec["added_tokens"]}
        self.tree: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for t in model["vocab"]:
            if t in specials:
                continue
            node, raw = 0, to_bytes(t)
            for b in raw:
                if b not in self.tree[node]:
                    self.tree[node][b] = len(self.tree)
                    self.tree.append({})
                    self.token.append(None)
                node = self.tree[node][b]
            self.token[node] = raw
        self.clear()

    def clear(self):
        self.moves: dict[int, tuple[int, int]] = {}
        self.ids = {((0, None, 0),): 0}
        self.keys = [((0, None, 0),)]
        self.side_by_side: dict[tuple[bytes, bytes], bool] = {}

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stay side by side: undo their merges, the latest first, and look whether a merge
        across the border would have come before the undone one (on equal rank the left place comes first)."""
        known = self.side_by_side.get((left, right))
        if known is not None:
            return known
        key, limit, free = (left, right), len(self.ranks) + 1, True
        while True:
            across = self.ranks.get((left, right))
            if across is not None and across < limit:
                free = False
                break
            l, r = self.made.get(left, -1), self.made.get(right, -1)
            if l > r:
                limit, left = l, self.halves[l][1]
            elif r >= 0:
                limit, right = r + 1, self.halves[r][0]
            else:
                break
        self.side_by_side[key] = free
        return free

    def whole(self, token: bytes) -> bool:
        """Whether a vocabulary entry is its own encoding."""
        known = self.own.get(token)
        if known is None:
            r = self.made.get(token)
            known = len(token) == 1 if r is None else all(map(self.whole, self.halves[r])) and self.joins(*self.halves[r], r)
            self.own[token] = known
        return known

    def joins(self, left: bytes, right: bytes, rank: int) -> bool:
        """Whether the two halves of a merge stay side by side until that merge."""
        limit = rank
        while True:
            l, r = self.made.get(left, -1), self.made.get(right, -1)
            if l < 0 and r < 0:
                return True
            if l > r:
                limit, left = min(limit, l), self.halves[l][1]
            else:
                limit, right = min(limit, r + 1), self.halves[r][0]
            across = self.ranks.get((left, right))
            if across is not None and across < limit:
                return False

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Compile one transition: the next state and the change of the token count."""
        grown, last = [], None
        for node, before, count in self.keys[state]:
            child = self.tree[node].get(byte)
            if child is None:
                continue
            grown.append((child, before, count))
            token = self.token[child]
            if token is not None and last is None and (before is None or self.fits(before, token)) and self.whole(token):
                last = (token, count + 1)
        token, change = last
        key = tuple((n, b, c - change) for n, b, c in grown if self.tree[n]) + ((0, token, 0),)
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.keys)
            self.keys.append(key)
        self.moves[state << 8 | byte] = (to, change)
        return to, change

    def count(self, word: bytes) -> int:
        if len(self.moves) > MAX_COMPILED:
            self.clear()
        state = total = 0
        moves = self.moves
        for byte in word:
            move = moves.get(state << 8 | byte) or self.step(state, byte)
            state = move[0]
            total += move[1]
        return total


def unlike(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Whether each word ``data[begin:stop]`` differs from word number ``same``, byte by byte."""
    size = stop - begin
    other = size != size[same]
    repeats = np.flatnonzero((same != np.arange(len(same))) & ~other)
    cuts = np.flatnonzero(np.diff(np.cumsum(size[repeats]) // SLICE)) + 1
    for check in np.split(repeats, cuts) if len(repeats) else []:
        own = size[check]
        ends = np.cumsum(own)
        place = np.arange(ends[-1]) - np.repeat(ends - own, own)
        differs = data[place + np.repeat(begin[check], own)] != data[place + np.repeat(begin[same[check]], own)]
        other[check] = np.logical_or.reduceat(differs, ends - own)
    return other


class TokenCounter:
    """Counts of many texts at once."""

    def __init__(self, spec: dict):
        self.splitter, self.merger = Splitter(), Merger(spec)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        rng = np.random.default_rng(11)
        self.code = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.known: dict[bytes, int] = {}
        self.grow(1 << 16)

    def grow(self, n: int):
        powers = np.full(n, self.base, dtype=np.uint64)
        powers[0] = 1
        self.up = np.cumprod(powers)
        powers = np.full(n, self.inverse, dtype=np.uint64)
        powers[0] = 1
        self.down = np.cumprod(powers)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, in slices of bounded size."""
        out = np.zeros(len(texts), dtype=np.int64)
        pieces, owners, size = [], [], 0
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and any(s in text for s in self.specials):
                parts = self.special.split(text)
                out[i] += len(parts) - 1
            for part in parts:
                pieces.append(part)
                owners.append(i)
                size += len(part)
            if size >= SLICE:
                self.add(pieces, owners, out)
                pieces, owners, size = [], [], 0
        self.add(pieces, owners, out)
        return out

    def add(self, pieces: list[str], owners: list[int], out: np.ndarray) -> None:
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        if not lengths.sum():
            return
        joined = "\x00".join(pieces) + "\x00"  # the mark; its class is set by place, not by value
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(lengths + 1) - 1
        starts = self.splitter.boundaries(points, ends)
        starts[ends] = True
        raw = joined.encode("utf-8")
        data = np.frombuffer(raw, dtype=np.uint8)
        lead = np.nonzero((data & 0xC0) != 0x80)[0]  # byte place of every code point
        at = np.nonzero(starts)[0]
        is_end = np.zeros(len(points), dtype=bool)
        is_end[ends] = True
        begin = lead[at]
        stop = np.append(begin[1:], len(data))
        owner = np.repeat(np.array(owners, dtype=np.int64), lengths + 1)[at]
        real = ~is_end[at]
        begin, stop, owner = begin[real], stop[real], owner[real]
        if len(data) + 1 > len(self.up):
            self.grow(2 * len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.code[data] * self.up[: len(data)], out=sums[1:])
        keys = (sums[stop] - sums[begin]) * self.down[begin] + (stop - begin).astype(np.uint64)
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        made = np.array([self.word(raw[b:e]) for b, e in zip(begin[first].tolist(), stop[first].tolist())], dtype=np.int64)
        each = made[inverse]
        for k in np.flatnonzero(unlike(data, begin, stop, first[inverse])).tolist():  # equal keys of different words
            each[k] = self.word(raw[begin[k] : stop[k]])
        out += np.bincount(owner, weights=each, minlength=len(out)).astype(np.int64)

    def word(self, raw: bytes) -> int:
        """The count of one word, remembered by its bytes."""
        n = self.known.get(raw)
        if n is None:
            if len(self.known) > MAX_COMPILED:
                self.known.clear()
            n = self.merger.count(raw)
            if len(raw) <= REMEMBERED:
                self.known[raw] = n
        return n


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def worker_counter(spec: str) -> TokenCounter:
    """One counter per Python worker, so that its compiled tables serve all tasks the worker runs."""
    store = sys.modules.setdefault("_ledgerlake_worker_store", types.ModuleType("_ledgerlake_worker_store"))
    kept = getattr(store, "counter", None)
    if kept is None or kept[0] != spec:
        kept = store.counter = (spec, TokenCounter(json.loads(spec)))
    return kept[1]


def count_tokens(docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per row. ``tokenizer_json`` is the file's content (fixed size)."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches):
        counter = worker_counter(shared.value)
        for batch in batches:
            bodies = batch.column("body")
            texts = [b.as_py().decode("utf-8", "replace") for b in bodies]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n_bytes": [len(b.as_buffer()) for b in bodies], "n_tokens": counter.counts(texts)},
                schema=RESULT,
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(F.col(text_col)).alias("body"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op6(spark, sf_dir):
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT_TOKENS)
