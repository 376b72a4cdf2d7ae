"""Exact substring dedup with a distributed, sparse suffix array.

A byte is removed if a 50-byte string that covers it also starts in a document
with a smaller id. Every 50-byte string holds 27 starts of 24-byte grams; the
leftmost one with the smallest hash is its anchor, the same in every copy. So
equal strings have equal anchors, and only suffixes that start at anchors
(about one byte in fourteen) need sorting.

1. Documents are kept in blocks of hashed ids (a bucketed table, so that later
   steps meet a block's text without moving it again).
2. Each block sends the distinct hashes of its anchor grams to hash ranges,
   which answer which of them a second block or document has too.
3. Only those suffixes go on: sampled splitters range-partition them by their
   leading bytes (one gram never straddles a border, so neighbouring ranges
   share no string of 50 bytes); each range sorts its suffixes by multikey
   quicksort on 8-byte words, groups equal prefixes by the common prefix with
   the neighbour, does the same to the left of the anchor, and finds for each
   of the 27 places of a 50-byte string the smallest id that has it.
4. Blocks mark the covered bytes and hash what is left.

Scale: what moves is 4 bytes per distinct anchor and block, then the 76 bytes
round each shared anchor, once per block, then the answers. A passage that a
third of all documents share is one row per block, never one per document. No
task holds more than its block or its range; the driver sees a bounded sample.

Defined results: null and empty texts have no bytes and lose none; texts
shorter than 50 bytes lose none; a null id counts as larger than all others;
rows that repeat an id do not remove each other's bytes; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_names, materialised, table, utf8

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1  # gram starts in a string of LENGTH bytes
REACH = SPAN - 1  # bytes before and after an anchor gram that its strings may need
#: Text bytes per block and per slice of a block.
BLOCK_BYTES = 24 << 20
SLICE_BYTES = 1 << 20
#: String starts whose anchors are found at once.
STRIDE = 1 << 16
#: Leading byte strings sampled for the splitters (their number bounds what the driver sees).
SAMPLE = 20_000
LAST = 2**63 - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


# -- anchors ----------------------------------------------------------------------


def unaligned(data: np.ndarray, kind: str) -> np.ndarray:
    """The word that starts at each place of ``data``, as a view."""
    return np.ndarray((len(data) - np.dtype(kind).itemsize + 1,), kind, buffer=data, strides=(1,))


def gram_ranks(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the ``GRAM`` bytes from each place (24 = 8 + 16), by doubling: it only picks anchors."""
    four = unaligned(data, "<u4") * np.uint32(0x9E3779B1)
    four ^= four >> np.uint32(15)
    eight = four[:-4] * np.uint32(0x85EBCA77)
    eight += four[4:]
    sixteen = eight[:-8] * np.uint32(0xC2B2AE3D)
    sixteen += eight[8:]
    out = sixteen[:-8] * np.uint32(0x27D4EB2F)
    out += eight[16:]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return out


def mixed(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of 8-byte words."""
    out = np.zeros(len(words), dtype=np.uint64)
    for k in range(words.shape[1]):
        word = words[:, k] * np.uint64(0xD6E8FEB86659FD93)
        word ^= word >> np.uint64(29)
        out *= np.uint64(0xA0761D6478BD642F)
        out += word
    out ^= out >> np.uint64(31)
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


def gram_hashes(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each of the given places."""
    if not len(place):
        return np.zeros(0, dtype=np.uint64)
    return mixed(np.lib.stride_tricks.sliding_window_view(data, GRAM)[place].view("<u8"))


def window_minima(ranks: np.ndarray) -> np.ndarray:
    """Minimum over ``SPAN`` = 27 places: widths 2, 4, 8, 16, then two overlapping 16s."""
    out = ranks
    for w in (1, 2, 4, 8):
        out = np.minimum(out[:-w], out[w:])
    return np.minimum(out[: len(out) - (SPAN - 16)], out[SPAN - 16 :])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Anchors of texts laid end to end in ``data``.

    Returns ``(place, first, last, text, gram hash)``: the anchor's place, the
    first and last start of the 50-byte strings it stands for, and their text.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    total = len(data) - LENGTH + 1
    opens = starts[ends - starts >= LENGTH]
    firsts, places = [], []
    for begin in range(0, total, STRIDE):  # arrays that stay in the processor's cache
        end, low = min(begin + STRIDE, total), max(begin - 1, 0)
        ranks = gram_ranks(data[low : end + LENGTH - 1])
        least = window_minima(ranks)
        # The anchor changes where a smaller gram enters or the anchor leaves; a text begins with a new one.
        enters = ranks[SPAN:] < least[:-1]
        change = np.zeros(len(least), dtype=bool)
        np.equal(ranks[: len(least) - 1], least[:-1], out=change[1:])
        change[1:] |= enters
        change[opens[np.searchsorted(opens, begin) : np.searchsorted(opens, end)] - low] = True
        at = np.nonzero(change)[0]
        place = at + REACH
        left = np.nonzero(~np.append(False, enters)[at])[0]
        some = at[left]
        place[left] = some + (np.lib.stride_tricks.sliding_window_view(ranks, SPAN)[some] == least[some][:, None]).argmax(axis=1)
        firsts.append(at + low)
        places.append(place + low)
    first, place = np.concatenate(firsts), np.concatenate(places)
    text = np.searchsorted(ends, first, side="right")
    final = ends[text] - LENGTH
    last = np.minimum(np.append(first[1:] - 1, total), final)
    inside = first <= final
    place, first, last, text = place[inside], first[inside], last[inside], text[inside]
    return place, first, last, text, gram_hashes(data, place)


def slices(ids: list[int], bodies: list[bytes]):
    """Documents in slices of about ``SLICE_BYTES``: ``(ids, data, starts, ends)``."""
    begin, size = 0, 0
    for i in range(len(bodies) + 1):
        if i == len(bodies) or (size and size + len(bodies[i]) > SLICE_BYTES):
            if i > begin:
                lengths = np.array([len(b) for b in bodies[begin:i]], dtype=np.int64)
                ends = np.cumsum(lengths)
                yield np.array(ids[begin:i], dtype=np.int64), np.frombuffer(b"".join(bodies[begin:i]), np.uint8), ends - lengths, ends
            begin, size = i, 0
        if i < len(bodies):
            size += len(bodies[i])


def ordered(block: pa.Table) -> tuple[list[int], list[bytes]]:
    """Ids and bodies of a block, in an order that does not depend on the shuffle."""
    rows = sorted(zip(block.column("doc_id").to_pylist(), block.column("body").to_pylist()))
    return [r[0] for r in rows], [r[1] for r in rows]


# -- suffix contexts of a block -------------------------------------------------------


def contexts(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One row per anchor: 26 bytes before (nearest first), 50 bytes from it on, and the range of string starts.

    Bytes that no string of the anchor needs are zero, so equal rows need equal strings.
    """
    padded = np.concatenate([np.zeros(REACH, np.uint8), data, np.zeros(LENGTH, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, REACH + LENGTH)
    raw = windows[place]
    before, after = raw[:, :REACH][:, ::-1].copy(), raw[:, REACH:].copy()
    most, least = (place - first)[:, None], (place - last)[:, None]  # bytes before the anchor, in the first and last string
    before[np.arange(REACH)[None, :] >= most] = 0
    after[np.arange(LENGTH)[None, :] >= LENGTH - least] = 0
    return np.concatenate([before, after, least.astype(np.uint8), most.astype(np.uint8)], axis=1)


WIDTH = REACH + LENGTH + 2
#: Leading bits of a short hash that tell most grams apart from the shared ones.
SIEVE_BITS = 22
SIEVE = np.uint64(40 - SIEVE_BITS)


def block_contexts(ids: list[int], bodies: list[bytes], shared: np.ndarray):
    """Distinct contexts of the anchors whose gram hash is in ``shared`` (sorted 64-bit prefixes), and where they are.

    Returns ``(rows, smallest id, per slice (context number, place, first, last))``.
    """
    parts, spots = [], []
    sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
    sieve[shared >> SIEVE] = True
    for doc_ids, data, starts, ends in slices(ids, bodies):
        place, first, last, doc, h = anchors(data, starts, ends)
        h = short_hash(h)
        wanted = np.nonzero(sieve[h >> SIEVE])[0]
        if len(wanted):
            h = h[wanted]
            wanted = wanted[shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h]
        place, first, last, doc = place[wanted], first[wanted], last[wanted], doc[wanted]
        parts.append((contexts(data, place, first, last) if len(place) else np.zeros((0, WIDTH), np.uint8), doc_ids[doc]))
        spots.append((place, first, last, doc))
    if not parts:
        return np.zeros((0, WIDTH), np.uint8), np.zeros(0, np.int64), []
    rows = np.concatenate([p[0] for p in parts])
    owner = np.concatenate([p[1] for p in parts])
    index, inverse = distinct_rows(rows)
    # Numbered by their leading bytes: rows that go to a range together are alike, and shuffled in less space.
    order = np.argsort(unaligned(rows.reshape(-1), ">u8")[index * WIDTH + REACH].astype(np.uint64), kind="stable") if len(index) else index
    index, number = index[order], np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    inverse = number[inverse]
    smallest = np.full(len(index), LAST, dtype=np.int64)
    np.minimum.at(smallest, inverse, owner)
    out, at = [], 0
    for place, first, last, doc in spots:
        out.append((inverse[at : at + len(place)], place, first, last, doc))
        at += len(place)
    return rows[index], smallest, out


def distinct_rows(rows: np.ndarray, hashed=mixed) -> tuple[np.ndarray, np.ndarray]:
    """``(index, inverse)`` of the distinct byte rows, as ``np.unique`` gives them: told apart by a hash, and by
    the bytes themselves if two different rows have one hash."""
    _, index, inverse = np.unique(hashed(as_words(rows)), return_index=True, return_inverse=True)
    if not all((rows[i : i + STRIDE] == rows[index[inverse[i : i + STRIDE]]]).all() for i in range(0, len(rows), STRIDE)):
        keys = np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").reshape(-1)
        _, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return index, inverse


def short_hash(h: np.ndarray) -> np.ndarray:
    """40 bits: the hash range (8 bits) and 32 more; chance matches only send a suffix on needlessly."""
    return h >> np.uint64(24)


# -- sorting a range of suffixes ---------------------------------------------------------


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of byte strings given as rows of big-endian 8-byte words: rows are
    partitioned by the first word, then only rows with equal words so far by
    the next one, as multikey quicksort does by characters."""
    order = np.argsort(words[:, 0], kind="stable")
    word = words[order, 0]
    new = np.append(True, word[1:] != word[:-1])[: len(order)]  # differs from the row before
    spots = np.arange(len(order))
    for k in range(1, words.shape[1]):
        spots = spots[~(new[spots] & np.append(new, True)[spots + 1])]
        if not len(spots):
            break
        some, begins = order[spots], new[spots]
        word = words[some, k]
        turn = np.lexsort((word, np.cumsum(begins)))
        order[spots], word = some[turn], word[turn]
        begins[1:] |= word[1:] != word[:-1]
        new[spots] = begins
    return order


def as_words(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return wide.view(">u8").astype(np.uint64)


class PrefixGroups:
    """Sorted rows with the common prefix of neighbours: ``group(k)`` numbers
    the rows by their first k bytes (and their ``within`` number)."""

    def __init__(self, raw: np.ndarray, within: np.ndarray | None = None):
        n, width = raw.shape
        words = as_words(raw)
        if within is not None:
            words = np.concatenate([within.astype(np.uint64)[:, None], words], axis=1)
        self.order = multikey_order(words)
        del words
        self.common = np.full(n, -1, dtype=np.int16)
        for i in range(0, n - 1, 1 << 16):  # bounded memory
            here, after = self.order[i : i + (1 << 16)], self.order[i + 1 : i + 1 + (1 << 16)]
            here = here[: len(after)]
            differ = raw[here] != raw[after]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            if within is not None:
                common[within[here] != within[after]] = -1
            self.common[i + 1 : i + 1 + len(after)] = common

    def group(self, k: int) -> np.ndarray:
        out = np.empty(len(self.order), dtype=np.int64)
        out[self.order] = np.cumsum(self.common < k)
        return out


def covered_places(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each context a bit mask over its strings (bit: bytes before the anchor): set if a smaller id has the string."""
    n = len(rows)
    mask = np.zeros(n, dtype=np.int64)
    if n < 2:
        return mask
    before, after = rows[:, :REACH], rows[:, REACH : REACH + LENGTH]
    least, most = rows[:, -2].copy(), rows[:, -1].copy()
    right = PrefixGroups(after)
    left = PrefixGroups(before, right.group(GRAM))
    for a in range(SPAN):
        here = np.nonzero((least <= a) & (a <= most))[0]
        for side in (left.group(a), right.group(LENGTH - a)):  # a row alone on one side has its string alone
            side = side[here]
            here = here[np.bincount(side, minlength=1)[side] > 1]
        if len(here) < 2:
            continue
        key = left.group(a)[here] * np.int64(n + 1) + right.group(LENGTH - a)[here]
        order = np.argsort(key)
        key, here = key[order], here[order]
        begin = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        smallest = np.repeat(np.minimum.reduceat(ids[here], begin), np.diff(np.append(begin, len(here))))
        mask[here] |= (smallest < ids[here]).astype(np.int64) << a
    return mask


# -- Spark steps ---------------------------------------------------------------------------


def stored_blocks(bodies: DataFrame, scratch: Scratch) -> tuple[str, int]:
    """``bodies(doc_id, body)`` as a table bucketed by block, in the shared scratch folder."""
    spark = bodies.sparkSession
    size = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    placed = bodies.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int"))
    (
        placed.repartition(count, "block").write.format("parquet").option("path", scratch.path("suffix-blocks"))
        .option("compression", "zstd").bucketBy(count, "block").sortBy("block").saveAsTable(name)
    )
    return name, count


def shared_grams(blocks: DataFrame, ranges: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(block, grams)``: the short hashes of each block that another document has too; and the splitter sample."""

    def send(block: pa.Table) -> pa.Table:
        ids, bodies = ordered(block)
        names = np.unique(np.array([i for i, body in zip(ids, bodies) if len(body) >= LENGTH], dtype=np.int64))
        found, leads = [], []
        for doc_ids, data, starts, ends in slices(ids, bodies):
            place, _, _, doc, h = anchors(data, starts, ends)
            # 40 bits of hash, then the number of the id: a block's texts of 50 bytes are far fewer than 2**24.
            found.append(short_hash(h) << np.uint64(24) | np.searchsorted(names, doc_ids)[doc].astype(np.uint64))
            few = np.nonzero(h % np.uint64(4096) == 0)[0][:64]
            leads += [data[p : p + GRAM].tobytes() for p in place[few]]
        found = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        grams = found >> np.uint64(24)
        begin = np.nonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])[0]
        unique = grams[begin]
        several = found[begin] != found[np.append(begin[1:], len(found))[: len(begin)] - 1]
        cut = np.searchsorted(unique, (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(40)) // np.uint64(ranges))
        number = block.column("block")[0].as_py()
        low = (unique & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        high = (unique >> np.uint64(32)).astype(np.uint8)
        # Only ranges that the block has grams of; the last row carries its splitter sample.
        parts = [(r, x, y) for r, (x, y) in enumerate(zip(cut.tolist(), cut[1:].tolist())) if x < y]
        return pa.Table.from_pydict(
            {
                "range": pa.array([r for r, _, _ in parts] + [-1], pa.int32()),
                "block": pa.array([number] * (len(parts) + 1), pa.int32()),
                "low": pa.array([low[x:y].tobytes() for _, x, y in parts] + [b""], pa.binary()),
                "high": pa.array([run_lengths(high[x:y]) for _, x, y in parts] + [b""], pa.binary()),
                "several": pa.array([np.packbits(several[x:y]).tobytes() for _, x, y in parts] + [b""], pa.binary()),
                "leads": pa.array([[]] * len(parts) + [leads], pa.list_(pa.binary())),
            }
        )

    kind = "range int, block int, low binary, high binary, several binary, leads array<binary>"
    sent = scratch.table(blocks.groupBy("block").applyInArrow(send, kind), "suffix-grams")

    def answer(group: pa.Table) -> pa.Table:
        numbers = group.column("block").to_pylist()
        grams = [unpacked(lo, hi) for lo, hi in zip(group.column("low").to_pylist(), group.column("high").to_pylist())]
        flags = [np.unpackbits(np.frombuffer(f, np.uint8))[: len(g)].astype(bool) for f, g in zip(group.column("several").to_pylist(), grams)]
        every = np.sort(np.concatenate(grams))
        again = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *[g[f] for g, f in zip(grams, flags)]]))
        replies = [(n, g[np.isin(g, again, assume_unique=True)]) for n, g in zip(numbers, grams)]
        replies = [(n, g) for n, g in replies if len(g)]
        return pa.Table.from_pydict(
            {"block": pa.array([n for n, _ in replies], pa.int32()), "grams": pa.array([g.tobytes() for _, g in replies], pa.binary())}
        )

    asked = sent.where("range >= 0").drop("leads")
    replies = scratch.table(asked.groupBy("range").applyInArrow(answer, "block int, grams binary"), "suffix-shared")
    return replies, sent.where("range = -1").select(F.explode("leads").alias("lead"))


def run_lengths(high: np.ndarray) -> bytes:
    """Sorted bytes as (value, count) pairs."""
    values, counts = np.unique(high, return_counts=True)
    return np.stack([values.astype(np.uint32), counts.astype(np.uint32)]).tobytes()


def unpacked(low: bytes, high: bytes) -> np.ndarray:
    values, counts = np.frombuffer(high, np.uint32).reshape(2, -1).astype(np.int64)
    return (np.repeat(values, counts).astype(np.uint64) << np.uint64(32)) | np.frombuffer(low, np.uint32).astype(np.uint64)


def known_grams(replies: list[bytes]) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(replies), np.uint64))


def splitters(leads: DataFrame, ranges: int) -> list[bytes]:
    """``ranges - 1`` byte strings that cut the sampled leading bytes into equal parts."""
    some = leads.orderBy(F.xxhash64("lead"), "lead").limit(SAMPLE).collect()
    keys = sorted(bytes(r["lead"]) for r in some)
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


SENT = "range int, block int, numbers binary, rows binary, ids binary"


def sent_suffixes(blocks: DataFrame, replies: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Distinct contexts of each block, dealt to ranges of leading bytes."""
    borders = np.array(cuts, dtype=f"S{GRAM}")

    def send(block: pa.Table, reply: pa.Table) -> pa.Table:
        out = {"range": [], "block": [], "numbers": [], "rows": [], "ids": []}
        if block.num_rows and reply.num_rows:
            ids, bodies = ordered(block)
            rows, smallest, _ = block_contexts(ids, bodies, known_grams(reply.column("grams").to_pylist()))
            lead = np.ascontiguousarray(rows[:, REACH : REACH + GRAM]).view(f"S{GRAM}").reshape(-1)
            to = np.searchsorted(borders, lead, side="right")
            order = np.argsort(to, kind="stable")
            for part in np.split(order, np.nonzero(np.diff(to[order]))[0] + 1):
                if len(part):
                    out["range"].append(int(to[part[0]]))
                    out["block"].append(block.column("block")[0].as_py())
                    out["numbers"].append(part.astype(np.int32).tobytes())
                    out["rows"].append(rows[part].tobytes())
                    out["ids"].append(smallest[part].tobytes())
        return pa.Table.from_pydict(
            out, schema=pa.schema([("range", pa.int32()), ("block", pa.int32()), ("numbers", pa.binary()), ("rows", pa.binary()), ("ids", pa.binary())])
        )

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(send, SENT)


def sorted_ranges(suffixes: DataFrame) -> DataFrame:
    """``(block, numbers, masks)``: which strings of a block's contexts a smaller id has."""

    def sort(group: pa.Table) -> pa.Table:
        raw = {c: group.column(c).to_pylist() for c in ("block", "numbers", "rows", "ids")}
        rows = np.frombuffer(b"".join(raw["rows"]), np.uint8).reshape(-1, WIDTH)
        ids = np.frombuffer(b"".join(raw["ids"]), np.int64)
        masks = covered_places(rows, ids)
        out, at = {"block": [], "numbers": [], "masks": []}, 0
        for block, numbers in zip(raw["block"], raw["numbers"]):
            numbers = np.frombuffer(numbers, np.int32)
            mine = masks[at : at + len(numbers)]
            at += len(numbers)
            hit = mine != 0
            if hit.any():
                out["block"].append(block)
                out["numbers"].append(numbers[hit].tobytes())
                out["masks"].append(mine[hit].astype(np.int32).tobytes())
        return pa.Table.from_pydict(out, schema=pa.schema([("block", pa.int32()), ("numbers", pa.binary()), ("masks", pa.binary())]))

    return suffixes.groupBy("range").applyInArrow(sort, "block int, numbers binary, masks binary")


def removed_spans(ids: list[int], bodies: list[bytes], shared: np.ndarray, numbers: np.ndarray, masks: np.ndarray):
    """Per document of a block the boolean array of removed bytes."""
    rows, smallest, spots = block_contexts(ids, bodies, shared)
    mask = np.zeros(len(rows), dtype=np.int64)
    mask[numbers] = masks
    for (doc_ids, data, starts, ends), (number, place, first, last, doc) in zip(slices(ids, bodies), spots):
        change = np.zeros(len(data) + 1, dtype=np.int64)
        # A smaller id in the same block has the whole context; else the mask tells string by string.
        own = doc_ids[doc] > smallest[number]
        np.add.at(change, first[own], 1)
        np.add.at(change, last[own] + LENGTH, -1)
        rest = np.nonzero(~own & (mask[number] != 0))[0]
        for a in range(SPAN):
            start = place[rest] - a
            hit = (first[rest] <= start) & (start <= last[rest]) & ((mask[number[rest]] >> a) & 1).astype(bool)
            np.add.at(change, start[hit], 1)
            np.add.at(change, start[hit] + LENGTH, -1)
        gone = np.cumsum(change[:-1]) > 0
        for s, e in zip(starts, ends):
            yield data[s:e], gone[s:e]


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("kept", pa.string()), ("input_sha256", pa.string()),
])
RESULT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string, input_sha256 string"


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", changed_texts: bool = False) -> DataFrame:
    """Counts and the hash of the remaining bytes per row of ``docs``. With
    ``changed_texts`` only rows that lose bytes, with the remaining text
    (without characters that lost a byte) and the hash of the input."""
    spark = docs.sparkSession
    bodies = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc_id"), utf8(F.col(text_col)).alias("body"))
    scratch = Scratch(spark)
    name, ranges = stored_blocks(bodies, scratch)
    blocks = spark.table(name)
    replies, leads = shared_grams(blocks, ranges, scratch)
    cuts = splitters(leads, ranges)
    scratch.clear("suffix-grams")
    masks = scratch.table(sorted_ranges(sent_suffixes(blocks, replies, cuts)), "suffix-masks")
    nothing = F.lit(None).cast("binary")
    news = replies.select("block", "grams", nothing.alias("numbers"), nothing.alias("masks")).unionByName(
        masks.select("block", nothing.alias("grams"), "numbers", "masks")
    )

    def finish(block: pa.Table, news: pa.Table) -> pa.Table:
        out = {f.name: [] for f in RESULT}
        ids, bodies = ordered(block) if block.num_rows else ([], [])
        part = lambda c: [x for x in news.column(c).to_pylist() if x is not None] if news.num_rows else []
        numbers = np.frombuffer(b"".join(part("numbers")), np.int32)
        places = np.frombuffer(b"".join(part("masks")), np.int32).astype(np.int64)
        for doc_id, (data, gone) in zip(ids, removed_spans(ids, bodies, known_grams(part("grams")), numbers, places)):
            if changed_texts and not gone.any():
                continue
            kept = data[~gone].tobytes()
            edge = np.diff(np.concatenate([np.zeros(1, np.int8), gone.view(np.int8)]))
            for name, value in (
                ("doc_id", None if doc_id == LAST else doc_id), ("n_bytes", len(data)), ("n_removed", int(gone.sum())),
                ("n_spans", int((edge == 1).sum())), ("kept_sha256", hashlib.sha256(kept).hexdigest()),
                ("kept", kept.decode("utf-8", "ignore") if changed_texts else None),
                ("input_sha256", hashlib.sha256(data).hexdigest() if changed_texts else None),
            ):
                out[name].append(value)
        return pa.Table.from_pydict(out, schema=RESULT)

    done = blocks.groupBy("block").cogroup(news.groupBy("block")).applyInArrow(finish, RESULT_DDL)
    done = materialised(done if changed_texts else done.drop("kept", "input_sha256"), "suffix-result")
    spark.sql(f"DROP TABLE {name}")
    scratch.clear()
    return done


def op8(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


def drop_repeats(spark, docs, sf_dir):
    """Pipeline stage: repeated bytes go from the text (and ``n_chars`` follows); documents and columns stay."""
    r_id, r_sha, r_kept = free_names(docs, "r_id", "r_sha", "r_kept")
    changed = (
        remove_repeats(docs, changed_texts=True)
        .select(F.col("doc_id").alias(r_id), F.col("input_sha256").alias(r_sha), F.col("kept").alias(r_kept))
        .dropDuplicates([r_id, r_sha])
    )
    same = F.col("doc_id").eqNullSafe(F.col(r_id)) & (F.sha2(utf8(F.col("text")), 256) == F.col(r_sha))
    joined = docs.join(changed, same, "left").withColumn("text", F.when(F.col(r_sha).isNull(), F.col("text")).otherwise(F.col(r_kept)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.when(F.col(r_sha).isNull(), F.col("n_chars")).otherwise(F.length(r_kept).cast(kind)))
    return joined.select(docs.columns)
