"""Quality rules with a hashed n-gram log-likelihood ratio.

Each text's word unigrams and bigrams are keyed by a hash of as many bits
as number the corpus's n-grams and eight more, so the key space grows with
the corpus. Two multinomials are counted: a trusted target
(the rows labelled good and not toxic, less a held-out fifth) and the raw
corpus (every row). A document's score is the mean of ``log p_target - log
p_raw`` over its n-grams, so length does not matter; the target is smoothed
with the raw corpus, by a share of its own size. It passes when the score
reaches the threshold, which the scores of the held-out labelled rows of the
same run give. The decision is deterministic.

Scale: the commonest n-grams, one in a thousand, make up half of a corpus. They are picked by a
look at every task's first texts, counted exactly over all rows, and their log
ratios (a table of fixed size) go to every task, which adds them up where the
text is. So no key that many documents hold is ever gathered. For the other
n-grams a task cuts its texts into blocks and sends each range of keys the
block's n-grams with the documents that hold them, packed, one row per block
and range that meet. A range counts its n-grams and sends back each
document's share of the sum. Text never moves. Which n-grams are common changes
what travels, never a count or a score.

Defined results: null and empty texts have no words, fail the base rules and
score 0; a missing or empty target gives every document the score 0, which
passes; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialised, table, utf8

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: The threshold where no held-out rows of both labels pass the base rules.
MIN_SCORE = -0.25
#: Bits of a key beyond those that number the corpus's n-grams, so one key in 2**8 at most is shared; never above 48.
SPARE_BITS, MAX_KEY_BITS = 8, 48
#: Weight of the raw corpus in the smoothed target, as a share of the target's n-grams.
SMOOTHING = 0.05
#: One in so many labelled ids sets the threshold and is no part of the target.
HELD_OUT = 5
#: N-grams whose log ratios go to every task: one in so many of the corpus's, up to a bound (25 MB of tables in a task).
COMMON_SHARE, COMMON = 1 << 10, 1 << 18
#: Slots of each of the two tables that find a common key.
SLOT_BITS = 20
#: N-grams of a task's first texts that are looked at for common ones, and how many it names.
LOOK_GRAMS, NAMED = 1_000_000, 1 << 15
#: Parts in which the common counts of the tasks are added up, and the groups of tasks.
SLICES, GROUPS = 64, 256
#: N-grams of a block (which has at most 2**16 texts) and, on average, of a range of keys.
BLOCK_GRAMS, RANGE_GRAMS = 2_000_000, 3_000_000
#: Trusted ids up to which they are broadcast; more of them are joined by a shuffle, with the same result.
BROADCAST_IDS = 2_000_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, computed once per different word."""
    known: dict[bytes, int] = {}
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            known[w] = h = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def ngram_buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all unigrams and bigrams."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    grams = hashes if len(hashes) < 2 else np.concatenate([hashes, hashes[:-1] * np.uint64(31) + hashes[1:] + np.uint64(1 << 33)])
    return ((grams * mix) >> np.uint64(64 - bits)).astype(np.int64)


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(hashes)
    if n < 4:
        return 0
    ids = np.unique(hashes, return_inverse=True)[1].astype(np.uint64)
    base = np.uint64(int(ids.max()) + 1)
    if n < 2_000_000:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:  # pairs first, so three ids still fit in 64 bits
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1].astype(np.uint64)
        windows = pairs[:-1] * base + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


WHITE = [bytes([c]) for c in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)]


def word_chars(text: bytes) -> int:
    """Code points outside white space: bytes that do not continue a character, less the white space."""
    raw = np.frombuffer(text, dtype=np.uint8)
    return int(((raw & 0xC0) != 0x80).sum()) - sum(text.count(w) for w in WHITE)


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array by their place, compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes(), 1)


def from_planes(raw: bytes, dtype) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(size, -1).T).view(dtype).ravel()


#: A block's n-grams in one range: differences of the ascending keys, documents of each, the documents, their counts.
PACKED = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("target", pa.bool_()), ("keys", pa.binary()), ("spread", pa.binary()),
    ("holders", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()),
])
PACKED_DDL = "part int, block bigint, target boolean, keys binary, spread binary, holders binary, counts binary, docs binary"
SUMS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("holders", pa.binary()), ("sums", pa.binary()), ("docs", pa.binary())])
SUMS_DDL = "block bigint, part int, holders binary, sums binary, docs binary"
FACTS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
])
BASED = FACTS.append(pa.field("base", pa.float64()))
SCORED_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, score double"
)


def facts(doc_id, text: bytes, hashes: np.ndarray) -> tuple:
    n, repeats = len(hashes), repeated_words(hashes)
    return (doc_id, n, word_chars(text), sum(text.count(c) for c in SYMBOLS), duplicate_lines(text), repeats, n < 50 or 100 * repeats > 50 * n)


class CommonKeys:
    """The number of a common key, by two tables with one slot a key; keys that find no slot in either are not common."""

    def __init__(self, keys: list[int] | np.ndarray, bits: int):
        self.keys, self.bits = np.array(keys, np.uint64), bits
        self.shift = np.uint64(max(bits - SLOT_BITS, 0))
        self.tables = [(np.full(1 << SLOT_BITS, 1 << 63, np.uint64), np.zeros(1 << SLOT_BITS, np.int32)) for _ in range(2)]
        self.size = 0
        waiting = self.keys
        for slot, (own, number) in zip((self.first, self.second), self.tables):
            at, first = np.unique(slot(waiting), return_index=True)  # the more frequent key takes the slot
            own[at], number[at] = waiting[first], np.arange(self.size, self.size + len(at))
            self.size += len(at)
            waiting = np.delete(waiting, first)

    def __reduce__(self):
        # Tasks get the keys (2 MB at most) and build the tables, which are far larger and mostly empty.
        return CommonKeys, (self.keys, self.bits)

    def first(self, keys: np.ndarray) -> np.ndarray:
        return keys >> self.shift

    def second(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SLOT_BITS)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, -1 for keys that are not common."""
        (own, number), (own_2, number_2) = self.tables
        at = self.first(keys)
        out = np.where(own[at] == keys, number[at], -1)
        rest = np.flatnonzero(out < 0)
        at = self.second(keys[rest])
        out[rest] = np.where(own_2[at] == keys[rest], number_2[at], -1)
        return out


def profile(texts: DataFrame) -> tuple[int, list[int]]:
    """The number of all n-grams of ``texts(body)``, and at most ``COMMON`` keys of
    ``MAX_KEY_BITS`` bits, the most frequent of the tasks' first texts first."""

    def run(batches):
        grams, looked, n = [], 0, 0
        for batch in batches:
            for body in batch.column("body"):
                words = body.as_py().split()
                n += max(2 * len(words) - 1, 0)
                if looked < LOOK_GRAMS:
                    grams.append(ngram_buckets(word_hashes(words), MAX_KEY_BITS))
                    looked += len(grams[-1])
        keys, counts = np.unique(np.concatenate(grams), return_counts=True) if grams else (np.zeros(0, np.int64),) * 2
        top = np.argsort(-counts, kind="stable")[:NAMED]
        yield pa.RecordBatch.from_pydict({"key": np.append(keys[top], -1), "n": np.append(counts[top], n)})

    named = texts.select("body").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    rows = named.orderBy((F.col("key") >= 0), F.desc("n"), "key").limit(COMMON + 1).toArrow()
    if not rows.num_rows:
        return 0, []
    return rows.column("n")[0].as_py(), rows.column("key").to_pylist()[1:]


def common_counts(texts: DataFrame, bits: int, common: CommonKeys) -> np.ndarray:
    """How often ``texts`` hold each common key: counts of every task, added up in slices and two steps."""

    def run(batches):
        counts = np.zeros(common.size, np.int64)
        for batch in batches:
            found = [common.numbers(ngram_buckets(word_hashes(body.as_py().split()), bits).astype(np.uint64)) for body in batch.column("body")]
            counts += np.bincount(np.concatenate([np.zeros(0, np.int64), *found]) + 1, minlength=common.size + 1)[1:]
        slices = [planes(x) if len(x) else b"" for x in np.array_split(counts, SLICES)]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(range(SLICES), pa.int32()), "team": pa.array([TaskContext.get().partitionId() % GROUPS] * SLICES, pa.int32()), "counts": pa.array(slices, pa.binary()),
        })

    def added(rows: pa.Table) -> pa.Table:
        total = sum(from_planes(x, np.int64) for x in rows.column("counts").to_pylist())
        return rows.slice(0, 1).set_column(2, "counts", pa.array([planes(total) if len(total) else b""], pa.binary()))

    ddl = "slice int, team int, counts binary"
    rows = texts.select("body").mapInArrow(run, ddl).groupBy("slice", "team").applyInArrow(added, ddl).groupBy("slice").applyInArrow(added, ddl)
    found = {r["slice"]: from_planes(r["counts"], np.int64) for r in rows.collect()}  # one row a slice
    return np.concatenate([found[k] for k in sorted(found)]) if found else np.zeros(common.size, np.int64)


def log_ratios(target: np.ndarray, raw: np.ndarray, n_target: int, n_raw: int, bits: int | None) -> np.ndarray:
    """``log p_target - log p_raw`` of n-grams by their counts."""
    # Given buckets count once more each, in the prior and as the target's smoothing; keys of the growing space need no more than their counts.
    size = 0 if bits is None else 1 << bits
    weight, more = (SMOOTHING * n_target, 0) if bits is None else (size, 1)
    if not n_target:
        return np.zeros(len(raw))
    prior = np.maximum(raw + more, 1) / (n_raw + more * size)
    return np.log((target + weight * prior) / (n_target + weight)) - np.log(prior)


def packed_grams(texts: DataFrame, bits: int, parts: int, target: bool, common: CommonKeys, ratios: np.ndarray) -> DataFrame:
    """The n-grams of ``texts(doc_id, body)`` that are not common, one row per block and
    range; the target has no documents, the others bring their facts and the sum of their common ratios in a row of their own."""

    def run(batches):
        grams: list[np.ndarray] = []
        known: list[tuple] = []
        total, serial = 0, 0

        def flush():
            block = (TaskContext.get().partitionId() << 32) + serial
            if not target:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*known), BASED)]
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, BASED) as out:
                    out.write_batch(pa.RecordBatch.from_arrays(columns, schema=BASED))
                rows = [(block % parts, block, False, b"", b"", b"", b"", sink.getvalue().to_pybytes())]
            else:
                rows = []
            holder = np.zeros(total, np.uint64) if target else np.repeat(np.arange(len(grams), dtype=np.uint64), [len(g) for g in grams])
            pairs, counts = np.unique((np.concatenate(grams) << np.uint64(16)) | holder, return_counts=True)
            keys, holder = pairs >> np.uint64(16), (pairs & np.uint64(0xFFFF)).astype(np.uint16)
            part = ((keys >> np.uint64(max(bits - 32, 0))) * np.uint64(parts)) >> np.uint64(min(bits, 32))
            at = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))
            for x, y in zip(at, [*at[1:], len(keys)]):
                start = np.flatnonzero(np.diff(keys[x:y], prepend=~keys[x]))
                rows.append((int(part[x]), block, target, planes(np.diff(keys[x:y][start], prepend=np.uint64(0))),
                             planes(np.diff(start, append=y - x).astype(np.uint32)), planes(holder[x:y]), planes(counts[x:y].astype(np.uint32)), None))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)

        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
                text = body.as_py()
                hashes = word_hashes(text.split())
                keys = ngram_buckets(hashes, bits).astype(np.uint64)
                number = common.numbers(keys)
                rare = number < 0
                grams.append(keys[rare])
                total += len(grams[-1])
                if not target:
                    known.append((*facts(doc_id, text, hashes), float(ratios[number[~rare]].sum())))
                if total >= BLOCK_GRAMS or len(grams) == 1 << 16:
                    yield flush()
                    grams, known, total, serial = [], [], 0, serial + 1
        if grams and (total or not target):
            yield flush()

    return texts.mapInArrow(run, PACKED_DDL)


def range_sums(n_target: int, n_raw: int, bits: int | None):
    """For each block the summed log ratios of its documents over the n-grams of one range."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        keys = [np.cumsum(from_planes(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])
        counted = {True: np.zeros(len(different)), False: np.zeros(len(different))}
        starts = [from_planes(r["spread"], np.uint32).astype(np.int64) for r in rows]
        for r, k, spread, end in zip(rows, keys, starts, ends):
            if len(k):
                first = np.cumsum(spread) - spread
                counted[r["target"]][at[end - len(k) : end]] += np.add.reduceat(from_planes(r["counts"], np.uint32).astype(np.int64), first)
        ratio = log_ratios(counted[True], counted[False], n_target, n_raw, bits)
        out = []
        for r, k, spread, end in zip(rows, keys, starts, ends):
            if r["target"]:
                continue
            holders, sums = np.zeros(0, np.uint16), np.zeros(0, np.float32)
            if len(k):
                each = np.repeat(ratio[at[end - len(k) : end]], spread) * from_planes(r["counts"], np.uint32)
                holders, place = np.unique(from_planes(r["holders"], np.uint16), return_inverse=True)
                sums = np.bincount(place, each).astype(np.float32)
            out.append((r["block"], r["part"], holders.tobytes(), sums.tobytes(), r["docs"]))
        return pa.Table.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(SUMS)], schema=SUMS)

    return run


def block_scores(rows: pa.Table) -> pa.Table:
    """The facts and scores of a block's documents."""
    rows = sorted(rows.to_pylist(), key=lambda r: (r["part"], r["docs"] is not None))
    known = pa.ipc.open_stream(next(r["docs"] for r in rows if r["docs"] is not None)).read_all()
    total = known.column("base").to_numpy().copy()
    for r in rows:
        total[np.frombuffer(r["holders"], np.uint16)] += np.frombuffer(r["sums"], np.float32)
    n = known.column("n_words").to_numpy()
    return known.drop_columns(["base"]).append_column("score", pa.array(total / np.maximum(2 * n - 1, 1)))


def held_out_cut(scored: DataFrame, labelled: DataFrame, fallback: float) -> float:
    """The score that tells held-out good rows from bad ones with the smallest
    sum of both error shares; in the middle of the widest stretch of such scores."""
    good = F.col("good").cast("bigint")
    bins = (
        scored.where(~F.col("base_failed")).join(labelled.where(held_out()), "doc_id")
        .groupBy(F.floor(F.col("score") * 100).cast("bigint").alias("bin")).agg(F.sum(good).alias("g"), F.sum(1 - good).alias("b"))
        .orderBy("bin").collect()  # one row per hundredth of a score
    )
    n_good, n_bad = sum(r["g"] for r in bins), sum(r["b"] for r in bins)
    if not n_good or not n_bad:
        return fallback
    best, below, above = (float("inf"),), 0, n_bad
    for last, r in zip([None, *bins], bins):
        if last is not None:
            below, above = below + last["g"], above - last["b"]
            gap = r["bin"] - last["bin"] - 1
            best = min(best, (below / n_good + above / n_bad, -gap, (last["bin"] + 1 + r["bin"]) / 200))
    return best[2] if len(best) == 3 else fallback


def held_out():
    return F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(HELD_OUT)) == 0


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int | None = None,
    min_score: float = MIN_SCORE,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """Rule counts, score and verdict per row of ``docs``. ``trusted`` has the
    texts of the target in a column of the same name. ``bits`` puts n-grams in
    so many buckets instead of a key space that grows with the corpus. The held-out rows of
    ``labelled(doc_id, good)`` set the threshold, otherwise it is ``min_score``."""
    scratch = Scratch(docs.sparkSession)
    body = utf8(F.col(text_col)).alias("body")
    bodies = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), body)
    target = trusted.select(F.lit(None).cast("bigint").alias("doc_id"), body)
    (n_target, _), (n_raw, often) = profile(target), profile(bodies)
    often = often[: -(-n_raw // COMMON_SHARE)]
    key_bits = bits or min(MAX_KEY_BITS, n_raw.bit_length() + SPARE_BITS)
    common = CommonKeys(list(dict.fromkeys(k >> max(MAX_KEY_BITS - key_bits, 0) for k in often)), key_bits)
    in_raw, in_target = common_counts(bodies, key_bits, common), common_counts(target, key_bits, common)
    ratios = log_ratios(in_target, in_raw, n_target, n_raw, bits)
    parts = max(1, -(-int(n_raw + n_target - in_raw.sum() - in_target.sum()) // RANGE_GRAMS))
    packed = packed_grams(bodies, key_bits, parts, False, common, ratios).unionByName(packed_grams(target, key_bits, parts, True, common, ratios))
    sums = packed.groupBy("part").applyInArrow(range_sums(n_target, n_raw, bits), SUMS_DDL)
    scored = scratch.table(sums.groupBy("block").applyInArrow(block_scores, SCORED_DDL), "ngram-scores")
    cut = min_score if labelled is None else held_out_cut(scored, labelled, min_score)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(cut))
    result = materialised(scored.select(*FACTS.names, kept.alias("kept"), "score"), "ngram-result")
    scratch.clear()
    return result


def labelled_ids(labels: DataFrame) -> DataFrame:
    """``(doc_id, good)`` of the labels: good and not toxic, or of low quality."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    known = labels.where(F.col("doc_id").isNotNull() & (good | (F.col("quality") == 0)))
    return known.groupBy("doc_id").agg(F.min(good).alias("good"))


def trusted_rows(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """All rows of ``docs`` that are labelled good and not held out."""
    ids = labelled.where(F.col("good") & ~held_out()).select("doc_id")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def op9(spark, sf_dir):
    docs, labelled = table(spark, sf_dir, "documents"), labelled_ids(table(spark, sf_dir, "labels"))
    return quality_rules(docs, trusted_rows(docs, labelled), labelled=labelled)
