"""Near-duplicate detection by circulant MinHash.

Shingles are hashed into a circle of ``2**UNIVERSE_BITS`` places. One random
permutation scatters the places; a second one, shifted round the circle by
``k`` places, gives the ``k``-th signature coordinate: the smallest value over
the document's shingles. Two permutations thus give all coordinates, and the
values of one shingle lie side by side in memory. Bands of ``ROWS`` coordinates
make the candidates; links are confirmed by the exact Jaccard similarity of
the full shingle sets.

Candidates without pairs: texts with equal words are one node. In every band
bucket each node is compared with one pivot (chosen by a hash, another one in
each band); confirmed links are merged into components. What is then left is
every pair of nodes in one bucket with different components: nodes outside
the bucket's largest component are compared with all its members, both cut into blocks
of bounded size, a task for each two of them, first by signature agreement, then exactly. Each pair is looked at in the
first bucket it shares. Nothing is capped.

Scale: three narrow tables move (class keys, band keys, links); shingle sets
are built only for nodes that share a bucket, found by a bitmap of fixed size.
Hot classes and buckets are combined per task; hot pivots are one row on the
other side of a join that Spark splits. Components come from min-label rounds
with pointer jumping; each round is written to the shared scratch folder.

Defined results: null, empty and white texts have no shingles and are linked
with nothing, each its own component; shorter texts than a shingle have one
shingle, the whole word sequence; rows with equal words are linked whatever
their ids; a null id gets the component of its text's other rows (null if all
are null) and is kept only if that is null; rows that repeat an id with different
texts are marked by their own texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_WS, Scratch, free_names, materialised, table, utf8

SHINGLE = 5
BANDS, ROWS = 28, 4
COORDINATES = BANDS * ROWS
UNIVERSE_BITS = 20
#: Links need 100 * intersection >= MIN_PERCENT * union.
MIN_PERCENT = 75
#: Signature agreement below which a pair is not compared: 4.9 standard deviations below the mean at 75 %.
MIN_AGREEMENT = int(0.55 * COORDINATES)
BLOCK = 4096
BITMAP_BITS = 23


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the circular one with its beginning repeated at the end."""
    store = sys.modules.setdefault("_ledgerlake_worker_store", types.ModuleType("_ledgerlake_worker_store"))
    if not hasattr(store, "circle"):
        rng = np.random.default_rng(20240607)
        size = 1 << UNIVERSE_BITS
        scatter = rng.permutation(size).astype(np.uint32)
        circle = rng.permutation(size).astype(np.uint32)
        store.circle = (scatter, np.concatenate([circle, circle[:COORDINATES]]))
    return store.circle


FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_set(body: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a lower-cased text."""
    words = body.split()
    known: dict[bytes, int] = {}
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    h = np.array([known[w] for w in words], dtype=np.uint64)
    n = len(h)
    if n == 0:
        return h
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], dtype=np.uint64)
    out = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
    for k in range(SHINGLE):
        out += h[k : n - SHINGLE + 1 + k] * FACTORS[k]
    out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates at once: the minimum over the shingles' stretches of the circle."""
    scatter, circle = permutations()
    at = scatter[((shingles * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    stretches = np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)
    out = np.full(COORDINATES, 1 << UNIVERSE_BITS, dtype=np.uint32)
    for k in range(0, len(at), 2048):  # bounded memory for long texts
        np.minimum(out, stretches[at[k : k + 2048]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> list[int]:
    raw = sig.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(raw[b].tobytes(), seed=b) - (1 << 63) for b in range(BANDS)]


def text_key(body: bytes) -> bytes:
    """128 bits that tell word sequences apart."""
    return xxhash.xxh3_128_digest(b" ".join(body.split()))


def node_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


# -- Spark steps ----------------------------------------------------------------


def described(bodies: DataFrame) -> DataFrame:
    """``(doc_id, digest, n_shingles, key, node, bands)`` per row of ``bodies(doc_id, body, digest)``; key is null without words."""

    def run(batches):
        for batch in batches:
            counts, keys, nodes, bands = [], [], [], []
            for b in batch.column("body"):
                body = b.as_py().lower()
                shingles = shingle_set(body)
                counts.append(len(shingles))
                key = text_key(body) if len(shingles) else None
                keys.append(key)
                nodes.append(None if key is None else node_of(key))
                bands.append(band_keys(signature(shingles)) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "n_shingles", "key", "node", "bands"],
            )

    return bodies.mapInArrow(run, "doc_id bigint, digest binary, n_shingles bigint, key binary, node bigint, bands array<bigint>")


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over hashed ids: what is not in it is not in ``ids``."""
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << BITMAP_BITS))
    words = ids.select(F.floor(slot / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int")).alias("b"))
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    for w, b in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():  # at most 2**17 rows
        out[w] = b
    return out


def node_sets(bodies: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, shingles, sig)``, one row a node, of the rows that stand for a node of ``reps(id)`` (a few others may
    be among them). The bitmap lets more copies of a text through as it fills; they are combined per task."""
    shared = bodies.sparkSession.sparkContext.broadcast(id_bitmap(reps))
    slotted = bodies.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)))

    def run(batches):
        bits = shared.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            wanted = np.nonzero((bits[slot >> 6] >> (slot & 63)) & 1)[0]
            nodes, sets, sigs = [], [], []
            for i in wanted.tolist():
                body = batch.column("body")[i].as_py().lower()
                shingles = shingle_set(body)
                if len(shingles):
                    nodes.append(node_of(text_key(body)))
                    sets.append(shingles.tobytes())
                    sigs.append(signature(shingles).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())], names=["node", "shingles", "sig"]
            )

    found = slotted.mapInArrow(run, "node bigint, shingles binary, sig binary")
    return scratch.table(found.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("sig").alias("sig")), "minhash-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows ``(a, b)`` of ``pairs`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                    for x, y in zip(batch.column("sa"), batch.column("sb"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return scratch.table(full.mapInArrow(run, "a bigint, b bigint").distinct(), "minhash-links")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` of all linked nodes: the smallest node that links reach."""
    both = scratch.table(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "minhash-edges"
    )
    labels = scratch.table(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "minhash-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        stepped = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "label", F.least("label", F.coalesce("seen", "label")).alias("next")
        )
        stepped = scratch.table(stepped, "minhash-step")
        # Pointer jumping: a label is a node; that node's own label may be smaller.
        jump = stepped.select(F.col("node").alias("next"), F.col("next").alias("far"))
        jumped = stepped.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("new"), "label")
        jumped = scratch.table(jumped, "minhash-jump")
        changed = jumped.where(F.col("new") != F.col("label")).limit(1).count()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.select("node", "label")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough to be linked."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < MIN_PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= MIN_PERCENT * (len(x) + len(y) - both)


def block_links(rest: DataFrame, members: DataFrame) -> DataFrame:
    """Confirmed links ``(a, b)`` of rest nodes with members of other components.

    Every pair of a bucket is looked at, in the first band that the two share;
    the exact comparison is left out only where the signatures disagree too
    much or the two components are linked already. One link per pair of
    components and block is enough for the components, so the output does not
    grow with the pairs.
    """

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, joined = [], [], set()
        if left.num_rows and right.num_rows:
            sig = [np.frombuffer(b"".join(t.column(f"{tag}_sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
                   for tag, t in (("r", left), ("m", right))]
            sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in t.column(f"{tag}_shingles")] for tag, t in (("r", left), ("m", right))]
            label = [left.column("r_label").to_numpy(), right.column("m_label").to_numpy()]
            node = [left.column("r_node").to_numpy(), right.column("m_node").to_numpy()]
            slot = left.column("r_slot")[0].as_py()
            columns = np.ascontiguousarray(sig[1].T)
            for i in range(left.num_rows):
                equal = columns == sig[0][i][:, None]
                agree = equal.sum(axis=0, dtype=np.int16)
                hit = np.nonzero((label[1] != label[0][i]) & (agree >= MIN_AGREEMENT))[0]
                first = equal[:, hit].reshape(BANDS, ROWS, -1).all(axis=1).argmax(axis=0)
                hit = hit[first == slot]
                for j in hit[np.argsort(-agree[hit], kind="stable")].tolist():
                    pair = (min(label[0][i], label[1][j]), max(label[0][i], label[1][j]))
                    if pair not in joined and similar(sets[0][i], sets[1][j]):
                        joined.add(pair)
                        a.append(int(min(node[0][i], node[1][j])))
                        b.append(int(max(node[0][i], node[1][j])))
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    names = ("band", "cut", "block", "slot", "node", "label", "sig", "shingles")
    left, right = (df.select(*[F.col(c).alias(f"{tag}_{c}") for c in names]) for tag, df in (("r", rest), ("m", members)))
    grouped = left.groupBy("r_band", "r_cut", "r_block").cogroup(right.groupBy("m_band", "m_cut", "m_block"))
    return grouped.applyInArrow(compare, "a bigint, b bigint").distinct()


def text_digest(text: Column) -> Column:
    """128 bits that tell texts apart; null counts as the empty text."""
    return F.unhex(F.md5(utf8(text)))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    return marked_rows(docs, id_col=id_col, text_col=text_col).drop("digest", "only")


def marked_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of :func:`near_duplicates` with ``digest`` (of the text) and
    ``only``: whether ``(doc_id, digest)`` is the one of its component that stays."""
    scratch = Scratch(docs.sparkSession)
    last = F.lit(2**63 - 1)  # stands for a null id, after all others
    bodies = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), last).alias("doc_id"), utf8(F.col(text_col)).alias("body"), text_digest(F.col(text_col)).alias("digest")
    )
    rows = scratch.table(described(bodies), "minhash-rows")
    classes = scratch.table(
        rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.struct("doc_id", "digest")).alias("first"), F.first("node").alias("node"))
        .select("key", F.col("first.doc_id").alias("rep"), F.col("first.digest").alias("digest"), "node"), "minhash-classes"
    )
    reps = classes.groupBy("node").agg(F.min(F.struct("rep", "digest")).alias("first")).select("node", "first.rep", "first.digest")

    # One row of each class brings the bands; buckets with one node only are dropped at once.
    firsts = rows.where(F.col("key").isNotNull()).join(classes.select("key", "rep"), "key").where(F.col("doc_id") == F.col("rep"))
    banded = firsts.select("node", F.posexplode("bands").alias("slot", "band"))
    draw = F.struct(F.xxhash64("node", "band").alias("draw"), F.col("node").alias("node"))
    buckets = (
        banded.groupBy("band")
        .agg(F.min(draw)["node"].alias("pivot"), F.max("node").alias("hi"), F.min("node").alias("lo"), F.count(F.lit(1)).alias("size"))
        .where(F.col("hi") != F.col("lo"))
        .drop("hi", "lo")
    )
    shared = scratch.table(banded.join(buckets, "band"), "minhash-buckets")
    pairs = (
        shared.where(F.col("node") != F.col("pivot"))
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    used = shared.select("node").distinct().join(reps, "node").select(F.col("rep").alias("id"))
    sets = node_sets(bodies.drop("digest"), used, scratch)
    links = confirmed(pairs, sets, scratch)
    labels = components(links, scratch)

    # The exact rest: buckets of three or more nodes that still hold several components.
    known = shared.where("size > 2").join(labels, "node", "left").select(
        "band", "slot", "node", "pivot", F.coalesce("label", "node").alias("label")
    ).distinct()
    known = scratch.table(known, "minhash-known")
    by_label = known.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_label.groupBy("band").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("labels")).where(
        "labels > 1"
    )
    left = known.join(mixed, "band").where(F.col("node") != F.col("pivot")).select(
        "band", "slot", "node", "label", (F.col("label") != F.col("main.label")).alias("other"),
        F.ceil((F.col("all") - F.col("main.n")) / F.lit(BLOCK)).cast("int").alias("cuts"), F.ceil(F.col("all") / F.lit(BLOCK)).cast("int").alias("blocks"),
    )
    # Rest nodes are dealt to cuts and members to blocks; each cut meets each block once.
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = left.where("other").withColumn("cut", own("cuts")).withColumn("block", every("blocks"))
    members = left.withColumn("block", own("blocks")).withColumn("cut", every("cuts"))
    wanted = scratch.table(sets.join(left.select("node").distinct(), "node", "left_semi"), "minhash-wanted")
    more = scratch.table(block_links(rest.join(wanted, "node"), members.join(wanted, "node")), "minhash-rest")
    if more.limit(1).count():
        labels = components(links.unionByName(more).distinct(), scratch)

    # Components are known by their nodes; ids, which may be null or repeated, only name them.
    first = F.struct("rep", "digest")
    named = labels.join(reps, "node").groupBy("label").agg(F.min(first).alias("first"))
    by_key = classes.join(labels.join(named, "label").select("node", "first"), "node", "left").select(
        "key", F.coalesce("first", first).alias("first")
    )
    marked = rows.select("doc_id", "digest", "n_shingles", "key").join(by_key, "key", "left")
    component = F.coalesce(F.col("first")["rep"], F.col("doc_id"))
    clean = lambda c: F.nullif(c, last)
    result = marked.select(
        clean(F.col("doc_id")).alias("doc_id"), "digest", "n_shingles", clean(component).alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
        F.coalesce(F.struct("doc_id", "digest") == F.col("first"), F.lit(True)).alias("only"),
    )
    result = materialised(result, "minhash-result")
    scratch.clear()
    return result


def op5(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def drop_near_duplicates(spark, docs, sf_dir):
    """Pipeline stage: one document of each component stays; all columns stay.

    A document is known by its id and text; rows that repeat both stay or go
    together. Equal texts without an id are not told apart: one row of them
    stays, the first by its other columns.
    """
    gone_id, gone_digest, digest, row = free_names(docs, "gone_id", "gone_digest", "digest", "row")
    gone = marked_rows(docs).where(~F.col("only")).select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest)).distinct()
    nameless = F.col("doc_id").isNull() & (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_WS)) > 0)
    others = [F.col(c) for c in docs.columns if c != "text"]
    keyed = docs.withColumn(digest, text_digest(F.col("text")))
    # Combined per task first, so many copies of one text are one row of each task.
    single = (
        keyed.where(nameless).groupBy(digest).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*others))).alias(row)).select(f"{row}.*", digest)
    )
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone_digest))
    return keyed.where(~nameless).unionByName(single).join(gone, same, "left_anti").drop(digest)
