"""Quality classifier: a factorisation machine.

``score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)`` over
hashed words, structure statistics and length metadata of the text. The
pairwise part is computed in linear time by the sum-of-squares identity
``0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

The model is fitted on a bounded sample of labelled rows (``train_rows``, the
same rows on every run); every document is then scored where it lies, without
a shuffle. The model has a fixed size, whatever the corpus.

Defined results: null and empty texts are scored like any other (all
statistics zero); without usable labels, or with one class only, every score
is the share of label 1 (0.5 without labels); rows with a null or conflicting
label do not train; repeated rows are scored alike. Inputs of a score are the
text alone: never labels, lang, source or doc_id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, free_names, table, unique_ids, utf8

#: Labelled rows that may train the model (a documented bound).
TRAIN_ROWS = 6_000
BITS = 15
RANK = 8
STATS = 14  # structure statistics, one feature each
BINS = 8  # and one indicator feature per statistic and bin
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"


def _share(text: bytes, chars: bytes) -> float:
    return 1.0 - len(text.translate(None, chars)) / max(len(text), 1)


def statistics(text: bytes, words: list[bytes], counts: dict[bytes, int]) -> np.ndarray:
    """Structure and length of a text, each between 0 and 1."""
    n, chars = len(words), max(len(text), 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    top = max(counts.values(), default=0)
    return np.array([
        min(len(text).bit_length() / 24, 1.0),
        min(n.bit_length() / 20, 1.0),
        _share(text, UPPER),
        _share(text, LOWER),
        _share(text, DIGITS),
        _share(text, SYMBOLS),
        min(text.count(b"!") / max(n, 1), 1.0),
        min((text.count(b".") + text.count(b",")) / max(n, 1), 1.0),
        1.0 - len(set(lines)) / max(len(lines), 1),
        1.0 - len(counts) / max(n, 1),
        top / max(n, 1),
        min(chars / max(n, 1) / 20, 1.0),
        min(len(lines) / max(n, 1), 1.0),
        min(max(map(len, lines), default=0) / chars, 1.0),
    ])


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values: hashed words (unit length together), statistics and their bins."""
    words = text.split()
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    stats = statistics(text, words, counts)
    if counts:
        ids = np.array([zlib.crc32(w) for w in counts], dtype=np.int64) & ((1 << bits) - 1)
        values = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        values /= np.sqrt((values**2).sum())
    else:
        ids, values = np.zeros(0, dtype=np.int64), np.zeros(0)
    base = 1 << bits
    binned = base + STATS + np.arange(STATS) * BINS + np.minimum((np.sqrt(stats) * BINS).astype(np.int64), BINS - 1)
    return (
        np.concatenate([ids, base + np.arange(STATS), binned]),
        np.concatenate([values, stats, np.full(STATS, 0.25)]),
    )


class FactorMachine:
    """Weights of the machine; ``raw`` is the logit of one feature list."""

    def __init__(self, bits: int = BITS, rank: int = RANK, seed: int = 7):
        size = (1 << bits) + STATS * (1 + BINS)
        rng = np.random.default_rng(seed)
        self.bits, self.b = bits, 0.0
        self.w = np.zeros(size)
        self.v = rng.normal(0, 0.01, (size, rank))

    def raw(self, ids: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[ids] * x[:, None]
        return self.b + float(self.w[ids] @ x) + 0.5 * float((vx.sum(0) ** 2 - (vx**2).sum(0)).sum())

    def score(self, text: bytes) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(*features(text, self.bits)), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 0.1,
            decay: float = 1e-5, seed: int = 7) -> "FactorMachine":
        """AdaGrad over single rows; both classes weigh the same in total."""
        share = labels.mean() if len(labels) else 0.5
        if len(labels) == 0 or share in (0.0, 1.0):
            self.b, self.v[:] = (30.0 if share == 1.0 else -30.0 if share == 0.0 else 0.0), 0.0
            return self
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        weight = np.clip(weight, 0.2, 5.0)
        gw, gv, gb = np.full(self.w.shape, 1e-3), np.full(self.v.shape, 1e-3), 1e-3
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for r in rng.permutation(len(rows)):
                ids, x = rows[r]
                vx = self.v[ids] * x[:, None]
                total = vx.sum(0)
                logit = self.b + float(self.w[ids] @ x) + 0.5 * float((total**2 - (vx**2).sum(0)).sum())
                g = weight[r] * (1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))) - labels[r])
                dw = g * x + decay * self.w[ids]
                dv = g * x[:, None] * (total - vx) + decay * self.v[ids]
                gw[ids] += dw**2
                gv[ids] += dv**2
                gb += g * g
                self.w[ids] -= rate * dw / np.sqrt(gw[ids])
                self.v[ids] -= 0.3 * rate * dv / np.sqrt(gv[ids])
                self.b -= rate * g / gb**0.5
        return self


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS, bits: int = BITS) -> FactorMachine:
    """Fit on at most ``train_rows`` labelled rows. ``labels(doc_id, quality)`` holds the rows that may train.
    Of an id that many rows repeat, the rows with the smallest hashes of their features train."""
    usable = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("q_max")
    ).where((F.col("quality") == F.col("q_max")) & F.col("quality").isin(0, 1))
    # The limit bounds the broadcast; the rarer class gets up to half of it.
    parts = [unique_ids(usable.where(F.col("quality") == q), "doc_id", train_rows // 2) for q in (0, 1)]
    picked = parts[0].withColumn("quality", F.lit(0)).unionByName(parts[1].withColumn("quality", F.lit(1)))
    sample = docs.select(F.col(id_col).alias("doc_id"), utf8(F.col(text_col)).alias("body")).join(
        F.broadcast(picked), "doc_id"
    )

    def featurise(batch):
        made = [features(b.as_py(), bits) for b in batch.column("body")]
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "quality": batch.column("quality").cast(pa.int32()),
            "ids": [i.astype(np.int32).tobytes() for i, _ in made],
            "x": [x.astype(np.float32).tobytes() for _, x in made],
        }

    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())])
    made = sample.mapInArrow(arrow_rows(featurise, schema), "doc_id bigint, quality int, ids binary, x binary")
    # Ids may repeat: the rows that the driver gathers are bounded too. Spark applies such a rank limit in every task
    # before the shuffle.
    rank = F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id", "ids", "x"), "doc_id", "ids", "x"))
    rows = made.withColumn("rank", rank).where(F.col("rank") <= train_rows // 2).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["ids"]), bytes(r["x"])))  # the same order on every run
    made = [(np.frombuffer(r["ids"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(np.float64)) for r in rows]
    return FactorMachine(bits).fit(made, np.array([float(r["quality"]) for r in rows]))


def score_quality(docs: DataFrame, model: FactorMachine, *, text_col: str = "text", keep: list[str] | None = None,
                  score_col: str = "fm_score") -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) plus the score as last column; no shuffle."""
    names = docs.columns if keep is None else keep
    added, body = free_names(docs, score_col, "fm_body")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    source = docs.select(*names, utf8(F.col(text_col)).alias(body))
    out = docs.select(*names).withColumn(added, F.lit(0.0)).schema

    def score(batches):
        machine = shared.value
        for batch in batches:
            scores = pa.array([machine.score(b.as_py()) for b in batch.column(body)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [scores], names=[*names, added])

    return source.mapInArrow(score, out)


def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 3
    labels = table(spark, sf_dir, "labels").where(fold("doc_id") != 1)
    model = train(docs, labels)
    scored = score_quality(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        F.col("fm_score").alias("score"),
        (F.col("fm_score") >= 0.5).cast("int").alias("predicted"),
    )


def reject_low_quality(spark, docs, sf_dir):
    """Pipeline stage: documents the classifier rejects go; all columns stay."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    model = train(table(spark, sf_dir, "documents"), labels)
    scored = score_quality(docs, model)
    return scored.where(F.col(scored.columns[-1]) >= 0.5).select(docs.columns)
