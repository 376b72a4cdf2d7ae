"""The score and the threshold that the query uses, against plain counts."""

import collections
import math
import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import ngram_rules as ng

from . import edge


def grams(text, bits):
    return ng.ngram_buckets(ng.word_hashes((text or "").encode().split()), bits).tolist()


def expected_scores(docs, target):
    n_raw, n_target = (sum(max(2 * len((t or "").split()) - 1, 0) for t in texts) for texts in ([t for _, t in docs], target))
    bits = min(48, n_raw.bit_length() + 8)
    raw, good = collections.Counter(), collections.Counter()
    for _, t in docs:
        raw.update(grams(t, bits))
    for t in target:
        good.update(grams(t, bits))

    def ratio(g):
        prior = raw[g] / n_raw
        return math.log((good[g] + 0.05 * n_target * prior) / (1.05 * n_target)) - math.log(prior)

    return [(i, np.mean([ratio(g) for g in grams(t, bits)]) if (t or "").split() else 0.0) for i, t in docs]


def made(seed, n):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["the"] * 30
    return [(k % (n - 3) if k % 11 else None, rnd.choice([None, "", *[" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 90))) for _ in range(9)]])) for k in range(n)]


@pytest.mark.parametrize("common, block, per_range", [(1 << 16, 2_000_000, 3_000_000), (0, 500, 200), (7, 300, 100), (40, 10_000, 1)])
def test_score_is_the_mean_log_ratio(spark, monkeypatch, common, block, per_range):
    monkeypatch.setattr(ng, "COMMON", common)
    monkeypatch.setattr(ng, "COMMON_SHARE", 1)
    monkeypatch.setattr(ng, "BLOCK_GRAMS", block)
    monkeypatch.setattr(ng, "RANGE_GRAMS", per_range)
    rows = made(4, 120) + [(i, t) for i, t in edge.TEXTS]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id bigint, text string, body string, key string, n int").repartition(5)
    target = docs.where(F.col("doc_id") % 3 == 0)
    got = sorted(((r["doc_id"], r["score"]) for r in ng.quality_rules(docs, target).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted(expected_scores(rows, [t for i, t in rows if i is not None and i % 3 == 0]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-5)


def test_common_keys_find_their_own():
    rnd = np.random.default_rng(2)
    keys = np.unique(rnd.integers(0, 1 << 40, 70_000)).astype(np.uint64)
    rnd.shuffle(keys)
    table = ng.CommonKeys(keys[:60_000].tolist(), 40)
    number = table.numbers(keys)
    found = number[number >= 0]
    assert len(set(found.tolist())) == len(found) == table.size > 59_000 and (number[60_000:] < 0).all()
    assert (number[:1000] >= 0).all()  # the most frequent come first and have a place
    assert (ng.CommonKeys([], 40).numbers(keys) < 0).all()


def test_threshold_has_the_fewest_errors(spark):
    rnd = random.Random(8)
    for k in range(4):
        rows = [(i, round(rnd.gauss(0.3 if good else -0.3, 0.25), 3), good, rnd.random() < 0.1) for i in range(300) for good in [rnd.random() < 0.5]]
        scored = spark.createDataFrame([(i, s, failed) for i, s, _, failed in rows], "doc_id bigint, score double, base_failed boolean")
        labelled = spark.createDataFrame([(i, good) for i, _, good, _ in rows], "doc_id bigint, good boolean")
        held = {r["doc_id"] for r in labelled.where(ng.held_out()).collect()}
        bins = [(math.floor(s * 100), good) for i, s, good, failed in rows if i in held and not failed]
        goods, bads = [b for b, g in bins if g], [b for b, g in bins if not g]
        error = {c: sum(b < c for b in goods) / len(goods) + sum(b >= c for b in bads) / len(bads) for c in range(min(b for b, _ in bins) + 1, max(b for b, _ in bins) + 1)}
        cut = ng.held_out_cut(scored, labelled, -9.0)
        least = min(error.values())
        assert error[math.ceil(cut * 100 - 1e-9)] == pytest.approx(least)
        stretches = collections.Counter()
        have = sorted({b for b, _ in bins})
        for c, e in error.items():
            if e == least:
                stretches[max(b for b in have if b < c)] += 1
        widest = max(stretches.values())
        assert cut in [pytest.approx((low + 1 + low + n) / 200) for low, n in stretches.items() if n == widest]


def test_query_keeps_what_passes(spark):
    rows = ng.op9(spark, "/root/testdata/sf0.001").collect()
    assert all(r["kept"] <= (not r["base_failed"]) for r in rows)
    kept, gone = [r["score"] for r in rows if r["kept"]], [r["score"] for r in rows if not r["kept"] and not r["base_failed"]]
    assert kept and (not gone or max(gone) < min(kept))


def test_common_keys_travel_without_their_tables():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 40, 30_000, dtype=np.uint64))
    keys = np.random.default_rng(6).permutation(keys)
    own = ng.CommonKeys(keys, 40)
    sent = pickle.dumps(own)
    assert len(sent) < 9 * len(keys)
    asked = np.concatenate([keys, keys + np.uint64(1)])
    assert (pickle.loads(sent).numbers(asked) == own.numbers(asked)).all() and (own.numbers(keys) >= 0).mean() > 0.99
