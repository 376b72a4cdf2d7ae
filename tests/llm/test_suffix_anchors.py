"""Anchors of the suffix operator: the right ones, found in little memory; rows told apart whatever the hash."""

import tracemalloc

import numpy as np

from ledgerlake.llm import suffix_dedup


def laid(bodies):
    ends = np.cumsum([len(b) for b in bodies])
    return np.frombuffer(b"".join(bodies), np.uint8), ends - [len(b) for b in bodies], ends


def texts():
    rnd = np.random.default_rng(4)
    plain = [rnd.integers(97, 123, n).astype(np.uint8).tobytes() for n in (49, 0, 50, 700, 51, 3, 333, 75)]
    return [*plain, b"a" * 180, b"ab" * 90, b"", b"\x00" * 60, plain[3][100:260], b"x" * 20, plain[6] + b"a" * 70]


def test_each_string_has_the_leftmost_smallest_gram(monkeypatch):
    bodies = texts()
    data, starts, ends = laid(bodies)
    ranks = suffix_dedup.gram_ranks(data)
    want = {}
    for k, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
        for i in range(s, e - suffix_dedup.LENGTH + 1):
            want[i] = (i + int(ranks[i : i + suffix_dedup.SPAN].argmin()), k)
    for stride in (1 << 16, 64, 7):  # also where the borders of strides lie inside texts
        monkeypatch.setattr(suffix_dedup, "STRIDE", stride)
        place, first, last, text, h = suffix_dedup.anchors(data, starts, ends)
        got = {i: (p, k) for p, a, b, k in zip(*(x.tolist() for x in (place, first, last, text))) for i in range(a, b + 1)}
        assert got == want and int((last - first + 1).sum()) == len(want)
        grams = {data[p : p + suffix_dedup.GRAM].tobytes() for p in place.tolist()}
        assert len(set(h.tolist())) == len(grams)


def test_short_texts_have_no_anchors():
    for bodies in ([], [b"", b"a" * 49], [b"a" * 30] * 5):
        assert all(len(x) == 0 for x in suffix_dedup.anchors(*laid(bodies)))


def test_anchors_take_little_memory():
    """No array as long as the slice with a word a byte: these made the time grow faster than the blocks."""
    data, starts, ends = laid([np.random.default_rng(6).integers(97, 123, 1 << 16).astype(np.uint8).tobytes()] * 32)
    tracemalloc.start()
    place = suffix_dedup.anchors(data, starts, ends)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(place) and peak < 16 * len(data)


def test_rows_with_one_hash_are_told_apart():
    rows = np.random.default_rng(9).integers(0, 2, (400, 12)).astype(np.uint8)
    keys, number = np.unique(rows, axis=0, return_inverse=True)
    for hashed in (suffix_dedup.mixed, lambda words: words[:, 0] & np.uint64(1)):
        index, inverse = suffix_dedup.distinct_rows(rows, hashed)
        assert len(index) == len(keys) and (rows[index][inverse] == rows).all()
        assert len(set(zip(inverse.tolist(), number.reshape(-1).tolist()))) == len(keys)
