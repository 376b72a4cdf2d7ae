"""A bucket of many unlike texts: both sides of its exact comparison are cut, no pair is lost."""

import random

from ledgerlake.llm import circulant_minhash as cm


def texts(n, seed=3):
    """Texts with a common first half, so that many share a bucket; some are near copies."""
    rnd = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(60))
    out = []
    for i in range(n):
        if i % 10 == 0 and out:
            words = out[rnd.randrange(len(out))][1].split()
            words[-1] = f"n{i}"
            out.append((i, " ".join(words)))
        else:
            out.append((i, common + " " + " ".join(f"w{rnd.randrange(4000)}" for _ in range(rnd.randint(20, 60)))))
    return out


def exact(rows):
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_groups_are_bounded_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(cm, "BLOCK", 16)
    sizes = []
    real = cm.block_links

    def watched(rest, members):
        for side in (rest, members):
            rows = side.groupBy("band", "cut", "block").count().collect()
            sizes.append(max((r["count"] for r in rows), default=0))
        return real(rest, members)

    monkeypatch.setattr(cm, "block_links", watched)
    rows = texts(500)
    got = cm.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == exact(rows)
    assert 0 < sizes[0] <= 3 * 16 and sizes[1] <= 3 * 16  # a hash deals them, so some more than 16


def test_copies_of_a_text_are_one_set(spark, monkeypatch):
    """With a full bitmap every copy passes it: still one set a node."""
    monkeypatch.setattr(cm, "BITMAP_BITS", 6)
    seen = []
    real = cm.node_sets

    def counted(*args):
        sets = real(*args)
        seen.append((sets.count(), sets.select("node").distinct().count()))
        return sets

    monkeypatch.setattr(cm, "node_sets", counted)
    some = texts(60)
    rows = some + [(1000 + k, some[0][1]) for k in range(300)]
    got = cm.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == exact(rows)
    assert seen[0][0] == seen[0][1] <= 60
