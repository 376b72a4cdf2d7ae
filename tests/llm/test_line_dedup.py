"""Shared lines against a plain count of all keys."""

import collections
import hashlib
import random

import pytest

from ledgerlake.llm import line_dedup as ld

from . import edge

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs, min_docs=10, min_chars=1, keep_first=False):
    keyed = [[(line, line.strip(WHITE).translate(LOWER)) for line in (t or "").split("\n")] for _, t in docs]
    held = collections.Counter(k for rows in keyed for k in {k for _, k in rows})
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, hashlib.sha256((b"" if docs[i][0] is None else b"=%d" % docs[i][0]) + b"\0" + (docs[i][1] or "").encode()).digest()[:16]))
    spared = {}
    if keep_first:
        for i in order:
            for p, (_, k) in enumerate(keyed[i]):
                spared.setdefault(k, (docs[i], p))
    out = []
    for doc, rows in zip(docs, keyed):
        stay = [line for p, (line, k) in enumerate(rows) if len(k) < min_chars or held[k] < min_docs or spared.get(k) == (doc, p)]
        out.append((doc[0], "\n".join(stay) if len(stay) < len(rows) else doc[1], len(rows), len(rows) - len(stay)))
    return sorted(out, key=str)


def compared(spark, docs, **rule):
    df = spark.createDataFrame([(i, t, "k", "x", "y", 1) for i, t in docs], "doc_id bigint, text string, key string, keep string, n_lines string, range int")
    kept = ld.drop_shared_lines(df, **rule)
    assert kept.columns == ["doc_id", "text", "key", "keep", "n_lines", "range", "n_dropped", "n_lines_"] or set(kept.columns) >= set(df.columns)
    got = kept.select("doc_id", "text", "n_lines_", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == expected(docs, **rule)


def made(seed, n):
    rnd = random.Random(seed)
    lines = ["", " ", "Menu", " menu\t", "MENU", "Ünder", "ünder", "a", "b ", *(f"line {k}" for k in range(30))]
    docs = [(rnd.choice([None, *range(n)]), rnd.choice([None, "", "\n", *["\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 8))) for _ in range(12)]])) for _ in range(n)]
    return docs + docs[:5]


@pytest.fixture(params=[8, 40])
def ranges(spark, request):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], str(request.param == 8).lower())
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


@pytest.mark.parametrize("rule", [{}, {"min_docs": 3}, {"min_docs": 1, "min_chars": 2}, {"min_docs": 2, "keep_first": True}, {"min_docs": 12, "keep_first": True}])
def test_lines_equal_a_plain_count(spark, ranges, rule):
    compared(spark, made(1, 90), **rule)


def test_line_of_a_third_of_all_rows(spark, ranges):
    docs = [(k, f"own {k}\nSubscribe now\nend {k % 7}" if k % 3 == 0 else f"own {k}") for k in range(1500)]
    compared(spark, docs)
    compared(spark, docs, keep_first=True)


def test_awkward_rows(spark):
    long = "\n".join(["same"] * 50_000 + ["x" * 2_000_000])
    docs = [(i, t) for i, t in edge.TEXTS] + [(100 + k, long if k == 3 else "same\r\nshort\n") for k in range(12)]
    compared(spark, docs)
    compared(spark, [])


def test_bitmaps_name_the_lines_that_stay(spark):
    import zlib

    docs = spark.createDataFrame([(k, f"a\nshared\nb{k}\nshared") for k in range(10)], "doc_id bigint, text string")
    rows = ld.line_keep_bitmaps(docs).collect()
    assert len(rows) == 10 and {(r["n_lines"], r["n_dropped"]) for r in rows} == {(4, 3)}
    assert {zlib.decompress(r["keep"]) for r in rows} == {bytes([0b0100])}
    assert {ld.kept_lines(b"1\n2\n3\n4", r["keep"]) for r in rows} == {b"3"}
