"""Windows and grams that are common on both sides of the decontamination join."""

import random

import pytest

from ledgerlake.llm import winnowing

from . import edge
from .test_table_operators import hits

PHRASE = "this short phrase of seven words stands"


def compared(spark, docs, items):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], "doc_id bigint, text string, w string, h string, win int")
    got = winnowing.decontaminate(df, edge.benchmark(spark, [(i, t, "x", "x") for i, t in items])).drop("tx")
    assert sorted(str(tuple(r)) for r in got.collect()) == hits(docs, items)


def test_hot_phrase_on_both_sides(spark):
    rnd = random.Random(1)
    word = lambda: f"w{rnd.randrange(40)}"
    around = lambda: " ".join([word() for _ in range(8)] + [PHRASE] + [word() for _ in range(8)])
    items = [(k, around()) for k in range(60)]
    docs = [(k, " ".join(around() for _ in range(6)) + (" " + items[k % 60][1] if k % 7 == 0 else "")) for k in range(120)]
    compared(spark, docs, items)


def test_repeated_words_and_letters(spark):
    docs = [(1, "a " * 60), (2, "A b " * 30), (3, "a " * 12), (4, "É a " * 20), (5, "é a " * 20), (6, "İ ß Σ ΑΣ'Α x " * 5), (7, "ΑΣ a b c d e f g h i j k l m"), (8, "ασ a b c d e f g h i j k l m")]
    items = [(1, "a " * 13), (2, "b A " * 7), (3, "a a"), (4, "É A " * 7), (5, "İ SS"), (6, "ΑΣ A B c d e f g h i j k l m"), (7, "İ ß Σ ΑΣ'Α X " * 3)]
    compared(spark, docs, items)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 11, 12, 13, 14])
def test_items_of_every_size(spark, size):
    rnd = random.Random(size)
    items = [(k, " ".join(rnd.choice("abc") for _ in range(size))) for k in range(3)] + [(9, " ".join(rnd.choice("abc") for _ in range(20)))]
    docs = [(k, " ".join(rnd.choice("abc") for _ in range(rnd.choice([3, 30, 200])))) for k in range(12)] + [(90, items[-1][1]), (91, items[0][1]), (91, items[0][1])]
    compared(spark, docs, items)


def test_window_shared_by_many_items(spark):
    items = [(k, edge.PASSAGE) for k in range(300)]
    compared(spark, [(k, f"{edge.PASSAGE} tail {k}") for k in range(40)], items)
