"""License scan: exact set-similarity join of text blocks with templates.

A block holds a template when ``|block & template| >= containment *
|template|`` over distinct words. Blocks are the lines of a text (for notice
templates), each with the words after it in its paragraph that a notice begun
in the line can run on to, and the paragraphs, lines between blank lines (for
long templates).

Method. Words are ordered by their frequency in the whole corpus, rarest
first. With an overlap of at least ``a`` needed, one of the template's first
``|template| - a + 1`` words must be among the block's first
``|block| - a + 1``  (prefix filter); a block with fewer than ``a`` template
words cannot match (length filter); and a shared prefix word at positions
``i`` and ``j`` leaves at most ``min(|template| - i, |block| - j)`` words to
share (positional filter). What is left is verified by counting. A block's
words outside all templates can never overlap, so blocks are cut down to the
template vocabulary first; this changes no overlap.

Besides, places where a base phrase's words stand consecutively are counted.

Scale: one pass counts the frequency of template words (partial sums per
task), a second emits the blocks that pass the filters. The template index is
of fixed size; text never moves.

Defined results: null text is empty and gives zero counts, null places and
empty labels; repeated rows are scanned alike; ``score`` is the best
containment of a verified block, at least ``PHRASE_SCORE`` with a base phrase,
0 without any finding; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table, utf8

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
PHRASE_SCORE = 0.5
#: Notices (matched against lines) and longer grants (matched against paragraphs).
NOTICES = (
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is licensed under the gnu lesser general public license version 2 1"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)
GRANTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction including without limitation the rights to "
            "use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
               "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer redistributions in binary form must reproduce the above copyright notice"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
)
CONTAINMENT = 0.85

# A-Z become a-z; all other ASCII characters that are not digits or letters become blanks.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 10 else 32 for c in range(256)
)


def folded(text: bytes) -> bytes:
    """Lower-cased text in which only words and line ends are left."""
    return text.translate(_FOLD)


class Templates:
    """The templates as word sets in corpus-frequency order, with the prefix index."""

    def __init__(self, templates=None, containment: float = CONTAINMENT, frequency: dict[str, int] | None = None):
        templates = [(k, *t) for k, group in (("line", NOTICES), ("paragraph", GRANTS)) for t in group] if templates is None else templates
        freq = frequency or {}
        self.kinds = [k for k, _, _ in templates]
        self.labels = [label for _, label, _ in templates]
        sets = [sorted(set(text.encode().split())) for _, _, text in templates]
        vocabulary = sorted({w for s in sets for w in s}, key=lambda w: (freq.get(w.decode(), 0), w))
        self.rank = {w: r for r, w in enumerate(vocabulary)}
        self.sets = [sorted(self.rank[w] for w in s) for s in sets]
        #: Words that a notice can have after the line it begins in.
        self.reach = max((len(text.split()) - 1 for kind, _, text in templates if kind == "line"), default=0)
        self.need = [max(1, math.ceil(containment * len(s) - 1e-9)) for s in self.sets]
        #: word -> (template, position of the word in it), for prefix words only
        self.prefix: dict[str, dict[int, list[tuple[int, int]]]] = {"line": {}, "paragraph": {}}
        for t, (s, a) in enumerate(zip(self.sets, self.need)):
            for i, r in enumerate(s[: len(s) - a + 1]):
                self.prefix[self.kinds[t]].setdefault(r, []).append((t, i))

    def candidates(self, kind: str, block: list[int]):
        """Templates that a block (ranks, ascending) may hold, after all filters."""
        index, size, seen = self.prefix[kind], len(block), set()
        for j, r in enumerate(block):
            for t, i in index.get(r, ()):
                a = self.need[t]
                if t in seen or size < a or j > size - a:  # length and prefix filter of the block
                    continue
                if 1 + min(len(self.sets[t]) - i - 1, size - j - 1) >= a:  # positional filter
                    seen.add(t)
                    yield t


def blocks(text: bytes, reach: int):
    """``(kind, words)`` of a folded text: every line with the next ``reach``
    words of its paragraph, and every paragraph."""
    paragraph: list[bytes] = []
    ends: list[int] = []
    for line in [*text.split(b"\n"), b""]:
        words = line.split()
        if words:
            paragraph += words
            ends.append(len(paragraph))
        elif ends:
            for start, end in zip([0, *ends], ends):
                yield "line", paragraph[start : end + reach]
            yield "paragraph", paragraph
            paragraph, ends = [], []


def phrase_places(words: list[bytes], phrases) -> list[tuple[int, int, str]]:
    """``(first word, last word, label)`` of every place of every phrase."""
    out = []
    for phrase, label in phrases:
        want = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(want[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(want)] == want:
                out.append((at, at + len(want) - 1, label))
    return out


def word_frequencies(bodies: DataFrame, words: set[bytes]) -> dict[str, int]:
    """Occurrences of the template words in the whole corpus; the result has one entry per template word."""
    known = frozenset(words)

    def count(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            for body in batch.column("body"):
                for w in folded(body.as_py()).split():
                    if w in known:
                        total[w] = total.get(w, 0) + 1
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w.decode() for w in total], pa.string()), "n": pa.array(list(total.values()), pa.int64())}
        )

    rows = bodies.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"]: r["n"] for r in rows}


SCAN = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
    ("found", pa.list_(pa.struct([("template", pa.int32()), ("kind", pa.string()), ("ranks", pa.list_(pa.int32()))]))),
])
SCAN_DDL = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    "found array<struct<template:int,kind:string,ranks:array<int>>>"
)


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=None,
                 containment: float = CONTAINMENT, phrases=PHRASES) -> DataFrame:
    """Counts, places, labels and score per row of ``docs``."""
    spark = docs.sparkSession
    bodies = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(F.col(text_col)).alias("body"))
    plain = Templates(templates, containment)
    index = Templates(templates, containment, word_frequencies(bodies, set(plain.rank)))
    first_words = [p.encode().split()[-1] for p, _ in phrases]

    def scan(batch):
        cols = {f.name: [] for f in SCAN}
        rare = set(index.prefix["line"]) | set(index.prefix["paragraph"])
        triggers = [w for w, r in index.rank.items() if r in rare]
        for body in batch.column("body"):
            text = folded(body.as_py())
            words = text.split()
            places = phrase_places(words, phrases) if any(w in text for w in first_words) else []
            found = []
            if not set(words).isdisjoint(triggers):
                for kind, block in blocks(text, index.reach):
                    ranks = sorted({index.rank[w] for w in block if w in index.rank})
                    for t in index.candidates(kind, ranks):
                        found.append({"template": t, "kind": kind, "ranks": ranks})
            for name, value in (
                ("n_words", len(words)), ("n_base", len(places)), ("first_word", min((p[0] for p in places), default=None)),
                ("last_word", max((p[0] for p in places), default=None)),
                ("base_labels", sorted({p[2] for p in places})), ("found", found),
            ):
                cols[name].append(value)
        cols["doc_id"] = batch.column("doc_id")
        return cols

    scanned = bodies.mapInArrow(arrow_rows(scan, SCAN), SCAN_DDL)
    # The verification side: one row per template, of fixed size.
    sides = spark.createDataFrame(
        [(label, s, a) for label, s, a in zip(index.labels, index.sets, index.need)], "label string, words array<int>, need int"
    ).collect()
    listed = F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.array(*map(F.lit, r["words"])).alias("words"),
                                F.lit(r["need"]).alias("need")) for r in sides])
    verified = F.filter(
        F.transform("found", lambda f: F.struct(
            listed[f["template"]]["label"].alias("label"), listed[f["template"]]["need"].alias("need"),
            F.size(F.array_intersect(f["ranks"], listed[f["template"]]["words"])).alias("shared"),
            F.size(listed[f["template"]]["words"]).alias("size"))),
        lambda f: f["shared"] >= f["need"],
    )
    out = scanned.withColumn("hits", verified)
    labels = F.array_sort(F.array_union("base_labels", F.transform("hits", lambda h: h["label"])))
    best = F.aggregate("hits", F.lit(0.0), lambda s, h: F.greatest(s, h["shared"] / h["size"]))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(F.col("n_base") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
    )


def op7(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))
