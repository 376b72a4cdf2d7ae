"""Operators that compare documents with each other."""

import collections
import hashlib
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import circulant_minhash, queries, source_mix, suffix_dedup, warc_bundle, winnowing

from . import edge

SF = "/root/testdata/sf0.001"


def texts_of(folder):
    t = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))


# -- archives ------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    long = "<p>" + "x" * 400_000
    pages = [(5, "http://a", "y" * 100), (3, "http://b c\n", "y" * 100), (4, None, "y" * 100), (4, None, "y" * 100), (6, "u", "z" * 99),
             (7, "u", "z" * 99), (8, "u", None), (9, "u", ""), (None, "u", "y" * 100), (10, "u", long), (11, "u", "é" * 50), (12, "u", "é" * 50)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, payload string")
    path = str(tmp_path / "warc")
    warc_bundle.write_archives(warc_bundle.classified(df), path, bundle_bytes=1000)
    got = warc_bundle.read_archives(spark, path)
    rows = got.collect()
    want = []
    for page, _, html in pages:
        raw = (html or "").encode()
        same = [p for p, _, h in pages if p is not None and (h or "").encode() == raw]
        again = len(raw) >= 100 and same and page != min(same)
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert sorted(map(str, (tuple(r)[:5] for r in rows))) == sorted(map(str, want))
    assert [r["url"] for r in rows if r["page_id"] == 3] == ["http://b%20c%0A"]
    # The files are seekable: every record is found by its place, and the stream reads from start to end.
    import zstandard

    files = {r["path"]: bytes(r["content"]) for r in spark.read.format("binaryFile").load(path).collect() if r["length"]}
    assert len(files) > 1
    for r in rows:
        bundle = warc_bundle.Bundle(files[r["archive"]])
        fields, payload = warc_bundle.parse_record(bundle.record(r["record_id"]))
        assert fields["WARC-Record-ID"] == f"<{r['record_id']}>"
        assert bundle.frame(r["frame"])[r["frame_offset"] :].startswith(b"WARC/1.1")
        assert r["record_type"] == "revisit" or hashlib.sha256(payload).hexdigest() == r["payload_digest"]
    for raw in files.values():
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and whole.endswith(b"\r\n\r\n")


def test_archives_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc_bundle.write_archives(warc_bundle.classified(df), str(tmp_path / "warc"))
    assert warc_bundle.read_archives(spark, str(tmp_path / "warc")).count() == 0


# -- decontamination -------------------------------------------------------------------


def hits(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(len(w) - 12) if len(w) >= 13 else [0] if w else []:
            if item is not None:
                windows[tuple(w[k : k + 13])].add(str(item))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                who = windows.get(tuple(w[k : k + n]))
                if who:
                    hit.update(range(k, k + n))
                    found |= who
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


@pytest.mark.parametrize("limit", [winnowing.BROADCAST_ROWS, 0])
def test_every_window_is_found(spark, monkeypatch, limit):
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", limit)  # 0: the shuffled join
    rnd = np.random.default_rng(9)
    few = lambda n: " ".join(rnd.choice(["aa", "bb", "cc"], n))  # noqa: E731  many repeats and ties
    docs = [*edge.TEXTS, *((100 + k, few(int(rnd.integers(1, 80)))) for k in range(40))]
    items = [(1, edge.PASSAGE), (2, edge.PASSAGE + " more"), (3, edge.text(6, 12)), (4, "One, two"), (5, None), (6, ""), (None, edge.BASE),
             (7, few(15)), (8, few(13)), (9, few(9)), (1, edge.PASSAGE), (10, "aa " * 20), (11, "!!! ...")]
    df = edge.documents(spark, [(i, t, None, None, None, *edge.EXTRA) for i, t in docs])
    got = winnowing.decontaminate(df, edge.benchmark(spark, [(i, t, "x", "x") for i, t in items])).drop("tx")
    assert sorted(str(tuple(r)) for r in got.collect()) == hits(docs, items)


def test_empty_benchmark_and_documents(spark):
    none = edge.benchmark(spark, [])
    got = winnowing.decontaminate(edge.documents(spark), none).collect()
    assert len(got) == len(edge.ROWS) and not any(r["contaminated"] for r in got)
    assert winnowing.decontaminate(edge.documents(spark, []), edge.benchmark(spark, [(1, edge.PASSAGE, "x", "x")])).count() == 0


# -- mix ---------------------------------------------------------------------------------


def test_mix_edges(spark):
    docs = edge.documents(spark)
    got = source_mix.mix_sources(docs, rows_per_range=2).collect()
    again = source_mix.mix_sources(docs, rows_per_range=3).collect()
    key = lambda rs: sorted(str((r["doc_id"], r["size"], r["source"], r["taken"], r["target"])) for r in rs)
    assert len(got) == len(edge.ROWS) and key(got) == key(again)
    sizes = collections.Counter()
    for row in edge.ROWS:
        sizes[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    weights = dict(zip([*sorted(s for s in sizes if s), None], [5.0, 2.0, 1.0, 5.0, 2.0]))
    # Reshare the excess until no source is above its cap.
    target, full, budget = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = budget - sum(2 * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        target = {s: 2.0 * sizes[s] for s in full} | {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            break
        full |= above
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    # Whole epochs before the sample: nothing of a source is left out while another document is taken twice.
    by_source = collections.defaultdict(list)
    for r in got:
        if r["size"]:
            by_source[r["source"]].append(r["taken"] / r["size"])
    assert all(max(v) - min(v) <= 1 for v in by_source.values())
    assert source_mix.mix_sources(edge.documents(spark, [])).count() == 0


def test_mix_prefers_heavy_documents(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w w w w").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    heavy = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = source_mix.mix_sources(df, quality=heavy, weights=(1.0, 1.0), share=0.3, max_epochs=2.0).where("taken > 0").collect()
    even = sum(r["doc_id"] % 2 == 0 for r in got)
    assert len(got) == 1200 and 0.65 < even / len(got) < 0.85


# -- near duplicates ---------------------------------------------------------------------------


def component_rows(docs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = []
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    for a in range(len(docs)):
        find(a)
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = collections.defaultdict(lambda: float("inf"))
    for k, (i, _) in enumerate(docs):
        smallest[find(k)] = min(smallest[find(k)], float("inf") if i is None else i)
    out = []
    for k, (i, _) in enumerate(docs):
        c = smallest[find(k)]
        c = None if c == float("inf") else int(c)
        out.append((i, len(sets[k]), c, i == c))
    return sorted(map(str, out))


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(circulant_minhash, "BLOCK", 8)
    # A graded group: neighbours are alike, the ends are not, so no pivot links to all.
    graded, words = [], edge.text(20, 150).split()
    for k in range(40):
        words[(k * 37) % 150] = f"step{k}"
        graded.append((200 + k, " ".join(words)))
    star = [(300 + k, edge.edited(edge.BASE, 50 + k, 4)) for k in range(30)]
    docs = [*edge.TEXTS, *graded, *star]
    df = edge.documents(spark, [(i, t, None, None, None, *edge.EXTRA) for i, t in docs])
    got = circulant_minhash.near_duplicates(df).collect()
    assert sorted(str(tuple(r)) for r in got) == component_rows(docs)


def test_components_of_the_documents_table(spark):
    got = circulant_minhash.op5(spark, SF).collect()
    assert sorted(str(tuple(r)) for r in got) == component_rows(texts_of(SF))
    assert circulant_minhash.near_duplicates(edge.documents(spark, [])).count() == 0


def test_signature_is_circulant():
    scatter, circle = circulant_minhash.permutations()
    size = 1 << circulant_minhash.UNIVERSE_BITS
    shingles = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    at = scatter[((shingles * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - circulant_minhash.UNIVERSE_BITS)).astype(np.int64)].astype(np.int64)
    want = [int(circle[:size][(at + k) % size].min()) for k in range(circulant_minhash.COORDINATES)]
    assert circulant_minhash.signature(shingles).tolist() == want
    half = circulant_minhash.signature(shingles[:2500])
    assert 0.3 < (half == circulant_minhash.signature(shingles)).mean() < 0.7


# -- repeated passages --------------------------------------------------------------------------


def removed_rows(docs):
    first, out = {}, []
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    for i, text in order:
        raw, rank = (text or "").encode(), float("inf") if i is None else i
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if first.setdefault(raw[k : k + 50], rank) < rank:
                gone[k : k + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def test_removed_bytes_equal_brute_force(spark):
    rnd = np.random.default_rng(3)
    base = edge.text(30, 400)
    cut = []
    for k in range(40):
        a, n = int(rnd.integers(0, 1500)), int(rnd.integers(30, 120))
        cut.append((400 + int(rnd.integers(0, 30)), edge.text(60 + k, 5) + " " + base[a : a + n] + edge.text(90 + k, 4)))
    docs = [*edge.TEXTS, (399, base), *cut, (500, "ab" * 300), (501, "ba" * 200), (502, "a" * 300), (503, "\x00" * 120), (504, "\x00" * 80)]
    df = edge.documents(spark, [(i, t, None, None, None, *edge.EXTRA) for i, t in docs])
    got = suffix_dedup.remove_repeats(df).collect()
    assert sorted(str(tuple(r)) for r in got) == removed_rows(docs)


def test_removed_bytes_of_the_documents_table(spark):
    got = suffix_dedup.op8(spark, SF).collect()
    assert sorted(str(tuple(r)) for r in got) == removed_rows(texts_of(SF))
    assert suffix_dedup.remove_repeats(edge.documents(spark, [])).count() == 0


def test_multikey_order_sorts_bytes():
    raw = np.random.default_rng(2).integers(0, 3, (3000, 30)).astype(np.uint8)
    order = suffix_dedup.multikey_order(suffix_dedup.as_words(raw))
    ranked = [raw[i].tobytes() for i in order]
    assert ranked == sorted(ranked)


def test_shared_places_across_ranges_and_contexts():
    """Contexts that agree only in part: every string is judged by itself."""
    rnd = np.random.default_rng(8)
    width = suffix_dedup.REACH + suffix_dedup.LENGTH
    raw = rnd.integers(97, 99, (60, width)).astype(np.uint8)
    raw[:, suffix_dedup.REACH - 5 : suffix_dedup.REACH + 40] = 100
    raw = raw[rnd.integers(0, 12, 60)]
    least = rnd.integers(0, 10, 60)
    most = np.minimum(least + rnd.integers(0, 20, 60), suffix_dedup.SPAN - 1)
    rows = np.concatenate([raw, least[:, None], most[:, None]], axis=1).astype(np.uint8)
    ids = rnd.integers(0, 20, 60)
    got = suffix_dedup.covered_places(rows, ids)
    for i in range(60):
        for a in range(suffix_dedup.SPAN):
            string = lambda j: (raw[j, :a].tobytes(), raw[j, suffix_dedup.REACH : suffix_dedup.REACH + 50 - a].tobytes())  # noqa: E731, B023
            want = least[i] <= a <= most[i] and any(least[j] <= a <= most[j] and ids[j] < ids[i] and string(j) == string(i) for j in range(60))
            assert bool(got[i] >> a & 1) == want


# -- pipeline --------------------------------------------------------------------------------------


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    folder = edge.stored(spark, str(tmp_path))
    docs = edge.documents(spark)
    near = circulant_minhash.drop_near_duplicates(spark, docs, folder)
    assert near.columns == docs.columns
    assert sorted(r["doc_id"] for r in near.collect() if r["doc_id"] in (7, 8, 9, 10)) == [7, 7]
    passages = suffix_dedup.drop_repeats(spark, docs, folder)
    assert passages.columns == docs.columns and passages.count() == docs.count()
    by_id = {r["doc_id"]: r for r in passages.collect()}
    assert edge.PASSAGE not in by_id[13]["text"] and edge.PASSAGE in by_id[12]["text"] and by_id[8]["text"] == edge.BASE.upper()
    assert by_id[13]["n_chars"] == len(by_id[13]["text"])
    clean = winnowing.drop_contaminated(spark, docs, folder)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()} == {12, 13, 14}


def test_pipeline_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "mix"]
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    assert rows and len(ids) == len(set(ids)) and all(0 < r["taken"] <= 2 * r["size"] for r in rows)
    # One document of each near-duplicate component, and none that the classifier or the benchmark removes.
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    kept = {r["doc_id"] for r in circulant_minhash.near_duplicates(good).where("kept").collect()}
    assert set(ids) <= kept


def test_every_operator_is_registered():
    assert {re.match(r"op(\d+)_", q)[1] for q in queries.QUERIES} == {str(n) for n in range(1, 14)}
