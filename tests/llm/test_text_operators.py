"""Operators that judge each text by itself."""

import collections
import json
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlake.llm import factor_machine, html_mincut, license_scan, ngram_rules, token_count

from . import edge

SF = "/root/testdata/sf0.001"


def rows(df, key="doc_id"):
    return sorted(map(tuple, df.collect()), key=str)


# -- quality rules ----------------------------------------------------------------


def base_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_rules_match_a_plain_count(spark):
    docs = edge.documents(spark)
    got = ngram_rules.quality_rules(docs, docs.where("doc_id in (7, 12)")).collect()
    want = collections.Counter((i, *base_rules(t)) for i, t in edge.TEXTS)
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    assert all(not (r["kept"] and r["base_failed"]) for r in got)


def test_rules_without_target_or_rows(spark):
    docs = edge.documents(spark)
    none = docs.limit(0)
    assert {r["score"] for r in ngram_rules.quality_rules(docs, none).collect()} == {0.0}
    assert ngram_rules.quality_rules(none, none).count() == 0


def test_likelihood_ratio_is_the_mean_over_ngrams(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c c c c")], "doc_id bigint, text string")
    target = docs.where("doc_id = 1")
    got = {r["doc_id"]: r["score"] for r in ngram_rules.quality_rules(docs, target, bits=10).collect()}
    size = 1 << 10
    grams = {
        1: ngram_rules.ngram_buckets(ngram_rules.word_hashes([b"a", b"b", b"a"]), 10),
        2: ngram_rules.ngram_buckets(ngram_rules.word_hashes([b"c"] * 4), 10),
    }
    raw = np.bincount(np.concatenate(list(grams.values())), minlength=size) + 1.0
    prior = raw / raw.sum()
    t = np.bincount(grams[1], minlength=size) + size * prior
    ratio = np.log(t / t.sum()) - np.log(prior)
    for i in (1, 2):
        assert got[i] == pytest.approx(ratio[grams[i]].mean(), abs=1e-5)
    assert got[1] > 0 > got[2]


# -- classifier ---------------------------------------------------------------------


def test_sum_of_squares_identity():
    machine = factor_machine.FactorMachine(bits=6, rank=3)
    rng = np.random.default_rng(1)
    machine.w, machine.v, machine.b = rng.normal(size=machine.w.shape), rng.normal(size=machine.v.shape), 0.3
    ids, x = np.array([1, 5, 9, 70]), np.array([0.5, 1.0, 2.0, 0.1])
    pairs = sum(machine.v[ids[i]] @ machine.v[ids[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert machine.raw(ids, x) == pytest.approx(0.3 + machine.w[ids] @ x + pairs)


def test_classifier_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in factor_machine.op2(spark, "/root/testdata/sf0.01").collect()}
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    assert len(got) == 1000
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert sum(right) / len(right) > 0.95


def test_classifier_edges(spark, tmp_path):
    folder = edge.stored(spark, str(tmp_path))
    got = factor_machine.op2(spark, folder).collect()
    assert len(got) == len(edge.ROWS) and all(0 <= r["score"] <= 1 for r in got)
    again = sorted(map(str, factor_machine.op2(spark, folder).collect()))
    assert again == sorted(map(str, got))
    kept = factor_machine.reject_low_quality(spark, edge.documents(spark), folder)
    assert kept.columns == edge.documents(spark).columns
    nothing = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert factor_machine.train(edge.documents(spark), nothing).score(b"any text") == 0.5
    empty = edge.documents(spark, [])
    assert factor_machine.score_quality(empty, factor_machine.FactorMachine()).count() == 0


# -- tokens ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return token_count.TokenCounter(json.loads(token_count.tokenizer_file()))


def library_counts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(token_count.TOKENIZER))
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_tokens_equal_the_library(counter):
    rnd = np.random.default_rng(5)
    parts = ["'", "s", "t", "re", "'ve", "m", "'ll", " ", "  ", "\n", "\t", " ", "a", "B", "é", "1", "٣", "!", "#", "日本",
             "\U0001f600", "\x00", "<|endoftext|>", "'r", "'l", "e", " ", "_", "'D", "the", " of"]
    texts = ["".join(rnd.choice(parts, size=rnd.integers(0, 30))) for _ in range(1500)]
    texts += [t or "" for _, t in edge.TEXTS] + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    assert counter.counts(texts).tolist() == library_counts(texts)


def test_chunk_maps_compose_to_the_sequential_states(counter):
    splitter = counter.splitter
    classes = np.random.default_rng(2).integers(0, 11, 5000).astype(np.uint8)
    state, want = token_count.START, []
    for c in classes:
        want.append(state)
        state = splitter.next[state, c]
    assert splitter.states(classes).tolist() == want


def test_token_query_edges(spark):
    got = token_count.count_tokens(edge.documents(spark), token_count.tokenizer_file()).collect()
    texts = [t or "" for _, t in edge.TEXTS]
    want = list(zip([i for i, _ in edge.TEXTS], [len(t.encode()) for t in texts], library_counts(texts)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_count.count_tokens(edge.documents(spark, []), token_count.tokenizer_file()).count() == 0


# -- licenses ----------------------------------------------------------------------------


def base_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_places(spark):
    texts = [*edge.TEXTS, (30, "MIT mit license MIT License. GNU General\nPublic, license apache license mit"), (31, "mit-license")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = license_scan.license_scan(docs).collect()
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(str((i, *base_places(t))) for i, t in texts)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_license_join_finds_every_block(spark):
    rnd = np.random.default_rng(3)
    words = [f"w{k}" for k in range(40)]
    templates = [("line", f"t{k}", " ".join(rnd.choice(words, rnd.integers(1, 9), replace=False))) for k in range(12)]
    lines = [" ".join(rnd.choice(words, rnd.integers(1, 14))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.license_scan(docs, templates=templates, containment=0.7).collect()}
    for i, line in enumerate(lines):
        have, labels, best = set(line.split()), set(), 0.0
        for _, label, t in templates:
            share = len(have & set(t.split())) / len(set(t.split()))
            if share >= 0.7 - 1e-12:
                labels.add(label)
                best = max(best, share)
        assert got[i]["labels"] == ",".join(sorted(labels)) and got[i]["score"] == pytest.approx(best)


# -- pages -------------------------------------------------------------------------------


PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body class='has-sidebar'>"
    "<header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></ul></nav><div id='sidebar'><p>Some long side text that goes on.</p></div>"
    "<main><div class=notice>Please accept</div><h1>Title &eacute;</h1><p>First  para with <a href=x>link</a>\n inside."
    "<form><input><label>Mail</label></form><p>Second &lt;b&gt;.</p><ul><li>one<li>two</ul>"
    "<div class='comments'><p>A reader says hello and a lot more than that, indeed.</p></div></main>"
    "<div class='ad'>Buy now.</div><footer>(c)</footer><p"
)


def test_main_text():
    assert html_mincut.main_text(PAGE) == "Title é\nFirst para with link inside.\nSecond <b>.\none\ntwo"


def test_min_cut_is_minimal():
    rng = np.random.default_rng(4)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        own = rng.normal(size=n).round(3).tolist()
        edges = {(i, j): float(rng.random().__round__(3)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(labels):
            terminals = sum(max(o, 0) if not l else max(-o, 0) for o, l in zip(own, labels))
            return terminals + sum(w for (i, j), w in edges.items() if labels[i] != labels[j])

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert cost(html_mincut.min_cut(own, edges)) == pytest.approx(best, abs=1e-3)


def test_articles_of_the_pages_table(spark):
    got = {r["page_id"]: r for r in html_mincut.op10(spark, SF).collect()}
    import html

    for page in pq.read_table(f"{SF}/pages.parquet").to_pylist():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1|li|ul)>", article))
        want = "\n".join(p for p in parts if p)
        assert got[page["page_id"]]["text"] == want and got[page["page_id"]]["n_chars"] == len(want)


def test_page_edges(spark):
    long = "<article>" + "<p>Word word.</p>" * 5000 + "</article>"
    pages = [(1, "u", None), (2, None, ""), (3, "u", "plain words without any markup at all, but quite a few."), (None, "u", "<<<>>> <p"), (4, "u", long), (4, "u", long)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, text string")
    got = html_mincut.extract_text(df).collect()
    assert len(got) == len(pages)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert [r["n_chars"] for r in got if r["page_id"] == 4] == [5000 * 11 - 1] * 2
    assert html_mincut.extract_text(df.limit(0)).count() == 0
