"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is 13 consecutive words of a benchmark item. Both sides hash every
7-word gram and keep the smallest hash of each 7 consecutive grams, so two
texts that share 13 words in a row always share a kept hash. Kept hashes of
documents are joined with those of the benchmark; in documents with a match,
every matching place is extended to the windows that hold it, and these are
joined with the benchmark's windows word for word. Items of fewer words are one
window each; they are found by the grams of the shortest such item.

A word is hashed once. Grams and minima of 7 come from those of 1, 2 and 4 by
doubling, so a word takes the same few steps whatever the widths. Hashes use
the whole lower case of a word, which joins all words that are equal with A-Z
lowered; the windows compare words with exactly A-Z lowered.

Scale: documents are never shuffled for the join when the benchmark's hashes
are few (their number is counted first; up to ``BROADCAST_ROWS`` rows of 8
bytes are broadcast), otherwise kept hashes (about a quarter of the words, 8
bytes each) are joined by a shuffle. Only documents with a match are read
again. A place of a document has one window to be joined, and the benchmark
has every window once with its items, so a phrase that is common on both sides
multiplies nothing; items are named per document at the end.

Defined results: null and empty texts have no words, are not hit and not
contaminated; items without words or id are ignored; an empty benchmark hits
nothing; rows that repeat an id and text get the same result each; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, lower_ascii, materialised, table

WINDOW = 13
GRAM = 7
KEEP = WINDOW - GRAM + 1  # grams per winnowing window
#: Benchmark hashes up to this number are broadcast (8 bytes a row).
BROADCAST_ROWS = 1_000_000
#: Share of a document's words that makes it contaminated: 1 / SHARE.
SHARE = 20


# The word pattern of the contract, with A-Z in the class. A class of single
# characters is looked up in a table.
BETWEEN = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
WORD_RAW = f"[^{BETWEEN}]+"


def words(text: Column) -> Column:
    """The words as they are written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_RAW), F.lit(0))


def lowered(w: Column) -> Column:
    return F.transform(w, lower_ascii)


def with_widened(df: DataFrame, name: str, source: str, width: int, join) -> DataFrame:
    """Column ``name``: ``join`` over ``width`` neighbours of ``source``, by place; widths 1, 2, 4, ... are columns
    on the way. A filter on the result would be pushed below these columns and repeat each of them several times, so
    rows are filtered before, and the result is exploded by the outer forms, which imply no filter."""
    df, have = df.withColumn(f"{name}_1", F.col(source)), 1
    while have < width:
        step = min(have, width - have)
        last = F.col(f"{name}_{have}")
        size = F.greatest(F.size(last) - step, F.lit(0))
        df = df.withColumn(f"{name}_{have + step}", F.zip_with(F.slice(last, 1, size), F.slice(last, 1 + step, size), join)).drop(f"{name}_{have}")
        have += step
    return df.withColumnRenamed(f"{name}_{width}", name)


def with_grams(df: DataFrame, name: str, width: int) -> DataFrame:
    """Column ``name``: the hash of every gram of ``width`` words of ``h``, by place."""
    return with_widened(df, name, "h", width, lambda x, y: F.xxhash64(x, y))


def hashed(df: DataFrame) -> DataFrame:
    """Column ``h``: a hash of every word of ``w``."""
    return df.withColumn("h", F.transform("w", lambda x: F.xxhash64(F.lower(x))))


def with_kept(df: DataFrame) -> DataFrame:
    """Column ``kept``: the smallest hash of each window of grams, without repeats."""
    df = with_widened(with_grams(df, "grams", GRAM), "least", "grams", KEEP, lambda x, y: F.least(x, y))
    return df.withColumn("kept", F.array_distinct("least")).drop("least")


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")
    )
    return materialised(items.where(F.size("w") > 0).distinct(), "winnow-items")


def windows_of(items: DataFrame) -> DataFrame:
    """``(code, n, window, ids, win)``: every different window of the items, once; ``win`` numbers them."""
    long = with_grams(hashed(items.where(F.size("w") >= WINDOW)), "code", WINDOW).withColumn("w", lowered(F.col("w")))
    cut = long.select("item_id", "w", F.posexplode_outer("code").alias("i", "code"))
    parts = [cut.select("code", F.lit(WINDOW).alias("n"), F.slice("w", F.col("i") + 1, WINDOW).alias("window"), "item_id")]
    for n in [r["n"] for r in items.where(F.size("w") < WINDOW).select(F.size("w").alias("n")).distinct().collect()]:  # 12 at most
        short = with_grams(hashed(items.where(F.size("w") == n)), "code", n)
        parts.append(short.select(F.element_at("code", 1).alias("code"), F.lit(n).alias("n"), lowered(F.col("w")).alias("window"), "item_id"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    once = every.groupBy("code", "n", "window").agg(F.collect_set("item_id").alias("ids"))
    return materialised(once.withColumn("win", F.monotonically_increasing_id()), "winnow-windows")


def matching_documents(docs: DataFrame, kept: str, keys: DataFrame) -> DataFrame:
    """``(doc_id, tx, fps)``: the hashes each document shares with ``keys(fp)``."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    shared = docs.select("doc_id", "tx", F.explode_outer(kept).alias("fp")).join(keys, "fp", "left_semi")
    return shared.groupBy("doc_id", "tx").agg(F.collect_set("fp").alias("fps"))


def found_windows(docs: DataFrame, found: DataFrame, gram: int, n: int, reach: int) -> DataFrame:
    """``(doc_id, tx, start, code, n, window)``: the windows of ``n`` words that start up to ``reach`` places before a shared gram."""
    back = found.select(F.col("doc_id").alias("f_id"), F.col("tx").alias("f_tx"), "fps")
    joined = docs.join(back, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("tx") == F.col("f_tx")))
    rows = hashed(joined.select("doc_id", "tx", "fps", words(F.col("text")).alias("w")).dropDuplicates(["doc_id", "tx"]))
    placed = with_grams(with_grams(rows, "grams", gram), "code", n).withColumn("w", lowered(F.col("w")))
    marked = placed.withColumn("hit", F.transform("grams", lambda g: F.array_contains("fps", g)))
    near = with_widened(marked, "near", "hit", reach + 1, lambda x, y: x | y) if reach else marked.withColumn("near", F.col("hit"))
    # Place k of ``near`` tells of the grams at places k to k + reach, all those of the window that starts there.
    each = F.transform("code", lambda c, k: F.struct(k.alias("start"), c.alias("code"), F.get("near", k).alias("ok")))
    at = F.transform(F.filter(each, lambda m: m["ok"]), lambda m: F.struct(m["start"].alias("start"), m["code"].alias("code"), F.slice("w", m["start"] + 1, n).alias("window")))
    return near.select("doc_id", "tx", F.explode_outer(at).alias("m")).select("doc_id", "tx", "m.*", F.lit(n).alias("n"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, tx, n_words, n_hit, n_items, items_sha256, contaminated)`` per row; ``tx`` is a hash of the text."""
    docs = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tx")
    )
    items = benchmark_items(benchmark, item_col, item_text_col)
    windows = windows_of(items)
    worded = docs.withColumn("w", words(F.col("text")))

    marks = with_kept(hashed(items.where(F.size("w") >= WINDOW))).select(F.explode_outer("kept").alias("fp")).distinct()
    found = matching_documents(with_kept(hashed(worded)), "kept", marks)
    places = found_windows(docs, found, GRAM, WINDOW, WINDOW - GRAM)

    short = items.where(F.size("w") < WINDOW)
    sizes = sorted(r["n"] for r in short.select(F.size("w").alias("n")).distinct().collect())  # 12 at most
    if sizes:
        starts = with_grams(hashed(short), "grams", sizes[0]).select(F.element_at("grams", 1).alias("fp")).distinct()
        again = with_grams(hashed(worded), "grams", sizes[0]).withColumn("grams", F.array_distinct("grams"))
        found = materialised(matching_documents(again, "grams", starts), "winnow-short")
        for n in sizes:
            places = places.unionByName(found_windows(docs, found, sizes[0], n, 0))

    spans = places.join(windows.drop("ids"), ["code", "n", "window"]).select(
        "doc_id", "tx", "start", (F.col("start") + F.col("n")).alias("stop"), "win"
    )
    spans = materialised(spans, "winnow-spans")
    # Union length of the spans of a document: the longest span per start, then a running end.
    longest = spans.groupBy("doc_id", "tx", "start").agg(F.max("stop").alias("stop"))
    earlier = Window.partitionBy("doc_id", "tx").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(earlier), F.lit(0))))
    hit = longest.withColumn("new", new).groupBy("doc_id", "tx").agg(F.sum("new").alias("n_hit"))
    named = (
        spans.select("doc_id", "tx", "win")
        .distinct()
        .join(windows.select("win", "ids"), "win")
        .select("doc_id", "tx", F.explode("ids").alias("item_id"))
        .distinct()
        .groupBy("doc_id", "tx")
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )

    def keyed(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumnRenamed("doc_id", f"{tag}_id").withColumnRenamed("tx", f"{tag}_tx")

    def on(tag: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(f"{tag}_id")) & (F.col("tx") == F.col(f"{tag}_tx"))

    counted = docs.select(
        "doc_id", "tx", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_RAW)), F.lit(0)).cast("bigint").alias("n_words")
    )
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return counted.join(keyed(hit, "a"), on("a"), "left").join(keyed(named, "b"), on("b"), "left").select(
        "doc_id",
        "tx",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def op3(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tx")


def drop_contaminated(spark, docs, sf_dir):
    """Pipeline stage: contaminated documents go; all columns stay."""
    c_id, c_tx = free_names(docs, "c_id", "c_tx")
    verdict = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(
        F.col("doc_id").alias(c_id), F.col("tx").alias(c_tx)
    )
    same = F.col("doc_id").eqNullSafe(F.col(c_id)) & (F.xxhash64(F.col("text")) == F.col(c_tx))
    return docs.join(verdict.distinct(), same, "left_anti")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS g FROM (
    SELECT item_id, list_slice(w, p, p + least(13, len(w)) - 1) AS g FROM (
      SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0))),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN ns ON len(w) >= n)),
m AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
