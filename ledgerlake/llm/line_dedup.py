"""Lines that many documents share, found and dropped by keep bitmaps.

A line's key is the line without white space at its ends, A-Z in lower case;
each different key of a document becomes one narrow row: a 128-bit hash of the
key, the document, the positions of its lines. The rows are range-partitioned
by hash, document and position and sorted so inside each range; one pass streams every
range, counts the first occurrences of a key (one per document), and sends
back the rows of keys that enough documents hold. Per document these become a
compressed bitmap of the lines that stay; the text itself meets only its own
bitmap.

Scale: the splitters of the ranges are sampled from hash *and* document, so a
line that a third of all documents hold is cut over as many ranges as its rows
fill. A run of one key that touches the end of a range is settled afterwards
from the counts of its pieces (two a range at most), so no task ever sees a
whole hot run. A range holds back fewer rows of a run than ``min_docs``. Copies of one row
(same id and text) share a bitmap. The bitmaps are joined with the texts by
Spark's own choice: broadcast when their measured size allows, else by a
shuffle.

Defined results: a null or empty text is one empty line, which has no key and
stays (a null text stays null); every row is a document of its own, also if it
repeats an id or a text, or has no id; keys count once per row however often
the row repeats them; other columns are kept as they are, names of columns
that the operator needs inside give way to theirs; an empty table gives an
empty result. Line ends are ``\\n`` only.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, free_names, materialised, table, utf8

#: Fixed value: white space at the ends of a line, x20 and x09 to x0D.
WHITE = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1

LINES = pa.schema([
    ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("key", pa.binary()),
    ("first", pa.int32()), ("more", pa.binary()), ("n_lines", pa.int32()),
])
LINES_DDL = "h1 bigint, h2 bigint, doc bigint, key binary, first int, more binary, n_lines int"
#: kind 0: a row of a settled key; 1: a row that waits for the count; 2: a run's count in this range.
FOUND_DDL = "kind int, h1 bigint, h2 bigint, range int, head boolean, n bigint, key binary, first int, more binary, n_lines int"
FOUND = pa.schema([
    ("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("range", pa.int32()), ("head", pa.bool_()), ("n", pa.int64()),
    ("key", pa.binary()), ("first", pa.int32()), ("more", pa.binary()), ("n_lines", pa.int32()),
])
BITMAPS = pa.schema([("key", pa.binary()), ("n_lines", pa.int32()), ("n_dropped", pa.int32()), ("keep", pa.binary())])
BITMAPS_DDL = "key binary, n_lines int, n_dropped int, keep binary"


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line; empty for lines of white space."""
    return [line.strip(WHITE) for line in text.lower().split(b"\n")]


def document_key(id_col: str, text_col: str):
    """16 bytes that name a row by its id and text."""
    named = F.concat(F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).cast("binary"), F.lit(b"\0"), utf8(F.col(text_col)))
    return F.unhex(F.substring(F.sha2(named, 256), 1, 32))


def key_rows(min_chars: int):
    """One row per document and different key."""

    def run(batches):
        for batch in batches:
            docs, keys = batch.column("doc"), batch.column("key")
            digests: list[bytes] = []
            at, first, more, lines = [], [], [], []

            def flush():
                hashes = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
                rows = pa.array(at, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), docs.take(rows), keys.take(rows),
                     pa.array(first, pa.int32()), pa.array(more, pa.binary()), pa.array(lines, pa.int32())],
                    schema=LINES,
                )

            for row, body in enumerate(batch.column("body")):
                own = line_keys(body.as_py())
                places: dict[bytes, object] = {}
                for k, line in enumerate(own):
                    if not line or (min_chars > 1 and len(line.decode("utf-8", "replace")) < min_chars):
                        continue
                    had = places.get(line)
                    if had is None:
                        places[line] = k
                    elif isinstance(had, int):
                        places[line] = [had, k]
                    else:
                        had.append(k)
                for line, had in places.items():
                    digests.append(hashlib.blake2b(line, digest_size=16).digest())
                    at.append(row)
                    first.append(had if isinstance(had, int) else had[0])
                    more.append(None if isinstance(had, int) else np.array(had[1:], "<i4").tobytes())
                    lines.append(len(own))
                if len(at) >= 100_000:
                    yield flush()
                    for x in (digests, at, first, more, lines):
                        x.clear()
            if at:
                yield flush()

    return run


def stream_runs(min_docs: int, keep_first: bool):
    """Over one sorted range: rows of keys that ``min_docs`` documents hold, and what the ends of the range leave open."""

    def emit(kind: int, rows: pa.Table, here: int, head: np.ndarray, counts=None) -> pa.RecordBatch:
        n = rows.num_rows
        columns = {
            "kind": pa.array(np.full(n, kind, np.int32)), "range": pa.array(np.full(n, here, np.int32)), "head": pa.array(head),
            "n": pa.nulls(n, pa.int64()) if counts is None else pa.array(counts, pa.int64()),
        }
        rows = rows.combine_chunks()
        cut = [columns[f.name] if f.name in columns else rows.column(f.name).combine_chunks() for f in FOUND]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cut], schema=FOUND)

    def run(batches):
        here = TaskContext.get().partitionId()
        held = None  # rows of the last run, fewer than min_docs
        settled = None  # (h1, h2, count) of the last run, once it has enough
        opening = None  # the range's first run, while it lasts: (h1, h2)
        started = False

        def count_row(h1, h2, n):
            blank = pa.Table.from_pydict({f.name: pa.nulls(1, f.type) for f in LINES}, schema=LINES)
            blank = blank.set_column(0, "h1", pa.array([h1], pa.int64())).set_column(1, "h2", pa.array([h2], pa.int64()))
            return emit(2, blank, here, np.zeros(1, bool), [n])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows, held = pa.concat_tables([held, rows]), None
            h1, h2 = rows.column("h1").to_numpy(), rows.column("h2").to_numpy()
            if not started:
                started, opening = True, (h1[0], h2[0])
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            sizes = np.diff(starts, append=len(h1))
            enough = sizes >= min_docs
            heads = np.zeros(len(h1), bool)
            heads[starts] = True
            more = settled is not None and settled[:2] == (h1[0], h2[0])
            if settled is not None and not more:
                if settled[:2] == opening:
                    yield count_row(*settled)
                settled = None
            if more:  # the run goes on from the batch before
                enough[0], heads[0] = True, False
            mask = np.repeat(enough, sizes)
            wait = np.zeros(len(h1), bool)
            if opening == (h1[0], h2[0]):
                if not enough[0] and len(starts) > 1:  # it ended here without enough: the range before may have the rest
                    wait[: sizes[0]] = True
                    yield count_row(h1[0], h2[0], int(sizes[0]))
                elif enough[0] and keep_first and heads[0]:
                    wait[0], mask[0] = True, False
                if enough[0] and len(starts) > 1:
                    yield count_row(h1[0], h2[0], int(sizes[0]) + (settled[2] if more else 0))
            if wait.any():
                yield emit(1, rows.filter(pa.array(wait)), here, heads[wait])
            if mask.any():
                yield emit(0, rows.filter(pa.array(mask)), here, heads[mask])
            last = starts[-1]
            if enough[-1]:
                before = settled[2] if more and len(starts) == 1 else 0
                settled = (h1[last], h2[last], int(sizes[-1]) + before)
            else:
                held, settled = rows.slice(last), None
        if settled is not None:
            yield count_row(*settled)
        if held is not None:
            yield emit(1, held, here, np.arange(held.num_rows) == 0)
            yield count_row(held.column("h1")[0].as_py(), held.column("h2")[0].as_py(), held.num_rows)

    return run


def bitmap_rows(batches):
    """``(key, n_lines, n_dropped, keep)`` from the dropped lines of each document."""
    for batch in batches:
        n_lines, dropped, keep = [], [], []
        for size, rows in zip(batch.column("n_lines").to_pylist(), batch.column("rows").to_pylist()):
            stay = np.ones(size, np.uint8)
            for r in rows:
                if not r["spare"]:
                    stay[r["first"]] = 0
                if r["more"]:
                    stay[np.frombuffer(r["more"], "<i4")] = 0
            n_lines.append(size)
            dropped.append(int(size - stay.sum()))
            keep.append(zlib.compress(np.packbits(stay, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(n_lines, pa.int32()), pa.array(dropped, pa.int32()), pa.array(keep, pa.binary())], schema=BITMAPS
        )


def line_keep_bitmaps(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """``(key, n_lines, n_dropped, keep)`` of every document that loses lines:
    those whose key at least ``min_docs`` documents hold. ``keep_first`` spares
    the key's first line, in the order of ids and positions. ``keep`` is a
    zlib-compressed bitmap, lowest bit first, 1 for lines that stay; ``key`` is
    :func:`document_key`."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("bigint").alias("doc"), document_key(id_col, text_col).alias("key"), utf8(F.col(text_col)).alias("body"))
    rows = scratch.table(own.mapInArrow(key_rows(min_chars), LINES_DDL), "line-keys")
    order = ["h1", "h2", "doc", "key", "first"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.table(ranges.mapInArrow(stream_runs(min_docs, keep_first), FOUND_DDL), "line-runs")
    pieces = found.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min("range").alias("origin"))
    pending = found.where("kind = 1").join(pieces.where(F.col("total") >= min_docs), ["h1", "h2"])
    spare = F.lit(keep_first)
    lost = found.where("kind = 0").select("key", "n_lines", "first", "more", (F.col("head") & spare).alias("spare")).unionByName(
        pending.select("key", "n_lines", "first", "more", (F.col("head") & spare & (F.col("range") == F.col("origin"))).alias("spare"))
    )
    # Equal rows share a key; under keep_first the first of them spares its line for all of them.
    grouped = lost.groupBy("key").agg(F.first("n_lines").alias("n_lines"), F.collect_set(F.struct("first", "more", "spare")).alias("rows"))
    bitmaps = grouped.select("key", "n_lines", _unspared("rows").alias("rows")).mapInArrow(bitmap_rows, BITMAPS_DDL)
    result = materialised(bitmaps, "line-bitmaps")
    scratch.clear()
    return result


def _unspared(rows: str):
    """A line that one of several equal rows spares is not dropped by the others."""
    spared = F.transform(F.filter(rows, lambda r: r["spare"]), lambda r: r["first"])
    return F.transform(rows, lambda r: F.struct(r["first"].alias("first"), r["more"].alias("more"), F.array_contains(spared, r["first"]).alias("spare")))


def kept_lines(text: bytes, keep: bytes | None) -> bytes:
    if keep is None:
        return text
    lines = text.split(b"\n")
    stay = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
    return b"\n".join([line for line, s in zip(lines, stay.tolist()) if s])


def drop_shared_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with shared lines taken out of its texts, plus ``n_lines`` (before)
    and ``n_dropped``; columns of these names get underscores, see :func:`free_names`."""
    bitmaps = line_keep_bitmaps(docs, id_col=id_col, text_col=text_col, **rule)
    key, b_key, keep, n_lines, n_dropped = free_names(docs, "key", "b_key", "keep", "n_lines", "n_dropped")
    marks = bitmaps.select(F.col("key").alias(b_key), F.col("keep").alias(keep), F.col("n_dropped").alias(n_dropped))
    joined = docs.withColumn(key, document_key(id_col, text_col)).join(marks, F.col(key) == F.col(b_key), "left").drop(key, b_key)
    counts = joined.withColumn(n_lines, (F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")) + 1).cast("bigint"))
    whole = counts.withColumn(n_dropped, F.coalesce(F.col(n_dropped), F.lit(0)).cast("bigint"))
    place = whole.columns.index(text_col)

    def run(batches):
        for batch in batches:
            marked = batch.column(keep)
            if marked.null_count < len(marked):
                texts = batch.column(text_col).to_pylist()
                for row, bits in enumerate(marked.to_pylist()):
                    if bits is not None:
                        texts[row] = kept_lines(texts[row].encode(), bits).decode()
                batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            yield batch

    return whole.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in whole.schema])).drop(keep)


def op11(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = drop_shared_lines(documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT r, p, lines[p] AS line, translate(trim(lines[p], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS p FROM d)),
hot AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
m AS (SELECT l.*, hot.k IS NOT NULL AS gone FROM l LEFT JOIN hot USING (k)),
s AS (SELECT r, count(*) AS n_lines, count_if(gone) AS n_dropped, string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone) AS kept FROM m GROUP BY r)
SELECT d.doc_id, CAST(s.n_lines AS BIGINT) AS n_lines, CAST(s.n_dropped AS BIGINT) AS n_dropped, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d JOIN s USING (r)
"""
