"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import ensure_checkpoint_dir, scratch_path

# The word patterns of the result contract.
WORD_WS = r"[^\x20\x09-\x0D]+"
WORD_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text; null counts as the empty text."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later steps
    read it instead of repeating it, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Folders of one operator run in the shared scratch folder, removed by
    :meth:`clear` once the operator's result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, name: str = "") -> None:
        """Remove the folders whose name starts with ``name`` (all by default)."""
        for path in [p for p in self.paths if p.rsplit("/", 1)[1].startswith(name)]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
            self.paths.remove(path)


def unique_ids(df: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` distinct non-null values of ``column``, chosen by a
    hash of the value (the same on every run), marked for a broadcast join:
    the limit bounds its size."""
    ids = df.where(F.col(column).isNotNull()).select(column).distinct()
    return F.broadcast(ids.orderBy(F.xxhash64(column), column).limit(limit))


def arrow_rows(make, schema):
    """A ``mapInArrow`` function from ``make(batch) -> dict of columns``."""
    import pyarrow as pa

    @functools.wraps(make)
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(make(batch), schema=schema)

    return run


__all__ = ["WORD_WS", "WORD_ALNUM", "table", "lower_ascii", "utf8", "free_names", "materialised", "Scratch", "unique_ids", "arrow_rows",
           "ensure_checkpoint_dir", "scratch_path"]
