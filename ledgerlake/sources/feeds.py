"""CSV feeds: declared all-string schemas, batch and streaming reads with
file lineage and rescued records, and the CSV landing sink.

Bronze keeps every column as text (no inference): typing is the silver
layer's job, where unparseable values become NULL instead of failing a job.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import clean_columns, file_name_of

# Raw column lists of the three feeds (the bronze contract).
TRANSACTION_FIELDS = (
    "txn_id", "account_id", "customer_id", "txn_timestamp", "txn_type", "amount", "currency",
    "from_account", "to_account", "channel", "device_id", "ip_address", "location_country",
    "location_city", "location_lat", "location_lon", "merchant_id", "merchant_category", "status",
)
CUSTOMER_FIELDS = (
    "customer_id", "account_id", "customer_name", "email", "phone", "date_of_birth", "kyc_status",
    "home_country", "home_city", "account_opening_date", "account_type", "account_balance", "is_active",
)
SESSION_FIELDS = (
    "session_id", "customer_id", "device_id", "login_timestamp", "logout_timestamp", "ip_address",
    "location_country", "location_city", "device_type", "os", "browser", "is_new_device", "is_new_location",
)

# Columns the feeds carry besides: the sender's ingest time, and (transactions) text it could not place.
INGEST_TS = "_ingest_ts"
RESCUE_COLUMN = "_rescued_data"
RAW_RECORD = "__raw_record"


def landed_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The header of the files under ``path`` (one line is read)."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path).columns


def raw_schema(columns: Sequence[str], rescue: bool = False) -> StructType:
    """All-string schema; with ``rescue`` a trailing column receives the raw
    line of any record that does not fit (too many/few tokens)."""
    names = [*columns, RAW_RECORD] if rescue else list(columns)
    return StructType([StructField(n, StringType(), True) for n in names])


def by_name(df: DataFrame, fields: Sequence[str], rescue: bool) -> DataFrame:
    """The declared ``fields`` in their order, whatever the order of the file.

    A field the file lacks is NULL. With ``rescue`` what has no field of its
    own lands in the rescue column: the raw line of a record that does not fit
    the header, else the extra columns as JSON, else what the sender rescued.
    Without it, extra columns are left out.
    """
    have = set(df.columns)
    out = [F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields]
    if rescue:
        extra = [c for c in df.columns if c not in (*fields, RESCUE_COLUMN, RAW_RECORD)]
        parts = [F.col(RAW_RECORD)] if RAW_RECORD in have else []
        if extra:
            some = F.greatest(*[F.col(c).isNotNull() for c in extra]) if len(extra) > 1 else F.col(extra[0]).isNotNull()
            parts.append(F.when(some, F.to_json(F.struct(*extra))))
        if RESCUE_COLUMN in have:
            parts.append(F.col(RESCUE_COLUMN))
        out.append(F.coalesce(*parts, F.lit(None).cast("string")).alias(RESCUE_COLUMN))
    return df.select(*out, "_metadata")


def _csv_options(reader, schema: StructType, sep: str):
    reader = reader.schema(schema).option("header", True).option("sep", sep)
    if RAW_RECORD in schema.fieldNames():
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_RECORD)
    # Check every file's header against the schema: a file with another header
    # is an error instead of silently shifting values between columns.
    return reader.option("enforceSchema", False)


def read_csv_batch(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ",") -> DataFrame:
    """Batch CSV read with a header. Without a schema every column is text."""
    if schema is None:
        return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return _csv_options(spark.read, schema, sep).csv(path)


def read_csv_stream(spark: SparkSession, path: str, fields: Sequence[str], rescue: bool = False, sep: str = ",",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental directory stream: each new file is read exactly once (the
    query checkpoint records the files already seen). Columns are matched by
    the name in the header."""
    schema = raw_schema(landed_columns(spark, path, sep), rescue)
    reader = _csv_options(spark.readStream, schema, sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return by_name(reader.csv(path), [*fields, INGEST_TS], rescue)


# -- files whose headers differ ----------------------------------------------------------


def new_files(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """The files that land under ``path`` as a stream of ``(path)``, each once; their content is
    not read. The folder may be empty."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .select("path")
    )


def header_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of every file that has one: the line of the lowest number in the file's first split."""
    lines = spark.read.text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")
    )
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("line")).collect()  # one row a file of the batch
    jvm = spark._jvm
    return {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["file"])).toString(): r["line"] for r in first}


def header_columns(line: str, sep: str = ",") -> list[str]:
    """Column names of a header line; unnamed and repeated ones get a number."""
    names: list[str] = []
    taken: set[str] = set()
    for k, name in enumerate(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])):
        name = name or f"_c{k}"
        while name.lower() in taken:
            name = f"{name}_{k}"
        taken.add(name.lower())
        names.append(name)
    return names or ["_c0"]


def read_files(spark: SparkSession, files: Sequence[str], fields: Sequence[str], rescue: bool = False, sep: str = ",") -> DataFrame | None:
    """The rows of ``files``, each parsed by its own header and matched by name, see
    :func:`by_name`; None if no file has a line. Files of one layout are one scan."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(header_lines(spark, files).items()):
        layouts.setdefault(tuple(header_columns(line, sep)), []).append(file)
    out = None
    for columns, same in layouts.items():
        # The schema is the header itself, so there is nothing to check it against.
        reader = _csv_options(spark.read, raw_schema(columns, rescue), sep).option("enforceSchema", True)
        rows = by_name(reader.csv(same), [*fields, INGEST_TS], rescue)
        out = rows if out is None else out.unionByName(rows)
    return out


def no_rows(spark: SparkSession, path: str, fields: Sequence[str], rescue: bool = False) -> DataFrame:
    """The empty result of :func:`read_files`."""
    return by_name(spark.read.schema(raw_schema(fields, rescue)).csv(path), [*fields, INGEST_TS], rescue).limit(0)


def with_lineage(df: DataFrame, ingest_time=None) -> DataFrame:
    """Bronze shaping: expose the file metadata struct, clean column names
    (``_metadata`` -> ``metadata``, ``_rescued_data`` -> ``rescued_data``),
    add ``source_file``, ``file_name`` and ``ingest_timestamp``."""
    df = clean_columns(df if "_metadata" in df.columns else df.select("*", "_metadata"))
    return (
        df.withColumn("source_file", F.col("metadata.file_path"))
        .withColumn("file_name", file_name_of(F.col("metadata.file_path")))
        .withColumn("ingest_timestamp", F.current_timestamp() if ingest_time is None else ingest_time)
    )


def land_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "append") -> None:
    """Write a feed as header CSV files (NULL -> empty field)."""
    if files:
        df = df.repartition(files)
    df.write.mode(mode).option("header", True).csv(path)
