"""Gold ``fact_transactions``: current transactions joined to current
customers, with null rules, flags and the per-customer sequence features.

Physical shape (see ``explain``): the transaction rows are hash-partitioned
once on ``(customer_id, __seg)``; the customer attributes are joined after
that, expanded to the transactions' (customer, account, segment) keys and
shuffled to the same partitioning, so a customer table too big to broadcast
costs a customer-sized shuffle, not a second shuffle of the fact. ``__seg`` is a
one-minute slice of time for hot customers (the largest, found by a cheap
count and a bounded top-k) and a single constant segment for everyone else. Every window below is
partitioned by a superset of those columns and every summary is joined back
on a superset of them, so no further exchange of the fact rows is needed.
A task holds its rows once for each order they are sorted in, so joins share
the order of a window where they can: four sorts (account, time, payee, address).
Summaries (per customer-segment-day, customer-payee-segment,
customer-ip-segment and customer-second) are the only other data that moves,
each combined map-side before its shuffle; for unsplit customers the first
three collapse to customer-day / customer-payee / customer-ip level. A
customer holding a third of all rows is spread over as many tasks as it has
active minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions.columns import upper_or
from ..functions.flags import as_flag
from .sequence import previous_by_segment, trailing_sum

ORDER = ["txn_timestamp", "txn_id"]  # tie-break on txn_id: lag/row_number are deterministic

CUSTOMER_COLUMNS = [
    "customer_id",
    "account_id",
    "account_type",
    "account_balance",
    "kyc_status",
    "home_country",
    "home_city",
]

FACT_COLUMNS = [
    "txn_id", "customer_id", "account_id", "device_id",
    "txn_timestamp", "txn_date", "txn_hour", "txn_type", "amount", "channel", "status",
    "from_account", "to_account",
    "account_type", "account_balance", "kyc_status",
    "ip_address", "home_country", "home_city", "location_country", "location_city",
    "high_amount_flag", "night_indicator", "geo_mismatch_flag", "txn_gap_minutes",
    "new_beneficiary_flag", "daily_txn_count", "daily_total_amount", "daily_unique_beneficiaries",
    "rolling_7day_amount", "previous_ip_city", "previous_ip_country",
]


SPLIT = ["customer_id", "__seg"]  # the one hash partitioning of the fact rows


UNSPLIT = -(2**63)  # segment of every customer that is not split (no time slice has it)


def split_rows():
    """Rows of hot customers (everyone else is in segment :data:`UNSPLIT`)."""
    return F.col("__seg") != F.lit(UNSPLIT)


def join_customers(base: DataFrame, rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join of the (already split) fact rows to customers on
    (customer_id, account_id), without moving the fact rows again.

    The customer attributes are expanded to the distinct (customer, account,
    segment) keys of the transactions (customer-sized: one segment per
    unsplit customer) and shuffled to the fact's partitioning, so the join
    is co-partitioned whether or not the customer table is small enough to
    broadcast.
    """
    keys = ["customer_id", "account_id", "__seg"]
    per_segment = rows.select(*keys).distinct().join(
        customers.select(*CUSTOMER_COLUMNS), ["customer_id", "account_id"], "inner"
    )
    return base.join(per_segment.repartition(*SPLIT).hint("merge"), keys, "left")


def apply_txn_null_rules(df: DataFrame) -> DataFrame:
    """Transaction-side defaults and overrides: upper-cased codes with
    UNKNOWN, CREDIT/DEPOSIT come from EXTERNAL_SOURCE, WITHDRAWAL/DEBIT go to
    CASH_OR_MERCHANT, remaining NULL accounts/locations -> UNKNOWN, IP ->
    UNKNOWN_IP."""
    df = (
        df.withColumn("txn_type", upper_or(F.col("txn_type"), "UNKNOWN"))
        .withColumn("channel", upper_or(F.col("channel"), "UNKNOWN"))
        .withColumn("status", upper_or(F.col("status"), "UNKNOWN"))
    )
    df = df.withColumn(
        "from_account",
        F.when(F.col("txn_type").isin("CREDIT", "DEPOSIT"), F.lit("EXTERNAL_SOURCE")).otherwise(F.col("from_account")),
    ).withColumn(
        "to_account",
        F.when(F.col("txn_type").isin("WITHDRAWAL", "DEBIT"), F.lit("CASH_OR_MERCHANT")).otherwise(F.col("to_account")),
    )
    return df.fillna(
        {
            "from_account": "UNKNOWN",
            "to_account": "UNKNOWN",
            "location_country": "UNKNOWN",
            "location_city": "UNKNOWN",
            "ip_address": "UNKNOWN_IP",
        }
    )


def apply_customer_null_rules(df: DataFrame) -> DataFrame:
    """Customer-side defaults after the left join (KYC: MINIMAL)."""
    return (
        df.withColumn("kyc_status", upper_or(F.col("kyc_status"), "MINIMAL"))
        .withColumn("account_type", upper_or(F.col("account_type"), "UNKNOWN"))
        .fillna({"home_country": "UNKNOWN", "home_city": "UNKNOWN"})
    )


SEGMENT_SECONDS = 60  # time slice of a hot customer's row-level window groups
HOT_KEYS = 100_000  # at most this many customers are split (a bounded broadcast)
HOT_MIN_ROWS = 1_000_000  # ... and only customers with at least this many rows


def hot_customers(rows: DataFrame, hot_keys: int = HOT_KEYS, hot_min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """The customers whose rows are split by time: the ``hot_keys`` largest
    with at least ``hot_min_rows`` rows. Counting is a partial aggregate; the
    top-k is taken per partition and merged, so the result has at most
    ``hot_keys`` rows. Any customer left out holds at most N / (hot_keys + 1)
    of the N rows (otherwise more than ``hot_keys`` customers would each
    hold more), so every unsplit group is bounded too."""
    counts = rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("__rows"))
    return (
        counts.filter(F.col("__rows") >= hot_min_rows)
        .orderBy(F.col("__rows").desc(), F.col("customer_id"))
        .limit(hot_keys)
        .select("customer_id")
    )


def add_time_columns(
    df: DataFrame,
    segment_seconds: int = SEGMENT_SECONDS,
    hot_keys: int = HOT_KEYS,
    hot_min_rows: int = HOT_MIN_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """txn_date, txn_hour, whole epoch seconds ``__s`` and the segment index
    ``__seg`` (internal): the time slice for hot customers, :data:`UNSPLIT`
    (one segment holding all rows) for everyone else. ``hot`` is a precomputed
    :func:`hot_customers` table (e.g. materialised once per run); when
    omitted it is computed from ``df``."""
    df = (
        df.withColumn("txn_date", F.to_date("txn_timestamp"))
        .withColumn("txn_hour", F.hour("txn_timestamp"))
        .withColumn("__s", F.unix_timestamp("txn_timestamp"))
    )
    # The hot list has at most ``hot_keys`` rows: a broadcast of proven size.
    if hot is None:
        hot = hot_customers(df, hot_keys, hot_min_rows)
    df = df.join(F.broadcast(hot.select("customer_id", F.lit(True).alias("__hot"))), "customer_id", "left")
    seg = F.when(F.col("__hot"), F.floor(F.col("__s") / F.lit(segment_seconds))).otherwise(F.lit(UNSPLIT))
    return df.withColumn("__seg", seg.cast("bigint")).drop("__hot")


def add_row_flags(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """night / high-amount / geo-mismatch flags."""
    return (
        df.withColumn("night_indicator", as_flag(F.col("txn_hour").between(t.night_start_hour, t.night_end_hour)))
        .withColumn("high_amount_flag", as_flag(F.col("amount") >= t.high_amount))
        .withColumn("geo_mismatch_flag", as_flag(F.col("home_country") != F.col("location_country")))
    )


def add_sequence_features(
    df: DataFrame, rows: DataFrame | None = None, t: Thresholds = DEFAULT, split_done: bool = False
) -> DataFrame:
    """Velocity gap, new-beneficiary flag, daily totals, rolling 7-day sum and
    same-IP previous location.

    ``df`` needs the columns of :func:`add_time_columns`. ``rows`` (the same
    transactions before any join, default ``df``) feeds the summaries: each
    is a partial aggregate over ``rows`` shuffled on its own keys, so a hot
    customer is combined map-side before anything moves. ``split_done``: ``df``
    is already hash-partitioned on :data:`SPLIT`.
    """
    split = SPLIT
    base = df if split_done else df.repartition(*split)
    rows = df if rows is None else rows

    # Per customer-segment-day summary: row count, amount and last timestamp.
    # Daily count/total are window sums over the segments of a day (at most
    # 1440 rows for one-minute segments); the previous segment's last
    # timestamp is a lag over one row per active segment (and day: an unsplit
    # customer is one segment spanning days, whose first row needs no carry).
    per_seg = rows.groupBy("customer_id", "txn_date", "__seg").agg(
        F.count("txn_id").alias("__n"),
        F.sum("amount").alias("__amt"),
        F.max("txn_timestamp").alias("__last"),
    )
    day = Window.partitionBy("customer_id", "txn_date")
    per_seg = per_seg.select(
        "customer_id",
        "txn_date",
        "__seg",
        F.sum("__n").over(day).alias("daily_txn_count"),
        F.sum("__amt").over(day).cast("decimal(28,2)").alias("daily_total_amount"),
        F.lag("__last").over(Window.partitionBy("customer_id").orderBy("__seg", "txn_date")).alias("__prev_seg_last"),
    )
    # Distinct payees per day: Spark plans a partial distinct aggregate.
    payees = rows.groupBy("customer_id", "txn_date").agg(
        F.countDistinct("to_account").alias("daily_unique_beneficiaries")
    )
    per_seg = per_seg.join(payees, ["customer_id", "txn_date"], "left")

    # Rolling 7 days: RANGE [s - span, s] over whole seconds, peers included.
    # The day's summary goes onto these narrow rows, so that both reach the fact
    # rows in one join, whose keys begin the order of the lag below: one sort.
    rolling = trailing_sum(
        rows, ["customer_id"], "__s", "amount", t.rolling_window_seconds, "rolling_7day_amount", carry_cols=["__seg", "txn_date"]
    )
    by_day = ["customer_id", "__seg", "txn_date"]
    summary = rolling.repartition(*split).join(per_seg.repartition(*split).hint("merge"), by_day, "left")

    # Gap to the customer's previous transaction (minutes, whole seconds):
    # inside the segment by lag, for its first row from the previous segment.
    in_seg = Window.partitionBy("customer_id", "__seg").orderBy("txn_date", "__s", *ORDER)
    out = base.withColumn("__prev", F.lag("txn_timestamp").over(in_seg))
    out = out.join(summary.hint("merge"), [*by_day, "__s"], "left").withColumn(
        "rolling_7day_amount", F.col("rolling_7day_amount").cast("decimal(28,2)")
    )
    gap = (F.col("__s") - F.unix_timestamp(F.coalesce("__prev", "__prev_seg_last"))) / 60
    out = out.withColumn("txn_gap_minutes", F.coalesce(gap, F.lit(t.first_txn_gap_minutes))).drop("__prev", "__prev_seg_last")

    # New beneficiary: a TRANSFER whose previous row to the same to_account
    # (any type) is absent or more than N days earlier.
    out = previous_by_segment(
        out, ["customer_id", "to_account"], "__seg", ORDER, ["txn_timestamp"], "__ben_", summary_source=rows,
        partition_keys=split, summary_filter=split_rows(),
    )
    prev_ben = F.col("__ben_txn_timestamp")
    is_new = (F.col("txn_type") == "TRANSFER") & (
        prev_ben.isNull() | (F.datediff(F.col("txn_date"), F.to_date(prev_ben)) > t.new_beneficiary_days)
    )
    out = out.withColumn("new_beneficiary_flag", as_flag(is_new)).drop("__ben_txn_timestamp")

    # Previous location seen on the same IP, falling back to the current one.
    out = previous_by_segment(
        out,
        ["customer_id", "ip_address"],
        "__seg",
        ORDER,
        ["location_city", "location_country"],
        "__ip_",
        summary_source=rows,
        partition_keys=split,
        summary_filter=split_rows(),
    )
    out = out.withColumn("previous_ip_city", F.coalesce("__ip_location_city", "location_city")).withColumn(
        "previous_ip_country", F.coalesce("__ip_location_country", "location_country")
    )
    return out.drop("__ip_location_city", "__ip_location_country", "__s", "__seg")


def fact_transactions(
    txns: DataFrame,
    customers: DataFrame,
    t: Thresholds = DEFAULT,
    segment_seconds: int = SEGMENT_SECONDS,
    hot_keys: int = HOT_KEYS,
    hot_min_rows: int = HOT_MIN_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The 32-column transaction fact from current transactions and customers.

    ``segment_seconds`` sets the time slice that bounds the row-level window
    groups of hot customers (see :func:`hot_customers`); results do not
    depend on it, nor on which customers are split. It must divide a day, so
    that a split segment never straddles two dates."""
    if segment_seconds <= 0 or 86400 % segment_seconds:
        raise ValueError(f"segment_seconds must divide 86400, got {segment_seconds}")
    rows = add_time_columns(apply_txn_null_rules(txns), segment_seconds, hot_keys, hot_min_rows, hot)
    base = rows.repartition(*SPLIT)  # the only exchange of full fact rows
    df = apply_customer_null_rules(join_customers(base, rows, customers))
    df = add_row_flags(df, t)
    df = add_sequence_features(df, rows, t, split_done=True)
    return df.select(*FACT_COLUMNS)
