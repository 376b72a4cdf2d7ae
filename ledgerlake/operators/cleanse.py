"""Bronze -> silver cleansing and quarantine, driven by one specification per feed.

A :class:`Feed` states what a feed's rows must have (mandatory columns), how
raw texts become typed columns, the rules a typed row must meet, the key of
which the newest row stays, and the condition for quarantine. One routine
(:func:`silver`) applies any of them: a projection, one filter over all rules
and one aggregate. :func:`audit` runs the same rules to name the first one a
row fails.

Quarantine and silver do not partition the bronze rows: rows whose amount,
date or timestamp does not parse, minors, future openings, negative durations
and dedup losers leave silver without entering quarantine.

No function does I/O. ``as_of`` stands for the processing time (the clock when
omitted), so that results are reproducible in tests.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions import flags, parsing
from ..functions.columns import mask_email

TXN_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SESSION_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _as_of_ts(as_of: str | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def _as_of_date(as_of: str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.to_date(F.lit(as_of).cast("timestamp_ntz"))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``newest_first`` (then by the
    remaining columns, so ties resolve deterministically).

    Written as an aggregate, not ``row_number``: the partial aggregate
    collapses copies map-side, so a key with millions of copies never reaches
    one task whole. The maximum is over one struct that begins with the order
    columns and holds all the others, so a row moves once.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [c for c in newest_first if c not in keys] + [c for c in others if c not in newest_first]
    if not order:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__latest"))
    return picked.select(*[c if c in keys else F.col("__latest").getField(c).alias(c) for c in df.columns])


def split_by_rules(df: DataFrame, rules: Sequence[tuple[str, Column]], reason: str = "failed_rule") -> DataFrame:
    """Tag each row with the name of the first rule it fails (NULL = passes).

    A rule whose condition is NULL counts as failed.
    """
    expr = None
    for name, ok in rules:
        bad = ~F.coalesce(ok, F.lit(False))
        expr = F.when(bad, F.lit(name)) if expr is None else expr.when(bad, F.lit(name))
    return df.withColumn(reason, expr)


Columns = dict[str, Column]


@dataclass(frozen=True)
class Moment:
    """What a specification may depend on besides the row."""

    as_of: str | None
    t: Thresholds

    @property
    def now(self) -> Column:
        return _as_of_ts(self.as_of)

    @property
    def today(self) -> Column:
        return _as_of_date(self.as_of)


@dataclass(frozen=True)
class Feed:
    """Specification of one feed. ``typed`` sees the raw columns, ``derived``
    and ``rules`` the typed ones, ``flagged`` the surviving rows."""

    needed: tuple[str, ...]
    mandatory: tuple[str, ...]
    key: str
    newest: str
    typed: Callable[[Moment], Columns]
    derived: Callable[[Moment], Columns]
    rules: Callable[[Moment], dict[str, Column]]
    quarantined: Callable[[], Column]
    reason: str
    flagged: Callable[[Moment], Columns] = lambda m: {}
    dropped: tuple[str, ...] = ()


def _any_null(*names: str) -> Column:
    return F.greatest(*[F.col(n).isNull() for n in names])


def _known(*names: str) -> Columns:
    """Missing place names and categories read UNKNOWN."""
    return {n: F.coalesce(F.col(n), F.lit("UNKNOWN")) for n in names}


def _each(function: Callable[[Column], Column], *names: str) -> Columns:
    return {n: function(F.col(n)) for n in names}


def _typed_rows(bronze: DataFrame, feed: Feed, moment: Moment) -> DataFrame:
    return bronze.withColumns(feed.typed(moment)).withColumns({**feed.derived(moment), "ingest_timestamp": moment.now})


def silver(bronze: DataFrame, feed: Feed, as_of: str | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    require_columns(bronze, feed.needed)
    moment = Moment(as_of, t)
    rows = _typed_rows(bronze.dropna(subset=list(feed.mandatory)), feed, moment)
    for ok in feed.rules(moment).values():
        rows = rows.filter(ok)
    rows = latest_per_key(rows.drop(*feed.dropped), [feed.key], [feed.newest])
    flagged = feed.flagged(moment)
    return rows.withColumns(flagged) if flagged else rows


def quarantine(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Works on a batch or a streaming DataFrame (stateless filter)."""
    return bronze.filter(feed.quarantined()).withColumn("error_reason", F.lit(feed.reason))


def audit(bronze: DataFrame, feed: Feed, as_of: str | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    """Every bronze row, typed, with the name of the first rule it fails (NULL: none)."""
    moment = Moment(as_of, t)
    present = {n: f"__had_{n}" for n in feed.mandatory}
    rows = _typed_rows(bronze.withColumns({f: F.col(n).isNotNull() for n, f in present.items()}), feed, moment)
    rules = [(f"{n} missing", F.col(f)) for n, f in present.items()] + list(feed.rules(moment).items())
    return split_by_rules(rows, rules).drop(*present.values())


_TXN_PLACES = ("location_country", "location_city", "merchant_category")
_TXN_CODES = ("txn_type", "channel", "status")

TRANSACTIONS = Feed(
    needed=("txn_id", "account_id", "customer_id", "amount", "currency", "txn_timestamp", "from_account", "to_account",
            "merchant_id", *_TXN_PLACES, *_TXN_CODES),
    mandatory=("txn_id", "account_id", "customer_id"),
    key="txn_id",
    newest="txn_timestamp",
    typed=lambda m: {
        **_known(*_TXN_PLACES),
        **_each(F.upper, *_TXN_CODES),
        "txn_timestamp": parsing.to_wall_timestamp(F.col("txn_timestamp"), TXN_TS_FORMAT),
        "amount": parsing.to_decimal(F.col("amount")),
    },
    derived=lambda m: {"normalised_amount": flags.normalised_amount(F.col("amount"), F.col("currency"), m.t)},
    rules=lambda m: {"amount not positive": F.col("amount") > 0, "txn_timestamp unreadable": F.col("txn_timestamp").isNotNull()},
    flagged=lambda m: {
        "account_match_flag": flags.account_match_flag(F.col("txn_type"), F.col("account_id"), F.col("from_account")),
        "txn_validation_flag": flags.validation_flag(
            F.col("txn_type"), F.col("from_account"), F.col("to_account"), F.col("merchant_id")
        ),
    },
    quarantined=lambda: _any_null("txn_id", "account_id", "customer_id") | (parsing.to_decimal(F.col("amount")) <= 0),
    reason="Invalid transaction data",
    dropped=("location_lat", "location_lon"),
)

CUSTOMERS = Feed(
    needed=("customer_id", "account_id", "email", "account_balance", "date_of_birth", "account_opening_date",
            "kyc_status", "account_type", "home_country", "home_city"),
    mandatory=("customer_id", "account_id", "email"),
    key="account_id",
    newest="account_opening_date",
    typed=lambda m: {
        **_each(parsing.to_date, "date_of_birth", "account_opening_date"),
        **_each(F.upper, "kyc_status", "account_type"),
        **_each(F.initcap, "home_country", "home_city"),
        "account_balance": parsing.to_double(F.col("account_balance")),
        "email": mask_email(F.col("email")),
    },
    derived=lambda m: {"age": F.floor(F.datediff(m.today, F.col("date_of_birth")) / 365)},  # 365-day years
    rules=lambda m: {
        "account_balance unreadable": F.col("account_balance").isNotNull(),
        "minor or date_of_birth unreadable": F.col("age") >= m.t.minimum_age,
        "account_opening_date unreadable or not past": F.col("account_opening_date") < m.today,
    },
    quarantined=lambda: _any_null("customer_id", "account_id", "email", "account_balance"),
    reason="Invalid mandatory fields",
    dropped=("phone",),
)

SESSIONS = Feed(
    needed=("session_id", "customer_id", "device_id", "location_country", "location_city", "device_type",
            "is_new_device", "is_new_location", "login_timestamp", "logout_timestamp"),
    mandatory=("session_id", "customer_id", "device_id"),
    key="session_id",
    newest="login_timestamp",
    typed=lambda m: {
        **{n: F.initcap(c) for n, c in _known("location_country", "location_city").items()},
        **_each(lambda c: parsing.to_wall_timestamp(c, SESSION_TS_FORMAT), "login_timestamp", "logout_timestamp"),
        **_each(parsing.to_boolean, "is_new_device", "is_new_location"),
        "device_type": F.upper("device_type"),
    },
    derived=lambda m: {
        "session_duration_seconds": parsing.epoch_seconds(F.col("logout_timestamp")) - parsing.epoch_seconds(F.col("login_timestamp"))
    },
    rules=lambda m: {"times unreadable or logout before login": F.col("session_duration_seconds") >= 0},
    quarantined=lambda: _any_null("session_id", "customer_id", "device_id"),
    reason="Invalid session data",
    dropped=("browser", "os"),
)


def quarantine_transactions(bronze: DataFrame) -> DataFrame:
    return quarantine(bronze, TRANSACTIONS)


def quarantine_customers(bronze: DataFrame) -> DataFrame:
    return quarantine(bronze, CUSTOMERS)


def quarantine_sessions(bronze: DataFrame) -> DataFrame:
    return quarantine(bronze, SESSIONS)


def silver_transactions(bronze: DataFrame, as_of: str | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    return silver(bronze, TRANSACTIONS, as_of, t)


def silver_customers(bronze: DataFrame, as_of: str | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    return silver(bronze, CUSTOMERS, as_of, t)


def silver_sessions(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    return silver(bronze, SESSIONS, as_of)
