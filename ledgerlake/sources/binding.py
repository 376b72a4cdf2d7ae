"""Map the driver's test tables onto the three bank feeds.

Only modulus and CASE are used (no hashes, no clock), so a SQL engine can
derive identical rows. All mappings read whole tables; output size grows
with the input.

Canonical (already clean, typed) entities feed the gold layer directly:
``transactions(events)``, ``customers(customer)``. Dirty all-string bronze
feeds (``bronze_*``) exercise cleansing, quarantine and dedup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of this binding (test-data mapping, not reference constants).
EVENT_TO_TXN_TYPE = (
    ("purchase", "DEBIT"),
    ("click", "TRANSFER"),
    ("view", "CREDIT"),
    ("signup", "DEPOSIT"),
    ("error", "WITHDRAWAL"),
)
CHANNELS_BY_MOD6 = ("ATM", "BRANCH", "UPI", "ONLINE", "POS", "MOBILE")
CURRENCIES_BY_MOD3 = ("INR", "USD", "EUR")
INDIA_CITIES_BY_MOD3 = ("Mumbai", "Delhi", "Pune")
CATEGORIES_BY_MOD7 = ("GROCERY", "ELECTRONICS", "TRAVEL", "DINING", "FUEL", "UTILITIES", "ENTERTAINMENT")
DEVICE_TYPES_BY_MOD4 = ("Mobile", "Laptop", "Tablet", "Desktop")


def _pick(index: Column, options: tuple[str, ...]) -> Column:
    expr = None
    for i, v in enumerate(options):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _txn_type(event_type: Column) -> Column:
    expr = None
    for ev, tt in EVENT_TO_TXN_TYPE:
        expr = F.when(event_type == ev, F.lit(tt)) if expr is None else expr.when(event_type == ev, F.lit(tt))
    return expr


def _prop_k(props: Column) -> Column:
    return F.regexp_extract(props, r"(\d+)", 1)


def transactions(events: DataFrame) -> DataFrame:
    """Clean, typed transactions (the silver shape the gold layer reads)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    ttype = _txn_type(F.col("event_type"))
    k = _prop_k(F.col("props"))
    canada = (eid % 5) == 0
    return events.select(
        eid.cast("string").alias("txn_id"),
        F.concat(F.lit("AC"), uid.cast("string")).alias("account_id"),
        uid.cast("string").alias("customer_id"),
        F.col("ts").cast("timestamp_ntz").alias("txn_timestamp"),
        ttype.alias("txn_type"),
        (F.col("value") * 10000).cast("decimal(18,2)").alias("amount"),
        _pick(eid % 3, CURRENCIES_BY_MOD3).alias("currency"),
        F.when(ttype.isin("CREDIT", "DEPOSIT"), F.lit(None).cast("string"))
        .when((eid % 13) == 0, F.concat(F.lit("AC"), (uid + 1).cast("string")))
        .otherwise(F.concat(F.lit("AC"), uid.cast("string")))
        .alias("from_account"),
        F.concat(F.lit("A"), k).alias("to_account"),
        _pick(eid % 6, CHANNELS_BY_MOD6).alias("channel"),
        F.concat(F.lit("D"), k).alias("device_id"),
        F.concat(F.lit("10.0.0."), (uid % 4).cast("string")).alias("ip_address"),
        F.when(canada, F.lit("Canada")).otherwise(F.lit("India")).alias("location_country"),
        F.when(canada, F.lit("Toronto")).otherwise(_pick(eid % 3, INDIA_CITIES_BY_MOD3)).alias("location_city"),
        F.concat(F.lit("M"), (eid % 50).cast("string")).alias("merchant_id"),
        _pick(eid % 7, CATEGORIES_BY_MOD7).alias("merchant_category"),
        F.when((eid % 10) == 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
    )


def _customer_columns() -> list[Column]:
    ck = F.col("c_custkey")
    canada = (ck % 10) == 0
    return [
        ck.cast("string").alias("customer_id"),
        F.concat(F.lit("AC"), ck.cast("string")).alias("account_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.col("c_name")), F.lit("@bank.example")).alias("email"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((ck * 331) % 25000).cast("int")).alias("date_of_birth"),
        F.date_add(F.lit("2018-01-01").cast("date"), ((ck * 7) % 2500).cast("int")).alias("account_opening_date"),
        F.when((ck % 3) == 0, F.lit("PENDING")).otherwise(F.lit("VERIFIED")).alias("kyc_status"),
        F.when((ck % 2) == 0, F.lit("SAVINGS")).otherwise(F.lit("CURRENT")).alias("account_type"),
        F.col("c_acctbal").alias("account_balance"),
        F.when(canada, F.lit("Canada")).otherwise(F.lit("India")).alias("home_country"),
        F.when(canada, F.lit("Toronto")).otherwise(F.lit("Mumbai")).alias("home_city"),
        F.when((ck % 9) == 0, F.lit("False")).otherwise(F.lit("True")).alias("is_active"),
    ]


def customers(customer: DataFrame) -> DataFrame:
    """Clean, typed customer profiles, one account per customer."""
    return customer.select(*_customer_columns())


# ---------------------------------------------------------------------------
# Dirty, all-string bronze feeds. Faults are planted by modulus of the key:
#   %50 null mandatory field    %53 unparseable amount / date
#   %59 negative amount          %73 non-numeric amount      %79 null amount
#   %61 duplicate key, second copy one day later            %67 lower-case type
#   %71 null country
# ---------------------------------------------------------------------------

TXN_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SESSION_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def bronze_transactions(events: DataFrame) -> DataFrame:
    """All-string transaction feed with planted faults and duplicates."""
    t = transactions(events).withColumn("event_id", F.col("txn_id").cast("bigint"))
    eid = F.col("event_id")
    amount_txt = F.col("amount").cast("string")
    rows = t.select(
        "event_id",
        F.when(eid % 50 == 0, F.lit(None)).otherwise(F.col("txn_id")).alias("txn_id"),
        "account_id",
        "customer_id",
        F.when(eid % 53 == 0, F.lit("2024-13-45 99:99:99.000000"))
        .otherwise(F.date_format("txn_timestamp", TXN_TS_FORMAT))
        .alias("txn_timestamp"),
        F.when(eid % 67 == 0, F.lower("txn_type")).otherwise(F.col("txn_type")).alias("txn_type"),
        F.when(eid % 79 == 0, F.lit(None))
        .when(eid % 73 == 0, F.lit("n/a"))
        .when(eid % 59 == 0, F.concat(F.lit("-"), amount_txt))
        .otherwise(amount_txt)
        .alias("amount"),
        "currency",
        "from_account",
        F.when(F.col("txn_type").isin("WITHDRAWAL", "DEBIT") & (eid % 4 != 0), F.lit(None))
        .otherwise(F.col("to_account"))
        .alias("to_account"),
        "channel",
        "device_id",
        "ip_address",
        F.when(eid % 71 == 0, F.lit(None)).otherwise(F.col("location_country")).alias("location_country"),
        "location_city",
        F.lit("19.07").alias("location_lat"),
        F.lit("72.87").alias("location_lon"),
        "merchant_id",
        "merchant_category",
        "status",
    )
    dup = rows.filter((eid % 61 == 0) & (eid % 50 != 0) & (eid % 53 != 0)).withColumn(
        "txn_timestamp",
        F.date_format(
            F.try_to_timestamp(F.col("txn_timestamp"), F.lit(TXN_TS_FORMAT)).cast("timestamp_ntz")
            + F.expr("INTERVAL 1 DAY"),
            TXN_TS_FORMAT,
        ),
    )
    return rows.unionByName(dup).drop("event_id")


def bronze_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """All-string customer feed; home country/city in raw case from ``nation``."""
    n = nation.select(F.col("n_nationkey"), F.lower("n_name").alias("n_name"))
    c = customer.join(n, customer["c_nationkey"] == n["n_nationkey"], "left").select(
        *_customer_columns(), F.col("c_custkey").alias("ck"), "n_name"
    )
    ck = F.col("ck")
    return c.select(
        F.when(ck % 50 == 0, F.lit(None)).otherwise(F.col("customer_id")).alias("customer_id"),
        "account_id",
        "customer_name",
        F.when(ck % 71 == 0, F.lit(None))
        .otherwise(F.concat(F.upper(F.col("customer_name")), F.lit("@corp.example")))
        .alias("email"),
        F.lit("+91-0000000000").alias("phone"),
        F.when(ck % 53 == 0, F.lit("1990-02-30")).otherwise(F.col("date_of_birth").cast("string")).alias("date_of_birth"),
        F.when(ck % 67 == 0, F.lower("kyc_status")).otherwise(F.col("kyc_status")).alias("kyc_status"),
        F.col("n_name").alias("home_country"),
        F.concat(F.lit("city of "), F.col("n_name")).alias("home_city"),
        F.col("account_opening_date").cast("string").alias("account_opening_date"),
        F.lower("account_type").alias("account_type"),
        F.when(ck % 79 == 0, F.lit(None))
        .when(ck % 73 == 0, F.lit("lots"))
        .otherwise(F.col("account_balance").cast("string"))
        .alias("account_balance"),
        "is_active",
    ).unionByName(
        # A later profile for some accounts: same account, later opening date.
        c.filter((ck % 61 == 0) & (ck % 50 != 0)).select(
            F.col("customer_id"),
            "account_id",
            "customer_name",
            F.concat(F.col("customer_name"), F.lit("@corp.example")).alias("email"),
            F.lit("+91-0000000000").alias("phone"),
            F.col("date_of_birth").cast("string").alias("date_of_birth"),
            "kyc_status",
            F.col("n_name").alias("home_country"),
            F.concat(F.lit("city of "), F.col("n_name")).alias("home_city"),
            F.date_add("account_opening_date", 1).cast("string").alias("account_opening_date"),
            F.lower("account_type").alias("account_type"),
            F.col("account_balance").cast("string").alias("account_balance"),
            "is_active",
        )
    )


def bronze_sessions(events: DataFrame) -> DataFrame:
    """All-string device-session feed derived from ``events``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    login = F.col("ts").cast("timestamp_ntz")
    logout = F.timestamp_add("SECOND", (F.col("value") * 60).cast("bigint"), login)
    k = _prop_k(F.col("props"))
    rows = events.select(
        eid,
        eid.cast("string").alias("session_id"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(uid.cast("string")).alias("customer_id"),
        F.concat(F.lit("D"), k).alias("device_id"),
        F.when(eid % 53 == 0, F.lit("yesterday")).otherwise(F.date_format(login, SESSION_TS_FORMAT)).alias(
            "login_timestamp"
        ),
        # %59: logout before login (negative duration)
        F.when(eid % 59 == 0, F.date_format(login - F.expr("INTERVAL 1 HOUR"), SESSION_TS_FORMAT))
        .otherwise(F.date_format(logout, SESSION_TS_FORMAT))
        .alias("logout_timestamp"),
        F.concat(F.lit("10.0.0."), (uid % 4).cast("string")).alias("ip_address"),
        F.when(eid % 71 == 0, F.lit(None))
        .when(eid % 5 == 0, F.lit("canada"))
        .otherwise(F.lit("india"))
        .alias("location_country"),
        F.when(eid % 71 == 0, F.lit(None))
        .when(eid % 5 == 0, F.lit("toronto"))
        .otherwise(F.lit("new delhi"))
        .alias("location_city"),
        _pick(eid % 4, DEVICE_TYPES_BY_MOD4).alias("device_type"),
        F.lit("Android").alias("os"),
        F.lit("Chrome").alias("browser"),
        F.when(eid % 12 == 0, F.lit("True")).otherwise(F.lit("False")).alias("is_new_device"),
        F.when(eid % 14 == 0, F.lit("True")).otherwise(F.lit("False")).alias("is_new_location"),
    )
    dup = rows.filter((eid % 61 == 0) & (eid % 53 != 0) & (eid % 59 != 0)).withColumn(
        "login_timestamp",
        F.date_format(
            F.try_to_timestamp(F.col("login_timestamp"), F.lit(SESSION_TS_FORMAT)).cast("timestamp_ntz")
            - F.expr("INTERVAL 1 MINUTE"),
            SESSION_TS_FORMAT,
        ),
    )
    return rows.unionByName(dup).drop("event_id")


def customer_changes(customer: DataFrame) -> DataFrame:
    """Change feed for SCD2: three versions per customer, one day apart
    (``ingest_timestamp``); the balance changes on even keys at version 2 and
    on every key at version 3."""
    ck = F.col("c_custkey")
    rows = customer.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("__v"))
    v = F.col("__v")
    balance = (
        F.when(v == 1, F.col("c_acctbal"))
        .when(v == 2, F.when(ck % 2 == 0, F.col("c_acctbal") + 50).otherwise(F.col("c_acctbal")))
        .otherwise(F.col("c_acctbal") + 100)
    )
    ingest = F.timestamp_add(
        "SECOND", (v - 1) * 86400 + (ck % 86400), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    )
    return rows.select(*_customer_columns(), balance.alias("__bal"), ingest.alias("ingest_timestamp")).withColumn(
        "account_balance", F.col("__bal")
    ).drop("__bal")
