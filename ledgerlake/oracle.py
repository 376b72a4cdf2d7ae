"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the semantics (plain windows, plain range joins) rather
than from the Spark plans, so a planning mistake on the Spark side shows up
as a mismatch. Tables are the driver's pre-registered views.
"""

from __future__ import annotations

from .sources.feeds import TRANSACTION_FIELDS

# --- bindings (must mirror ledgerlake.sources.binding) ---------------------

TXN = r"""
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_id,
         'AC' || CAST(user_id AS VARCHAR) AS account_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         ts AS txn_timestamp,
         CASE event_type WHEN 'purchase' THEN 'DEBIT' WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'CREDIT'
                         WHEN 'signup' THEN 'DEPOSIT' WHEN 'error' THEN 'WITHDRAWAL' END AS txn_type,
         CAST(value * 10000 AS DECIMAL(18,2)) AS amount,
         CASE event_id % 3 WHEN 0 THEN 'INR' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
         CASE WHEN event_type IN ('view', 'signup') THEN NULL
              WHEN event_id % 13 = 0 THEN 'AC' || CAST(user_id + 1 AS VARCHAR)
              ELSE 'AC' || CAST(user_id AS VARCHAR) END AS from_account,
         'A' || regexp_extract(props, '(\d+)', 1) AS to_account,
         CASE event_id % 6 WHEN 0 THEN 'ATM' WHEN 1 THEN 'BRANCH' WHEN 2 THEN 'UPI' WHEN 3 THEN 'ONLINE'
                           WHEN 4 THEN 'POS' ELSE 'MOBILE' END AS channel,
         'D' || regexp_extract(props, '(\d+)', 1) AS device_id,
         '10.0.0.' || CAST(user_id % 4 AS VARCHAR) AS ip_address,
         CASE WHEN event_id % 5 = 0 THEN 'Canada' ELSE 'India' END AS location_country,
         CASE WHEN event_id % 5 = 0 THEN 'Toronto' WHEN event_id % 3 = 0 THEN 'Mumbai'
              WHEN event_id % 3 = 1 THEN 'Delhi' ELSE 'Pune' END AS location_city,
         'M' || CAST(event_id % 50 AS VARCHAR) AS merchant_id,
         CASE event_id % 7 WHEN 0 THEN 'GROCERY' WHEN 1 THEN 'ELECTRONICS' WHEN 2 THEN 'TRAVEL' WHEN 3 THEN 'DINING'
                           WHEN 4 THEN 'FUEL' WHEN 5 THEN 'UTILITIES' ELSE 'ENTERTAINMENT' END AS merchant_category,
         CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM events
)"""

CUST = r"""
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         'AC' || CAST(c_custkey AS VARCHAR) AS account_id,
         c_name AS customer_name,
         lower(c_name) || '@bank.example' AS email,
         DATE '1950-01-01' + CAST((c_custkey * 331) % 25000 AS INTEGER) AS date_of_birth,
         DATE '2018-01-01' + CAST((c_custkey * 7) % 2500 AS INTEGER) AS account_opening_date,
         CASE WHEN c_custkey % 3 = 0 THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status,
         CASE WHEN c_custkey % 2 = 0 THEN 'SAVINGS' ELSE 'CURRENT' END AS account_type,
         c_acctbal AS account_balance,
         CASE WHEN c_custkey % 10 = 0 THEN 'Canada' ELSE 'India' END AS home_country,
         CASE WHEN c_custkey % 10 = 0 THEN 'Toronto' ELSE 'Mumbai' END AS home_city,
         CASE WHEN c_custkey % 9 = 0 THEN 'False' ELSE 'True' END AS is_active
  FROM customer
)"""


def fact_cte(high_amount: int = 400000, new_days: int = 90, rolling: int = 604800,
             txn: str = "txn", cust: str = "cust") -> str:
    """``fact`` CTE (needs ``txn`` and ``cust``): the reference's windows as written."""
    return rf"""
fj AS (
  SELECT t.txn_id, t.customer_id, t.account_id, t.device_id, t.txn_timestamp, t.amount,
         CASE WHEN t.txn_type IS NULL THEN 'UNKNOWN' ELSE upper(t.txn_type) END AS txn_type,
         CASE WHEN t.channel IS NULL THEN 'UNKNOWN' ELSE upper(t.channel) END AS channel,
         CASE WHEN t.status IS NULL THEN 'UNKNOWN' ELSE upper(t.status) END AS status,
         CASE WHEN c.kyc_status IS NULL THEN 'MINIMAL' ELSE upper(c.kyc_status) END AS kyc_status,
         CASE WHEN c.account_type IS NULL THEN 'UNKNOWN' ELSE upper(c.account_type) END AS account_type,
         c.account_balance,
         coalesce(CASE WHEN upper(t.txn_type) IN ('CREDIT', 'DEPOSIT') THEN 'EXTERNAL_SOURCE' ELSE t.from_account END,
                  'UNKNOWN') AS from_account,
         coalesce(CASE WHEN upper(t.txn_type) IN ('WITHDRAWAL', 'DEBIT') THEN 'CASH_OR_MERCHANT' ELSE t.to_account END,
                  'UNKNOWN') AS to_account,
         coalesce(t.location_country, 'UNKNOWN') AS location_country,
         coalesce(t.location_city, 'UNKNOWN') AS location_city,
         coalesce(c.home_country, 'UNKNOWN') AS home_country,
         coalesce(c.home_city, 'UNKNOWN') AS home_city,
         coalesce(t.ip_address, 'UNKNOWN_IP') AS ip_address,
         CAST(t.txn_timestamp AS DATE) AS txn_date,
         CAST(hour(t.txn_timestamp) AS INTEGER) AS txn_hour,
         epoch_us(t.txn_timestamp) // 1000000 AS s
  FROM {txn} t LEFT JOIN {cust} c ON t.customer_id = c.customer_id AND t.account_id = c.account_id
),
fw AS (
  SELECT *,
    lag(s) OVER (PARTITION BY customer_id ORDER BY txn_timestamp, txn_id) AS prev_s,
    lag(txn_timestamp) OVER (PARTITION BY customer_id, to_account ORDER BY txn_timestamp, txn_id) AS prev_ben,
    count(txn_id) OVER (PARTITION BY customer_id, txn_date) AS daily_txn_count,
    sum(amount) OVER (PARTITION BY customer_id, txn_date) AS daily_total,
    count(DISTINCT to_account) OVER (PARTITION BY customer_id, txn_date) AS daily_unique_beneficiaries,
    sum(amount) OVER (PARTITION BY customer_id ORDER BY s RANGE BETWEEN {rolling} PRECEDING AND CURRENT ROW) AS rolling_sum,
    lag(location_city) OVER (PARTITION BY customer_id, ip_address ORDER BY txn_timestamp, txn_id) AS p_city,
    lag(location_country) OVER (PARTITION BY customer_id, ip_address ORDER BY txn_timestamp, txn_id) AS p_country
  FROM fj
),
fact AS (
  SELECT txn_id, customer_id, account_id, device_id, txn_timestamp, txn_date, txn_hour, txn_type, amount,
         channel, status, from_account, to_account, account_type, account_balance, kyc_status, ip_address,
         home_country, home_city, location_country, location_city,
         CASE WHEN amount >= {high_amount} THEN 1 ELSE 0 END AS high_amount_flag,
         CASE WHEN txn_hour BETWEEN 0 AND 4 THEN 1 ELSE 0 END AS night_indicator,
         CASE WHEN home_country <> location_country THEN 1 ELSE 0 END AS geo_mismatch_flag,
         coalesce((s - prev_s) / 60, 99999.0) AS txn_gap_minutes,
         CASE WHEN txn_type = 'TRANSFER'
                   AND (prev_ben IS NULL OR date_diff('day', CAST(prev_ben AS DATE), txn_date) > {new_days})
              THEN 1 ELSE 0 END AS new_beneficiary_flag,
         daily_txn_count,
         CAST(daily_total AS DECIMAL(28,2)) AS daily_total_amount,
         daily_unique_beneficiaries,
         CAST(rolling_sum AS DECIMAL(28,2)) AS rolling_7day_amount,
         coalesce(p_city, location_city) AS previous_ip_city,
         coalesce(p_country, location_country) AS previous_ip_country,
         s
  FROM fw
)"""


FACT_COLUMNS = (
    "txn_id, customer_id, account_id, device_id, txn_timestamp, txn_date, txn_hour, txn_type, amount, channel, "
    "status, from_account, to_account, account_type, account_balance, kyc_status, ip_address, home_country, "
    "home_city, location_country, location_city, high_amount_flag, night_indicator, geo_mismatch_flag, "
    "txn_gap_minutes, new_beneficiary_flag, daily_txn_count, daily_total_amount, daily_unique_beneficiaries, "
    "rolling_7day_amount, previous_ip_city, previous_ip_country"
)


def with_fact(select: str, **fact_args) -> str:
    return "WITH " + ",\n".join([TXN, CUST, fact_cte(**fact_args)]) + "\n" + select


def _d(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


KPI1 = ("SELECT txn_id, customer_id, account_id, txn_date, amount, kyc_status, channel FROM fact "
        "WHERE new_beneficiary_flag = 1 AND high_amount_flag = 1")


def kpi2(span: int = 1800, min_payees: int = 3) -> str:
    return f"""SELECT customer_id, count(*) AS event_count, CAST(sum(tot) AS DECIMAL(38,2)) AS total_amount
FROM (
  SELECT i.customer_id, i.credit_time, count(DISTINCT o.to_account) AS ub, sum(o.amount) AS tot
  FROM (SELECT customer_id, txn_timestamp AS credit_time, s AS cs FROM fact WHERE txn_type IN ('CREDIT', 'DEPOSIT')) i
  JOIN (SELECT customer_id, s AS os, to_account, amount FROM fact WHERE txn_type = 'TRANSFER') o
    ON i.customer_id = o.customer_id AND o.os - i.cs >= 0 AND o.os - i.cs <= {span}
  GROUP BY i.customer_id, i.credit_time
) r WHERE ub >= {min_payees} GROUP BY customer_id"""


KPI3 = """SELECT customer_id, txn_date, count(*) AS event_count, CAST(sum(daily_total_amount) AS DECIMAL(38,2)) AS total_amount
FROM fact WHERE account_type = 'SAVINGS' AND ((daily_total_amount > 200000 AND channel NOT IN ('BRANCH', 'ONLINE', 'POS'))
   OR daily_txn_count >= 10 OR rolling_7day_amount >= 1000000)
GROUP BY customer_id, txn_date"""

KPI4 = """SELECT customer_id, account_id, txn_id, txn_date, channel, daily_txn_count, daily_total_amount FROM fact
WHERE account_type = 'CURRENT' AND ((channel = 'ATM' AND daily_total_amount > 200000)
   OR (channel = 'ONLINE' AND daily_total_amount > 2000000) OR (channel = 'POS' AND daily_total_amount > 500000)
   OR (channel = 'MOBILE' AND daily_total_amount > 300000))"""

KPI6 = """SELECT txn_id, customer_id, ip_address, txn_timestamp, location_city, location_country, prev_city, prev_country,
       time_diff_minutes
FROM (SELECT *, lag(location_city) OVER w AS prev_city, lag(location_country) OVER w AS prev_country,
             (s - lag(s) OVER w) / 60 AS time_diff_minutes
      FROM fact WINDOW w AS (PARTITION BY customer_id, ip_address ORDER BY txn_timestamp, txn_id))
WHERE ip_address IS NOT NULL AND time_diff_minutes <= 10 AND location_country <> prev_country"""

KPI7 = """SELECT customer_id, account_id, txn_id, txn_date, daily_total_amount, kyc_status, channel FROM fact
WHERE kyc_status = 'PENDING' AND daily_total_amount > 200000 AND channel NOT IN ('BRANCH')"""


def velocity(width: str = "5 minutes", min_count: int = 5) -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', txn_timestamp) AS window_start,
       time_bucket(INTERVAL '{width}', txn_timestamp) + INTERVAL '{width}' AS window_end,
       customer_id, count(*) AS count
FROM fact GROUP BY 1, 2, customer_id HAVING count(*) > {min_count}"""


def percentages_select(span: int = 1800) -> str:
    return f"""SELECT k1 / total AS p1, k2 / total AS p2, k3 / total AS p3, k4 / total AS p4,
       k5 / total AS p5, k6 / total AS p6, k7 / total AS p7
FROM (SELECT (SELECT count(*) FROM fact) AS total,
             (SELECT count(*) FROM ({KPI1})) AS k1,
             (SELECT count(*) FROM ({kpi2(span)})) AS k2,
             (SELECT count(*) FROM ({KPI3})) AS k3,
             (SELECT count(*) FROM ({KPI4})) AS k4,
             (SELECT count(*) FROM ({KPI1})) AS k5,
             (SELECT count(*) FROM ({KPI6})) AS k6,
             (SELECT count(*) FROM ({KPI7})) AS k7)"""


def score_select(span: int = 1800) -> str:
    w = (0.15, 0.20, 0.10, 0.10, 0.15, 0.15, 0.10)
    terms = " + ".join(
        f"p{i} * ({_d(0.7)} * {_d(w[i - 1])} + {_d(0.3)} * (p{i} / tp))" for i in range(1, 8)
    )
    return f"""SELECT risk_score,
       CASE WHEN risk_score >= 0.6 THEN 'HIGH' WHEN risk_score >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM (SELECT {terms} AS risk_score
      FROM (SELECT *, p1 + p2 + p3 + p4 + p5 + p6 + p7 AS tp FROM ({percentages_select(span)})))"""


CHANNELS = ("ATM", "BRANCH", "UPI", "ONLINE", "POS", "MOBILE")


def sql_report_daily() -> str:
    return with_fact(
        "SELECT txn_date, channel, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount "
        "FROM fact GROUP BY txn_date, channel"
    )


# --- bronze / silver -------------------------------------------------------

AS_OF = "2024-02-01 00:00:00"

BRONZE_TXN = r"""
bt_rows AS (
  SELECT CAST(txn_id AS BIGINT) AS event_id,
         CASE WHEN CAST(txn_id AS BIGINT) % 50 = 0 THEN NULL ELSE txn_id END AS txn_id,
         account_id, customer_id,
         CASE WHEN CAST(txn_id AS BIGINT) % 53 = 0 THEN '2024-13-45 99:99:99.000000'
              ELSE strftime(txn_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS txn_timestamp,
         CASE WHEN CAST(txn_id AS BIGINT) % 67 = 0 THEN lower(txn_type) ELSE txn_type END AS txn_type,
         CASE WHEN CAST(txn_id AS BIGINT) % 79 = 0 THEN NULL
              WHEN CAST(txn_id AS BIGINT) % 73 = 0 THEN 'n/a'
              WHEN CAST(txn_id AS BIGINT) % 59 = 0 THEN '-' || CAST(amount AS VARCHAR)
              ELSE CAST(amount AS VARCHAR) END AS amount,
         currency, from_account,
         CASE WHEN txn_type IN ('WITHDRAWAL', 'DEBIT') AND CAST(txn_id AS BIGINT) % 4 <> 0 THEN NULL
              ELSE to_account END AS to_account,
         channel, device_id, ip_address,
         CASE WHEN CAST(txn_id AS BIGINT) % 71 = 0 THEN NULL ELSE location_country END AS location_country,
         location_city, '19.07' AS location_lat, '72.87' AS location_lon,
         merchant_id, merchant_category, status, txn_timestamp AS orig_ts
  FROM txn
),
bronze_txn AS (
  SELECT * EXCLUDE (event_id, orig_ts) FROM bt_rows
  UNION ALL
  SELECT * EXCLUDE (event_id, orig_ts) REPLACE (strftime(orig_ts + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%f') AS txn_timestamp)
  FROM bt_rows WHERE event_id % 61 = 0 AND event_id % 50 <> 0 AND event_id % 53 <> 0
)"""


def silver_txn_cte(as_of: str = AS_OF, name: str = "silver_txn") -> str:
    return rf"""
{name}_a AS (
  SELECT * EXCLUDE (location_lat, location_lon, amount, location_country, location_city, merchant_category,
                    txn_timestamp, txn_type, channel, status),
         coalesce(location_country, 'UNKNOWN') AS location_country,
         coalesce(location_city, 'UNKNOWN') AS location_city,
         coalesce(merchant_category, 'UNKNOWN') AS merchant_category,
         TRY_CAST(amount AS DECIMAL(18,2)) AS amount,
         try_strptime(txn_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS txn_timestamp,
         upper(txn_type) AS txn_type, upper(channel) AS channel, upper(status) AS status,
         TIMESTAMP '{as_of}' AS ingest_timestamp
  FROM bronze_txn
  WHERE txn_id IS NOT NULL AND account_id IS NOT NULL AND customer_id IS NOT NULL
),
{name}_b AS (
  SELECT *,
         CAST(CASE WHEN currency = 'USD' THEN amount * 94 WHEN currency = 'EUR' THEN amount * 111
                   WHEN currency = 'INR' THEN amount END AS DECIMAL(22,2)) AS normalised_amount,
         row_number() OVER (PARTITION BY txn_id ORDER BY txn_timestamp DESC) AS rn
  FROM {name}_a WHERE amount IS NOT NULL AND amount > 0 AND txn_timestamp IS NOT NULL
),
{name} AS (
  SELECT * EXCLUDE (rn),
         CASE WHEN txn_type IN ('DEPOSIT', 'CREDIT') THEN 'Not_Applicable'
              WHEN account_id = from_account THEN 'SAME_ACCOUNT' ELSE 'SUSPICIOUS' END AS account_match_flag,
         CASE WHEN (txn_type = 'WITHDRAWAL' AND from_account IS NOT NULL AND to_account IS NULL)
                OR (txn_type = 'TRANSFER' AND from_account IS NOT NULL AND to_account IS NOT NULL)
                OR (txn_type = 'DEBIT' AND from_account IS NOT NULL AND merchant_id IS NOT NULL AND to_account IS NULL)
                OR (txn_type IN ('CREDIT', 'DEPOSIT') AND to_account IS NOT NULL AND from_account IS NULL)
              THEN 'VALID' ELSE 'INVALID' END AS txn_validation_flag
  FROM {name}_b WHERE rn = 1
)"""


INITCAP = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda x: upper(x[1]) || x[2:]), ' ')"

BRONZE_CUST = r"""
bc_base AS (
  SELECT c.*, c_custkey AS ck, lower(n.n_name) AS n_name
  FROM (SELECT cust.*, customer.c_custkey FROM cust JOIN customer ON cust.customer_id = CAST(customer.c_custkey AS VARCHAR)) c
  LEFT JOIN nation n ON (SELECT c_nationkey FROM customer WHERE customer.c_custkey = c.c_custkey) = n.n_nationkey
),
bronze_cust AS (
  SELECT CASE WHEN ck % 50 = 0 THEN NULL ELSE customer_id END AS customer_id, account_id, customer_name,
         CASE WHEN ck % 71 = 0 THEN NULL ELSE upper(customer_name) || '@corp.example' END AS email,
         '+91-0000000000' AS phone,
         CASE WHEN ck % 53 = 0 THEN '1990-02-30' ELSE CAST(date_of_birth AS VARCHAR) END AS date_of_birth,
         CASE WHEN ck % 67 = 0 THEN lower(kyc_status) ELSE kyc_status END AS kyc_status,
         n_name AS home_country, 'city of ' || n_name AS home_city,
         CAST(account_opening_date AS VARCHAR) AS account_opening_date,
         lower(account_type) AS account_type,
         CASE WHEN ck % 79 = 0 THEN NULL WHEN ck % 73 = 0 THEN 'lots' ELSE CAST(account_balance AS VARCHAR) END
           AS account_balance,
         is_active
  FROM bc_base
  UNION ALL
  SELECT customer_id, account_id, customer_name, customer_name || '@corp.example', '+91-0000000000',
         CAST(date_of_birth AS VARCHAR), kyc_status, n_name, 'city of ' || n_name,
         CAST(account_opening_date + 1 AS VARCHAR), lower(account_type), CAST(account_balance AS VARCHAR), is_active
  FROM bc_base WHERE ck % 61 = 0 AND ck % 50 <> 0
)"""


def silver_cust_cte(as_of: str = AS_OF) -> str:
    ic_country = INITCAP.format("home_country")
    ic_city = INITCAP.format("home_city")
    return rf"""
sc_a AS (
  SELECT * EXCLUDE (email, account_balance, date_of_birth, account_opening_date, kyc_status, account_type,
                    home_country, home_city, phone),
         lower(regexp_replace(email, '@.*', '@gmail.com')) AS email,
         TRY_CAST(account_balance AS DOUBLE) AS account_balance,
         CAST(try_strptime(date_of_birth, '%Y-%m-%d') AS DATE) AS date_of_birth,
         CAST(try_strptime(account_opening_date, '%Y-%m-%d') AS DATE) AS account_opening_date,
         upper(kyc_status) AS kyc_status, upper(account_type) AS account_type,
         TIMESTAMP '{as_of}' AS ingest_timestamp,
         {ic_country} AS home_country, {ic_city} AS home_city
  FROM bronze_cust
  WHERE customer_id IS NOT NULL AND account_id IS NOT NULL AND email IS NOT NULL
),
sc_b AS (
  SELECT *, CAST(floor(date_diff('day', date_of_birth, CAST(TIMESTAMP '{as_of}' AS DATE)) / 365) AS BIGINT) AS age
  FROM sc_a WHERE account_balance IS NOT NULL AND date_of_birth IS NOT NULL AND account_opening_date IS NOT NULL
),
silver_cust AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY account_opening_date DESC) AS rn
    FROM sc_b WHERE age >= 18 AND account_opening_date < CAST(TIMESTAMP '{as_of}' AS DATE)
  ) WHERE rn = 1
)"""


BRONZE_SESS = r"""
bs_rows AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS session_id,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS customer_id,
         'D' || regexp_extract(props, '(\d+)', 1) AS device_id,
         CASE WHEN event_id % 53 = 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS login_timestamp,
         CASE WHEN event_id % 59 = 0 THEN strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts + to_seconds(CAST(trunc(value * 60) AS BIGINT)), '%Y-%m-%d %H:%M:%S') END
           AS logout_timestamp,
         '10.0.0.' || CAST(user_id % 4 AS VARCHAR) AS ip_address,
         CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'canada' ELSE 'india' END AS location_country,
         CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'toronto' ELSE 'new delhi' END AS location_city,
         CASE event_id % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Laptop' WHEN 2 THEN 'Tablet' ELSE 'Desktop' END AS device_type,
         'Android' AS os, 'Chrome' AS browser,
         CASE WHEN event_id % 12 = 0 THEN 'True' ELSE 'False' END AS is_new_device,
         CASE WHEN event_id % 14 = 0 THEN 'True' ELSE 'False' END AS is_new_location,
         ts AS orig_ts
  FROM events
),
bronze_sess AS (
  SELECT * EXCLUDE (event_id, orig_ts) FROM bs_rows
  UNION ALL
  SELECT * EXCLUDE (event_id, orig_ts)
         REPLACE (strftime(date_trunc('second', orig_ts) - INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS login_timestamp)
  FROM bs_rows WHERE event_id % 61 = 0 AND event_id % 53 <> 0 AND event_id % 59 <> 0
)"""


def silver_sess_cte(as_of: str = AS_OF, name: str = "silver_sess") -> str:
    return rf"""
{name}_a AS (
  SELECT * EXCLUDE (location_country, location_city, device_type, is_new_device, is_new_location,
                    login_timestamp, logout_timestamp, os, browser),
         {INITCAP.format("coalesce(location_country, 'UNKNOWN')")} AS location_country,
         {INITCAP.format("coalesce(location_city, 'UNKNOWN')")} AS location_city,
         upper(device_type) AS device_type,
         TRY_CAST(is_new_device AS BOOLEAN) AS is_new_device,
         TRY_CAST(is_new_location AS BOOLEAN) AS is_new_location,
         try_strptime(login_timestamp, '%Y-%m-%d %H:%M:%S') AS login_timestamp,
         try_strptime(logout_timestamp, '%Y-%m-%d %H:%M:%S') AS logout_timestamp
  FROM bronze_sess
  WHERE session_id IS NOT NULL AND customer_id IS NOT NULL AND device_id IS NOT NULL
),
{name}_b AS (
  SELECT *, epoch_us(logout_timestamp) // 1000000 - epoch_us(login_timestamp) // 1000000 AS session_duration_seconds,
         TIMESTAMP '{as_of}' AS ingest_timestamp
  FROM {name}_a WHERE login_timestamp IS NOT NULL AND logout_timestamp IS NOT NULL
),
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY login_timestamp DESC) AS rn
    FROM {name}_b WHERE session_duration_seconds >= 0
  ) WHERE rn = 1
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CUST_CHANGES = r"""
cust_changes AS (
  SELECT c.* REPLACE (
           CASE WHEN v = 1 THEN account_balance
                WHEN v = 2 THEN CASE WHEN customer.c_custkey % 2 = 0 THEN account_balance + 50 ELSE account_balance END
                ELSE account_balance + 100 END AS account_balance),
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((v - 1) * 86400 + customer.c_custkey % 86400) AS ingest_timestamp
  FROM cust c JOIN customer ON c.customer_id = CAST(customer.c_custkey AS VARCHAR),
       (SELECT unnest([1, 2, 3]) AS v)
)"""

ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


register("fact_transactions", with_fact(f"SELECT {FACT_COLUMNS} FROM fact"))
register("fact_transactions_split", ORACLE["fact_transactions"])
register("report_daily", sql_report_daily())
register(
    "report_monthly",
    with_fact("SELECT strftime(txn_date, '%Y-%m') AS txn_month, channel, count(*) AS txn_count, "
              "CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount FROM fact GROUP BY 1, 2"),
)
register(
    "report_daily_pivot",
    with_fact("SELECT txn_date, " + ", ".join(
        f"CAST(sum(amount) FILTER (WHERE channel = '{c}') AS DECIMAL(28,2)) AS \"{c}\"" for c in CHANNELS
    ) + " FROM fact GROUP BY txn_date"),
)
register("kpi_new_beneficiary_high_amt", with_fact(KPI1))
register("kpi_night_velocity", with_fact(KPI1))
register("kpi_rapid_distribution", with_fact(kpi2(1800)))
register("kpi_rapid_distribution_1d", with_fact(kpi2(86400)))
register("kpi_savings_abnormal", with_fact(KPI3))
register("kpi_current_overactivity", with_fact(KPI4))
register("kpi_transaction_velocity", with_fact(velocity("5 minutes")))
register("kpi_transaction_velocity_1d", with_fact(velocity("1 day")))
register("kpi_impossible_travel", with_fact(KPI6))
register("kpi_kyc_pending", with_fact(KPI7))
register("kpi_percentages", with_fact(percentages_select(1800)))
register("system_risk_score", with_fact(score_select(1800)))
register("system_risk_score_1d", with_fact(score_select(86400)))

register("quarantine_transactions", with_ctes(TXN, BRONZE_TXN) + """
SELECT *, 'Invalid transaction data' AS error_reason FROM bronze_txn
WHERE txn_id IS NULL OR account_id IS NULL OR customer_id IS NULL OR TRY_CAST(amount AS DECIMAL(18,2)) <= 0""")
register("silver_transactions", with_ctes(TXN, BRONZE_TXN, silver_txn_cte()) + "SELECT * FROM silver_txn")
register("quarantine_customers", with_ctes(CUST, BRONZE_CUST) + """
SELECT *, 'Invalid mandatory fields' AS error_reason FROM bronze_cust
WHERE customer_id IS NULL OR account_id IS NULL OR email IS NULL OR account_balance IS NULL""")
register("silver_customers", with_ctes(CUST, BRONZE_CUST, silver_cust_cte()) + "SELECT * FROM silver_cust")
register("quarantine_sessions", with_ctes(BRONZE_SESS) + """
SELECT *, 'Invalid session data' AS error_reason FROM bronze_sess
WHERE session_id IS NULL OR customer_id IS NULL OR device_id IS NULL""")
register("silver_sessions", with_ctes(BRONZE_SESS, silver_sess_cte()) + "SELECT * FROM silver_sess")
register("dim_customers", with_ctes(CUST, BRONZE_CUST, silver_cust_cte()) + """
SELECT customer_id, account_id, customer_name, age, account_type, account_balance, kyc_status, is_active,
       home_country, home_city, account_opening_date FROM silver_cust""")
register("dim_devices", with_ctes(BRONZE_SESS, silver_sess_cte()) + """
SELECT DISTINCT session_id, customer_id, device_id, device_type, ip_address, location_country, location_city,
       is_new_device, is_new_location, login_timestamp, logout_timestamp, session_duration_seconds FROM silver_sess""")
register("dim_merchants", with_ctes(TXN, BRONZE_TXN, silver_txn_cte()) + """
SELECT DISTINCT merchant_id, merchant_category FROM silver_txn WHERE merchant_id IS NOT NULL""")
register("scd2_customers", with_ctes(CUST, CUST_CHANGES) + """
SELECT * EXCLUDE (ingest_timestamp), ingest_timestamp, ingest_timestamp AS __START_AT,
       lead(ingest_timestamp) OVER (PARTITION BY customer_id, account_id ORDER BY ingest_timestamp) AS __END_AT
FROM cust_changes""")
register("scd2_customers_tracked", with_ctes(CUST, CUST_CHANGES) + """
SELECT * EXCLUDE (ingest_timestamp, pb), ingest_timestamp, ingest_timestamp AS __START_AT,
       lead(ingest_timestamp) OVER (PARTITION BY customer_id, account_id ORDER BY ingest_timestamp) AS __END_AT
FROM (SELECT *, lag(account_balance) OVER (PARTITION BY customer_id, account_id ORDER BY ingest_timestamp) AS pb,
             row_number() OVER (PARTITION BY customer_id, account_id ORDER BY ingest_timestamp) AS rn
      FROM cust_changes) WHERE rn = 1 OR pb IS DISTINCT FROM account_balance""".replace("EXCLUDE (ingest_timestamp, pb)", "EXCLUDE (ingest_timestamp, pb, rn)"))
register("scd2_current_customers", with_ctes(CUST, CUST_CHANGES) + """
SELECT * EXCLUDE (ingest_timestamp), ingest_timestamp, ingest_timestamp AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, account_id ORDER BY ingest_timestamp DESC) AS rn
      FROM cust_changes) WHERE rn = 1""".replace("EXCLUDE (ingest_timestamp), ingest_timestamp, ingest_timestamp AS __START_AT, CAST", "EXCLUDE (ingest_timestamp, rn), ingest_timestamp, ingest_timestamp AS __START_AT, CAST"))
register("scd2_transactions", with_ctes(TXN, BRONZE_TXN, silver_txn_cte(AS_OF, "s1"), silver_txn_cte("2024-02-02 00:00:00", "s2")) + """
SELECT *, ingest_timestamp AS __START_AT,
       lead(ingest_timestamp) OVER (PARTITION BY txn_id ORDER BY ingest_timestamp) AS __END_AT
FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2)""")

register("bronze_transactions", with_ctes(TXN, BRONZE_TXN) + "SELECT *, CAST(NULL AS VARCHAR) AS rescued_data FROM bronze_txn")
register("bronze_customers", with_ctes(CUST, BRONZE_CUST) + "SELECT * FROM bronze_cust")
register("bronze_sessions", with_ctes(BRONZE_SESS) + "SELECT * FROM bronze_sess")
register("scan_csv_batch", with_ctes(BRONZE_SESS) + "SELECT * FROM bronze_sess")
register("bronze_rescued", with_ctes(TXN, BRONZE_TXN) + """
SELECT txn_id, CASE WHEN CAST(txn_id AS BIGINT) % 97 = 0 THEN """ + " || ',' || ".join(
    "'SUCCESS,EXTRA'" if f == "status" else f"coalesce({f}, '')" for f in TRANSACTION_FIELDS) + """ END AS rescued_data FROM bronze_txn""")
register("bronze_by_name", with_ctes(TXN, BRONZE_TXN) + """
SELECT * EXCLUDE (status), CAST(NULL AS VARCHAR) AS status, '2024-01-31' AS ingest_ts,
       '{"sender note":"note ' || txn_id || '"}' AS rescued_data FROM bronze_txn""")
register("bronze_drift", with_ctes(TXN, BRONZE_TXN) + """
SELECT * EXCLUDE (status), CASE WHEN channel IN ('ONLINE', 'POS', 'MOBILE') THEN NULL ELSE status END AS status,
       CASE WHEN channel IN ('ONLINE', 'POS', 'MOBILE') AND txn_id IS NOT NULL THEN '{"sender note":"note ' || txn_id || '"}' END AS rescued_data
FROM bronze_txn""")
register("bronze_lineage", with_ctes(TXN, BRONZE_TXN) + "SELECT txn_id, true AS lineage_ok FROM bronze_txn")
register("stream_customer_quarantine", ORACLE["quarantine_customers"])
register("stream_velocity_1d", ORACLE["kpi_transaction_velocity_1d"])
register("stream_dedup_transactions", with_ctes(TXN) + "SELECT * FROM txn")
register("stream_scd2_customers", ORACLE["scd2_customers"])
register("stream_latest_transactions", ORACLE["silver_transactions"])
register("stream_scd2_transactions", ORACLE["scd2_transactions"])
register("scd2_sessions", with_ctes(BRONZE_SESS, silver_sess_cte(AS_OF, "s1"), silver_sess_cte("2024-02-02 00:00:00", "s2")) + """
SELECT *, ingest_timestamp AS __START_AT,
       lead(ingest_timestamp) OVER (PARTITION BY session_id ORDER BY ingest_timestamp) AS __END_AT
FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2)""")
register("stream_scd2_sessions", ORACLE["scd2_sessions"])
register("scd2_late_batch", ORACLE["scd2_customers_tracked"])
register("kpi_impossible_travel_split", ORACLE["kpi_impossible_travel"])
register("fact_beneficiary_5d", with_fact("SELECT txn_id, new_beneficiary_flag FROM fact", new_days=5))

register("fact_incremental", ORACLE["fact_transactions"])
register("fact_partition_prune", with_fact(f"SELECT {FACT_COLUMNS} FROM fact WHERE txn_date = DATE '2024-01-15'"))
register("fact_from_history", with_ctes(
    TXN, CUST, BRONZE_TXN, silver_txn_cte(), BRONZE_CUST, silver_cust_cte(),
    fact_cte(txn="silver_txn", cust="silver_cust")) + f"SELECT {FACT_COLUMNS} FROM fact")
