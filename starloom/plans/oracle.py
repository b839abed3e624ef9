"""Oracle SQL (DuckDB dialect) for every registered query.

Each text starts from the given tables (pre-registered views ``events``,
``orders``) and rebuilds the layers it needs as CTEs: the adapter of
FIXTURES.md, then staging, dimensions (surrogate keys as row_number over the
natural key; reports compare natural keys only), facts and views. Output
columns are named and typed like the Spark side: integers BIGINT, rounded
ratios DOUBLE.
"""

from __future__ import annotations

from starloom.plans.warehouse import AS_OF, BROKEN, BROKEN_EVERY, EARLY_CUTOFF
from starloom.schemas import CALENDAR_MONTHS, FEATURE_SEED, NOT_NULL, UNIQUE_KEYS, VARCHAR_LIMITS

_AS_OF = f"DATE '{AS_OF.isoformat()}'"
_CUT = f"'{EARLY_CUTOFF}'"

_FEATURE_CASE = "CASE k % 8 " + " ".join(
    f"WHEN {i} THEN '{fid}'" for i, (fid, _, _, _) in enumerate(FEATURE_SEED[:-1])
) + f" ELSE '{FEATURE_SEED[-1][0]}' END"

_FEATURE_ROWS = ", ".join(
    f"({i + 1}, '{fid}', '{name}', '{cat}', {'TRUE' if prem else 'FALSE'})"
    for i, (fid, name, cat, prem) in enumerate(FEATURE_SEED)
)

_FEATURE_NAME_CASE = "CASE feature_id " + " ".join(
    f"WHEN '{fid}' THEN '{name}'" for fid, name, _, _ in FEATURE_SEED) + " END"

# Layer CTEs, in dependency order.
CTE = {
    "e1": """e1 AS (
  SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, ts,
         CAST(user_id % 6 AS INT) AS u6, CAST(FLOOR(user_id / 6) AS INT) % 3 AS u3
  FROM events)""",
    "e2": """e2 AS (SELECT *, ts + to_days(CAST(30 * (u3 + least(k % 6, u6)) AS INT)) AS ets FROM e1)""",
    "e3": """e3 AS (
  SELECT *,
    CASE WHEN event_type = 'view' AND k % 10 < 7 THEN 'document_edited'
         WHEN event_type = 'view' AND k % 10 < 9 THEN 'document_shared'
         WHEN event_type = 'view' THEN 'document_deleted'
         WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'document_created'
         WHEN event_type = 'purchase' AND k % 6 = 1 THEN 'subscription_started'
         WHEN event_type = 'purchase' AND k % 6 = 3 THEN 'subscription_upgraded'
         WHEN event_type = 'purchase' THEN 'subscription_cancelled'
         WHEN event_type = 'click' THEN 'feature_used'
         WHEN event_type = 'signup' THEN 'user_login'
         ELSE 'user_logout' END AS etype,
    CASE WHEN event_id % 20 < 12 THEN 'web' WHEN event_id % 20 < 17 THEN 'mobile'
         WHEN event_id % 20 < 19 THEN 'desktop' ELSE 'api' END AS platform
  FROM e2)""",
    "staging": f"""staging AS (
  SELECT 'evt_' || CAST(event_id AS VARCHAR) AS event_id, etype AS event_type, ets AS event_timestamp,
    'usr_' || CAST(user_id AS VARCHAR) AS user_id,
    'ses_' || CAST(user_id AS VARCHAR) || '_' || strftime(ets, '%Y%m%d') AS session_id,
    CASE WHEN etype LIKE 'document%' THEN 'doc_' || CAST(k AS VARCHAR) END AS document_id,
    CASE WHEN etype = 'feature_used' THEN {_FEATURE_CASE} END AS feature_id,
    CASE WHEN etype = 'document_edited' THEN 10 + (k * 36) % 3591
         WHEN etype = 'feature_used' THEN 5 + (k * 7) % 296 END AS duration_seconds,
    CASE WHEN etype = 'document_edited' THEN CAST(event_id * 37 % 5001 AS INT) END AS characters_added,
    platform, 'Mozilla/5.0 (' || platform || ')' AS user_agent,
    '192.168.' || CAST(user_id % 255 + 1 AS VARCHAR) || '.' || CAST(k + 1 AS VARCHAR) AS ip_address,
    CASE WHEN etype IN ('subscription_started', 'subscription_upgraded')
         THEN CASE WHEN k % 4 = 1 THEN 'pro' ELSE 'enterprise' END END AS plan,
    CASE WHEN etype IN ('subscription_started', 'subscription_upgraded')
         THEN CASE WHEN event_id % 2 = 0 THEN 'monthly' ELSE 'annual' END END AS billing_cycle,
    CASE WHEN etype = 'subscription_cancelled'
         THEN CASE event_id % 4 WHEN 0 THEN 'too_expensive' WHEN 1 THEN 'not_using'
                                WHEN 2 THEN 'competitor' ELSE 'other' END END AS reason,
    'batch_' || strftime(ts, '%Y%m%d') AS batch_id
  FROM e3)""",
    "orders_staging": """orders_staging AS (
  SELECT 'ord_' || CAST(o_orderkey AS VARCHAR) AS event_id,
    CASE o_orderstatus WHEN 'F' THEN 'subscription_started' WHEN 'O' THEN 'subscription_upgraded'
         ELSE 'subscription_cancelled' END AS event_type,
    o_orderdate AS event_timestamp, 'cus_' || CAST(o_custkey AS VARCHAR) AS user_id
  FROM orders)""",
    "dim_users": """dim_users AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, user_id || '@example.com' AS email,
         CAST(MIN(event_timestamp) AS DATE) AS signup_date, MIN(event_timestamp) AS first_ts,
         'free' AS current_plan, 'active' AS account_status, TRUE AS is_current
  FROM staging GROUP BY user_id)""",
    "dim_documents": """dim_documents AS (
  SELECT row_number() OVER (ORDER BY document_id) AS document_sk, document_id,
         'Document ' || document_id AS title, MIN(user_id) AS owner_user_id, MIN(event_timestamp) AS created_at
  FROM staging WHERE document_id IS NOT NULL GROUP BY document_id)""",
    "dim_features": f"""dim_features AS (
  SELECT * FROM (VALUES {_FEATURE_ROWS}) t(feature_sk, feature_id, feature_name, feature_category, is_premium))""",
    "dim_date": """dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date,
         CAST(dayofweek(d) AS INT) AS day_of_week,
         rpad(dayname(d), 9, ' ') AS day_name, CAST(weekofyear(d) AS INT) AS week_of_year,
         CAST(month(d) AS INT) AS month, rpad(monthname(d), 9, ' ') AS month_name,
         CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY) t(d))""",
    # An event is a fact if it lies in the calendar and its user is known;
    # each key is looked up on its own.
    "fact_events": """fact_events AS (
  SELECT s.*, year(event_timestamp) * 10000 + month(event_timestamp) * 100 + day(event_timestamp) AS date_key,
         (SELECT u.user_sk FROM dim_users u WHERE u.user_id = s.user_id) AS user_sk,
         (SELECT d.document_sk FROM dim_documents d WHERE d.document_id = s.document_id) AS document_sk,
         (SELECT f.feature_sk FROM dim_features f WHERE f.feature_id = s.feature_id) AS feature_sk
  FROM staging s
  WHERE event_timestamp >= TIMESTAMP '2020-01-01' AND event_timestamp < TIMESTAMP '2027-01-01'
    AND EXISTS (SELECT 1 FROM dim_users u WHERE u.user_id = s.user_id))""",
    # A user's day as the list of its events, measured list by list.
    "daily": """daily AS (
  SELECT activity_date, user_sk, len(kinds) AS total_events, len([k FOR k IN kinds IF k = 'user_login']) AS login_count,
         len([k FOR k IN kinds IF k = 'document_edited']) AS documents_edited,
         len([k FOR k IN kinds IF k = 'document_created']) AS documents_created,
         COALESCE(list_sum(seconds), 0) AS total_active_seconds, CAST(list_unique(features) AS BIGINT) AS distinct_features_used
  FROM (SELECT event_timestamp::DATE AS activity_date, user_sk, list(event_type) AS kinds,
               list(duration_seconds) AS seconds, list(feature_sk) AS features
        FROM fact_events GROUP BY ALL))""",
    "daily_early": """daily_early AS (
  SELECT CAST(event_timestamp AS DATE) AS activity_date, user_sk
  FROM fact_events WHERE batch_id <= """ + _CUT + """ GROUP BY 1, 2)""",
    # Every user once per month with activity (once with none, if never
    # active): a group then has as many users as rows.
    "user_months": """user_months AS (
  SELECT DISTINCT u.user_sk, date_trunc('month', u.first_ts)::DATE AS cohort_month,
         date_trunc('month', f.event_timestamp)::DATE AS activity_month
  FROM dim_users u LEFT JOIN fact_events f USING (user_sk))""",
    "retention": """retention AS (
  SELECT cohort_month, activity_month,
         CAST((year(activity_month) - year(cohort_month)) * 12 + month(activity_month) - month(cohort_month) AS BIGINT)
           AS months_since_signup,
         COUNT(*) AS cohort_size, COUNT(activity_month) AS retained_users,
         CASE WHEN activity_month IS NULL THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS retention_rate
  FROM user_months GROUP BY cohort_month, activity_month)""",
    "funnel": """funnel AS (
  SELECT feature_name, feature_category, is_premium AS is_premium_feature, len(list_distinct(users)) AS unique_users,
         len(users) AS total_uses, CAST(ROUND(list_avg(seconds), 2) AS DOUBLE) AS avg_duration_seconds,
         list_min(times) AS first_used_at, list_max(times) AS last_used_at
  FROM dim_features JOIN (
    SELECT feature_sk, list(user_sk) AS users, list(duration_seconds) AS seconds, list(event_timestamp) AS times
    FROM fact_events WHERE event_type = 'feature_used' AND feature_sk IS NOT NULL GROUP BY feature_sk) USING (feature_sk))""",
    # Risk by the span of days that the silence falls into.
    "churn": """churn AS (
  SELECT user_sk, user_id, current_plan, last_active_date, silent AS days_since_last_activity, lifetime_events,
         risk AS churn_risk_category
  FROM (SELECT u.user_sk, u.user_id, u.current_plan, MAX(f.event_timestamp)::DATE AS last_active_date,
               CAST(""" + _AS_OF + """ - MAX(f.event_timestamp)::DATE AS BIGINT) AS silent, COUNT(*) AS lifetime_events
        FROM fact_events f JOIN dim_users u USING (user_sk) WHERE u.account_status = 'active' GROUP BY ALL)
  JOIN (VALUES (-1000000, 7, 'active'), (8, 14, 'low'), (15, 30, 'medium'), (31, 1000000, 'high')) r(least, most, risk)
    ON silent BETWEEN least AND most)""",
    "sub_changes": """sub_changes AS (
  SELECT user_id, event_timestamp AS change_ts, event_id AS change_id,
         CASE WHEN event_type = 'subscription_cancelled' THEN 'free' ELSE plan END AS plan,
         CASE WHEN event_type = 'subscription_cancelled' THEN 'cancelled' ELSE 'active' END AS account_status,
         batch_id
  FROM staging WHERE event_type LIKE 'subscription_%')""",
    "plan_points": """plan_points AS (
  SELECT user_id, plan, account_status, change_ts, change_id FROM (
    SELECT *, lag(plan) OVER w AS prev_plan, lag(account_status) OVER w AS prev_status
    FROM (SELECT user_id, MIN(event_timestamp) AS change_ts, '' AS change_id, 'free' AS plan,
                 'active' AS account_status FROM staging GROUP BY user_id
          UNION ALL SELECT user_id, change_ts, change_id, plan, account_status FROM sub_changes) x
    WINDOW w AS (PARTITION BY user_id ORDER BY change_ts, change_id))
  WHERE prev_plan IS NULL OR plan IS DISTINCT FROM prev_plan OR account_status IS DISTINCT FROM prev_status)""",
    "plan_history": """plan_history AS (
  SELECT user_id, plan, account_status, change_ts AS valid_from,
         lead(change_ts) OVER (PARTITION BY user_id ORDER BY change_ts, change_id) AS valid_to
  FROM plan_points)""",
    # Events with one defect each, by the remainder of their number; a
    # malformed document has no field.
    "broken": f"""broken AS (
  SELECT k, event_id AS raw_id, CASE WHEN k NOT IN ({BROKEN['malformed_json']}, {BROKEN['missing_event_id']}) THEN event_id END AS event_id,
         CASE WHEN k NOT IN ({BROKEN['malformed_json']}, {BROKEN['missing_event_type']}) THEN event_type END AS event_type,
         CASE WHEN k NOT IN ({BROKEN['malformed_json']}, {BROKEN['bad_timestamp']}) THEN event_timestamp END AS event_timestamp,
         CASE WHEN k NOT IN ({BROKEN['malformed_json']}, {BROKEN['missing_user_id']}) THEN user_id END AS user_id,
         CASE WHEN k <> {BROKEN['malformed_json']} THEN session_id END AS session_id,
         CASE WHEN k <> {BROKEN['malformed_json']} THEN document_id END AS document_id,
         CASE WHEN k <> {BROKEN['malformed_json']} THEN feature_id END AS feature_id,
         CASE k WHEN {BROKEN['too_long_platform']} THEN repeat('x', 60) WHEN {BROKEN['malformed_json']} THEN NULL ELSE platform END AS platform,
         CASE k WHEN {BROKEN['bad_ip']} THEN '300.1.2.3' WHEN {BROKEN['malformed_json']} THEN NULL ELSE ip_address END AS ip_address,
         duration_seconds AS given_seconds, batch_id,
         unnest(CASE k WHEN {BROKEN['duplicate_event_id']} THEN [1, 2] ELSE [1] END) AS copy
  FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) % {BROKEN_EVERY} AS k FROM staging))""",
}

_ORDER = list(CTE)


def with_ctes(*names: str) -> str:
    """WITH clause holding the named CTEs and everything before them."""
    last = max(_ORDER.index(n) for n in names)
    needed = _ORDER[: last + 1]
    return "WITH " + ",\n".join(CTE[n] for n in needed) + "\n"


def _w(names: str, body: str) -> str:
    return with_ctes(*names.split()) + body


ORACLE: dict[str, str] = {}

# ------------------------------------------------------------------ sources
ORACLE["raw_ingest"] = _w("staging", f"""
SELECT event_id, batch_id FROM staging WHERE batch_id > {_CUT}""")

ORACLE["raw_payload_json"] = _w("staging", f"""
SELECT event_id, batch_id, event_type,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS event_timestamp_text,
       user_id, document_id, CAST(duration_seconds AS BIGINT) AS duration_seconds,
       CASE WHEN feature_id IS NOT NULL THEN {_FEATURE_NAME_CASE} END AS feature_name,
       platform, ip_address
FROM staging""")

ORACLE["batch_stamp"] = _w("staging", """
SELECT 'batch_' || strftime(event_timestamp, '%Y%m%d') AS batch_id, COUNT(*) AS n_events
FROM staging GROUP BY 1""")

ORACLE["batch_inventory"] = _w("staging", """
SELECT batch_id, event_type, COUNT(*) AS n_events FROM staging GROUP BY 1, 2""")

# ------------------------------------------------------------------ staging
ORACLE["staging_parse"] = _w("staging", """
SELECT event_id, event_type, event_timestamp, user_id, session_id, batch_id FROM staging""")

ORACLE["staging_nested"] = _w("staging", """
SELECT event_id, document_id, feature_id, platform, user_agent, ip_address FROM staging""")

ORACLE["staging_duration"] = _w("staging", """
SELECT event_id, event_type, CAST(duration_seconds AS BIGINT) AS duration_seconds FROM staging""")

ORACLE["staging_casts"] = _w("staging", """
SELECT event_id, event_timestamp, CAST(duration_seconds AS BIGINT) AS duration_seconds,
       CAST(characters_added AS BIGINT) AS characters_added FROM staging""")

ORACLE["staging_properties"] = _w("staging", f"""
SELECT event_id, document_id AS prop_document_id,
       CASE WHEN feature_id IS NOT NULL THEN {_FEATURE_NAME_CASE} END AS prop_feature_name,
       plan AS prop_plan, billing_cycle AS prop_billing_cycle, reason AS prop_reason
FROM staging""")

ORACLE["ip_valid"] = _w("broken", """
SELECT event_id, ip_address, ip_address LIKE '192.168.%' AS ip_valid FROM broken""")

ORACLE["staging_increment"] = _w("staging", f"""
SELECT event_id, batch_id FROM staging WHERE batch_id > {_CUT}""")

ORACLE["staging_contract"] = _w("broken", """
SELECT 'not_null' AS rule, 'event_id' AS column_name,
       CAST(COUNT(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS violations FROM broken
UNION ALL SELECT 'not_null', 'event_type', COUNT(*) FILTER (WHERE event_type IS NULL) FROM broken
UNION ALL SELECT 'not_null', 'event_timestamp', COUNT(*) FILTER (WHERE event_timestamp IS NULL) FROM broken
UNION ALL SELECT 'not_null', 'user_id', COUNT(*) FILTER (WHERE user_id IS NULL) FROM broken
UNION ALL SELECT 'not_null', 'batch_id', COUNT(*) FILTER (WHERE batch_id IS NULL) FROM broken
UNION ALL SELECT 'not_null', 'processed_at', 0
UNION ALL SELECT 'unique', 'event_id', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
FROM (SELECT event_id, COUNT(*) AS n FROM broken WHERE event_id IS NOT NULL GROUP BY event_id HAVING COUNT(*) > 1)""")

ORACLE["staging_quarantine"] = _w("broken", f"""
, reasons(reason, k) AS (VALUES {", ".join(f"('{r}', {k})" for r, k in BROKEN.items())})
SELECT reason, CAST(SUM(n) AS BIGINT) AS n_rows FROM (
  SELECT COALESCE(r.reason, 'ok') AS reason, CASE WHEN r.reason = 'duplicate_event_id' THEN copy - 1 ELSE 1 END AS n
  FROM broken b LEFT JOIN reasons r ON r.k = b.k AND (r.reason <> 'bad_integer' OR given_seconds IS NOT NULL)
  UNION ALL SELECT 'ok', COUNT(DISTINCT event_id) FROM broken WHERE k = (SELECT k FROM reasons WHERE reason = 'duplicate_event_id'))
GROUP BY reason""")

# --------------------------------------------------------------- dimensions
ORACLE["dim_date"] = _w("fact_events", """
SELECT CAST(date_key AS BIGINT) AS date_key, full_date, CAST(day_of_week AS BIGINT) AS day_of_week, day_name,
       CAST(week_of_year AS BIGINT) AS week_of_year, CAST(month AS BIGINT) AS month, month_name,
       CAST(quarter AS BIGINT) AS quarter, CAST(year AS BIGINT) AS year, is_weekend,
       (SELECT COUNT(*) FROM fact_events f WHERE f.date_key = dim_date.date_key) AS n_events
FROM dim_date""")

ORACLE["dim_features"] = _w("fact_events", """
SELECT CAST(f.feature_sk AS BIGINT) AS feature_sk, f.feature_id, f.feature_name, f.feature_category, f.is_premium,
       CAST(COALESCE(u.n, 0) AS BIGINT) AS n_events
FROM dim_features f
LEFT JOIN (SELECT feature_sk, COUNT(*) AS n FROM fact_events WHERE feature_sk IS NOT NULL GROUP BY 1) u
  ON f.feature_sk = u.feature_sk""")

ORACLE["dim_users"] = _w("dim_users", """
SELECT user_id, email, signup_date, current_plan, account_status, is_current FROM dim_users""")

ORACLE["dim_documents"] = _w("dim_documents", """
SELECT document_id, title, owner_user_id, created_at FROM dim_documents""")

ORACLE["surrogate_keys"] = _w("dim_documents", """
SELECT 'dim_users' AS dimension, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_keys,
       CAST(1 AS BIGINT) AS min_key, COUNT(*) AS max_key FROM dim_users
UNION ALL
SELECT 'dim_documents', COUNT(*), COUNT(DISTINCT document_id), 1, COUNT(*) FROM dim_documents""")

ORACLE["dim_users_scd2"] = _w("plan_history sub_changes", """
SELECT ph.user_id, ph.plan AS current_plan, ph.account_status, ph.valid_to IS NULL AS is_current,
       ph.valid_from AS effective_date, ph.valid_to AS end_date
FROM plan_history ph""")

# -------------------------------------------------------------------- facts
ORACLE["fact_events"] = _w("fact_events", """
SELECT event_id, user_id, document_id, feature_id, document_sk IS NOT NULL AS has_document_key,
       feature_sk IS NOT NULL AS has_feature_key, CAST(date_key AS BIGINT) AS date_key, event_type,
       session_id, platform, event_timestamp, CAST(duration_seconds AS BIGINT) AS duration_seconds,
       CAST(characters_added AS BIGINT) AS characters_added
FROM fact_events""")

ORACLE["fact_events_dropped"] = _w("dim_date", """
, everything AS (SELECT event_id, user_id, event_timestamp FROM staging
                 UNION ALL SELECT event_id, user_id, event_timestamp FROM orders_staging)
SELECT 'no_current_user' AS reason, COUNT(*) AS n_events FROM everything WHERE CAST(substr(user_id, 5) AS BIGINT) % 7 = 3
UNION ALL
SELECT 'date_out_of_range', COUNT(*) FROM everything e
WHERE CAST(strftime(e.event_timestamp, '%Y%m%d') AS INT) NOT IN (SELECT date_key FROM dim_date)""")

_DAILY_OUT = """SELECT d.activity_date, u.user_id, d.total_events, d.login_count, d.documents_edited,
       d.documents_created, CAST(d.total_active_seconds AS BIGINT) AS total_active_seconds,
       d.distinct_features_used"""

ORACLE["fact_daily_user_activity"] = _w("daily", _DAILY_OUT + """
FROM daily d JOIN dim_users u ON d.user_sk = u.user_sk""")

ORACLE["daily_upsert"] = _w("daily_early", _DAILY_OUT + """,
       CASE WHEN e.user_sk IS NULL THEN 'inserted' ELSE 'updated' END AS action
FROM daily d JOIN dim_users u ON d.user_sk = u.user_sk
LEFT JOIN daily_early e ON d.activity_date = e.activity_date AND d.user_sk = e.user_sk""")

ORACLE["daily_incremental"] = ORACLE["fact_daily_user_activity"]

# -------------------------------------------------------------------- views
_RET_OUT = """SELECT cohort_month, activity_month, months_since_signup, cohort_size, retained_users,
       retention_rate"""

ORACLE["retention_cohorts"] = _w("retention", _RET_OUT + " FROM retention")

ORACLE["retention_cohorts_true"] = _w("retention", """
SELECT r.cohort_month, r.activity_month, r.months_since_signup, s.n AS cohort_size, r.retained_users,
       CAST(ROUND(100.0 * r.retained_users / s.n, 2) AS DOUBLE) AS retention_rate
FROM retention r
JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, COUNT(*) AS n
      FROM dim_users WHERE is_current GROUP BY 1) s ON r.cohort_month = s.cohort_month""")

ORACLE["feature_adoption_funnel"] = _w("funnel", "SELECT * FROM funnel")

_CHURN_OUT = """SELECT user_id, current_plan, last_active_date, days_since_last_activity, lifetime_events,
       churn_risk_category"""

ORACLE["churn_risk_scores"] = _w("churn", _CHURN_OUT + " FROM churn")

# Activity by user_id over all versions; the current version's state
# comes from the early subscription events (SCD2 between the two loads).
ORACLE["key_stability"] = _w("sub_changes", f"""
, early_state AS (
  SELECT user_id, plan, account_status FROM (
    SELECT user_id, plan, account_status,
           row_number() OVER (PARTITION BY user_id ORDER BY change_ts DESC, change_id DESC) AS rn
    FROM sub_changes WHERE batch_id <= {_CUT}) WHERE rn = 1),
  per_user AS (
  SELECT user_id, MAX(CAST(event_timestamp AS DATE)) AS last_active_date, COUNT(*) AS lifetime_events
  FROM staging WHERE event_timestamp >= TIMESTAMP '2020-01-01' AND event_timestamp < TIMESTAMP '2027-01-01'
  GROUP BY user_id)
SELECT p.user_id, COALESCE(s.plan, 'free') AS current_plan, p.last_active_date,
       CAST({_AS_OF} - p.last_active_date AS BIGINT) AS days_since_last_activity,
       CAST(p.lifetime_events AS BIGINT) AS lifetime_events,
       CASE WHEN {_AS_OF} - p.last_active_date > 30 THEN 'high'
            WHEN {_AS_OF} - p.last_active_date > 14 THEN 'medium'
            WHEN {_AS_OF} - p.last_active_date > 7 THEN 'low' ELSE 'active' END AS churn_risk_category
FROM per_user p LEFT JOIN early_state s ON p.user_id = s.user_id
WHERE COALESCE(s.account_status, 'active') = 'active'""")

# ------------------------------------------------------------------ reports
ORACLE["feature_avg_uses"] = _w("fact_events", """
SELECT (SELECT feature_name FROM dim_features d WHERE d.feature_sk = e.feature_sk) AS feature_name, COUNT(*) AS total_uses,
       COUNT(DISTINCT user_id) AS unique_users,
       CAST(ROUND(CAST(COUNT(*) AS DECIMAL(20, 0)) / COUNT(DISTINCT user_id), 1) AS DOUBLE) AS avg_uses_per_user
FROM fact_events e WHERE event_type = 'feature_used' AND feature_sk IS NOT NULL GROUP BY feature_sk""")

ORACLE["churn_distribution"] = _w("churn", """
, n AS (SELECT COUNT(*) AS everyone FROM churn)
SELECT churn_risk_category, COUNT(*) AS user_count, CAST(ROUND(100.0 * COUNT(*) / everyone, 1) AS DOUBLE) AS percentage
FROM churn, n GROUP BY churn_risk_category, everyone""")

ORACLE["dau_trend"] = _w("fact_events", f"""
SELECT event_timestamp::DATE AS activity_date, COUNT(DISTINCT user_id) AS daily_active_users, COUNT(*) AS total_events
FROM fact_events WHERE event_timestamp::DATE >= {_AS_OF} - 30 GROUP BY 1""")

_LAYERS = """, layers AS (
  SELECT 'Raw' AS layer, COUNT(*) AS record_count FROM staging
  UNION ALL SELECT 'Staging', COUNT(*) FROM staging
  UNION ALL SELECT 'Core', COUNT(*) FROM fact_events)
"""

ORACLE["layer_counts"] = _w("fact_events", _LAYERS + "SELECT layer, record_count FROM layers")

ORACLE["layer_pct_first"] = _w("fact_events", _LAYERS + """
SELECT layer, record_count, CAST(ROUND(100.0 * record_count / base, 2) AS DOUBLE) AS pct_of_raw
FROM layers, (SELECT record_count AS base FROM layers ORDER BY layer LIMIT 1)""")

ORACLE["layer_pct_of_raw"] = _w("fact_events", _LAYERS + """
SELECT layer, record_count,
       CAST(ROUND(100.0 * record_count / (SELECT record_count FROM layers WHERE layer = 'Raw'), 2) AS DOUBLE) AS pct_of_raw
FROM layers""")

ORACLE["duplicate_events"] = _w("broken", """
SELECT DISTINCT event_id, n_rows FROM (SELECT event_id, COUNT(*) OVER (PARTITION BY event_id) AS n_rows FROM broken)
WHERE n_rows > 1""")

ORACLE["table_counts"] = _w("funnel", """
SELECT 'dim_date' AS table_name, COUNT(*) AS n_rows FROM dim_date
UNION ALL SELECT 'fact_events', COUNT(*) FROM fact_events
UNION ALL SELECT 'feature_adoption_funnel', COUNT(*) FROM funnel""")

ORACLE["retention_matrix"] = _w("retention", f"""
, rt AS (
  SELECT r.cohort_month, r.months_since_signup,
         CAST(ROUND(100.0 * r.retained_users / s.n, 2) AS DOUBLE) AS rate
  FROM retention r
  JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, COUNT(*) AS n
        FROM dim_users WHERE is_current GROUP BY 1) s ON r.cohort_month = s.cohort_month
  WHERE r.months_since_signup IS NOT NULL)
SELECT cohort_month, {", ".join(f'MAX(rate) FILTER (WHERE months_since_signup = {m}) AS "{m}"' for m in range(CALENDAR_MONTHS))}
FROM rt GROUP BY cohort_month""")

ORACLE["total_users"] = _w("dim_users", "SELECT COUNT(*) AS total_users FROM dim_users WHERE is_current")

# ------------------------------------------------------------------ quality
# Tables by the name that rules are declared under; the load stamps and the
# facts' own key are set by the load and exist in no query here.
_RULE_TABLES = {"raw_events": "raw_rows", "staging_events": "broken", "fact_daily_user_activity": "daily",
                "user_retention_cohorts": "retention", "feature_adoption_funnel": "funnel", "churn_risk_scores": "churn"}
_RAW_ROWS = ", raw_rows AS (SELECT raw_id AS event_id, raw_id AS raw_payload, batch_id FROM broken)\n"
_LOAD_SET = {"loaded_at", "processed_at", "created_at", "updated_at", "effective_date", "event_sk"}


def _rule(kind: str, label: str, name: str, count: str, table: str) -> str:
    return f"SELECT '{label}' AS table_name, '{kind}' AS rule, '{name}' AS column_name, CAST({count} AS BIGINT) AS violations {table}"


ORACLE["chk_not_null"] = _w("daily broken", _RAW_ROWS + "\nUNION ALL ".join(
    _rule("not_null", t, c, "0", "") if c in _LOAD_SET else
    _rule("not_null", t, c, f"COUNT(*) FILTER (WHERE {c} IS NULL)", f"FROM {_RULE_TABLES.get(t, t)}")
    for t, columns in NOT_NULL.items() for c in columns))


def _unique(table: str, keys: list[str], label: str | None = None) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return (f"SELECT '{label or table}' AS table_name, 'unique' AS rule, '{','.join(keys)}' AS column_name, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations "
            f"FROM (SELECT {k}, COUNT(*) AS n FROM {table} WHERE {nn} GROUP BY {k})")


ORACLE["chk_unique"] = _w("daily retention funnel churn broken", _RAW_ROWS + "\nUNION ALL ".join(
    _rule("unique", t, ",".join(keys), "0", "") if set(keys) & _LOAD_SET else _unique(_RULE_TABLES.get(t, t), keys, t)
    for t, all_keys in UNIQUE_KEYS.items() for keys in all_keys))

ORACLE["chk_one_current"] = _w("dim_users", """
SELECT 'dim_users' AS table_name, 'one_current' AS rule, 'user_id' AS column_name,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations
FROM (SELECT user_id, CASE CAST(substr(user_id, 5) AS BIGINT) % 10 WHEN 1 THEN 2 ELSE 1 END AS n FROM dim_users WHERE is_current)""")

ORACLE["chk_foreign_keys"] = _w("daily", """
SELECT 'fact_events' AS table_name, 'foreign_key' AS rule, 'user_sk' AS column_name,
       CAST(COUNT(*) FILTER (WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM dim_users WHERE CAST(substr(user_id, 5) AS BIGINT) % 10 <> 2)) AS BIGINT) AS violations
FROM fact_events
UNION ALL SELECT 'fact_events', 'foreign_key', 'document_sk',
       COUNT(*) FILTER (WHERE document_sk IS NOT NULL AND document_sk NOT IN (SELECT document_sk FROM dim_documents WHERE CAST(substr(document_id, 5) AS BIGINT) % 10 <> 3))
FROM fact_events
UNION ALL SELECT 'fact_events', 'foreign_key', 'feature_sk',
       COUNT(*) FILTER (WHERE feature_sk IS NOT NULL AND feature_sk NOT IN (SELECT feature_sk FROM dim_features WHERE feature_id <> 'comments'))
FROM fact_events
UNION ALL SELECT 'fact_events', 'foreign_key', 'date_key',
       COUNT(*) FILTER (WHERE date_key IS NULL OR date_key NOT IN (SELECT date_key FROM dim_date WHERE month <> 2))
FROM fact_events
UNION ALL SELECT 'fact_daily_user_activity', 'foreign_key', 'user_sk',
       COUNT(*) FILTER (WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM dim_users WHERE CAST(substr(user_id, 5) AS BIGINT) % 10 <> 2))
FROM daily""")


def _lengths(table: str, limits: dict[str, int], label: str) -> str:
    parts = [f"SELECT '{label}' AS table_name, 'max_length' AS rule, '{c}' AS column_name, "
             f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violations FROM {table}"
             for c, n in limits.items()]
    return "\nUNION ALL ".join(parts)


ORACLE["chk_lengths"] = _w("fact_events broken", _RAW_ROWS + "\nUNION ALL ".join(
    _lengths(_RULE_TABLES.get(t, t), limits, t) for t, limits in VARCHAR_LIMITS.items()))

ORACLE["chk_reconcile"] = _w("daily", """
SELECT COALESCE(f.activity_date, d.activity_date) AS activity_date,
       CAST(COALESCE(f.n, 0) AS BIGINT) AS fact_events, CAST(COALESCE(d.n, 0) AS BIGINT) AS daily_events,
       CAST(COALESCE(f.n, 0) - COALESCE(d.n, 0) AS BIGINT) AS difference
FROM (SELECT CAST(event_timestamp AS DATE) AS activity_date, COUNT(*) AS n FROM fact_events
      WHERE CAST(substr(event_id, 5) AS BIGINT) % 97 <> 0 GROUP BY 1) f
FULL OUTER JOIN (SELECT activity_date, SUM(total_events) AS n FROM daily GROUP BY 1) d
  ON f.activity_date = d.activity_date""")

# ------------------------------------------------------------------ profiles
def _mix_sql(key: str, weights: list[tuple[str, int]]) -> str:
    rows = ", ".join(f"('{k}', {w})" for k, w in weights)
    return f"""
, counts AS (SELECT {key}, COUNT(*) AS n FROM staging GROUP BY {key}),
  share AS (SELECT {key}, n, ROUND(100.0 * n / SUM(n) OVER (), 2) AS pct FROM counts),
  expected AS (SELECT * FROM (VALUES {rows}) t({key}, w))
SELECT COALESCE(s.{key}, e.{key}) AS {key}, CAST(COALESCE(s.n, 0) AS BIGINT) AS n_events,
       CAST(COALESCE(s.pct, 0) AS DOUBLE) AS actual_pct, CAST(e.w AS DOUBLE) AS expected_pct
FROM share s FULL OUTER JOIN expected e ON s.{key} = e.{key}"""


def _profile_sql() -> None:
    from starloom.schemas import EVENT_TYPE_WEIGHTS, PLATFORM_WEIGHTS
    ORACLE["event_mix"] = _w("staging", _mix_sql("event_type", EVENT_TYPE_WEIGHTS))
    ORACLE["platform_mix"] = _w("staging", _mix_sql("platform", PLATFORM_WEIGHTS))


_profile_sql()

ORACLE["hour_profile"] = _w("staging", """
SELECT CAST(h.hour AS BIGINT) AS hour, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_events
FROM range(24) h(hour)
LEFT JOIN (SELECT hour(event_timestamp) AS hour, COUNT(*) AS n FROM staging GROUP BY 1) c ON h.hour = c.hour""")

ORACLE["volume_trend"] = _w("fact_events", """
, per_day AS (
  SELECT f.date_key, d.full_date, d.is_weekend, COUNT(*) AS n
  FROM fact_events f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3)
SELECT full_date AS activity_date, is_weekend, CAST(n AS BIGINT) AS n_events,
       ROUND(AVG(n) OVER (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS trailing_7d_mean,
       ROUND(AVG(CASE WHEN is_weekend THEN n END) OVER () / AVG(CASE WHEN NOT is_weekend THEN n END) OVER (), 4)
         AS weekend_ratio
FROM per_day""")

ORACLE["session_rollup"] = _w("staging", """
SELECT session_id, MIN(user_id) AS user_id, COUNT(*) AS n_events, MIN(event_timestamp) AS session_start,
       MAX(event_timestamp) AS session_end,
       CAST(trunc((epoch_us(MAX(event_timestamp)) - epoch_us(MIN(event_timestamp))) / 1000000) AS BIGINT)
         AS session_seconds
FROM staging WHERE session_id IS NOT NULL GROUP BY session_id""")

ORACLE["subscription_lifecycle"] = _w("staging", """
SELECT event_type, plan, billing_cycle, reason, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users
FROM staging WHERE event_type LIKE 'subscription_%' GROUP BY 1, 2, 3, 4""")

ORACLE["plan_history"] = _w("plan_history sub_changes", """
SELECT user_id, plan, account_status, valid_from, valid_to FROM plan_history""")

ORACLE["stream_ingest"] = _w("staging", "SELECT event_id, batch_id, event_type, user_id FROM staging")

# What one run (all batches) stores; the rollups merged.
_STORED = """
SELECT 'raw_events' AS table_name, COUNT(*) AS n_rows FROM staging
UNION ALL SELECT 'staging_events', COUNT(*) FROM staging
UNION ALL SELECT 'dim_users', COUNT(*) FROM dim_users
UNION ALL SELECT 'dim_documents', COUNT(*) FROM dim_documents
UNION ALL SELECT 'dim_features', COUNT(*) FROM dim_features
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
UNION ALL SELECT 'fact_events', COUNT(*) FROM fact_events"""

_COUNTS = _w("daily retention funnel churn", _STORED + """
UNION ALL SELECT 'fact_daily_user_activity', COUNT(*) FROM daily
UNION ALL SELECT 'feature_user_usage', COUNT(*) FROM (
  SELECT DISTINCT feature_sk, user_sk FROM fact_events WHERE event_type = 'feature_used')
UNION ALL SELECT 'user_activity', COUNT(DISTINCT user_sk) FROM fact_events
UNION ALL SELECT 'user_month_activity', COUNT(*) FROM (SELECT DISTINCT user_sk, date_trunc('month', event_timestamp) FROM fact_events)
UNION ALL SELECT 'user_retention_cohorts', COUNT(*) FROM retention
UNION ALL SELECT 'feature_adoption_funnel', COUNT(*) FROM funnel
UNION ALL SELECT 'churn_risk_scores', COUNT(*) FROM churn
UNION ALL SELECT 'churn_risk_by_user', COUNT(*) FROM churn""")

ORACLE["daily_load"] = _COUNTS
ORACLE["reset_rebuild"] = _COUNTS

# Rows that two runs write: the early batches, then the rest. Dimensions and
# event layers insert, rollups add a part per run, the second run replaces
# the months of user-day facts that it touches, views are written by both runs.
ORACLE["run_summary"] = _w("daily daily_early", f"""
, runs(run) AS (VALUES ('early'), ('late'), ('all')),
  seen AS (
  SELECT run, s.* FROM staging s JOIN runs
    ON run = 'all' OR (run = 'early') = (batch_id <= {_CUT})),
  placed AS (
  SELECT *, date_trunc('month', event_timestamp) AS month FROM seen
  WHERE event_timestamp >= TIMESTAMP '2020-01-01' AND event_timestamp < TIMESTAMP '2027-01-01'),
  cohorts AS (SELECT run, user_id, date_trunc('month', MIN(event_timestamp)) AS cohort FROM seen GROUP BY 1, 2),
  months AS (SELECT DISTINCT run, user_id, month FROM placed),
  written AS (
  SELECT 'fact_daily_user_activity' AS table_name, 'early' AS run, COUNT(*) AS n FROM daily_early
  UNION ALL SELECT 'fact_daily_user_activity', 'late', COUNT(*) FROM daily
    WHERE date_trunc('month', activity_date) IN (SELECT month FROM placed WHERE run = 'late')
  UNION ALL SELECT 'feature_user_usage', run, COUNT(*) FROM (
    SELECT DISTINCT run, feature_id, user_id FROM placed WHERE event_type = 'feature_used') GROUP BY run
  UNION ALL SELECT 'user_activity', run, COUNT(DISTINCT user_id) FROM placed GROUP BY run
  UNION ALL SELECT 'user_month_activity', run, COUNT(*) FROM months GROUP BY run
  UNION ALL SELECT 'user_retention_cohorts', run, COUNT(*) FROM (
    SELECT DISTINCT c.run, cohort, month FROM cohorts c LEFT JOIN months m ON m.run = c.run AND m.user_id = c.user_id) GROUP BY run
  UNION ALL SELECT 'feature_adoption_funnel', run, COUNT(DISTINCT p.feature_id) FROM placed p
    JOIN dim_features d ON d.feature_id = p.feature_id WHERE event_type = 'feature_used' GROUP BY run
  UNION ALL SELECT 'churn_risk_scores', run, COUNT(DISTINCT user_id) FROM placed GROUP BY run
  UNION ALL SELECT 'churn_risk_by_user', run, COUNT(DISTINCT user_id) FROM placed GROUP BY run)
{_STORED.strip()}
UNION ALL SELECT table_name, CAST(SUM(n) AS BIGINT) FROM written
  WHERE run = 'early' OR run = CASE WHEN table_name IN (
    'user_retention_cohorts', 'feature_adoption_funnel', 'churn_risk_scores', 'churn_risk_by_user') THEN 'all' ELSE 'late' END
  GROUP BY table_name""")

ORACLE["stored_user_versions"] = ORACLE["dim_users_scd2"]
