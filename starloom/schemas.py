"""Declared schemas, fixed values and limits of the warehouse layers.

Nothing in the warehouse is inferred: every layer has a StructType here and
every reader applies it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# --------------------------------------------------------------------------

# Feature seed rows (feature_id, feature_name, feature_category, is_premium),
# in their seed order; feature_sk is 1..8 in this order.
FEATURE_SEED = [
    ("real_time_collab", "Real-time Collaboration", "collaboration", True),
    ("comments", "Comments", "collaboration", False),
    ("version_history", "Version History", "editing", True),
    ("export_pdf", "Export to PDF", "editing", False),
    ("templates", "Templates", "editing", False),
    ("cloud_storage", "Cloud Storage", "storage", False),
    ("advanced_search", "Advanced Search", "analytics", True),
    ("team_analytics", "Team Analytics", "analytics", True),
]

# Calendar covered by dim_date (inclusive): 2,557 days.
CALENDAR_START = _dt.date(2020, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)

# Defaults written for a new user row.
DEFAULT_PLAN = "free"
DEFAULT_STATUS = "active"
EMAIL_DOMAIN = "@example.com"
DOCUMENT_TITLE_PREFIX = "Document "

# Churn thresholds in days: > 30 high, > 14 medium, > 7 low, else active.
CHURN_HIGH_DAYS = 30
CHURN_MEDIUM_DAYS = 14
CHURN_LOW_DAYS = 7

# Event type weights of the product's event model (share in percent).
EVENT_TYPE_WEIGHTS = [
    ("document_edited", 35),
    ("document_created", 10),
    ("user_login", 15),
    ("feature_used", 20),
    ("document_shared", 8),
    ("user_logout", 5),
    ("subscription_started", 2),
    ("subscription_upgraded", 3),
    ("subscription_cancelled", 1),
    ("document_deleted", 1),
]

# Platform weights (percent).
PLATFORM_WEIGHTS = [("web", 60), ("mobile", 25), ("desktop", 10), ("api", 5)]

# Months of the calendar (2020 to 2026): the span that a cohort can be followed.
CALENDAR_MONTHS = 84

# Length limits of the VARCHAR columns, per table.
VARCHAR_LIMITS = {
    "raw_events": {"event_id": 255, "batch_id": 255},
    "staging_events": {
        "event_id": 255,
        "event_type": 100,
        "user_id": 255,
        "session_id": 255,
        "document_id": 255,
        "feature_id": 100,
        "platform": 50,
        "batch_id": 255,
    },
    "dim_users": {"user_id": 255, "email": 255, "current_plan": 50, "account_status": 50},
    "dim_documents": {"document_id": 255, "title": 500, "owner_user_id": 255},
    "dim_features": {"feature_id": 100, "feature_name": 255, "feature_category": 100},
    "dim_date": {"day_name": 10, "month_name": 10},
    "fact_events": {"event_id": 255, "event_type": 100, "session_id": 255, "platform": 50},
}

# NOT NULL columns, per table.
NOT_NULL = {
    "raw_events": ["event_id", "raw_payload", "batch_id", "loaded_at"],
    "staging_events": ["event_id", "event_type", "event_timestamp", "user_id", "batch_id", "processed_at"],
    "dim_users": ["user_sk", "user_id", "is_current", "effective_date", "created_at", "updated_at"],
    "dim_documents": ["document_sk", "document_id", "updated_at"],
    "dim_features": ["feature_sk", "feature_id", "is_premium", "created_at"],
    "dim_date": ["date_key", "full_date"],
    "fact_events": ["event_sk", "event_id", "user_sk", "date_key", "event_type", "event_timestamp", "created_at"],
    "fact_daily_user_activity": [
        "activity_date", "user_sk", "total_events", "login_count", "documents_edited",
        "documents_created", "total_active_seconds", "distinct_features_used", "created_at", "updated_at",
    ],
}

# Primary / unique keys, per table.
UNIQUE_KEYS = {
    "raw_events": [["event_id"]],
    "staging_events": [["event_id"]],
    "dim_users": [["user_sk"]],
    "dim_documents": [["document_sk"], ["document_id"]],
    "dim_features": [["feature_sk"], ["feature_id"]],
    "dim_date": [["date_key"]],
    "fact_events": [["event_sk"], ["event_id"]],
    "fact_daily_user_activity": [["activity_date", "user_sk"]],
    "user_retention_cohorts": [["cohort_month", "activity_month"]],
    "feature_adoption_funnel": [["feature_name"]],
    "churn_risk_scores": [["user_sk"]],
}

# Foreign keys of the facts: (fact, column, dimension, dimension column, nullable).
FOREIGN_KEYS = [
    ("fact_events", "user_sk", "dim_users", "user_sk", False),
    ("fact_events", "document_sk", "dim_documents", "document_sk", True),
    ("fact_events", "feature_sk", "dim_features", "feature_sk", True),
    ("fact_events", "date_key", "dim_date", "date_key", False),
    ("fact_daily_user_activity", "user_sk", "dim_users", "user_sk", False),
]

# --------------------------------------------------------------------------
# Layer schemas: column names, types and NOT NULL are fixed values too, as
# are the limits and keys above.
# --------------------------------------------------------------------------

NTZ = T.TimestampNTZType()

RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("raw_payload", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("loaded_at", NTZ, False),
])

STAGING_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_timestamp", NTZ, False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("document_id", T.StringType(), True),
    T.StructField("feature_id", T.StringType(), True),
    T.StructField("duration_seconds", T.IntegerType(), True),
    T.StructField("characters_added", T.IntegerType(), True),
    T.StructField("platform", T.StringType(), True),
    T.StructField("user_agent", T.StringType(), True),
    T.StructField("ip_address", T.StringType(), True),
    T.StructField("properties", T.StringType(), True),
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("processed_at", NTZ, False),
])

DIM_USERS = T.StructType([
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("email", T.StringType(), True),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("current_plan", T.StringType(), True),
    T.StructField("account_status", T.StringType(), True),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("effective_date", NTZ, False),
    T.StructField("end_date", NTZ, True),
    T.StructField("created_at", NTZ, False),
    T.StructField("updated_at", NTZ, False),
    # The change that opened this version; NULL for a user's first one.
    T.StructField("change_id", T.StringType(), True),
])

# Every state change of a user ever seen, also those that opened no version.
USER_CHANGES = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("change_ts", NTZ, False),
    T.StructField("change_id", T.StringType(), False),
    T.StructField("current_plan", T.StringType(), True),
    T.StructField("account_status", T.StringType(), True),
])

DIM_DOCUMENTS = T.StructType([
    T.StructField("document_sk", T.LongType(), False),
    T.StructField("document_id", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("owner_user_id", T.StringType(), True),
    T.StructField("created_at", NTZ, True),
    T.StructField("updated_at", NTZ, False),
])

DIM_FEATURES = T.StructType([
    T.StructField("feature_sk", T.LongType(), False),
    T.StructField("feature_id", T.StringType(), False),
    T.StructField("feature_name", T.StringType(), True),
    T.StructField("feature_category", T.StringType(), True),
    T.StructField("is_premium", T.BooleanType(), False),
    T.StructField("created_at", NTZ, False),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("day_name", T.StringType(), True),
    T.StructField("week_of_year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("month_name", T.StringType(), True),
    T.StructField("quarter", T.IntegerType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("is_weekend", T.BooleanType(), True),
])

FACT_EVENTS = T.StructType([
    T.StructField("event_sk", T.LongType(), False),
    T.StructField("event_id", T.StringType(), False),
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("document_sk", T.LongType(), True),
    T.StructField("feature_sk", T.LongType(), True),
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("platform", T.StringType(), True),
    T.StructField("event_timestamp", NTZ, False),
    T.StructField("duration_seconds", T.IntegerType(), True),
    T.StructField("characters_added", T.IntegerType(), True),
    T.StructField("created_at", NTZ, False),
])

FACT_DAILY = T.StructType([
    T.StructField("activity_date", T.DateType(), False),
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("total_events", T.LongType(), False),
    T.StructField("login_count", T.LongType(), False),
    T.StructField("documents_edited", T.LongType(), False),
    T.StructField("documents_created", T.LongType(), False),
    T.StructField("total_active_seconds", T.LongType(), False),
    T.StructField("distinct_features_used", T.LongType(), False),
    T.StructField("created_at", NTZ, False),
    T.StructField("updated_at", NTZ, False),
])

STAGING_REJECTS = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("batch_id", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("reasons", T.ArrayType(T.StringType()), True),
    T.StructField("n_rows", T.LongType(), True),
    T.StructField("rejected_at", NTZ, True),
    T.StructField("reject_id", T.StringType(), True),
])

# Rollups of the facts: one partial row per key and load.
FEATURE_USER_USAGE = T.StructType([
    T.StructField("feature_sk", T.LongType(), True),
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("dur_sum", T.LongType(), True),
    T.StructField("dur_n", T.LongType(), False),
    T.StructField("first_ts", NTZ, True),
    T.StructField("last_ts", NTZ, True),
])

USER_ACTIVITY = T.StructType([
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("lifetime_events", T.LongType(), False),
    T.StructField("last_active_date", T.DateType(), True),
])

USER_MONTH_ACTIVITY = T.StructType([
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("activity_month", T.DateType(), False),
])

USER_RETENTION_COHORTS = T.StructType([
    T.StructField("cohort_month", T.DateType(), True),
    T.StructField("activity_month", T.DateType(), True),
    T.StructField("months_since_signup", T.LongType(), True),
    T.StructField("cohort_size", T.LongType(), True),
    T.StructField("retained_users", T.LongType(), True),
    T.StructField("retention_rate", T.DecimalType(23, 2), True),
])

FEATURE_ADOPTION_FUNNEL = T.StructType([
    T.StructField("feature_name", T.StringType(), True),
    T.StructField("feature_category", T.StringType(), True),
    T.StructField("is_premium_feature", T.BooleanType(), True),
    T.StructField("unique_users", T.LongType(), True),
    T.StructField("total_uses", T.LongType(), True),
    T.StructField("avg_duration_seconds", T.DecimalType(23, 2), True),
    T.StructField("first_used_at", NTZ, True),
    T.StructField("last_used_at", NTZ, True),
])

_CHURN_COLUMNS = [
    T.StructField("user_id", T.StringType(), True),
    T.StructField("current_plan", T.StringType(), True),
    T.StructField("last_active_date", T.DateType(), True),
    T.StructField("days_since_last_activity", T.LongType(), True),
    T.StructField("lifetime_events", T.LongType(), True),
    T.StructField("churn_risk_category", T.StringType(), True),
]
CHURN_RISK_SCORES = T.StructType([T.StructField("user_sk", T.LongType(), True), *_CHURN_COLUMNS])
CHURN_RISK_BY_USER = T.StructType(_CHURN_COLUMNS)

# Violations found by the reports on parts of a growing table.
QUALITY_COUNTS = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rule", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("violations", T.LongType(), False),
])

LAYER_SCHEMAS = {
    "staging_rejects": STAGING_REJECTS,
    "raw_events": RAW_EVENTS,
    "staging_events": STAGING_EVENTS,
    "dim_users": DIM_USERS,
    "dim_documents": DIM_DOCUMENTS,
    "dim_features": DIM_FEATURES,
    "dim_date": DIM_DATE,
    "fact_events": FACT_EVENTS,
    "fact_daily_user_activity": FACT_DAILY,
    # Staging rows without a place in the facts yet (dates outside the calendar).
    "staging_unplaced": STAGING_EVENTS,
    "user_changes": USER_CHANGES,
    "quality_counts": QUALITY_COUNTS,
    "feature_user_usage": FEATURE_USER_USAGE,
    "user_activity": USER_ACTIVITY,
    "user_month_activity": USER_MONTH_ACTIVITY,
    "user_retention_cohorts": USER_RETENTION_COHORTS,
    "feature_adoption_funnel": FEATURE_ADOPTION_FUNNEL,
    "churn_risk_scores": CHURN_RISK_SCORES,
    "churn_risk_by_user": CHURN_RISK_BY_USER,
}

# Physical layout of the stored layers, below the folder of each load. Partition
# columns are bounded by the calendar: staging by event month, event facts
# by event day (a refresh reads only the touched days), user-day facts by month
# (a small table whose touched months are replaced whole).
LAYER_PARTITIONS = {
    "staging_events": ["event_month"],
    "fact_events": ["event_date"],
    "fact_daily_user_activity": ["activity_month"],
}
PARTITION_TYPES = {"event_date": T.DateType(), "event_month": T.StringType(), "activity_month": T.StringType()}
# Tables whose partitions are replaced one by one.
REPLACED_BY_PARTITION = {"fact_daily_user_activity"}
# Columns that the rows of a write are gathered by: files hold few of their
# values, and AQE splits a hot one over tasks.
REBALANCE_ON_WRITE = {
    "staging_events": ["event_month", "event_type"],
    "fact_events": ["event_date"],
    "fact_daily_user_activity": ["activity_month"],
}
# Sort inside each written file, so min/max statistics let filters on these
# columns (e.g. event_type = 'feature_used') skip row groups and pages. Task-local sort,
# no shuffle.
SORT_ON_WRITE = {
    "raw_events": ["batch_id"],
    "staging_events": ["event_type", "user_id"],
    "fact_events": ["event_type", "user_sk"],
    "fact_daily_user_activity": ["activity_date", "user_sk"],
}
# Tables with a key index (see sources.layers): unique, never changed once stored.
LAYER_KEYS = {"raw_events": "event_id", "staging_events": "event_id", "fact_events": "event_id"}
# Surrogate keys whose maximum each commit keeps.
LAYER_MAXIMA = {"fact_events": "event_sk", "dim_users": "user_sk", "dim_documents": "document_sk"}
