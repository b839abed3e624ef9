"""Dimensions: calendar, users (insert-if-absent and SCD2), documents,
features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_key, padded_name
from starloom.operators.keys import assign_keys
from starloom.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    DEFAULT_PLAN,
    DEFAULT_STATUS,
    DOCUMENT_TITLE_PREFIX,
    EMAIL_DOMAIN,
    FEATURE_SEED,
)


# --------------------------------------------------------------------- C1
def build_dim_date(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END, pad: bool = True,
                   existing: DataFrame | None = None) -> DataFrame:
    """One row per day of [start, end]. day_of_week 0 = Sunday; names are
    blank-padded to 9 characters unless ``pad`` is False; ISO week;
    is_weekend for Saturday and Sunday. Existing date_keys are skipped.

    Size is fixed by the calendar bounds (2,557 rows by default), so joins
    may broadcast it."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    dow = F.dayofweek("d") - 1
    out = days.select(
        date_key(F.col("d")).alias("date_key"),
        F.col("d").alias("full_date"),
        dow.alias("day_of_week"),
        padded_name(F.col("d"), "EEEE", pad).alias("day_name"),
        F.weekofyear("d").alias("week_of_year"),
        F.month("d").alias("month"),
        padded_name(F.col("d"), "MMMM", pad).alias("month_name"),
        F.quarter("d").alias("quarter"),
        F.year("d").alias("year"),
        dow.isin(0, 6).alias("is_weekend"),
    )
    if existing is not None:
        out = out.join(F.broadcast(existing.select("date_key")), "date_key", "left_anti")
    return out


# --------------------------------------------------------------- A6 / C5
def seed_features(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The feature seed rows, skipping ids already stored."""
    schema = T.StructType([
        T.StructField("feature_id", T.StringType(), False),
        T.StructField("feature_name", T.StringType(), True),
        T.StructField("feature_category", T.StringType(), True),
        T.StructField("is_premium", T.BooleanType(), False),
        T.StructField("seed_order", T.LongType(), False),
    ])
    rows = [(fid, name, cat, prem, i + 1) for i, (fid, name, cat, prem) in enumerate(FEATURE_SEED)]
    df = spark.createDataFrame(rows, schema)
    if existing is not None:
        df = df.join(F.broadcast(existing.select("feature_id")), "feature_id", "left_anti")
    return df


def build_dim_features(spark: SparkSession, existing: DataFrame | None = None,
                       now: Column | None = None) -> DataFrame:
    """Seed rows with surrogate keys in seed order (8 rows: broadcastable)."""
    start = 0
    if existing is not None:
        start = existing.agg(F.coalesce(F.max("feature_sk"), F.lit(0))).first()[0]
    seed = seed_features(spark, existing)
    w = Window.orderBy("seed_order")  # at most 8 rows
    return seed.select(
        (F.lit(start) + F.row_number().over(w)).cast("bigint").alias("feature_sk"),
        "feature_id", "feature_name", "feature_category", "is_premium",
        (now if now is not None else F.localtimestamp()).alias("created_at"),
    )


# --------------------------------------------------------------------- C2
def build_dim_users(staging: DataFrame, existing: DataFrame | None = None, start: int = 0,
                    now: Column | None = None, effective_from_first_event: bool = False) -> DataFrame:
    """One new row per user_id that has no current row yet.

    signup_date = date of the user's first event; email = user_id + domain;
    plan / status defaults. Existing rows never change (a later, earlier-
    dated event does not move signup_date). ``effective_from_first_event``
    dates the version by the first event instead of the load time, which
    makes the result reproducible."""
    now = now if now is not None else F.localtimestamp()
    firsts = staging.groupBy("user_id").agg(F.min("event_timestamp").alias("_first"))
    if existing is not None:
        current = existing.where(F.col("is_current")).select("user_id")
        firsts = firsts.join(current, "user_id", "left_anti")
    rows = firsts.select(
        "user_id",
        F.concat(F.col("user_id"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.col("_first").cast("date").alias("signup_date"),
        F.lit(DEFAULT_PLAN).alias("current_plan"),
        F.lit(DEFAULT_STATUS).alias("account_status"),
        F.lit(True).alias("is_current"),
        (F.col("_first") if effective_from_first_event else now).alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        now.alias("created_at"),
        now.alias("updated_at"),
        F.lit(None).cast("string").alias("change_id"),
    )
    keyed = assign_keys(rows, ["user_id"], "user_sk", start)
    return keyed.select("user_sk", *[c for c in rows.columns])


# --------------------------------------------------------------------- C4
def build_dim_documents(staging: DataFrame, existing: DataFrame | None = None, start: int = 0,
                        now: Column | None = None) -> DataFrame:
    """C4: one new row per non-NULL document_id: title prefix + id, owner =
    smallest user_id (text order), created_at = first event. Existing ids
    are skipped. The aggregation is partial (map-side), so a hot document
    costs no more than a cold one."""
    now = now if now is not None else F.localtimestamp()
    docs = (staging.where(F.col("document_id").isNotNull())
            .groupBy("document_id")
            .agg(F.min("user_id").alias("owner_user_id"), F.min("event_timestamp").alias("created_at")))
    if existing is not None:
        docs = docs.join(existing.select("document_id"), "document_id", "left_anti")
    rows = docs.select(
        "document_id",
        F.concat(F.lit(DOCUMENT_TITLE_PREFIX), F.col("document_id")).alias("title"),
        "owner_user_id", "created_at", now.alias("updated_at"))
    keyed = assign_keys(rows, ["document_id"], "document_sk", start)
    return keyed.select("document_sk", *rows.columns)


# --------------------------------------------------------------------- C3
def apply_scd2(dim: DataFrame, changes: DataFrame, start: int, now: Column | None = None,
               tracked: tuple[str, ...] = ("current_plan", "account_status"), earlier: DataFrame | None = None) -> DataFrame:
    """SCD type 2 on the user dimension.

    ``changes``: (user_id, change_ts, change_id, <tracked columns>), the
    state a user is in from ``change_ts`` on. For every user with changes,
    the existing versions and the changes form one sequence in the order of
    (change_ts, change_id), a user's first version before changes of its time:
    each existing version stays (same key; its end_date / is_current follow
    from the version after it), and each change whose state differs from the
    state just before it opens a new version (new key from ``start`` + 1),
    which keeps the change_id. A change later than the current version closes
    it; a late change, older than the current version, is placed inside the
    history (the version it falls into ends at the change). Users without
    changes are returned unchanged; at most one row per user stays current.

    A change is recognised by its id, so changes that were applied before add
    nothing, also with others at the same time and in the same state.
    ``earlier``: all changes seen before (the change log). With it, a change that
    opened nothing when it came takes part again, since a late change before
    it may have made it one.

    The ordering runs through ``sequence.neighbors``, so a user with very
    many versions or changes is split over several tasks.
    """
    from starloom.operators.sequence import neighbors

    now = now if now is not None else F.localtimestamp()
    if "change_id" not in dim.columns:
        dim = dim.withColumn("change_id", F.lit(None).cast("string"))
    columns = ["user_id", "change_ts", "change_id", *tracked]
    affected = changes.select("user_id").distinct()
    if earlier is not None:
        changes = changes.select(*columns).unionByName(earlier.select(*columns).join(affected, "user_id", "left_semi")) \
            .dropDuplicates(["user_id", "change_id"])
    # Changes that opened a stored version come in with that version.
    known = dim.where(F.col("change_id").isNotNull()).select("user_id", "change_id")
    changes = changes.join(known, ["user_id", "change_id"], "left_anti")
    old = dim.join(affected, "user_id", "left_semi")
    untouched = dim.join(affected, "user_id", "left_anti")
    order = ["change_ts", "_rank", "change_id"]
    seq_old = old.select("user_id", F.col("effective_date").alias("change_ts"),
                         F.when(F.col("change_id").isNull(), 0).otherwise(1).alias("_rank"),
                         F.coalesce("change_id", F.lit("")).alias("change_id"), *tracked, F.col("user_sk").alias("_old_sk"))
    seq_new = changes.join(dim.select("user_id").distinct(), "user_id", "left_semi").select(
        "user_id", "change_ts", F.lit(1).alias("_rank"), "change_id", *tracked,
        F.lit(None).cast("bigint").alias("_old_sk"))
    nb = neighbors(seq_old.unionByName(seq_new), "user_id", order, prev_cols=list(tracked))
    differs = None
    for c in tracked:
        d = ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
        differs = d if differs is None else (differs | d)
    is_old = F.col("_old_sk").isNotNull()
    points = nb.where(is_old | ~F.col("has_prev") | differs).select(*seq_old.columns)
    chain = neighbors(points, "user_id", order, next_cols=["change_ts"])

    ends = chain.where(F.col("_old_sk").isNotNull()).select(
        F.col("_old_sk").alias("user_sk"), F.col("next_change_ts").alias("_end"))
    o = old.join(ends, "user_sk")
    moved = ~F.col("end_date").eqNullSafe(F.col("_end"))
    kept = o.select(
        "user_sk", "user_id", "email", "signup_date", "current_plan", "account_status",
        F.col("_end").isNull().alias("is_current"),
        "effective_date",
        F.col("_end").alias("end_date"),
        "created_at",
        F.when(moved, now).otherwise(F.col("updated_at")).alias("updated_at"),
        "change_id",
    )
    base = old.groupBy("user_id").agg(F.min_by(F.struct("email", "signup_date"), F.col("effective_date")).alias("_b"))
    opened = chain.where(F.col("_old_sk").isNull()).join(base, "user_id").select(
        "user_id", F.col("_b.email").alias("email"), F.col("_b.signup_date").alias("signup_date"), *tracked,
        F.col("next_change_ts").isNull().alias("is_current"),
        F.col("change_ts").alias("effective_date"),
        F.col("next_change_ts").alias("end_date"),
        now.alias("created_at"), now.alias("updated_at"), F.col("change_id"),
    )
    opened = assign_keys(opened, ["user_id", "effective_date", "change_id"], "user_sk", start)
    return untouched.select(*kept.columns).unionByName(kept).unionByName(opened.select(*kept.columns))
