"""The warehouse derived from the given tables.

The ``events`` table goes through the adapter into the raw layer (JSON
documents) and the parser into the staging layer; each is stored once per
application (as the product stores them), when a query first reads it. Everything above - dimensions,
facts, views, reports, checks - is computed by each query from the stored
staging rows; the keyed user and document dimensions are written once per
query as Parquet in the shared folder, so every branch of the query reads the
same keys. Catalyst prunes columns and pushes filters into the Parquet scans, and
surrogate keys are stable functions of the data (see ``operators.keys``).

Scenario constants (fixed, documented): batches up to EARLY_CUTOFF form the
first load, the rest the second; AS_OF is the churn / trend reference date.
"""

from __future__ import annotations

import datetime as _dt
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dims, facts, marts, profile, staging
from starloom.operators.keys import next_key_start
from starloom.schemas import DIM_DOCUMENTS, DIM_USERS, RAW_EVENTS, STAGING_EVENTS
from starloom.session import configure, scratch_path, shared_dir
from starloom.sources.driver import order_events, product_events
from starloom.sources.raw import to_payload

AS_OF = _dt.date(2024, 7, 15)
EARLY_CUTOFF = "batch_20240115"

# Defects of the broken events: the remainder of an event's number by
# BROKEN_EVERY that has each of them.
BROKEN_EVERY = 97
BROKEN = {"bad_ip": 1, "missing_user_id": 2, "missing_event_type": 3, "duplicate_event_id": 4, "too_long_platform": 5,
          "malformed_json": 6, "bad_timestamp": 7, "bad_integer": 8, "missing_event_id": 9}


def number_of(name: str):
    """The number that an id ends with."""
    return F.regexp_extract(name, "([0-9]+)$", 1).cast("bigint")


# (application id, sf_dir, layer) -> path written this session.
_STORED: dict[tuple[str, str, str], str] = {}
_STORED_LOCK = threading.RLock()


class Warehouse:
    """All layers over one set of given tables (``sf_dir``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.as_of = as_of

    # ------------------------------------------------------------- sources
    @cached_property
    def events(self) -> DataFrame:
        """Product events in staging shape (adapter output)."""
        return product_events(self.spark, self.sf_dir)

    def _stored(self, layer: str) -> str:
        """Where the raw layer (JSON documents) or the staging layer (typed rows, from the stored
        raw one) is: written once per application and set of given tables by the first query
        that reads it, as Parquet in the shared folder; later queries of the session read it
        back, as the product reads its stored raw and staging tables. A query that reads no
        staging does not wait for it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, layer)
        with _STORED_LOCK:
            if key not in _STORED:
                rows = to_payload(self.events).withColumn("loaded_at", F.localtimestamp()) if layer == "raw_events" \
                    else staging.parse_events(self.raw)
                path = scratch_path(self.spark, layer)
                rows.write.mode("overwrite").parquet(path)
                _STORED[key] = path
            return _STORED[key]

    @cached_property
    def raw(self) -> DataFrame:
        """Raw layer: one JSON document per event (stored)."""
        return self.spark.read.schema(RAW_EVENTS).parquet(self._stored("raw_events"))

    @cached_property
    def staging(self) -> DataFrame:
        """Staging layer: typed, validated events (stored)."""
        return self.spark.read.schema(STAGING_EVENTS).parquet(self._stored("staging_events"))

    @cached_property
    def raw_early(self) -> DataFrame:
        return self.raw.where(F.col("batch_id") <= EARLY_CUTOFF)

    @cached_property
    def staging_early(self) -> DataFrame:
        return self.staging.where(F.col("batch_id") <= EARLY_CUTOFF)

    @cached_property
    def staging_late(self) -> DataFrame:
        return self.staging.where(F.col("batch_id") > EARLY_CUTOFF)

    # ------------------------------------------------------ broken events
    @cached_property
    def raw_broken(self) -> DataFrame:
        """The raw layer with defects in its documents: by the remainder of
        the event's number, one kind each (see BROKEN)."""
        k, p = number_of("event_id") % BROKEN_EVERY, F.col("raw_payload")
        cut = lambda pattern, new: F.regexp_replace(p, pattern, new)
        broken = {
            "bad_ip": cut('"ip_address":"[^"]*"', '"ip_address":"300.1.2.3"'),
            "missing_user_id": cut('"user_id":"[^"]*",', ""),
            "missing_event_type": cut('"event_type":"[^"]*",', ""),
            "too_long_platform": cut('"platform":"[^"]*"', f'"platform":"{"x" * 60}"'),
            "malformed_json": p.substr(F.lit(1), F.length(p) - 1),
            "bad_timestamp": cut('"event_timestamp":"[^"]*"', '"event_timestamp":"soon"'),
            "bad_integer": cut('"(edit_duration_sec|duration_sec)":([0-9]+)', '"$1":$2.0'),
            "missing_event_id": cut('"event_id":"[^"]*",', ""),
        }
        payload = None
        for kind, text in broken.items():
            payload = (F if payload is None else payload).when(k == BROKEN[kind], text)
        copies = F.when(k == BROKEN["duplicate_event_id"], F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return self.raw.select("event_id", payload.otherwise(p).alias("raw_payload"), "batch_id", "loaded_at",
                               F.explode(copies).alias("copy")).drop("copy")

    @cached_property
    def staging_broken(self) -> DataFrame:
        """What a lenient parse makes of the broken documents."""
        return staging.parse_events(self.raw_broken, strict=False, check_contract=False)

    # ---------------------------------------------------------- dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.build_dim_date(self.spark)

    @cached_property
    def dim_features(self) -> DataFrame:
        return dims.build_dim_features(self.spark)

    # The user and document dimensions are computed by each query and then
    # written once as Parquet in the shared folder, as the product stores
    # them: every fact, view and check of the query reads the same keyed rows
    # (columnar, pruned to the columns it joins on) instead of re-deriving
    # them per branch.
    def _materialize(self, df: DataFrame, name: str, schema) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    @cached_property
    def dim_users(self) -> DataFrame:
        return self._materialize(dims.build_dim_users(self.staging, effective_from_first_event=True),
                                 "dim_users", DIM_USERS)

    @cached_property
    def dim_documents(self) -> DataFrame:
        return self._materialize(dims.build_dim_documents(self.staging), "dim_documents", DIM_DOCUMENTS)

    # ---------------------------------------------------------------- facts
    def fact_for(self, stg: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return facts.build_fact_events(stg, self.dim_users, self.dim_documents, self.dim_features,
                                       self.dim_date, keep=keep)

    @cached_property
    def fact_events(self) -> DataFrame:
        return self.fact_for(self.staging)

    @cached_property
    def keyed_fact_events(self) -> DataFrame:
        """The facts with their own keys, as a load stores them."""
        return facts.build_fact_events(self.staging, self.dim_users, self.dim_documents, self.dim_features,
                                       self.dim_date, event_keys=True)

    @cached_property
    def daily(self) -> DataFrame:
        return facts.build_daily(self.fact_events)

    # --------------------------------------------------------------- views
    @cached_property
    def retention(self) -> DataFrame:
        return marts.retention_cohorts(self.dim_users, self.daily, "group")

    @cached_property
    def retention_true(self) -> DataFrame:
        return marts.retention_cohorts(self.dim_users, self.daily, "cohort")

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.feature_adoption(self.fact_events, self.dim_features)

    @cached_property
    def churn(self) -> DataFrame:
        return marts.churn_risk(self.dim_users, self.daily, self.as_of)

    # ------------------------------------------------------------ helpers
    def with_user_id(self, df: DataFrame) -> DataFrame:
        """Replace user_sk by the natural user_id (reports compare on it)."""
        return df.join(self.dim_users.select("user_sk", "user_id"), "user_sk").drop("user_sk")

    @cached_property
    def staging_with_orders(self) -> DataFrame:
        """Product events plus the multi-year order stream, whose documents are parsed
        once a query and stored as staging is: every branch of the query reads the typed rows."""
        other = staging.parse_events(to_payload(order_events(self.spark, self.sf_dir)))
        return self.staging.unionByName(self._materialize(other, "staging_orders", STAGING_EVENTS))

    # ------------------------------------------- two-load SCD2 scenario
    def two_load_scenario(self) -> tuple[DataFrame, DataFrame]:
        shared_dir(self.spark)
        """Load 1: early batches -> users v1, facts bound to v1. Then the
        early subscription events close and open user versions (SCD2). Load
        2: late batches -> new users inserted after the current rows, facts
        bound to the current versions. Returns (all user versions, daily
        over both loads)."""
        # Each load stores its dimension (as the product does); here that is a
        # reliable checkpoint, so later steps read it instead of re-deriving it.
        users_v1 = dims.build_dim_users(self.staging_early, effective_from_first_event=True).checkpoint(eager=True)
        docs = self.dim_documents
        facts_1 = facts.build_fact_events(self.staging_early, users_v1, docs, self.dim_features, self.dim_date)
        changes = profile.plan_changes(self.staging_early)
        start = next_key_start(users_v1, "user_sk")
        users_v2 = dims.apply_scd2(users_v1, changes, start).checkpoint(eager=True)
        start2 = next_key_start(users_v2, "user_sk")
        new_users = dims.build_dim_users(self.staging_late, users_v2, start=start2,
                                         effective_from_first_event=True)
        users_all = users_v2.unionByName(new_users).checkpoint(eager=True)
        facts_2 = facts.build_fact_events(self.staging_late, users_all, docs, self.dim_features, self.dim_date)
        daily = facts.build_daily(facts_1.unionByName(facts_2))
        return users_all, daily
