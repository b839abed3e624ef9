"""Raw -> staging: parse, type, validate, and keep only new events.

The payload is read twice per row, in a generator, however many columns are extracted: into
a VARIANT (``parse_json``), which says whether it is well-formed and gives the
``properties`` object, and into a struct of texts, which keeps number literals
as they stand in the document (``12.0`` is no INTEGER).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.inet import is_inet
from starloom.functions.json import payload_text, read_documents
from starloom.schemas import NOT_NULL, VARCHAR_LIMITS
from starloom.sources.layers import KeyIndex, insert_absent

# Text fields of the payload, by staging column.
TEXT_FIELDS = {
    "event_id": "event_id",
    "event_type": "event_type",
    "user_id": "user_id",
    "session_id": "session_id",
    "document_id": "properties.document_id",
    "feature_id": "properties.feature_id",
    "platform": "context.platform",
    "user_agent": "context.user_agent",
    "ip_address": "context.ip_address",
}

# Text of the fields that are cast.
CAST_FIELDS = {
    "_ts": "event_timestamp",
    "_edit_duration_sec": "properties.edit_duration_sec",
    "_duration_sec": "properties.duration_sec",
    "_characters_added": "properties.characters_added",
}

STAGING_COLUMNS = [
    "event_id", "event_type", "event_timestamp", "user_id", "session_id", "document_id",
    "feature_id", "duration_seconds", "characters_added", "platform", "user_agent",
    "ip_address", "properties", "batch_id", "processed_at",
]


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message))


def _checked(col: Column, name: str, not_null: bool, limit: int | None) -> Column:
    """Enforce NOT NULL and VARCHAR length row by row (fails the query)."""
    out = col
    if not_null:
        out = F.when(col.isNull(), _fail(f"null value in column {name} violates not-null constraint"))
    if limit is not None:
        too_long = F.length(col) > limit
        msg = _fail(f"value too long for {name} (limit {limit})")
        out = out.when(too_long, msg) if not_null else F.when(too_long, msg)
    return out.otherwise(col) if (not_null or limit is not None) else col


def parse_events(raw: DataFrame, strict: bool = True, check_contract: bool = True) -> DataFrame:
    """Raw rows -> typed staging rows (B1-B6, B8 row rules).

    B1 top-level text fields, B2 two-level ``properties.*`` / ``context.*``,
    B3 duration = first non-NULL of edit_duration_sec, duration_sec (each as
    INTEGER), B4 strict ANSI casts (bad text fails the statement), B5 the
    whole ``properties`` object as JSON, B6 address validity. With
    ``check_contract`` NOT NULL and length rules are enforced inline.
    """
    v = F.parse_json("raw_payload") if strict else F.try_parse_json("raw_payload")
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    parsed = read_documents(raw.select("batch_id", "raw_payload"), "raw_payload", {**TEXT_FIELDS, **CAST_FIELDS}, v)
    t = F.col
    cols: dict[str, Column] = {name: t(name) for name in TEXT_FIELDS}
    cols["event_timestamp"] = cast(t("_ts"), "timestamp_ntz")
    cols["duration_seconds"] = F.coalesce(cast(t("_edit_duration_sec"), "int"), cast(t("_duration_sec"), "int"))
    cols["characters_added"] = cast(t("_characters_added"), "int")
    cols["properties"] = payload_text(F.col("_v"), "properties")
    cols["batch_id"] = F.col("batch_id")
    cols["processed_at"] = F.localtimestamp()
    # Extract every field once; the checks below reference the extracted
    # columns (a separate projection), so no field is read twice.
    fields = parsed.select(*[cols[n].alias(n) for n in STAGING_COLUMNS])
    checks: dict[str, Column] = {n: F.col(n) for n in STAGING_COLUMNS}
    if strict:
        ip = F.col("ip_address")
        checks["ip_address"] = F.when(ip.isNull() | is_inet(ip), ip).otherwise(
            F.raise_error(F.concat(F.lit("invalid input syntax for type inet: "), ip)))
    if check_contract:
        limits = VARCHAR_LIMITS["staging_events"]
        required = set(NOT_NULL["staging_events"])
        checks = {n: _checked(c, n, n in required, limits.get(n)) for n, c in checks.items()}
    return fields.select(*[checks[n].alias(n) for n in STAGING_COLUMNS])


def fail_on_duplicates(df: DataFrame, key: str, message: str, keys: DataFrame | None = None) -> DataFrame:
    """``df`` unchanged, plus a guard branch that fails the query when a key
    value occurs more than once. The duplicate count is a partial (map-side)
    aggregation, so a key repeated millions of times costs no more than a
    unique one; with no duplicates the guard adds no rows. ``keys``: the keys
    of ``df``, where they come cheaper than with the rows."""
    dups = (df if keys is None else keys).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    guard = dups.select("_n", *[
        (F.col(key) if c == key else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in df.columns
    ]).withColumn(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(message + ": "), F.col(key))))
                  .cast(df.schema[key].dataType))
    # The error depends on the count, so no pushed-down filter can evaluate
    # it below the aggregation (on rows that are not duplicates).
    return df.unionByName(guard.drop("_n"))


def payload_ids(raw: DataFrame) -> DataFrame:
    """The event_id of every document, and nothing else read of it."""
    return read_documents(raw.select("raw_payload"), "raw_payload", {"event_id": "event_id"}).select("event_id")


def new_events(parsed: DataFrame, staging: DataFrame | KeyIndex | None, strict_unique: bool = True,
               ids: DataFrame | None = None) -> DataFrame:
    """Parsed rows whose (payload) event_id is not in staging (or its key
    index) yet; a rerun adds nothing. With ``strict_unique`` a repeated event_id among the
    new rows fails the statement (primary key). Stored and repeated keys are looked
    for among ``ids`` (:func:`payload_ids` of the rows that were parsed), so that
    the documents are not parsed for each of these steps."""
    out = insert_absent(parsed, staging, ["event_id"], ids)
    if strict_unique:
        new_ids = None if ids is None else insert_absent(ids.where(F.col("event_id").isNotNull()), staging, ["event_id"], ids)
        out = fail_on_duplicates(out, "event_id", "duplicate key value violates unique constraint on event_id", new_ids)
    return out.select(*parsed.columns)


def contract_report(staging: DataFrame) -> DataFrame:
    """B8 as a report: violations per rule and column in one pass for the
    NOT NULL rules and one aggregation for the key. Zero rows violate on
    valid data; every rule is listed."""
    not_null = [c for c in NOT_NULL["staging_events"] if c in staging.columns]
    counts = staging.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    nn = counts.selectExpr(f"stack({len(not_null)}, {stack}) as (column_name, violations)") \
        .withColumn("rule", F.lit("not_null"))
    dup = (staging.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
           .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("violations"))
           .withColumn("column_name", F.lit("event_id")).withColumn("rule", F.lit("unique")))
    return nn.unionByName(dup).select("rule", "column_name", F.col("violations").cast("bigint"))


def with_reasons(rows: DataFrame, reasons: list[Column]) -> DataFrame:
    """``rows`` with those ``reasons`` that are not NULL as ``_reasons``. They come
    out of a generator, so a filter on them is neither worked out a second time below
    the rows nor drawn into the constraints of every later join."""
    return rows.select("*", F.inline(F.array(F.struct(F.array_compact(F.array(*reasons)).alias("_reasons")))))


def split_valid(raw: DataFrame, staging: DataFrame | KeyIndex | None = None) -> tuple[DataFrame, DataFrame]:
    """Split raw rows into good typed rows and rejects with reasons,
    instead of failing the batch.

    Reasons: malformed_json, missing_<field>, bad_timestamp, bad_integer,
    bad_ip, too_long_<column>, duplicate_event_id. Among repeats of an
    event_id the smallest payload is kept (deterministic); the extra rows are
    reported as one reject row per event_id with their number. Each payload
    is parsed once: the checks and the typed good rows come from the same
    extracted fields.
    """
    v = F.try_parse_json("raw_payload")
    ints = ("edit_duration_sec", "duration_sec", "characters_added")
    fields = read_documents(raw.select("batch_id", "raw_payload"), "raw_payload", {**TEXT_FIELDS, **CAST_FIELDS}, v).select(
        "batch_id", "raw_payload", F.col("_v").isNull().alias("_malformed"),
        *TEXT_FIELDS, *CAST_FIELDS, payload_text(F.col("_v"), "properties").alias("properties"))
    c = F.col
    limits = VARCHAR_LIMITS["staging_events"]
    reasons = [F.when(c("_malformed"), F.lit("malformed_json"))]
    reasons += [F.when(~c("_malformed") & c(n).isNull(), F.lit(f"missing_{n}"))
                for n in ("event_id", "event_type", "user_id")]
    reasons.append(F.when(~c("_malformed") & c("_ts").isNull(), F.lit("missing_event_timestamp")))
    reasons.append(F.when(c("_ts").isNotNull() & c("_ts").try_cast("timestamp_ntz").isNull(), F.lit("bad_timestamp")))
    bad_int = None
    for n in ints:
        b = c(f"_{n}").isNotNull() & c(f"_{n}").try_cast("int").isNull()
        bad_int = b if bad_int is None else (bad_int | b)
    reasons.append(F.when(bad_int, F.lit("bad_integer")))
    reasons.append(F.when(c("ip_address").isNotNull() & ~is_inet(c("ip_address")), F.lit("bad_ip")))
    reasons += [F.when(F.length(c(n)) > m, F.lit(f"too_long_{n}")) for n, m in limits.items() if n in TEXT_FIELDS]
    checked = with_reasons(fields, reasons)
    ok = F.size("_reasons") == 0

    bad = checked.where(~ok).select(
        "event_id", "batch_id", "raw_payload", F.col("_reasons").alias("reasons"),
        F.lit(1).cast("bigint").alias("n_rows"))
    typed = {n: c(n) for n in TEXT_FIELDS}
    typed["event_timestamp"] = c("_ts").try_cast("timestamp_ntz")
    typed["duration_seconds"] = F.coalesce(c("_edit_duration_sec").try_cast("int"), c("_duration_sec").try_cast("int"))
    typed["characters_added"] = c("_characters_added").try_cast("int")
    typed["properties"] = c("properties")
    typed["batch_id"] = c("batch_id")
    typed["processed_at"] = F.localtimestamp()
    good_rows = checked.where(ok).select("raw_payload", *[typed[n].alias(n) for n in STAGING_COLUMNS])
    good_rows = insert_absent(good_rows, staging, ["event_id"], payload_ids(raw))
    rest = [n for n in STAGING_COLUMNS if n not in ("event_id", "processed_at")]
    # MIN over (payload, all columns): a total order, so a recomputed task
    # keeps the same row among repeats.
    firsts = (good_rows.groupBy("event_id")
              .agg(F.min(F.struct("raw_payload", *rest)).alias("_k"),
                   F.count(F.lit(1)).alias("_n")))
    dups = firsts.where(F.col("_n") > 1).select(
        "event_id", F.col("_k.batch_id").alias("batch_id"), F.lit(None).cast("string").alias("raw_payload"),
        F.array(F.lit("duplicate_event_id")).alias("reasons"), (F.col("_n") - 1).alias("n_rows"))
    good = firsts.select("event_id", "_k.*").withColumn("processed_at", F.localtimestamp()) \
        .select(*STAGING_COLUMNS)
    return good, bad.unionByName(dups)


def split_deliverable(incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that raw can store (id, JSON payload and batch present and the
    payload well-formed) and the others as rejects with their reasons. A
    landed line that is no JSON row at all comes with ``_corrupt_record``."""
    line = F.col("_corrupt_record") if "_corrupt_record" in incoming.columns else F.lit(None).cast("string")
    c = F.col
    reasons = [F.when(line.isNotNull(), F.lit("malformed_line"))]
    reasons += [F.when(line.isNull() & c(n).isNull(), F.lit(f"missing_{n}")) for n in ("event_id", "raw_payload", "batch_id")]
    reasons.append(F.when(c("raw_payload").isNotNull() & F.try_parse_json("raw_payload").isNull(), F.lit("malformed_json")))
    checked = with_reasons(incoming, reasons)
    good = checked.where(F.size("_reasons") == 0).select("event_id", "raw_payload", "batch_id")
    bad = checked.where(F.size("_reasons") > 0).select(
        "event_id", "batch_id", F.coalesce("raw_payload", line).alias("raw_payload"), F.col("_reasons").alias("reasons"),
        F.lit(1).cast("bigint").alias("n_rows"))
    return good, bad


def checked_delivery(incoming: DataFrame) -> DataFrame:
    """``incoming``, failing the statement on a row that raw cannot store: the
    key, payload and batch rules of the raw table and its JSON type. The payload
    carries the check, so a step that reads only ids does not parse it again."""
    c = F.col
    missing = c("event_id").isNull() | c("raw_payload").isNull() | c("batch_id").isNull()
    message = F.concat(F.lit("invalid raw event "), F.coalesce("event_id", F.lit("without event_id")))
    wrong = missing | F.try_parse_json("raw_payload").isNull()
    return incoming.withColumn("raw_payload", F.when(wrong, F.raise_error(message)).otherwise(c("raw_payload")))


def new_rejects(rejects: DataFrame, stored: DataFrame | None) -> DataFrame:
    """What ``rejects`` adds to the stored ones: equal rejects (same id,
    batch, payload and reasons) are one with their number. A reject is
    identified within its batch, so a replay or rerun of a delivery adds nothing
    and a delivery that brings more of them adds the difference; n_rows of
    a reject_id sums up to the largest number that came at once."""
    parts = [F.coalesce(c, F.lit("\0")) for c in ("event_id", "batch_id", "raw_payload")]
    identity = F.sha2(F.concat_ws("\1", *parts, F.array_join("reasons", ",")), 256)
    came = rejects.withColumn("reject_id", identity).groupBy("reject_id").agg(
        F.sum("n_rows").alias("n_rows"), *(F.first(c).alias(c) for c in ("event_id", "batch_id", "raw_payload", "reasons")))
    if stored is not None:
        had = stored.join(came.select("reject_id"), "reject_id", "left_semi").groupBy("reject_id").agg(F.sum("n_rows").alias("had"))
        came = came.join(had, "reject_id", "left") \
            .withColumn("n_rows", F.col("n_rows") - F.coalesce("had", F.lit(0))).where("n_rows > 0")
    return came.select("event_id", "batch_id", "raw_payload", "reasons", "n_rows", F.localtimestamp().alias("rejected_at"), "reject_id")


def quarantine_summary(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows per outcome: ``ok`` for good rows, else one row per reason."""
    ok = good.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("ok").alias("reason"), "n_rows")
    bad = (rejects.select(F.explode("reasons").alias("reason"), "n_rows")
           .groupBy("reason").agg(F.sum("n_rows").alias("n_rows")))
    return ok.unionByName(bad).select("reason", F.col("n_rows").cast("bigint"))
