import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import event
from starloom.functions.inet import is_inet
from starloom.operators import staging
from starloom.sources.raw import ingest_raw


def test_ingest_dedup_in_batch_and_across_batches(raw_rows):
    e = event("e1")
    batch1 = raw_rows([("e1", e, "batch_20240301"), ("e1", e, "batch_20240301")])
    new1 = ingest_raw(batch1, None)
    assert new1.count() == 1
    batch2 = raw_rows([("e1", e, "batch_20240302")])
    assert ingest_raw(batch2, new1).count() == 0


def test_timestamp_zone_suffix_is_ignored(raw_rows):
    raw = raw_rows([
        ("a", event("a", ts="2024-03-01T10:00:00Z"), "b"),
        ("b", event("b", ts="2024-03-01T10:00:00+05:00"), "b"),
    ])
    got = {r.event_id: r.event_timestamp for r in staging.parse_events(raw).collect()}
    assert got == {"a": dt.datetime(2024, 3, 1, 10), "b": dt.datetime(2024, 3, 1, 10)}


def test_duration_first_non_null(raw_rows):
    raw = raw_rows([
        ("both", event("both", props={"edit_duration_sec": 7, "duration_sec": 9}), "b"),
        ("second", event("second", props={"duration_sec": 9}), "b"),
        ("nullfirst", event("nullfirst", props={"edit_duration_sec": None, "duration_sec": 9}), "b"),
        ("text", event("text", props={"edit_duration_sec": "12"}), "b"),
    ])
    got = {r.event_id: r.duration_seconds for r in staging.parse_events(raw).collect()}
    assert got == {"both": 7, "second": 9, "nullfirst": 9, "text": 12}


@pytest.mark.parametrize("bad", ["12.5", "x"])
def test_bad_integer_fails_strict_and_is_quarantined(raw_rows, bad):
    raw = raw_rows([("a", event("a", props={"characters_added": bad}), "b")])
    with pytest.raises(PySparkException):
        staging.parse_events(raw).collect()
    good, rejects = staging.split_valid(raw)
    assert good.count() == 0
    assert rejects.collect()[0].reasons == ["bad_integer"]


def test_missing_user_malformed_and_bad_ip(raw_rows):
    no_user = event("nu")
    del no_user["user_id"]
    raw = raw_rows([
        ("nu", no_user, "b"),
        ("mal", "{not json", "b"),
        ("ip", event("ip", ctx={"platform": "web", "ip_address": "999.1.1.1"}), "b"),
        ("ok", event("ok"), "b"),
    ])
    for eid in ("nu", "ip"):
        with pytest.raises(PySparkException):
            staging.parse_events(raw.where(F.col("event_id") == eid)).collect()
    good, rejects = staging.split_valid(raw)
    assert [r.event_id for r in good.collect()] == ["ok"]
    reasons = {r.raw_payload: r.reasons for r in rejects.collect()}
    assert reasons["{not json"] == ["malformed_json"]
    assert sorted(sum(reasons.values(), [])) == ["bad_ip", "malformed_json", "missing_user_id"]


def test_duplicate_json_key_keeps_last(raw_rows):
    text = ('{"event_id": "d", "event_type": "user_login", "event_timestamp": "2024-03-01T10:00:00Z", '
            '"user_id": "first", "user_id": "last"}')
    row = staging.parse_events(raw_rows([("d", text, "b")])).collect()[0]
    assert row.user_id == "last"


def test_duplicate_payload_id_fails_primary_key(raw_rows):
    raw = raw_rows([("r1", event("same"), "b"), ("r2", event("same", user="u2"), "b")])
    with pytest.raises(PySparkException):
        staging.new_events(staging.parse_events(raw), None).collect()


def test_increment_is_idempotent(raw_rows):
    raw = raw_rows([(f"e{i}", event(f"e{i}"), "b") for i in range(5)])
    first = staging.new_events(staging.parse_events(raw), None)
    assert first.count() == 5
    assert staging.new_events(staging.parse_events(raw), first).count() == 0


def test_properties_kept_as_json(raw_rows):
    raw = raw_rows([("p", event("p", etype="subscription_started", props={"plan": "pro", "billing_cycle": "annual"}), "b")])
    row = staging.parse_events(raw).select(F.get_json_object("properties", "$.plan").alias("plan")).collect()[0]
    assert row.plan == "pro"


def test_is_inet(spark):
    cases = {"192.168.1.1": True, "10.0.0.0/8": True, "::1": True, "2001:db8::1": True, "fe80::1/64": True,
             "::ffff:192.168.0.1": True, "256.1.1.1": False, "1.2.3": False, "abc": False, "1.2.3.4/33": False}
    df = spark.createDataFrame([(k,) for k in cases], "ip string")
    got = {r.ip: r.ok for r in df.select("ip", is_inet(F.col("ip")).alias("ok")).collect()}
    assert got == cases


def test_documents_are_read_once(spark):
    """However many fields are used, also by filters: one read of a document in each branch of a plan."""
    raw = spark.createDataFrame([("e1", "{}", "b")], "event_id string, raw_payload string, batch_id string")

    def reads(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("from_json("), plan.count("regexp_replace(")

    good, rejects = staging.split_valid(raw)
    assert reads(staging.parse_events(raw).where("user_id <> 'x' and duration_seconds > 1")) == (1, 1)
    assert reads(good) == (1, 1)
    assert reads(rejects) == (2, 2)  # invalid rows, repeats


def test_number_literals_beside_strings(spark):
    docs = [r'{"event_id":"a-1 \"2.0\" \\","user_id":1.50,"session_id":[1,-2e3,"3"],"properties":{"duration_sec":12.0}}',
            r'{"event_id":"x","user_id":-0,"properties":{"document_id":"1.0"},"properties":{"duration_sec":7,"z":"4\\"}}']
    raw = spark.createDataFrame([(d, "b") for d in docs], "raw_payload string, batch_id string")
    got = staging.parse_events(raw, strict=False, check_contract=False).orderBy("event_id").collect()
    assert [(r.event_id, r.user_id, r.session_id, r.document_id, r.duration_seconds) for r in got] == [
        ('a-1 "2.0" \\', "1.50", '["1","-2e3","3"]', None, None), ("x", "-0", None, None, 7)]


def test_reasons_are_worked_out_once(spark):
    """The address check of a row stands once in each branch, not again in the filter that uses it."""
    raw = spark.createDataFrame([("e1", "{}", "b")], "event_id string, raw_payload string, batch_id string")
    good, rejects = staging.split_valid(raw)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (good, rejects)]
    assert [p.count("RLIKE(ip_address") for p in plans] == [2, 4]  # IPv4, IPv6
    delivered, undeliverable = staging.split_deliverable(raw)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (delivered, undeliverable)]
    assert [sum("malformed_json" in line for line in p.splitlines()) for p in plans] == [1, 1]


def test_new_events_parse_each_document_once(spark, raw_rows):
    """Stored and repeated ids are looked for without parsing the documents again."""
    raw = raw_rows([("a", event("a"), "b"), ("b", event("b"), "b"), ("b2", event("b"), "b")])
    parsed, ids = staging.parse_events(raw), staging.payload_ids(raw)
    new = staging.new_events(parsed, raw_rows([("b", "{}", "b")]), ids=ids)
    assert new._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [r.event_id for r in new.collect()] == ["a"]
    with pytest.raises(Exception, match="duplicate key value.*: b"):
        staging.new_events(parsed, raw_rows([("a", "{}", "b")]), ids=ids).collect()


def test_delivery_is_checked_once(spark, raw_rows):
    from starloom.sources.raw import ingest_raw
    delivery = raw_rows([("a", "{}", "b"), ("b", "{}", "b"), ("b", "{}", "b")])
    new = ingest_raw(staging.checked_delivery(delivery), raw_rows([("a", "{}", "b")]))
    assert new._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [tuple(r) for r in new.collect()] == [("b", "{}", "b")]
    for row in [(None, "{}", "b"), ("c", None, "b"), ("c", "{}", None), ("c", "{", "b")]:
        wrong = spark.createDataFrame([row], delivery.schema)
        with pytest.raises(Exception, match="invalid raw event"):
            ingest_raw(staging.checked_delivery(wrong), delivery).collect()
