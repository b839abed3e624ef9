import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    shared_dir(s)  # sets a checkpoint folder only when the session has none
    yield s
    s.stop()


def payload(**fields) -> str:
    return json.dumps(fields)


def event(eid, etype="user_login", ts="2024-03-01T10:00:00.000000Z", user="u1", props=None, ctx=None, **extra):
    body = {"event_id": eid, "event_type": etype, "event_timestamp": ts, "user_id": user,
            "session_id": f"s_{user}", "properties": props or {},
            "context": ctx or {"platform": "web", "ip_address": "192.168.1.1", "user_agent": "Mozilla/5.0 (web)"}}
    body.update(extra)
    return body


@pytest.fixture
def raw_rows(spark):
    """Build a raw DataFrame from (event_id, payload text or dict, batch_id)."""
    def make(rows):
        data = [(eid, p if isinstance(p, str) else json.dumps(p), b) for eid, p, b in rows]
        return spark.createDataFrame(data, "event_id string, raw_payload string, batch_id string")
    return make
