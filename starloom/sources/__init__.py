"""Sources and sinks: the given tables, the raw layer and stored layers."""

from starloom.sources.driver import adapt_events, adapt_orders, order_events, product_events, read_table
from starloom.sources.layers import insert_absent, read_layer, upsert, write_layer
from starloom.sources.raw import batch_id_for, ingest_raw, raw_inventory, stamp_batch, to_payload

__all__ = [
    "adapt_events",
    "adapt_orders",
    "order_events",
    "product_events",
    "read_table",
    "insert_absent",
    "read_layer",
    "upsert",
    "write_layer",
    "batch_id_for",
    "ingest_raw",
    "raw_inventory",
    "stamp_batch",
    "to_payload",
]
