"""Structured Streaming forms of the operators.

Windowed aggregates run as ordinary streaming aggregations with a
watermark (append mode).  Ranking after a windowed aggregate, late-row side
outputs and keyed upserts run in ``foreachBatch`` with idempotent,
batch-id-addressed writes.  Per-record keyed state (running counts, jump
alerts, count windows, retract streams) uses ``transformWithStateInPandas``
with the RocksDB state store.
"""
