"""Scans, sources and sinks: driver-table adapter, raw schema, partitioned
lake, seeds and generated relations."""
