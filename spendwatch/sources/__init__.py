"""Scans and sinks: the reference's CSV tables, the test-table adapter, report writers."""
