"""Readers: lake partitions, time windows, JDBC, streams."""
