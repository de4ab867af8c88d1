"""Sinks: idempotent partition-overwrite writers."""
