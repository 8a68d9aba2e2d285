"""Sinks: table snapshots (replace, append, reset) and CSV / text outputs."""
