"""Scans, test sources and sinks (snapshot publishing)."""
