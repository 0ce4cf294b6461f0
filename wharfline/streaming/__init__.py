"""Streams: run modes, routed sinks, stateful operators and progress records."""
