"""Structured Streaming: sources, runner, sinks, joins."""
