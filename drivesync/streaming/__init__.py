"""Structured Streaming: following a change log, reassembly state, sinks."""
