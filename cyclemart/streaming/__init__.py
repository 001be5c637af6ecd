"""Structured Streaming: arrival stream, emit-once cycle gate, de-duplication, alarms."""
