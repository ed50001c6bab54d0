"""Streaming forms: unique events, sessions, and runs over what has arrived."""

from tillhouse.streaming.events import sessions, unique_events
from tillhouse.streaming.runs import advance, read_arrivals, replay

__all__ = ["advance", "read_arrivals", "replay", "sessions", "unique_events"]
