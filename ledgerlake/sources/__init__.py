"""Readers: change-event streams, raw and state layers, operation logs, relational sources."""
