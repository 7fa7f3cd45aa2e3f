"""Structured Streaming: sources, the scoring query with per-batch fan-out, KPIs, event-time rates."""
