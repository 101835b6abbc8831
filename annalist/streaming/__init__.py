"""Structured Streaming forms of the snapshot difference, replay removal and daily roll-up."""
