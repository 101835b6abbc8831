"""Relational operators: snapshots, history, reconciliation, claims, coverage, extraction, reports and constraints."""
