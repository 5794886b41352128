"""Composite plans: ingest pipeline (X1–X3) and inputs built from the test tables."""
