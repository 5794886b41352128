"""Unattended arrival of new extract files (Structured Streaming)."""

from tabulon.streaming.arrivals import start_arrivals

__all__ = ["start_arrivals"]
