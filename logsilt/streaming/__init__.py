"""Continuous landing of batches."""

from logsilt.streaming.online import start_online

__all__ = ["start_online"]
