"""Land log batches in a partitioned table: read, key, deduplicate, merge, register, compact."""

from logsilt.layout import Rule, Store, Subject, TrackingNames
from logsilt.session import configure

__all__ = ["Rule", "Store", "Subject", "TrackingNames", "configure"]
