"""Names and value objects shared by the operators: subjects, tracking columns, rules, stores."""

from __future__ import annotations

from dataclasses import dataclass, field

# Table partition keys in path order, and the key of the per-write folder.
TIME_KEYS = ("year", "month", "day", "hour")
RANDOM_KEY = "randompath"

# The partition rules and how many time keys each one has.
RULE_DEPTH = {"yyyy": 1, "yyyy/MM": 2, "yyyy/MM/dd": 3, "yyyy/MM/dd/HH": 4}


@dataclass(frozen=True)
class Subject:
    """A log feed, written ``<db>.<table>``."""

    db: str
    table: str

    @classmethod
    def parse(cls, text: str) -> "Subject":
        parts = text.split(".")
        if len(parts) < 2 or not parts[0] or not parts[1]:
            raise ValueError(f"subject must look like <db>.<table>: {text!r}")
        return cls(parts[0], parts[1])

    def __str__(self) -> str:
        return f"{self.db}.{self.table}"


@dataclass(frozen=True)
class TrackingNames:
    """Names of the columns an ingest adds.

    Tables that already exist under other names keep them: ``TrackingNames.with_prefix("x")``
    gives ``xUpdateTime``, ``xMatchValue`` and ``xActionTime``.
    """

    update_time: str = "logUpdateTime"
    match_value: str = "logMatchValue"
    action_time: str = "logActionTime"
    header: str = "header"

    @classmethod
    def with_prefix(cls, prefix: str) -> "TrackingNames":
        return cls(f"{prefix}UpdateTime", f"{prefix}MatchValue", f"{prefix}ActionTime")

    def match_path(self, layout: str) -> str:
        """Where the match value sits in a stored row: top level (flat) or inside the header."""
        if layout == "flat":
            return self.match_value
        if layout == "header":
            return f"{self.header}.{self.match_value}"
        raise ValueError(f"layout must be 'flat' or 'header': {layout!r}")


@dataclass(frozen=True)
class Rule:
    """How one subject is ingested. ``match_key`` and ``time_key`` are trusted SQL expressions.

    ``order_by`` (SQL expressions, newest first) makes the choice among duplicates reproducible;
    without it any one row of a key is kept.
    """

    subject: str
    match_key: str
    time_key: str
    partition: str
    files: int | None = None
    file_type: str = "json"
    order_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Store:
    """Where landed data, its ledger and its catalog database live.

    ``keep_versions`` is for how many ledger entries a folder that a compaction or a drop took out can
    still be read as of an older one; ``catalog.tables.vacuum`` deletes older ones. 0 deletes at once.
    """

    root: str
    db_prefix: str = "log_"
    names: TrackingNames = field(default_factory=TrackingNames)
    keep_versions: int = 0

    def table_root(self, subject: Subject) -> str:
        return f"{self.root.rstrip('/')}/{subject.db}/{subject.table}"

    def ledger_root(self) -> str:
        return f"{self.root.rstrip('/')}/_ledger"

    def database(self, subject: Subject) -> str:
        return f"{self.db_prefix}{subject.db}"

    def table_name(self, subject: Subject) -> str:
        return f"`{self.database(subject)}`.`{subject.table}`"


def rule_depth(rule: str) -> int:
    if rule not in RULE_DEPTH:
        raise ValueError(f"partition rule must be one of {sorted(RULE_DEPTH)}: {rule!r}")
    return RULE_DEPTH[rule]


def time_keys(rule: str) -> list[str]:
    """``yyyy/MM`` -> ``['year', 'month']``."""
    return list(TIME_KEYS[: rule_depth(rule)])


def partition_keys(rule: str | None) -> list[str]:
    """All table partition keys of a rule; an empty rule has none."""
    return [*time_keys(rule), RANDOM_KEY] if rule else []


def quoted(name: str) -> str:
    """A column name usable in ``F.col`` even when it holds dots or backticks."""
    return "`" + name.replace("`", "``") + "`"
