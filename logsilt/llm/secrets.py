"""Secret spans by patterns and by sliding-window entropy, in Spark expressions only.

Spans are (start, kind, end) in code points, end exclusive. Positions come from the text between the
matches: ``split`` gives the gaps, ``regexp_extract_all`` the matches, running totals of their lengths
the places.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that secrets are known by.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}

WINDOW = 20
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"


class CharacterClass(NamedTuple):
    """Runs of some characters, and the entropy in bits that makes a window of them suspicious."""

    pattern: str
    bits: float


#: Random hex digits have about 3.4 bits in a window of 20 characters, base64 about 4.1, words under 3.7.
CLASSES = (CharacterClass(r"[0-9a-fA-F]{20,}", 3.1), CharacterClass(r"[A-Za-z0-9+/=_-]{20,}", 3.9))
#: Candidates that are no secrets, whole: words and names with a number, one repeated part, ordered
#: digits and letters, UUIDs, and published example keys. Repeats of a group are possessive, as Java's
#: matcher would otherwise go one call deeper for each.
ALLOWED = (
    r"[A-Za-z]*", r"[0-9]*", r"[A-Za-z]++(?:[-_/+=]++[A-Za-z]++)*+[-_]?[0-9]{0,4}", r"(.{1,8}?)\1{2,}.{0,8}",
    r"(?i)0?1234567890?abcdefg?.*", r"(?i)abcdefghijklmnopqrst.*", r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",
    r"(?:[A-Za-z_-]+=)?(?:A[A-Z]{3}[A-Z0-9]{9}EXAMPLE|[A-Za-z0-9+/]{30}EXAMPLEKEY)",
)
_SPAN = "array<struct<start: int, kind: int, end: int>>"
_CHUNK = 512


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, also where ``then`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _totals(lengths: Column, first: Column) -> Column:
    """Running totals of ``lengths``, from ``first`` on. A step copies what a chunk has so far, so
    chunks keep the cost in proportion to the number of matches."""
    n = F.size(lengths)

    def chunk(at: Column, base: Column) -> Column:
        stop = F.least(n, at + _CHUNK)
        return F.aggregate(
            F.sequence(at, stop - 1), F.array(base),
            lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1) + F.get(lengths, i))),
        )

    def total(at: Column) -> Column:
        stop = F.least(n, at + _CHUNK)
        return F.aggregate(F.sequence(at, stop - 1), F.lit(0), lambda acc, i: acc + F.get(lengths, i))

    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(_CHUNK))
    bases = F.aggregate(
        starts, F.array(first), lambda acc, at: F.concat(acc, F.array(F.element_at(acc, -1) + total(at)))
    )
    return let(
        bases,
        lambda b: F.flatten(F.transform(starts, lambda at, i: F.slice(chunk(at, F.get(b, i)), 1, _CHUNK))),
    )


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value, part) of the leftmost non-overlapping matches; part is a group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)

    def place(row: Column) -> Column:
        values, between, inner = row["values"], row["gaps"], row["parts"]
        # from the start of a match to the start of the next one
        steps = F.transform(values, lambda v, i: F.length(v) + F.length(F.get(between, i + 1)))
        starts = let(steps, lambda s: _totals(s, F.length(F.get(between, F.lit(0)))))
        return let(
            starts,
            lambda at: F.transform(
                values,
                lambda v, i: F.struct(
                    F.get(at, i).alias("start"), (F.get(at, i) + F.length(v)).alias("end"), v.alias("value"),
                    F.get(inner, i).alias("part"),
                ),
            ),
        )

    row = F.struct(found.alias("values"), gaps.alias("gaps"), parts.alias("parts"))
    empty = F.expr("CAST(array() AS array<struct<start: int, end: int, value: string, part: string>>)")
    return F.when(F.rlike(text, F.lit(pattern)), let(row, place)).otherwise(empty)


def _spans(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")),
    )


def base_spans(text: Column) -> Column:
    """Spans of the three known patterns; matches that are too short are dropped after matching."""
    kinds = []
    for kind, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)):
        if kind == "hex":
            # a run has one match, so looking only for long runs gives the same spans
            pattern = rf"(?<![0-9a-f])[0-9a-f]{{{SHORTEST[kind]},}}+"
        long_enough = F.filter(matches(text, pattern, group), lambda m: F.length(m["part"]) >= SHORTEST[kind])
        kinds.append(_spans(long_enough, kind))
    return F.concat(*kinds)


def _flagged(value: Column, start: Column, bits: float, window: int) -> Column:
    """Stretches of a candidate whose windows have at least ``bits`` of entropy.

    A window's entropy is log2(w) - sum(c * log2(c)) / w. Sliding by one character changes two of the
    counts c, and the sum by the difference of their terms.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    most = F.lit(window * (math.log2(window) - bits) + 1e-9)
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(_ALPHABET), c) - 1)
    span = "struct<start: int, end: int>"

    def run(code: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(code, i), F.coalesce(F.get(code, i - window), F.lit(-1))
            rise, fall = F.get(acc["counts"], new), F.get(acc["counts"], old)
            moved = F.when(
                new != old,
                acc["sum"] + F.get(terms, rise + 1) - F.get(terms, rise)
                + F.coalesce(F.get(terms, fall - 1) - F.get(terms, fall), F.lit(0.0)),
            ).otherwise(acc["sum"])

            def slid(total: Column) -> Column:
                hit = (i >= window - 1) & (total <= most)
                first = i - (window - 1)
                goes_on = hit & (acc["end"] >= first)
                closes = hit & ~goes_on & (acc["end"] > 0)
                return F.struct(
                    F.transform(
                        acc["counts"],
                        lambda c, j: c + F.when(j == new, 1).otherwise(0) - F.when(j == old, 1).otherwise(0),
                    ).alias("counts"),
                    total.alias("sum"),
                    F.when(hit & ~goes_on, first).otherwise(acc["start"]).alias("start"),
                    F.when(hit, i + 1).otherwise(acc["end"]).alias("end"),
                    F.when(
                        closes,
                        F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))),
                    ).otherwise(acc["done"]).alias("done"),
                )

            return let(moved, slid)

        zero = F.struct(
            F.array_repeat(F.lit(0), len(_ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
            F.lit(0).alias("start"), F.lit(0).alias("end"), F.expr(f"CAST(array() AS array<{span}>)").alias("done"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(code) - 1), zero, step,
            lambda acc: F.when(
                acc["end"] > 0,
                F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))),
            ).otherwise(acc["done"]),
        )

    return F.transform(
        let(codes, run),
        lambda s: F.struct(
            (start + s["start"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), (start + s["end"]).alias("end")
        ),
    )


def entropy_spans(
    text: Column, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW
) -> Column:
    """Stretches of high entropy in candidate strings that are not on the allow-list."""
    found = []
    for pattern, bits in classes:
        candidates = F.filter(
            matches(text, pattern),
            lambda m: ~F.rlike(m["value"], F.lit(f"^(?:{'|'.join(allowed)})$")),
        )
        found.append(F.flatten(F.transform(candidates, lambda m: _flagged(m["value"], m["start"], bits, window))))
    return F.array_distinct(F.concat(*found))


def secret_spans(df: DataFrame, **entropy) -> DataFrame:
    """Adds ``base`` and ``spans``, arrays of (start, kind, end) sorted by start, kind, end.

    ``spans`` has all of ``base`` and the entropy spans that no single base span or other entropy span
    covers; one that a base span only overlaps stays whole. A null text counts as empty and has no spans; other columns are kept, but none may be
    called base or spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = df.withColumn("base", F.array_sort(base_spans(text)))
    more = F.filter(
        F.col("_entropy"),
        lambda e: ~F.exists("base", lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"]))
        & ~F.exists(
            "_entropy",
            lambda o: (o["start"] <= e["start"]) & (e["end"] <= o["end"]) & ((o["start"] != e["start"]) | (e["end"] != o["end"])),
        ),
    )
    return (
        found.withColumn("_entropy", entropy_spans(text, **entropy))
        .withColumn("spans", F.array_sort(F.concat("base", more)))
        .drop("_entropy")
    )


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def find_secrets(df: DataFrame, **entropy) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row; see ``secret_spans``.

    A null doc_id is kept, repeated rows are scanned each, an empty table gives no rows.
    """
    found = secret_spans(df.select("doc_id", "text"), **entropy)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.encode(span_text(F.col("base")), "utf-8"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by the mask."""
    empty = F.expr("CAST(array() AS array<struct<start: int, end: int>>)")

    def join(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        wider = F.array(
            F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        )
        apart = (F.size(done) == 0) | (s["start"] > last["end"])
        return F.when(apart, F.concat(done, own)).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), wider))

    def mask_out(merged: Column) -> Column:
        kept = F.transform(
            merged,
            lambda s, i: F.substr(
                text, F.coalesce(F.get(merged, i - 1)["end"], F.lit(0)) + 1,
                s["start"] - F.coalesce(F.get(merged, i - 1)["end"], F.lit(0)),
            ),
        )
        tail = F.substr(text, F.element_at(merged, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(kept, mask), F.lit(mask), tail)

    return F.when(F.size(spans) > 0, let(F.aggregate(spans, empty, join), mask_out)).otherwise(text)
