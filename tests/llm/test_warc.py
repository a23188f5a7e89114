from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from logsilt.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"
ROWS = [
    (5, "u5", "same", "p"), (2, "u2", "same", None), (9, None, "same", "p"), (2, "u2", "same", "p"), (1, "a%0A\nb", "über 日本", "p"),
    (None, "n", "same", "p"), (None, None, None, None), (3, "", None, "p"), (4, "u", "", "p"), (7, "u", "x" * 700_000, "p"),
    (None, "m", "only here", "p"), (None, "m", "only here", "p"),
]


def brute(rows, least=0):
    found = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        ids = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        first = min(ids) if ids and len(data) >= least else None
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        found.append((page, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=str)


def read(spark, path):
    rows = warc.read_bundles(spark, path).collect()
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    path = warc.write_bundles(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"), min_bytes=least, frame_bytes=200)
    assert read(spark, path) == brute(ROWS, least)
    stored = {r.page_id: r for r in warc.read_bundles(spark, path).collect() if r.record_type == "response"}
    assert bytes(stored[7].payload) == b"x" * 700_000 and stored[1].url == "a%0A\nb" and stored[1].payload.decode() == "über 日本"


def test_files_are_seekable(spark, tmp_path):
    path = warc.write_bundles(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"), frame_bytes=100, bundle_bytes=150)
    files = [f for f in Path(path).glob("part-*") if f.stat().st_size]
    assert len(files) > 1
    for file in files:
        data = file.read_bytes()
        bundle = warc.Bundle(data)
        # any Zstandard reader gives the whole file, as it skips index and seek table
        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as stream:
            whole = stream.read()
        assert whole == b"".join(bytes(bundle.frame(i)) for i in range(len(bundle.frames)))
        assert whole.startswith(b"WARC/1.1\r\n") and data[-4:] == b"\xb1\xea\x92\x8f"


def test_index_and_fetch(spark, tmp_path):
    path = warc.write_bundles(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"), frame_bytes=100)
    index = warc.read_index(spark, path)
    assert index.count() == len(ROWS)
    got = warc.fetch(spark, index.where(F.col("page_id").isin(1, 7))).collect()
    assert sorted((r.page_id, len(r.payload)) for r in got) == [(1, 12), (7, 700_000)]
    assert warc.fetch(spark, index.where("page_id = -5")).collect() == []


def test_empty_table(spark, tmp_path):
    path = warc.write_bundles(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_bundles(spark, path).collect() == [] and warc.read_index(spark, path).collect() == []


def test_damage_is_found():
    writer = warc.BundleWriter()
    writer.add(warc.Record(1, "response", None, 3, "A" * 32, b"abc", None))
    with pytest.raises(ValueError, match="digest"):
        list(warc.Bundle(writer.finish()).records())
