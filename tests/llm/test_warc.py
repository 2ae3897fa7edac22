from __future__ import annotations

import gzip
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundflow.llm import warc
from fundflow.sources.workspace import new_folder

PAGES = "page_id long, url string, html string, digest string, payload int"


class Counting(io.BytesIO):
    """Remembers how much was read as blocks."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_blocks_of_records_that_fail_a_filter_are_not_read():
    rows = [
        {"record_id": f"urn:x:{k}", "record_type": kind, "payload": b"p" * 1_000}
        for k, kind in enumerate(["response", "resource", "response"])
    ]
    stream = Counting(b"".join(map(warc.record, rows)))
    tests = [warc.HeaderTest("record_type", "in", ("resource",))]
    found = list(warc.records(stream, tests, block=True, verify=True))
    assert [r["record_id"] for r in found] == ["urn:x:1"]
    assert found[0]["payload"] == b"p" * 1_000 and stream.taken == 1_000
    stream.seek(0)
    heads = list(warc.records(stream, [], block=False, verify=False))
    assert len(heads) == 3 and "payload" not in heads[0] and stream.taken == 1_000


def test_damage_fails():
    whole = warc.record({"record_type": "resource", "payload": b"abc"})
    for broken in (whole[:-6], whole[:30], b"junk" + whole):
        with pytest.raises((EOFError, ValueError)):
            list(warc.records(io.BytesIO(broken), [], True, True))
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(io.BytesIO(whole.replace(b"abc", b"abd")), [], True, True))


ROWS = [
    (1, "http://a/1", "same"), (2, None, "same"), (3, "http://a\r\nX: y", "same"), (4, "u", None),
    (5, "u", ""), (None, "u", "same"), (6, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\n"), (7, "u", "é" * 200_000),
    (8, "u", "twice"), (8, "u", "twice"),
]


def test_round_trip_with_revisits(spark):
    pages = spark.createDataFrame([(*r, "d", 3) for r in ROWS], PAGES).repartition(3)
    path = new_folder(spark, "warc")
    warc.write_warc(warc.page_records(pages), path, file_bytes=200)
    files = list(Path(path).glob("*"))
    assert len(files) > 3 and not [f for f in files if f.name.startswith(".")]
    got = warc.read_warc(spark, path, verify=True).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["record_id"].removeprefix("urn:page:"), []).append(r)
    assert {k: v[0]["record_type"] for k, v in by.items()} == {
        "1": "revisit", "2": "revisit", "3": "response", "4": "revisit", "5": "response",
        "": "revisit", "6": "response", "7": "response", "8": "response",
    }
    assert {by[k][0]["refers_to"] for k in ("1", "2", "")} == {"urn:page:3"}
    assert bytes(by["7"][0]["payload"]) == ("é" * 200_000).encode()
    assert bytes(by["6"][0]["payload"]).startswith(b"WARC/1.1")
    assert by["2"][0]["target_uri"] is None and by["3"][0]["target_uri"] == "http://a%0D%0AX: y"
    assert len(by["8"]) == 2 and all(r["payload_digest"] for r in got)
    assert by["1"][0]["payload_bytes"] == 0

    heads = warc.read_warc(spark, path, ["record_id", "record_type"])
    few = heads.filter((F.col("record_type") == "revisit") & F.col("record_id").startswith("urn:page:"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert few.count() == 4
    assert "Filter" not in plan.split("BatchScan")[0]


def test_plain_and_empty_folders(spark):
    path = new_folder(spark, "warc")
    assert warc.read_warc(spark, path).count() == 0
    empty = spark.createDataFrame([], PAGES)
    warc.write_warc(warc.page_records(empty), path)
    assert warc.read_warc(spark, path).count() == 0
    Path(path).mkdir(parents=True, exist_ok=True)
    body = warc.record({"record_type": "metadata", "payload": b"m", "record_id": "urn:x:1"})
    Path(path, "a.warc").write_bytes(body * 3)
    Path(path, "b.warc.gz").write_bytes(gzip.compress(body))
    assert warc.read_warc(spark, path).filter("record_type = 'metadata'").count() == 4


def test_files_are_packed_whole(tmp_path):
    for k, size in enumerate([10, 60, 50, 30]):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * size)
    (tmp_path / ".hidden.warc").write_bytes(b"x")
    reader = warc.WarcReader(warc.SCHEMA, str(tmp_path), False, 80)
    packed = [[Path(p).name for p in part.paths] for part in reader.partitions()]
    assert packed == [["1.warc"], ["2.warc", "3.warc"], ["0.warc"]]
