import base64
import gzip
import hashlib
import json
from pathlib import Path

import pytest

from grainmill.llm import warc
from grainmill.llm.oracles import ORACLES
from grainmill.llm.queries import QUERIES
from tests.oracle import assert_same


def test_query_equals_its_sql(spark, small):
    assert_same(QUERIES["op2_warc_round_trip"](spark, small), ORACLES["op2_warc_round_trip"], small)


def rows_of(spark):
    rows = [(i, f"http://h/{i} é\n", "<p>é" + "x" * i) for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (50, "u", ""), (103, "u", "<p>é"), (None, "u", "<p>é"), (7, "http://h/7 é\n", "<p>é" + "x" * 7), (104, "u", "y" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_of_odd_rows(spark):
    df = rows_of(spark).selectExpr("*", "'a' as record_type")
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, shard_bytes=20_000, roll_bytes=2_000).collect())
    plain = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
    want = []
    for i, p in plain:
        first = min((j for j, q in plain if q == p and j is not None), default=None)
        again = first is not None and i != first
        want.append((str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_files_are_the_same_for_any_partitioning_and_manifest_lists_them(spark, tmp_path):
    seen = []
    for n in (1, 5):
        folder = f"file://{tmp_path}/{n}"
        warc.write_archives(rows_of(spark).repartition(n), folder, shard_bytes=20_000, roll_bytes=2_000)
        at = Path(f"{tmp_path}/{n}")
        manifest = json.loads((at / "manifest.json").read_text())["files"]
        assert not (at / "_temporary").exists() and len(manifest) > 2 and sum(f["records"] for f in manifest) == 47
        files = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in at.glob("*.warc.gz")}
        assert files == {f["name"]: f["sha256"] for f in manifest}
        seen.append(files)
        ids = [int(line.split(b": ")[1]) for p in sorted(at.glob("*.gz")) for line in gzip.decompress(p.read_bytes()).split(b"\r\n") if line.startswith(b"Row-Id: ")]
        assert ids == sorted(ids)
    assert seen[0] == seen[1]


def test_shards_are_cut_by_bytes_wherever_ids_lie(spark, tmp_path):
    """Extreme and far ids, a third without an id and a third of one id leave shards of about the same size."""
    page = "<p>" + "x" * 2000
    far = [(-(2**63) + 1, "a", page), (2**62, "b", page), (2**40, "c", page)]
    rows = far + [(i, f"u{i}", f"{page}{i}") for i in range(600)] + [(7, f"v{i}", f"{page}v{i}") for i in range(600)] + [(None, f"w{i}", f"{page}w{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    warc.write_archives(df, folder, shard_bytes=100_000)
    records = [f["records"] for f in json.loads((tmp_path / "w/manifest.json").read_text())["files"]]
    assert sum(records) == 1803 and len(records) > 40 and max(records) <= 2 * 1803 / len(records)
    got = {r.page_id: r for r in warc.read_archives(spark, folder).where("refers_to is not null or page_id < 0").collect()}
    assert got[2**62].refers_to == got[2**40].refers_to == -(2**63) + 1 and got[-(2**63) + 1].record_type == "response"


def test_shards_grow_rather_than_pass_their_limit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SHARDS", 3)
    facts = warc.write_archives(rows_of(spark), f"file://{tmp_path}/w", shard_bytes=1)
    assert len({r.name.split("-")[1] for r in facts.collect()}) <= 3


def test_damage_is_noticed():
    whole = warc.page_record(1, "u", b"abc")
    record = next(warc.members(whole))
    assert warc.page_facts(*warc.parsed(record))[1] == 3
    with pytest.raises(ValueError):
        warc.parsed(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.members(whole[:-9]))
