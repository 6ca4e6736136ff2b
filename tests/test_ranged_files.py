"""Files read and copied in byte ranges by several tasks."""

from __future__ import annotations

import hashlib
import io
import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import types as T

from prodlake.sinks import copies
from prodlake.sources import json_arrays as J
from prodlake.sources.files import CORRUPT, scan_binary, scan_json_array
from prodlake.sources.ranged import TASK_BYTES, file_ranges, local_path

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])


def by_ranges(raw: bytes, size: int) -> list[bytes]:
    """The records of all ranges, each told by the ones before it how it begins."""
    f, out, quotes, depth = io.BytesIO(raw), [], 0, 0
    array = J._begins_with_array(f)
    for start in range(0, max(1, len(raw)), size):
        end = min(len(raw), start + size)
        out += J.records(f, start, end, bool(quotes % 2), depth, array)
        q, outside, inside = J.summary(f, start, end)
        depth += inside if quotes % 2 else outside
        quotes += q
    return out


def any_value(r: random.Random, depth: int = 0):
    kind = r.randrange(6)
    if kind == 0:
        return r.choice(['a"b', "\\", '\\"', "[{", "}]", "x,y", "", "é中", '\\\\"', "line\n"])
    if kind == 1 and depth < 3:
        return [any_value(r, depth + 1) for _ in range(r.randrange(3))]
    if kind == 2 and depth < 3:
        return {r.choice(["k", '"q"', "{", "\\"]): any_value(r, depth + 1) for _ in range(r.randrange(3))}
    return r.choice([None, True, 1.5, "text", 12])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 1000])
def test_ranges_of_any_size_give_the_records(size):
    r = random.Random(size)
    for _ in range(150):
        records = [{f"c{i}": any_value(r) for i in range(r.randrange(4))} for _ in range(r.randrange(6))]
        raw = json.dumps(records, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])).encode()
        assert [json.loads(x) for x in by_ranges(raw, size)] == records


@pytest.mark.parametrize("size", [4, 1000])
def test_broken_and_odd_arrays(size):
    assert by_ranges(b'[{"a":1},{"b":2},{"c": "x', size) == [b'{"a":1}', b'{"b":2}', b'{"c": "x']
    assert by_ranges(b'\xef\xbb\xbf[{"a":1}, 12, nul, [3], {"b":}, {"z":9}]', size) == [
        b'{"a":1}', b"12", b"nul", b"[3]", b'{"b":}', b'{"z":9}'
    ]
    assert by_ranges(b'{"a":[1]}', size) == [b'{"a":[1]}']
    assert by_ranges(b"", size) == by_ranges(b" \n", size) == by_ranges(b"[]", size) == []


def test_split_array_equals_whole_reader(spark, tmp):
    r = random.Random(1)
    for i, n in enumerate((0, 1, 400)):
        rows = [{"a": r.choice(["x", '"]},{[', "\\", None]), "b": "y" * r.randrange(90)} for _ in range(n)]
        Path(f"{tmp}/part {i}.json").write_text(json.dumps(rows, indent=i))
    split = J.scan_json_array_split(spark, tmp, SCHEMA, chunk_bytes=777)
    assert split.filter(f"{CORRUPT} IS NOT NULL").count() == 0
    key = lambda rows: sorted(map(str, rows))
    assert key(split.drop(CORRUPT).collect()) == key(scan_json_array(spark, tmp, SCHEMA).collect())


def test_one_large_file_is_read_by_several_tasks(spark, tmp):
    Path(f"{tmp}/one.json").write_text(json.dumps([{"a": str(i)} for i in range(5000)]))
    rows = J.scan_json_array_split(spark, tmp, SCHEMA, chunk_bytes=8192)
    from pyspark.sql import functions as F

    tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4 and {r.a for r in rows.collect()} == {str(i) for i in range(5000)}


def test_broken_file_keeps_its_good_records(spark, tmp):
    Path(f"{tmp}/b.json").write_text('[{"a": "1"}, {"a": nope}, {"a": "2"}, 7, {"a": "3", "b": "cut')
    got = {(r.a, r[CORRUPT]) for r in J.scan_json_array_split(spark, tmp, SCHEMA, chunk_bytes=10).collect()}
    assert got == {("1", None), ("2", None), (None, '{"a": nope}'), (None, "7"), (None, '{"a": "3", "b": "cut')}


def sources(folder: str) -> dict[str, bytes]:
    r = random.Random(2)
    out = {"empty.bin": b"", "small.bin": b"\x00\xff\n", "sub/large 1%.bin": r.randbytes(5 * 4096 + 17), "exact.bin": r.randbytes(8192)}
    for name, content in out.items():
        path = Path(folder) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return out


def test_copy_keeps_every_byte(spark, tmp):
    content = sources(f"{tmp}/in")
    report = copies.copy_files(spark, f"{tmp}/in", f"{tmp}/out", recursive=True, chunk_bytes=4096)
    assert {str(p.relative_to(f"{tmp}/out")): p.read_bytes() for p in Path(f"{tmp}/out").rglob("*") if p.is_file()} == content
    found = {os.path.relpath(r["copy"], f"{tmp}/out"): r for r in report.collect()}
    for name, data in content.items():
        ranges = [data[i : i + 4096] for i in range(0, max(1, len(data)), 4096)]
        sums = "".join(hashlib.sha256(x).hexdigest() for x in ranges)
        row = found[name]
        assert (row["length"], row["ranges"]) == (len(data), len(ranges))
        assert row["checksum"] == hashlib.sha256(sums.encode()).hexdigest()
    # again: replaced, nothing left over
    copies.copy_files(spark, f"{tmp}/in", f"{tmp}/out", recursive=True, chunk_bytes=4096)
    assert sum(p.is_file() for p in Path(f"{tmp}/out").rglob("*")) == len(content)


def test_copy_of_one_file_and_by_glob(spark, tmp):
    sources(f"{tmp}/in")
    copies.copy_files(spark, f"{tmp}/in/small.bin", f"{tmp}/one")
    assert os.listdir(f"{tmp}/one") == ["small.bin"]
    copies.copy_files(spark, f"file://{tmp}/in", f"file://{tmp}/some", glob="e*.bin")
    assert sorted(os.listdir(f"{tmp}/some")) == ["empty.bin", "exact.bin"]


def test_a_range_that_reads_back_differently_fails(spark, tmp, monkeypatch):
    def differing(batches):
        import pyarrow as pa

        for batch in batches:
            sums = [pa.array([x] * batch.num_rows) for x in "xy"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], [*batch.schema.names, "read_sum", "copy_sum"])

    sources(f"{tmp}/in")
    monkeypatch.setattr(copies, "_copies", differing)
    with pytest.raises(OSError, match="differently"):
        copies.copy_files(spark, f"{tmp}/in", f"{tmp}/out")
    assert not any(p.is_file() for p in Path(f"{tmp}/out").rglob("*.bin"))


def test_targets_without_places_are_refused(spark, tmp):
    with pytest.raises(ValueError, match="file: target"):
        copies.copy_files(spark, tmp, "s3a://bucket/folder")
    assert local_path("file:///a/b") == local_path("file:/a/b") == local_path("/a/b") == "/a/b"
    assert local_path("hdfs://h/a") is None


def test_ranges_cover_every_file(spark, tmp):
    sources(tmp)
    rows, tasks = file_ranges(spark, tmp, 4096, recursive=True, empty=True)
    got = rows.collect()
    assert tasks == len(got) == 1 + 1 + 6 + 2
    assert sum(r["end"] - r["start"] for r in got) == 3 + 5 * 4096 + 17 + 8192


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1000])
def test_binary_pieces_are_whole_lines(spark, tmp, size):
    r = random.Random(size)
    for name in ("a", "b", "c d%"):
        lines = [r.choice(["", "x", "é中,1", "y" * r.randrange(300)]).encode() for _ in range(60)]
        Path(f"{tmp}/{name}.bin").write_bytes(b"\n".join(lines) + r.choice([b"", b"\n", b"\n\n"]))
    Path(f"{tmp}/none.bin").write_bytes(b"")
    pieces = scan_binary(spark, tmp, glob="*.bin", piece_bytes=size).collect()
    for name in ("a", "b", "c d%"):
        found = sorted((p.start, bytes(p.content)) for p in pieces if p.path.endswith(f"/{name}.bin"))
        raw = Path(f"{tmp}/{name}.bin").read_bytes()
        assert b"".join(c for _, c in found) == raw
        assert all(raw[s : s + len(c)] == c for s, c in found)
        assert all(c.endswith(b"\n") for _, c in found[:-1])
        longest = max(map(len, raw.split(b"\n")))
        assert max(len(c) for _, c in found) <= size + longest + 1


def test_scan_binary_query_holds_pieces_of_a_file(spark, tmp, monkeypatch):
    from prodlake.plans import catalog, ingest
    from prodlake.schemas import FIELD_COLUMNS

    rows = [[f"{c}{i}" for c in range(len(FIELD_COLUMNS))] for i in range(400)]
    text = "\n".join([",".join(FIELD_COLUMNS), *map(",".join, rows)]) + "\n"
    Path(f"{tmp}/one.csv").write_text(text)
    monkeypatch.setattr(ingest, "field_csv", lambda *_: tmp)
    monkeypatch.setattr(ingest, "BINARY_PIECE", 1000)
    got = catalog.queries()["scan_binary"](spark, tmp)
    from pyspark.sql import functions as F

    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert sorted(map(list, got.collect())) == sorted(rows)


def test_tasks_follow_the_bytes_not_the_ranges(spark, tmp):
    sizes = {"a.bin": 1 << 30, "b.bin": (300 << 20) + 5}
    for name, size in sizes.items():
        with open(f"{tmp}/{name}", "wb") as f:
            f.truncate(size)
    rows, tasks = file_ranges(spark, tmp, 1 << 16)
    assert tasks == -(-sum(sizes.values()) // TASK_BYTES) == rows.rdd.getNumPartitions()
    from pyspark.sql import functions as F

    each = rows.withColumn("p", F.spark_partition_id())
    assert each.count() == (1 << 14) + 4801
    assert each.agg(F.sum(F.col("end") - F.col("start"))).first()[0] == sum(sizes.values())
    # neighbours stay together: a task has few runs of a file
    runs = each.select("path", "p", F.floor(F.col("range") / 100).alias("run")).distinct().count()
    assert runs < 5 * tasks


def test_a_task_flushes_a_file_once(tmp, monkeypatch):
    import pyarrow as pa

    Path(f"{tmp}/in").write_bytes(bytes(range(256)) * 40)
    flushed = []
    monkeypatch.setattr(copies.os, "fsync", lambda fd: flushed.append(fd))
    rows = [{"path": f"{tmp}/in", "partial": f"{tmp}/out", "start": i, "end": i + 1024} for i in range(0, 10240, 1024)]
    out = pa.Table.from_batches(copies._copies(iter([pa.RecordBatch.from_pylist(rows)]))).to_pylist()
    assert len(flushed) == 1 and Path(f"{tmp}/out").read_bytes() == Path(f"{tmp}/in").read_bytes()
    assert [r["start"] for r in out] == [r["start"] for r in rows]
    assert all(r["read_sum"] == r["copy_sum"] == hashlib.sha256(bytes(range(256)) * 4).hexdigest() for r in out)
