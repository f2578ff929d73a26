import base64
import hashlib

import pytest

from reviewgate.llm.warc import WarcReader, archive_round_trip, read_warc, write_warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows],
                                 "page_id long, url string, html string, digest string").repartition(3)


ROWS = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (9, None, "<p>é</p>"), (3, "u\r\nX: y", "one"),
        (4, "u", None), (5, "u", ""), (6, "u", "trap\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n"),
        (7, "u", "ends with breaks\r\n\r\n"), (8, "u", "z" * 3_000_000), (9, "again", "<p>é</p>"), (None, "u", "no id"),
        (10, "u", "\n\n"), (-3, "u", "minus"), (-4, "u", "minus")]


def brute(rows, min_bytes=0):
    body = [(h or "").encode() for _, _, h in rows]
    out = []
    for (i, _, _), b in zip(rows, body):
        best = max((j for (j, _, _), c in zip(rows, body) if c == b and j is not None), default=None)
        ref = best if len(b) >= min_bytes and best is not None and best != i else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if ref is not None else "response", ref))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip(spark, min_bytes):
    got = archive_round_trip(pages(spark, ROWS), min_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS, min_bytes)


def test_empty(spark):
    assert archive_round_trip(pages(spark, [])).collect() == []


def test_bodies_predicates_and_plan(spark, tmp_path):
    write_warc(pages(spark, ROWS), f"file://{tmp_path}/w", records_per_file=2)
    back = read_warc(spark, f"file://{tmp_path}/w").collect()
    assert len(back) == len(ROWS)
    kinds = read_warc(spark, f"file://{tmp_path}/w", "none").groupBy("record_type").count().collect()
    assert dict(map(tuple, kinds)) == {"response": 10, "revisit": 4}
    bodies = {r.record_id: bytes(r.payload) for r in back if r.record_type == "response"}
    for i, _, h in ROWS:
        name = f"<urn:x-page:{'' if i is None else i}>"
        assert name not in bodies or bodies[name] == (h or "").encode()
    some = read_warc(spark, f"file://{tmp_path}/w").where("record_id IN ('<urn:x-page:3>', '<urn:x-page:8>')")
    assert sorted(r.read_length for r in some.collect()) == [3, 3_000_000]


def test_partitions_and_broken_files(tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    reader = WarcReader({"path": f"file://{tmp_path}", "partitionbytes": "80"})
    parts = reader.partitions()
    assert [len(p.paths) for p in parts] == [2, 2, 1]
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 5
    (tmp_path / "bad.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 30\r\n\r\nabc")
    with pytest.raises(ValueError):
        [list(reader.read(p)) for p in reader.partitions()]
    with pytest.raises(ValueError):
        WarcReader({"path": "x", "payload": "some"})
