import csv
import gzip
import io as stdio
import random

import pytest

from reviewgate.sources import export_blocks, io

NAMES = [io.EXPORT_ID, io.EXPORT_DATE, io.EXPORT_ISSUE, io.EXPORT_PRODUCT, io.EXPORT_NARRATIVE]


def export(n, feed="\n", seed=1, long=0):
    rng = random.Random(seed)
    bits = ["plain", 'a "quoted" word', "two\nlines", "comma, here", '"', "\n\n", "é😀", "crlf\r\nin text", ""]
    rows = [[str(i), f"2024-01-{1 + i % 28:02d}", rng.choice(["x", "y, z"]), rng.choice("ab"),
             " ".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))] for i in range(n)]
    if long:
        rows[n // 2][4] = 'very "long"\n' * long
    out = stdio.StringIO(newline="")
    csv.writer(out, lineterminator=feed).writerows([NAMES] + rows)
    return rows, out.getvalue().encode()


@pytest.mark.parametrize("feed", ["\n", "\r\n"])
def test_every_block_size_gives_the_same_records(feed, monkeypatch):
    rows, data = export(12, feed)
    monkeypatch.setattr(export_blocks, "_PIECE", 5)
    for size in [*range(1, 70), len(data) - 1, len(data)]:
        for source in (data, data.removesuffix(feed.encode())):
            got = []
            for start in range(0, len(source), size):
                inside = source[:start].count(b'"') % 2 == 1
                got += list(export_blocks.records_in(stdio.BytesIO(source), start, min(start + size, len(source)), inside))
            assert b"".join(r for _, r in got) == source
            parsed = [next(csv.reader(stdio.StringIO(r.decode(), newline=""))) for _, r in got]
            assert parsed == [NAMES] + rows


def read(spark, path, **options):
    return sorted((tuple(r) for r in io.read_narratives_csv(spark, str(path), **options).collect()), key=repr)


def test_many_tasks_read_one_file_like_one(spark, tmp_path):
    rows, data = export(300, long=500)
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + data)
    (tmp_path / "b.csv").write_bytes(export(40, seed=2)[1].removesuffix(b"\n"))
    (tmp_path / "c.csv").write_bytes(b"")
    got = read(spark, tmp_path, block_bytes=700)
    assert got == read(spark, tmp_path, block_bytes=None) == read(spark, tmp_path)
    assert {r[0]: r[4] for r in read(spark, tmp_path / "a.csv", block_bytes=700)} == \
        {r[0]: r[4] for r in rows if r[4]}
    blocks = export_blocks.blocks_of(export_blocks.files_of(spark, str(tmp_path / "a.csv")), 700)
    records = export_blocks.export_records(blocks)
    assert records.rdd.getNumPartitions() == blocks.count() > 30


def test_line_ends_inside_quotes_stay_as_written(spark, tmp_path):
    rows, data = export(60, "\r\n")
    (tmp_path / "x.csv").write_bytes(data)
    assert {r[0]: r[4] for r in read(spark, tmp_path / "x.csv", block_bytes=200)} == {r[0]: r[4] for r in rows if r[4]}


def test_products_unbalanced_and_compressed_files(spark, tmp_path):
    rows, data = export(30)
    (tmp_path / "x.csv").write_bytes(data)
    assert len(read(spark, tmp_path / "x.csv", products=["a"], block_bytes=64)) == \
        sum(1 for r in rows if r[4] and r[3] == "a")
    (tmp_path / "odd.csv").write_bytes(data + b'9,2024-01-01,x,a,5" pipe\n')
    with pytest.raises(ValueError, match="unbalanced quotes in .*odd.csv"):
        io.read_narratives_csv(spark, str(tmp_path / "odd.csv"), block_bytes=64)
    (tmp_path / "x.csv.gz").write_bytes(gzip.compress(data))
    assert read(spark, tmp_path / "x.csv.gz", block_bytes=64) == read(spark, tmp_path / "x.csv")


def test_a_header_alone_has_no_records(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(export(0)[1])
    assert read(spark, tmp_path / "x.csv", block_bytes=8) == []
