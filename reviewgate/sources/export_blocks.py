"""Quoted CSV exports read by many tasks a file (A1).

A line feed ends a record only outside quotes, and a byte stands inside quotes
when an odd number of quotes stands before it. So a first pass counts the quotes
of every block of a file, a running sum over the blocks says on which side each
block begins, and a second pass cuts every block at true record ends. A record
belongs to the block that holds its first byte; its task reads on past the end
of the block to finish it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 32 << 20
_PIECE = 1 << 20
_ROWS = 4096
_QUOTE, _FEED = 34, 10
_COMPRESSED = r"(?i)\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def _open(path: str):
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    where, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return where.open_input_file(name)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the files; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")


def has_compressed(files: DataFrame) -> bool:
    return bool(files.where(F.col("path").rlike(_COMPRESSED)).head(1))


def _count_quotes(batches):
    for batch in batches:
        quotes = []
        for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            n = 0
            with _open(path) as f:
                f.seek(start)
                while start < end and (piece := f.read(min(_PIECE, end - start))):
                    n += piece.count(b'"')
                    start += len(piece)
            quotes.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())],
                                         ["path", "start", "end", "quotes"])


def blocks_of(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, start, end, inside``: one narrow row a block, ``inside`` telling
    whether its first byte stands inside quotes. A file with an odd number of
    quotes raises: its records cannot be told apart this way."""
    blocks = files.select("path", F.col("length"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias("start")) \
        .select("path", "start", F.least(F.col("start") + block_bytes, "length").alias("end"))
    counted = blocks.repartition(max(1, blocks.count())).mapInArrow(
        _count_quotes, "path string, start long, end long, quotes long").checkpoint()
    odd = counted.groupBy("path").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").head(1)
    if odd:
        raise ValueError(f"unbalanced quotes in {odd[0].path}; read it with block_bytes=None")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("path", "start", "end", (
        F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _ends(data: bytes, inside: bool) -> np.ndarray:
    """Offsets just after each line feed that ends a record."""
    data = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(data == _FEED)
    sides = np.searchsorted(np.flatnonzero(data == _QUOTE), feeds) + inside
    return feeds[sides % 2 == 0] + 1


def records_in(f, start: int, end: int, inside: bool):
    """(offset, bytes) of the records that begin in ``start`` to ``end``."""
    at_edge = start == 0
    if start:
        f.seek(start - 1)
        at_edge = f.read(1) == b"\n" and not inside
    f.seek(start)
    data = f.read(end - start)
    cuts = _ends(data, inside).tolist()
    starts = ([0] if at_edge else []) + [c for c in cuts if c < len(data)]
    if not starts:
        return
    for a, b in zip(starts, starts[1:]):
        yield start + a, data[a:b]
    rest = [data[starts[-1]:]]
    if not cuts or cuts[-1] != len(data):  # the last record goes on behind the block
        odd = rest[0].count(b'"') % 2 == 1
        while piece := f.read(_PIECE):
            stop = _ends(piece, odd)
            rest.append(piece[:stop[0]] if len(stop) else piece)
            if len(stop):
                break
            odd ^= piece.count(b'"') % 2 == 1
    yield start + starts[-1], b"".join(rest)


def _cut(batches):
    for batch in batches:
        for path, start, end, inside in zip(*(c.to_pylist() for c in batch.columns)):
            with _open(path) as f:
                held = []
                for at, record in records_in(f, start, end, inside):
                    record = record.removesuffix(b"\n").removesuffix(b"\r")
                    if at and record:  # at 0 stands the header
                        held.append(record)
                    if len(held) == _ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])


def export_records(blocks: DataFrame) -> DataFrame:
    """``record``: every record but the header line of each file, as text
    without its line end; empty lines are left out."""
    spread = blocks.repartition(max(1, blocks.count()))
    return spread.mapInArrow(_cut, "record binary").select(F.col("record").cast("string").alias("record"))
