"""Token ids in files: documents in id order, segments of rANS blocks with checkpoints and checksums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm import rans
from touchline.llm.text import bounded_batches
from touchline.llm.tokens import encoded_texts

#: A segment closes with the document that takes it to so many ids. It has one frequency table,
#: counted over all its ids and shared by its blocks.
SEGMENT = 4 << 20

_LONGS = T.ArrayType(T.LongType())
#: One row of the files is one segment.
FORMAT = T.StructType([
    T.StructField("part", T.LongType()),  # the range of document ids, in order
    T.StructField("segment", T.LongType()),  # within the part, in order
    T.StructField("first_token", T.LongType()),  # ids of the part before it
    T.StructField("n_tokens", T.LongType()),
    T.StructField("doc_ids", _LONGS),
    T.StructField("doc_tokens", _LONGS),
    T.StructField("bits", T.LongType()),  # the frequencies sum to 2^bits
    T.StructField("symbols", _LONGS),
    T.StructField("freqs", _LONGS),
    T.StructField("checkpoints", _LONGS),  # by block: its first word in the payload
    T.StructField("states", T.BinaryType()),  # by block and lane: 64-bit states, little-endian
    T.StructField("checksums", _LONGS),  # by block: crc32 of its ids as little-endian 32-bit integers
    T.StructField("payload", T.BinaryType()),  # 32-bit words, little-endian
])
_ARROW = pa.schema([
    (f.name, pa.list_(pa.int64()) if f.dataType == _LONGS else pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64())
    for f in FORMAT.fields
])


def _block_sums(ids: np.ndarray) -> list[int]:
    return [zlib.crc32(ids[a:a + rans.BLOCK]) for a in range(0, len(ids), rans.BLOCK)]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end: int = 2, id_column: str = "doc_id", text_column: str = "text",
    segment: int = SEGMENT,
) -> None:
    """Encode every whole text, close it with ``end``, and write the ids in ascending order of documents.

    One shuffle deals the texts out by ranges of ids; a task then encodes, counts and codes its range
    in one pass, a segment at a time. Segments hold whole documents. Null and empty texts are the
    single id ``end``. Null ids come first. Rows with equal ids stay together, in the order of their texts.
    An empty table writes no segment.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        total = 0

        def closed() -> pa.RecordBatch:
            nonlocal number, before, total
            ids = np.concatenate(held).astype(np.uint32)
            c = rans.encode(ids)
            row = (part, number, before, len(ids), list(names), np.concatenate(sizes).tolist(), c.bits, c.symbols, c.freqs,
                   c.offsets, c.states.astype("<u8").tobytes(), _block_sums(ids), c.words.astype("<u4").tobytes())
            number, before, total = number + 1, before + len(ids), 0
            names.clear(), sizes.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, coded in encoded_texts(tokenizer, batch.column(1), end):
                a, count = 0, len(coded.first) - 1
                while a < count:
                    b = int(np.searchsorted(coded.first, coded.first[a] + segment - total))
                    b = min(max(b, a + 1), count)
                    names.extend(own[row + a:row + b])
                    sizes.append(np.diff(coded.first[a:b + 1]))
                    held.append(coded.ids[coded.first[a]:coded.first[b]].copy())
                    total += len(held[-1])
                    a = b
                    if total >= segment:
                        yield closed()
        if total:
            yield closed()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, FORMAT).write.parquet(path)


def _values(batch: pa.RecordBatch, k: int) -> dict:
    """A row of the files by column: lists as Arrow arrays, whose numbers need not become Python objects, the rest as Python values."""
    row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
    return {name: v.values if isinstance(v, pa.ListScalar) else v.as_py() for name, v in row.items()}


def _segment(row: dict) -> rans.Coded:
    return rans.Coded(
        row["n_tokens"], row["bits"], row["symbols"].to_numpy(), row["freqs"].to_numpy(),
        np.frombuffer(row["payload"], "<u4"), row["checkpoints"].to_numpy(),
        np.frombuffer(row["states"], "<u8").reshape(-1, rans.LANES),
    )


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of token files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    Segments are decoded side by side; a block whose checksum differs raises ValueError. ``start``
    counts the ids of all documents before, so the totals of the parts, one number for each task
    that wrote, are summed on the driver.
    """
    bounded_batches(spark)
    files = spark.read.schema(FORMAT).parquet(path)
    totals = sorted((r.part, r.n) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).toLocalIterator())
    before, base = 0, []
    for part, n in totals:
        base.append((part, before))
        before += n
    bases = spark.createDataFrame(base, "part long, base long")
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("within", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", _LONGS)] if with_ids else []),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = _values(batch, k)
                ids = rans.decode(_segment(row))
                if _block_sums(ids) != row["checksums"].to_numpy().tolist():
                    raise ValueError(f"part {row['part']}, segment {row['segment']}: a block's checksum differs")
                sizes = row["doc_tokens"].to_numpy()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                columns = [
                    pa.array(np.full(len(sizes), row["part"]), pa.int64()), row["doc_ids"],
                    pa.array(starts + row["first_token"]), pa.array(sizes),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    rows = files.mapInArrow(run, schema).join(F.broadcast(bases), "part")
    return rows.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32",
                       *(["ids"] if with_ids else []))
