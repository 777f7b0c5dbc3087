"""Benchmark decontamination: test n-grams in a broadcast set, training windows scanned and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import PLAIN, Words, bounded_batches, scan, slices, utf8, windows

WINDOW = 10
#: Windows in one broadcast set. At some 200 bytes each it stays below 100 MB; a larger benchmark
#: is scanned for in several sets, one after the other over the same rows, without a shuffle.
BLOCK = 400_000


@dataclass
class WindowSet:
    """Normalised windows of benchmark items by length; ``items`` by the window's own words."""

    size: int
    items: dict[bytes, list[str]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, length: int, words: bytes, hashed: int, item: str | None) -> None:
        owners = self.items.setdefault(words, [])
        if item is not None and item not in owners:
            owners.append(item)
        self._pending.setdefault(length, set()).add(hashed)

    def __post_init__(self) -> None:
        self._pending: dict[int, set[int]] = {}

    def close(self) -> WindowSet:
        self.hashes = {n: np.sort(np.fromiter(v, np.uint64, len(v))) for n, v in self._pending.items()}
        self._pending = {}
        return self

    def spans(self, words: Words, first: int, last: int, known: dict[int, np.ndarray]) -> tuple[list, set[str]]:
        """Word ranges hit in one text, and the items that own them; a hash hit counts if its words are equal."""
        found, items = [], set()
        for length, where in known.items():
            for at in where[np.searchsorted(where, first):np.searchsorted(where, last - length, side="right")]:
                key = b" ".join(words.bytes_of(int(at) + k) for k in range(length))
                if key in self.items:
                    found.append((int(at) - first, int(at) - first + length))
                    items.update(self.items[key])
        return found, items

    def candidates(self, words: Words) -> dict[int, np.ndarray]:
        """By window length, the words at which a window with a known hash begins."""
        out = {}
        for length, hashes in self.hashes.items():
            own = windows(words.hash, length)
            if len(own) and len(hashes):
                table = np.zeros(1 << 20, bool)  # most windows end here
                table[hashes >> np.uint64(44)] = True
                maybe = np.flatnonzero(table[own >> np.uint64(44)])
                at = np.minimum(np.searchsorted(hashes, own[maybe]), len(hashes) - 1)
                out[length] = maybe[hashes[at] == own[maybe]]
        return out


def window_sets(benchmark: DataFrame, size: int, block: int) -> Iterator[WindowSet]:
    """The benchmark's windows in sets of about ``block``; rows come to the driver a few at a time."""
    current = WindowSet(size)
    for row in benchmark.toLocalIterator():
        column = pa.array([row.text], pa.string())
        words = scan(*utf8(column), PLAIN)
        length = min(size, len(words.hash))
        if not length:
            continue
        item = None if row.item is None else str(row.item)
        for at, hashed in enumerate(windows(words.hash, length)):
            current.add(length, b" ".join(words.bytes_of(at + k) for k in range(length)), int(hashed), item)
            if len(current.items) >= block:
                yield current.close()
                current = WindowSet(size)
    yield current.close()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    size: int = WINDOW, block: int = BLOCK, name: str = "found",
) -> DataFrame:
    """Every row of ``docs`` with a struct ``name`` of n_words, hit word ranges (spans) and items.

    Words are runs of a-z (A-Z lower-cased), 0-9 and anything beyond ASCII. A window is ``size``
    consecutive words of a benchmark item, or the whole item if it has fewer. A range is where a
    window occurs, ranges that touch are joined; items holds the ids as text, sorted. Documents are
    read once and never shuffled. The benchmark is broadcast in sets of ``block`` windows at most;
    with several sets, each is a further pass over the same rows in the same task.

    Null and empty texts have no words. Items without words match nothing; a null item id hits words
    but is not listed. Repeated items and rows are as good as one or count each. A column of ``docs``
    called ``name`` is replaced. Empty tables give no rows or no hits.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType([*kept, T.StructField(name, FOUND)])
    arrow = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
    items = benchmark.select(F.col(f"`{item_column}`").alias("item"), F.col("text"))
    out = docs.drop(name) if name in docs.columns else docs

    def scanner(shared, again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                raw, bounds = utf8(batch.column(batch.schema.names.index(text_column)))
                rows = []
                for a, b in slices(bounds):
                    words = scan(raw, bounds[a:b + 1], PLAIN)
                    hits = known.candidates(words)
                    starts = np.unique(np.concatenate([*hits.values(), np.empty(0, np.int64)]))
                    touched = set((np.searchsorted(words.first, starts, side="right") - 1).tolist())
                    for i in range(b - a):
                        first, last = int(words.first[i]), int(words.first[i + 1])
                        spans, owners = known.spans(words, first, last, hits) if i in touched else ([], set())
                        rows.append({"n_words": last - first, "spans": merged(spans), "items": sorted(owners)})
                if again:
                    for old, new in zip(batch.column(len(kept)).to_pylist(), rows, strict=True):
                        new["spans"] = merged([*map(tuple, old["spans"]), *new["spans"]])
                        new["items"] = sorted({*old["items"], *new["items"]})
                columns = [batch.column(k) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, arrow)], [*(f.name for f in kept), name])

        return run

    for k, one in enumerate(window_sets(items, size, block)):
        out = out.mapInArrow(scanner(spark.sparkContext.broadcast(one), k > 0), schema)
    return out


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row: n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined) and contaminated."""
    found = find_contamination(docs.select(F.col(f"`{id_column}`").alias("doc_id"), "text"), benchmark)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs."""
    name = "found__"
    return find_contamination(docs, benchmark, name=name).filter(F.size(f"{name}.spans") == 0).drop(name)


def drop_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the words of benchmark windows cut out of the text; the rest stays as it is.

    A hit range goes with what stands between its words, and a space takes its place.
    """
    name = "found__"
    found = find_contamination(docs, benchmark, name=name)
    schema = docs.schema
    arrow_names = [f.name for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = arrow_names.index("text")
            column = batch.column(at)
            texts = column.to_pylist()
            for i, one in enumerate(batch.column(len(arrow_names)).to_pylist()):
                if one["spans"]:
                    data = texts[i].encode()
                    words = scan(*utf8(pa.array([texts[i]], pa.string())), PLAIN)
                    pieces, past = [], 0
                    for a, b in one["spans"]:
                        pieces.append(data[past:int(words.start[a])])
                        past = int(words.end[b - 1])
                    texts[i] = b" ".join([*pieces, data[past:]]).decode()
            columns = [pa.array(texts, column.type) if k == at else batch.column(k) for k in range(len(arrow_names))]
            yield pa.RecordBatch.from_arrays(columns, arrow_names)

    return found.mapInArrow(cut, schema)
