"""Hard negatives for contrastive training by an inverted multi-index with certified search."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import bounded_batches
from touchline.session import scratch_path

#: Codewords of each half; their pairs are the cells.
CODEWORDS = 16
#: Vectors that train the codebooks. They only shape the cells; every row is indexed, whatever the sample.
SAMPLE = 20_000
ROUNDS = 12
#: Rows of a shard of the index; a task holds one shard at a time.
ROWS_PER_SHARD = 131_072
LEAST_SHARDS = 24
#: Rows that are scored at once while cells are visited.
CHUNK = 1024

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95

FOUND = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("window", T.LongType()),
    T.StructField("id", T.LongType()), T.StructField("score", T.LongType()),
])


def usable_vectors(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    label: Column | None = None,
) -> DataFrame:
    """id, label and v, the components as whole numbers: floor(SCALE * x), x as double.

    Rows without an id or a label, without a vector, and with a null or non-finite component are left out.
    """
    x = F.transform(F.col(f"`{vector_column}`"), lambda c: c.cast("double"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    out = rows.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        (F.col(f"`{label_column}`") if label is None else label).cast("long").alias("label"), x.alias("x"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(F.coalesce(good, F.lit(False)))
    return out.select("id", "label", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


@dataclass(frozen=True)
class Codebooks:
    """Codewords of the first ``cut`` components and of the others; ``width`` components in all."""

    first: np.ndarray
    second: np.ndarray
    cut: int
    width: int


def _codewords(points: np.ndarray, count: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from the first distinct points; a codeword that loses all its points stays where it was."""
    _, places = np.unique(points, axis=0, return_index=True)
    words = points[np.sort(places)[:count]].astype(float)
    for _ in range(rounds):
        nearest = _nearest(points, words)
        for k in range(len(words)):
            own = points[nearest == k]
            if len(own):
                words[k] = own.mean(axis=0)
    return words


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words ** 2).sum(axis=1) - 2.0 * (points @ words.T), axis=1)


def learn_codebooks(rows: DataFrame, codewords: int = CODEWORDS, sample: int = SAMPLE, rounds: int = ROUNDS) -> Codebooks:
    """Two codebooks from the ``sample`` rows whose ids have the least hashes.

    The width is that of the longest vector of all rows; shorter vectors count as filled up with zeros.
    """
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    points = _matrix(drawn.column(0).combine_chunks(), width).astype(float)
    cut = (width + 1) // 2
    if not len(points):
        return Codebooks(np.zeros((1, cut)), np.zeros((1, width - cut)), cut, width)
    return Codebooks(_codewords(points[:, :cut], codewords, rounds), _codewords(points[:, cut:], codewords, rounds), cut, width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of whole numbers, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    if len(values):
        out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Shard:
    """The inverted multi-index of some rows: their cells, and how far each half codeword's members lie from it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, books: Codebooks):
        _, once = np.unique(ids, return_index=True)
        ids, labels, vectors = ids[once], labels[once], vectors[once]
        halves = vectors[:, :books.cut].astype(float), vectors[:, books.cut:].astype(float)
        words = books.first, books.second
        codes = [_nearest(h, w) for h, w in zip(halves, words, strict=True)]
        self.radius = []
        for half, word, code in zip(halves, words, codes, strict=True):
            away = np.sqrt(((half - word[code]) ** 2).sum(axis=1))
            radius = np.full(len(word), -np.inf)  # no member, no bound
            np.maximum.at(radius, code, away)
            self.radius.append(radius)
        cell = codes[0] * len(words[1]) + codes[1]
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.books = ids[order], labels[order], books
        self.exact = vectors[order]
        self.largest = int(np.abs(self.exact).max(initial=0))
        self.float = self.exact.astype(float)
        self.start = np.searchsorted(cell[order], np.arange(len(words[0]) * len(words[1]) + 1))

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products as whole numbers; sums beyond the doubles' 53 bits are taken in Python's integers."""
        if self.largest * int(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) < 1 << 53:
            return (self.float[rows] @ anchor.astype(float)).astype(np.int64)
        return (self.exact[rows].astype(object) @ anchor.astype(object)).astype(np.int64)

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Bound, first and last row of every filled cell, by falling bound: the multi-sequence heap.

        A half's members reach at most the codeword's product plus radius times the half's length. Both halves are sorted
        by that; the heap starts at the pair of the best, and a pair is pushed once both pairs before it are out.
        """
        q = anchor.astype(float)
        sides = []
        for half, words, radius in zip((q[:self.books.cut], q[self.books.cut:]), (self.books.first, self.books.second), self.radius, strict=True):
            bound = np.where(np.isfinite(radius), words @ half + np.where(np.isfinite(radius), radius, 0) * math.sqrt(half @ half), -np.inf)
            order = np.argsort(-bound, kind="stable")[:int(np.isfinite(radius).sum())]
            sides.append((bound[order].tolist(), order.tolist()))
        (one, first), (two, second) = sides
        if not one or not two:
            return
        width, out = len(self.books.second), [0] * len(one)  # out[i]: pairs of i that have left the heap
        heap = [(-(one[0] + two[0]), 0, 0)]
        start = self.start
        while heap:
            bound, i, j = heapq.heappop(heap)
            out[i] = j + 1
            if i + 1 < len(one) and out[i + 1] == j:
                heapq.heappush(heap, (-(one[i + 1] + two[j]), i + 1, j))
            if j + 1 < len(two) and (i == 0 or out[i - 1] > j + 1):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            cell = first[i] * width + second[j]
            if start[cell] < start[cell + 1]:
                yield -bound, int(start[cell]), int(start[cell + 1])

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rows and scores in chunks by falling bound, each with a bound of all rows that are still to come."""
        pending, count, slack = [], 0, 1e-9 * (1.0 + float(self.largest) * float(np.abs(anchor).sum()))
        for bound, a, b in self.cells(anchor):
            if count >= CHUNK:
                rows = np.concatenate(pending)
                yield rows, self.scores(rows, anchor), bound + slack
                pending, count = [], 0
            pending.append(np.arange(a, b))
            count += b - a
        if pending:
            rows = np.concatenate(pending)
            yield rows, self.scores(rows, anchor), -math.inf

    def nearest(self, anchor_id: int, label: int, anchor: np.ndarray, count: int) -> list[tuple[int, int]]:
        """The ``count`` best (score, id) of the label without the anchor itself; certified by the bounds."""
        best: list[tuple[int, int]] = []
        for rows, scores, ahead in self.visit(anchor):
            best = _merge(best, scores, self.ids[rows], (self.labels[rows] == label) & (self.ids[rows] != anchor_id), count)
            if len(best) == count and best[-1][0] > ahead:
                break
        return best

    def inside(self, label: int, anchor: np.ndarray, windows: list[int], count: int, low: int, high: int) -> dict[int, list[tuple[int, int]]]:
        """Per window score p the ``count`` best (score, id) of other labels with low * p <= 100 * score <= high * p.

        A window is certified when its last row beats every bound ahead, or when the bounds have fallen below it.
        """
        best = {p: [] for p in windows}
        edges = {p: (-(-low * p // 100), high * p // 100) for p in windows}
        open_ = {p for p in windows if edges[p][0] <= edges[p][1]}
        if not open_:
            return best
        for rows, scores, ahead in self.visit(anchor):
            other = self.labels[rows] != label
            for p in list(open_):
                least, most = edges[p]
                best[p] = _merge(best[p], scores, self.ids[rows], other & (scores >= least) & (scores <= most), count)
                if least > ahead or (len(best[p]) == count and best[p][-1][0] > ahead):
                    open_.discard(p)
            if not open_:
                break
        return best


def _merge(best: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, mask: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The best ``count`` by falling score, then id, of those known and those of the mask."""
    if len(best) == count:
        mask = mask & (scores >= best[-1][0])
    places = np.flatnonzero(mask)
    if not len(places):
        return best
    chosen = places[np.lexsort((ids[places], -scores[places]))[:count]]
    both = best + list(zip(scores[chosen].tolist(), ids[chosen].tolist(), strict=True))
    return sorted(both, key=lambda x: (-x[0], x[1]))[:count]


def _in_shards(rows: DataFrame, anchors: DataFrame, shards: int) -> DataFrame:
    """Rows dealt evenly by a hash of their id, and every anchor once in each shard, behind its rows.

    A shard holds a bounded number of rows, whatever their labels or cells; the anchors stream past it.
    """
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
                        "id", "label", "v", F.lit(None).cast("array<long>").alias("windows"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                           "id", "label", "v", "windows")
    return dealt.unionByName(asked).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "kind")


def _searched(dealt: DataFrame, books: Codebooks, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Rows of FOUND for every anchor and shard: its nearest of the same label, or, with windows, the best in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, index = None, [], None
        for batch in batches:
            shard, kind = (batch.column(i).to_numpy() for i in (0, 1))
            ids, labels = (batch.column(i).to_numpy() for i in (2, 3))
            vectors, windows = _matrix(batch.column(4), books.width), batch.column(5)
            edges = np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1
            for a, b in zip([0, *edges], [*edges, len(shard)], strict=True):
                if a == b:
                    continue
                if shard[a] != current:
                    current, parts, index = shard[a], [], None
                if kind[a] == 0:
                    parts.append((ids[a:b], labels[a:b], vectors[a:b]))
                    continue
                if index is None:
                    if not parts:
                        continue
                    index, parts = Shard(*(np.concatenate(x) for x in zip(*parts, strict=True)), books), []
                out = []
                for k in range(a, b):
                    if windows[k].is_valid:
                        found = index.inside(int(labels[k]), vectors[k], windows[k].as_py(), negatives, low, high)
                        out += [(int(ids[k]), p, i, s) for p, best in found.items() for s, i in best]
                    else:
                        out += [(int(ids[k]), None, i, s) for s, i in index.nearest(int(ids[k]), int(labels[k]), vectors[k], positives)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ([],) * 4)], FOUND.names)

    return dealt.mapInArrow(run, FOUND)


def mine_hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    codewords: int = CODEWORDS, sample: int = SAMPLE, shards: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` have id, label and v as :func:`usable_vectors` makes them; an anchor is one of the rows. A score is
    the inner product with the anchor; higher ones come first, ties by the smaller id. The first ``positives`` other rows of the
    anchor's label are its positives. For each of them, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned, or all if fewer.

    Both halves of a vector have a codebook, the pairs of codewords are cells. Rows are dealt into shards of bounded size by a hash;
    each shard is an inverted multi-index with its own radii. An anchor visits a shard's cells by falling bound and stops where
    the bound certifies what it has: first for the positives, then, their scores known over all shards, for the windows they open. So results
    are exact for any codebook. Work grows with rows times anchors where bounds are loose; moved are the rows once and the anchors
    once a shard, twice.

    Rows that repeat an id must be equal and count once. Shorter vectors are filled up with zeros. Scores must fit 64 bits. An
    anchor without another row of its label, or without a row in a window, has no result. Empty tables give none.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    count = rows.count()
    shards = shards or max(LEAST_SHARDS, -(-count // ROWS_PER_SHARD))
    books = learn_codebooks(rows, codewords, sample)
    anchors = anchors.dropDuplicates(["id"]).withColumn("windows", F.lit(None).cast("array<long>"))

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = _searched(_in_shards(rows, anchors, shards), books, positives, negatives, low, high)
    path = scratch_path(spark, "positives")
    near.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= positives).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(path)
    chosen = spark.read.schema("anchor_id long, positive_id long, positive_score long").parquet(path)

    asked = anchors.drop("windows").join(
        chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("windows")), "id")
    hard = _searched(_in_shards(rows, asked, shards), books, positives, negatives, low, high)
    by_window = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    ranked = hard.withColumn("rank", F.row_number().over(by_window)).filter(F.col("rank") <= negatives).select(
        "anchor_id", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return chosen.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
