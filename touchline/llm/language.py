"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import bounded_batches

#: N-grams in a profile, of a language or a document.
PROFILE = 400
#: Languages that may be learned: with PROFILE entries each they bound what is broadcast.
LANGUAGES = 2_000
UNKNOWN = "und"
#: Characters that are worked on at once; a worker needs some 150 bytes for each.
RUN = 1 << 17


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Every code point as itself if it is a letter, else 0."""
    return np.fromiter((i if chr(i).isalpha() else 0 for i in range(0x110000)), np.int64, 0x110000)


@dataclass
class Grams:
    """N-grams of one to three letters, a word's edge being a letter of its own, and the text each is in."""

    code: np.ndarray
    text: np.ndarray


def grams(texts: list[str]) -> Grams:
    """All n-grams of lower-cased texts, in no order; whatever is not a letter is an edge."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    text = np.repeat(np.arange(-1, len(texts)), [1, *(len(t) + 1 for t in lowered)])
    keep = letter > 0
    keep[1:] |= letter[:-1] > 0  # one edge behind each word
    keep[0] = True
    z, text = letter[keep], text[keep]
    one = z > 0
    two = one[:-1] | one[1:]
    middle = one[1:-1]
    # the text of a gram is that of its last letter
    owner2 = np.where(one[1:], text[1:], text[:-1])
    return Grams(
        np.concatenate([z[one], ((z[:-1] << 21) | z[1:] | (1 << 62))[two], ((z[:-2] << 42) | (z[1:-1] << 21) | z[2:])[middle]]),
        np.concatenate([text[one], owner2[two], text[1:-1][middle]]),
    )


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    first, size, run = 0, 0, []
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= RUN:
            yield first, run
            first, size, run = i + 1, 0, []
    if run:
        yield first, run


def learn_profiles(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", size: int = PROFILE
) -> list[tuple[str, list[int]]]:
    """The ``size`` most frequent n-grams of each language, most frequent first, over all rows of ``docs``.

    Tasks add up what they read, so a shuffled row is one n-gram of one language in one task. Rows
    without language or text teach nothing. More than LANGUAGES languages raise ValueError: the
    profiles are broadcast, and their bound is what makes that safe.
    """
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("code", T.LongType()), T.StructField("n", T.LongType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, texts in _runs(batch.column(0).to_pylist()):
                own = np.array(langs[first:first + len(texts)], object)
                found = grams(texts)
                for lang in set(own):
                    mine = found.code[(own == lang)[found.text]]
                    codes, counts = np.unique(mine, return_counts=True)
                    if lang in tally:
                        old, had = tally[lang]
                        codes, where = np.unique(np.concatenate([old, codes]), return_inverse=True)
                        counts = np.bincount(where, np.concatenate([had, counts])).astype(np.int64)
                    tally[lang] = codes, counts
        for lang, (codes, counts) in tally.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], schema.names)

    bounded_batches(docs.sparkSession)
    taught = docs.select(F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang")).dropna()
    counted = taught.mapInArrow(run, schema).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = counted.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "rank", "code")
    rows = top.limit(LANGUAGES * size + 1).collect()
    if len({r.lang for r in rows}) > LANGUAGES or len(rows) > LANGUAGES * size:
        raise ValueError(f"more than {LANGUAGES} languages")
    by_lang: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r["rank"])):
        by_lang.setdefault(r.lang, []).append(r.code)
    return sorted(by_lang.items())


class Classifier:
    """Out-of-place distances of documents to language profiles."""

    def __init__(self, profiles: list[tuple[str, list[int]]], size: int) -> None:
        self.names = [name for name, _ in profiles]
        self.size = size
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *(np.array(p, np.int64) for _, p in profiles)]))
        self.places = np.full((len(profiles), len(self.codes) + 1), size, np.int64)  # last column: not in a profile
        for k, (_, codes) in enumerate(profiles):
            self.places[k, np.searchsorted(self.codes, codes)] = np.arange(len(codes))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        found = grams(texts)
        order = np.argsort(found.text, kind="stable")
        code = found.code[order]
        bounds = np.searchsorted(found.text[order], np.arange(len(texts) + 1))
        names, scores = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a == b or not self.names:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            own, counts = np.unique(code[a:b], return_counts=True)
            own = own[np.argsort(-counts, kind="stable")[:self.size]]
            at = np.searchsorted(self.codes, own)
            at[at == len(self.codes)] = 0
            at = np.where(self.codes[at] == own, at, len(self.codes))
            there = self.places[:, at]
            apart = np.where(there < self.size, np.abs(there - np.arange(len(own))), self.size).sum(axis=1)
            best = int(np.argmin(apart))
            names.append(self.names[best])
            scores.append(float(1 - apart[best] / (self.size * len(own))))
        return names, scores


def identify(
    docs: DataFrame, profiles: list[tuple[str, list[int]]], text_column: str = "text", size: int = PROFILE,
    lang_name: str = "lang_pred", score_name: str = "score",
) -> DataFrame:
    """Every row of ``docs`` with the nearest language and a score from 0 to 1.

    A document's ``size`` most frequent n-grams are ranked, equal counts by code; its distance to a
    language sums how far each rank is from the language's, an n-gram without a rank there counting
    ``size``. The score is one minus the distance over its largest value. The whole text counts. Null
    text, text without a letter, and text when nothing was learned is ``und`` with score 0. Of
    languages equally near, the first by name wins. Columns of ``docs`` with the two names are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    fields = [f for f in docs.schema.fields if f.name not in (lang_name, score_name)]
    schema = T.StructType([*fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())])
    shared = spark.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value, size)
        for batch in batches:
            names, scores = [], []
            for _, texts in _runs(batch.column(batch.schema.names.index(text_column)).to_pylist()):
                n, s = classifier.predict(texts)
                names += n
                scores += s
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return docs.select(*(F.col(f"`{f.name}`") for f in fields)).mapInArrow(run, schema)


def bucket(id_column: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus
