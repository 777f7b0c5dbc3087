"""Fingerprints against the same rule in plain Python."""

import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from touchline.llm.order_minhash import fingerprint_report, likeness, with_signature


def hashed(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 42)


def brute_signature(text, kmer=6, entries=64, size=2):
    if not text:
        return []
    grams = [text[i:i + kmer] for i in range(len(text) - kmer + 1)] if len(text) >= kmer else [text]
    count, numbered = {}, []
    for place, gram in enumerate(grams):
        count[gram] = count.get(gram, 0) + 1
        numbered.append((hashed(gram.encode()) & (1 << 37) - 1, count[gram], place))
    out = []
    shift = 37 - (entries.bit_length() - 1)
    for entry in range(entries):
        least = sorted(x for x in numbered if x[0] >> shift == entry)[:size]
        if least:
            value = 42
            for h, _, _ in sorted(least, key=lambda x: x[2]):
                value = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), value)
            out.append((entry << 32) + (value & 0xFFFFFFFF))
    return out


def alike(a, b):
    either = {x >> 32 for x in a} | {x >> 32 for x in b}
    return len(set(a) & set(b)) / len(either) if either else 1.0


def brute_report(rows):
    def key(row):
        h = hashed(row[1].encode())
        return (row[0] is not None, row[0] or 0, h - (1 << 64) if h >> 63 else h)

    rows = sorted(((i, t or "") for i, t in rows), key=key, reverse=True)
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, near = brute_signature(text), brute_signature(edited), brute_signature(following)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{e:010X}" for e in own),
                    "".join(f"{e:010X}" for e in other), alike(own, other), alike(own, near)))
    return out


@pytest.mark.parametrize("block_rows", [512, 4])
def test_report(docs, rows, block_rows):
    got = sorted(map(tuple, fingerprint_report(docs, block_rows=block_rows).collect()), key=str)
    assert got == sorted(brute_report(rows), key=str)


def test_edges(spark, empty):
    assert fingerprint_report(empty).count() == 0
    one = spark.createDataFrame([(7, "alone at last, and quite long enough")], "doc_id long, text string")
    assert list(map(tuple, fingerprint_report(one).collect())) == brute_report([(7, "alone at last, and quite long enough")])
    two = spark.createDataFrame([(7, None), (8, "")], "doc_id long, text string")
    assert {(r.near_edited, r.near_next) for r in fingerprint_report(two).collect()} == {(1.0, 1.0)}


def test_order_matters(spark):
    """The same k-mers in another order are less alike than in their own, unlike sets of k-mers."""
    words = [f"p{i * 7919 % 1000:03d}q{i:03d} " for i in range(300)]
    texts = ["".join(words), "".join(words[150:] + words[:150]), "".join(reversed(words))]
    df = with_signature(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "s", size=3)
    a, b, c = (r.s for r in df.collect())
    assert alike(a, b) > alike(a, c) and alike(a, c) < 0.5
    pair = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    assert pair.select(likeness(F.col("a"), F.col("b"))).first()[0] == alike(a, b)
