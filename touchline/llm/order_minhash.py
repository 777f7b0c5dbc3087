"""Document fingerprints by Order MinHash, in SQL functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of a k-mer, entries of a fingerprint, k-mers of an entry.
KMER, ENTRIES, TUPLE = 6, 64, 2
#: Bits of a k-mer's hash and of its place in the text, packed into one long.
HASH_BITS, PLACE_BITS = 37, 27
#: Code points whose k-mers are taken at once.
CHUNK = 4096
#: Documents of a block of the id order, and the greatest number of blocks; blocks become larger beyond.
BLOCK_ROWS, MOST_BLOCKS = 512, 100_000


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def packed_kmers(text: Column, kmer: int = KMER) -> Column:
    """Hash and place of every k-mer of a text, as longs; a shorter text is one k-mer, an empty text has none.

    The text is cut into chunks, so that the k-mers of one chunk only are held as text.
    """
    def of_chunk(chunk: Column, at: Column, ahead: Column) -> Column:
        base = at.cast("long") * CHUNK
        whole = F.concat(chunk, F.coalesce(F.left(ahead, F.lit(kmer - 1)), F.lit("")))
        grams = F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{kmer}}}))."), F.lit(1))
        return _let(base, lambda first: F.transform(grams, lambda gram, i: F.shiftleft(F.xxhash64(gram), PLACE_BITS) + first + i))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    many = _let(chunks, lambda cs: F.flatten(F.transform(cs, lambda c, at: of_chunk(c, at, F.get(cs, at + 1)))))
    one = F.array(F.shiftleft(F.xxhash64(text), PLACE_BITS))
    return F.when(F.length(text) >= kmer, many).when(F.length(text) > 0, one).otherwise(
        F.slice(one, 1, 0))  # of a type without nulls, whose arrays sort as plain longs


def with_signature(df: DataFrame, text: str, out: str, kmer: int = KMER, entries: int = ENTRIES, size: int = TUPLE) -> DataFrame:
    """Add the signature of ``text``: at most one long per entry, its number above 32 bits of hash; by rising number.

    Equal k-mers are told apart by their occurrence number. Of the numbered k-mers that an entry's share of the hash values holds,
    the ``size`` least are selected, by hash and then occurrence number; put back into the order of the text, their hashes are hashed as
    a tuple. An edit changes an entry if it touches a selected k-mer or swaps two.
    """
    bits = entries.bit_length() - 1
    if entries != 1 << bits:
        raise ValueError("the number of entries must be a power of two")

    def number(x: Column) -> Column:
        return F.shiftrightunsigned(x, HASH_BITS + PLACE_BITS - bits)

    low = (1 << PLACE_BITS) - 1
    # sorted by entry, hash and place: a later place of the same hash is a later occurrence; longs of a negative sign come first
    df = df.withColumn("omh_sorted__", F.sort_array(packed_kmers(F.col(text), kmer)))
    ordered, count = F.col("omh_sorted__"), F.size("omh_sorted__")

    steps = F.filter(F.array(*[F.lit(1 << p) for p in reversed(range(PLACE_BITS + 1))]), lambda step: step <= count)

    def start(bound: Column, steps: Column) -> Column:
        """How many of the sorted longs lie below a bound, by halving steps."""
        return F.aggregate(steps, F.lit(0), lambda found, step: F.when(
            (found + step <= count) & (F.get(ordered, found + step - 1) < bound), found + step).otherwise(found))

    bounds = F.array(*[F.lit((e - (entries // 2)) << (HASH_BITS + PLACE_BITS - bits)) for e in range(entries)])
    taken = _let(steps, lambda own: F.transform(bounds, lambda bound: F.slice(ordered, start(bound, own) + 1, size)))
    own = F.transform(taken, lambda some, e: F.filter(some, lambda x: number(x) == (e + entries // 2) % entries))
    df = df.withColumn("omh_least__", F.flatten(own)).drop("omh_sorted__")
    least = F.col("omh_least__")

    def entry(j: Column) -> Column:
        own = number(F.get(least, j))
        chosen = F.filter(F.slice(least, j + 1, size), lambda y: number(y) == own)
        by_place = F.sort_array(F.transform(chosen, lambda y: F.shiftleft(y.bitwiseAND(F.lit(low)), HASH_BITS).bitwiseOR(F.shiftrightunsigned(y, PLACE_BITS))))
        hashes = F.transform(by_place, lambda z: z.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
        return F.shiftleft(own, 32) + F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFFFFFF))

    heads = F.filter(F.transform(least, lambda x, j: F.when((j > 0) & (number(F.get(least, j - 1)) == number(x)), -1).otherwise(j)), lambda j: j >= 0)
    return df.withColumn(out, F.sort_array(F.transform(heads, entry))).drop("omh_least__")


def fingerprint(signature: Column) -> Column:
    """A signature as text: two hex digits for the entry's number, eight for its hash."""
    return F.array_join(F.transform(signature, lambda e: F.lpad(F.hex(e), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal entries among those that either signature has, 0 to 1; two empty ones are alike."""
    either = F.size(F.array_union(F.transform(a, lambda e: F.shiftright(e, 32)), F.transform(b, lambda e: F.shiftright(e, 32))))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


KEY = "struct<k0:int,k1:bigint,k2:bigint>"


def _key(id_column: str, text: str) -> Column:
    """Orders documents by id, null first, and rows of one id by a hash of their text."""
    doc = F.col(id_column)
    return F.struct(doc.isNotNull().cast("int").alias("k0"), F.coalesce(doc, F.lit(0)).alias("k1"), F.xxhash64(text).alias("k2"))


def _edges(keyed: DataFrame, blocks: int) -> list[tuple]:
    """Least and greatest key of each block of a range-partitioned order, rising; two keys per block reach the driver."""
    dealt = keyed.select("key").repartitionByRange(blocks, "key").select("key", F.spark_partition_id().alias("part"))
    found = dealt.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most")).collect()
    return sorted((tuple(r.least), tuple(r.most)) for r in found)


def with_next(docs: DataFrame, carry: list[str], id_column: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``next_<c>`` for the carried columns: of the next document by falling id; after the last comes the first.

    The order is cut into blocks of about ``block_rows`` documents by a sorted pass over the keys. Texts are shuffled once, by
    block; the document before which a block ends is sent there too.
    """
    keyed = docs.withColumn("key", _key(id_column, text))
    count = docs.count()
    edges = _edges(keyed, max(1, -(-count // max(block_rows, -(-count // MOST_BLOCKS)))))
    if not edges:
        edges = [((0, 0, 0), (0, 0, 0))]

    def table(keys: list[tuple]) -> Column:
        return F.from_json(F.lit(json.dumps([dict(zip(("k0", "k1", "k2"), k, strict=True)) for k in keys])), f"array<{KEY}>")

    cuts, ends = table([least for least, _ in edges[1:]]), table([most for _, most in edges])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    block = F.aggregate(steps, F.lit(0), lambda found, step: F.when(
        (found + step <= len(edges) - 1) & (F.get(cuts, found + step - 1) <= F.col("key")), found + step).otherwise(found))
    keyed = keyed.withColumn("block", block)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("borrowed"))
    lent = F.struct(((F.col("block") + 1) % len(edges)).alias("block"), F.lit(True).alias("borrowed"))
    sent = F.when(F.get(ends, F.col("block")) == F.col("key"), F.array(own, lent)).otherwise(F.array(own))
    names = [c for c in docs.columns]
    dealt = keyed.select(*names, "key", F.explode(sent).alias("place")).select(*names, "key", "place.block", "place.borrowed")
    order = Window.partitionBy("block").orderBy("borrowed", F.desc("key"))
    return dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry]).filter("not borrowed").drop("key", "block", "borrowed")


def fingerprint_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", kmer: int = KMER, entries: int = ENTRIES,
                       size: int = TUPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document, by
    falling id; after the last document comes the first, and the only document follows itself. near_edited and near_next are the :func:`likeness`
    of a document's signature to that of the edited text and of the next document.

    A null text is empty: no entries, like an empty text 1.0, like any other 0.0. Rows without an id come last; rows of one id are ordered by a hash of
    their text, so equal rows are interchangeable. An empty table gives no rows. Texts may have up to 2^27 code points; an array of a text's k-mers
    is held in memory, some 50 bytes a code point.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    signed = with_signature(rows, "text", "signature", kmer, entries, size)
    linked = with_next(signed, ["text", "signature"], block_rows=block_rows)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    linked = linked.select("doc_id", n.cast("long").alias("n_chars"), "signature", "next_signature", edited.alias("edited"))
    linked = with_signature(linked, "edited", "edited_signature", kmer, entries, size)
    return linked.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("signature")).alias("fingerprint"), fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
