"""Near duplicates by bottom-k sketches from one hash function."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.components import components
from touchline.llm.text import SPACED, Words, bounded_batches, scan, slices, utf8, windows
from touchline.session import scratch_path

#: Values in a sketch.
SKETCH = 32
#: Values of the union's sketch that both must have before a pair is verified. Of a pair that is as
#: similar as 0.8, the union's 32 least values have fewer than 10 in common with probability 2e-10.
SHARED = 10
#: Bits of the parity sketches that are kept, a multiple of 64; beyond about as many shingles that differ it tells little more.
PARITIES = 512
#: Documents that are compared with one pivot of an inverted list.
BLOCK = 64
#: Ids that may be broadcast to pick rows, 8 bytes each; beyond that many they are joined by shuffle.
BROADCAST = 1_000_000

_LONGS = T.ArrayType(T.LongType())
SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("sketch", _LONGS), T.StructField("parity", _LONGS),
])


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct shingles; with fewer words than ``size`` all of them are one."""
    whole = windows(words.hash, size)
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= size:
            yield np.unique(whole[first:last - size + 1])
        else:
            yield windows(words.hash[first:last], last - first) if last > first else np.empty(0, np.uint64)


def _positive(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(1)).astype(np.int64)


def parity_sketch(hashes: np.ndarray, size: int = 1024) -> np.ndarray:
    """``size`` bits as longs: whether an odd number of the hashes falls on each.

    Two sets' sketches differ in no more bits than the sets in elements, as a common element flips the same bit of both.
    """
    bits = np.bincount((hashes % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sign(docs: DataFrame, size: int, sketch: int) -> DataFrame:
    """Rows of SIGNED for doc_id, text: a digest of the word sequence, the set's size, its ``sketch`` least hashes, its parities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = utf8(batch.column(1))
            for a, b in slices(bounds):
                words = scan(raw, bounds[a:b + 1], SPACED)
                digests, sizes, sketches, parities = [], [], [], []
                gap = words.low.copy()
                gap[~SPACED[gap]] = 0x20
                # the words and single spaces: what lies between two words beyond their first gap byte goes
                keep = SPACED[gap]
                follows = np.zeros(len(gap), bool)
                follows[words.end[words.end < len(gap)]] = True
                keep |= follows & ~keep
                cut = np.append(0, np.cumsum(keep))
                text = gap[keep]
                edges = cut[bounds[a:b + 1] - bounds[a]]
                for i, own in enumerate(shingle_sets(words, size)):
                    digests.append(hashlib.blake2b(text[edges[i]:edges[i + 1]].tobytes().strip(b" "), digest_size=16).digest())
                    sizes.append(len(own))
                    sketches.append(_positive(own[:sketch]))
                    parities.append(parity_sketch(own, PARITIES))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.array(sketches, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64())),
                ], SIGNED.names)

    return docs.mapInArrow(run, SIGNED)


def enough(x: Column, y: Column, nx: Column, ny: Column, sketch: int, shared: int, percent: int) -> Column:
    """Whether the sketch of the union leaves a chance of the similarity asked for; exact if it is the whole union."""
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, sketch)
    common = F.size(F.array_intersect(F.array_intersect(x, y), union))
    sizes = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    return sizes & F.when(F.size(union) < sketch, common * 100 >= F.size(union) * percent).otherwise(common >= shared)


def only(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is in ``ids``: by a broadcast up to BROADCAST counted ids, else by a shuffle."""
    ids = ids.withColumnRenamed(ids.columns[0], column).distinct()
    few = ids.limit(BROADCAST + 1).count() <= BROADCAST
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")


def _links(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs a, b whose whole shingle sets are as similar as ``percent``; only their texts are moved."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = only(rows.select(F.col("doc_id").alias("id"), "text"), ends, "id").dropDuplicates(["id"])
    first = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = utf8(batch.column(2)), utf8(batch.column(3))
            total = np.diff(x[1]) + np.diff(y[1])
            keep = np.zeros(batch.num_rows, bool)
            for a, b in slices(np.append(0, np.cumsum(total))):
                sets = [shingle_sets(scan(raw, bounds[a:b + 1], SPACED), size) for raw, bounds in (x, y)]
                for i, (one, two) in enumerate(zip(*sets, strict=True)):
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    keep[a + i] = common * 100 >= (len(one) + len(two) - common) * percent
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema.names).filter(pa.array(keep))

    return both.mapInArrow(run, schema)


def _fits(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as ``percent``."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _stars(lists: DataFrame, longest: int, percent: int) -> DataFrame:
    """Pairs a < b of each member of an inverted list with a pivot, and whether their sizes fit.

    A list (value, members, id, n) is dealt into blocks of about BLOCK members, the least of each is its
    pivot, and the pivots of a list form a shorter list. So no group is large, and the pairs are
    about as many as the members.
    """
    out = None
    while True:
        blocks = F.ceil(F.col("members") / BLOCK)
        dealt = lists.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("value", "id"), F.col("blocks")))
        pivots = dealt.groupBy("value", "block", "blocks").agg(F.min(F.struct("id", "n")).alias("p"))
        pairs = dealt.select("value", "block", F.col("id").alias("b"), "n").join(pivots, ["value", "block"]).filter("p.id <> b").select(
            F.col("p.id").alias("a"), "b", _fits("p.n", "n", percent).alias("fits"))
        out = pairs if out is None else out.unionByName(pairs)
        if longest <= BLOCK:
            return out.distinct()
        longest = -(-longest // BLOCK)
        lists = pivots.filter("blocks > 1").select("value", F.col("blocks").alias("members"), F.col("p.id").alias("id"), F.col("p.n").alias("n"))


def _labelled(rows: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """``rows`` with the component of ``column`` as ``out``; an id without links is its own."""
    named = labels.select(F.col("node").alias(column), F.col("component").alias(out))
    return rows.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def _mixed(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the inverted lists that hold several components so far: value, members, id, n, component, main.

    main is the most frequent component of the list. A list of two has its only pair among the stars.
    """
    labelled = _labelled(lists.filter("members > 2").select("value", "members", "id", "n"), labels, "id", "component")
    count = labelled.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    main = count.groupBy("value").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = main.filter("parts > 1").select(F.bitwise_not("value").alias("key"), F.col("main.component").alias("main"))
    return labelled.withColumn("key", F.bitwise_not("value")).join(main, "key").select("value", "members", "id", "n", "component", "main")


def _differ_little(x: str, y: str, sizes: Column, percent: int) -> Column:
    """Whether parity sketches leave a chance of the similarity asked for, of sets with these summed sizes.

    Sets that are as similar as ``percent`` differ in (100 - percent) / (100 + percent) of their summed sizes at most,
    and the sketches in no more bits. So no such pair is refused.
    """
    bits = F.lit(0)
    for k in range(PARITIES // 64):
        bits = bits + F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k]))
    return bits * (100 + percent) <= sizes * (100 - percent)


def _meetings(mixed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b, which may repeat, of members of a mixed list in different components that can still be similar.

    The members outside the main component are compared with all members outside their own, by sizes and parity sketches in the
    join itself: an edited copy that reaches nobody makes no row with each of all other copies. Two that meet in several
    lists of more than BLOCK members make a row in one of them only. Shorter lists are joined with themselves under two sets of names
    and one order of columns, so that Spark deals them out once for both sides.
    """
    several = mixed.filter(F.col("members") > BLOCK).groupBy("id").agg(F.collect_list(F.bitwise_not("value")).alias("long"))
    sketches = classes.select("id", "parity")

    def side(rows: DataFrame, sketches: DataFrame, name: str, *more: str) -> DataFrame:
        columns = [F.bitwise_not("value").alias(f"key_{name}"), (F.col("component") != F.col("main")).alias(f"outside_{name}")]
        return rows.join(sketches, "id").select(
            *columns, *(F.col(c).alias(f"{c}_{name}") for c in ("id", "n", "parity", "component", *more)))

    other = (F.col("key_x") == F.col("key_y")) & (F.col("component_x") != F.col("component_y"))
    reach = _fits("n_x", "n_y", percent) & _differ_little("parity_x", "parity_y", F.col("n_x") + F.col("n_y"), percent)
    few = mixed.filter(F.col("members") <= BLOCK)
    met = side(few, sketches, "x").join(side(few, sketches, "y"), other & (F.col("id_x") < F.col("id_y")) & (F.col("outside_x") | F.col("outside_y")) & reach)
    many, known = mixed.filter(F.col("members") > BLOCK), sketches.join(several, "id", "left")
    once = ~F.col("outside_y") | (F.col("id_x") < F.col("id_y"))
    here = F.array_min(F.array_intersect("long_x", "long_y")) == F.col("key_x")
    met_long = side(many, known, "x", "long").filter("outside_x").join(side(many, known, "y", "long"), other & once & reach & here)
    return met.unionByName(met_long, allowMissingColumns=True).select(
        F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, sketch: int = SKETCH, shared: int = SHARED,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept.

    Words stand between white space, A-Z lower-cased; a document's set holds its distinct shingles of ``words``
    words, or all its words as one if they are fewer. Documents are linked whose sets have
    100 * intersection >= percent * union, and component_id is the least id reachable over links.

    Equal word sequences are one class from the start. A class keeps the least hashes of its set. Each hash is an
    inverted list; the lists are ranked from rare to frequent, and a class enters only so many of its rarest that two classes with
    ``shared`` hashes in common meet in one. First each class meets the least pivot of its lists, then, where that left
    them in different components, all its pivots: pairs in proportion to the members. At last the members of a list
    that are still in different components meet each other, unless the parities of their shingles differ in too many bits for a link; this
    loses no link that could join two components, and pairs inside one need no test. Candidates pass the estimate from the union's sketch and are confirmed on the
    whole sets of both texts. Lists, pairs, links and labels are tables in the shared folder.

    The one loss: two sets of more than ``sketch`` shingles, as similar as asked for, have fewer than ``shared`` of
    the union's least hashes in common, with the probability stated at SHARED. Shingles are compared by 64-bit hashes.
    Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat an id must repeat its text and are one
    document in several rows. A row without id has no component and is kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    signed = stored(sign(rows, words, sketch), "signed")
    able = signed.filter("n > 0 and doc_id is not null")
    classes = stored(able.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity")), "classes")

    postings = classes.select("id", "n", F.explode("sketch").alias("value"))
    often = postings.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select(
        F.bitwise_not("value").alias("key"), "members")
    # hashes that only one class has come first in its ranking; their number is enough
    shared_ones = postings.select("id", "n", F.bitwise_not("value").alias("key")).join(often, "key").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("members", "key"))).alias("values"))
    size = F.least("n", F.lit(sketch))
    exact = F.ceil(F.col("n") * percent / 100)  # with whole sets on either side
    need = F.when(F.col("n") * 100 <= sketch * percent, exact).otherwise(F.least(F.lit(shared), size))
    room = (size - need + 1) - (size - F.size("values"))
    prefix = F.slice("values", 1, F.greatest(room, F.lit(0)).cast("int"))
    lists = stored(shared_ones.select("id", "n", F.explode(prefix).alias("p")).select(
        "id", "n", F.bitwise_not("p.key").alias("value"), F.col("p.members").alias("members")), "lists")

    longest = lists.agg(F.max("members")).first()[0] or 0
    tested = stored(_stars(lists, longest, percent), "tested")
    fitting = tested.filter("fits").select("a", "b")
    # for the estimate the upper halves of the hashes do: they order alike, and a false match only lets a pair pass
    brief = classes.select("id", "n", F.transform("sketch", lambda v: F.shiftright(v, 32).cast("int")).alias("s"), "parity")

    def linked(pairs: DataFrame) -> DataFrame:
        for name in ("a", "b"):
            pairs = pairs.join(brief.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("s").alias(f"s_{name}"), F.col("parity").alias(f"parity_{name}")), name)
        little = _differ_little("parity_a", "parity_b", F.col("n_a") + F.col("n_b"), percent)
        passed = pairs.filter(little & enough(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b"), sketch, shared, percent))
        return stored(_links(stored(passed.select("a", "b"), "pairs"), rows, words, percent), "links")

    least = fitting.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = linked(least)
    labels = components(links, "a", "b")
    apart = _labelled(_labelled(fitting.join(least, ["a", "b"], "left_anti"), labels, "a", "c"), labels, "b", "d").filter("c <> d")
    more = linked(apart.select("a", "b"))
    if more.take(1):
        links = links.unionByName(more)
        labels = components(links, "a", "b")
    mixed = stored(_mixed(lists, labels), "mixed")
    last = linked(_meetings(mixed, classes, percent).distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti"))
    if last.take(1):
        labels = components(links.unionByName(last), "a", "b")
    named = classes.select("digest", "id").join(labels, F.col("id") == F.col("node"), "left").select(
        F.struct("digest").alias("key"), F.coalesce("component", "id").alias("component"))
    out = signed.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.struct("digest")).alias("key"))
    component = F.coalesce("component", "doc_id")
    return out.join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
