"""Equal and nearly equal lines by a segment-partition edit join, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import scratch_path

THRESHOLD = 2
#: Lines with fewer characters are compared for equality only: at such lengths two edits make other words.
SHORTEST = 16
#: Hashes that may be broadcast to pick the lines of candidates, 8 bytes each.
BROADCAST = 1_000_000
#: Lines that share a segment before their pairs are first tested by their parities; up to two stand in the segment's own row.
CROWD = 2
#: Parts of a line that are looked for in the other line of a candidate, before the distance is counted.
PARTS = 8
#: Longs of a line's parities by the number of characters in a gram. Short grams tell words apart, longer ones where the letters are the same.
PARITIES = {1: 1, 2: 2, 3: 4}


def segment(length: str, parts: int, number: int) -> tuple[str, str]:
    """SQL for the start (from 1) and size of a segment; the last ``length % parts`` are one longer."""
    small = f"({length} div {parts})"
    longer = f"({length} % {parts})"
    before = f"greatest(0, {number} - {parts} + {longer})"  # longer ones among the segments before
    return f"({number} * {small} + {before} + 1)", f"({small} + if({number} >= {parts} - {longer}, 1, 0))"


def probe_keys(threshold: int, shortest: int) -> list[tuple[str, bool]]:
    """SQL for the keys of a line, one for each substring at which it meets lines of its length or up to ``threshold`` less.

    With at most ``threshold`` edits one of the threshold-plus-one segments of the shorter line stays whole. Seen
    from the left, the i-th one that is whole has at most i edits before it, seen from the right at
    most ``threshold - i`` behind it (i from 0), and each moves it by one place; both must hold. A key hashes the
    length of the other line, the segment's number and its text; those marked True are the line's own segments.
    """
    keys = []
    for less in range(threshold + 1):
        for number in range(threshold + 1):
            start, size = segment(f"(n - {less})", threshold + 1, number)
            low = max(-number, less - (threshold - number))
            high = min(number, less + (threshold - number))
            for move in range(low, high + 1):
                key = (f"if(n - {less} >= {shortest} and {start} + {move} between 1 and n - {size} + 1, "
                       f"xxhash64(n - {less}, {number}, substring(line, {start} + {move}, {size})), null)")
                keys.append((key, less == 0 and move == 0))
    return keys


def shared_parts(a: str, b: str, threshold: int) -> Column:
    """Whether enough of the ``PARTS`` parts of a text are in the other: an edit breaks one part at most."""
    found = [f"if(contains({b}, substring({a}, {start}, {size})), 1, 0)"
             for start, size in (segment(f"length({a})", PARTS, k) for k in range(PARTS))]
    return F.expr(" + ".join(found)) >= PARTS - threshold


def banded_distance(a: Column, b: Column, threshold: int) -> Column:
    """The edit distance of two texts if it is at most ``threshold``, else something larger.

    A column of the distance matrix is kept as bits, one for each row within ``threshold`` of the diagonal: where the
    value rises (vp) or falls (vn) from the row above. A character of the shorter text takes the band one column
    on with a few operations on these bits; the distance is counted along the diagonal that ends in the last
    cell. Rows above the first count as flat, which makes the first row rise by one with each column.
    """
    width = 2 * threshold + 1
    mask = (1 << width) - 1
    swap = F.length(a) < F.length(b)
    pad = F.array_repeat(F.lit(""), threshold)
    table = F.concat(pad, F.split(F.when(swap, b).otherwise(a), ""), pad)
    short = F.split(F.when(swap, a).otherwise(b), "")
    apart = F.abs(F.length(a) - F.length(b))

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def run(v: Column) -> Column:
        def step(state: Column, column: Column) -> Column:
            letter = column["letter"]
            equal = [F.when(F.get(v["table"], column["at"] + k) == letter, F.lit(1 << k)).otherwise(0) for k in range(width)]
            met = equal[0]
            for e in equal[1:]:
                met = met + e
            vp, vn = state["vp"], state["vn"]

            def moved(d0: Column) -> Column:
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(F.lit(mask))
                down = F.shiftright(d0, 1)
                rises = d0.bitwiseAND(vp).bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(F.lit(mask))
                kept = F.shiftright(d0, threshold).bitwiseAND(F.lit(mask))
                kept = F.when(v["apart"] == 0, kept)
                for d in range(1, threshold + 1):
                    kept = kept.when(v["apart"] == d, F.shiftright(d0, threshold + d))
                return F.struct(rises.alias("vp"), down.bitwiseAND(hp).alias("vn"),
                                (state["dist"] + 1 - kept.bitwiseAND(F.lit(1))).alias("dist"))

            def diagonal(m: Column) -> Column:
                return (m.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(m).bitwiseOR(vn).bitwiseAND(F.lit(mask))

            ahead = let(met, lambda m: let(diagonal(m), moved))
            return F.when(state["dist"] > threshold, state).otherwise(ahead)

        first = F.struct(F.lit(mask ^ ((1 << threshold) - 1)).alias("vp"), F.lit(0).alias("vn"), v["apart"].alias("dist"))
        letters = F.transform(v["short"], lambda c, i: F.struct(c.alias("letter"), i.alias("at")))
        return F.aggregate(letters, first, step, lambda s: s["dist"])

    bound = F.struct(table.alias("table"), short.alias("short"), apart.alias("apart"))
    return F.when(apart > threshold, F.lit(threshold + 1)).when(
        F.least(F.length(a), F.length(b)) == 0, apart).otherwise(let(bound, run))


def lines_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc, pos and line of every line that is not empty."""
    cut = docs.select(F.col(f"`{id_column}`").alias("doc"), F.posexplode(F.split(F.col(f"`{text_column}`"), "\n")).alias("pos", "line"))
    return cut.filter("line <> ''")


def _hashed(lines: DataFrame) -> DataFrame:
    """Lines with two 64-bit hashes that stand for their text."""
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64("line", F.lit(20)))


def _classes(lines: DataFrame) -> DataFrame:
    """Distinct lines with the place where each is first: by document, then position; without their text."""
    return _hashed(lines).groupBy("h1", "h2").agg(F.min(F.struct("doc", "pos")).alias("first"))


def _texts_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct lines with an ``h1`` that is wanted: h1, h2, line, first.

    The hashes are broadcast up to BROADCAST counted ones, so the text of other lines is not moved; beyond,
    lines and hashes are joined by a shuffle.
    """
    wanted = wanted.distinct()
    few = wanted.limit(BROADCAST + 1).count() <= BROADCAST
    chosen = _hashed(lines).join(F.broadcast(wanted) if few else wanted, "h1", "left_semi")
    return chosen.groupBy("h1", "h2").agg(F.max("line").alias("line"), F.min(F.struct("doc", "pos")).alias("first"))


def parities(line: str) -> str:
    """SQL for bits as longs, in the order of PARITIES: whether an odd number of the line's grams falls on each."""
    out = []
    for size, longs in PARITIES.items():
        grams = f"transform(sequence(1, greatest(length({line}) - {size - 1}, 1)), k -> cast(pmod(xxhash64(substring({line}, k, {size})), {64 * longs}) as int))"
        words = [f"aggregate(g, 0L, (sum, h) -> sum ^ if(h div 64 = {w}, shiftleft(1L, h % 64), 0L))" for w in range(longs)]
        out.append(f"element_at(transform(array({grams}), g -> array({', '.join(words)})), 1)")
    return f"concat({', '.join(out)})"


def _near(x: str, y: str, threshold: int) -> Column:
    """Whether parities leave a chance of ``threshold`` edits: an edit takes away and adds a gram for each of its characters at most."""
    near, at = F.lit(True), 0
    for size, longs in PARITIES.items():
        bits = F.lit(0)
        for k in range(at, at + longs):
            bits = bits + F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k]))
        near, at = near & (bits <= 2 * size * threshold), at + longs
    return near


def _crowded(lines: DataFrame, members: DataFrame, probes: DataFrame, threshold: int) -> DataFrame:
    """Pairs i, p of members and probes with the same key whose parities leave a chance of ``threshold`` edits.

    No pair within the threshold is refused. The test is part of the join: lines that share a segment and little else make no rows.
    """
    ids = members.select(F.col("i").alias("h1")).unionByName(probes.select(F.col("p").alias("h1"))).distinct()
    few = ids.limit(BROADCAST + 1).count() <= BROADCAST
    marked = _hashed(lines).join(F.broadcast(ids) if few else ids, "h1", "left_semi").groupBy("h1").agg(F.max("line").alias("line"))
    marked = marked.select("h1", F.expr(parities("line")).alias("bits"))
    path = scratch_path(lines.sparkSession, "parities")
    marked.write.parquet(path)
    marked = lines.sparkSession.read.schema(marked.schema).parquet(path)

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.join(marked.select(F.col("h1").alias(name), F.col("bits").alias(f"bits_{name}")), name)

    left, right = side(members, "i"), side(probes, "p").withColumnRenamed("key", "met")
    return left.join(right, (F.col("key") == F.col("met")) & (F.col("i") != F.col("p")) & _near("bits_i", "bits_p", threshold)).select("i", "p")


def similar_lines(lines: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """Pairs a, b (structs of h1, h2, first) of different lines within ``threshold`` edits, once each.

    A task turns each line into the keys of its probes, of which some are its own segments. Lines that repeat are combined
    with their keys, as hashes and without the lines, and stored once. In the join of keys a segment is one row, however many lines
    share it; up to two of them are in that row. What meets a segment of more than CROWD lines is joined with them by ``_crowded``, where
    the parities of their grams decide first. Candidates are made distinct, written to the shared
    folder, tested by parts of the one line in the other, and verified on the whole lines.

    ``shortest=1`` joins all lines. Those of at most ``threshold`` characters have empty segments, at which they
    meet every line of about their length, as two edits may leave nothing of them.
    """
    if shortest < 1:
        raise ValueError("a line must have a character")
    spark = lines.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    keys = probe_keys(threshold, shortest)
    names = [f"k{j}" for j in range(len(keys))]
    long_ = _hashed(lines).withColumn("n", F.length("line")).filter(F.col("n") >= shortest)
    keyed = stored(long_.groupBy("h1", "h2").agg(*(F.first(F.expr(key)).alias(name) for (key, _), name in zip(keys, names, strict=True)))
                   .drop("h2"), "keys")
    index = keyed.select(F.col("h1").alias("i"), F.explode(F.array(*(name for (_, own), name in zip(keys, names, strict=True) if own))).alias("key"))
    probes = keyed.select(F.col("h1").alias("p"), F.explode(F.array_compact(F.array(*names))).alias("key"))
    # a segment is one row, which has its lines if they are two at most; the struct lets Spark split the join
    counted = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("low"), F.max("i").alias("high"))
    counted = counted.withColumn("place", F.struct("key")).drop("key")
    met = counted.join(probes.withColumn("place", F.struct("key")), "place").filter("n > 1 or low <> p")
    met = stored(met.select("key", "n", "low", "high", "p"), "met")
    few = min(2, CROWD)
    found = met.filter(F.col("n") <= few).select(F.explode(F.array_distinct(F.array("low", "high"))).alias("i"), "p").filter("i <> p")
    if met.filter(F.col("n") > few).take(1):
        wanted = met.filter(F.col("n") > few).select("key").distinct()
        broadcast = wanted.limit(BROADCAST + 1).count() <= BROADCAST
        members = stored(index.join(F.broadcast(wanted) if broadcast else wanted, "key", "left_semi").select("i", "key"), "members")
        if CROWD > few:
            between = met.filter((F.col("n") > few) & (F.col("n") <= CROWD)).select("key", "p")
            found = found.unionByName(between.join(members, "key").filter("i <> p").select("i", "p"))
        crowded = met.filter(F.col("n") > CROWD).select("p", "key").distinct()
        if crowded.take(1):
            of_crowds = members.join(crowded.select("key").distinct(), "key", "left_semi") if CROWD > few else members
            found = found.unionByName(_crowded(lines, of_crowds.select("i", "key"), crowded, threshold))
    path = scratch_path(spark, "candidates")
    found.select(F.least("i", "p").alias("a1"), F.greatest("i", "p").alias("b1")).distinct().write.parquet(path)
    pairs = spark.read.schema("a1 long, b1 long").parquet(path)
    texts = _texts_of(lines, pairs.select(F.explode(F.array("a1", "b1")).alias("h1")))
    path = scratch_path(spark, "lines")
    texts.write.parquet(path)
    texts = spark.read.schema(texts.schema).parquet(path)

    def side(name: str) -> DataFrame:
        return texts.select(F.col("h1").alias(f"{name}1"), F.struct("h1", "h2", "first").alias(name), F.col("line").alias(f"line_{name}"))

    both = pairs.join(side("a"), "a1").join(side("b"), "b1")
    both = both.filter(shared_parts("line_a", "line_b", threshold))
    return both.filter(banded_distance(F.col("line_a"), F.col("line_b"), threshold) <= threshold).select("a", "b")


def judged_lines(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every distinct line: h1, h2, first (doc, pos), n_links and kept.

    n_links counts the other lines within ``threshold`` edits. A line is kept unless one of those
    comes first somewhere earlier, by document id and then position.
    """
    lines = lines_of(docs, id_column, text_column)
    classes, links = _classes(lines), similar_lines(lines, threshold, shortest)
    ends = links.select(F.explode(F.array(
        F.struct(F.col("a.h1").alias("h1"), F.col("a.h2").alias("h2"), F.col("b.first").alias("other")),
        F.struct(F.col("b.h1").alias("h1"), F.col("b.h2").alias("h2"), F.col("a.first").alias("other")))).alias("e")).select("e.*")
    linked = ends.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_links"), F.min("other").alias("earliest"))
    out = classes.join(linked, ["h1", "h2"], "left")
    kept = F.col("earliest").isNull() | (F.col("first") < F.col("earliest"))
    return out.select("h1", "h2", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), kept.alias("kept"))


def line_report(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """Per document: doc_id, n_lines, n_links, n_dropped.

    n_lines counts the lines that are not empty; n_links the links of lines that come first here; n_dropped
    the lines that go because an equal or similar one comes earlier. Null and empty texts have no lines. Rows
    that repeat an id are one document. An empty table gives no rows.
    """
    judged = judged_lines(docs, threshold, shortest)
    here = judged.groupBy(F.col("first.doc").alias("doc")).agg(
        F.sum("n_links").alias("n_links"), F.count_if("kept").alias("n_kept"))
    count = F.size(F.filter(F.split("text", "\n"), lambda line: line != ""))
    own = docs.select(F.col("doc_id"), F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)).alias("n"))
    own = own.groupBy("doc_id").agg(F.sum("n").alias("n_lines"))
    both = own.join(here, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    return both.select("doc_id", "n_lines", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                       (F.col("n_lines") - F.coalesce("n_kept", F.lit(0))).alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """doc_id and text of every document, with only its kept lines at their first place; a text may become empty."""
    kept = judged_lines(docs, threshold, shortest).filter("kept").select(F.struct("first.doc", "first.pos").alias("place"))
    lines = lines_of(docs).withColumn("place", F.struct("doc", "pos")).dropDuplicates(["place"])
    again = lines.join(kept, lines["place"].eqNullSafe(kept["place"]), "left_semi").groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("rows"))
    ids = docs.select("doc_id").distinct()
    joined = ids.join(again, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    return joined.select("doc_id", F.array_join(F.transform(F.coalesce("rows", F.array()), lambda r: r["line"]), "\n").alias("text"))
