"""Repair of damaged conversations: the cheapest edits to a legal order of roles, by Hirschberg's divide and conquer."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import bounded_batches
from touchline.operators.ordered import BLOCK, measure_layout
from touchline.session import scratch_path

#: Rows that one task plans at once; a longer conversation is cut along its order.
ROWS_PER_BLOCK = 50_000

# States between rows: nothing yet, after the system's turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: The state that an inserted turn, or one with a new role, leads to; it is the user's turn unless a user has just spoken.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert at the end of a conversation, by its last state.
TAIL = (0, 2, 1, 0)
#: What may be done at a row, in ASCII order of the audits: inserted turns, then the row's own edit.
EDITS = ("D", "IIK", "IIR", "IK", "IR", "K", "R")

BLANK_TEXT, WITH_END = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

#: Options of one row or block by the state before it: state after it, cost, order of its audit among those from the same state.
Options = tuple[tuple[tuple[int, int, int], ...], ...]
Vector = list[tuple[int, int] | None]


def row_options(initial: str, truncated: bool, doomed: bool) -> Options:
    """What may be done at one row. Turns are inserted before a row that stays, never before one that goes:
    behind it they cost the same and come earlier in ASCII order. A third inserted turn leads where one does."""
    table = []
    for state in range(4):
        found = [(state, DELETE, 0)]
        at = state
        for inserted in range(0 if doomed else 3):
            extra = inserted * INSERT + TRUNCATED * truncated
            kept = {"s": SYSTEM if at == START else None, "u": USER if NEXT[at] == USER else None,
                    "a": ASSISTANT if at == USER else None}.get(initial)
            if kept is not None:
                found.append((kept, extra, EDITS.index("I" * inserted + "K")))
            found.append((NEXT[at], extra + REROLE, EDITS.index("I" * inserted + "R")))
            at = NEXT[at]
        table.append(tuple(found))
    return tuple(table)


def forward(items: list[Options], first: int, last: int, start: int) -> Vector:
    """Per state after the items: least cost from ``start``, and the place of its least audit among the four.

    No audit of one row's end is the beginning of another, as each ends with the edit of that row. So two audits compare as
    their beginnings do, and those of the same beginning by the options' order.
    """
    vector: Vector = [None] * 4
    vector[start] = (0, 0)
    for item in items[first:last]:
        best: list[tuple[int, int, int] | None] = [None] * 4
        for state, known in enumerate(vector):
            if known is None:
                continue
            for to, cost, order in item[state]:
                here = (known[0] + cost, known[1], order)
                if best[to] is None or here < best[to]:
                    best[to] = here
        ranks = {x: i for i, x in enumerate(sorted(b[1:] for b in best if b is not None))}
        vector = [None if b is None else (b[0], ranks[b[1:]]) for b in best]
    return vector


def backward(items: list[Options], first: int, last: int, target: int | None) -> list[int | None]:
    """Per state before the items: least cost to ``target``, or to the end of a legal conversation."""
    costs: list[int | None] = [TAIL[s] * INSERT if target is None else (0 if s == target else None) for s in range(4)]
    for item in reversed(items[first:last]):
        costs = [min((cost + costs[to] for to, cost, _ in options if costs[to] is not None), default=None) for options in item]
    return costs


def cheapest(items: list[Options], start: int, target: int | None) -> list[tuple[int, int]]:
    """State after and order number of each item's edit, least cost first, then the ASCII-least audit.

    Hirschberg: cost vectors from both ends meet in the middle; of the optimal crossings the one whose audit so far is least
    is taken, and both halves are solved between known states. Only two vectors of four are held at a time.
    """
    out: list[tuple[int, int]] = []

    def solve(first: int, last: int, start: int, target: int | None) -> None:
        if last - first == 1:
            end = backward(items, last, last, target)
            _, order, to = min((cost + end[to], order, to) for to, cost, order in items[first][start] if end[to] is not None)
            out.append((to, order))
            return
        middle = (first + last) // 2
        left, right = forward(items, first, middle, start), backward(items, middle, last, target)
        _, _, crossing = min((x[0] + right[s], x[1], s) for s, x in enumerate(left) if x is not None and right[s] is not None)
        solve(first, middle, start, crossing)
        solve(middle, last, crossing, target)

    if items:
        solve(0, len(items), start, target)
    return out


def block_options(items: list[Options]) -> Options:
    """A whole block as one item: from each state to each other, least cost and order of the audits."""
    return tuple(
        tuple((to, x[0], x[1]) for to, x in enumerate(forward(items, 0, len(items), state)) if x is not None) for state in range(4)
    )


ORDER = ["has", "turn", "role", "digest"]


def ordered_rows(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                 text_column: str = "text") -> DataFrame:
    """conv, has, turn, role, text, digest: a conversation's order is by turn, nulls first, then role and the text's digest.

    A null role or text is one space.
    """
    def col(name: str) -> Column:
        return F.col(f"`{name}`")

    turn, text = col(turn_column).cast("long"), F.coalesce(col(text_column), F.lit(" "))
    return rows.select(
        col(conv_column).alias("conv"), turn.isNotNull().cast("int").alias("has"), F.coalesce(turn, F.lit(0)).alias("turn"),
        F.coalesce(col(role_column), F.lit(" ")).alias("role"), text.alias("text"), F.md5(text.cast("binary")).alias("digest"),
    )


def runs(ordered: DataFrame) -> DataFrame:
    """Equal rows of one turn as one: conv, ORDER, copies, blank, truncated, and repeated (its role and text came in an earlier turn).

    Texts stand as their digests. Copies are counted before the shuffle, and a text that returns in very many turns
    meets its first turn in a join that Spark may divide.
    """
    blank, ended = ~F.col("text").rlike(BLANK_TEXT), F.col("text").rlike(WITH_END)
    coded = ordered.select("conv", *ORDER, blank.alias("blank"), (~blank & ~ended).alias("truncated"))
    counted = coded.groupBy("conv", *ORDER, "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    key = F.struct("conv", "role", "digest").alias("key")
    first = counted.groupBy(key).agg(F.min(F.struct("has", "turn")).alias("first"))
    return counted.withColumn("key", key).join(first, "key").select(
        "conv", *ORDER, "copies", "blank", "truncated", (~F.col("blank") & (F.struct("has", "turn") != F.col("first"))).alias("repeated"))


def _type(conv: str, df: DataFrame) -> DataFrame:
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    doomed = F.col("blank") | F.col("repeated")
    return df.withColumn("type", (kind * 4 + F.col("truncated").cast("int") * 2 + doomed.cast("int")).cast("int"))


TYPES = [row_options(i, t, d) for i in ("s", "u", "a", "") for t in (False, True) for d in (False, True)]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first ``keys`` columns, whole groups at a time; for narrow rows of a bounded group."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield current, rows


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 4096, cost: Callable[[tuple], int] = lambda r: 1) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, total = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        total += cost(row)
        if total >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), arrow.types, strict=True)], schema=arrow)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), arrow.types, strict=True)], schema=arrow)


def _crossings(placed: DataFrame) -> DataFrame:
    """conv, block, entry, exit of every block of the conversations that were cut; the last block has no exit."""
    conv = placed.schema["conv"].dataType
    matrix = T.StructType([T.StructField("conv", conv), T.StructField("block", T.IntegerType()), T.StructField("m", T.ArrayType(T.LongType()))])
    found = T.StructType([T.StructField("conv", conv), *[T.StructField(n, T.IntegerType()) for n in ("block", "entry", "exit")]])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (name, block), own in _grouped(batches, 2):
                table = block_options([TYPES[r[-1]] for r in own])
                # deletions of further copies change costs only
                yield name, block, [n for s, options in enumerate(table) for o in options for n in (s, *o)]
        yield from _batches(rows(), matrix)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (name,), own in _grouped(batches, 1):
                items = []
                for _, m in own:
                    table: list[list] = [[] for _ in range(4)]
                    for i in range(0, len(m), 4):
                        table[m[i]].append(tuple(m[i + 1:i + 4]))
                    items.append(tuple(tuple(x) for x in table))
                state = START
                for k, ((block, _), (to, _)) in enumerate(zip(own, cheapest(items, START, None), strict=True)):
                    yield name, block, state, None if k == len(own) - 1 else to
                    state = to
        yield from _batches(rows(), found)

    cut = placed.filter(F.col("block").isNotNull())
    by_block = cut.repartition("conv", "block").sortWithinPartitions("conv", "block", *ORDER).select("conv", "block", "type")
    return by_block.mapInArrow(matrices, matrix).repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(composed, found)


def planned_edits(coded: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``coded`` (from :func:`runs`) with what is done at each: edit (one of EDITS), state before it, tail (turns inserted after it).

    A conversation within ``rows_per_block`` is planned in one piece. A longer one is cut along its order; each block becomes a
    four by four table of costs, the tables of a conversation are crossed as rows are, and then each block is
    planned between its two known states. Copies beyond the first are always deleted and change no choice.
    """
    coded = _type("conv", coded)
    layout = measure_layout(coded, ["conv"], ORDER, rows_per_block)
    if layout.bounds is None:
        placed = coded.select("*", F.lit(None).cast("int").alias("block"), F.lit(START).alias("entry"), F.lit(None).cast("int").alias("exit"))
    else:
        own = layout.place(coded).withColumnRenamed(BLOCK, "block")
        path = scratch_path(coded.sparkSession, "placed")
        own.write.parquet(path)
        own = coded.sparkSession.read.schema(own.schema).parquet(path)
        states = _crossings(own).select(F.struct("conv", "block").alias("key"), "entry", "exit")
        placed = own.withColumn("key", F.struct("conv", "block")).join(states, "key", "left").drop("key").withColumn(
            "entry", F.coalesce("entry", F.lit(START)))
    conv = coded.schema["conv"].dataType
    names = ["conv", "block", "entry", "exit", *ORDER, "copies", "blank", "truncated", "repeated", "type"]
    schema = T.StructType([
        T.StructField("conv", conv), *[placed.schema[n] for n in [*ORDER, "copies", "blank", "truncated", "repeated"]],
        T.StructField("edit", T.StringType()), T.StructField("state", T.IntegerType()), T.StructField("tail", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (name, _, entry, leave), own in _grouped(batches, 4):
                state = entry
                path = cheapest([TYPES[r[-1]] for r in own], entry, leave)
                for k, (r, (to, order)) in enumerate(zip(own, path, strict=True)):
                    last = leave is None and k == len(own) - 1
                    yield name, *r[:-1], EDITS[order], state, TAIL[to] if last else 0
                    state = to
        yield from _batches(rows(), schema)

    return placed.repartition("conv", "block").sortWithinPartitions("conv", "block", *ORDER).select(*names).mapInArrow(run, schema)


SEEN, EDIT, TEXT = -1, 0, 1


def _merged(rows: DataFrame, names: dict[str, str], rows_per_block: int) -> tuple[DataFrame, T.DataType]:
    """Texts behind their edits, conversation by conversation in order; texts are shuffled once.

    Every conversation of ``rows`` leads with a row of its own, so that none is lost.
    """
    ordered = ordered_rows(rows, **names)
    present = ordered.filter(F.col("has") >= 0)
    edits = planned_edits(runs(present), rows_per_block)
    columns = ["conv", *ORDER, "mark", "text", "copies", "blank", "truncated", "repeated", "edit", "state", "tail"]

    def shaped(df: DataFrame, mark: int) -> DataFrame:
        types = {f.name: f.dataType for f in edits.schema} | {"text": T.StringType()}
        return df.withColumn("mark", F.lit(mark)).select(
            *[F.col(c) if c in df.columns or c == "mark" else F.lit(None).cast(types[c]).alias(c) for c in columns])

    both = shaped(edits, EDIT).unionByName(shaped(present, TEXT))
    return both, columns


TURNS = [("position", T.LongType()), ("edit", T.StringType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType())]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a sorted partition, one at a time, and a last one that is None."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)
    yield None


class _Report:
    """What is told of one conversation; texts pass through the hash and are not kept."""

    def __init__(self, conv):
        self.conv, self.count = conv, dict.fromkeys(COUNTS, 0)
        self.audit, self.hash, self.any = [], hashlib.sha256(), False
        self.turns, self.least, self.most, self.last, self.before = 0, None, None, None, None

    def edit(self, has, turn, role, copies, blank, truncated, repeated, edit, tail):
        doomed, count = blank or repeated, self.count
        count["blank"] += copies if blank else 0
        count["duplicate"] += 0 if blank else copies if repeated else copies - 1
        count["truncated"] += 1 if truncated and not doomed else 0
        initial = role[:1]
        if self.before is not None and (self.before, initial) not in LEGAL:
            count["illegal"] += 1
        count["illegal"] += copies - 1
        self.before = initial
        if has and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.least, self.most = turn if self.least is None else self.least, turn
        count["cost"] += (copies - 1) * DELETE + (edit.count("I") + tail) * INSERT + edit.count("D") * DELETE + edit.count("R") * REROLE
        count["cost"] += TRUNCATED if truncated and edit[-1] != "D" else 0
        self.audit.append(edit + "D" * (copies - 1) + "I" * tail)

    def said(self, role: str, text: str):
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def row(self) -> tuple:
        if self.turns:
            self.count["gaps"] = self.most - self.least + 1 - self.turns
        return self.conv, *(self.count[n] for n in COUNTS), "".join(self.audit), self.hash.hexdigest()


def _spoken(edit: str, state: int, role: str) -> Iterator[tuple[str, str, bool]]:
    """Edit, role and whether it has the row's text, of the turns that stand for one row."""
    for letter in edit:
        if letter == "D":
            return
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]] if letter == "K" else NEXT[state]
        yield letter, role if letter == "K" else NAMES[state], letter != "I"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple | None]]:
    """Every edit row with its text (None if the row goes), in order; a row's further copies are passed by."""
    waiting = None
    for row in _walk(batches):
        if row is not None and row[5] == TEXT:
            if waiting is not None and waiting[:5] == row[:5]:
                yield waiting, row[6]
                waiting = None
            continue
        if row is None:
            return
        if row[5] == EDIT and row[11][-1] != "D":
            waiting = row
        else:
            yield row, None


def _after(state: int, edit: str, role: str) -> int:
    for letter in edit:
        if letter != "D":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]] if letter == "K" else NEXT[state]
    return state


def _turns_of(row: tuple, text: str | None) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of what stands in the repaired conversation for a row, with the turns at the end."""
    role, edit, state, tail = row[3], row[11], row[12], row[13]
    for letter, name, own in _spoken(edit, state, role):
        yield letter, name, text if own else ""
    state = _after(state, edit, role)
    for _ in repeat(None, tail):
        state = NEXT[state]
        yield "I", NAMES[state], ""


def _sorted(both: DataFrame, columns: list[str]) -> DataFrame:
    return both.select(*columns).repartition("conv").sortWithinPartitions("conv", *ORDER, "mark")


def repaired_turns(rows: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, **names: str) -> DataFrame:
    """The repaired conversations: conv, position (from 0), edit (K, R or I), turn (null if inserted or unknown), role, text."""
    bounded_batches(rows.sparkSession)
    both, columns = _merged(rows, names, rows_per_block)
    schema = T.StructType([T.StructField("conv", both.schema["conv"].dataType), *[T.StructField(n, t) for n, t in TURNS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            current, position = object(), 0
            for row, text in _stream(batches):
                if row[0] != current:
                    current, position = row[0], 0
                for letter, role, said in _turns_of(row, text):
                    yield row[0], position, letter, row[2] if row[1] and letter != "I" else None, role, said
                    position += 1
        yield from _batches(out(), schema, 4 << 20, lambda r: 64 + len(r[5]))

    return _sorted(both, columns).mapInArrow(run, schema)


def repair_report(rows: DataFrame, conversations: DataFrame | None = None, rows_per_block: int = ROWS_PER_BLOCK, **names: str) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation is read by turn (nulls first); rows of one turn by role, then by the text's digest. Each row counts for its first
    fault: blank (white space only), duplicate (role and text came earlier), truncated (the last character that is no white space is none of ``.!?``).
    gaps are the turns missing between the least and greatest, illegal the neighbours whose roles begin neither su, ua nor au. Edits
    are Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate rows), Insert an empty turn 5; a truncated row that stays
    adds 5. The cheapest edits to roles ``(s?(ua)+)?`` are chosen, of these the ASCII-least audit.

    Texts are compared by 128-bit digests and shuffled once; planning moves digests only, in blocks of ``rows_per_block``. The digest of a
    repaired conversation needs its texts in order: they stream through one task, which keeps none of them.

    A null role or text is one space, rows without a conversation are one of their own, null turns make no gap. Rows that repeat are
    duplicates. ``conversations`` (column conv) adds those that have no rows: zeros, an empty audit and the hash of nothing. Empty
    tables give no rows.
    """
    bounded_batches(rows.sparkSession)
    both, columns = _merged(rows, names, rows_per_block)
    kind = both.schema["conv"].dataType
    if conversations is not None:
        seen = conversations.select(F.col("conv").cast(kind)).distinct()
        both = both.unionByName(seen.select("conv", F.lit(-1).alias("has"), F.lit(SEEN).alias("mark")), allowMissingColumns=True)
    schema = T.StructType([
        T.StructField("conv_id", kind), *[T.StructField(n, T.LongType()) for n in COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            report = None
            for row, text in _stream(batches):
                if report is None or row[0] != report.conv:
                    if report is not None:
                        yield report.row()
                    report = _Report(row[0])
                if row[5] == SEEN:
                    continue
                report.edit(row[1], row[2], row[3], *row[7:12], row[13])
                for _, role, said in _turns_of(row, text):
                    report.said(role, said)
            if report is not None:
                yield report.row()
        yield from _batches(out(), schema)

    return _sorted(both, columns).mapInArrow(run, schema)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one row in twenty each dropped, emptied, cut off, repeated, or given to the user.

    The crc32 of ``conv_id:turn`` decides; nulls are one space.
    """
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(F.col("lot") == 4, "user").otherwise(said("role"))
    return rows.withColumn("lot", lot).filter("lot <> 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("lot") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
