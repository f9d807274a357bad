"""Faults of conversations and their cheapest repair.

A repair edits a conversation's rows until the initials of their roles read
``(s?(ua)+)?``: it keeps, reroles or deletes each row and inserts empty ones.
A path is a number: its high digits are its cost, its low digits the letters
of its edits, one digit each in a field of fixed width, first letter highest,
zeros after the last. An edit in front of a path moves the path's letters one
place down and adds the edit's own weight, so the cheapest path with the
ASCII-least letters is the least integer, and an ordinary minimum over the DAG
of (row, place in the pattern), from the last row to the first, decides
everything. The letters name the edits: the pattern leaves one role to each.

Rows are partitioned by conversation, sorted and streamed. A conversation of
more than ``chunk`` rows is cut: per chunk the least cost between each two
places in the pattern (16 numbers) gives, carried back over the chunks, the
cost still to come after each of them; with it each chunk settles its own edits
for every place it can be entered at. Inserts go before a row, so that no
path of a chunk is the beginning of another. The last pass replays the edits
in order and takes the digest, one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet.llm.text import WHITE_SPACE, digest128, written
from rivet.operators.rank import global_row_number

CHUNK = 1024  # rows that one dynamic programme takes

# FIXED VALUES: letters of the edits in ASCII order, their costs, ends of
# sentences, initials that may follow each other
LETTERS = "DIKR"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
STOPS = ".!?"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

# places in the pattern: at the start, after s, after u, after a
START, S, U, A = range(4)
KEEPS = [{"s": S, "u": U}, {"u": U}, {"a": A}, {"u": U}]  # where a kept row's initial leads
NEXT = [U, U, A, U]  # where a reroled or inserted row leads
ROLE = {U: "user", A: "assistant"}
_BITS = 3  # of one letter

Row = tuple[str, bool, bool]  # initial, has to go, truncated


def weight(cost: int, letter: str, bits: int) -> int:
    """An edit as a number; without letters if the field has no bits."""
    return cost << bits | ((LETTERS.index(letter) + 1) << (bits - _BITS) if bits else 0)


def least(rows: list[Row], after: list[int], bits: int) -> list[int]:
    """Least numbers of the paths through all rows from each place in the
    pattern, given those after the last row."""
    low = (1 << bits) - 1

    def down(v: int) -> int:  # the letters one place down
        return v - (v & low) + ((v & low) >> _BITS)
    delete, insert = weight(DELETE, "D", bits), weight(INSERT, "I", bits)
    keep, rerole = [[weight(c + t, letter, bits) for t in (0, TRUNCATED)] for c, letter in ((0, "K"), (REROLE, "R"))]
    best = after
    for initial, must_go, truncated in reversed(rows):
        then = [down(v) for v in best]
        row = []
        for place in range(4):
            v = then[place] + delete
            if not must_go:
                v = min(v, then[NEXT[place]] + rerole[truncated])
                if initial in KEEPS[place]:
                    v = min(v, then[KEEPS[place][initial]] + keep[truncated])
            row.append(v)
        # two inserts reach every place; a third would only come back
        one = [down(row[NEXT[p]]) + insert for p in range(4)]
        best = [min(row[p], one[p], down(one[NEXT[p]]) + insert) for p in range(4)]
    return best


def field(n_rows: int) -> int:
    """Bits for the letters of a path: two inserts before each row, its edit,
    and two inserts at the end."""
    return _BITS * (3 * n_rows + 2)


def at_end(bits: int) -> list[int]:
    """Numbers after a conversation's last row: what must still be inserted."""
    one = weight(INSERT, "I", bits)
    return [0, one + weight(INSERT, "I", bits) - (one & ((1 << bits) - 1)) + ((one & ((1 << bits) - 1)) >> _BITS), one, 0]


def edits(rows: list[Row], to_come: list[int] | None) -> list[str]:
    """Letters of the best path from each place in the pattern. ``to_come``:
    costs after the rows, None at the end of the conversation."""
    bits = field(len(rows))
    after = at_end(bits) if to_come is None else [c << bits for c in to_come]
    out = []
    for v in least(rows, after, bits):
        letters, at = [], bits - _BITS
        while at >= 0 and (code := (v >> at) & 7):
            letters.append(LETTERS[code - 1])
            at -= _BITS
        out.append("".join(letters))
    return out


def costs_between(rows: list[Row]) -> list[int]:
    """Least cost from each place in the pattern (16 numbers, row by row) to each."""
    never = 1 << 50
    columns = [least(rows, [0 if p == to else never for p in range(4)], 0) for to in range(4)]
    return [columns[to][p] for p in range(4) for to in range(4)]


def faults(role: str, text: str, seen: bool) -> tuple[str | None, Row]:
    """The first fault of a row, and the row as the programme sees it."""
    bare = text.rstrip(WHITE_SPACE)
    fault = "blank" if not bare else "duplicate" if seen else "truncated" if bare[-1] not in STOPS else None
    return fault, (role[:1], fault in ("blank", "duplicate"), fault == "truncated")


class Repair:
    """One conversation, as its rows come by in order."""

    def __init__(self, emit=None):
        self.place, self.cost, self.lines = START, 0, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.before, self.seen = None, set()
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.pending: list[tuple[str, str, Row]] = []  # rows whose edits are not known yet
        self.letters: Iterator[str] | None = None
        self.emit = emit

    def _out(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1
        if self.emit:
            self.emit(role, text)

    def row(self, turn, role: str, text: str, again: bool | None) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if again is None:
            again = (role, text) in self.seen
            self.seen.add((role, text))
        fault, row = faults(role, text, again)
        if fault:
            self.counts[fault] += 1
        if self.before is not None and (self.before, row[0]) not in LEGAL:
            self.counts["illegal"] += 1
        self.before = row[0]
        if self.letters is None:
            self.pending.append((role, text, row))
        else:
            self._replay(role, text, row)

    def told(self, by_place: list[str]) -> None:
        """The edits of the rows that follow, for each place."""
        self._inserts()
        self.letters = iter(by_place[self.place])

    def _apply(self, letter: str) -> None:
        self.audit.append(letter)
        self.place = NEXT[self.place]

    def _replay(self, role: str, text: str, row: Row) -> None:
        for letter in self.letters:
            if letter == "I":
                self._apply(letter)
                self.cost += INSERT
                self._out(ROLE[self.place], "")
                continue
            if letter == "D":
                self.audit.append(letter)
                self.cost += DELETE
            elif letter == "K":
                self.audit.append(letter)
                self.place = KEEPS[self.place][row[0]]
                self.cost += TRUNCATED * row[2]
                self._out(role, text)
            else:
                self._apply(letter)
                self.cost += REROLE + TRUNCATED * row[2]
                self._out(ROLE[self.place], text)
            return

    def _inserts(self) -> None:
        """Edits after the last row."""
        for letter in self.letters or ():
            self._apply(letter)
            self.cost += INSERT
            self._out(ROLE[self.place], "")

    def end(self) -> tuple:
        if self.pending:
            self.letters = iter(edits([row for *_, row in self.pending], None)[START])
            for role, text, row in self.pending:
                self._replay(role, text, row)
        self._inserts()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return gaps, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest()


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple]:
    """(value of the first ``key`` columns, rows) of each run of a sorted partition."""
    own, rows = None, None
    for r in chain.from_iterable(zip(*[c.to_pylist() for c in b.columns], strict=True) for b in batches):
        if rows is None or r[:key] != own:
            if rows is not None:
                yield own, rows
            own, rows = r[:key], []
        rows.append(r[key:])
    if rows is not None:
        yield own, rows


def _chunk_rows(rows: list[tuple]) -> list[Row]:
    return [faults(role, text, again)[1] for role, text, again in rows]


def _chunked(df: DataFrame, more: list[str] | tuple = ()) -> DataFrame:
    """Rows of long conversations, a chunk's together and in order."""
    return (df.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "at")
            .select("conv", "chunk", *more, "role", "text", "again"))


def _settled(rows: DataFrame, long_ones: DataFrame, chunk: int) -> DataFrame:
    """Rows of the conversations in ``long_ones`` with their place ``at`` and
    whether they were seen before, and for each chunk a row ahead of it with
    its edits for each place in the pattern."""
    conv = rows.schema["conv"].dataType
    mine = rows.join(long_ones.select(F.col("conv").alias("l")), F.col("conv").eqNullSafe(F.col("l")), "left_semi")
    ranked = global_row_number(mine, [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "tie")], "at")
    first = ranked.groupBy(F.col("conv").alias("g")).agg(F.min("at").alias("begin"))
    seen = ranked.groupBy(F.col("conv").alias("h"), F.col("role").alias("r"), F.col("tie").alias("t")).agg(F.min("at").alias("original"))
    ranked = ranked.join(first, F.col("conv").eqNullSafe(F.col("g"))).join(
        seen, F.col("conv").eqNullSafe(F.col("h")) & (F.col("role") == F.col("r")) & (F.col("tie") == F.col("t")))
    ranked = written(ranked.select("conv", "turn", "role", "text", (F.col("at") - F.col("begin")).cast("long").alias("at"),
                                   (F.col("at") > F.col("original")).alias("again"))
                     .withColumn("chunk", F.floor(F.col("at") / F.lit(chunk)).cast("long")), "conversations-long")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, k), part in _runs(batches, 2):
            yield pa.RecordBatch.from_pydict({"conv": [c], "chunk": [k], "costs": [costs_between(_chunk_rows(part))]}, between)
    between = pa.schema([("conv", _arrow(conv)), ("chunk", pa.int64()), ("costs", pa.list_(pa.int64()))])
    costs = _chunked(ranked).mapInArrow(matrices, T.StructType([
        T.StructField("conv", conv), T.StructField("chunk", T.LongType()), T.StructField("costs", T.ArrayType(T.LongType()))]))

    def carried(pdf: pd.DataFrame) -> pd.DataFrame:  # one row per chunk
        pdf = pdf.sort_values("chunk", ascending=False)
        after, out = at_end(0), []
        for costs in pdf["costs"]:
            out.append(after)
            after = [min(int(costs[4 * p + to]) + after[to] for to in range(4)) for p in range(4)]
        out[0] = None
        return pd.DataFrame({"conv": pdf["conv"], "chunk": pdf["chunk"], "to_come": out})
    to_come = written(costs.groupBy("conv").applyInPandas(carried, T.StructType([
        T.StructField("conv", conv), T.StructField("chunk", T.LongType()),
        T.StructField("to_come", T.ArrayType(T.LongType()))])), "conversations-costs")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, k), part in _runs(batches, 2):
            letters = edits(_chunk_rows([r[1:] for r in part]), part[0][0])
            yield pa.RecordBatch.from_pydict({"conv": [c], "chunk": [k], "edits": [letters]}, settled)
    settled = pa.schema([("conv", _arrow(conv)), ("chunk", pa.int64()), ("edits", pa.list_(pa.string()))])
    told = to_come.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), "to_come")
    moves = _chunked(ranked.join(told, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))), ["to_come"]).mapInArrow(
        settle, T.StructType([T.StructField("conv", conv), T.StructField("chunk", T.LongType()),
                              T.StructField("edits", T.ArrayType(T.StringType()))]))
    ahead = moves.select("conv", (F.col("chunk") * chunk).alias("at"), "edits")
    return ranked.drop("chunk").unionByName(ahead, allowMissingColumns=True)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _ordered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, chunk: int) -> DataFrame:
    """All rows, a conversation's together and in order."""
    def bare(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), bare(role_col).alias("role"),
                       bare(text_col).alias("text")).withColumn("tie", digest128(F.col("text")))
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk)
    long_ones = written(sizes, "conversations-sizes")
    told = F.lit(None).cast("array<string>").alias("edits")
    short = rows
    if not long_ones.isEmpty():
        short = rows.join(long_ones.select(F.col("conv").alias("l")), F.col("conv").eqNullSafe(F.col("l")), "left_anti")
    every = short.select("conv", F.lit(0).cast("long").alias("at"), "turn", "role", "text", "tie",
                         F.lit(None).cast("boolean").alias("again"), told)
    if not long_ones.isEmpty():
        every = every.unionByName(_settled(rows, long_ones, chunk), allowMissingColumns=True)
    first = F.asc_nulls_first
    return (every.repartition("conv").sortWithinPartitions(first("conv"), "at", F.col("edits").isNull(), first("turn"), "role", "tie")
            .select("conv", "turn", "role", "text", "again", "edits"))


def _streamed(batches: Iterator[pa.RecordBatch], begin, end) -> Iterator:
    """Feed the rows of a sorted partition to one ``Repair`` per conversation."""
    own, repair = None, None
    for batch in batches:
        for conv, turn, role, text, again, told in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if repair is None or conv != own:
                if repair is not None:
                    end(own, repair)
                own, repair = conv, begin(conv)
            if told is None:
                repair.row(turn, role, text, again)
            else:
                repair.told(told)
        yield
    if repair is not None:
        end(own, repair)
    yield


def repair_report(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: ``id_col``, gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256 (digest of the repaired rows,
    ``role:text``, joined by newlines).

    Rows of a conversation are taken by turn, null turns first; rows of one
    turn by role and then by the digest of their text, so that rows that
    repeat stand side by side. A null role or text is one space: such a text
    is blank, such a role has no place in the pattern. Null ids are one
    conversation. Texts of any length are read whole, one row at a time.
    Columns that are not named are ignored. An empty table gives an empty
    result. A conversation's letters and its digest are made by one task, as
    both are sequences; the edits of a long one are settled by many.
    """
    kind = rows.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), *[T.StructField(c, T.LongType()) for c in _REPORT],
              T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    schema = pa.schema([(id_col, _arrow(kind)), *[(c, pa.int64()) for c in _REPORT], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for _ in _streamed(batches, lambda conv: Repair(), lambda conv, r: done.append((conv, *r.end()))):
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)],
                                                 schema=schema)
                done.clear()
    return _ordered(rows, id_col, turn_col, role_col, text_col, chunk).mapInArrow(run, T.StructType(fields))


def repaired_rows(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The repaired conversations, one row per turn: ``id_col``, place (from
    0), role and text. Inserted rows have an empty text. Nulls, ties, repeats
    and empty tables as in ``repair_report``."""
    kind = rows.schema[id_col].dataType
    fields = T.StructType([T.StructField(id_col, kind), T.StructField("place", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    schema = pa.schema([(id_col, _arrow(kind)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def begin(conv):
            repair = Repair()
            repair.emit = lambda role, text: out.append((conv, repair.lines - 1, role, text))
            return repair
        for _ in _streamed(batches, begin, lambda conv, r: r.end()):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                                 schema=schema)
                out.clear()
    return _ordered(rows, id_col, turn_col, role_col, text_col, chunk).mapInArrow(run, fields)


def damage(rows: DataFrame) -> DataFrame:
    """The test damage of ``conversations``: by crc32 of ``conv_id:turn``
    modulo 20 a row is dropped (0), emptied (1), loses its stops (2), is
    repeated (3) or gets the role user (4). Nulls are one space."""
    def told(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(told("text"), STOPS, "")).otherwise(told("text"))
    return (rows.select("conv_id", "turn", F.when(case == 4, "user").otherwise(told("role")).alias("role"), text.alias("text"),
                        F.explode(F.array_repeat(F.lit(1), F.when(case == 0, 0).when(case == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))
