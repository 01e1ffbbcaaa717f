"""Repair of conversation structure by a grammar-compressed dynamic program.

A conversation's rows, by turn (nulls first, then role and text), become one
symbol each: the role's initial if it may stay, ``s`` ``u`` ``a`` or ``o`` for
another (capitals: the text is truncated), or ``X`` if the row must go (blank,
or role and text seen earlier). Edits: keep (0), rerole to user or assistant
(2), delete (3), insert an empty user or assistant row (2); a truncated row that
stays costs 1 more. The cheapest edits that leave ``(s?(ua)+)?`` win, ties go to
the audit (initials K R D I in order) that is least in ASCII.

States: nothing yet, after s, after u, after a. A symbol is a min-plus transfer
matrix over them: entry (i, j) is the least cost from i to j, inserts before the
row included, with the audit as a rope. Two different audits of equal cost over
the same rows never begin one another (they end with a row's edit and have as
many of those), so the least rope of an entry stays least in any product.

Re-Pair: the distinct sequences of a batch of conversations are compressed
together; the most frequent pair of neighbours becomes a rule until pairs are
rare or 256 symbols are used. A rule's matrix is the product of its two parts',
made once, bottom-up, and shared by all conversations of the batch. A sequence
is then the product of its few symbols. A conversation longer than ``BLOCK`` rows
goes on block by block from the vector it has reached.

Spark deals the rows by conversation and sorts them inside the partitions
(spilling); a task streams over them and holds a batch of symbols, not texts.
A repaired conversation is hashed as it streams by, behind its audit, in a
second pass; so a huge conversation costs one task's time, not its memory. (Its
audit and its hash are single values in the result.)

Defined cases: null text or role is one space, a null conversation id is an id of
its own, rows of a null turn come first; gaps ignore null turns; roles other
than s..., u..., a... cannot stay; repeated rows are duplicates; a conversation
without rows has zeros, an empty audit and the hash of an empty text; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, staged

#: Rows of a batch that is compressed together, and of one block of a conversation.
BATCH, BLOCK = 1 << 17, 1 << 16
#: A pair becomes a rule if it occurs so often in a batch's distinct sequences.
LEAST_USE = 4
STATES = 4  # nothing yet, after s, after u, after a
_NEXT = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),), "o": ()}
_INSERTS = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1}
SYMBOLS = "suaoSUAOX"

Rope = str | tuple
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def text_of(rope: Rope) -> str:
    """The letters of a rope."""
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += [x[1], x[0]]
    return "".join(out)


def _tied(a: Rope, b: Rope) -> Rope:
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64:
        return a + b
    return (a, b) if a and b else a or b


def _better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if text_of(a[1]) <= text_of(b[1]) else b


def step(vector: list[Entry], matrix: Matrix) -> list[Entry]:
    """Min-plus product of a row of entries and a matrix."""
    out: list[Entry] = [None] * STATES
    for i, v in enumerate(vector):
        if v is not None:
            for j, m in enumerate(matrix[i]):
                if m is not None and (out[j] is None or v[0] + m[0] <= out[j][0]):
                    out[j] = _better(out[j], (v[0] + m[0], _tied(v[1], m[1])))
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    return [step(row, b) for row in a]


def inserts() -> Matrix:
    """Inserts between two rows, or none."""
    return [[(0, "") if i == j else (2 * n, "I" * n) if (n := _INSERTS.get((i, j))) else None
             for j in range(STATES)] for i in range(STATES)]


def matrix_of(symbol: str) -> Matrix:
    """Inserts, then the edit of one row."""
    row: Matrix = [[(3, "D") if i == j else None for j in range(STATES)] for i in range(STATES)]
    if symbol != "X":
        extra = int(symbol.isupper())
        for role in "ua":
            for i, j in _NEXT[role]:
                row[i][j] = _better(row[i][j], (2 + extra, "R"))
        for i, j in _NEXT[symbol.lower()]:
            row[i][j] = _better(row[i][j], (extra, "K"))
    return product(inserts(), row)


def repair_pairs(sequences: list[np.ndarray], weights: np.ndarray,
                 kinds: int = len(SYMBOLS)) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Re-Pair: the compressed sequences and the rules (symbol ``kinds`` + k is
    the k-th rule's pair)."""
    rules: list[tuple[int, int]] = []
    flat = np.concatenate([np.append(s.astype(np.int64), 255) for s in sequences])  # 255 parts sequences
    owner = np.repeat(np.arange(len(sequences)), [len(s) + 1 for s in sequences])
    while kinds + len(rules) < 255:
        code = flat[:-1] * 256 + flat[1:]
        live = (flat[:-1] != 255) & (flat[1:] != 255)
        use = np.bincount(code[live], weights[owner[:-1][live]], 1 << 16)
        best = int(use.argmax())
        if use[best] < LEAST_USE:
            break
        at = np.flatnonzero((code == best) & live)
        if best >> 8 == best & 255:  # in a run of equal symbols every other place
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            at = at[(np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) % 2 == 0]
        flat[at] = kinds + len(rules)
        rules.append((best >> 8, best & 255))
        stay = np.ones(len(flat), bool)
        stay[at + 1] = False
        flat, owner = flat[stay], owner[stay]
    ends = np.flatnonzero(flat == 255)
    starts = np.append(0, ends[:-1] + 1)
    return [flat[a:b] for a, b in zip(starts, ends, strict=True)], rules


def solve(sequences: list[bytes], vectors: list[list[Entry]]) -> list[list[Entry]]:
    """Each vector taken through its sequence of symbols."""
    if not sequences:
        return []
    distinct: dict[bytes, int] = {}
    for s in sequences:
        distinct[s] = distinct.get(s, 0) + 1
    number = np.zeros(256, np.int64)
    number[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
    packed, rules = repair_pairs([number[np.frombuffer(s, np.uint8)] for s in distinct],
                                 np.fromiter(distinct.values(), np.float64, len(distinct)))
    matrices = [matrix_of(s) for s in SYMBOLS]
    for a, b in rules:  # bottom-up: a rule's parts come before it
        matrices.append(product(matrices[a], matrices[b]))
    by = dict(zip(distinct, packed, strict=True))
    done: dict[bytes, list[Entry]] = {}
    out = []
    for s, v in zip(sequences, vectors, strict=True):
        fresh = v is START
        if fresh and s in done:
            out.append(done[s])
            continue
        for k in by[s].tolist():
            v = step(v, matrices[k])
        v = [None if e is None else (e[0], text_of(e[1])) for e in v]
        if fresh:
            done[s] = v
        out.append(v)
    return out


START: list[Entry] = [(0, ""), None, None, None]


def finished(vector: list[Entry]) -> tuple[int, str]:
    end = step(vector, inserts())
    cost, rope = _better(end[0], end[3])
    return cost, text_of(rope)


# ---------------------------------------------------------------- rows

def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows damaged by the CRC-32 of
    ``conv_id:turn`` modulo 20 (0 drops, 1 empties, 2 takes ``.!?`` out, 3
    repeats, 4 makes the role user). A dropped row stays with ``gone`` true, so
    its conversation is still known."""
    blank = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv_id), F.lit(":"), blank(turn)).cast("binary")) % 20
    src = rows.select(quoted(conv_id).cast("long").alias("conv_id"), quoted(turn).cast("long").alias("turn"),
                      blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind"))
    return src.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with their faults, a conversation in one partition, sorted. One
    exchange; the window and the sort spill."""
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    body = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    flagged = rows.repartition("conv_id").select(
        "conv_id", "turn", "role", "text", "gone", (F.length(body) == 0).alias("blank"),
        (F.row_number().over(seen) > 1).alias("repeated"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    return flagged.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "repeated")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """(first, row): rows with a mark where a conversation begins."""
    last, begun = None, False
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield not begun or row[0] != last, row
            last, begun = row[0], True


class _Conv:
    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.vector = conv_id, bytearray(), START
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.least, self.most, self.turn, self.role = 0, None, None, None, None

    def add(self, turn, role, blank, repeated, cut) -> None:
        initial = role[:1]
        if blank or repeated:
            self.blank += blank
            self.duplicate += not blank
            self.symbols += b"X"
        else:
            self.truncated += cut
            s = initial if initial in ("s", "u", "a") else "o"
            self.symbols += (s.upper() if cut else s).encode()
        if self.role is not None and self.role + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = initial
        if turn is not None:  # sorted: equal turns are neighbours
            self.turns += turn != self.turn
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn

    def row(self) -> tuple:
        cost, audit = finished(self.vector)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _emitted(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def audited(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of
    every conversation of ``damaged`` rows, written once."""
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(convs: list[_Conv]) -> None:
            for c, v in zip(convs, solve([bytes(c.symbols) for c in convs], [c.vector for c in convs]), strict=True):
                c.vector, c.symbols = v, bytearray()
        waiting: list[_Conv] = []
        held = 0
        for first, (conv_id, turn, role, gone, blank, repeated, cut) in _runs(batches):
            if first:
                if held >= BATCH:
                    settled(waiting)
                    yield _emitted([c.row() for c in waiting], schema)
                    waiting, held = [], 0
                waiting.append(_Conv(conv_id))
                held += 1
            if not gone:
                conv = waiting[-1]
                conv.add(turn, role, blank, repeated, cut)
                held += 1
                if len(conv.symbols) >= BLOCK:
                    settled([conv])
        if waiting:
            settled(waiting)
            yield _emitted([c.row() for c in waiting], schema)
    src = _ordered(rows).select("conv_id", "turn", "role", "gone", "blank", "repeated", "cut")
    return staged(src.mapInArrow(run, _FOUND))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves of (role, text) rows."""
    after = ""

    def due() -> str:
        return "assistant" if after == "u" else "user"
    for edit in audit:
        if edit == "I":
            role, text = due(), ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            role = due() if edit == "R" else role
        after = role[:1]
        yield edit, role, text


def _repaired(rows: DataFrame, found: DataFrame, schema: str, make) -> DataFrame:
    """``make(conv_id, audit, rows)`` over each conversation: its audit comes
    first, then its rows in order, one at a time."""
    audits = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"))
    body = rows.where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    both = audits.unionByName(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.asc_nulls_first("turn"), "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _runs(batches)
        ahead = next(stream, None)

        def own() -> Iterator[tuple[str, str]]:
            nonlocal ahead
            while (ahead := next(stream, None)) is not None and not ahead[0]:
                yield ahead[1][1], ahead[1][2]

        def all_rows() -> Iterator[tuple]:
            while ahead is not None:
                conv_id, _, audit = ahead[1]
                rest = own()
                yield from make(conv_id, audit, rest)
                for _ in rest:  # rows that the audit deleted at the end
                    pass
        part: list[tuple] = []
        for row in all_rows():
            part.append(row)
            if len(part) >= 512:
                yield _emitted(part, arrow)
                part = []
        if part:
            yield _emitted(part, arrow)
    from pyspark.sql.pandas.types import to_arrow_schema
    spark_schema = rows.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(spark_schema)
    return both.mapInArrow(run, spark_schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations."""
    def make(conv_id, audit, own):
        for place, (edit, role, text) in enumerate(edited(audit, own)):
            yield conv_id, place, edit, role, text
    return _repaired(rows, found, "conv_id long, place long, edit string, role string, text string", make)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(of_conv, repaired_sha256): SHA-256 of each repaired conversation's
    ``role:text`` lines, newline-joined."""
    def make(conv_id, audit, own):
        h = hashlib.sha256()
        for place, (_, role, text) in enumerate(edited(audit, own)):
            h.update((("\n" if place else "") + role + ":" + text).encode())
        yield conv_id, h.hexdigest()
    return _repaired(rows, found, "of_conv long, repaired_sha256 string", make)
