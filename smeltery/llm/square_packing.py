"""Sum-of-squares packing of token sequences, online, with cuts in place of padding.

Each map task keeps an array with the number of open sequences at every fill level. A document goes to the level (or starts
a new sequence) where the sum of the squared counts is lowest afterwards, of levels alike the fullest. No level then
gathers many sequences, whatever the sizes, so most sizes soon find one that they fill exactly. Documents longer than a sequence give
whole sequences first and go on with the rest. Only a bounded number of sequences is open; when none is allowed
more and none has room, the document is cut to fill up the fullest.

At the end of a task its open sequences fill each other up, the fullest first, by cutting pieces of the emptiest. One
sequence may be left; the few tokens of each task meet in a second round of the same method, in groups of bounded
size, and what a group leaves is cut into sequences whose lengths are powers of two. So nothing is padded. Placements are
written to the shared folder before anything depends on them, so a task that runs again cannot disagree with itself.

Defined results: a null text counts as empty and makes one piece, the end token alone; repeated rows and null ids are
packed like others. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .codec import steps
from .common import documents, text_or_empty, written

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 2
END = END_ID.to_bytes(4, "little")
#: Sequences a task keeps open; their ids are in its memory.
MOST_OPEN = 1024
#: Tasks whose last tokens are packed together.
GROUP_TASKS = 1000
#: Rows of a batch of pieces.
BATCH = 4096


class Levels:
    """How many open sequences there are at each fill level, and the level that keeps squares of these counts low."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)

    def best(self, size: int, new: bool) -> int | None:
        """The level to put ``size`` tokens on; 0 is a new sequence, if ``new`` allows one."""
        last = self.capacity - size
        start, end = self.counts[: last + 1], self.counts[size:]
        # Taking one from a level changes its square by 1 - 2 n, adding one by 1 + 2 n.
        change = 2 * (end - start) + 2
        change[0] -= 1  # a new sequence is taken from nowhere
        change[last] -= 1  # a full one is added nowhere
        open_ = start > 0
        open_[0] = new
        change[~open_] = np.iinfo(np.int64).max
        found = last - int(np.argmin(change[::-1]))
        return found if open_[found] else None

    def moved(self, before: int, after: int) -> None:
        if before:
            self.counts[before] -= 1
        if after < self.capacity:
            self.counts[after] += 1


#: doc_id, start, ids, doc_tokens
Piece = tuple[object, int, np.ndarray, int]


class Packer:
    """Places pieces; ``full`` gathers the sequences that are complete."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = MOST_OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.levels = Levels(capacity)
        self.full: list[list[Piece]] = []
        self._at: dict[int, list[list[Piece]]] = defaultdict(list)
        self._n_open = 0

    def add(self, piece: Piece) -> None:
        name, start, ids, total = piece
        while len(ids) >= self.capacity:
            self.full.append([(name, start, ids[: self.capacity], total)])
            start, ids = start + self.capacity, ids[self.capacity :]
        while len(ids):
            level = self.levels.best(len(ids), self._n_open < self.most_open)
            if level is None:  # cut, to fill up the fullest
                level = int(np.flatnonzero(self.levels.counts)[-1])
            head = ids[: self.capacity - level]
            self._put(level, (name, start, head, total))
            start, ids = start + len(head), ids[len(head) :]

    def _put(self, level: int, piece: Piece) -> None:
        sequence = self._at[level].pop() if level else []
        sequence.append(piece)
        after = level + len(piece[2])
        self.levels.moved(level, after)
        self._n_open += (after < self.capacity) - (level > 0)
        (self.full if after == self.capacity else self._at[after]).append(sequence)

    def finish(self) -> list[Piece]:
        """Fill open sequences up by each other; what is left, less than one sequence."""
        rest = [s for level in sorted(self._at, reverse=True) for s in self._at[level]]
        self._at.clear()
        self.levels.counts[:] = 0
        self._n_open = 0
        first, last = 0, len(rest) - 1
        sizes = [sum(len(p[2]) for p in s) for s in rest]
        while first < last:
            name, start, ids, total = rest[last].pop()
            taken = min(len(ids), self.capacity - sizes[first])
            rest[first].append((name, start, ids[:taken], total))
            sizes[first] += taken
            if taken < len(ids):
                rest[last].append((name, start + taken, ids[taken:], total))
            if sizes[first] == self.capacity:
                self.full.append(rest[first])
                first += 1
            if not rest[last]:
                last -= 1
            else:
                sizes[last] = sum(len(p[2]) for p in rest[last])
        if first > last or not rest[first]:
            return []
        if sizes[first] == self.capacity:
            self.full.append(rest[first])
            return []
        return rest[first]


def powers_of_two(pieces: Iterable[Piece]) -> Iterator[list[Piece]]:
    """Sequences whose lengths are powers of two, the longest first, of all the tokens of the pieces."""
    pieces = list(pieces)
    left = sum(len(p[2]) for p in pieces)
    while left:
        size = 1 << left.bit_length() - 1
        left -= size
        sequence = []
        while size:
            name, start, ids, total = pieces[0]
            taken = min(size, len(ids))
            sequence.append((name, start, ids[:taken], total))
            pieces[:1] = [(name, start + taken, ids[taken:], total)] if taken < len(ids) else []
            size -= taken
        yield sequence


PIECES = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.binary()),
    ("task", pa.int64()),
]
PIECES_DDL = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, task long"
)


class _Rows:
    """Rows of pieces, in batches."""

    def __init__(self, id_type: pa.DataType, first_sequence: int):
        self._type, self._next, self._held = id_type, first_sequence, []

    def add(self, sequences: list[list[Piece]]) -> None:
        for sequence in sequences:
            offset = 0
            for name, start, ids, total in sequence:
                crc = zlib.crc32(ids.tobytes())
                self._held.append((name, start, len(ids), crc, total, self._next, offset, None, None))
                offset += len(ids)
            self._next += 1
        sequences.clear()

    def leave(self, pieces: list[Piece], task: int) -> None:
        for name, start, ids, total in pieces:
            raw = ids.tobytes()
            self._held.append((name, start, len(ids), None, total, None, None, raw, task))

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self._held) >= least:
            names, *columns = zip(*self._held)
            self._held = []
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, PIECES)]
            yield pa.RecordBatch.from_arrays([pa.array(names, self._type), *arrays], ["doc_id", *dict(PIECES)])


def _placed(docs: DataFrame, path: str, id: str, text: str, capacity: int, most_open: int) -> DataFrame:
    """A row per piece; pieces of the sequence that a task leaves open keep their ids and have no place."""
    taken = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made, packer, rows = encoder(path), Packer(capacity, most_open), None
        for batch in steps(batches):
            rows = rows or _Rows(batch.column(0).type, task << 40)
            for name, raw in zip(batch.column(0).to_pylist(), made.encode(batch.column("_text").to_pylist())):
                ids = np.frombuffer(raw + END, dtype="<u4")
                packer.add((name, 0, ids, len(ids)))
            rows.add(packer.full)
            yield from rows.batches(BATCH)
        if rows:
            left = packer.finish()
            rows.add(packer.full)
            rows.leave(left, task)
            yield from rows.batches()

    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, {PIECES_DDL}")


def _second_round(left: DataFrame, capacity: int, most_open: int, group_tasks: int) -> DataFrame:
    """Places for the pieces that tasks left, group by group."""
    id_type = left.schema["doc_id"].dataType.simpleString()

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("task", "ascending"), ("length", "descending"), ("start", "ascending")])
        packer = Packer(capacity, most_open)
        rows = _Rows(table.schema.field("doc_id").type, (1 << 62) + (key[0].as_py() << 40))
        for row in table.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
            packer.add((row["doc_id"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"]))
        rest = packer.finish()
        rows.add(packer.full)
        rows.add(list(powers_of_two(rest)))
        return pa.Table.from_batches(rows.batches())

    grouped = left.withColumn("group", F.expr(f"task div {group_tasks}")).groupBy("group")
    return grouped.applyInArrow(run, f"doc_id {id_type}, {PIECES_DDL}")


def pack_by_squares(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    most_open: int = MOST_OPEN,
    group_tasks: int = GROUP_TASKS,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``capacity`` is a power of two."""
    placed = written(_placed(docs, path, id, text, capacity, most_open), "square-pieces")
    second = _second_round(placed.where("task IS NOT NULL"), capacity, most_open, group_tasks)
    return placed.where("task IS NULL").unionByName(second).drop("ids", "task")


def op11_square_packing(spark, sf_dir):
    return pack_by_squares(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
