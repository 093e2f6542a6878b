"""Best-fit packing of token sequences, online and in bounded space.

Each map task keeps a fixed number of open bins, found by their free space through one bit set: the lowest bit at or
above a piece's length is the best fit. Pieces come in short runs, of each the longest first, which leaves
short ones to fill up bins. When a bin more than allowed would open, the fullest closes. Bins still
open at the end of a task are pieces themselves for a second round of the same method, in groups of bounded size,
so that small tasks do not leave half-empty sequences behind. Placements are written to the shared folder before
anything depends on them, so a task that runs again cannot disagree with itself.

Defined results: a null text counts as empty and makes one piece, the end token alone; repeated rows are packed
repeatedly. Only the named columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder, stored_vocabulary, token_bytes
from .codec import VOCABULARY, steps
from .common import documents, text_or_empty, written

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 4096
#: Pieces that wait before they are placed, the longest first; their numbers only, not their ids.
WAITING = 8192
#: Bins left open by tasks are packed in groups of about this many.
GROUP_BINS = 50_000


class OpenBins:
    """A bounded set of bins; ``place`` returns bin and offset."""

    def __init__(self, capacity: int, most: int, first_bin: int = 0):
        self.capacity, self.most = capacity, most
        self._free = 0  # bit f is set where a bin with f places free is open
        self._by_free: dict[int, list[int]] = defaultdict(list)
        self._n_open = 0
        self._next = first_bin

    def place(self, length: int) -> tuple[int, int]:
        fitting = self._free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self._n_open == self.most:
                self._take((self._free & -self._free).bit_length() - 1)  # the fullest closes
            chosen, free = self._next, self.capacity
            self._next += 1
        if free > length:
            self._by_free[free - length].append(chosen)
            self._free |= 1 << (free - length)
            self._n_open += 1
        return chosen, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self._by_free[free]
        taken = bins.pop()
        if not bins:
            self._free &= ~(1 << free)
        self._n_open -= 1
        return taken

    def still_open(self) -> Iterator[tuple[int, int]]:
        """Each open bin and the places used in it."""
        for free, bins in self._by_free.items():
            for one in bins:
                yield one, self.capacity - free


def cut(n_tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece: all whole but the first."""
    first = (n_tokens - 1) % capacity + 1
    yield 0, first
    for start in range(first, n_tokens, capacity):
        yield start, capacity


_libraries: dict[str, tiktoken.Encoding] = {}


def token_ids(path: str, text: str) -> np.ndarray:
    """Ids of a text by a byte-level vocabulary, through the library that encodes by rank: ids are the ranks here.

    Its pattern engine gives up on very long runs of blanks; the encoder in ``bpe`` gives the same ids.
    """
    if path not in _libraries:
        _libraries[path] = tiktoken.Encoding(
            path,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=token_bytes(path),
            special_tokens=stored_vocabulary(path)[1],
        )
    try:
        return _libraries[path].encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.frombuffer(encoder(path).encode([text])[0], dtype="<u4")


PIECES = pa.schema(
    [
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("bin", pa.int64()),
        ("offset", pa.int64()),
        ("used", pa.int64()),
    ]
)
PIECES_DDL = "piece int, start long, length long, ids_crc32 long, bin long, offset long, used long"


def _placed_pieces(
    docs: DataFrame, path: str, id: str, text: str, capacity: int, open_bins: int, waiting: int
) -> DataFrame:
    """A row per piece with its bin and offset; and a row without a piece for each bin left open."""
    taken = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("_text"))
    id_type = taken.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        kind, held = pa.int64(), []

        def placed() -> pa.RecordBatch:
            held.sort(key=lambda piece: -piece[3])
            names, *columns = zip(*[(*piece, *bins.place(piece[3]), None) for piece in held])
            held.clear()
            arrays = [pa.array(c, f.type) for c, f in zip(columns, PIECES)]
            return pa.RecordBatch.from_arrays([pa.array(names, kind), *arrays], ["doc_id", *PIECES.names])

        for batch in steps(batches):
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column("_text").to_pylist()):
                ids = np.append(token_ids(path, text), END_ID).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    held.append((name, number, start, length, zlib.crc32(ids[start : start + length])))
            if len(held) >= waiting:
                yield placed()
        if held:
            yield placed()
        left = list(bins.still_open())
        if left:
            nothing = {"doc_id": pa.nulls(len(left), kind)} | {f.name: pa.nulls(len(left), f.type) for f in PIECES}
            nothing["bin"] = pa.array([b for b, _ in left], pa.int64())
            nothing["used"] = pa.array([u for _, u in left], pa.int64())
            yield pa.RecordBatch.from_pydict(nothing)

    return taken.mapInArrow(run, f"doc_id {id_type}, {PIECES_DDL}")


def _packed_bins(left: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """Where each bin left open goes: the bin it joins and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("bin", pa.int64()), ("used", pa.int64())]))
        table = table.sort_by([("used", "descending"), ("bin", "ascending")])
        bins, names, rows = OpenBins(capacity, open_bins), {}, []
        for name, used in zip(table["bin"].to_pylist(), table["used"].to_pylist()):
            number, offset = bins.place(used)
            rows.append((name, names.setdefault(number, name), offset))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["bin", "into", "base"])

    return left.mapInArrow(run, "bin long, into long, base long")


def pack(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    waiting: int = WAITING,
    group_bins: int = GROUP_BINS,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    placed = written(_placed_pieces(docs, path, id, text, capacity, open_bins, waiting), "pieces")
    left = placed.where("piece IS NULL").select("bin", "used")
    groups = max(1, math.ceil(left.count() / group_bins))
    moved = _packed_bins(left.repartition(groups, "bin"), capacity, open_bins)
    return (
        placed.where("piece IS NOT NULL")
        .join(written(moved, "bins"), "bin", "left")
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            F.coalesce("into", "bin").alias("sequence_id"),
            (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        )
    )


def op4_best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
