"""Removal of long byte strings that documents with smaller ids also hold, by externally induced suffix sorting.

A window is a string of ``WINDOW`` bytes inside one document. Every window has an anchor: of the strings of ``ANCHOR``
bytes in it, the one whose hash is least, the first if there are several. Equal windows have equal anchors, so
suffixes that begin at anchors are the only ones that are sorted; all others are induced from them:

1. Texts are cut into chunks of whole documents, kept compressed in the shared folder.
2. Neighbouring windows with one anchor make an item: their bytes, and where the anchor is. Items go to a shard by
   the hash of the anchor, one compressed frame per chunk and shard.
3. A shard sorts the suffixes at the anchors once, with the lengths of common prefixes of neighbours. Then, byte by
   byte to the left, the tuple of the byte before and the rank of the suffix behind it gives the order of the
   longer suffix. Windows are equal where the bytes to the left agree and the common prefix at the anchor covers
   the rest. Per set of equal windows the smallest document id is known, and who must give way.
4. Ranges to remove go back to their chunk.

Memory does not depend on the shard: frames are spooled to disk once they outgrow a buffer, and a shard with too
many different items is dealt into parts by other bits of the hash, items that share one anchor into single windows by a
hash of the window. Copies of an item are one item, however many there are.

Defined results: a null text counts as empty; a text shorter than a window keeps all its bytes; rows with equal ids do not
remove anything from each other; a null id counts as larger than all others. Only the named columns are read;
ids are whole numbers.
"""

from __future__ import annotations

import pickle
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_or_empty, written

WINDOW = 50
ANCHOR = 12
#: Raw bytes of a chunk; a longer document makes a chunk by itself.
CHUNK_BYTES = 8 << 20
#: Bytes looked at in one go for anchors.
SLICE_BYTES = 1 << 20
#: Raw text per shard; with more text than so many shards hold, shards grow, and are dealt into parts on disk.
SHARD_BYTES = 4 << 20
MAX_SHARDS = 2048
#: Different items a shard sorts in memory; beyond, it is dealt into parts on disk.
MAX_ITEMS = 600_000
PARTS = 32
#: How often parts are made by anchors before single windows are dealt.
BY_ANCHOR = 2
SPOOL_BYTES = 48 << 20
LEVEL = 6
NO_ID = np.iinfo(np.int64).max

CHUNKS = "chunk long, ids binary, sizes binary, text binary"


def _squeezed(array: np.ndarray) -> bytes:
    """An array of numbers, its bytes sorted by their place value, compressed."""
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T)
    return zstandard.compress(planes.tobytes(), 3)


def _spread(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def chunked(docs: DataFrame, id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Whole documents in compressed chunks: ids, sizes in bytes, and the bytes one after the other."""
    taken = docs.select(F.col(id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            known = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            row = [number, _squeezed(np.diff(known, prepend=0)), _squeezed(sizes)]
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(row[:1], pa.int64()),
                    "ids": pa.array(row[1:2], pa.binary()),
                    "sizes": pa.array(row[2:], pa.binary()),
                    "text": pa.array([zstandard.compress(b"".join(texts), LEVEL)], pa.binary()),
                }
            )

        for batch in batches:
            for one, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                raw = raw.as_py()
                if texts and held + len(raw) > chunk_bytes:
                    yield chunk()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(one)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield chunk()

    return taken.mapInArrow(run, CHUNKS)


def _mixed(words: np.ndarray, window: int = ANCHOR) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each place; ``words`` has the eight bytes from each place."""
    low = words[: len(words) - window + 8]
    high = words[window - 8 :]
    h = low * np.uint64(0x9E3779B97F4A7C15)
    h ^= (high * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(9)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a number, the first ones lowest."""
    words = data.astype(np.uint64)
    for step in (1, 2, 4):
        words = words[:-step] | (words[step:] << np.uint64(8 * step))
    return words


def _items(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, number of windows, place of the anchor in it and hash of the anchor of each item of a chunk."""
    found = []
    choices = WINDOW - ANCHOR + 1
    place = np.uint64(2 * SLICE_BYTES - 1)
    for at in range(0, len(data) - WINDOW + 1, SLICE_BYTES):
        part = data[at : at + SLICE_BYTES + WINDOW - 1]
        hashes = _mixed(_eight(part))
        least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while span < choices:
            step = min(span, choices - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        anchor = (least & place).astype(np.int64)
        begin = np.arange(at, at + len(anchor))
        document = np.searchsorted(ends, begin, side="right")
        inside = begin + WINDOW <= ends[document]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(anchor))
        real = inside[first]
        first, count = first[real], count[real]
        spot = anchor[first]
        found.append((begin[first], count, spot - first, hashes[spot]))
    if not found:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Mixed anew: hashes of anchors are the least of many, so their first bits are alike."""
    mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Frame:
    """Items of one chunk in one shard."""

    def __init__(self, chunk: int, ids: np.ndarray, places: np.ndarray, left: np.ndarray, contents: list[bytes]):
        self.chunk, self.ids, self.places, self.left, self.contents = chunk, ids, places, left, contents

    def packed(self) -> bytes:
        sizes = np.array([len(c) for c in self.contents], dtype=np.uint8)
        fields = [np.diff(self.ids, prepend=0), np.diff(self.places, prepend=0), self.left.astype(np.uint8), sizes]
        return pickle.dumps((self.chunk, [_squeezed(f) for f in fields], zstandard.compress(b"".join(self.contents), LEVEL)))

    @staticmethod
    def unpacked(data: bytes) -> Frame:
        chunk, fields, text = pickle.loads(data)
        ids, places, left, sizes = map(_spread, fields, (np.int64, np.int64, np.uint8, np.uint8))
        ends = np.cumsum(sizes, dtype=np.int64)
        raw = zstandard.decompress(text)
        contents = [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        return Frame(chunk, np.cumsum(ids), np.cumsum(places), left.astype(np.int64), contents)


def _framed(chunks: DataFrame, shards: int) -> DataFrame:
    """A row per chunk and shard with the items there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = zstandard.decompress(row["text"])
                ends = np.cumsum(_spread(row["sizes"], np.int64))
                ids = np.cumsum(_spread(row["ids"], np.int64))
                begin, count, left, hashes = _items(np.frombuffer(raw, dtype=np.uint8), ends)
                owner = ids[np.searchsorted(ends, begin, side="right")] if len(begin) else begin
                shard = _shard(hashes, shards)
                order = np.argsort(shard, kind="stable")  # by place within a shard
                bounds = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
                stop = begin + count + WINDOW - 1
                for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    if a < b:
                        of = order[a:b]
                        contents = [raw[x:y] for x, y in zip(begin[of].tolist(), stop[of].tolist())]
                        frame = Frame(row["chunk"], owner[of], begin[of], left[of], contents).packed()
                        yield pa.RecordBatch.from_pydict(
                            {"shard": pa.array([number], pa.int32()), "frame": pa.array([frame], pa.binary())}
                        )

    return chunks.mapInArrow(run, "shard int, frame binary")


class Spool:
    """Packed frames in memory, and on disk from a size on."""

    def __init__(self, spool_bytes: int = SPOOL_BYTES):
        self._file = tempfile.SpooledTemporaryFile(max_size=spool_bytes)
        self._sizes: list[int] = []

    def add(self, packed: bytes) -> None:
        self._file.write(packed)
        self._sizes.append(len(packed))

    def __iter__(self) -> Iterator[Frame]:
        at = 0
        for size in self._sizes:
            self._file.seek(at)
            yield Frame.unpacked(self._file.read(size))
            at += size

    def __len__(self) -> int:
        return len(self._sizes)

    def close(self) -> None:
        self._file.close()


def induced_minima(contents: list[bytes], left: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (item, number of the window in it) that an item with a smaller owner also holds."""
    if not contents:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    sizes = np.fromiter(map(len, contents), dtype=np.int64, count=len(contents))
    flat = np.frombuffer(b"".join(contents), dtype=np.uint8)
    spot = np.cumsum(sizes) - sizes + left
    behind = sizes - left  # bytes from the anchor on
    # Anchors no other item has are done.
    padded = np.concatenate([flat, np.zeros(WINDOW, dtype=np.uint8)])
    low, high = (
        sum(padded[spot + begin + k].astype(np.uint64) << np.uint64(8 * k) for k in range(8))
        for begin in (0, ANCHOR - 8)
    )
    order = np.lexsort((high, low))
    same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
    items = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    if not len(items):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # Sort the suffixes at anchors, and measure what neighbours have in common.
    width = -(-WINDOW // 8) * 8
    suffixes = np.zeros((len(items), width), dtype=np.uint8)
    for reach in range(WINDOW):
        suffixes[:, reach] = np.where(reach < behind[items], padded[spot[items] + reach], 0)
    columns = suffixes.view(">u8").astype(np.uint64)
    # Of suffixes that differ only in the zeros they are filled up with, the shorter come first, so equal ones stay together.
    order = np.lexsort([np.minimum(behind[items], WINDOW), *columns.T[::-1]])
    items, suffixes = items[order], suffixes[order]
    differ = suffixes[1:] != suffixes[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.concatenate([[0], np.minimum(common, np.minimum(behind[items][1:], behind[items][:-1]))])
    del suffixes, columns, differ

    def ranked(depth: int) -> np.ndarray:
        """Suffixes with this many bytes in common have one number."""
        return np.cumsum(common < depth)

    found_items, found_windows = [], []
    live = np.arange(len(items))  # positions in the sorted order, by class, within a class in order
    group = ranked(ANCHOR)
    for before in range(WINDOW - ANCHOR + 1):
        if before:
            live_items = items[live]
            able = left[live_items] >= before
            live, group, live_items = live[able], group[able], live_items[able]
            key = group * 256 + flat[spot[live_items] - before]
            order = np.argsort(key, kind="stable")
            live, key = live[order], key[order]
            group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        if not len(live):
            break
        size = np.bincount(group)
        shared = size[group] > 1
        live, group = live[shared], group[shared]
        rank = ranked(WINDOW - before)[live]
        whole = behind[items[live]] >= WINDOW - before
        held, classes, ranks = live[whole], group[whole], rank[whole]
        if len(held):
            new = np.concatenate([[True], (classes[1:] != classes[:-1]) | (ranks[1:] != ranks[:-1])])
            owners = owner[items[held]]
            least = np.minimum.reduceat(owners, np.flatnonzero(new))[np.cumsum(new) - 1]
            give = least < owners
            found_items.append(items[held[give]])
            found_windows.append(left[items[held[give]]] - before)
    if not found_items:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_items), np.concatenate(found_windows)


def _part(content: bytes, left: int, depth: int) -> int:
    told = content if depth >= BY_ANCHOR else content[left : left + ANCHOR]
    return xxhash.xxh32_intdigest(told, depth) % PARTS


def _dealt(frame: Frame, depth: int) -> Iterator[tuple[int, Frame]]:
    """The frame's items by part; in the end as single windows."""
    rows = zip(frame.ids.tolist(), frame.places.tolist(), frame.left.tolist(), frame.contents)
    if depth == BY_ANCHOR:
        rows = ((i, p + k, 0, c[k : k + WINDOW]) for i, p, _, c in rows for k in range(len(c) - WINDOW + 1))
    parts: list[list] = [[] for _ in range(PARTS)]
    for row in rows:
        parts[_part(row[3], row[2], depth)].append(row)
    for number, part in enumerate(parts):
        if part:
            ids, places, left, contents = zip(*part)
            yield number, Frame(frame.chunk, np.array(ids), np.array(places), np.array(left), list(contents))


def removed_ranges(spool: Spool, max_items: int = MAX_ITEMS, depth: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk, begins and ends of the bytes to remove, frame by frame. Closes the spool."""
    numbers: dict[bytes, int] = {}
    left: list[np.ndarray] = []
    owner = np.zeros(0, dtype=np.int64)
    whole = depth > BY_ANCHOR  # single windows: the bytes tell all
    too_many = False
    for frame in spool:
        before = len(numbers)
        at = np.array([numbers.setdefault(c, len(numbers)) for c in frame.contents])
        new = len(numbers) - before
        owner = np.concatenate([owner, np.full(new, NO_ID)])
        np.minimum.at(owner, at, frame.ids)
        fresh = np.zeros(new, dtype=np.int64)
        added = at >= before
        fresh[at[added] - before] = frame.left[added]
        left.append(fresh)
        too_many = len(numbers) > max_items
        if too_many:
            break
    if too_many:
        del numbers, left, owner
        parts = [Spool(SPOOL_BYTES // PARTS) for _ in range(PARTS)]
        for frame in spool:
            for number, part in _dealt(frame, depth):
                parts[number].add(part.packed())
        spool.close()
        for part in parts:
            yield from removed_ranges(part, max_items, depth + 1)
        return
    if whole:
        runs_of: dict[int, list[tuple[int, int]]] = {}
    else:
        contents = list(numbers)
        items, windows = induced_minima(contents, np.concatenate(left) if left else owner, owner)
        order = np.lexsort((windows, items))
        items, windows = items[order], windows[order]
        breaks = np.ones(len(items), dtype=bool)
        breaks[1:] = (items[1:] != items[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(breaks)
        last = np.append(first[1:], len(items)) - 1
        runs_of = {}
        for i, a, b in zip(items[first].tolist(), windows[first].tolist(), windows[last].tolist() if len(items) else []):
            runs_of.setdefault(i, []).append((a, b + WINDOW))
    has_runs = np.zeros(len(numbers), dtype=bool)
    has_runs[list(runs_of)] = True
    for frame in spool:
        at = np.array([numbers[c] for c in frame.contents])
        sizes = np.fromiter(map(len, frame.contents), dtype=np.int64, count=len(at))
        copies = frame.ids > owner[at]
        begins, ends = [frame.places[copies]], [frame.places[copies] + sizes[copies]]
        some = np.flatnonzero(~copies & has_runs[at])
        if len(some):
            pairs = [(p + a, p + b) for p, i in zip(frame.places[some].tolist(), at[some].tolist()) for a, b in runs_of[i]]
            more = np.array(pairs)
            begins.append(more[:, 0])
            ends.append(more[:, 1])
        begin, end = np.concatenate(begins), np.concatenate(ends)
        if len(begin):
            order = np.argsort(begin, kind="stable")
            yield frame.chunk, begin[order], end[order]
    spool.close()


def _solved(framed: DataFrame, max_items: int) -> DataFrame:
    """Ranges to remove, by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((s.as_py(), f) for batch in batches for s, f in zip(batch.column(0), batch.column(1)))
        for _, frames in groupby(rows, key=lambda row: row[0]):
            spool = Spool()
            for _, frame in frames:
                spool.add(frame.as_py())
            for chunk, begin, end in removed_ranges(spool, max_items):
                ranges = pickle.dumps((_squeezed(np.diff(begin, prepend=0)), _squeezed(end - begin)))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([chunk], pa.int64()), "ranges": pa.array([ranges], pa.binary())}
                )

    ordered = framed.repartition("shard").sortWithinPartitions("shard")
    return ordered.mapInArrow(run, "chunk long, ranges binary")


KEPT = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"


def _covered(size: int, ranges: Iterable[bytes]) -> np.ndarray:
    steps = np.zeros(size + 1, dtype=np.int32)
    for packed in ranges:
        begin, length = (_spread(x, np.int64) for x in pickle.loads(packed))
        begin = np.cumsum(begin)
        np.add.at(steps, begin, 1)
        np.add.at(steps, begin + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _applied(chunks: DataFrame, ranges: DataFrame, whole_characters: bool) -> DataFrame:
    """Each document with what is left of it; without the rest of characters cut in two, if asked."""
    by_chunk = ranges.groupBy("chunk").agg(F.collect_list("ranges").alias("ranges"))
    joined = chunks.join(by_chunk, "chunk", "left").select("ids", "sizes", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                ids, sizes, text, found = (batch.column(c)[n].as_py() for c in range(4))
                raw = zstandard.decompress(text)
                data = np.frombuffer(raw, dtype=np.uint8)
                covered = _covered(len(data), found or ())
                ends = np.cumsum(_spread(sizes, np.int64))
                names = np.cumsum(_spread(ids, np.int64))
                rows = []
                for name, begin, end in zip(names.tolist(), [0, *ends.tolist()], ends.tolist()):
                    gone = covered[begin:end]
                    n_removed = int(np.count_nonzero(gone))
                    one = raw[begin:end]
                    n_spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if n_removed else 0
                    kept = data[begin:end][~gone].tobytes() if n_removed else one
                    if whole_characters and n_removed:
                        kept = kept.decode("utf-8", "ignore").encode()
                    digest = xxhash.xxh64_intdigest(one, 42)
                    signed = digest - (1 << 64) if digest >> 63 else digest
                    rows.append((None if name == NO_ID else name, signed, end - begin, n_removed, n_spans, kept))
                kinds = [*[pa.int64()] * 5, pa.binary()]
                for a in range(0, len(rows), 2000):
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows[a : a + 2000]), kinds)]
                    yield pa.RecordBatch.from_arrays(
                        columns, ["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept"]
                    )

    return joined.mapInArrow(run, KEPT)


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    max_items: int = MAX_ITEMS,
    whole_characters: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n_bytes``, ``n_removed``, ``n_spans``, and the bytes ``kept``."""
    total = docs.select(F.sum(F.octet_length(text_or_empty(text))).alias("n")).first()["n"] or 0
    chunks = written(chunked(docs, id, text, chunk_bytes), "chunks")
    framed = _framed(chunks, min(MAX_SHARDS, max(1, -(-total // shard_bytes))))
    return _applied(chunks, written(_solved(framed, max_items), "ranges"), whole_characters)


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """All rows and columns, the texts without what was removed; a character cut in two goes as a whole.

    ``n_chars``, where the table has it, follows the text.
    """
    changed = remove_repeats(docs, id, text, whole_characters=True, **limits).where("n_removed > 0")
    left = changed.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.first("kept").alias("_kept")
    )
    filled = text_or_empty(text)
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(id).cast("bigint").alias("_doc"), F.xxhash64(filled).alias("_text_hash")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    joined = rows.join(left, same, "left").select("_row", "_kept")
    whole = F.coalesce(F.col("_kept").cast("string"), F.col("_row")[text])
    out = joined.select("_row", whole.alias("_new"))
    new = {text: F.col("_new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text_or_empty("_new")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op1_suffix_dedup(spark, sf_dir):
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Bytes are pairs of hexadecimal digits here, so that strings of them can be cut anywhere.
OP1_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT doc_id, 256 * k AS base, substr(h, 512 * k + 1, 512 + {2 * WINDOW - 2}) AS h
  FROM (SELECT doc_id, h, unnest(range((length(h) + 511) // 512)) AS k FROM d)),
w AS (
  SELECT doc_id, base + k AS p, substr(h, 2 * k + 1, 2) AS one,
    CASE WHEN 2 * k + {2 * WINDOW} <= length(h) THEN substr(h, 2 * k + 1, {2 * WINDOW}) END AS win
  FROM (SELECT doc_id, base, h, unnest(range(least(256, length(h) // 2))) AS k FROM parts)),
firsts AS (SELECT win, min(doc_id) AS first_id FROM w WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
f AS (SELECT doc_id, p, one, coalesce(first_id < doc_id, false) AS again FROM w LEFT JOIN firsts USING (win)),
c AS (
  SELECT doc_id, p, one, max(again::INT) OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) = 1 AS covered FROM f),
s AS (
  SELECT *, covered AND NOT coalesce(lag(covered) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM c),
t AS (
  SELECT doc_id, count(*) FILTER (WHERE covered) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
    string_agg(one, '' ORDER BY p) FILTER (WHERE NOT covered) AS kept FROM s GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
