"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified distance, components.

Two fingerprints that differ in at most ``d`` of 64 bits agree on at least ``b - d`` of ``b`` blocks. Every choice of
that many blocks is a key; fingerprints meet under equal keys, and their distance is verified there. More blocks
make longer, rarer keys but more of them; ``b`` follows the number of distinct fingerprints, and every ``b`` finds
every pair. Equal fingerprints are one node before anything is joined, so exact copies cost nothing. Under one
key only a spanning star of each linked set is emitted, never its pairs. A key with more fingerprints than a
task should hold at once is dealt out in pairs of chunks, which together see every pair.

Defined results: a null text counts as empty; texts without words have fingerprint zero and link like others;
rows with one id are one document; rows without an id get a fingerprint, link nothing, and have no component.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codec import steps
from .common import documents, text_or_empty, written
from .components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Fingerprints a key should have on average, at most.
KEY_LOAD = 8
#: A key with more fingerprints is dealt out in chunks of this size.
CHUNK = 4096


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Each bit by majority over the hashes of the word shingles, as a signed 64-bit number."""
    words = text.lower().split()  # on bytes: ASCII letters and the six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, stops)], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a long."""
    taken = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            column = batch.column("_text").cast(pa.binary()).to_pylist()
            bits = pa.array([fingerprint(t, width) for t in column], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], ["doc_id", "bits"])

    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, bits long")


def key_masks(distinct: int, max_distance: int = MAX_DISTANCE) -> list[int]:
    """The bits of each key, as signed longs."""
    blocks = max_distance + 1
    while blocks < max_distance + 5 and distinct > KEY_LOAD << (64 * (blocks - max_distance) // blocks):
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - max_distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a signed number, the bits of its size would count


def linked_sets(bits: np.ndarray, ids: np.ndarray, max_distance: int) -> Iterator[tuple[int, int]]:
    """The sets that links within the distance connect, each as links from its smallest id."""
    order = np.argsort(ids)
    bits, ids = bits[order], ids[order]
    while len(ids) > 1:
        root, frontier = ids[0], bits[:1]
        bits, ids = bits[1:], ids[1:]
        while len(frontier) and len(bits):
            near = np.zeros(len(bits), dtype=bool)
            for one in frontier:
                near |= distance(bits, one) <= max_distance
            for member in ids[near].tolist():
                yield int(root), member
            frontier = bits[near]
            bits, ids = bits[~near], ids[~near]


#: Either a link of two nodes, or a row of a chunk of a group that was too large.
_TOLD = pa.schema(
    [
        ("a", pa.int64()),
        ("b", pa.int64()),
        ("mask", pa.int32()),
        ("key", pa.int64()),
        ("part", pa.int32()),
        ("bits", pa.int64()),
        ("node", pa.int64()),
    ]
)
_TOLD_DDL = "a long, b long, mask int, key long, part int, bits long, node long"


def _told(**known: np.ndarray) -> pa.RecordBatch:
    n = len(next(iter(known.values())))
    columns = [pa.array(known[f.name], f.type) if f.name in known else pa.nulls(n, f.type) for f in _TOLD]
    return pa.RecordBatch.from_arrays(columns, schema=_TOLD)


def _links_in_groups(rows: np.ndarray, max_distance: int) -> Iterator[pa.RecordBatch]:
    """Links within each group of rows: columns that name the group, then bits and node."""
    edges = np.flatnonzero(np.any(rows[1:, :-2] != rows[:-1, :-2], axis=1)) + 1
    bounds = np.array([0, *edges.tolist(), len(rows)])
    sizes = np.diff(bounds)
    first = bounds[:-1][sizes == 2]
    near = first[distance(rows[first, -2], rows[first + 1, -2]) <= max_distance]
    links = list(zip(rows[near, -1].tolist(), rows[near + 1, -1].tolist()))
    for begin, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        group = rows[begin : begin + size]
        links += linked_sets(group[:, -2], group[:, -1], max_distance)
    if links:
        ends = np.array(links)
        yield _told(a=ends[:, 0], b=ends[:, 1])


def _chunk(rows: np.ndarray, part: int) -> pa.RecordBatch:
    """Rows of one large group, to be compared with its other chunks later."""
    mask, key, bits, node = rows.T
    return _told(mask=mask.astype(np.int32), key=key, part=np.full(len(rows), part, np.int32), bits=bits, node=node)


def _links(groups: DataFrame, by: list[str], max_distance: int, chunk: int | None) -> DataFrame:
    """Links within groups of rows (``bits``, ``node``). With ``chunk``, larger groups come back in chunks instead.

    Groups are read in order, so a task holds the rows of one batch and of the group at its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows of the last group seen, which may go on in the next batch
        parts = 0  # chunks of that group that are out already
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            rows = np.stack(columns, axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            if not len(rows):
                continue
            last = np.all(rows[:, :-2] == rows[-1, :-2], axis=1)
            begin = 0 if last.all() else len(rows) - int(np.argmin(last[::-1]))
            if begin:
                whole, rows = rows[:begin], rows[begin:]
                if parts:  # the rest of a group that was too large comes first
                    first = np.all(whole[:, :-2] == whole[0, :-2], axis=1)
                    stop = len(whole) if first.all() else int(np.argmin(first))
                    yield _chunk(whole[:stop], parts)
                    whole, parts = whole[stop:], 0
                if len(whole):
                    yield from _links_in_groups(whole, max_distance)
            while chunk and len(rows) > chunk:
                yield _chunk(rows[:chunk], parts)
                rows, parts = rows[chunk:], parts + 1
            held = rows
        if held is not None:
            yield from [_chunk(held, parts)] if parts else _links_in_groups(held, max_distance)

    ordered = groups.repartition(*by).sortWithinPartitions(*by).select(*by, "bits", "node")
    return ordered.mapInArrow(run, _TOLD_DDL)


def near_links(nodes: DataFrame, max_distance: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect all ``node`` whose ``bits`` are near; ``bits`` must be distinct."""
    masks = key_masks(nodes.count(), max_distance)
    keys = [F.struct(F.lit(i).alias("mask"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    keyed = nodes.select(F.explode(F.array(*keys)).alias("k"), "bits", "node").select("k.*", "bits", "node")
    first = written(_links(keyed, ["mask", "key"], max_distance, chunk), "near")
    hot = first.where("part IS NOT NULL").select("mask", "key", "part", "bits", "node")
    last = hot.groupBy("mask", "key").agg(F.max("part").alias("last"))
    # A chunk meets every chunk, itself included: pair (low, high) holds the rows of both.
    other = F.explode(F.sequence(F.lit(0), F.col("last")))
    dealt = hot.join(last, ["mask", "key"]).select("mask", "key", "part", "bits", "node", other.alias("other"))
    dealt = dealt.select(
        "mask", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "bits", "node"
    )
    second = _links(dealt, ["mask", "key", "low", "high"], max_distance, None)
    return first.where("a IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    chunk: int = CHUNK,
) -> DataFrame:
    """``doc_id``, its ``bits``, and ``component_id``: the smallest id that links of near fingerprints reach."""
    marked = written(fingerprints(docs, id, text, width), "fingerprints")
    nodes = marked.where("doc_id IS NOT NULL").groupBy("bits").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes, "nodes")
    found = connected_components(near_links(nodes, max_distance, chunk))
    named = nodes.join(found, "node", "left").select(
        "bits", F.coalesce("component", "node").alias("component_id")
    )
    joined = marked.join(named, "bits", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", "bits", own.alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The rows of the document that names its component, with all columns; rows without an id stay."""
    found = near_duplicates(docs, id, text, **limits)
    dropped = found.where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.select(F.struct("*").alias("_row"))
    kept = rows.join(dropped, F.col("_row")[id] == F.col("_gone"), "left_anti")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op7_simhash(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
