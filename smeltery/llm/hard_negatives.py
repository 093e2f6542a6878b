"""Hard negatives of anchors: rows of another label that score close below the anchor's own positives.

Every row gets short codes: the vector is rotated by a fixed random rotation, the signs of its entries are one code, and its
alignment (the part of the vector along the code's own unit vector) is stored with it. What the code leaves over is
rotated and coded again, a few times, and the length of the last rest is stored. The product of an anchor with a row is then
estimated by counting bits of codes against bit planes of the rotated anchor, and by Cauchy-Schwarz it cannot be
further from the estimate than rest and anchor allow. Rows whose interval cannot reach the answer are dropped;
those that can are scored in whole numbers, so results are exact.

All anchors meet all rows, in blocks: rows are dealt into stripes and anchors into groups, both of bounded size, by row
number and not by label or id, and a task works on one stripe and one group. Each task keeps only the best rows of each
anchor; a window joins those. Nothing is broadcast but the rotation, one number per pair of dimensions.

Defined results: a row without label or vector, with an empty vector, or with one whose length differs from the one most
vectors have (of two as frequent, the longer), takes no part. Each row stands for itself: a repeated row
is another row, may be a positive of its copy, and an anchor that occurs twice is answered twice. A null id comes last
among equal scores and is null in the result. An anchor without positives, or a positive without rows in its
range, gives no rows. Only the named columns are read. Entries too large for exact products in 64 bits end the job with an
error that says so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import common_length, embeddings, finite, matrix, whole

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these shares of the positive's, in hundredths.
LEAST, MOST = 30, 90
#: Codes of a vector: each codes what the ones before leave over.
CODES = 6
#: Bits of the whole numbers that stand for an anchor's entries.
PLANES = 8
#: Rows of a stripe, anchors of a group, anchors of a step.
STRIPE = 8192
GROUP = 16384
STEP = 32


def rotation(width: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits along the last axis as 64-bit words, filled up with zeros."""
    missing = -bits.shape[-1] % 64
    filled = np.concatenate([bits, np.zeros((*bits.shape[:-1], missing), dtype=bool)], axis=-1)
    return np.packbits(filled, axis=-1).view(np.uint64)


class Codes:
    """One-bit codes of vectors, their alignments, the lengths of the vectors and of what the codes leave over."""

    def __init__(self, words: np.ndarray, alignments: np.ndarray, lengths: np.ndarray, rests: np.ndarray):
        self.words, self.alignments, self.lengths, self.rests = words, alignments, lengths, rests

    @classmethod
    def of(cls, x: np.ndarray, turn: np.ndarray, codes: int) -> Codes:
        lengths = np.linalg.norm(x, axis=1)
        rest = x / np.maximum(lengths, 1e-300)[:, None]
        words, alignments = [], []
        for _ in range(codes):
            rest = rest @ turn
            signs = rest > 0
            unit = np.where(signs, 1.0, -1.0) / math.sqrt(x.shape[1])
            along = np.einsum("ij,ij->i", rest, unit)
            rest = rest - along[:, None] * unit
            words.append(_packed(signs))
            alignments.append(along)
        return cls(np.stack(words, axis=1), np.stack(alignments, axis=1), lengths, np.linalg.norm(rest, axis=1))


def intervals(codes: Codes, anchors: np.ndarray, turn: np.ndarray, planes: int = PLANES) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the product of each anchor with each coded vector: an array with a row per anchor, twice."""
    width = anchors.shape[1]
    length = np.linalg.norm(anchors, axis=1)[:, None]
    estimate = np.zeros((len(anchors), len(codes.lengths)))
    margin = np.zeros(estimate.shape)
    q = anchors
    for level in range(codes.words.shape[1]):
        q = q @ turn
        low = q.min(axis=1, keepdims=True)
        step = np.maximum((q.max(axis=1, keepdims=True) - low) / (2**planes - 1), 1e-300)
        steps = np.rint((q - low) / step)
        rounded = low + step * steps
        off = np.linalg.norm(q - rounded, axis=1)[:, None]  # how far the numbers that stand for the anchor are from it
        plane_words = _packed((steps.astype(np.int64)[:, None, :] >> np.arange(planes)[:, None]) & 1 == 1)
        words, aligned = codes.words[:, level], codes.alignments[:, level]
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        sums = np.zeros(estimate.shape, dtype=np.int64)
        for bit in range(planes):
            for word in range(words.shape[1]):
                common = np.bitwise_count(words[None, :, word] & plane_words[:, bit, word][:, None])
                sums += common.astype(np.int64) << bit
        along = (2 * (low * ones + step * sums) - rounded.sum(axis=1)[:, None]) / math.sqrt(width)
        estimate += aligned * along
        margin += np.abs(aligned) * off
    # The last rest is at right angles to the last code, so only the anchor's part beside that code counts.
    beside = np.sqrt(np.maximum(length**2 - np.maximum(np.abs(along) - off, 0) ** 2, 0))
    margin += codes.rests * beside + 1e-9 * length
    estimate *= codes.lengths
    margin = margin * codes.lengths + 1e-6
    return estimate - margin, estimate + margin


class _Rows:
    """Rows of one task, by label."""

    def __init__(self, table: pa.Table, label: np.ndarray, width: int, codes: int):
        order = np.argsort(label, kind="stable")
        table = table.take(pa.array(order))
        self.label = label[order]
        self.row = table["row"].to_numpy()
        self.no_id = pc.is_null(table["id"]).to_numpy()
        self.id = pc.fill_null(table["id"], 0).to_numpy()

        def binary(name: str, kind: str, *shape: int) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind).reshape(-1, *shape)

        self.x = binary("x", "<i4", width).astype(np.int64)
        if "words" in table.column_names:
            self.codes = Codes(
                binary("words", "<u8", codes, -(-width // 64)),
                binary("alignments", "<f8", codes),
                table["length"].to_numpy(),
                table["rest"].to_numpy(),
            )

    def part(self, rows: slice) -> Codes:
        c = self.codes
        return Codes(c.words[rows], c.alignments[rows], c.lengths[rows], c.rests[rows])

    def best(self, found: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Places of the first ``most`` of ``found`` by score, id and row."""
        order = np.lexsort((self.row[found], self.id[found], self.no_id[found], -scores))
        return order[:most]

    def ids(self, found: np.ndarray) -> pa.Array:
        return pa.array(self.id[found], pa.int64(), mask=self.no_id[found])


def _labels(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the labels of both tables."""
    both = pa.chunked_array([*rows["label"].chunks, *anchors["label"].chunks], rows.schema.field("label").type)
    numbers = both.combine_chunks().dictionary_encode().indices.to_numpy()
    return numbers[: rows.num_rows], numbers[rows.num_rows :]


def _kth(values: np.ndarray, most: int) -> float:
    """The ``most``-th largest value; minus infinity if there are fewer."""
    return np.partition(values, len(values) - most)[len(values) - most] if len(values) >= most else -math.inf


def _nearest_of_label(rows: _Rows, anchors: _Rows, turn: np.ndarray, most: int) -> Iterator[tuple]:
    """Per anchor: its place, and the best other rows of its label with their scores."""
    for label in np.unique(anchors.label):
        first, last = np.searchsorted(rows.label, [label, label + 1])
        own = np.flatnonzero(anchors.label == label)
        for begin in range(0, len(own) if last > first else 0, STEP):
            step = own[begin : begin + STEP]
            low, high = intervals(rows.part(slice(first, last)), anchors.x[step].astype(float), turn)
            for i, anchor in enumerate(step):
                other = rows.row[first:last] != anchors.row[anchor]
                reach = _kth(low[i][other], most)
                found = first + np.flatnonzero(other & (high[i] >= reach))
                scores = rows.x[found] @ anchors.x[anchor]
                best = rows.best(found, scores, most)
                yield anchor, found[best], scores[best]


def _within(rows: _Rows, anchors: _Rows, positives: list, turn: np.ndarray, limits: tuple[int, int], most: int) -> Iterator[tuple]:
    """Per anchor and positive: the anchor's place, the positive, and the best rows of other labels within its range."""
    least, greatest = limits
    for begin in range(0, len(anchors.row), STEP):
        step = range(begin, min(begin + STEP, len(anchors.row)))
        low, high = intervals(rows.codes, anchors.x[step.start : step.stop].astype(float), turn)
        for i, anchor in enumerate(step):
            other = rows.label != anchors.label[anchor]
            ranges = []
            may = np.zeros(len(other), dtype=bool)
            for positive in positives[anchor]:
                bottom, top = -(-least * positive["score"] // 100), greatest * positive["score"] // 100
                fits = other & (high[i] >= bottom) & (low[i] <= top)
                sure = fits & (low[i] >= bottom) & (high[i] <= top)
                may |= fits & (high[i] >= _kth(low[i][sure], most))
                ranges.append((positive, bottom, top))
            found = np.flatnonzero(may)
            scores = rows.x[found] @ anchors.x[anchor]
            for positive, bottom, top in ranges:
                inside = (bottom <= scores) & (scores <= top)
                best = rows.best(found[inside], scores[inside], most)
                yield anchor, positive, found[inside][best], scores[inside][best]


def _coded(taken: DataFrame, width: int, turn: np.ndarray, codes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            x = matrix(batch.column("x"), width)
            made = Codes.of(x.astype(float), turn, codes)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": np.arange(number, number + len(x)),
                    "id": batch.column("id"),
                    "label": batch.column("label"),
                    "is_anchor": batch.column("is_anchor"),
                    "x": pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary()),
                    "words": pa.array([w.tobytes() for w in made.words], pa.binary()),
                    "alignments": pa.array([a.tobytes() for a in made.alignments], pa.binary()),
                    "length": made.lengths,
                    "rest": made.rests,
                }
            )
            number += len(x)

    label = taken.schema["label"].dataType.simpleString()
    return taken.mapInArrow(
        run,
        f"row long, id long, label {label}, is_anchor boolean, x binary, words binary, alignments binary, "
        "length double, rest double",
    )


def mine(
    rows: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    codes: int = CODES,
    stripe: int = STRIPE,
    group: int = GROUP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchors`` holds.

    ``vector`` holds whole numbers and ``id`` is one. Positives are the best rows of the anchor's label by product with it, negatives the
    best rows of other labels whose score is from ``least`` to ``most`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    taken = rows.where(F.col(label).isNotNull()).select(
        F.col(id).cast("bigint").alias("id"),
        F.col(label).alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        F.col(vector).cast("array<bigint>").alias("x"),
    )
    width, n, largest = common_length(taken, "x")
    if largest >= 1 << 31 or width * largest**2 >= 1 << 62:
        raise ValueError(f"entries up to {largest} are too large for exact products of {width} dimensions")
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], names)
    turn = rotation(width)
    table = written(_coded(taken.where(F.size("x") == width), width, turn, codes), "codes")

    chosen = table.where("is_anchor").select("row", "id", "label", "x")
    stripes = math.ceil(n / stripe)
    groups = max(1, math.ceil(chosen.count() / group))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_stripe = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    # Dealt by row number: no label or id can make a stripe or a group larger than the others.
    dealt = (
        table.withColumn("stripe", F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int"))
        .withColumn("group", every_group)
        .drop("is_anchor")
    )

    def met(asked: DataFrame, work, schema: str) -> DataFrame:
        """What ``work`` finds for each stripe of rows and group of anchors."""
        asked = asked.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn(
            "stripe", every_stripe
        )
        empty = pa.schema([])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return empty.empty_table()
            labels = _labels(left, right)
            held, queries = _Rows(left, labels[0], width, codes), _Rows(right, labels[1], width, codes)
            order = np.argsort(labels[1], kind="stable")
            return pa.Table.from_batches([work(held, queries, right.take(pa.array(order)))])

        return dealt.groupBy("stripe", "group").cogroup(asked.groupBy("stripe", "group")).applyInArrow(run, schema)

    def best_of_label(held: _Rows, queries: _Rows, asked: pa.Table) -> pa.RecordBatch:
        out = [(np.zeros(0, np.int64),) * 3]
        for anchor, found, scores in _nearest_of_label(held, queries, turn, positives):
            out.append((np.full(len(found), anchor), found, scores))
        anchor, found, scores = map(np.concatenate, zip(*out))
        return pa.RecordBatch.from_pydict(
            {"anchor": queries.row[anchor], "row": held.row[found], "id": held.ids(found), "score": scores}
        )

    near = met(chosen, best_of_label, "anchor long, row long, id long, score long")
    by_score = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))
    own = (
        near.withColumn("place", place)
        .where(F.col("place") <= positives)
        .groupBy(F.col("anchor").alias("row"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    )
    with_positives = written(chosen.join(own, "row"), "positives")

    def best_of_others(held: _Rows, queries: _Rows, asked: pa.Table) -> pa.RecordBatch:
        columns: dict[str, list] = {k: [] for k in ("anchor", "anchor_id", "place", "positive_id", "positive_score")}
        found_rows, found_scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ids = asked["id"].to_pylist()
        wanted = asked["positives"].to_pylist()
        for anchor, positive, found, scores in _within(held, queries, wanted, turn, (least, most), negatives):
            values = (int(queries.row[anchor]), ids[anchor], positive["place"], positive["id"], positive["score"])
            for column, value in zip(columns.values(), values):
                column += [value] * len(found)
            found_rows.append(found)
            found_scores.append(scores)
        found = np.concatenate(found_rows)
        arrays = {k: pa.array(v, pa.int32() if k == "place" else pa.int64()) for k, v in columns.items()}
        return pa.RecordBatch.from_pydict(
            arrays | {"row": held.row[found], "id": held.ids(found), "score": np.concatenate(found_scores)}
        )

    schema = "anchor long, anchor_id long, place int, positive_id long, positive_score long, row long, id long, score long"
    hard = met(with_positives, best_of_others, schema)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*by_score))
    return (
        hard.withColumn("rank", rank)
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def op12_hard_negatives(spark, sf_dir):
    rows = embeddings(spark, sf_dir).where(finite("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    prepared = rows.select("vec_id", moved.alias("label"), whole("embedding", SCALE).alias("vector"))
    return mine(prepared, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""
