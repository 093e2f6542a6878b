"""Whitening and hard-negative mining against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from oracle_check import differences, duck
from pyspark.sql import functions as F

from smeltery.llm import hard_negatives, vectors, whitening

SF_DIR = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Rows of (id, vector, label), with columns named like those the operators use inside."""
    kind = "vec_id long, embedding array<float>, label int, id string, row string, x string, n string, _x string, stripe string"
    floats = lambda v: None if v is None else [None if c is None else float(c) for c in v]
    return spark.createDataFrame([(i, floats(v), y, *["own"] * 6) for i, v, y in rows], kind)


def awkward_vectors():
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(5)], i % 3) for i in range(60)]
    rows += [(i, rows[0][1], 0) for i in range(60, 90)]  # copies of an anchor
    rows += [rows[0], rows[7], (None, rows[3][1], 1), (None, rows[4][1], 2), (-100, rows[5][1], 2)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0, None, 0, 0, 0], 1), (203, [1.0, math.nan, 0, 0, 0], 1)]
    rows += [(204, [math.inf, 0, 0, 0, 0], 1), (300, [1.0, 2.0], 1), (400, rows[6][1], None), (500, [0.0] * 5, 1)]
    return rows


def usable(rows, width=5):
    """Vectors of finite numbers and of the common length."""
    return [r for r in rows if r[1] and len(r[1]) == width and all(c is not None and math.isfinite(c) for c in r[1])]


def whole(vector, scale, add=0):
    return [math.floor(float(np.float32(c)) * scale) + add for c in vector]


# ---- whitening


def whitening_of(rows):
    """By the covariance matrix: n, deviations, whitened rows and shares."""
    x = np.array([whole(v, whitening.SCALE, whitening.ADDED) for _, v, _ in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum(int(c) ** 2 for c in row) for row in n * x - sums]
    return n, deviation, centred @ axes / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


def check_whitening(found, rows, components):
    n, deviation, white, share = whitening_of(rows)
    of = {}
    for r in found:
        of.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    assert sum(map(len, of.values())) == len(rows) * components
    for (i, _, _), d, w in zip(rows, deviation, white):
        own = of[i, d]
        for c in range(components):
            got = [r for r in own if r["component"] == c + 1]
            assert {r["n"] for r in got} == {n}
            assert min(abs(abs(r["whitened"]) - abs(w[c])) for r in got) < 1e-7
            assert all(abs(r["explained"] / share[c] - 1) < 1e-9 for r in got)
            assert all(r["identity_error"] < 1e-9 for r in got)
    for c in range(components):  # one sign for all rows
        by_id = {i: w[c] for (i, _, _), w in zip(rows, white)}
        signs = {r["whitened"] * by_id[r["vec_id"]] > 0 for r in found if r["component"] == c + 1 and abs(r["whitened"]) > 1e-6}
        assert len(signs) == 1


def read_rows(spark):
    e = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    return [(r["vec_id"], r["embedding"], r["label"]) for r in e]


def test_whitening_matches_the_covariance(spark):
    check_whitening(whitening.op13_whitening(spark, SF_DIR).collect(), read_rows(spark), 8)


def test_whitening_of_awkward_rows(spark, tmp_path):
    rows = awkward_vectors()
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    known = [r for r in usable(rows) if r[0] is not None]
    found = whitening.op13_whitening(spark, str(tmp_path)).collect()
    assert len(found) == 5 * len(usable(rows))
    _, deviation, _, _ = whitening_of(usable(rows))
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == sorted(deviation)
    assert sum(r["vec_id"] is None for r in found) == 10
    frame(spark, known).write.parquet(str(tmp_path / "known/embeddings.parquet"))
    check_whitening(whitening.op13_whitening(spark, str(tmp_path / "known")).collect(), known, 5)


def vectors_of(spark, x):
    return spark.createDataFrame([(i, [int(c) for c in v]) for i, v in enumerate(x)], "vec_id long, vector array<bigint>")


@pytest.mark.parametrize("x", [[], [[3, 4]], [[1, 2], [1, 2], [1, 2]]])
def test_vectors_without_variance_have_no_components(spark, x):
    assert whitening.whiten(vectors_of(spark, x)).collect() == []


def test_dependent_dimensions_have_no_component_of_their_own(spark):
    base = np.random.default_rng(2).integers(-50, 50, (200, 3))
    x = np.c_[base, base[:, 0] + base[:, 1], np.full(200, 7), 2 * base[:, 2]]
    found = whitening.whiten(vectors_of(spark, x)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    assert max(r["identity_error"] for r in found) < 1e-9


def test_small_variances_keep_their_digits(spark):
    """A variance 1e14 times smaller than the largest, which products of the rows alone would lose."""
    draw = np.random.default_rng(4)
    x = np.c_[draw.integers(-(10**8), 10**8, 300), draw.integers(-9, 10, 300), draw.integers(-1000, 1000, 300)]
    x[:, 2] += x[:, 0]
    found = whitening.whiten(vectors_of(spark, x)).collect()
    values = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    share = {r["component"]: r["explained"] for r in found}
    assert np.allclose([share[k] for k in (1, 2, 3)], values / values.sum(), rtol=1e-6, atol=0)


def test_results_do_not_depend_on_partitions(spark):
    x = np.random.default_rng(5).integers(-500, 500, (97, 6))
    by_parts = []
    for parts in (1, 5, 120):
        rows = whitening.whiten(vectors_of(spark, x).repartition(parts)).collect()
        by_parts.append({(r["vec_id"], r["component"]): r["whitened"] for r in rows})
    for other in by_parts[1:]:
        assert other.keys() == by_parts[0].keys()
        assert max(abs(other[k] - v) for k, v in by_parts[0].items()) < 1e-9


def test_numbers_that_cannot_be_centred_exactly_are_refused(spark):
    with pytest.raises(ValueError, match="exactly"):
        whitening.whiten(vectors_of(spark, [[2**60, 1], [0, 1]]))


def test_triangular_solves():
    draw = np.random.default_rng(1)
    factor = np.triu(draw.standard_normal((70, 70))) + 10 * np.eye(70)
    rows = draw.standard_normal((20, 70))
    assert np.allclose(whitening.solved(rows, factor) @ factor, rows)


# ---- hard negatives


def mined(rows, anchors_every=100, positives=5, negatives=10, width=5):
    """Every anchor against every row, one by one."""
    held = []
    for k, (i, vector, label) in enumerate(usable(rows, width)):
        if label is not None:
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            held.append((k, i, label, whole(vector, hard_negatives.SCALE)))
    out = []
    for k, i, label, x in held:
        if i is None or i % anchors_every:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, lab) for r, j, lab, y in held if r != k]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:negatives]
            out += [(i, positive, rank, j, p, s) for rank, (s, j, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def listed(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_negatives_match_sql(spark):
    found = hard_negatives.op12_hard_negatives(spark, SF_DIR)
    assert differences(duck(SF_DIR), hard_negatives.OP12_SQL, found) == []
    assert listed(found) == mined(read_rows(spark), width=64)


def test_negatives_of_awkward_rows(spark, tmp_path):
    rows = awkward_vectors()
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    expected = mined(rows)
    assert listed(hard_negatives.op12_hard_negatives(spark, str(tmp_path))) == expected
    assert {r[0] for r in expected} >= {0, -100}


@pytest.mark.parametrize("limits", [{"stripe": 7, "group": 2}, {"codes": 1}, {"codes": 3, "stripe": 40}])
def test_negatives_do_not_depend_on_blocks_or_codes(spark, limits):
    draw = random.Random(9)
    # A third of all rows has one label, and many rows are alike.
    rows = [(i, [draw.choice([-1.0, 0.5, 1.0]) for _ in range(5)], draw.choice([0, 0, 0, 1, 2, 3])) for i in range(150)]
    df = frame(spark, rows)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    prepared = df.select("vec_id", moved.alias("label"), vectors.whole("embedding", hard_negatives.SCALE).alias("vector"))
    found = hard_negatives.mine(prepared, F.col("vec_id") % 10 == 0, **limits)
    assert listed(found) == mined(rows, anchors_every=10)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], None)], [(0, [1.0, 2.0], 1)]])
def test_tables_without_negatives(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert hard_negatives.op12_hard_negatives(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("width", [3, 64, 100])
@pytest.mark.parametrize("codes", [1, 2, 6])
def test_intervals_hold_the_product(width, codes):
    draw = np.random.default_rng(width)
    x = np.floor(256 * draw.standard_normal((400, width)) * draw.choice([0, 0.01, 1, 30], (400, 1)))
    anchors = np.concatenate([x[:20], np.floor(50 * draw.standard_normal((10, width)))])
    turn = hard_negatives.rotation(width)
    assert np.allclose(turn @ turn.T, np.eye(width))
    low, high = hard_negatives.intervals(hard_negatives.Codes.of(x, turn, codes), anchors, turn)
    products = anchors @ x.T
    assert (low <= products).all() and (products <= high).all()


def test_more_codes_make_narrower_intervals():
    x = np.random.default_rng(0).standard_normal((300, 64)) * 100
    turn = hard_negatives.rotation(64)
    widths = []
    for codes in (1, 3, 6):
        low, high = hard_negatives.intervals(hard_negatives.Codes.of(x, turn, codes), x[:20], turn)
        widths.append((high - low).mean())
    assert widths[0] > 2.5 * widths[1] > 6 * widths[2]


def test_intervals_drop_most_rows(spark):
    """On real vectors few rows are left to be scored."""
    x = np.array([whole(v, 256) for _, v, _ in read_rows(spark)], dtype=float)
    turn = hard_negatives.rotation(x.shape[1])
    low, high = hard_negatives.intervals(hard_negatives.Codes.of(x, turn, hard_negatives.CODES), x[:30], turn)
    reach = np.partition(low, len(x) - 10, axis=1)[:, len(x) - 10]
    assert (high >= reach[:, None]).mean() < 0.2


def test_large_entries_are_refused(spark):
    rows = spark.createDataFrame([(0, 1, [2**40, 1]), (1, 1, [1, 1])], "vec_id long, label int, vector array<bigint>")
    with pytest.raises(ValueError, match="too large"):
        hard_negatives.mine(rows, F.lit(True))
