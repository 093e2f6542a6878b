"""Sum-of-squares packing: the level rule against a plain version, and whole packings against the vocabulary's library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpus_cases import EXTRA, SCHEMA, awkward_rows, by_id, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smeltery.llm import square_packing
from smeltery.llm.square_packing import Levels, Packer, powers_of_two

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_best(counts, size, new):
    """Try every level and add up all squares."""
    capacity = len(counts) - 1
    found = None
    for level in range(capacity - size + 1):
        if level == 0 and not new or level and not counts[level]:
            continue
        after = list(counts)
        if level:
            after[level] -= 1
        if level + size < capacity:
            after[level + size] += 1
        cost = (sum(n * n for n in after), -level)
        if found is None or cost < found[0]:
            found = cost, level
    return found and found[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=60), st.integers(1, 20))
def test_levels_choose_the_smallest_sum_of_squares(sizes, most_open):
    levels, n_open = Levels(12), 0
    for size in sizes:
        new = n_open < most_open
        level = levels.best(size, new)
        assert level == plain_best(levels.counts.tolist(), size, new)
        if level is not None:
            levels.moved(level, level + size)
            n_open += (level + size < 12) - (level > 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 9))
def test_packer_places_every_token_once(sizes, most_open):
    packer = Packer(16, most_open)
    for i, size in enumerate(sizes):
        packer.add((i, 0, np.arange(size, dtype="<u4"), size))
        assert packer._n_open <= most_open
    rest = packer.finish()
    assert all(sum(len(p[2]) for p in s) == 16 for s in packer.full)
    assert sum(len(p[2]) for p in rest) < 16
    cut = list(powers_of_two(rest))
    lengths = [sum(len(p[2]) for p in s) for s in cut]
    assert all(n & (n - 1) == 0 for n in lengths) and sum(lengths) == sum(len(p[2]) for p in rest)
    placed = sorted((i, start + k, int(t)) for s in packer.full + cut for i, start, ids, _ in s for k, t in enumerate(ids))
    assert placed == [(i, k, k) for i, size in enumerate(sizes) for k in range(size)]


def test_sizes_that_fill_each_other_are_not_cut():
    """Pairs that fill a sequence exactly, in any order, leave few open and need no cut."""
    sizes = [s for s in (3, 5, 6, 7) for _ in range(200)] + [16 - s for s in (3, 5, 6, 7) for _ in range(200)]
    random.Random(1).shuffle(sizes)
    packer = Packer(16, 1000)
    for i, size in enumerate(sizes):
        packer.add((i, 0, np.zeros(size, dtype="<u4"), size))
    assert all(start == 0 and len(ids) == total for s in packer.full for _, start, ids, total in s)
    assert packer._n_open < 60


def check(pieces, texts, capacity=square_packing.CAPACITY):
    """Every id in one piece, pieces gapless, lengths whole or powers of two. Ids in ``texts`` occur once."""
    library = Tokenizer.from_file(WORDS)
    for i, rows in by_id(pieces).items():
        ids = np.array(library.encode(texts[i] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert {r["doc_id"] for r in pieces} == set(texts)
    check_sequences(pieces, capacity)


def check_sequences(pieces, capacity=square_packing.CAPACITY):
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    short = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
        short += at < capacity
    return short


def test_packing_by_squares(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    check(square_packing.op11_square_packing(spark, SF_DIR).collect(), texts)


@pytest.mark.parametrize("limits", [{"capacity": 64, "most_open": 2}, {"capacity": 8}, {"capacity": 512, "group_tasks": 2}])
def test_packing_in_small_spaces(spark, limits):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5, "doc_id")
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    check(square_packing.pack_by_squares(docs, WORDS, **limits).collect(), texts, limits["capacity"])


def test_many_small_tasks_leave_few_short_sequences(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(60)
    pieces = square_packing.pack_by_squares(docs, WORDS).collect()
    assert check_sequences(pieces) <= 12


def test_packing_awkward_rows(spark):
    rows = awkward_rows()
    pieces = square_packing.pack_by_squares(table(spark, rows).repartition(3), WORDS).collect()
    check_sequences(pieces)
    once = {i for i in {r[0] for r in rows} if sum(i == r[0] for r in rows) == 1}
    texts = {i: t for i, t, _ in rows if i in once}
    check_one = [r for r in pieces if r["doc_id"] in once]
    library = Tokenizer.from_file(WORDS)
    n = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert {i: sum(r["length"] for r in rs) for i, rs in by_id(check_one).items()} == n
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert sum(r["length"] for r in pieces) == total
    assert len(EXTRA) and "piece" in EXTRA


def test_an_empty_table_has_no_pieces(spark):
    assert square_packing.pack_by_squares(spark.createDataFrame([], SCHEMA), WORDS).collect() == []
