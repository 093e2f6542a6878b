"""Token counts of whole texts, without sending pre-tokens anywhere.

Two tiers, both in the map tasks. A broadcast table holds the token counts of the corpus's most frequent pre-tokens. They
come from a frequent-items sketch over all texts, whose size is a parameter, so the table is bounded.
What the table lacks is encoded once per worker and remembered, up to a bound. The tiers only save work: the
counts are the same whatever the table holds.

Defined results: a null text counts as empty, with no bytes and no tokens; every row gets its counts. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import REMEMBERED, Encoder, encoder
from .codec import steps
from .common import documents, text_or_empty

VOCABULARY = "word_bpe_49k.json"
MAX_TOKENS = 2048
#: Rows of the broadcast table, and items a sketch tracks to find them.
TABLE_ROWS = 8_192
TRACKED = 16_384
#: Longer runs of letters are left to the workers, so that the table is bounded in bytes too.
MAX_LETTERS = 64
#: Sketches of map tasks are merged in so many groups before one task merges the groups.
SKETCH_GROUPS = 32


def frequent_pre_tokens(docs: DataFrame, text: str = "text", rows: int = TABLE_ROWS, tracked: int = TRACKED) -> list[str]:
    """The most frequent runs of letters in lower case, about; at most ``rows``."""
    words = docs.select(F.explode(F.split(F.lower(text_or_empty(text)), r"[^\p{L}]+")).alias("word"))
    sketches = (
        words.where(f"word != '' AND length(word) <= {MAX_LETTERS}")
        .groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part"))
        .agg(F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch"))
    )
    # Grouped by a constant: merging without groups fails on a task that gets no sketch.
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {rows})")).alias("entry"))
    return [r[0] for r in top.select("entry.item").collect()]


class TokenCounter:
    """Counts tokens of texts. Counts in ``table`` are never forgotten, others are once they get too many."""

    def __init__(self, encoder: Encoder, table: dict[str, int], remembered: int = REMEMBERED):
        self._encoder = encoder
        self._table = table
        self._known = dict(table)
        self._remembered = remembered

    def count(self, texts: Sequence[str]) -> list[int]:
        split = [self._encoder.chunks(t) for t in texts]
        asked = set().union(*split)
        new = asked.difference(self._known)
        if len(self._known) + len(new) > self._remembered:
            self._known = self._table | {c: self._known[c] for c in asked if c in self._known}
        known = self._known
        parts = self._encoder.split_chunks(new)
        of = self._table | dict.fromkeys(self._encoder.vocabulary.specials, 1)
        rest = list(set(chain.from_iterable(parts)).difference(of))
        of.update(zip(rest, self._encoder.vocabulary.encode_pieces(rest)[1].tolist()))
        known.update((c, sum([of[p] for p in ps])) for c, ps in zip(new, parts))
        return [sum([known[c] for c in cs]) for cs in split]


#: The worker's counter and the table it was made with.
_counters: dict[str, tuple[object, TokenCounter]] = {}


def _counter(path: str, table: tuple[str, np.ndarray]) -> TokenCounter:
    if path not in _counters or _counters[path][0] is not table:
        words, counts = table
        entries = dict(zip(words.split("\n"), counts.tolist())) if words else {}
        _counters[path] = table, TokenCounter(encoder(path), entries)
    return _counters[path][1]


def token_counts(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), rows: int = TABLE_ROWS
) -> DataFrame:
    """The kept columns, ``n_bytes`` and ``n_tokens``."""
    made = encoder(path)
    # A run of letters is one pre-token unless the vocabulary normalises it to something else.
    words = [w for w in frequent_pre_tokens(docs, text, rows) if made.pre_tokens(w) == [w]]
    counts = made.vocabulary.encode_pieces(words)[1]
    table = docs.sparkSession.sparkContext.broadcast(("\n".join(words), counts))
    filled = text_or_empty(text)
    taken = docs.select(*keep, F.octet_length(filled).cast("bigint").alias("n_bytes"), filled.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, table.value)
        for batch in steps(batches):
            counts = pa.array(counter.count(batch.column("_text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], [*batch.schema.names[:-1], "n_tokens"])

    fields = [*taken.schema.fields[:-1], T.StructField("n_tokens", T.LongType())]
    return taken.mapInArrow(run, T.StructType(fields))


def op3_token_counts(spark, sf_dir):
    counted = token_counts(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))
