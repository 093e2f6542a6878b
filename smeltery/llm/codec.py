"""Token ids of whole texts and texts of token ids, by a byte-level vocabulary.

The encoder is exact: backtracking over the longest tokens (see ``bpe``). Special strings inside a text become
their ids, as the vocabulary's library has it by default.

Defined results: a null text counts as empty and has no ids; ids that are null decode to the empty text. Every
row gets its result, repeated rows and null document ids too. Only the named columns are read. A text is held
whole by one task, a batch of them at a time, whatever their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import OffsetTable, decoder, encoder
from .common import documents, text_or_empty

VOCABULARY = "byte_bpe_50k.json"
#: A step of work ends at this many rows or characters.
STEP_ROWS = 500
STEP_CHARS = 2_000_000


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where their rows or the texts, their last column, get many; a longer text is a step by itself."""
    for batch in batches:
        begin = chars = 0
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy()
        for row, size in enumerate(sizes.tolist()):
            if row > begin and (chars + size > STEP_CHARS or row - begin == STEP_ROWS):
                yield batch.slice(begin, row - begin)
                begin, chars = row, 0
            chars += size
        yield batch.slice(begin)


def encoded_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches with ``ids`` in place of their last column, the texts."""
    made = encoder(path)
    for batch in steps(batches):
        raw = made.encode(batch.column(batch.num_columns - 1).to_pylist())
        offsets = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
        values = pa.array(np.frombuffer(b"".join(raw), dtype="<i4"))
        ids = pa.ListArray.from_arrays(pa.array(offsets), values)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])


def each_ids(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    return (flat[a:b] for a, b in zip(offsets, offsets[1:]))


def decoded_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches with the ``decoded`` texts after their last column, the ids."""
    made = decoder(path)
    for batch in batches:
        texts = [made.decode(ids) for ids in each_ids(batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
        )


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, and ``ids`` as an array."""
    taken = docs.select(*keep, text_or_empty(text).alias("_text"))
    fields = [*taken.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return taken.mapInArrow(lambda batches: encoded_batches(batches, path), T.StructType(fields))


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, and the ``decoded`` text."""
    taken = encoded.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids"))
    fields = [*taken.schema.fields, T.StructField("decoded", T.StringType())]
    return taken.mapInArrow(lambda batches: decoded_batches(batches, path), T.StructType(fields)).drop("_ids")


def digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Counts and hashes of ids and decoded texts, for batches of ``doc_id``, ``ids`` and ``decoded``."""
    decimal = OffsetTable([b"%d," % i for i in range(decoder(path).size)])
    for batch in batches:
        ids, texts = list(each_ids(batch.column(1))), batch.column(2).to_pylist()
        columns = [
            pa.array([len(i) for i in ids], pa.int64()),
            pa.array([hashlib.sha256(decimal.joined(i)[:-1]).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )


def op2_bpe_codec(spark, sf_dir):
    """Encoding, decoding and hashing in one pass: ids and decoded texts need not leave the worker."""
    path = public_tokenizers.path(VOCABULARY)
    taken = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return digests(decoded_batches(encoded_batches(batches, path), path), path)

    doc_id = taken.schema["doc_id"].dataType.simpleString()
    return taken.mapInArrow(run, f"doc_id {doc_id}, n_tokens long, ids_sha256 string, decoded_sha256 string")
