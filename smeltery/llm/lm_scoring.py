"""Log-bilinear language model, trained by noise-contrastive estimation; normalised log-probabilities of texts.

Words are counted over all training texts by Spark. The most frequent ones, in classes of equal size by rank, have
vectors; the rest is one class whose words share its probability by their counts. The vectors of the last words,
each weighted by place, add up to a predicted vector. Its products with class vectors give the class, its products
with the word vectors of that class the word; both are normalised, so a text's probability is exact under the model.

Training passes once over all training tokens. Each task starts from the same vectors and learns from its part against
noise drawn from the counts; Spark adds up the tasks' parameters, weighted by their tokens. What reaches the driver
are counts of the most frequent words and one set of parameters, both of fixed size.

Counts are looked up in two tiers: a broadcast table of bounded size, and a join for the words it lacks.

Defined results: a null text counts as empty and has its end only; a null id hashes as the empty text; repeated rows
are separate texts, in training too. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codec import steps
from .common import documents, text_or_empty, written

FOLDS, HELD_OUT = 7, 2
#: Words with vectors, and words of a class.
MODEL_WORDS = 2048
CLASS_WORDS = 64
#: Words of the broadcast table of counts.
TABLE_WORDS = 1 << 17
CONTEXT = 3
WIDTH = 16
NOISE = 16
BATCH = 8192
RATE = 0.4
#: Partial counts a task holds before it hands them on.
HELD_WORDS = 300_000
#: Numbers of a row that carries parameters.
BLOCK = 4096
END = b""


def tokens(text: bytes) -> list[bytes]:
    """Words in ASCII lower case, then the end."""
    words = text.lower().split()
    words.append(END)
    return words


def is_held_out(id: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT):
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % folds == fold


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``count`` over rows of ``_text``."""

    def told(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in steps(batches):
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                counts.update(tokens(text))
            if len(counts) > HELD_WORDS:
                yield told(counts)
                counts.clear()
        yield told(counts)

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("count"))


def frequent_words(counts: DataFrame, most: int) -> pa.Table:
    """The most frequent words, at most so many, in order of their counts.

    Words are counted by steps of the logarithm of their count, a few thousand steps at most, and the
    table takes whole steps from the top: no task sends more than its share of the table.
    """
    step = F.floor(F.log2("count") * 64).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, held = None, 0
    for row in sorted(sizes, reverse=True):
        held += row["n"]
        if held > most:
            break
        least = row["step"]
    taken = counts.where(step >= least) if least is not None else counts.where("false")
    return taken.toArrow().sort_by([("count", "descending"), ("word", "ascending")])


class Statistics:
    """Counts of the frequent words, and totals over all."""

    def __init__(self, words: list[bytes], counts: list[int], train_tokens: int, distinct: int, model_words: int):
        self.words, self.counts = words, np.array(counts, dtype=np.int64)
        self.train_tokens, self.distinct = train_tokens, distinct
        self.model_words = min(model_words, len(words))
        self.rare_tokens = train_tokens - int(self.counts[: self.model_words].sum())
        self.rare_words = distinct - self.model_words

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.train_tokens + self.distinct + 1))

    def rare(self, counts: np.ndarray) -> np.ndarray:
        """Share of a rare word among rare words; one more stands for all words never seen."""
        return np.log10((counts + 1) / (self.rare_tokens + self.rare_words + 1))


class Model:
    """Parameters in one array, with views by part."""

    def __init__(self, statistics: Statistics, seed: int = 7):
        n = statistics.model_words
        self.n_words = n
        self.n_classes = -(-n // CLASS_WORDS) + 1  # the last one is for rare words
        rows = (self.n_classes - 1) * CLASS_WORDS
        shapes = {
            "seen": (n + 2, WIDTH),  # words in the context, rare words, nothing
            "place": (CONTEXT, WIDTH),
            "words": (rows, WIDTH),
            "word_bias": (rows,),
            "classes": (self.n_classes, WIDTH),
            "class_bias": (self.n_classes,),
        }
        self.parameters = np.zeros(sum(math.prod(s) for s in shapes.values()), dtype=np.float32)
        at = 0
        for name, shape in shapes.items():
            size = math.prod(shape)
            setattr(self, name, self.parameters[at : at + size].reshape(shape))
            at += size
        random = np.random.default_rng(seed)
        for part in (self.seen, self.words, self.classes):
            part[:] = random.normal(0, 0.1, part.shape)
        self.place[:] = 1.0
        counts = statistics.counts[:n].astype(np.float64)
        padded = np.zeros(rows)
        padded[:n] = counts + 1
        of_class = np.append(padded.reshape(-1, CLASS_WORDS).sum(axis=1), statistics.rare_tokens + 1)
        #: What noise is drawn from, by class and within classes.
        self.class_noise = of_class / of_class.sum()
        within = padded.reshape(-1, CLASS_WORDS) / np.maximum(of_class[:-1, None], 1)
        self.word_noise = within
        # Places of a class that no word has never get a share.
        self.word_bias[:] = np.log(np.maximum(within, 1e-30)).reshape(-1)
        self.class_bias[:] = np.log(self.class_noise)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return sum(self.seen[context[:, j]] * self.place[j] for j in range(CONTEXT))

    def log10_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target word after its context; of rare words, that some rare word comes."""
        vectors = self.predicted(context)
        classes = np.minimum(target // CLASS_WORDS, self.n_classes - 1)
        classes[target >= self.n_words] = self.n_classes - 1
        out = _normalised(vectors @ self.classes.T + self.class_bias, classes)
        order, bounds = _by_class(classes, self.n_classes)
        for c, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b:
                rows = order[a:b]
                block = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
                scores = vectors[rows] @ self.words[block].T + self.word_bias[block]
                out[rows] += _normalised(scores, target[rows] - c * CLASS_WORDS)
        return out / math.log(10)


def _by_class(classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their class, and where each class but the last begins and ends."""
    small = classes.astype(np.int16 if n_classes < 1 << 15 else np.int32)
    order = np.argsort(small, kind="stable")
    return order, np.searchsorted(small[order], np.arange(n_classes))


def _normalised(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Natural logarithms of the shares of the chosen columns, whatever the size of scores, which are used up."""
    scores -= scores.max(axis=1, keepdims=True)
    own = scores[np.arange(len(scores)), chosen].astype(np.float64)
    np.exp(scores, out=scores)
    return own - np.log(scores @ np.ones(scores.shape[1], dtype=scores.dtype))


class Noise:
    """Draws from counts, and the logarithms that draws are contrasted with."""

    def __init__(self, shares: np.ndarray):
        self._steps = np.cumsum(shares)
        self._steps /= self._steps[-1]
        self.levels = np.log(np.maximum(NOISE * shares, 1e-30)).astype(np.float32)

    def draw(self, random: np.random.Generator) -> np.ndarray:
        return np.searchsorted(self._steps, random.random(NOISE), side="right")


class Trainer:
    """Steps of noise-contrastive estimation, each parameter with a rate of its own."""

    def __init__(self, model: Model, seed: int):
        self.model = model
        self.random = np.random.default_rng(seed)
        self.squares = np.full(len(model.parameters), 1e-3, dtype=np.float32)
        self.trained = 0
        self.class_noise = Noise(model.class_noise)
        self.word_noise = [Noise(shares) for shares in model.word_noise]

    def _contrast(self, vectors, rows, bias, noise, target):
        """Gradients of telling the targets from noise: of vectors, rows and bias."""
        drawn = noise.draw(self.random)
        own = np.einsum("ij,ij->i", vectors, rows[target]) + bias[target] - noise.levels[target]
        with np.errstate(over="ignore"):  # then the chance is zero
            missed = 1 / (1 + np.exp(own))
            taken = 1 / (1 + np.exp(noise.levels[drawn] - bias[drawn] - vectors @ rows[drawn].T))
        to_vectors = missed[:, None] * rows[target] - taken @ rows[drawn]
        picks = np.zeros((len(target), len(rows)), dtype=np.float32)
        picks[np.arange(len(target)), target] = missed
        to_rows = picks.T @ vectors
        to_bias = picks.sum(axis=0)
        np.add.at(to_rows, drawn, -(taken.T @ vectors))
        np.add.at(to_bias, drawn, -taken.sum(axis=0))
        return to_vectors, to_rows, to_bias

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        m = self.model
        gradient = np.zeros_like(m.parameters)
        parts, at = {}, 0
        for name in ("seen", "place", "words", "word_bias", "classes", "class_bias"):
            value = getattr(m, name)
            parts[name] = gradient[at : at + value.size].reshape(value.shape)
            at += value.size
        vectors = m.predicted(context)
        classes = np.where(target < m.n_words, target // CLASS_WORDS, m.n_classes - 1)
        back, parts["classes"][:], parts["class_bias"][:] = self._contrast(
            vectors, m.classes, m.class_bias, self.class_noise, classes
        )
        order, bounds = _by_class(classes, m.n_classes)
        for c, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b:
                rows = order[a:b]
                block = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
                to_vectors, parts["words"][block], parts["word_bias"][block] = self._contrast(
                    vectors[rows], m.words[block], m.word_bias[block], self.word_noise[c], target[rows] - c * CLASS_WORDS
                )
                back[rows] += to_vectors
        for j in range(CONTEXT):
            words = context[:, j]
            order = np.argsort(words, kind="stable")
            sorted_words = words[order]
            first = np.flatnonzero(np.append(True, sorted_words[1:] != sorted_words[:-1]))
            of_word = np.add.reduceat(back[order], first, axis=0)
            some = sorted_words[first]
            parts["seen"][some] += of_word * m.place[j]
            # Rows of one word share its vector.
            parts["place"][j] = np.einsum("ij,ij->j", of_word, m.seen[some])
        gradient /= len(target)
        self.squares += gradient * gradient
        m.parameters += RATE * gradient / np.sqrt(self.squares)
        self.trained += len(target)


class Reader:
    """Numbers of words, and contexts, from texts. Training needs no words but those of the model."""

    def __init__(self, statistics: Statistics, whole_table: bool):
        self.n_words = statistics.model_words
        self.number = {w: i for i, w in enumerate(statistics.words if whole_table else statistics.words[: self.n_words])}

    def read(self, texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens; numbers of all tokens, -1 outside the table; their model words; contexts; where texts end."""
        split = [tokens(t) for t in texts]
        ends = np.cumsum([len(s) for s in split])
        flat = np.fromiter(map(self.number.get, chain.from_iterable(split), repeat(-1)), np.int64, int(ends[-1]))
        words = np.where((flat < 0) | (flat >= self.n_words), self.n_words, flat)
        place = np.arange(len(flat)) - np.repeat(np.append(0, ends[:-1]), np.diff(ends, prepend=0))
        context = np.full((len(flat), CONTEXT), self.n_words + 1, dtype=np.int32)
        for j in range(CONTEXT):
            context[j + 1 :, j] = words[: len(words) - j - 1]
            context[place <= j, j] = self.n_words + 1
        return split, flat, words, context, ends


_readers: dict[bool, tuple[Statistics, Reader]] = {}


def _reader(statistics: Statistics, whole_table: bool) -> Reader:
    """The worker's reader for the statistics it got."""
    if whole_table not in _readers or _readers[whole_table][0] is not statistics:
        _readers[whole_table] = statistics, Reader(statistics, whole_table)
    return _readers[whole_table][1]


def trained_parameters(texts: DataFrame, statistics) -> tuple[np.ndarray, int] | None:
    """Parameters averaged over tasks by tokens, from rows of ``_text``; ``statistics`` is broadcast."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = statistics.value
        model = Model(known)
        trainer = Trainer(model, TaskContext.get().partitionId())
        reader = _reader(known, whole_table=False)
        for batch in steps(batches):
            if not batch.num_rows:
                continue
            _, _, words, context, _ = reader.read(batch.column(0).cast(pa.binary()).to_pylist())
            order = trainer.random.permutation(len(words))
            for at in range(0, len(words), BATCH):
                some = order[at : at + BATCH]
                trainer.step(context[some], words[some])
        if trainer.trained:
            whole = model.parameters.astype(np.float64) * trainer.trained
            whole = np.append(whole, trainer.trained)
            for block, at in enumerate(range(0, len(whole), BLOCK)):
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int32()), "numbers": pa.array([whole[at : at + BLOCK].tobytes()])}
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(numbers)
        for block, numbers in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "numbers": pa.array([numbers.tobytes()])}
            )

    schema = "block int, numbers binary"
    total = texts.mapInArrow(train, schema).repartition("block").mapInArrow(add, schema)
    rows = sorted(total.collect())
    if not rows:
        return None
    whole = np.frombuffer(b"".join(r["numbers"] for r in rows))
    return (whole[:-1] / whole[-1]).astype(np.float32)


SCORED = (
    "doc_id {id}, held_out boolean, row long, n_tokens long, n_known long, base double, score double, "
    "missing array<struct<word:string,times:int>>"
)


def _scored(taken: DataFrame, known, parameters) -> DataFrame:
    """Sums over the words of the table, and the words it lacks, by row."""
    missing_type = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics = known.value
        reader, model = _reader(statistics, whole_table=True), Model(statistics)
        if parameters.value is not None:
            model.parameters[:] = parameters.value
        base_of = np.append(statistics.base(statistics.counts), 0.0)
        rare_of = np.append(statistics.rare(statistics.counts), 0.0)
        row = TaskContext.get().partitionId() << 40
        for batch in steps(batches):
            if not batch.num_rows:
                continue
            split, flat, words, context, ends = reader.read(batch.column(2).cast(pa.binary()).to_pylist())
            starts = np.append(0, ends[:-1])
            score = np.empty(len(flat))
            for at in range(0, len(flat), BATCH):
                part = slice(at, at + BATCH)
                score[part] = model.log10_probabilities(context[part], words[part])
            score += np.where(words == statistics.model_words, rare_of[flat], 0.0)
            lacking = np.flatnonzero(flat < 0)
            of_text = np.searchsorted(ends, lacking, side="right").tolist()
            found: list[Counter] = [Counter() for _ in split]
            for place, text in zip((lacking - starts[of_text]).tolist() if len(lacking) else [], of_text):
                found[text][split[text][place].decode()] += 1
            missing = [[{"word": w, "times": n} for w, n in c.items()] for c in found]
            arrays = [
                batch.column(0),
                batch.column(1),
                pa.array(np.arange(row, row + batch.num_rows)),
                pa.array(np.diff(ends, prepend=0)),
                pa.array(np.add.reduceat(flat >= 0, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(base_of[flat], starts)),
                pa.array(np.add.reduceat(score, starts)),
                pa.array(missing, missing_type),
            ]
            names = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "score", "missing"]
            yield pa.RecordBatch.from_arrays(arrays, names)
            row += batch.num_rows

    return taken.mapInArrow(run, SCORED.format(id=taken.schema["doc_id"].dataType.simpleString()))


def score_texts(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    model_words: int = MODEL_WORDS,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    taken = docs.select(F.col(id).alias("doc_id"), is_held_out(id).alias("held_out"), text_or_empty(text).alias("_text"))
    training = taken.where("NOT held_out").select("_text")
    counts = written(word_counts(training), "words")
    totals = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = frequent_words(counts, table_words)
    statistics = Statistics(
        [w.encode() for w in top["word"].to_pylist()],
        top["count"].to_pylist(),
        totals["n"] or 0,
        totals["v"],
        model_words,
    )
    known = spark.sparkContext.broadcast(statistics)
    parameters = spark.sparkContext.broadcast(trained_parameters(training, known))
    scored = written(_scored(taken, known, parameters), "scored")

    lacking = scored.select("row", F.explode("missing").alias("m")).select("row", "m.word", "m.times")
    looked_up = lacking.join(counts, "word", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    base_total = float(statistics.train_tokens + statistics.distinct + 1)
    rare_total = float(statistics.rare_tokens + statistics.rare_words + 1)
    of_row = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("count") + 1) / base_total)).alias("more_base"),
        F.sum(F.col("times") * F.log10((F.col("count") + 1) / rare_total)).alias("more_score"),
    )
    none = F.lit(0.0)
    return scored.join(of_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(statistics.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"),
    )


def op5_lm_scoring(spark, sf_dir):
    return score_texts(documents(spark, sf_dir))
