"""Document fingerprints by consistent weighted sampling; their likeness estimates generalised Jaccard similarity.

Built on DataFrame functions alone.

A text's terms are its words, weighted by how often they occur. For each of ``SAMPLES`` samples a term has three random
numbers that depend on the term and the sample only: gamma variates r and c of shape 2 and a uniform b. A term of
weight w takes the step t = floor(ln w / r + b) and the value ln c - r * (t - b) - r; the term with the smallest value
and its step are the sample. Two texts draw the same sample with the probability of the sum of smaller weights
over the sum of larger ones.

The edited text of a document is its own first half and the beginning of the next document by descending id. The
next document is found among ids alone, in ranges of bounded size; then only the parts of texts that are needed move.
Own and edited text come from one row. A bound without logarithms leaves out most draws; texts with a sample that
this does not settle are drawn again in full.

Defined results: a null text counts as empty; texts without words have the fingerprint of zeros and are alike among
themselves; a null id comes after all others; rows that agree in id and text are one document and give one
row; of rows with one id, the larger hash of the text comes first. Only the named columns are read; ids are whole
numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, let, split_words, text_or_empty, written

SAMPLES = 64
#: The value of a term is kept in steps of this fraction.
_STEPS = 1 << 22
_LOW = 0xFFFFFFFF
#: Draws are left out if certainly above this many times the mean of the smallest; it is above that once in e^25 samples.
REACH = 25.0


def term_hashes(text: Column) -> Column:
    """Hashes of the words in rising order, one for each time a word occurs."""
    return F.sort_array(F.transform(split_words(text), lambda w: F.xxhash64(w)))


def weighted_terms(hashes: Column) -> Column:
    """The distinct of ``term_hashes`` and how often each occurs."""
    places = F.sequence(F.lit(0), F.size(hashes) - 1)
    first = F.filter(places, lambda i: ~F.get(hashes, i).eqNullSafe(F.get(hashes, i - 1)))
    counted = let(
        first,
        lambda at: F.transform(
            at,
            lambda i, k: F.struct(
                F.get(hashes, i).alias("term"),
                (F.coalesce(F.get(at, k + 1), F.size(hashes)) - i).alias("weight"),
            ),
        ),
    )
    return F.when(F.size(hashes) > 0, counted)


_BITS = 21
_SALT = 0x2545F4914F6CDD1D
_SALT_MASK = (1 << 62) - 1


def _salts(samples: int) -> Column:
    # Every draw has hash functions of its own: the term is changed by another constant before.
    return F.array(*[F.lit((2 * k + 1) * _SALT & _SALT_MASK).cast("bigint") for k in range(samples)])


def _uniform(h: Column, k: int) -> Column:
    """The number between 0 and 1 from the ``k``-th bits of a hash."""
    bits = F.shiftrightunsigned(h, _BITS * k).bitwiseAND(F.lit((1 << _BITS) - 1))
    return (bits.cast("double") + 0.5) * 2.0**-_BITS


def _uniforms(term: Column, salt: Column) -> dict[str, Column]:
    """``r`` is minus the logarithm of ``ab``, c of ``cd``; ``shift`` is b."""
    h = F.xxhash64(term.bitwiseXOR(salt))
    g = F.xxhash64(term.bitwiseXOR((salt + F.lit(_SALT)).bitwiseAND(F.lit(_SALT_MASK))))
    return {
        "ab": _uniform(h, 0) * _uniform(h, 1),
        "shift": _uniform(h, 2),
        "cd": _uniform(g, 0) * _uniform(g, 1),
    }


def _draw() -> Column:
    """Value and identity of a term's draw in one number: the smallest is the sample."""
    r = -F.log("ab")
    step = F.floor(F.log(F.col("weight").cast("double")) / r + F.col("shift"))
    value = F.log(-F.log("cd")) - r * (step.cast("double") - F.col("shift")) - r
    name = F.shiftright("term", 16).bitwiseXOR(step).bitwiseAND(F.lit(_LOW))
    return F.shiftleft((value * _STEPS).cast("bigint"), 32).bitwiseOR(name)


def _above(limit: Column) -> Column:
    """Whether a draw's value is certainly above the logarithm of ``limit``, without any logarithm.

    The exponential of the value is at least -ln cd * ab / w, as r * (t - b) is at most ln w. With w = 1 it is
    -ln cd * ab^p, p = 1 - b, since t = 0. For x between 0 and 1, -ln x is at least 2 (1 - x) / (1 + x), and x^p at least
    x / (x + p (1 - x)). The coarser test comes first, it settles most draws.
    """
    x, y = F.col("cd"), F.col("ab")
    coarse = (1.0 - x) * y > limit * F.col("weight")
    p = F.when(F.col("weight") == 1, 1.0 - F.col("shift")).otherwise(1.0)
    fine = 2.0 * (1.0 - x) * y > limit * F.col("weight") * (1.0 + x) * (y + p * (1.0 - y))
    return coarse | fine


def draws(texts: DataFrame, keys: list[str], carried: list[str], samples: int, reach: float | None) -> DataFrame:
    """One row for each term of ``text`` and ``edited`` and each sample, with what its draw needs.

    Among n words the exponential of the smallest value is exponentially distributed with mean 1/n. Draws certainly
    above ``reach`` / n are left out, with no ``reach`` none.
    """
    both = F.array(*[F.struct(F.lit(c == "edited").alias("edited"), F.col(c).alias("of")) for c in ("text", "edited")])
    sides = texts.select(*keys, *carried, F.explode(both).alias("side")).select(
        *keys, *carried, F.col("side.edited").alias("edited"), term_hashes(F.col("side.of")).alias("hashes")
    )
    terms = sides.select(
        *keys,
        *carried,
        "edited",
        F.greatest(F.size("hashes"), F.lit(1)).alias("words"),
        F.posexplode_outer(weighted_terms(F.col("hashes"))).alias("place", "t"),
    ).select(*keys, *carried, "edited", "words", "place", "t.*")
    each = terms.select("*", F.posexplode(_salts(samples)).alias("sample", "salt"))
    each = each.select("*", *[c.alias(name) for name, c in _uniforms(F.col("term"), F.col("salt")).items()])
    if reach is None:
        return each
    # The first term of a text is never left out, so that each sample has a row.
    left_out = (F.col("place") > 0) & _above(reach / F.col("words"))
    return each.where(~F.coalesce(left_out, F.lit(False)))


def _drawn(texts: DataFrame, keys: list[str], carried: list[str], samples: int, reach: float | None) -> DataFrame:
    """The columns of ``signatures`` and whether they are ``open``: a draw left out might be the smallest."""
    each = draws(texts, keys, carried, samples, reach)
    kept = [F.max(c).alias(c) for c in carried]
    found = each.groupBy(*keys, "edited", "words", "sample").agg(F.min(_draw()).alias("draw"), *kept)
    if reach is None:
        unsure = F.lit(False)
    else:
        # The margin covers rounding of the values and of the test.
        limit = F.floor((F.log(reach / F.col("words")) - 1e-5) * _STEPS)
        unsure = F.coalesce(F.shiftright("draw", 32) >= limit, F.lit(False))
    name = F.coalesce(F.col("draw").bitwiseAND(F.lit(_LOW)), F.lit(0).cast("bigint"))
    one = F.struct("edited", "sample", name.alias("name"))
    made = found.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("all"), F.max(unsure).alias("open"), *kept)
    names = packed(F.col("all.name"))
    return made.select(
        *keys,
        *carried,
        F.slice(names, 1, samples).alias("signature"),
        F.slice(names, samples + 1, samples).alias("edited_signature"),
        "open",
    )


def signatures(
    texts: DataFrame, keys: list[str], carried: list[str], samples: int = SAMPLES, reach: float = REACH
) -> DataFrame:
    """Keys, ``signature`` of ``text`` and ``edited_signature`` of ``edited``, arrays of packed sample names.

    Rows of equal keys have equal texts and carried numbers. All terms are grouped by the keys, so these should be short.
    """
    made = written(_drawn(texts, keys, carried, samples, reach), "signatures")
    left = made.where("open").select(*[F.col(k).alias(f"open_{k}") for k in keys])
    if left.isEmpty():
        return made.drop("open")
    same = [F.col(k).eqNullSafe(F.col(f"open_{k}")) for k in keys]
    again = written(_drawn(texts.join(left, same, "left_semi"), keys, carried, samples, None), "signatures-again")
    return made.where(~F.col("open")).unionByName(again).drop("open")


def packed(signature: Column) -> Column:
    """Names as 32-bit numbers."""
    return F.transform(signature, lambda s: (s - (1 << 31)).cast("int"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda s: s)
    return F.size(same) / F.lit(float(samples))


def as_text(signature: Column) -> Column:
    unpacked = F.transform(signature, lambda s: s.cast("bigint") + (1 << 31))
    return F.array_join(F.transform(unpacked, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def hex_parts(digest: Column, parts: int) -> list[Column]:
    """A text of hexadecimal digits as whole numbers of 16 digits each."""
    return [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(parts)]


def hex_text(parts: list[Column]) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(p), 16, "0")) for p in parts])


_RANGE_BITS = 16
_LEVELS = 3


def _following(keys: DataFrame, level: int) -> DataFrame:
    """``key`` and ``next``, the ``first`` of the next smaller key, from unique keys; null after the last.

    Keys are looked at in ranges of 2^16. After ``_LEVELS`` rounds the keys have 16 bits left.
    """
    if level == _LEVELS:
        return keys.select("key", F.lead("first").over(Window.orderBy(F.desc("key"))).alias("next"))
    part = F.shiftright("key", _RANGE_BITS)
    order = Window.partitionBy("part").orderBy(F.desc("key"))
    ranges = keys.groupBy(part.alias("key")).agg(F.max_by("first", "key").alias("first"))
    outside = _following(ranges, level + 1).select(F.col("key").alias("part"), F.col("next").alias("outside"))
    inside = keys.withColumn("part", part).withColumn("next", F.lead("first").over(order))
    return inside.join(outside, "part").select("key", F.coalesce("next", "outside").alias("next"))


def next_documents(rows: DataFrame) -> DataFrame:
    """``id``, ``hash`` and ``next``, a struct of the next document's; from distinct ids and hashes. The last meets the first."""
    one = F.struct("id", "hash")
    own = Window.partitionBy("id").orderBy(F.desc("hash"))
    # Several texts may share an id: they follow each other, then comes the next id.
    within = rows.select("id", "hash", F.lead(one).over(own).alias("next"))
    ids = rows.groupBy(F.col("id").alias("key")).agg(F.max(one).alias("first"))
    after = _following(ids, 0).select(F.col("key").alias("id"), F.col("next").alias("after"))
    first = rows.agg(F.max(one).alias("first")).first()["first"]
    around = F.struct(*[F.lit(first[c] if first else None).cast("bigint").alias(c) for c in ("id", "hash")])
    return within.join(after, "id").select("id", "hash", F.coalesce("next", "after", around).alias("next"))


_NULL_ID = -(1 << 63)


def with_edited(texts: DataFrame, order: DataFrame) -> DataFrame:
    """``id``, ``hash``, ``text`` and the ``edited`` text; ``order`` has n_chars and next by id and hash."""
    same = ["id", "hash"]
    wanted = order.select(
        F.col("next.id").alias("id"),
        F.col("next.hash").alias("hash"),
        F.col("id").alias("of_id"),
        F.col("hash").alias("of_hash"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("half"),
    )
    beginnings = texts.join(wanted, same).select(
        F.col("of_id").alias("id"), F.col("of_hash").alias("hash"), F.left("text", "half").alias("beginning")
    )
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), "beginning")
    return texts.join(beginnings, same).select(*same, "text", edited.alias("edited"))


def edited_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Per document: doc_id, n_chars, its signature, the edited text's hash and signature, and both likenesses."""
    same = ["id", "hash"]
    filled = text_or_empty(text)
    known = F.coalesce(F.col(id).cast("bigint"), F.lit(_NULL_ID))
    texts = docs.select(known.alias("id"), F.xxhash64(filled).alias("hash"), filled.alias("text"))
    keys = written(texts.select(*same, F.length("text").cast("bigint").alias("n_chars")).distinct(), "keys")
    order = written(keys.join(next_documents(keys.select(*same)), same), "order")
    both = with_edited(texts, order).withColumn("n_chars", F.length("text").cast("bigint"))
    both = both.withColumn("digest", F.sha2("edited", 256))
    digest = {f"digest{k}": part for k, part in enumerate(hex_parts(F.col("digest"), 4))}
    own = signatures(both.withColumns(digest), same, ["n_chars", *digest], samples)
    # Each signature goes to the document before, which is all that has to move.
    before = order.select(F.col("next.id").alias("id"), F.col("next.hash").alias("hash"), F.struct(*same).alias("of"))
    following = own.select(*same, F.col("signature").alias("next_signature")).join(before, same)
    joined = own.join(following.select("of.*", "next_signature"), same)
    return joined.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        hex_text([F.col(c) for c in digest]).alias("edited_sha256"),
        "signature",
        "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature"), samples).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature"), samples).alias("near_next"),
    )


def op8_fingerprints(spark, sf_dir):
    return edited_likeness(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
