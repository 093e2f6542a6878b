"""Quality rules from repeated words within a document and repeated lines across documents.

Built on DataFrame functions alone.

A line's identity is its host and a 64-bit hash of its normal form: ASCII lower case, digits as ``0``,
runs of blanks as one space. Lines without a word are never counted and never removed. A line is above its limit
when more than ``MIN_DOCUMENTS`` documents of the host have it and, times its words, they are more than
``ROOT_FACTOR`` times the square root of the host's documents: what is said in a word or two recurs by chance on a
large host, a sentence does not. It is one rule for hosts of any size. Such a line is removed from every document but
the first (smallest id) that has it, so that one of many near copies stays whole. A document is depleted, hence
rejected, when more than the allowed share of its words stood on removed lines.

Texts are split and hashed in one pass; what follows reads a table of numbers: statistics, and for each line its hash and
words.

Defined results: a null text counts as empty (no words, so it fails the base rules); a null host is the host
``""``; equal texts of one host count as one document, so copies do not make their own lines frequent; rows that
agree in id and text get equal results. Other columns are not touched, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, documents, let, split_words, text_or_empty, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
#: A line is above its limit in more documents than this, and than this factor times the root of the host's over its words.
MIN_DOCUMENTS = 10
ROOT_FACTOR = 0.5
#: The largest share of words that may stand on removed lines.
MAX_REMOVED_PERCENT = 50


_FOLDED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"


def normal_lines(text: Column) -> Column:
    """Each line's hash and number of words, null for a line without a word; the text is folded as a whole."""
    folded = F.translate(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "), *_FOLDED)

    def hashed(line: Column) -> Column:
        # The normal form has one space between two words.
        words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        return F.when(line != "", F.struct(F.xxhash64(line).alias("line"), words.alias("words")))

    return F.transform(F.split(folded, "\n"), lambda line: let(F.trim(line), hashed))


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that the array holds more than once."""

    def window_hashes(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - width)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def repeated_starts(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(rows: Column) -> Column:
            same = F.filter(
                rows,
                lambda x, k: (x["h"] == F.get(rows, k - 1)["h"]) | (x["h"] == F.get(rows, k + 1)["h"]),
            )
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        return let(placed, marked)

    def covered(starts: Column) -> Column:
        def add(done: Column, start: Column) -> Column:
            new = F.least(F.lit(width), start + F.lit(width) - done["end"])
            return F.struct((done["n"] + new).alias("n"), (start + F.lit(width)).alias("end"))

        begin = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("end"))
        return F.aggregate(starts, begin, add, lambda done: done["n"])

    def counted(hashes: Column) -> Column:
        # Most documents repeat no window; a set of the hashes tells, and saves them the sort of pairs.
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, covered(repeated_starts(hashes))).otherwise(F.lit(0))

    total = let(hashed, lambda ws: let(window_hashes(ws), counted))
    return F.when(F.size(words) >= width, total).otherwise(F.lit(0)).cast("bigint")


def text_statistics(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``id``, ``host``, ``text_hash``, counts per row, whether the base rules reject it, and its ``lines``."""
    parts = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        text_or_empty(text).alias("text"),
    ).select(
        "*",
        split_words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), _has_word).alias("own_lines"),
    )
    counts = parts.select(
        "id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("own_lines") - F.size(F.array_distinct("own_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        normal_lines(F.col("text")).alias("lines"),
    )
    too_short = F.col("n_words") < MIN_WORDS
    repetitive = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return counts.withColumn("base_failed", too_short | repetitive)


def frequent_lines(
    statistics: DataFrame, min_documents: int = MIN_DOCUMENTS, root_factor: float = ROOT_FACTOR
) -> DataFrame:
    """Lines above their limits: host, line hash, the first document that has the line."""
    own = F.array_distinct(F.filter("lines", lambda x: x.isNotNull()))
    lines = statistics.select("id", "host", "text_hash", F.explode(own).alias("l")).select("id", "host", "text_hash", "l.*")
    counts = (
        lines.groupBy("host", "line", "words", "text_hash")  # copies are one document
        .agg(F.min("id").alias("first_id"))
        .groupBy("host", "line", "words")
        .agg(F.count(F.lit(1)).alias("documents"), F.min("first_id").alias("first_id"))
        .where(F.col("documents") > min_documents)
    )
    distinct = statistics.select("host", "text_hash").distinct()
    sizes = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    above = F.col("documents") * F.col("words") > root_factor * F.sqrt(F.col("host_documents"))
    return counts.join(sizes, "host").where(above).select("host", "line", "words", "first_id")


def lines_to_remove(statistics: DataFrame, **limits) -> DataFrame:
    """Per row (``_id`` and ``_hash`` of the text): the positions of its lines above the limits, and the words on them."""
    lines = statistics.select("id", "host", "text_hash", F.posexplode("lines").alias("pos", "l")).where("l IS NOT NULL")
    return (
        lines.select("id", "host", "text_hash", "pos", "l.*")
        .join(frequent_lines(statistics, **limits), ["host", "line", "words"])
        .where(~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "pos")  # equal rows count once
        .agg(F.first("words").alias("words"))
        .groupBy("_id", "_hash")
        .agg(F.collect_list("pos").alias("removed_lines"), F.sum("words").alias("n_removed_words"))
    )


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", **limits
) -> DataFrame:
    """The statistics of each row, its lines above the limits, and the verdict ``kept``."""
    base = written(text_statistics(docs, id, text, host), "statistics")
    removed = lines_to_remove(base, **limits)
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    depleted = 100 * F.col("n_removed_words") > MAX_REMOVED_PERCENT * F.col("n_words")
    counts = ["text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return base.join(removed, same, "left").select(
        F.col("id").alias(id),
        *[base[c] for c in counts],
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        F.coalesce("n_removed_words", F.lit(0)).cast("bigint").alias("n_removed_words"),
        (~F.col("base_failed") & ~F.coalesce(depleted, F.lit(False))).alias("kept"),
    )


def apply_quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", **limits
) -> DataFrame:
    """The rows the rules keep, without their removed lines; all columns as they came.

    ``n_chars``, where the table has it, follows the text.
    """
    verdicts = (
        quality_rules(docs, id, text, host, **limits)
        .where("kept")
        .select(F.col(id).alias("_id"), F.col("text_hash").alias("_hash"), "removed_lines")
        .distinct()
    )
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(id).alias("_doc"), F.xxhash64(text_or_empty(text)).alias("_text_hash")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    kept = rows.join(verdicts, same).select("_row", "removed_lines")

    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed_lines"))
        return F.array_join(F.transform(places, lambda p: F.get(lines, p)), "\n")

    whole = F.col("_row")[text]
    cleaned = F.when(F.size("removed_lines") == 0, whole).otherwise(let(F.split(whole, "\n"), without))
    out = kept.select("_row", cleaned.alias("_text"))
    new = {text: F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text_or_empty("_text")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op6_quality_rules(spark, sf_dir):
    report = quality_rules(documents(spark, sf_dir))
    return report.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.size("removed_lines").cast("bigint").alias("n_removed_lines"),
        "n_removed_words",
        "kept",
    )


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, text FROM d),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE n > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, host, md5, line, pos,
    translate(regexp_replace(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      '[\x20\x09-\x0D]+', ' ', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS norm
  FROM (
    SELECT doc_id, host, md5, unnest(ls) AS line, unnest(range(len(ls))) AS pos
    FROM (SELECT doc_id, host, md5(text) AS md5, string_split(text, chr(10)) AS ls FROM d))
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
sizes AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
frequent AS (
  SELECT host, norm, length(norm) - length(replace(norm, ' ', '')) + 1 AS words, count(DISTINCT md5) AS n,
    min(doc_id) AS first_id FROM l GROUP BY host, norm
  HAVING count(DISTINCT md5) > 10),
gone AS (
  SELECT l.doc_id, count(*) AS n_lines, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS n_words
  FROM l JOIN frequent USING (host, norm) JOIN sizes USING (host)
  WHERE frequent.n * frequent.words > 0.5 * sqrt(sizes.n) AND l.doc_id <> first_id GROUP BY l.doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT j.*, coalesce(g.n_lines, 0)::BIGINT AS n_removed_lines, coalesce(g.n_words, 0)::BIGINT AS n_removed_words,
  NOT base_failed AND NOT 100 * coalesce(g.n_words, 0) > 50 * j.n_words AS kept
FROM judged j LEFT JOIN gone g USING (doc_id)
"""
