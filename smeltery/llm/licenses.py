"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is any run of consecutive words as long as one and a half templates (a shorter text is one block). It meets a
template when it contains at least the threshold's share of the template's distinct words. The join is exact:
template words are put in one order over the whole corpus, rarest first by document frequency. A block that
meets the threshold must contain one of the template's rarest words (prefix filter), must be long enough
(length filter), and from the rank of that word the most it can still share is known (positional filter).
Only what passes is verified. Every block that meets the threshold is found; those of a template that share words are
given as one range. Short notices differ from one another by a word or two, so a template can name telling words, which a
block must contain besides. Templates are a parameter and small, so they travel with the tasks; texts stay where they
are read.

Defined results: a null text counts as empty: no words, no labels, score 0; every row gets its result. Only
the named columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codec import steps
from .common import documents, text_or_empty

THRESHOLD = 0.8
#: Words of a block for each word of the template.
BLOCK_FACTOR = 1.5

# Phrases that are searched word by word, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices whose words a block is compared with, and their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "released under the mit license": "mit-release",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd-conditions",
    "you may not use this file except in compliance with the license": "apache-header",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation": "gpl-header",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
    "the software and to permit persons to whom the software is furnished to do so subject to the following "
    "conditions the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software the software is provided as is without warranty of any kind express "
    "or implied including but not limited to the warranties of merchantability fitness for a particular purpose "
    "and noninfringement": "mit-text",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
    "required by applicable law or agreed to in writing software distributed under the license is distributed on "
    "an as is basis without warranties or conditions of any kind either express or implied see the license for "
    "the specific language governing permissions and limitations under the license": "apache-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution": "bsd-2-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc-text",
}

# For each of these labels the words without which a block is not that notice.
TELLING = {
    "apache-2.0": "licensed apache 2",
    "gpl-3.0": "licensed gnu general public 3",
    "mit-release": "released mit",
    "cc-by-nc-4.0": "cc by nc 4",
    "mit-grant": "granted charge person",
    "bsd-conditions": "redistribution source binary",
    "apache-header": "file except compliance license",
    "gpl-header": "free gnu general public",
    "mpl-2.0": "mozilla public 2",
    "mit-text": "granted charge sublicense noninfringement",
    "apache-notice": "apache 2 compliance",
    "bsd-2-text": "redistribution binary disclaimer",
    "isc-text": "permission fee granted",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower() if text.isascii() else text.translate(_LOWER))


class Template:
    """A template's distinct words, rarest first, and what a block must share with it."""

    def __init__(self, text: str, label: str, frequency: Mapping[str, int], threshold: float, telling: str = ""):
        words = split_words(text)
        self.label = label
        self.telling = frozenset(split_words(telling))
        if not self.telling.issubset(words):
            raise ValueError(f"the telling words of {label} must be words of the template")
        self.order = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(self.order)}
        self.block = math.ceil(BLOCK_FACTOR * len(words))
        # The smallest share that reaches the threshold, safe from rounding.
        self.least = next(k for k in range(1, len(self.order) + 1) if k / len(self.order) >= threshold)
        self.prefix = frozenset(self.order[: len(self.order) - self.least + 1])

    def _candidates(self, places: list[tuple[int, str]]) -> Iterator[int]:
        """Places of prefix words around which enough words could be shared."""
        spots = [p for p, _ in places]
        for place, word in places:
            rank = self.rank[word]
            around = places[bisect_left(spots, place - self.block + 1) : bisect_left(spots, place + self.block)]
            rarer = len({w for _, w in around if self.rank[w] < rank})
            if rarer + len(self.order) - rank >= self.least:
                yield place

    def ranges(self, words: Sequence[str]) -> list[tuple[int, int, int]]:
        """Start and end of each run of words that blocks which meet the threshold cover together, and the most one shares."""
        if len(words) < self.least:
            return []
        places = [(i, w) for i, w in enumerate(words) if w in self.prefix]
        last = max(0, len(words) - self.block)
        found: list[tuple[int, int, int]] = []
        done = 0
        for place in self._candidates(places):
            # Blocks that contain the place, but for starts looked at before.
            first = max(done, place - self.block + 1, 0)
            done = max(done, place + 1)
            inside = Counter(w for w in words[first : first + self.block - 1] if w in self.rank)
            for start in range(first, min(place, last) + 1):
                end = min(start + self.block, len(words))
                if start + self.block <= len(words) and words[end - 1] in self.rank:
                    inside[words[end - 1]] += 1
                if len(inside) >= self.least and self.telling <= inside.keys():
                    if found and start < found[-1][1]:
                        found[-1] = found[-1][0], end, max(found[-1][2], len(inside))
                    else:
                        found.append((start, end, len(inside)))
                gone = words[start]
                if gone in inside:
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
        return found


def template_frequencies(docs: DataFrame, text: str, vocabulary: frozenset[str]) -> dict[str, int]:
    """In how many rows each template word is: counted by the tasks, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in steps(batches):
            for one in batch.column("_text").to_pylist():
                found.update(vocabulary.intersection(split_words(one)))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())}
        )

    partial = docs.select(text_or_empty(text).alias("_text")).mapInArrow(run, "word string, n long")
    return {r["word"]: r["n"] for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def phrase_starts(words: Sequence[str], phrases: Mapping[str, str] = PHRASES) -> list[tuple[int, str]]:
    """Word number and label of every place of a phrase."""
    found = []
    joined = f" {' '.join(words)} "
    for phrase, label in phrases.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            found.append((joined.count(" ", 0, at), label))
            at = joined.find(f" {phrase} ", at + 1)
    return found


SCANNED = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "blocks array<struct<label:string,start:int,end:int,containment:double>>"
)


def license_scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    telling: Mapping[str, str] = TELLING,
) -> DataFrame:
    """Per row: places of phrases, and for each template all blocks that meet the threshold.

    Blocks that share words are one range, with the best containment of any of them. ``telling`` gives by label the
    words a block must contain besides; a label without an entry needs none.
    """
    vocabulary = frozenset(w for t in templates for w in split_words(t))
    frequency = template_frequencies(docs, text, vocabulary)
    made = [Template(t, label, frequency, threshold, telling.get(label, "")) for t, label in templates.items()]
    taken = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("_text"))
    block_type = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())])
    )

    def scan(one: str) -> tuple:
        words = split_words(one)
        starts = phrase_starts(words)
        present = set(words)
        blocks = []
        for t in made:
            if t.telling <= present and not present.isdisjoint(t.prefix):
                for begin, end, shared in t.ranges(words):
                    blocks.append({"label": t.label, "start": begin, "end": end, "containment": shared / len(t.order)})
        places = [p for p, _ in starts]
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            sorted({label for _, label in starts}),
            blocks,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.list_(pa.string()), block_type]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"]
        for batch in steps(batches):
            if batch.num_rows:
                columns = zip(*map(scan, batch.column("_text").to_pylist()))
                arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return taken.mapInArrow(run, SCANNED.format(id=taken.schema["doc_id"].dataType.simpleString()))


def op9_license_scan(spark, sf_dir):
    scanned = license_scan(documents(spark, sf_dir))
    labels = F.array_union("base_labels", F.transform("blocks", lambda b: b["label"]))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0)).alias("score"),
    )


def _rows(values: Mapping[str, str]) -> str:
    return ", ".join(f"('{text}', '{label}')" for text, label in values.items())


def _template_rows() -> str:
    return ", ".join(f"('{text}', '{label}', '{TELLING[label]}')" for text, label in TEMPLATES.items())


OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d),
phrases AS (SELECT string_split(phrase, ' ') AS ph, label FROM (VALUES {_rows(PHRASES)}) AS t(phrase, label)),
base AS (
  SELECT w.doc_id, w.p, label FROM w JOIN phrases ON w.w = ph[1] JOIN d USING (doc_id)
  WHERE d.ws[w.p + 1 : w.p + len(ph)] = ph),
based AS (
  SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
templates AS (
  SELECT label, list_distinct(string_split(t, ' ')) AS ts, string_split(telling, ' ') AS must,
    ceil({BLOCK_FACTOR} * len(string_split(t, ' '))) AS block
  FROM (VALUES {_template_rows()}) AS t(t, label, telling)),
hits AS (
  SELECT w.doc_id, w.w, w.p, label, block, size, n_must, list_contains(must, t) AS tells
  FROM w JOIN (
    SELECT label, block, len(ts) AS size, must, len(must) AS n_must, unnest(ts) AS t FROM templates) ON w.w = t),
blocks AS (
  SELECT a.doc_id, a.label, a.p,
    CASE WHEN count(DISTINCT b.w) FILTER (b.tells) = any_value(a.n_must)
      THEN count(DISTINCT b.w) / any_value(a.size) END AS containment
  FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND a.label = b.label AND b.p >= a.p AND b.p < a.p + a.block
  GROUP BY a.doc_id, a.label, a.p),
met AS (SELECT doc_id, label, max(containment) AS c FROM blocks WHERE containment >= {THRESHOLD} GROUP BY ALL),
scored AS (SELECT doc_id, max(c) AS score FROM met GROUP BY doc_id),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM met UNION ALL SELECT doc_id, label FROM base) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id) LEFT JOIN scored USING (doc_id)
"""
