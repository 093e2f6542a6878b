"""Each stage of the pipeline against a plain version on its own input; awkward rows and no rows at all."""

from __future__ import annotations

import hashlib
import importlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from corpus_cases import (
    LOWER,
    PERSONAL,
    WORD,
    awkward_rows,
    components,
    covered_bytes,
    fingerprint,
    is_personal,
    personal_spans,
    table,
)
from pyspark.sql import functions as F
from test_corpus_operators import check_packing

import __spark_entry__ as entry
import corpus_pipeline
from smeltery.llm import quality_rules
from smeltery.llm.common import documents, written
from smeltery.llm.quality_rules import MIN_DOCUMENTS, ROOT_FACTOR

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    """The input of the first stage, and what each stage gives, written and read again."""
    frames = [documents(spark, SF_DIR)]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF_DIR), "stage"))
    return frames


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def normal(line):
    folded = " ".join(WORD.findall(line)).translate(LOWER)
    return "".join("0" if c in "123456789" else c for c in folded)


def quality(docs):
    """Texts of documents that stay, by id."""
    hosts = Counter(host for host, _ in {(d["source"], d["text"]) for d in docs.values()})
    having, first = defaultdict(set), {}
    for i, d in docs.items():
        for line in d["text"].split("\n"):
            if WORD.search(line):
                key = d["source"], normal(line)
                having[key].add(d["text"])
                first[key] = min(first.get(key, i), i)
    out = {}
    for i, d in docs.items():
        words = WORD.findall(d["text"])
        windows = Counter(zip(words, words[1:], words[2:]))
        repeated = {k + n for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for n in range(3)}
        stay, gone = [], 0
        for line in d["text"].split("\n"):
            key = d["source"], normal(line)
            n_words = max(1, len(WORD.findall(line)))
            above = len(having.get(key, ())) > max(MIN_DOCUMENTS, ROOT_FACTOR * hosts[d["source"]] ** 0.5 / n_words)
            if above and first[key] != i:
                gone += len(WORD.findall(line))
            else:
                stay.append(line)
        if len(words) >= 50 and 2 * len(repeated) <= len(words) and 2 * gone <= len(words):
            out[i] = "\n".join(stay)
    return out


def entity(kind, value):
    return kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)


LETTERS = regex.compile(r"\p{L}+")


def disclosing(docs):
    """Pairs of an entity and a term that tells it, from texts by id."""
    near, having = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for i, text in docs.items():
        for kind, pattern in PERSONAL.items():
            matches = list(re.finditer(pattern, text))
            ends = [0, *(m.end() for m in matches)]
            starts = [*(m.start() for m in matches), len(text)]
            for k, m in enumerate(matches):
                if is_personal(kind, m.group()):
                    before, after = text[ends[k] : m.start()], text[m.end() : starts[k + 1]]
                    line = before.split("\n")[-1] + m.group() + after.split("\n")[0]
                    around = " ".join(WORD.findall(before)[-10:] + WORD.findall(after)[:10])
                    having[entity(kind, m.group())].add(i)
                    for term in {t.translate(LOWER) for t in LETTERS.findall(around)}:
                        near[entity(kind, m.group()), term][i].add(hashlib.md5(line.encode()).hexdigest())
    frequency = Counter(t for text in docs.values() for t in {t.translate(LOWER) for t in LETTERS.findall(text)})
    found = set()
    for (one, term), lines in near.items():
        different = len({min(of_doc) for of_doc in lines.values()})
        believed = different / (different + 3)
        told = math.log2(believed * len(lines) * len(docs) / (frequency[term] * len(having[one])))
        if told >= 0.8 * math.log2(len(docs) / len(having[one])):
            found.add((one, term))
    return found


def sanitised(docs):
    """Texts by id with the union of their spans under the name of the one that starts first, of those the longest."""
    telling = defaultdict(set)
    for one, term in disclosing(docs):
        telling[one].add(term)
    out = {}
    for i, text in docs.items():
        base = personal_spans(text)
        told = set().union(*(telling[entity(k, text[a:b])] for k, a, b in base))
        terms = [
            ("term", m.start(), m.end())
            for m in LETTERS.finditer(text)
            if m.group().translate(LOWER) in told and not any(a < m.end() and m.start() < b for _, a, b in base)
        ]
        parts, at = [], 0
        for start, _, end, kind in sorted((a, -b, b, k) for k, a, b in base + terms):
            if start >= at:
                parts += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        out[i] = "".join([*parts, text[at:]])
    return out


def test_stages_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "simhash near-dedup",
        "suffix-array dedup",
        "personal data",
        "best-fit packing",
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_quality_stage(frames):
    want = quality(rows(frames[0]))
    assert {i: r["text"] for i, r in rows(frames[1]).items()} == want


def test_frequent_lines_go_from_a_host_with_a_third_of_all_rows(spark):
    def body(i):
        return " ".join(f"word{'abcdefghij'[i % 10]}{'x' * (i // 10 % 30)}{'y' * (i // 300)}{'z' * k}" for k in range(55))

    def host(i):
        return "hot" if i % 3 == 0 else f"small{i % 40}"

    # Of the hot host, one document in fifty shows a sentence, and one in fifty a single word.
    given = [
        (i, body(i) if i % 150 else f"Share This Page\n{body(i)}" if i % 300 else f"Next\n{body(i)}", host(i))
        for i in range(1, 3700)
    ]
    out = rows(corpus_pipeline.quality(spark, table(spark, given), SF_DIR))
    having = [i for i, text, _ in given if "Share" in text]
    short = [i for i, text, _ in given if "Next" in text]
    hot = [i for i, _, h in given if h == "hot"]
    assert {*having, *short} <= set(hot) and min(len(having), len(short)) > 10
    assert 3 * len(having) > 0.5 * len(hot) ** 0.5 > len(short)
    assert [i for i in having if "Share" in out[i]["text"]] == having[:1]
    assert all(out[i]["text"] == body(i) for i in having[1:])
    assert all(out[i]["text"] == f"Next\n{body(i)}" for i in short)  # a word recurs by chance on a large host


def test_one_large_host_loses_what_small_hosts_lose(spark):
    """The limits grow with a host by its root only: sentences frequent on a small host are so on all hosts put together."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    each = [quality_rules.text_statistics(d) for d in (docs, docs.withColumn("source", F.lit("one")))]
    small, large = ({r["line"] for r in quality_rules.frequent_lines(s).collect()} for s in each)
    assert small and small <= large


def test_near_duplicate_stage(frames):
    before, after = rows(frames[1]), rows(frames[2])
    reached = components({i: fingerprint(r["text"]) for i, r in before.items()})
    assert after == {i: r for i, r in before.items() if reached[i] == i}


def test_repeats_stage(frames):
    before = [(i, r["text"]) for i, r in rows(frames[2]).items()]
    after = rows(frames[3])
    for (i, text), mask in zip(before, covered_bytes(before)):
        left = np.frombuffer(text.encode(), dtype=np.uint8)[~mask].tobytes().decode("utf-8", "ignore")
        assert (after[i]["text"], after[i]["n_chars"]) == (left, len(left))


def test_personal_data_stage(frames):
    want = sanitised({i: r["text"] for i, r in rows(frames[3]).items()})
    assert {i: r["text"] for i, r in rows(frames[4]).items()} == want


def test_personal_data_stage_where_terms_are_removed(spark):
    """Entities of all frequencies among words of all frequencies; spans that overlap; copies of a line."""
    draw = random.Random(21)
    fill = [f"word{'abcdefghij'[k % 10]}{'x' * (k // 10)}" for k in range(60)]
    names = [f"name{'qrstuvwxyz'[k % 10]}{'y' * (k // 10)}" for k in range(25)]
    values = [f"{n}@mail.example.com" for n in names[:10]] + [f"10.1.{k}.7" for k in range(8)]
    values += ["+1 (212) 555-0188", "4111 1111 1111 1111", "4111 1111 1111 1111@x.org", "10.0.0.0 4111 1111 1111 1111"]
    given = {}
    for i in range(900):
        words = draw.choices(fill, k=draw.randint(3, 40))
        if i % 6 == 0:
            k = min(int(draw.expovariate(0.25)), len(values) - 1)
            words.insert(draw.randint(0, len(words)), f"{names[k]} {values[k]}" if draw.random() < 0.7 else values[k])
        given[i] = "".join(w + draw.choice("  \n") for w in words)
    for i in range(900, 905):
        given[i] = "copied quagmire +1 (212) 555-0199 line"
    out = rows(corpus_pipeline.personal_data(spark, table(spark, [(i, t, "a") for i, t in given.items()]), SF_DIR))
    want = sanitised(given)
    assert {i: r["text"] for i, r in out.items()} == want
    assert sum(t.count("[TERM]") for t in want.values()) > 20
    assert len(disclosing(given)) < 60


def test_packing_stage(frames):
    texts = {i: r["text"] for i, r in rows(frames[4]).items()}
    check_packing(frames[5].collect(), texts)


def test_columns_go_through(frames):
    assert all(f.columns == frames[0].columns for f in frames[1:5])


def test_run_gives_what_the_stages_give(spark, frames):
    one, other = (
        sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in f.collect())
        for f in (corpus_pipeline.run(spark, SF_DIR), frames[5])
    )
    assert one == other


@pytest.mark.parametrize("given", [awkward_rows(), []])
def test_stages_on_awkward_rows(spark, given):
    docs = table(spark, given)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), "stage")
        assert name == "best-fit packing" or docs.columns == columns
    assert bool(docs.count()) == bool(given)


def test_the_rest_imports_without_the_corpus_part(monkeypatch):
    """As after deleting the subpackage; the entry module is loaded anew and put back."""
    real = importlib.import_module

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.split(".")[:2] == ["smeltery", "llm"] or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name="corpus_pipeline")

    import sys

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    for name in [n for n in sys.modules if n.startswith("smeltery.llm") or n in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    fresh = real("__spark_entry__")
    assert "daily_revenue" in fresh.queries() and not any(n.startswith("op1") for n in fresh.queries())
    assert set(fresh.oracle_sql()) <= set(fresh.queries())
