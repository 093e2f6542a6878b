"""Tables with awkward rows, and plain versions of the operators to compare with."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = (
    "The quick brown fox jumps over the lazy dog while seven wizards box quietly near an old stone bridge "
    "and count the boats that pass below it every morning before the market opens its gates to the public."
)

#: Columns that carry names the operators use inside.
EXTRA = ["id", "hash", "text_hash", "words", "lines", "bits", "node", "kept", "chunk", "ids", "spans", "piece", "row"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in EXTRA
)


def table(spark, rows):
    """Rows of (doc_id, text, source), with the other columns of documents and clashing ones."""
    full = [(i, t, "en", s, None if t is None else len(t), *[f"own {n}" for n in EXTRA]) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward_rows():
    long = " ".join(f"w{k % 4999}x{k % 89}" for k in range(60_000))
    return [
        (1, PROSE, "a"),
        (2, PROSE, "a"),
        (3, PROSE + " One more sentence follows here.", "b"),
        (4, None, "a"),
        (5, "", None),
        (6, " \t\n ", "a"),
        (7, long, "a"),
        (8, long, None),
        (9, "x" * 40_000, "a"),
        (10, "Mail jo.doe@mail.example.com or call +1 (212) 555-0188, 10.0.0.1 and 4111 1111 1111 1111.", "b"),
        (11, "Ünïcödé 日本語 🙂 <|endoftext|> don't\r\nMIT License <|startoftext|>", "b"),
        (12, PROSE, "a"),
        (12, PROSE, "a"),
        (13, "same id, first text", "a"),
        (13, "same id, second text", "a"),
        (None, PROSE, "a"),
        (None, None, None),
        (-5, "a negative id", "a"),
        (14, " " * 3000 + "\n" * 50, "a"),
    ]


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """Smallest id reachable, from fingerprints by id."""
    ids = sorted(prints)
    bits = np.array([prints[i] for i in ids], dtype=np.uint64)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(bits[k + 1 :] ^ bits[k]) <= distance):
            a, b = find(i), find(ids[k + 1 + j])
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def covered_bytes(rows, window=50):
    """For rows of (id, text): a mask of the bytes to remove. A null id is larger than all others."""
    top = 1 << 62
    first: dict[bytes, int] = {}
    data = [((top if i is None else i), (t or "").encode()) for i, t in rows]
    for i, text in data:
        for k in range(len(text) - window + 1):
            one = text[k : k + window]
            first[one] = min(first.get(one, top), i)
    out = []
    for i, text in data:
        mask = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - window + 1):
            if first[text[k : k + window]] < i:
                mask[k : k + window] = True
        out.append(mask)
    return out


def spans(mask):
    return int(np.count_nonzero(np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1))


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_personal(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def personal_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PERSONAL.items()
        for m in re.finditer(pattern, text or "")
        if is_personal(kind, m.group())
    ]


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def by_id(rows):
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(r)
    return found
