"""Byte-pair encoding by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the reversed tokens runs from the end of a pre-token to its start, and its state tells the
longest token that starts at each byte. The encoder places
longest tokens from left to right; a token may follow another only if merging would never join across their border.
Where it may not, the next shorter token that is a prefix is tried, then the token before is taken back. A
position that was taken back once is never entered again, so the work is linear. The one sequence whose
neighbours are all compatible is the sequence that merging by rank gives.

Distinct pre-tokens of a batch are encoded side by side in numpy; a worker remembers what it encoded, up to a bound.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
import regex

#: Stands for the end of a word in vocabularies that mark it; no byte does.
WORD_END = chr(256)
NEVER = np.int64(1 << 40)
#: Pieces of text a worker remembers before it starts over.
REMEMBERED = 500_000
_SLOTS = 1 << 18
#: Begins the key of a text's first chunk. No text holds half a surrogate pair.
_FIRST = "\ud800"
#: A word and one of these are two pre-tokens.
_MARKS = ",.;:!?"
_BLANKS = regex.compile(r"\p{White_Space}+")
#: str.split() takes these for blanks, the libraries do not.
_NOT_BLANK = "\x1c\x1d\x1e\x1f"
#: Where none of these is, each inner space has a non-blank on either side.
_RARE_BLANKS = [
    "  ", " \n", "\n ", *"\t\v\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))
]

# The splitting patterns of the two vocabularies.
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    spare = 0x100
    for b in range(0x100):
        if b not in plain:
            letters[chr(spare)] = b
            spare += 1
    return letters


def _reversed_automaton(spellings: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The column of each symbol, next state by state and column, and the longest token that ends what a state has read.

    Symbols that only stand alone as tokens go back to the start, in one column; their tokens are put in by the caller.
    """
    used = sorted({ord(c) for s in spellings if len(s) > 1 for c in s})
    column = np.zeros(ord(WORD_END) + 1, dtype=np.int64)
    column[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    children: dict[int, int] = {}
    parent, symbol, depth, token = [0], [0], [0], [-1]
    for number, spelling in enumerate(spellings):
        node = 0
        columns = column[[ord(c) for c in reversed(spelling)]].tolist()
        if columns == [0]:
            continue
        for c in columns:
            key = node * width + c
            if key not in children:
                children[key] = len(parent)
                parent.append(node)
                symbol.append(c)
                depth.append(depth[node] + 1)
                token.append(-1)
            node = children[key]
        token[node] = number
    parents, symbols, depths, tokens = map(np.array, (parent, symbol, depth, token))
    step = np.zeros((len(parents), width), dtype=np.int32)
    fall = np.zeros(len(parents), dtype=np.int64)
    levels = [np.flatnonzero(depths == d) for d in range(depths.max() + 1)]
    for d, nodes in enumerate(levels):
        if d > 1:
            fall[nodes] = step[fall[parents[nodes]], symbols[nodes]]
        step[nodes] = step[fall[nodes]]
        tokens[nodes] = np.where(tokens[nodes] < 0, tokens[fall[nodes]], tokens[nodes])
        if d + 1 < len(levels):
            below = levels[d + 1]
            step[parents[below], symbols[below]] = below
    return column, step, tokens


def stored_vocabulary(path: str) -> tuple[dict, dict[str, int]]:
    """The model as its file has it, and the ids of special strings."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    return stored["model"], {t["content"]: t["id"] for t in stored["added_tokens"]}


def token_bytes(path: str) -> dict[bytes, int]:
    """The ids of a byte-level vocabulary by the bytes they stand for, without special strings."""
    model, _ = stored_vocabulary(path)
    letters = byte_letters()
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}


class Vocabulary:
    """Tokens and merges of a vocabulary file, numbered by the age of their merge."""

    def __init__(self, path: str):
        model, self.specials = stored_vocabulary(path)
        letters = byte_letters()
        suffix = model.get("end_of_word_suffix") or ""
        self.marks_word_ends = bool(suffix)
        ids: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        joined = [a[: len(a) - len(suffix)] + b if suffix and a.endswith(suffix) else a + b for a, b in merges]
        made = set(joined)
        names = [*(t for t in sorted(ids, key=ids.get) if t not in made), *joined]
        number = {name: i for i, name in enumerate(names)}
        n = len(names)

        def spelled(token: str) -> str:
            end = suffix and token.endswith(suffix)
            body = token[: len(token) - len(suffix)] if end else token
            return "".join(chr(letters[c]) for c in body) + (WORD_END if end else "")

        self.spellings = [spelled(name) for name in names]
        self.ids = np.array([ids[name] for name in names], dtype=np.uint32)
        self.lengths = np.array([len(s) for s in self.spellings], dtype=np.int64)
        self.n_base = n - len(merges)
        self.left = np.arange(n)
        self.right = np.arange(n)
        self.left[self.n_base :] = [number[a] for a, _ in merges]
        self.right[self.n_base :] = [number[b] for _, b in merges]

        by_pair = (self.left[self.n_base :] << 20) | self.right[self.n_base :]
        order = np.argsort(by_pair)
        self._pairs, self._merged = by_pair[order], order + self.n_base
        self._column, self._step, self._longest = _reversed_automaton(self.spellings)
        self._alone = np.full(ord(WORD_END) + 1, -1)  # the token of a symbol by itself
        for i, spelling in enumerate(self.spellings):
            if len(spelling) == 1:
                self._alone[ord(spelling)] = i
        of = {spelling: i for i, spelling in enumerate(self.spellings)}
        self.shorter = np.array(
            [next((of[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in of), -1) for s in self.spellings]
        )
        self._seen_pairs = np.full(_SLOTS, -1, dtype=np.int64)
        self._seen_fit = np.zeros(_SLOTS, dtype=bool)

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._merged[at], NEVER)

    def _fit_by_unmerging(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Undo merges at the border, youngest first; an older merge across it means the pair cannot stand."""
        fit = np.ones(len(left), dtype=bool)
        live = np.arange(len(left))
        limit = np.full(len(left), NEVER)
        while len(live):
            crossing = self._joins(left, right) < limit
            fit[live[crossing]] = False
            go_on = ~crossing & (np.maximum(left, right) >= self.n_base)
            live, left, right = live[go_on], left[go_on], right[go_on]
            from_left = left > right
            limit = np.where(from_left, left, right + 1)
            left, right = np.where(from_left, self.right[left], left), np.where(from_left, right, self.left[right])
        return fit

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each token may follow the one before it, from a table of pairs looked at before."""
        key = (left << 20) | right
        slot = (key * np.int64(0x9E3779B1) >> 13) & (_SLOTS - 1)
        known = self._seen_pairs[slot] == key
        fit = self._seen_fit[slot]
        if not known.all():
            new = ~known
            fit[new] = self._fit_by_unmerging(left[new], right[new])
            # Pairs that share a slot write key and answer in the same order, so the last one's stay together.
            self._seen_pairs[slot[new]] = key[new]
            self._seen_fit[slot[new]] = fit[new]
        return fit

    def _longest_tokens(self, flat: np.ndarray, stops: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The longest token that starts at each place, found for all pre-tokens side by side."""
        longest = np.full(len(flat), -1, dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        place = stops[order]
        ascending = sizes[order][::-1]
        state = np.zeros(len(order), dtype=np.int64)
        for read in range(int(sizes.max(initial=0))):
            n = len(order) - int(np.searchsorted(ascending, read, side="right"))  # those with symbols left
            state, place = state[:n], place[:n] - 1
            read_now = flat[place]
            state = self._step[state, self._column[read_now]]
            found = self._longest[state]
            longest[place] = np.where(found < 0, self._alone[read_now], found)
        return longest

    def encode_pieces(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each pre-token, one after the other, and how many each has."""
        spelled = [p.encode() for p in pieces]
        sizes = np.array([len(s) for s in spelled], dtype=np.int64)
        if not len(sizes):
            return sizes, sizes
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        flat = np.frombuffer(b"\0".join(spelled) + b"\0", dtype=np.uint8).astype(np.int16)
        if self.marks_word_ends:
            flat[ends - 1] = ord(WORD_END)
            sizes = sizes + 1
        stops = starts + sizes
        longest = self._longest_tokens(flat, stops, sizes)

        placed = np.full(len(flat), -1, dtype=np.int64)  # the token that starts here
        before = np.full(len(flat) + 1, -1, dtype=np.int64)  # where the token before starts
        dead = np.zeros(len(flat) + 1, dtype=bool)
        at, stop = starts.copy(), stops
        token = longest[at]
        live = np.flatnonzero(sizes > 0)
        at, stop, token = at[live], stop[live], token[live]
        while len(at):
            tried = token >= 0
            previous = before[at]
            ok = tried & ~dead[at + np.where(tried, self.lengths[token], 0)]
            check = np.flatnonzero(ok & (previous >= 0))
            ok[check] = self.fits(placed[previous[check]], token[check])
            # Place what fits and step on; shorten what does not; where nothing is left, take one back.
            good = np.flatnonzero(ok)
            here = at[good]
            placed[here] = token[good]
            after = here + self.lengths[token[good]]
            before[after] = here
            back = np.flatnonzero(~tried)
            dead[at[back]] = True
            shorter = np.flatnonzero(tried & ~ok)
            token[shorter] = self.shorter[token[shorter]]
            undone = previous[back]
            token[back] = self.shorter[placed[undone]]
            placed[undone] = -1
            at[back] = undone
            at[good] = after
            unfinished = at < stop
            token[good] = np.where(unfinished[good], longest[np.minimum(after, len(flat) - 1)], -1)
            if not unfinished.all():
                at, stop, token = at[unfinished], stop[unfinished], token[unfinished]
        taken = placed >= 0
        return placed[taken], np.where(sizes > 0, np.add.reduceat(taken, starts, dtype=np.int64), 0)


class Encoder:
    """Encodes texts as the vocabulary's own library does; remembers pieces between batches."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(path)
        self.remembered = remembered
        self._byte_level = not self.vocabulary.marks_word_ends
        self._special = regex.compile("|".join(map(regex.escape, self.vocabulary.specials)) or r"(?!)")
        self._pattern = regex.compile(BYTE_PATTERN if self._byte_level else WORD_PATTERN)
        self._inner_space = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self._known: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """Parts that no pre-token reaches across; the byte-level ones but the first lack the space before them."""
        if not self._byte_level:
            return _BLANKS.split(text) if any(c in text for c in _NOT_BLANK) else text.split()
        plain = not any(c in text for c in _RARE_BLANKS) and text[0] != " " and text[-1] != " "
        return text.split(" ") if plain else self._inner_space.split(text)

    def pre_tokens(self, chunk: str) -> list[str]:
        """Pre-tokens and special strings, in order."""
        if self._byte_level and chunk:
            chunk = chunk[1:] if chunk[0] == _FIRST else " " + chunk
        found, at = [], 0
        for match in self._special.finditer(chunk) if "<" in chunk else ():
            found += [*self._plain(chunk[at : match.start()]), match.group()]
            at = match.end()
        return found + self._plain(chunk[at:])

    def _plain(self, part: str) -> list[str]:
        if not self._byte_level:
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
        return self._pattern.findall(part)

    def split_chunks(self, chunks: Iterable[str]) -> list[list[str]]:
        """Pre-tokens of each chunk. Most chunks are a word, or a word and a mark, and need no pattern."""
        out = []
        for c in chunks:
            if self._byte_level or c.isascii():
                if c.isalpha():
                    out.append([" " + c if self._byte_level else c.lower()])
                    continue
                if c and c[-1] in _MARKS and c[:-1].isalpha():
                    out.append([" " + c[:-1] if self._byte_level else c[:-1].lower(), c[-1]])
                    continue
            out.append(self.pre_tokens(c))
        return out

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not remembered; if too many are, forget those not asked for now."""
        known = self._known
        new = chunks.difference(known)
        if len(known) + len(new) > self.remembered:
            known = self._known = {c: known[c] for c in chunks if c in known}
        split = self.split_chunks(new)
        specials = self.vocabulary.specials
        pieces = list(set(chain.from_iterable(split)).difference(specials))
        tokens, counts = self.vocabulary.encode_pieces(pieces)
        raw = self.vocabulary.ids[tokens].astype("<u4").tobytes()
        stops = np.cumsum(counts * 4)
        spans = map(slice, (stops - counts * 4).tolist(), stops.tolist())
        of = dict(zip(pieces, map(raw.__getitem__, spans)))
        of |= {name: number.to_bytes(4, "little") for name, number in specials.items()}
        for chunk, parts in zip(new, split):
            known[chunk] = of[parts[0]] if len(parts) == 1 else b"".join([of[p] for p in parts])

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, four bytes each, little-endian."""
        split = [self.chunks(t) if t else [""] for t in texts]
        if self._byte_level:  # a first part gets a key of its own: it has no space before it
            split = [[_FIRST + parts[0], *parts[1:]] for parts in split]
        self.learn(set().union(*split))
        known = self._known
        return [b"".join([known[c] for c in parts]) for parts in split]


class OffsetTable:
    """The bytes that stand for each number, in one array."""

    def __init__(self, parts: Sequence[bytes]):
        self._bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self._sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self._offsets = np.cumsum(self._sizes) - self._sizes

    def joined(self, numbers: np.ndarray) -> bytes:
        sizes = self._sizes[numbers]
        first = np.repeat(self._offsets[numbers] - (np.cumsum(sizes) - sizes), sizes)
        first += np.arange(len(first))
        return self._bytes[first].tobytes()


class Decoder:
    """Texts of a byte-level vocabulary's ids."""

    def __init__(self, path: str):
        spelled = {i: token for token, i in token_bytes(path).items()}
        spelled |= {i: name.encode() for name, i in stored_vocabulary(path)[1].items()}
        self.size = max(spelled) + 1
        self._table = OffsetTable([spelled.get(i, b"") for i in range(self.size)])

    def decode(self, ids: np.ndarray) -> str:
        """The text; bytes that are not UTF-8 become replacement characters."""
        return self._table.joined(ids).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}
_decoders: dict[str, Decoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decoder(path: str) -> Decoder:
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]
