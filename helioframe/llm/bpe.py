"""Byte-pair encoding by backtracking, decoding by an offset table.

Encoding a word: an Aho-Corasick automaton over the vocabulary gives the
longest token at each place. A token may follow another only if the merges,
run on the two joined, would stop at exactly this pair; that answer is
computed from the merge tree once per pair and remembered (the compatibility
table). If the greedy tokens all agree, they are the encoding; if not, the
search steps back to shorter prefixes, and a place found to be a dead end is
never entered again, so the time stays linear in the word's length.

Decoding gathers bytes from one buffer that holds all tokens, through the
table of their offsets.

Null and empty texts have no tokens; repeated rows are encoded as rows of
their own; an empty table gives an empty result; other columns are ignored.
A special token's string inside a text becomes that token, as the tokenizers
library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from helioframe.llm.common import bound_batches, held

# The split pattern of the byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries that a Python worker remembers: words, and pairs of tokens.
CACHED_WORDS = 700_000
CACHED_PAIRS = 500_000
LONGEST_CACHED = 64
#: Marks the last character of a word in vocabularies whose words end in "</w>".
WORD_END = 0x10000

# A space at which a text must not be cut: it stands within a run of white space.
_RUN = re.compile(r"\s (?:\s|\Z)")


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairEncoder:
    """Exact merges of one vocabulary. ``ids`` of tokens must rise in the order of their merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        import ahocorasick

        byte_of = byte_characters()

        def plain(token: str) -> str:
            if word_end and token.endswith(word_end):
                body = [byte_of[c] for c in token[:-len(word_end)]]
                return "".join(map(chr, body[:-1])) + chr(body[-1] + WORD_END)
            return "".join(chr(byte_of[c]) for c in token)

        self.token_of = {plain(t): i for t, i in vocab.items()
                         if all(c in byte_of for c in t.removesuffix(word_end))}
        self.text_of = {i: t for t, i in self.token_of.items()}
        self.length = {i: len(t) for i, t in self.text_of.items()}
        self.joined: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for a, b in merges:
            a, b = plain(a), plain(b)
            pair, whole = (self.token_of[a], self.token_of[b]), self.token_of[a + b]
            self.joined[pair] = whole
            self.parts.setdefault(whole, pair)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.token_of.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.agreed: dict[tuple[int, int], bool] = {}
        # The longest token that is a proper prefix of each token; -1 if there is none.
        self.shorter_of = {i: next((self.token_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.token_of), -1)
                           for i, t in self.text_of.items()}

    def compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging the two tokens' text stops at exactly these two."""
        known = self.agreed.get(pair)
        if known is None:
            if len(self.agreed) >= CACHED_PAIRS:
                self.agreed.clear()
            known = self.agreed[pair] = self._stops_at(*pair)
        return known

    def _stops_at(self, left: int, right: int) -> bool:
        # Undo merges on both sides of the seam, latest first, and see whether
        # an earlier merge across the seam would have come before.
        bound = float("inf")
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < bound:
                return False
            undo_left, undo_right = self.parts.get(left), self.parts.get(right)
            if undo_left and (not undo_right or left > right):
                bound, left = left, undo_left[1]
            elif undo_right:
                # On the right, a merge across the seam that has the same rank comes first.
                bound, right = right + 1, undo_right[0]
            else:
                return True

    def encode(self, word: str) -> list[int]:
        """Tokens of one word, given as a character for each byte."""
        got = [token for _, token in self.automaton.iter_long(word)]
        if len(got) > 1:
            agreed, last = self.agreed, got[0]
            for k in range(1, len(got)):
                pair = (last, last := got[k])
                known = agreed.get(pair)
                if known is None:
                    known = self.compatible(pair)
                if not known:
                    return self._search(word, got, k)
        return got

    def _search(self, word: str, got: list[int], k: int) -> list[int]:
        """Go on from the first ``k`` tokens of ``got``, which agree, where the next one does not."""
        n, length, agreed, shorter_of = len(word), self.length, self.agreed, self.shorter_of
        if n > LONGEST_CACHED:
            match = self._longest(word).__getitem__
        else:
            def match(at, find=self.automaton.iter_long):
                return next(find(word, at))[1]
        closed = set()
        out, token = got[:k], shorter_of[got[k]]
        last = out[-1]
        at = sum([length[t] for t in out])
        while True:
            while token >= 0:
                end = at + length[token]
                if end not in closed:
                    if last < 0:
                        break
                    known = agreed.get((last, token))
                    if known or known is None and self.compatible((last, token)):
                        break
                token = shorter_of[token]
            if token >= 0:
                if end == n:
                    out.append(token)
                    return out
                out.append(token)
                at, last, token = end, token, match(end)
            else:
                closed.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1

    def _longest(self, word: str) -> list[int]:
        """The longest token that begins at each place of a long word, by one pass of the automaton."""
        length = self.length
        out: list[int] = [-1] * len(word)
        for end, token in self.automaton.iter(word):
            start = end + 1 - length[token]
            if out[start] < 0 or length[token] > length[out[start]]:
                out[start] = token
        return out


class WordIds(dict):
    """Ids of words as bytes of 32-bit numbers, computed when first asked for.

    Two generations of ``most // 2`` words: when the young one is full it
    becomes the old one, and words asked for again move back.
    """

    def __init__(self, encode, most: int, longest: int = LONGEST_CACHED):
        super().__init__()
        self.encode, self.most, self.longest, self.old = encode, most // 2, longest, {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word) or self.encode(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got


class ByteLevelTokenizer:
    """Encoding and decoding with a byte-level vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pairs = PairEncoder({t: i for t, i in vocab.items() if t not in self.added},
                                 [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]])
        self.split = regex.compile(SPLIT).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = WordIds(self._piece, CACHED_WORDS // 2)
        self.words = WordIds(self._word, CACHED_WORDS)

    def _piece(self, piece: str) -> bytes:
        return array("I", self.pairs.encode(piece if piece.isascii() else piece.encode().decode("latin-1"))).tobytes()

    def _word(self, word: str) -> bytes:
        if word[1:].isalpha() and word[0] == " " or word.isalpha():
            return self._piece(word)
        return b"".join(map(self.pieces.__getitem__, self.split(word)))

    def _ordinary(self, text: str) -> bytes:
        if _RUN.search(text):
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        # No piece of the split pattern crosses the front of a single space.
        first, *rest = text.split(" ")
        return self.words[first] + b"".join([self.words[" " + w] for w in rest])

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._ordinary(text), np.uint32)
        return np.frombuffer(b"".join(
            array("I", [self.added[part]]).tobytes() if i % 2 else self._ordinary(part) if part else b""
            for i, part in enumerate(self.special.split(text))), np.uint32)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes one after the other, and where each id's begin."""
        texts = {i: t.encode("latin-1") for i, t in self.pairs.text_of.items()}
        texts |= {i: t.encode("utf-8") for t, i in self.added.items()}
        size = np.zeros(max(texts) + 2, np.int64)
        for i, t in texts.items():
            size[i + 1] = len(t)
        return (np.frombuffer(b"".join(texts[i] for i in sorted(texts)), np.uint8), np.cumsum(size))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are not UTF-8 become U+FFFD."""
        buffer, begins = self.tables
        first = begins[ids]
        size = begins[ids + 1] - first
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        raw = buffer[np.repeat(first - ends + size, size) + np.arange(ends[-1])].tobytes()
        return raw.decode("utf-8", "replace").encode("utf-8")


def tokenizer(path: str) -> ByteLevelTokenizer:
    return held(("bytes", path), lambda: ByteLevelTokenizer(path))


def encoded(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256)``; ``ids=False`` leaves the ids out."""
    bound_batches(docs.sparkSession)
    names = ["doc_id", *(["ids"] if ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        own = tokenizer(path)
        for batch in batches:
            rows, counts, encoded_hash, decoded_hash = [], [], [], []
            for text in batch.column("text").to_pylist():
                got = own.encode(text or "").astype(np.int64)
                rows.append(got)
                counts.append(len(got))
                encoded_hash.append(hashlib.sha256(",".join(map(str, got.tolist())).encode()).hexdigest())
                decoded_hash.append(hashlib.sha256(own.decode(got)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *([pa.array(rows, pa.list_(pa.int64()))] if ids else []),
                 pa.array(counts, pa.int64()), pa.array(encoded_hash), pa.array(decoded_hash)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + "ids array<long>, " * ids + "n_tokens long, ids_sha256 string, decoded_sha256 string")
