"""Encoding with a merge-type SentencePiece vocabulary by an agenda of symbol pairs.

A text's spaces become U+2581 and one is put in front. Every character is a
symbol; an agenda holds each two neighbours whose concatenation is a piece,
the best score first and the leftmost of equal scores. The first entry whose
symbols still stand is merged, and the new symbol enters the agenda with its
two neighbours, until nothing is left. Symbols that are no piece become the
pieces of their UTF-8 bytes.

If no piece of the vocabulary goes on behind U+2581, as is usual, no merge
crosses the end of a word, and words are encoded once and remembered; else a
text is one unit. Both are exact. The units that an Arrow batch brings for the
first time are also encoded by the sentencepiece library, in one call;
``agrees`` says of a row whether the ids of all its units are the library's
and the decoded text is the text.

Null and empty texts have no tokens; repeated rows are encoded as rows of
their own; an empty table gives an empty result; other columns are ignored.
Strings of control pieces inside a text are ordinary text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from helioframe.llm.bpe import WordIds
from helioframe.llm.common import bound_batches, held

#: Stands for a space.
SPACE = "▁"
#: Words that a Python worker remembers.
CACHED_WORDS = 600_000
#: Bits of a symbol's number in a pair, and of a place in an agenda entry.
SYMBOL_BITS, PLACE_BITS = 24, 32
#: Units of at most so many characters keep their agenda as a list in the order of the text.
SHORT = 32
LETTERS_FIRST = re.compile(r"([^\W\d_]+)([\W\d_].*)", re.S)


def _each_byte(error):
    """One U+FFFD for each byte that is not UTF-8."""
    return "�" * (error.end - error.start), error.end


codecs.register_error("helioframe.each_byte", _each_byte)


class PieceTokenizer:
    """Encoder and decoder of one merge-type model with byte pieces and no text normalisation."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        if lib.normalize("a  ａé ") != f"{SPACE}a{SPACE * 2}ａé{SPACE}":
            raise ValueError(f"{path}: only models that leave texts as they are")
        count = lib.get_piece_size()
        pieces = lib.id_to_piece(list(range(count)))
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.first_of_bytes = {i: b for b, i in enumerate(self.byte_ids) if lib.is_byte(i)}
        if len(self.first_of_bytes) < 256 or any(lib.is_unused(i) for i in range(count)):
            raise ValueError(f"{path}: only models with all byte pieces and no unused ones")
        plain = [i for i in range(count) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.pieces = pieces
        self.symbol_of = {pieces[i]: i for i in plain}
        for i in plain:
            for c in pieces[i]:
                self.symbol_of.setdefault(c, count + len(self.symbol_of))
        scores = {i: lib.get_score(i) for i in plain}
        place = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: place[s] << PLACE_BITS for i, s in scores.items()}
        #: Piece and rank of each pair of symbols that may be merged; the byte ids of symbols that are no piece.
        self.merged: dict[int, int] = {}
        for i in plain:
            text = pieces[i]
            for k in range(1, len(text)):
                left, right = self.symbol_of.get(text[:k]), self.symbol_of.get(text[k:])
                if left is not None and right is not None:
                    self.merged[left << SYMBOL_BITS | right] = i
        self.pair_rank = {pair: self.rank[i] for pair, i in self.merged.items()}
        self.spelled = {i: [self.byte_ids[b] for b in c.encode()] for c, i in self.symbol_of.items() if i >= count}
        #: Whether words can be encoded one by one.
        self.by_words = not any(SPACE in pieces[i].lstrip(SPACE) for i in plain)
        self.count = count
        self.inside = {t[k:k + 2] for t in self.symbol_of for k in range(len(t) - 1)}
        self.words = WordIds(self._word, CACHED_WORDS)
        self.tails = WordIds(self.agenda, CACHED_WORDS // 8)
        #: Units not yet compared with the library, and those that it encodes otherwise.
        self.fresh: dict[str, bytes] = {}
        self.wrong: set[str] = set()

    def _word(self, word: str) -> bytes:
        """Ids of a word with a space in front (not given)."""
        parts = LETTERS_FIRST.fullmatch(word)
        if parts and word[parts.end(1) - 1:parts.end(1) + 1] not in self.inside:
            # No piece holds these two characters, so no merge joins what is before to what is after.
            got = self.words[parts[1]] + self.tails[parts[2]]
        else:
            got = self.agenda(SPACE + word)
        self.fresh[word] = got
        return got

    def compare(self) -> None:
        """Encode the fresh units by the library and note which differ."""
        theirs = self.library.encode(list(self.fresh), num_threads=1)
        self.wrong.update(w for (w, ours), ids in zip(self.fresh.items(), theirs, strict=True)
                          if array("I", ids).tobytes() != ours)
        self.fresh.clear()

    def agenda(self, unit: str) -> bytes:
        """Ids of ``unit`` (spaces already replaced) as 32-bit numbers."""
        find = self.symbol_of.get
        symbols = [find(c, -1) for c in unit]
        if len(symbols) <= SHORT and -1 not in symbols:
            return self._short(symbols)
        merged, rank = self.merged.get, self.rank
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        todo = []
        for at in range(n - 1):
            whole = merged(symbols[at] << SYMBOL_BITS | symbols[at + 1])
            if whole is not None:
                todo.append(rank[whole] | at)
        heapq.heapify(todo)
        mask = (1 << PLACE_BITS) - 1
        while todo:
            entry = heapq.heappop(todo)
            at = entry & mask
            right = after[at]
            if right >= n or symbols[at] == -2:
                continue
            whole = merged(symbols[at] << SYMBOL_BITS | symbols[right])
            if whole is None or rank[whole] | at != entry:
                continue
            symbols[at], symbols[right] = whole, -2
            after[at] = right = after[right]
            if right < n:
                before[right] = at
                whole = merged(symbols[at] << SYMBOL_BITS | symbols[right])
                if whole is not None:
                    heapq.heappush(todo, rank[whole] | at)
            left = before[at]
            if left >= 0:
                whole = merged(symbols[left] << SYMBOL_BITS | symbols[at])
                if whole is not None:
                    heapq.heappush(todo, rank[whole] | left)
        ids = array("I")
        count, byte_ids = self.count, self.byte_ids
        for at, symbol in enumerate(symbols):
            if 0 <= symbol < count:
                ids.append(symbol)
            elif symbol != -2:
                ids.extend([byte_ids[b] for b in unit[at].encode()])
        return ids.tobytes()

    def _short(self, symbols: list[int]) -> bytes:
        """The same with the agenda's ranks in a list: its first least entry is next."""
        ranked, merged = self.pair_rank.get, self.merged
        none = 1 << 62
        ranks = [ranked(a << SYMBOL_BITS | b, none) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            whole = merged[symbols[at] << SYMBOL_BITS | symbols[at + 1]]
            symbols[at] = whole
            del symbols[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = ranked(whole << SYMBOL_BITS | symbols[at + 1], none)
            if at:
                ranks[at - 1] = ranked(symbols[at - 1] << SYMBOL_BITS | whole, none)
        if max(symbols, default=0) >= self.count:
            symbols = [i for s in symbols for i in self.spelled.get(s, [s])]
        return array("I", symbols).tobytes()

    def units(self, text: str) -> list[str]:
        """Parts of a text between which nothing merges, each without the space in front of it."""
        if not text:
            return []
        if self.by_words and not ("  " in text or SPACE in text or text[0] == " " or text[-1] == " "):
            return text.split(" ")
        spaced = SPACE + text.replace(" ", SPACE)
        # Runs of spaces merge among themselves: a unit is a run and the word behind it.
        return [u[1:] for u in (re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", spaced) if self.by_words else [spaced])]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.words.__getitem__, self.units(text))), np.uint32)

    def agrees(self, text: str) -> bool:
        """Whether the library gives the same ids for all units (after :meth:`compare`)."""
        return not self.wrong or self.wrong.isdisjoint(self.units(text))

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes one after the other, where each id's begin, and which ids are bytes."""
        lib = self.library
        texts = [bytes([self.first_of_bytes[i]]) if i in self.first_of_bytes
                 else b"" if lib.is_control(i)
                 else lib.decode([i]).encode() if lib.is_unknown(i)
                 else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        single = np.zeros(len(texts), bool)
        single[self.byte_ids] = True
        return np.frombuffer(b"".join(texts), np.uint8), begins, single

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text, without the space put in front; U+FFFD for each stray byte."""
        if not len(ids):
            return b""
        buffer, begins, single = self.tables
        first = begins[ids]
        size = begins[ids + 1] - first
        ends = np.cumsum(size)
        raw = buffer[np.repeat(first - ends + size, size) + np.arange(ends[-1])].tobytes()
        spoken = next((i for i in ids.tolist() if not self.library.is_control(i)), None)
        if spoken is not None and self.pieces[spoken].startswith(SPACE):
            raw = raw[1:]
        lone = single[ids]
        if lone.any():
            # Bytes make characters only within one run of byte pieces.
            cuts = ends[np.flatnonzero(lone[1:] != lone[:-1])] + len(raw) - ends[-1]
            edges = [0, *cuts.tolist(), len(raw)]
            raw = "".join(raw[a:b].decode("utf-8", "helioframe.each_byte")
                          for a, b in zip(edges, edges[1:])).encode()
        return raw


def tokenizer(path: str) -> PieceTokenizer:
    return held(("pieces", path), lambda: PieceTokenizer(path))


def encoded(docs: DataFrame, path: str, ids: bool = True, check: bool = True) -> DataFrame:
    """``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256, agrees)``; ``ids=False`` leaves the ids out.

    ``agrees`` is null with ``check=False``, which spares the library's work.
    """
    bound_batches(docs.sparkSession)
    names = ["doc_id", *(["ids"] if ids else []), "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]

    def run(batches):
        own = tokenizer(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [own.encode(t).astype(np.int64) for t in texts]
            spelled = [",".join(map(str, r.tolist())) for r in rows]
            decoded = [own.decode(r) for r in rows]
            agrees = [None] * len(rows)
            if check:
                own.compare()
                agrees = [own.agrees(t) and d == t.replace(SPACE, " ").encode()
                          for t, d in zip(texts, decoded, strict=True)]
            own.fresh.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *([pa.array(rows, pa.list_(pa.int64()))] if ids else []),
                 pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([hashlib.sha256(s.encode()).hexdigest() for s in spelled], pa.string()),
                 pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                 pa.array(agrees, pa.bool_())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + "ids array<long>, " * ids
        + "n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")
