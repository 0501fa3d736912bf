"""Sequence packing by minimum bin slack.

Documents become token ids; every full window of a long document is a
sequence of its own and the rests are packed. Only the histogram of rest
lengths (at most ``capacity - 1`` numbers, whatever the corpus) reaches the
driver. There, each step takes the longest rest left, finds by a bitset
subset-sum over the remaining-length multiset the filling that leaves the
least slack, backtracks how many rests of each length it uses, and applies
that pattern as often as the counts allow. The patterns are then dealt to
documents by their rank within a rest length, on the executors.

Null and empty texts are one token (the end id); repeated rows are packed as
rows of their own; an empty table gives an empty result; other columns are
ignored. A length that is a multiple of ``capacity`` leaves no rest.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.bpe import WORD_END, PairEncoder, WordIds
from helioframe.llm.common import Scratch, bound_batches, held, rank_within

CAPACITY = 4096
END_ID = 2
#: Remembered words of a Python worker (about 150 bytes each).
CACHED_WORDS = 700_000
# The split pattern of the lower-casing vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Text outside these ranges goes to the tokenizer whole: its white space,
# case or normal form may differ from Python's there.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-¬®-įı-ž‐-‧‰-›€]|<\\|")


class WordEncoder:
    """Ids of a lower-casing vocabulary with word ends; words between white space are encoded once and remembered."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {t["content"] for t in spec["added_tokens"]}
        self.pairs = PairEncoder({t: i for t, i in spec["model"]["vocab"].items() if t not in added},
                                 [tuple(m) for m in spec["model"]["merges"]], word_end="</w>")
        self.ends = {chr(b): chr(b + WORD_END) for b in range(256)}
        self.split = regex.compile(SPLIT).findall
        self.words = WordIds(self._word, CACHED_WORDS)

    def _piece(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode().decode("latin-1")
        return array("I", self.pairs.encode(raw[:-1] + self.ends[raw[-1]])).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._piece(word)
        if word[-1] in ",.;:" and word[:-1].isalpha():
            return self.words[word[:-1]] + self.words[word[-1]]
        pieces = self.split(word)
        return self._piece(word) if len(pieces) == 1 else b"".join(map(self.words.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as bytes of 32-bit numbers, the same as the tokenizers library gives."""
        if _UNUSUAL.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.words.__getitem__, text.lower().split()))


def encoder(path: str) -> WordEncoder:
    return held(("words", path), lambda: WordEncoder(path))


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, doc_tokens, windows, rest, crcs)``: lengths of each document and a CRC-32 for each of its pieces."""
    bound_batches(docs.sparkSession)

    def run(batches):
        own = encoder(path)
        end, step = array("I", [end_id]).tobytes(), 4 * capacity
        for batch in batches:
            tokens, crcs = [], []
            for text in batch.column("text").to_pylist():
                raw = memoryview(own.encode(text or "") + end)
                tokens.append(len(raw) // 4)
                crcs.append([zlib.crc32(raw[i:i + step]) for i in range(0, len(raw), step)])
            n = np.array(tokens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(n // capacity), pa.array(n % capacity),
                 pa.array(crcs, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "windows", "rest", "crcs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, doc_tokens long, windows long, rest long, crcs array<long>")


def least_slack(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best: subset sums as bits of one integer, then backtracked."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + part
            total -= length * part
    return used


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns ``(sequences, {length: pieces of it in each})`` that use every piece of the histogram once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    patterns = []
    while left:
        seed = max(left)
        left[seed] -= 1
        pattern = least_slack(left, capacity - seed)
        left[seed] += 1
        pattern[seed] = pattern.get(seed, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        patterns.append((times, pattern))
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return patterns


def seats(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces a sequence, first sequence, offset of the first piece)."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    first = 0
    for times, pattern in patterns:
        at = 0
        for n in sorted(pattern, reverse=True):
            out.setdefault(n, []).append((taken.get(n, 0), pattern[n], first, at))
            taken[n] = taken.get(n, 0) + pattern[n] * times
            at += n * pattern[n]
        first += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    each = scratch.keep(tokenized(docs, path, capacity, end_id)
                        .withColumn("row", F.monotonically_increasing_id()), "tokens")
    rests = {r["rest"]: r["count"] for r in each.where("rest > 0").groupBy("rest").count().collect()}
    patterns = pack_lengths(rests, capacity)
    by_length, packed = seats(patterns), sum(t for t, _ in patterns)

    def seat(batches):
        for batch in batches:
            rest, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rest", "rank"))
            sequence, offset = np.empty(len(rest), np.int64), np.empty(len(rest), np.int64)
            for n in np.unique(rest):
                at, rows = np.flatnonzero(rest == n), by_length[int(n)]
                first, per, base, start = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1].T
                sequence[at] = base + (rank[at] - first) // per
                offset[at] = start + (rank[at] - first) % per * n
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "start", "rest", "crc", "doc_tokens")]
                + [pa.array(sequence), pa.array(offset)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:])
    n_rows = sum(rests.values())
    short = (rank_within(each.where("rest > 0"), "rest", ["row"], n_rows)
             .select("doc_id", (F.col("doc_tokens") - F.col("rest")).alias("start"), "rest",
                     F.element_at("crcs", -1).alias("crc"), "doc_tokens", "rank")
             .mapInArrow(seat, schema))

    # Sequences of full windows: documents with w windows, one after the other for each w.
    base, at = [], packed
    long_docs = 0
    for r in each.where("windows > 0").groupBy("windows").count().orderBy("windows").collect():
        base.append((r["windows"], at))
        at += r["windows"] * r["count"]
        long_docs += r["count"]
    first = spark.createDataFrame(base, "windows long, base long")
    full = (rank_within(each.where("windows > 0"), "windows", ["row"], long_docs).join(first, "windows")
            .select("doc_id", "doc_tokens", "windows", "rank", "base",
                    F.posexplode(F.slice("crcs", F.lit(1), F.col("windows").cast("int"))).alias("k", "ids_crc32"))
            .select("doc_id", (F.col("k") * F.lit(capacity).cast("long")).alias("start"),
                    F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                    (F.col("base") + F.col("rank") * F.col("windows") + F.col("k")).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))
    return short.unionByName(full)
