"""Phrase collocations from FM-indexes over word numbers, one for each shard.

A task numbers the words of the pieces it reads and cuts them into shards of
one language. For a shard, suffixes of the number sequence and of its reverse
are sorted by as many symbols as the longest phrase has; the symbols before
them are the two Burrows-Wheeler transforms. A phrase is an interval in each.
All intervals of one length are extended to the right at once: the rows of
the reverse interval, grouped by the symbol before them, are the longer
phrases, the group's size is the count, its least LF value is the new reverse
interval, and the sizes of the smaller symbols' groups shift the forward one;
to the left it is the other way round. Phrases grow right and left in turn.

Counts of shards are summed. A phrase can only be frequent if its parts are,
so pairs are enumerated over words that are frequent in all the language, and
longer phrases over pairs that are. Frequent words get numbers, so phrases
travel as numbers; which words a shard holds comes by a join on the shard.
Frequent pairs are told by a bitmap of fixed size: a pair that is not frequent
may share a bit and pass, but no frequent one is stopped, and only summed
counts decide. No count is estimated or left out.

Texts are lower-cased (A-Z only) and cut into pieces at ``.,;:!?`` and line
ends; words stand between spaces and tabs. Null and empty texts have no words,
a null language is ``und``; repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored. A piece is kept
whole in one shard, so the memory of a task grows with its longest piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, bound_batches
from helioframe.operators.rows import with_row_index
from helioframe.session import discard

#: Words and ends of pieces in a shard (one piece more at most); a task holds four times as many.
SHARD_WORDS = 1 << 19
#: Rows given back to Spark at once.
ROWS = 1 << 16
#: Pairs that may be part of a frequent phrase are told by one of 2 ** SLOT_BITS bits (2 MB).
SLOT_BITS = 24
#: Symbols below the words': the end of a piece, and any word that is not frequent.
BREAK, OTHER, WORDS = 0, 1, 2

# A-Z to a-z, the ends of pieces to a line feed, tabs to spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
               for b in range(256))


class Numbers(dict):
    """Numbers words from 1 as they come; the end of a piece is 0."""

    def __init__(self):
        super().__init__({b"\n": BREAK})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def piece_words(text: str | None) -> list[bytes]:
    """The words of a text with a line feed for each end of a piece."""
    if not text:
        return []
    return list(filter(None, text.encode().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")))


class _Shard:
    """Words of one language on the way into a shard."""

    def __init__(self):
        self.number, self.parts, self.size, self.words = Numbers(), [], 0, 0

    def add(self, tokens: list[bytes]) -> None:
        ids = np.fromiter(map(self.number.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(ids)
        self.size += len(ids)
        self.words += int(np.count_nonzero(ids))

    def row(self) -> dict:
        """Number of words, the different words joined by spaces, their numbers with 0 for the end of a piece."""
        return {"n": self.words, "words": b" ".join(list(self.number)[1:]).decode(), "ids": np.concatenate(self.parts).tobytes()}


def _shards(docs: DataFrame) -> DataFrame:
    """``(shard, lang, n, words, ids)``."""
    schema = "shard long, lang string, n long, words string, ids binary"
    most = SHARD_WORDS

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        open_shards: dict[str, _Shard] = {}
        made = held = 0

        def give(lang):
            nonlocal made, held
            shard = open_shards.pop(lang)
            held -= shard.size
            made += 1
            return pa.RecordBatch.from_pylist([{"shard": first + made, "lang": lang, **shard.row()}])

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                tokens = piece_words(text)
                if tokens:
                    tokens.append(b"\n")
                at = 0
                while at < len(tokens):
                    shard = open_shards.setdefault(lang, _Shard())
                    end = at + most - shard.size
                    # Go on to the end of the piece.
                    end = tokens.index(b"\n", max(at, end - 1)) + 1 if end < len(tokens) else len(tokens)
                    shard.add(tokens[at:end])
                    held += end - at
                    at = end
                    if shard.size >= most:
                        yield give(lang)
                while held > 4 * most:
                    yield give(max(open_shards, key=lambda k: open_shards[k].size))
        for lang in list(open_shards):
            yield give(lang)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select("text", lang.alias("lang")).mapInArrow(run, schema)


class Index:
    """One direction of a shard's index, for patterns of at most ``depth`` symbols.

    ``text`` begins and ends with ``BREAK``. Suffixes are in the order of their
    first ``depth`` symbols, which is enough for intervals of patterns so long.
    """

    def __init__(self, text: np.ndarray, depth: int):
        rank, have = text.astype(np.int64), 1
        while have < depth:
            behind = np.zeros_like(rank)
            behind[:-have] = rank[have:]
            rank = rank * (int(rank.max()) + 1) + behind
            order = np.argsort(rank, kind="stable")
            ordered = rank[order]
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            have *= 2
        del rank, behind, ordered
        row_of = np.empty(len(order), np.int32)
        row_of[order] = np.arange(len(order), dtype=np.int32)
        self.before = text[order - 1].astype(np.int32)
        self.lf = row_of[order - 1]

    def extend(self, begin: np.ndarray, size: np.ndarray, symbols: int):
        """All patterns one symbol longer: of which pattern, by which symbol, begin, size, and the shift in the other index."""
        ends = np.cumsum(size)
        rows = np.repeat(begin - ends + size, size) + np.arange(ends[-1])
        key = np.repeat(np.arange(len(begin)), size) * symbols + self.before[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([first, [len(key)]]))
        new_begin = np.minimum.reduceat(self.lf[rows[order]], first)
        pattern, symbol = np.divmod(key[first], symbols)
        return pattern, symbol, new_begin, count, first - (ends - size)[pattern]


class Phrases:
    """Phrases of one length in a shard: their words' symbols, both intervals and the count."""

    def __init__(self, symbols: np.ndarray, forward: np.ndarray, backward: np.ndarray, count: np.ndarray):
        self.symbols, self.forward, self.backward, self.count = symbols, forward, backward, count

    def pick(self, which: np.ndarray) -> Phrases:
        return Phrases(self.symbols[which], self.forward[which], self.backward[which], self.count[which])


class ShardIndex:
    """Both directions of a shard's text."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        text = np.concatenate([[BREAK], text, [BREAK]])
        self.text, self.symbols = text, symbols
        self.ahead, self.back = Index(text, depth), Index(text[::-1], depth)

    def words(self) -> Phrases:
        count = np.bincount(self.text, minlength=self.symbols)
        begin = np.cumsum(count) - count
        held = np.flatnonzero(count[WORDS:]) + WORDS
        return Phrases(held[:, None], begin[held], begin[held], count[held])

    def longer(self, some: Phrases, left: bool = False) -> Phrases:
        """All phrases that go on with one more word to the right, or to the left."""
        if not len(some.count):
            return Phrases(np.empty((0, some.symbols.shape[1] + 1), np.int64), *[np.empty(0, np.int64)] * 3)
        here, there = (some.forward, some.backward) if left else (some.backward, some.forward)
        pattern, symbol, begin, count, shift = (self.ahead if left else self.back).extend(here, some.count, self.symbols)
        other = there[pattern] + shift
        words = [symbol, some.symbols[pattern]] if left else [some.symbols[pattern], symbol]
        out = Phrases(np.column_stack(words), *((begin, other) if left else (other, begin)), count)
        return out.pick(symbol >= WORDS)


def longer_phrases(index: ShardIndex, allowed, longest: int) -> list[Phrases]:
    """Phrases of 3 to ``longest`` words all of whose pairs are ``allowed``, by length; they grow right and left in turn."""
    some = index.longer(index.words())
    some = some.pick(allowed(some.symbols))
    out = []
    for size in range(3, longest + 1):
        left = size % 2 == 0
        some = index.longer(some, left)
        some = some.pick(allowed(some.symbols[:, :2] if left else some.symbols[:, -2:]))
        out.append(some)
    return out


def _rows(batch):
    """The rows of a batch one at a time."""
    for k in range(batch.num_rows):
        yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _numbered(shards: DataFrame) -> DataFrame:
    """``(text, numbers)``: a shard's text with ``OTHER`` for words that are not in ``known``, and the symbols' numbers in all shards."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                words = row["words"].split(" ") if row["words"] else []
                symbol = {w: k + WORDS for k, w in enumerate(words)}
                numbers = np.full(len(words) + WORDS, -1, np.int32)
                for word, number in zip(row["known_words"], row["known_numbers"], strict=True):
                    numbers[symbol[word]] = number
                # Only frequent words keep a symbol of their own.
                kept = np.flatnonzero(numbers >= 0)
                table = np.full(len(words) + 1, OTHER, np.int32)
                table[kept - WORDS + 1] = np.arange(WORDS, WORDS + len(kept))
                table[0] = BREAK
                yield pa.RecordBatch.from_arrays(
                    [pa.array([table[np.frombuffer(row["ids"], np.int32)].tobytes()], pa.binary()),
                     pa.array([np.concatenate([numbers[:WORDS], numbers[kept]]).tobytes()], pa.binary())], names=["text", "numbers"])

    return (shards.select("words", "ids", F.col("known.phrase").alias("known_words"), F.col("known.number").alias("known_numbers"))
            .mapInArrow(run, "text binary, numbers binary"))


def _indexed(row: dict, depth: int) -> tuple[ShardIndex, np.ndarray]:
    numbers = np.frombuffer(row["numbers"], np.int32).astype(np.int64)
    return ShardIndex(np.frombuffer(row["text"], np.int32), len(numbers), depth), numbers


def _count_words(shards: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                words = row["words"].split(" ") if row["words"] else []
                count = np.bincount(np.frombuffer(row["ids"], np.int32), minlength=len(words) + 1)[1:]
                for i in range(0, len(words), ROWS):
                    part = words[i:i + ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["shard"]] * len(part), pa.int64()), pa.array([row["lang"]] * len(part)),
                         pa.array(part), pa.array(count[i:i + ROWS])], names=["shard", "lang", "phrase", "count"])

    return shards.select("shard", "lang", "words", "ids").mapInArrow(
        run, "shard long, lang string, phrase string, count long")


def _count_pairs(shards: DataFrame) -> DataFrame:
    """``(pair, count)``: pairs of frequent words, as two numbers of 32 bits."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                index, numbers = _indexed(row, 2)
                some = index.longer(index.words())
                pair = _pair(numbers[some.symbols])
                for i in range(0, len(pair), ROWS):
                    part = slice(i, i + ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pair[part]), pa.array(some.count[part])], names=["pair", "count"])

    return shards.mapInArrow(run, "pair long, count long")


def _pair(numbers: np.ndarray) -> np.ndarray:
    return numbers[:, 0] << 32 | numbers[:, 1]


def _slot(pairs: np.ndarray, slots: int) -> np.ndarray:
    """Place of a pair among so many bits (a power of two)."""
    spread = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (spread & np.uint64(slots - 1)).astype(np.int64)


def _slots(pairs: DataFrame) -> np.ndarray:
    """Bits of all pairs of a table: at most ``2 ** SLOT_BITS / 64`` words reach the driver, whatever the rows."""
    size = 1 << SLOT_BITS

    def run(batches):
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_slot(batch.column("pair").to_numpy(), size)] = True
        words = np.packbits(bits, bitorder="little").view("<i8")
        held = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(words[held])], names=["at", "bits"])

    got = pairs.select("pair").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out


def _count_longer(shards: DataFrame, slots, longest: int) -> DataFrame:
    """``(key, count)``: phrases of 3 words and more whose pairs have their bits set, as numbers of 32 bits."""

    def run(batches):
        bits = np.unpackbits(slots.value.view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for row in _rows(batch):
                index, numbers = _indexed(row, longest)
                for some in longer_phrases(index, lambda s, n=numbers: bits[_slot(_pair(n[s]), len(bits))], longest):
                    step = 4 * some.symbols.shape[1]
                    for i in range(0, len(some.count), ROWS):
                        raw = numbers[some.symbols[i:i + ROWS]].astype("<i4").tobytes()
                        keys = pa.Array.from_buffers(pa.binary(step), len(raw) // step, [None, pa.py_buffer(raw)]).cast(pa.binary())
                        yield pa.RecordBatch.from_arrays([keys, pa.array(some.count[i:i + ROWS])], names=["key", "count"])

    return shards.mapInArrow(run, "key binary, count long")


def _spelled(frequent: DataFrame, words: DataFrame) -> DataFrame:
    """``(lang, phrase, a)`` of phrases given by their words' numbers."""

    def run(batches):
        for batch in batches:
            numbers = [np.frombuffer(k, "<i4").astype(np.int64) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("a"), pa.array(numbers, pa.list_(pa.int64()))],
                                             names=["key", "a", "numbers"])

    each = (frequent.select("key", "a").mapInArrow(run, "key binary, a long, numbers array<long>")
            .select("key", "a", F.posexplode("numbers").alias("place", "number")))
    back = each.join(words.select("number", "lang", F.col("phrase").alias("word")), "number")
    return (back.groupBy("key", "a", "lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
            .select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a"))


def _frequent_rows(counted: DataFrame, key: list[str], least: int) -> DataFrame:
    """The rows of shards whose key is frequent in all shards together, with its count ``a``.

    One shuffle; a window holds the rows of one word, at most one a shard, and spills.
    """
    return counted.withColumn("a", F.sum("count").over(Window.partitionBy(*key))).where(f"a >= {int(least)}")


def frequent_phrases(docs: DataFrame, scratch: Scratch, least: int = 30, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, a)`` of 1 to ``longest`` words that occur ``least`` times, and ``(lang, n)``."""
    spark = docs.sparkSession
    bound_batches(spark)
    shards = scratch.keep(_shards(docs), "shards")
    total = scratch.keep(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    held = scratch.keep(_frequent_rows(_count_words(shards), ["lang", "phrase"], least), "words")
    numbered = with_row_index(held.groupBy("lang", "phrase").agg(F.first("a").alias("a")), ["lang", "phrase"], idx="number")
    words = scratch.keep(numbered.df, "frequent")
    discard(spark, numbered.path)
    known = (held.join(words, ["lang", "phrase"]).groupBy("shard")
             .agg(F.collect_list(F.struct("phrase", "number")).alias("known")))
    shards_known = scratch.keep(_numbered(shards.join(known, "shard")), "shards")
    for done in (held, shards):
        scratch.drop(done)
    pairs = _count_pairs(shards_known).groupBy("pair").agg(F.sum("count").alias("a")).where(f"a >= {int(least)}")
    pairs = scratch.keep(pairs, "pairs")

    def keys(batches):
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            raw = np.column_stack([pair >> 32, pair & 0xFFFFFFFF]).astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[i:i + 8] for i in range(0, len(raw), 8)], pa.binary()),
                                              batch.column("a")], names=["key", "a"])

    frequent = pairs.mapInArrow(keys, "key binary, a long")
    if longest > 2:
        slots = spark.sparkContext.broadcast(_slots(pairs))
        longer = _count_longer(shards_known, slots, longest).groupBy("key").agg(F.sum("count").alias("a"))
        longer = scratch.keep(longer.where(f"a >= {int(least)}"), "longer")
        slots.unpersist()
        frequent = frequent.unionByName(longer)
    scratch.drop(shards_known)
    phrases = scratch.keep(_spelled(frequent, words), "frequent")
    scratch.drop(pairs)
    return words.select("lang", "phrase", "a").unionByName(phrases), total


def _part(words: str, first, length) -> F.Column:
    return F.array_join(F.slice(words, first, length), " ")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000,
                 covered_percent: int = 80) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words, the most tightly bound first.

    ``(lang, rank, phrase, a, l, r, n, score, left_extensions,
    right_extensions)``: a phrase's count, the counts of the two parts of its
    weakest cut, all words of the language, and how many frequent phrases (of
    up to ``longest`` words) put one word before or after it. A phrase inside
    a longer one that has ``covered_percent`` of its count goes.
    """
    scratch = Scratch(docs.sparkSession)
    frequent, total = frequent_phrases(docs, scratch, least, longest)
    count = frequent.select("lang", "phrase", "a")
    some = frequent.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words")).where("size > 1")
    cut = (some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
           .select("lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("head"),
                   _part("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    score = F.expr("cast(2000000 as decimal(18, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + r)")
    scored = (cut.join(count.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
              .join(count.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
              .withColumn("score", score)
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = (some.where("size > 2")
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .groupBy("lang", _part("words", F.col("at"), F.col("m")).alias("phrase"))
             .agg(F.max("a").alias("longer")))
    covered = F.expr(f"cast(longer as decimal(19, 0)) * 100 >= cast(a as decimal(19, 0)) * {int(covered_percent)}")
    left = scored.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(top)}")
    size = F.size("words")
    for side, start in (("left", F.lit(2)), ("right", F.lit(1))):
        extended = some.groupBy("lang", _part("words", start, size - 1).alias("phrase")).agg(F.count(F.lit(1)).alias(f"{side}_extensions"))
        best = best.join(extended, ["lang", "phrase"], "left")
    counts = [F.coalesce(f"{side}_extensions", F.lit(0)).alias(f"{side}_extensions") for side in ("left", "right")]
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), *counts)
