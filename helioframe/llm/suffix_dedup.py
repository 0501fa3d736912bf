"""Removal of byte strings that occur more than once, by suffix arrays.

A string of ``length`` bytes is removed wherever it stands if it also starts
anywhere else, in another document or the same one. Strings do not cross
documents and are judged on the input.

1. Every window of ``length`` bytes belongs to its minimizer, the least k-gram
   hash in it, so equal windows share one; a *segment* is a run of windows of
   one minimizer. Only the texts that hold a minimizer which occurs again in
   the corpus go on.
2. Equal segments are counted together: all windows of a segment that occurs
   twice are repeated. One of each kind goes on, and only where another kind
   shares its minimizer or the minimizer occurs twice inside it.
3. The kinds of a minimizer meet in one task, where a suffix array over the
   words (strings that end at a separator, ranked in byte order) groups the
   suffixes that share a prefix; a window is repeated if another one has the
   same bytes before its first word boundary and a suffix of the same group
   after it. Minimizers of very many kinds are dealt out by window instead, so
   that no task gets an unbounded group: windows are counted by a 128-bit hash.
4. Repeated windows are joined to spans, and the spans cut out of the texts.

Texts are told apart by their SHA-256; those that go on are numbered. (The
64-bit hash of a text only says which ones go on; one too many does no harm.)
Null and empty texts and texts shorter than ``length`` keep everything; equal texts of ``length`` bytes or
more lose everything; an empty table gives an empty result; other columns are
ignored by :func:`repeated_spans` and kept by :func:`without_repeats`.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, bound_batches, grouped
from helioframe.llm.suffix_array import suffix_array
from helioframe.llm.winnowing import gram_hashes, sliding_minimum

LENGTH = 200
GRAM = 32
#: Segments of more windows are cut; their parts still share the minimizer.
MOST_WINDOWS = 512
#: Kinds of segments of one minimizer that a task sorts together (some 3 MB of text, 200 MB of memory);
#: beyond, windows are counted by hash.
MOST_KINDS = 8192
#: Bytes whose suffixes are sorted at once (single minimizers may need more).
SORTED_BYTES = 1 << 18
#: Longest word for the suffix array over words; with a longer one, each byte is a word.
LONGEST_WORD = 64
#: Bytes of text that a worker cuts into segments at once.
GROUP_BYTES = 1 << 17

# A word ends at white space, a stop or a comma, or one of a few common letters' bytes.
_ENDS = np.zeros(256, bool)
_ENDS[[*b" \n\t\r.,;:/\"'", 0]] = True
_WORD = re.compile(b"[^" + re.escape(bytes(np.flatnonzero(_ENDS).tolist())) + b"]*[" + re.escape(bytes(np.flatnonzero(_ENDS).tolist())) + b"]")


def text_key(text):
    """What tells texts apart: 32 bytes that no two texts share."""
    return F.unhex(F.sha2(text, 256))


class Minimizers:
    """Segments of texts laid end to end: runs of windows that share their minimizer."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        raw = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        self.reach = length - gram + 1
        self.ends = np.cumsum(size)
        self.grams = self.least = np.empty(0, np.uint64)
        #: Text of each segment, its first window there, its number of windows, its minimizer.
        self.owner = self.start = self.windows = np.empty(0, np.int64)
        self.value = np.empty(0, np.int64)
        if len(raw) < length:
            return
        self.grams = gram_hashes(raw, gram)
        self.least = least = sliding_minimum(self.grams, self.reach)
        # Runs of equal minima, cut where a text begins and where its last window ends.
        first = self.ends - size
        windows = np.maximum(size - length + 1, 0)
        cut = np.concatenate([first, first + windows])
        new = np.empty(len(least) + 1, bool)
        new[0] = new[-1] = True
        np.not_equal(least[1:], least[:-1], out=new[1:-1])
        new[cut[cut <= len(least)]] = True
        edges = np.flatnonzero(new)
        start, count = edges[:-1], np.diff(edges)
        owner = np.searchsorted(self.ends, start, "right")
        real = start < (first + windows)[np.minimum(owner, len(texts) - 1)]
        start, count, owner = start[real], count[real], owner[real]
        if len(count) and count.max() > MOST_WINDOWS:
            parts = -(-count // MOST_WINDOWS)
            k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start, owner = np.repeat(start, parts) + k * MOST_WINDOWS, np.repeat(owner, parts)
            count = np.minimum(np.repeat(count, parts) - k * MOST_WINDOWS, MOST_WINDOWS)
        self.owner, self.start, self.windows = owner, start - first[owner], count
        self.value = least[start].view(np.int64)

    def inner(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, minimizer) where one segment may hold its minimizer twice, as in a short period."""
        if not len(self.least):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # A gram is the minimizer of some window if it equals the greatest of the minima around it.
        around = np.zeros(len(self.least) + 2 * (self.reach - 1), np.uint64)
        around[self.reach - 1:self.reach - 1 + len(self.least)] = self.least
        at = np.flatnonzero(self.grams == ~sliding_minimum(~around, self.reach))
        twice = at[:-1][(self.grams[at[1:]] == self.grams[at[:-1]]) & (at[1:] - at[:-1] <= self.reach)]
        return np.searchsorted(self.ends, twice, "right"), self.grams[twice].view(np.int64)


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each part, which of its windows occur elsewhere in the parts (or again in the same one)."""
    words = _WORD.findall(joined := b"\n".join(parts) + b"\n")
    if max(map(len, words)) > min(LONGEST_WORD, length - 1):
        words = [joined[i:i + 1] for i in range(len(joined))]
    size = np.fromiter(map(len, words), np.int64, len(words))
    # Words are prefix-free, so the order of their ranks is the order of their bytes.
    rank = {w: i for i, w in enumerate(sorted(set(words)))}
    order = np.array(suffix_array([rank[w] for w in words]), np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    data = np.frombuffer(joined + bytes(length), np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    shared = np.zeros(len(order), np.int64)
    for k in range(0, len(order) - 1, 4096):
        block = view[begins[order[k:k + 4097]]]
        differ = block[1:] != block[:-1]
        shared[k + 1:k + len(block)] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    at = np.empty(len(order), np.int64)  # of each word, its suffix's place in the array
    at[order] = np.arange(len(order))

    # A window starts inside a word and reaches the next one after ``ahead`` bytes.
    n_windows = np.array([max(len(p) - length + 1, 0) for p in parts], np.int64)
    part_begin = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    start = np.arange(n_windows.sum()) + np.repeat(part_begin - np.cumsum(n_windows) + n_windows, n_windows)
    word = np.searchsorted(ends, start, "right")
    ahead = ends[word] - start
    suffix = at[np.minimum(word + 1, len(order) - 1)]
    found = np.zeros(len(start), bool)
    prefix = np.zeros(len(data) + 1, np.uint64)  # hash of the bytes from a place to the end of its word
    value = data.astype(np.uint64) + np.uint64(1)
    word_of = np.searchsorted(ends, np.arange(len(joined)), "right")
    to_end = ends[word_of] - np.arange(len(joined))
    by_distance = np.argsort(to_end, kind="stable")
    cut = np.searchsorted(to_end[by_distance], np.arange(1, int(to_end.max()) + 2))
    by_ahead = np.argsort(ahead, kind="stable")
    own = np.searchsorted(ahead[by_ahead], np.arange(1, int(to_end.max()) + 2))
    for j in range(1, int(to_end.max()) + 1):
        here = by_distance[cut[j - 1]:cut[j]]
        rest = prefix[here + 1] if j > 1 else np.uint64(0)
        prefix[here] = (rest + value[here]) * np.uint64(0xD6E8FEB86659FD93) ^ (value[here] << np.uint64(40))
        windows = by_ahead[own[j - 1]:own[j]]
        if len(windows) < 2:
            continue
        group = np.cumsum(shared < length - j)[suffix[windows]]
        front = prefix[start[windows]]
        order_j = np.lexsort((front, group))
        same = (group[order_j][1:] == group[order_j][:-1]) & (front[order_j][1:] == front[order_j][:-1])
        found[windows[order_j[1:][same]]] = True
        found[windows[order_j[:-1][same]]] = True
    return np.split(found, np.cumsum(n_windows)[:-1])


def runs_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and lengths of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()


def _minimizers(texts: DataFrame, length: int) -> DataFrame:
    """``(mh, ref)`` of every segment, and once more if the segment may repeat windows itself."""

    def run(batches):
        for batch in batches:
            rows = [(r, t.encode("utf-8", "surrogatepass")) for r, t in zip(batch.column("ref").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            for group in grouped(rows, GROUP_BYTES, lambda r: len(r[1])):
                found = Minimizers([t for _, t in group], length)
                more, again = found.inner()
                owner, value = np.concatenate([found.owner, more]), np.concatenate([found.value, again])
                refs = np.array([r for r, _ in group], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(refs[owner])], names=["mh", "ref"])

    return texts.select("ref", "text").mapInArrow(run, "mh long, ref long")


def _kinds(candidates: DataFrame, length: int) -> DataFrame:
    """``(mh, sh, ref, start, windows, inner, copies)`` of the segments whose minimizer is among ``mhs``."""
    names = ["mh", "sh", "ref", "start", "windows", "inner", "copies"]

    def run(batches):
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("ref", "text", "copies", "mhs"))
            for ref, text, copies, mhs in zip(*cols, strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                found = Minimizers([raw], length)
                keep = np.isin(found.value, np.array(mhs, np.int64))
                start, runs, value = found.start[keep], found.windows[keep], found.value[keep]
                grams = found.grams.view(np.int64)
                hashes = [xxhash.xxh3_64_intdigest(raw[a:a + n - 1 + length]) for a, n in zip(start.tolist(), runs.tolist(), strict=True)]
                inner = [int(np.count_nonzero(grams[a:a + n + length - GRAM] == v)) > 1
                         for a, n, v in zip(start.tolist(), runs.tolist(), value.tolist(), strict=True)]
                k = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value), pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.full(k, ref, np.int64)),
                     pa.array(start.astype(np.int32)), pa.array(runs.astype(np.int32)), pa.array(inner, pa.bool_()),
                     pa.array(np.full(k, copies, np.int64))], names=names)

    return candidates.mapInArrow(run, "mh long, sh long, ref long, start int, windows int, inner boolean, copies long")


def _cut_out(wanted: DataFrame, length: int) -> DataFrame:
    """``(mh, sh, ref, start, seen, bytes)`` of the wanted segments of each text."""
    names = ["mh", "sh", "ref", "start", "seen", "bytes"]

    def run(batches):
        for batch in batches:
            out = []
            for ref, text, parts in zip(*(batch.column(c).to_pylist() for c in ("ref", "text", "parts")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for p in parts:
                    piece = raw[p["start"]:p["start"] + p["windows"] - 1 + length]
                    if xxhash.xxh3_64_intdigest(piece) == p["sh"] % 2**64:
                        out.append((p["mh"], p["sh"], ref, p["start"], p["seen"], piece))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return wanted.mapInArrow(run, "mh long, sh long, ref long, start int, seen long, bytes binary")


def _sorted_out(parts: DataFrame, length: int) -> DataFrame:
    """``(ref, start, windows)``: repeated runs in segments seen once; the kinds of a minimizer are next to each other."""

    def compare(rows: list[tuple]):
        for (_, _, ref, start, seen, _), flags in zip(rows, repeated_windows([r[5] for r in rows], length), strict=True):
            if seen == 1:
                for a, n in zip(*runs_of(flags), strict=True):
                    yield ref, start + a, n

    def run(batches):
        held: list[tuple] = []
        volume = 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("mh", "sh", "ref", "start", "seen", "bytes")), strict=True):
                if held and volume > SORTED_BYTES and held[-1][0] != row[0]:
                    out += compare(held)
                    held, volume = [], 0
                held.append(row)
                volume += len(row[5])
            yield record(out)
        if held:
            yield record(list(compare(held)))

    def record(out):
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int32()], strict=True)],
                                          names=["ref", "start", "windows"])

    return parts.mapInArrow(run, "ref long, start int, windows int")


def _windows(parts: DataFrame, length: int) -> DataFrame:
    """``(mh, wh, ref, at, seen)``: a hash of each window."""

    def run(batches):
        for batch in batches:
            for mh, ref, start, seen, raw in zip(*(batch.column(c).to_pylist() for c in ("mh", "ref", "start", "seen", "bytes")), strict=True):
                hashes = [xxhash.xxh3_128_digest(raw[i:i + length]) for i in range(len(raw) - length + 1)]
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, mh, np.int64)), pa.array(hashes, pa.binary()), pa.array(np.full(n, ref, np.int64)),
                     pa.array(np.arange(start, start + n, dtype=np.int32)), pa.array(np.full(n, seen, np.int64))], names=["mh", "wh", "ref", "at", "seen"])

    return parts.mapInArrow(run, "mh long, wh binary, ref long, at int, seen long")


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold repeats ``(ref, key, text, copies)``, and their runs of repeated windows ``(ref, start, windows)``."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    texts = docs.where(F.octet_length("text") >= length).select(F.xxhash64("text").alias("ref"), "text")

    marks = scratch.keep(_minimizers(texts, length), "minimizers")
    # Written, so that the join's both sides are shuffled for it and a very common minimizer can be split.
    again = scratch.keep(marks.groupBy("mh").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mh"), "again")
    wanted = marks.join(again, "mh").groupBy("ref").agg(F.collect_set("mh").alias("mhs"))
    keyed = texts.withColumn("key", text_key("text"))
    once = keyed.groupBy("ref", "key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    # The keys fetch the minimizers, so that the texts are shuffled once only.
    wanted = keyed.select("ref", "key").distinct().join(wanted, "ref")
    candidates = scratch.keep(once.join(wanted, ["ref", "key"]).withColumn("ref", F.monotonically_increasing_id()), "candidates")
    scratch.drop(marks)
    scratch.drop(again)

    each = scratch.keep(_kinds(candidates, length), "segments")
    kinds = scratch.keep(each.groupBy("mh", "sh").agg(
        F.sum("copies").alias("seen"), F.min("ref").alias("ref"), F.min_by("start", "ref").alias("start"),
        F.max("windows").alias("windows"), F.max("inner").alias("inner")), "kinds")
    whole = each.join(kinds.where("seen > 1").select("mh", "sh"), ["mh", "sh"]).select("ref", "start", "windows")

    others = kinds.groupBy("mh").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.when(F.col("seen") == 1, 1)).alias("open"))
    others = others.where("open = 1")
    chosen = kinds.join(others, "mh").where("kinds > 1 or (inner and seen = 1)")
    parts = (chosen.groupBy("ref").agg(F.collect_list(F.struct("mh", "sh", "start", "windows", "seen", "kinds")).alias("parts"))
             .join(candidates.select("ref", "text"), "ref"))
    few, many = (parts.withColumn("parts", F.filter("parts", test)).where(F.size("parts") > 0)
                 for test in (lambda p: p["kinds"] <= MOST_KINDS, lambda p: p["kinds"] > MOST_KINDS))
    sorted_out = _sorted_out(_cut_out(few, length).repartition("mh").sortWithinPartitions("mh"), length)
    windows = _windows(_cut_out(many, length), length)
    twice = windows.groupBy("mh", "wh").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mh", "wh")
    counted = (windows.where("seen = 1").join(twice, ["mh", "wh"])
               .select("ref", F.col("at").alias("start"), F.lit(1).alias("windows")))
    return candidates, whole.unionByName(sorted_out).unionByName(counted)


def _covered(n: int, runs: list[dict], length: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    at = np.array([r["start"] for r in runs], np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + np.array([r["windows"] for r in runs], np.int64) - 1 + length, -1)
    return np.cumsum(change[:-1]) > 0


def _removals(docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """``(key, n_removed, n_spans, kept_sha256[, kept])`` of the texts that lose something."""
    candidates, runs = repeated_runs(docs, length)
    runs = runs.groupBy("ref").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    names = ["key", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]

    def run(batches):
        for batch in batches:
            out = []
            for key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "runs")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                gone = _covered(len(raw), spans, length)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                row = (key, len(raw) - len(kept), len(runs_of(gone)[0]), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
            types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()][:len(names)]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return (candidates.select("ref", "key", "text").join(runs, "ref").select("key", "text", "runs")
            .mapInArrow(run, "key binary, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of all documents."""
    empty = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text_key(empty).alias("key"), F.octet_length(empty).cast("long").alias("n_bytes"),
                       F.sha2(F.encode(empty, "UTF-8"), 256).alias("own_sha256"))
    lost = _removals(docs, length, with_text=False)
    return (rows.join(lost, "key", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                    F.coalesce("kept_sha256", "own_sha256").alias("kept_sha256")))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut out of their texts; bytes of a character cut in two are dropped."""
    lost = _removals(docs, length, with_text=True).select(F.struct("key", "kept").alias("lost"))
    own = docs.select(F.struct("*").alias("doc"), text_key("text").alias("key"))  # columns of any name stay apart
    keep = [F.coalesce("lost.kept", "doc.text").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return own.join(lost, F.col("key") == F.col("lost.key"), "left").select(*keep)
