"""MinHash near-dedup with SetSketch registers.

A document's set is its distinct word shingles. Each shingle draws a Poisson
process of points; a register keeps the least point that fell on it, stored
as a truncated power of ``BASE``. Registers are mergeable (minima), and two
sets agree in a register about as often as their Jaccard similarity.

1. Sketches; documents with equal sets collapse to one class.
2. Bands of registers: each class meets the least class of every bucket, which
   gives groups of possible duplicates without listing a bucket's pairs.
3. The texts of a group are compared in cells of two blocks, so no task gets
   more than two blocks of a large group. In a cell, the joint likelihood of
   the registers estimates the similarity; pairs that may reach the threshold
   are confirmed on the full sets, best first, unless already connected.
4. Connected components of the confirmed links.

Null and empty texts, and texts without words, have an empty set and are
linked with nothing; repeated rows and rows of equal id are rows of their own;
a null id counts as larger than any other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, bound_batches, components, grouped

REGISTERS = 128
#: Registers hold ``1 - log_BASE(point)``, cut to 0 .. TOP; RATE shifts them above 0 for small sets.
BASE, RATE, TOP = 1.02, 20.0, 4095
ROWS_PER_BAND = 4
#: Pairs whose estimate is this much below the threshold are not compared: over 4.5 standard deviations.
MARGIN = 0.17
#: A block of a group: classes, and shingles in them.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 400_000
#: Bytes of text that a worker turns into shingles at once.
GROUP_BYTES = 1 << 20

_MIX = [np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _MIX[2])
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text (A-Z count as a-z; words end at ASCII white space)."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(texts)
    ends = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    size = ends - starts
    # Each word is a polynomial in its bytes.
    inside = np.flatnonzero(~space)
    first = np.cumsum(size) - size
    place = np.arange(len(inside)) - np.repeat(first, size)
    value = (_LOWER[raw[inside]] + np.uint64(1)) * _powers(int(size.max()))[place]
    word = _mixed(np.add.reduceat(value, first) + size.astype(np.uint64) * _MIX[3])
    # Shingles of ``words`` words from each word on, whichever text they reach into.
    many = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for k in range(words if len(many) else 0):
        many = many * _MIX[3] + word[k:len(word) - words + 1 + k]
    many = _mixed(many + np.uint64(words))
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(starts, begin)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(many[a:b - words + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = one * _MIX[3] + word[k]
            out.append(_mixed(one + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Registers (a row for each set) of sets that hold something."""
    least = np.full(len(sets) * registers, np.inf)
    size = np.array([len(s) for s in sets])
    reach = (np.log(registers) + 8) / size  # so far, all registers are hit but once in some thousand sets
    todo = np.arange(len(sets))
    while len(todo):
        owner = np.repeat(todo, size[todo])
        state = np.concatenate([sets[i] for i in todo])
        point, limit = np.zeros(len(state)), reach[owner]
        while len(state):
            state = _mixed(state + _MIX[2])
            point = point - np.log(((state >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / registers
            near = point <= limit
            owner, state, point, limit = owner[near], state[near], point[near], limit[near]
            register = (_mixed(state ^ _MIX[3]) >> np.uint64(32)).astype(np.int64) % registers
            np.minimum.at(least, owner * registers + register, point)
        full = np.isfinite(least.reshape(-1, registers)[todo]).all(axis=1)
        todo = todo[~full]
        reach[todo] *= 4
    stored = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(stored, 0, TOP).astype("<u2").reshape(-1, registers)


def estimate(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Jaccard similarity of greatest joint likelihood, given in how many registers set a is above or below set b."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = registers - above - below

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j):
        up, down = p(np.maximum(u - v * j, 1e-12)), p(np.maximum(v - u * j, 1e-12))
        return above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):  # the likelihood has one peak
        third = (high - low) / 3
        left = fit(low + third) >= fit(high - third)
        low, high = np.where(left, low, low + third), np.where(left, high - third, high)
    return (low + high) / 2


def described(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key, sketch)``; the last two are null for empty sets."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            n, keys, marks = [], [], []
            for group in grouped(texts, GROUP_BYTES, len):
                sets = shingle_sets(group, words)
                full = [s for s in sets if len(s)]
                mark = iter(sketches(full) if full else ())
                n += [len(s) for s in sets]
                keys += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                marks += [next(mark).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, set_key binary, sketch binary")


class _Forest:
    """Union-find over the members of a cell."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def _confirmed(sets: list[np.ndarray], marks: np.ndarray, block: np.ndarray, one_block: bool, percent: int):
    """Pairs of members whose sets reach the threshold, as many as connect what can be connected."""
    size = np.array([len(s) for s in sets], np.float64)
    firsts, seconds, ups, downs = [], [], [], []
    least = REGISTERS * max(percent / 100 - 2 * MARGIN, 0.1)
    for i in range(len(sets) - 1):
        after = marks[i + 1:]
        same = (after == marks[i]).sum(axis=1)
        j = np.flatnonzero((same >= least) & (one_block | (block[i + 1:] != block[i])))
        if len(j):
            up = (after[j] < marks[i]).sum(axis=1)
            firsts.append(np.full(len(j), i))
            seconds.append(j + i + 1)
            ups.append(up)
            downs.append(REGISTERS - same[j] - up)
    if not firsts:
        return
    a, b, up, down = (np.concatenate(x) for x in (firsts, seconds, ups, downs))
    guess = estimate(up, down, size[a], size[b])
    forest = _Forest(len(sets))
    for k in np.argsort(-guess, kind="stable"):
        if guess[k] < percent / 100 - MARGIN:
            break
        x, y = forest.root(int(a[k])), forest.root(int(b[k]))
        if x == y:
            continue
        one, other = sets[a[k]], sets[b[k]]
        both = len(np.intersect1d(one, other, assume_unique=True))
        if 100 * both >= percent * (len(one) + len(other) - both):
            forest.up[x] = y
            yield int(a[k]), int(b[k])


def _links(cells: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)`` of classes confirmed in each cell; rows of a cell are next to each other."""

    def compare(rows: list[tuple]):
        _, low, high = rows[0][0]
        sets = [s for group in grouped([r[3].encode("utf-8", "surrogatepass") for r in rows], GROUP_BYTES, len)
                for s in shingle_sets(group, words)]
        own: dict[int, int] = {}
        for i, (_, cid, key, _, _, _) in enumerate(rows):  # rows of one id with other texts do not belong here
            if cid not in own and xxhash.xxh3_128_digest(sets[i].tobytes()) == key:
                own[cid] = i
        at = list(own.values())
        marks = np.stack([np.frombuffer(rows[i][4], "<u2") for i in at]) if at else np.empty((0, REGISTERS))
        block = np.array([rows[i][5] for i in at])
        ids = [rows[i][1] for i in at]
        return [(ids[i], ids[j]) for i, j in _confirmed([sets[i] for i in at], marks, block, low == high, percent)]

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            out = []
            for gid, low, high, *rest in zip(*(batch.column(c).to_pylist() for c in ("gid", "low", "high", "cid", "set_key", "text", "sketch", "block")), strict=True):
                cell = (gid, low, high)
                if held and held[0][0] != cell:
                    out += compare(held)
                    held = []
                held.append((cell, *rest))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
        if held:
            out = compare(held)
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows_per_band: int = ROWS_PER_BAND) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row a document, components of links ``100 |A n B| >= percent |A u B|``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    each = scratch.keep(described(docs, words), "sketches")
    classes = scratch.keep(
        each.where("n_shingles > 0").groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    width = 2 * rows_per_band
    bands = [F.xxhash64(F.lit(b), F.substring("sketch", 1 + b * width, width)) for b in range(REGISTERS // rows_per_band)]
    buckets = classes.select("cid", F.explode(F.array(*bands)).alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = buckets.join(heads, "bucket").where("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    grouped_with = components(spark, stars)
    roots = grouped_with.select(F.col("component").alias("node"), "component").distinct()
    members = (grouped_with.unionAll(roots).select(F.col("node").alias("cid"), F.col("component").alias("gid"))
               .join(classes.select("cid", "doc_id", "set_key", "sketch", "n_shingles"), "cid"))

    # A group of several blocks is dealt to a cell for each two of them.
    blocks = members.groupBy("gid").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = (members.join(blocks, "gid").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
               .drop("n_shingles"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").where("text is not null")
    members = texts.join(members, F.col("id").eqNullSafe(F.col("doc_id"))).drop("id", "doc_id")
    cells = (members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("gid", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "cid", "set_key", "text", "sketch", "block")
             .repartition("gid", "low", "high").sortWithinPartitions("gid", "low", "high"))
    linked = components(spark, _links(cells, words, percent))

    # From classes to documents; classes of a single document that is linked with nothing are left out.
    rooted = classes.select("cid", "set_key", "doc_id", "copies").join(linked, F.col("cid") == F.col("node"), "left")
    rooted = rooted.select("set_key", "doc_id", "copies", F.coalesce("component", "cid").alias("root"))
    totals = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("documents")).where("documents > 1")
    named = rooted.join(totals, "root").select("set_key", "component_id")
    return (each.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those linked to one of smaller id; of rows equal in id and text one stays."""
    found = near_duplicates(docs, words, percent).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    found = Scratch(docs.sparkSession).keep(found, "kept")
    out = docs.join(found.select(F.col("doc_id").alias("kept_id")), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return out.dropDuplicates(["doc_id", "text"]) if found.where("rows > 1").limit(1).count() else out
