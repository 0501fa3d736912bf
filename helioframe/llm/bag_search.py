"""Ranked lexical search over bags of words, each different bag scored once.

Items (queries) are taken in blocks of bounded size. For a block, a document
is cut down to the block's vocabulary: its bag is the vector of term numbers
and counts, and together with its length norm ``m`` it decides every score.
Documents with one vector and one ``m`` form a class: they are dealt by a hash
of the two and told apart by comparing the vectors themselves. Each class is
scored once against all items of the block. The ten best classes of an item,
ties by their smallest ``doc_id``, hold its ten best documents, since each of
them has a document that ranks as well; so only those classes are expanded,
again comparing vectors, to their members of smallest ``doc_id``.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII,
only A-Z lower-cased. With N documents that hold a term, L terms in them, n in
one document and df the documents that hold a term, a term's weight is
``floor(1000 ln((2N+2)/(2df+1)))`` and ``m = 25 + 75nN div L``; a score adds
``w * ((10^9 tf) div (1000 tf + 8m))`` over an item's terms with repeats.

Null and empty texts have no terms: such documents are never found, such items
find nothing. Repeated documents are rows of their own, each takes a rank.
Every row of the items is answered, also if its ``item_id`` is null or occurs
before. Null ids of documents come first among equal scores. Empty tables give
an empty result; other columns are ignored.

The driver holds one block's items (``BLOCK_BYTES``) and their df; nothing of
it grows with the documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, bound_batches

#: Bytes of different items in one block (estimated from their terms).
BLOCK_BYTES = 4 << 20
#: Products of class and item handled at once in a task.
PRODUCTS = 1 << 21
#: Sums below this are exact in doubles.
EXACT = 1 << 53

_KEPT = {*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)}
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_TABLE).split(b" ") if text else []


def _found(text: str | None) -> list[bytes]:
    return [t for t in terms(text) if t]


def item_bags(items: DataFrame) -> DataFrame:
    """``(item_id, bag)``: an item's terms in order of their bytes, with repeats, joined by spaces."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            bags = [b" ".join(sorted(_found(t))).decode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(bags, pa.string())],
                                             names=["item_id", "bag"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, bag string")


class Block:
    """The items of one block: their vocabulary and, by term, the items that hold it."""

    def __init__(self, bags: list[str]):
        self.bags = sorted(bags)
        counts = [Counter(b.encode().split(b" ")) for b in self.bags]
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        holds = sorted((self.vocabulary[t], item, q) for item, c in enumerate(counts) for t, q in c.items())
        term, self.item, self.repeats = np.array(holds, np.int64).reshape(-1, 3).T
        self.begin = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        self.most = max((sum(c.values()) for c in counts), default=0)

    def vector(self, words: list[bytes]) -> bytes:
        """Term numbers and counts of a document within the vocabulary, as pairs of 32-bit numbers."""
        count = Counter(filter(self.vocabulary.__contains__, words))
        pairs = sorted((self.vocabulary[t], n) for t, n in count.items())
        return np.array(pairs, np.uint32).tobytes()

    def scores(self, vectors: list[np.ndarray], m: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of classes (rows) for items (columns)."""
        rows, wide = len(vectors), len(self.bags)
        size = [len(v) for v in vectors]
        row = np.repeat(np.arange(rows), size)
        term, tf = np.concatenate(vectors).astype(np.int64).T
        part = weight[term] * ((10**9 * tf) // (1000 * tf + 8 * m[row]))
        many = self.begin[term + 1] - self.begin[term]
        ends = np.cumsum(many)
        at = np.repeat(self.begin[term] - ends + many, many) + np.arange(ends[-1])
        cell = np.repeat(row * wide, many) + self.item[at]
        part = np.repeat(part, many) * self.repeats[at]
        if int(weight.max()) * 10**6 * self.most < EXACT:
            total = np.bincount(cell, part, rows * wide).astype(np.int64)
        else:
            total = np.zeros(rows * wide, np.int64)
            np.add.at(total, cell, part)
        return total.reshape(rows, wide)


def _bags(docs: DataFrame, shared) -> DataFrame:
    """``(doc_id, n, vector)`` of each document for one block."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        block = shared.value
        for batch in batches:
            words = (_found(t) for t in batch.column("text").to_pylist())
            got = [(len(w), block.vector(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([v for _, v in got], pa.binary())], names=["doc_id", "n", "vector"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, vector binary")


def _frequencies(bags: DataFrame, shared) -> np.ndarray:
    """Documents that hold each term of the block."""

    def run(batches):
        df = np.zeros(len(shared.value.vocabulary), np.int64)
        for batch in batches:
            raw = b"".join(batch.column("vector").to_pylist())
            df += np.bincount(np.frombuffer(raw, np.uint32)[::2], minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    counts = bags.select("vector").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(shared.value.vocabulary), np.int64)
    for r in counts.toLocalIterator():
        out[r["term"]] = r["df"]
    return out


def _best_classes(classes: DataFrame, shared, weight: np.ndarray, top: int) -> DataFrame:
    """``(item, score, m, vector, first)``: the best classes of each item, ``top`` from each task at most."""

    def run(batches):
        block: Block = shared.value
        wide = len(block.bags)
        # For each item: score, and place in `known` of its best classes so far, the best first.
        score = np.zeros((0, wide), np.int64)
        place = np.zeros((0, wide), np.int64)
        known: list = []
        for batch in batches:
            rows = list(zip(batch.column("first").to_pylist(), batch.column("m").to_pylist(),
                            batch.column("vector").to_pylist(), strict=True))
            step = max(1, PRODUCTS // max(1, wide))
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                s = block.scores([np.frombuffer(v, np.uint32).reshape(-1, 2) for _, _, v in part],
                                 np.array([m for _, m, _ in part], np.int64), weight)
                # A class that is below the last one kept for every item is out.
                least = score[top - 1] if len(score) >= top else np.zeros(wide, np.int64)
                use = np.flatnonzero(((s >= least) & (s > 0)).any(axis=1))
                if not len(use):
                    continue
                both = known + [part[k] for k in use]
                order = sorted(range(len(both)), key=lambda k: (both[k][0] is not None, both[k][0]))
                turn = np.empty(len(both), np.int64)
                turn[order] = np.arange(len(both))
                score = np.concatenate([score, s[use]])
                place = np.concatenate([place, np.broadcast_to(len(known) + np.arange(len(use))[:, None], (len(use), wide))])
                best = np.lexsort((turn[place], -score), axis=0)[:top]
                score, place = np.take_along_axis(score, best, 0), np.take_along_axis(place, best, 0)
                kept, again = np.unique(np.where(score > 0, place, place.flat[0]), return_inverse=True)
                known, place = [both[k] for k in kept], again.reshape(place.shape)
        rank, item = np.nonzero(score > 0)
        at = place[rank, item]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(score[rank, item]), pa.array([known[k][1] for k in at], pa.int64()),
             pa.array([known[k][2] for k in at], pa.binary()), pa.array([known[k][0] for k in at], first)],
            names=["item", "score", "m", "vector", "first"])

    from pyspark.sql.pandas.types import to_arrow_type

    first = to_arrow_type(classes.schema["first"].dataType)
    kind = classes.schema["first"].dataType.simpleString()
    return classes.select("first", "m", "vector").mapInArrow(
        run, f"item long, score long, m long, vector binary, first {kind}")


def _search(docs: DataFrame, bags_of_items: list[str], top: int, scratch: Scratch) -> DataFrame:
    """``(bag, rank, doc_id, score)`` for one block of items."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Block(bags_of_items))
    bags = scratch.keep(_bags(docs, shared), "bags")
    count, length = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _frequencies(bags, shared)
    weight = np.floor(1000 * np.log((2 * count + 2) / (2 * df + 1))).astype(np.int64)
    held = (bags.where(F.length("vector") > 0)
            .withColumn("m", F.expr(f"25 + cast(75 as decimal(38, 0)) * n * {count}L div {max(1, length)}L"))
            .withColumn("hash", F.xxhash64("m", "vector")))
    # Dealt by the hash; grouping by the vector itself verifies it.
    classes = held.groupBy("hash", "m", "vector").agg(F.min(F.struct("doc_id")).alias("first"))
    classes = classes.select("m", "vector", F.col("first.doc_id").alias("first"))
    best = _best_classes(classes, shared, weight, top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("first"), "m", "vector")
    best = best.withColumn("place", F.row_number().over(order)).where(f"place <= {int(top)}")
    best = scratch.keep(best.withColumn("hash", F.xxhash64("m", "vector")).drop("place", "first"), "best")
    member = Window.partitionBy("hash", "m", "vector").orderBy("doc_id")
    members = (held.join(best.select("hash", "m", "vector").distinct(), ["hash", "m", "vector"])
               .select("hash", "m", "vector", "doc_id")
               .withColumn("turn", F.row_number().over(member)).where(f"turn <= {int(top)}"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"), "hash", "turn")
    found = (members.join(best, ["hash", "m", "vector"])
             .withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(top)}"))
    names = spark.createDataFrame(list(enumerate(shared.value.bags)), "item long, bag string")
    found = scratch.keep(found.join(names, "item").select("bag", "rank", "doc_id", "score"), "found")
    for done in (bags, best):
        scratch.drop(done)
    shared.unpersist()
    return found


def ranked(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` best documents of score above 0."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    asked = scratch.keep(item_bags(items).where("bag <> ''"), "items")
    different = asked.select("bag").distinct()
    size = different.agg(F.sum(F.octet_length("bag"))).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    ids = docs.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"bag string, rank int, doc_id {ids}, score long")
    for k in range(blocks):
        part = different.where(F.pmod(F.xxhash64("bag"), F.lit(blocks)) == k) if blocks > 1 else different
        bags = [r["bag"] for r in part.toLocalIterator()]
        if bags:
            out = out.unionByName(_search(docs, bags, top, scratch))
    return asked.join(out, "bag").select("item_id", "rank", "doc_id", "score")
