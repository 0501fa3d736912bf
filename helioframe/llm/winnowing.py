"""Document fingerprints by winnowing.

Every k-gram of code points is hashed with a rolling polynomial; of each
window of grams the least hash is chosen, the rightmost on ties. Any two texts
that share ``k + window - 1`` code points in a row share a chosen gram, and
the kept positions tell where.

:func:`with_next` puts each document beside the next one by ``doc_id`` with
one shuffle of the texts: rows are cut into ranges of ids, each range also
gets the first row of the range after it, and a sorted stream holds one row
back.

Null and empty texts have no code points and an empty fingerprint. A text
shorter than ``k`` is a single gram. Null ids come first; rows of equal id
follow each other by a hash of the text; after the last row comes the first
(a single row follows itself). An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from helioframe.llm.common import bound_batches

K = 16
WINDOW = 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 15


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """48-bit hashes of all k-grams: polynomials of doubling length, joined to length ``k``."""
    size, power = 1, _BASE
    part = codes.astype(np.uint64) + np.uint64(1)
    out, out_size = None, 0
    left = k
    while left:
        if left & 1:
            # Grams of ``out`` followed by grams of ``part``.
            out = part if out is None else out[:len(out) - size] * np.uint64(power) + part[out_size:]
            out_size += size
        left >>= 1
        if left:
            part = part[:len(part) - size] * np.uint64(power) + part[size:]
            size, power = 2 * size, power * power & (1 << 64) - 1
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
        out = out ^ (out >> np.uint64(shift))
        out *= np.uint64(factor)
    return out >> np.uint64(16)


def sliding_minimum(x: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each window, from running minima of blocks of ``window`` from both sides."""
    n = len(x)
    blocks = np.full(-(-n // window) * window, np.iinfo(x.dtype).max, x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - window + 1], ahead[window - 1:n])


def winnow(codes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions."""
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = gram_hashes(codes, min(k, len(codes)))
    window = min(window, len(grams))
    chosen = []
    for start in range(0, len(grams) - window + 1, _BLOCK):
        block = grams[start:start + _BLOCK + window - 1]
        # Low bits fall with the position, so that the least key is the rightmost of the least hashes.
        key = (block << np.uint64(16)) | (np.uint64(0xFFFF) - np.arange(len(block), dtype=np.uint64))
        least = sliding_minimum(key, window)
        at = start + 0xFFFF - (least[np.flatnonzero(np.diff(least, prepend=~least[:1]))] & np.uint64(0xFFFF)).astype(np.int64)
        chosen.append(at)
    at = np.concatenate(chosen)
    at = at[np.diff(at, prepend=-1) != 0]
    return grams[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    return ",".join([f"{h:x}:{p}" for h, p in zip(hashes.tolist(), positions.tolist(), strict=True)])


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_chars, hashes, positions)`` of each document."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            codes = [code_points(t or "") for t in batch.column("text").to_pylist()]
            got = [winnow(c, k, window) for c in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(c) for c in codes], pa.int64()),
                 pa.array([h.astype(np.int64) for h, _ in got], pa.list_(pa.int64())),
                 pa.array([p for _, p in got], pa.list_(pa.int64()))],
                names=["doc_id", "n_chars", "hashes", "positions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_chars long, hashes array<long>, positions array<long>")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: first among every n-th, then among n."""
    if not bounds:
        return F.lit(0)
    n = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i:i + n] for i in range(0, len(bounds), n)]
    head = F.size(F.filter(F.lit([g[0] for g in groups]), lambda b: b <= key))
    ranges = F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in groups])
    inside = F.size(F.filter(F.element_at(ranges, F.greatest(head, F.lit(1))), lambda b: b <= key))
    return F.when(head == 0, 0).otherwise((head - 1) * n + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """``(range, edge, doc_id, text)`` sorted within each range; the ``edge`` row closes a range.

    The driver holds one id for each range: four a shuffle partition.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text").withColumn("order", F.xxhash64(F.coalesce("text", F.lit(""))))
    if isinstance(docs.schema["doc_id"].dataType, T.NumericType):
        cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
    else:
        some = docs.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id")).limit(64 * ranges)
        some = sorted(r["doc_id"] for r in some.collect())
        cuts = some[::64][1:]
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), sorted(set(cuts or []))))
    firsts = sorted((r["range"], r["first"]) for r in rows.groupBy("range").agg(F.min(F.struct("doc_id", "order")).alias("first")).collect())
    edges = [(first["doc_id"], first["order"], firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    kind = T.StructType([docs.schema["doc_id"], T.StructField("order", T.LongType()), T.StructField("before", T.IntegerType())])
    edges = spark.createDataFrame(edges, kind).withColumnsRenamed({"doc_id": "edge_id", "order": "edge_order"})
    rows = rows.join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("edge_id")) & (F.col("order") == F.col("edge_order")), "left")
    own, other = F.struct("range", F.lit(False).alias("edge")), F.struct(F.col("before").alias("range"), F.lit(True).alias("edge"))
    return (rows.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, other))))
            .select("to.range", "to.edge", "doc_id", "order", "text")
            .repartition("range").sortWithinPartitions("range", "edge", "doc_id", "order")
            .select("range", "edge", "doc_id", "text"))


def edited_likeness(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they and the next document are.

    The edited text has its last ``n_chars // 2`` code points replaced by the
    first as many of the next document.
    """
    bound_batches(docs.sparkSession)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None
        for batch in batches:
            out: list[tuple] = []
            for part, edge, doc, text in zip(*(batch.column(c).to_pylist() for c in ("range", "edge", "doc_id", "text")), strict=True):
                if held and held[0] != part:
                    held = None
                if edge and not held:
                    continue
                text = text or ""
                now = (part, doc, text, winnow(code_points(text), k, window))
                if held:
                    _, own, before, mark = held
                    half = len(before) // 2
                    edited = before[:len(before) - half] + text[:half]
                    other = winnow(code_points(edited), k, window)
                    out.append((own, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                written(*mark), written(*other), likeness(mark[0], other[0]), likeness(mark[0], now[3][0])))
                held = None if edge else now
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    types = [to_arrow_type(docs.schema["doc_id"].dataType),
             pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_next(docs).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
