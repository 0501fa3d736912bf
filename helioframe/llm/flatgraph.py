"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Equal vectors of a label collapse to one class. Centroids are fitted on a
   bounded sample (``SAMPLE`` vectors); a vector goes to every cluster whose
   border to its closest one is at most half as far as the radius allows two
   vectors to be apart, so the shards (a cluster of one label) overlap and any
   two vectors to be linked share at least one (see :func:`margins`).
2. In each shard every vector picks its neighbours from the nearest and some
   random ones by robust pruning: a candidate is dropped if a chosen neighbour
   is closer to it by a factor. Links back are added and pruned alike.
3. The adjacency lists of a vector are united over its shards.
4. Each shard is searched over the united lists for the vectors that are at
   home in it (whose closest cluster it is; the margins let one of two linked
   vectors into the other's home): a greedy beam search from the shard's
   medoid, widened until it meets the query itself, then the range is expanded
   from every vector found near the radius. Similarities are cosines in double
   precision, so what is found is verified. A pair seen from the homes of both
   is counted in the first of the two shards.
   Shards of more than ``LARGEST`` vectors have no graph: they are dealt into
   blocks by a hash, and each two blocks (a cell) are compared as a whole, so a
   large group of near copies is spread over tasks of bounded size.
5. Connected components of the links.

:func:`audit` counts the links of a bounded sample of queries against all rows
by brute force; those counts are a column of the result.

Vectors that are null or zero or hold null or non-finite components, and rows
without a label, are linked with nothing; vectors of different length are
never linked; repeated rows and rows of equal id are rows of their own; a null
id counts as larger than any other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, bound_batches, components

#: Vectors the centroids are fitted on, and most clusters.
SAMPLE, MOST_CLUSTERS = 20_000, 1024
#: Vectors of one label that a cluster is meant to hold.
SHARD = 1000
#: Vectors of a shard that one task searches, or about those of a cell of a larger shard.
LARGEST = 4096
#: Neighbours: from the nearest, from random ones; candidates of each kind.
NEAR, FAR, NEAR_CANDIDATES, FAR_CANDIDATES = 24, 8, 48, 24
ALPHA = 1.2
BEAM, WIDTH = 32, 4
#: The range is expanded from vectors this far below the radius.
SLACK = 0.02
#: Queries of the audit.
AUDITED = 256


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of unit rows."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.maximum(norm, 1e-30), c)
    return c


def margins(c: np.ndarray, radius: float) -> np.ndarray:
    """How much less than the best centroid's a centroid's product with a vector may be for the vector to join it (row: best).

    Vectors x and y of cosine ``radius`` are ``d = sqrt(2 - 2 radius)`` apart.
    With best centroids a and b, x.(a - b) + y.(b - a) = (x - y).(a - b) is at
    most d |a - b|, so one of the two is at most half of that: x joins y's
    cluster or y joins x's.
    """
    apart = np.array([np.linalg.norm(c - v, axis=1) for v in c])
    return math.sqrt(max(2 - 2 * radius, 0)) / 2 * apart + 1e-9


def robust_prune(own: np.ndarray, x: np.ndarray, candidates: np.ndarray, most: int, alpha: float = ALPHA) -> np.ndarray:
    """For vectors ``own``: which of their ``candidates`` (rows of ``x``, nearest first, -1: none) stay, at most ``most``."""
    vectors = x[candidates]
    far = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,ncd->nc", own, vectors), 0))
    between = np.sqrt(np.maximum(2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0))
    alive = candidates >= 0
    kept = np.zeros_like(alive)
    count = np.zeros(len(own), np.int64)
    for k in range(candidates.shape[1]):
        take = alive[:, k] & (count < most)
        kept[:, k] = take
        count += take
        alive &= ~(take[:, None] & (alpha * between[:, k, :] <= far))
    return kept


def build(x: np.ndarray, seed: int = 1, block: int = 256) -> list[np.ndarray]:
    """Neighbours of each row of unit vectors ``x``."""
    n = len(x)
    rng = np.random.default_rng(seed)
    lists: list[np.ndarray] = []
    near = min(NEAR_CANDIDATES, n - 1)
    if near < 1:
        return [np.empty(0, np.int64)] * n
    for a in range(0, n, block):
        rows = np.arange(a, min(a + block, n))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -3
        best = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(sims, best, axis=1), axis=1, kind="stable"), axis=1)
        kept = robust_prune(x[rows], x, best, NEAR)
        away = rng.integers(0, n, (len(rows), FAR_CANDIDATES))
        away = np.where(away == rows[:, None], -1, away)
        away = np.take_along_axis(away, np.argsort(-np.take_along_axis(sims, np.maximum(away, 0), axis=1), axis=1, kind="stable"), axis=1)
        wide = robust_prune(x[rows], x, away, FAR)
        lists += [np.union1d(best[i][kept[i]], away[i][wide[i]]) for i in range(len(rows))]
    # Links back; lists that grow too long are pruned again, a batch at a time.
    back_from = np.concatenate(lists)
    back_to = np.repeat(np.arange(n), [len(v) for v in lists])
    order = np.argsort(back_from, kind="stable")
    cut = np.searchsorted(back_from[order], np.arange(n + 1))
    lists = [np.union1d(lists[i], back_to[order[cut[i]:cut[i + 1]]]) for i in range(n)]
    most = 2 * (NEAR + FAR)
    for i in [i for i in range(n) if len(lists[i]) > most]:
        ranked = lists[i][np.argsort(-(x[lists[i]] @ x[i]), kind="stable")]
        # The nearest links stay; of the rest, those that lead elsewhere.
        kept = robust_prune(x[i:i + 1], x, ranked[None, :4 * most], most)[0]
        lists[i] = np.union1d(ranked[:NEAR], ranked[:4 * most][kept])
    return lists


#: What tells a shard, and a cell of one.
KEY = ("label", "dim", "cluster")
CELL = (*KEY, "lo", "hi")


class Shard:
    """Vectors of one shard and the united lists of neighbours among them."""

    def __init__(self, x: np.ndarray, neighbours: list[np.ndarray]):
        self.x, n = x, len(x)
        width = max([1, *map(len, neighbours)])
        self.lists = np.full((n, width), n)  # n stands for none
        for i, v in enumerate(neighbours):
            self.lists[i, :len(v)] = v
        self.entries = self._entries()

    def _entries(self) -> np.ndarray:
        """The medoid, and one vector of each part that cannot be reached from it."""
        n = len(self.x)
        seen = np.zeros(n + 1, bool)
        seen[n] = True
        entries = [int(np.argmax(self.x @ self.x.mean(axis=0)))]
        at = 0
        while True:
            frontier = np.array(entries[-1:])
            seen[frontier] = True
            while len(frontier):
                frontier = np.unique(self.lists[frontier])
                frontier = frontier[~seen[frontier]]
                seen[frontier] = True
            while at < n and seen[at]:
                at += 1
            if at == n:
                return np.array(entries)
            entries.append(at)

    def within(self, query: int, radius: float) -> np.ndarray:
        """Vectors whose cosine with the query's is ``radius`` or more, as far as found; not the query itself."""
        beam = BEAM
        while True:
            sims, seen = self._search(self.x[query], beam)
            if seen[query] or beam >= len(self.x):
                break
            beam *= 2
        n = len(self.x)
        expanded = np.zeros(n + 1, bool)
        while True:
            frontier = np.flatnonzero((sims >= radius - SLACK) & ~expanded[:n])
            if not len(frontier):
                break
            expanded[frontier] = True
            new = np.zeros(n + 1, bool)
            new[self.lists[frontier]] = True
            new = np.flatnonzero(new & ~seen)
            seen[new] = True
            sims[new] = self.x[new] @ self.x[query]
        sims[query] = -3
        return np.flatnonzero(sims >= radius)

    def _search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.x)
        seen = np.zeros(n + 1, bool)
        seen[n] = True
        sims = np.full(n, -3.0)
        ids = self.entries
        seen[ids] = True
        sims[ids] = near = self.x[ids] @ q
        open_ = np.ones(len(ids), bool)
        while open_.any():
            step = np.flatnonzero(open_)
            step = step[np.argsort(-near[step], kind="stable")[:WIDTH]]
            open_[step] = False
            new = self.lists[ids[step]].ravel()
            new = new[~seen[new]]
            if not len(new):
                continue
            new = np.unique(new)
            seen[new] = True
            sims[new] = found = self.x[new] @ q
            ids, near = np.concatenate([ids, new]), np.concatenate([near, found])
            open_ = np.concatenate([open_, np.ones(len(new), bool)])
            if len(ids) > beam:
                best = np.argpartition(-near, beam - 1)[:beam]
                ids, near, open_ = ids[best], near[best], open_[best]
        return sims, seen


class Links:
    """Counts of links and components of the vectors of a shard or cell, from blocks of linked pairs as they are found.

    A pair counts where one of the two is at home. If the homes differ and
    both shards hold both vectors, it counts in the first of the two shards.
    """

    def __init__(self, copies: list[int], clusters: list[list[int]], homes: list[int], own: int):
        n = len(copies)
        self.weight = np.array(copies, np.float64)
        self.links, self.head = np.zeros(n), np.arange(n)
        self.home = np.array(homes) == own
        # Whether a vector is in an earlier shard, and whether that is its home.
        before = sorted({h for h in homes if h < own})
        place = {c: i for i, c in enumerate(before)}
        self.member = np.zeros((n, len(before)), np.float32)
        self.from_ = np.zeros((n, len(before)), np.float32)
        for i, (cs, h) in enumerate(zip(clusters, homes, strict=True)):
            self.member[i, [place[c] for c in cs if c in place]] = 1
            if h in place:
                self.from_[i, place[h]] = 1

    def _here(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Which pairs of a vector at home (rows) and any other count in this shard."""
        return self.home[rows][:, None] & (self.member[rows] @ self.from_[columns].T == 0)

    def add(self, rows: np.ndarray, columns: np.ndarray, near: np.ndarray) -> None:
        """Pairs ``(rows[i], columns[j])`` where ``near[i, j]``; each pair comes once."""
        counted = self._here(rows, columns) & self._here(columns, rows).T \
            | self._here(rows, columns) & ~self.home[columns] | self._here(columns, rows).T & ~self.home[rows][:, None]
        here = (near & counted).astype(np.float64)
        self.links[rows] += here @ self.weight[columns]
        self.links[columns] += self.weight[rows] @ here
        for i, linked in zip(rows[near.any(axis=1)], near[near.any(axis=1)], strict=True):
            heads = self.head[columns[linked]]
            if (heads != self.head[i]).any():
                heads = np.unique(np.append(heads, self.head[i]))
                self.head[np.isin(self.head, heads)] = heads[0]


def compare(x: np.ndarray, block: np.ndarray, lo: int, hi: int, radius: float, links: Links, step: int = 256) -> None:
    """Add the linked pairs of a cell: of vectors in block ``lo`` with those in block ``hi``."""
    first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    for a in range(0, len(first), step):
        rows = first[a:a + step]
        near = x[rows] @ x[second].T >= radius
        if lo == hi:
            near &= rows[:, None] < second[None]
        links.add(rows, second, near)


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _per_shard(frame: DataFrame, columns: list[str], work, schema: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """``work(key, columns as lists)`` for each shard; yields record batches. Rows of a shard are put next to each other."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[c.strip().split(" ")[1]] for c in schema.split(",")]

    def record(columns_out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns_out, types, strict=True)], names=names)

    def run(batches):
        held, shard = None, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, *columns)), strict=True):
                if row[:len(key)] != shard:
                    if held:
                        yield record(work(shard, [list(c) for c in zip(*held, strict=True)]))
                    held, shard = [], row[:len(key)]
                held.append(row[len(key):])
        if held:
            yield record(work(shard, [list(c) for c in zip(*held, strict=True)]))

    return frame.select(*key, *columns).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _valid(vector):
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _shards(classes: DataFrame, sample: int, shard: int, overlap: float, radius: float) -> DataFrame:
    """``(nid, label, dim, cluster, clusters, home, copies, embedding)``: classes in each of their shards; ``home``: the best."""
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k = min(MOST_CLUSTERS, math.ceil(largest / shard))
    fitted: dict[int, np.ndarray] = {}
    if k > 1:
        rows = classes.select("dim", "embedding").orderBy(F.xxhash64("nid")).limit(sample).collect()
        for dim in {r["dim"] for r in rows}:
            x = _unit([r["embedding"] for r in rows if r["dim"] == dim])
            fitted[dim] = centroids(x, min(k, len(x)))
    margin = {dim: np.maximum(margins(c, radius), overlap) for dim, c in fitted.items()}

    def run(batches):
        for batch in batches:
            out, homes = [], []
            for dim, vector in zip(batch.column("dim").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                best = 0
                if dim in fitted:
                    near = fitted[dim] @ _unit([vector])[0]
                    best = int(near.argmax())
                    out.append(np.flatnonzero(near >= near[best] - margin[dim][best]).tolist())
                else:
                    out.append([0])
                homes.append(best)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64())), pa.array(homes, pa.int64())],
                                             names=[*batch.schema.names, "clusters", "home"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema) + ", clusters array<long>, home long"
    return classes.mapInArrow(run, schema).withColumn("cluster", F.explode("clusters"))


def split(sharded: DataFrame, largest: int = LARGEST) -> tuple[DataFrame, DataFrame]:
    """Shards of at most ``largest`` vectors, and the others in cells ``(lo, hi)`` of two blocks of about half as many."""
    large = (sharded.groupBy(*KEY).agg(F.count(F.lit(1)).alias("blocks")).where(F.col("blocks") > largest)
             .withColumn("blocks", F.ceil(F.col("blocks") * 2 / largest)))
    dealt = sharded.join(large, [*KEY], "left")
    cells = (dealt.where("blocks is not null").withColumn("block", F.pmod(F.xxhash64("nid"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("blocks", "other"))
    return dealt.where("blocks is null").drop("blocks"), cells


def near_duplicates(vectors: DataFrame, radius: float = 0.98, sample: int = SAMPLE, shard: int = SHARD,
                    overlap: float = 0.0, largest: int = LARGEST) -> DataFrame:
    """``(vec_id, n_links, component_id, kept, audited_links)``: one row a vector; links of cosine ``radius`` or more within a label.

    ``overlap`` is a least margin by which vectors join further clusters, on
    top of the one that the radius needs.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    vectors = vectors.select("vec_id", "label", "embedding")
    usable = F.col("label").isNotNull() & _valid(F.col("embedding"))
    classes = scratch.keep(
        vectors.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .withColumns({"dim": F.size("embedding").cast("long"), "nid": F.monotonically_increasing_id()}), "vectors")
    sharded, cells = split(scratch.keep(_shards(classes, sample, shard, overlap, radius), "shards"), largest)

    def neighbours(_, columns):
        nid, vector = columns
        ids = np.array(nid, np.int64)
        return nid, [ids[v] for v in build(_unit(vector))]

    graph = _per_shard(sharded, ["nid", "embedding"], neighbours, "nid long, neighbours array<long>")
    united = graph.groupBy("nid").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))

    def search(key, columns):
        nid, vector, copies, clusters, homes, neighbours_ = columns
        place = {v: i for i, v in enumerate(nid)}
        graph_ = Shard(_unit(vector), [np.array([place[v] for v in vs or () if v in place], np.int64) for vs in neighbours_])
        every = np.arange(len(nid))
        near = np.zeros((len(nid), len(nid)), bool)
        # A link is seen from the home of one of its vectors at least (see margins), so only those search.
        for i in np.flatnonzero(np.array(homes) == key[2]):
            near[i, graph_.within(i, radius)] = True
        near = np.triu(near | near.T)  # found from either side
        links = Links(copies, clusters, homes, key[2])
        for a in range(0, len(nid), 256):
            links.add(every[a:a + 256], every, near[a:a + 256])
        return nid, links.links.astype(np.int64), np.array(nid, np.int64)[links.head]

    def cell(key, columns):
        nid, vector, copies, clusters, homes, block = columns
        links = Links(copies, clusters, homes, key[2])
        compare(_unit(vector), np.array(block, np.int64), *key[3:], radius, links)
        # Cells of one block give a row for each vector, the others for linked ones.
        told = np.flatnonzero((key[3] == key[4]) | (links.links > 0) | (links.head != np.arange(len(nid))))
        ids = np.array(nid, np.int64)
        return ids[told], links.links[told].astype(np.int64), ids[links.head[told]]

    out = "nid long, links long, head long"
    searched = _per_shard(sharded.join(united, "nid", "left"), ["nid", "embedding", "copies", "clusters", "home", "neighbours"], search, out)
    compared = _per_shard(cells, ["nid", "embedding", "copies", "clusters", "home", "block"], cell, out, CELL)
    found = scratch.keep(searched.unionAll(compared), "found")
    counts = found.groupBy("nid").agg(F.sum("links").alias("links"))
    linked = components(spark, found.where("nid <> head").select(F.col("nid").alias("a"), F.col("head").alias("b")))
    each = (classes.join(counts, "nid").join(linked, F.col("nid") == F.col("node"), "left")
            .withColumns({"root": F.coalesce("component", "nid"), "n_links": F.col("links") + F.col("copies") - 1}))
    least = each.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    each = each.join(least, "root").select("label", "embedding", "n_links", "component_id")
    audited = audit(vectors.where(usable), classes, radius)
    # Null labels and vectors meet nothing here and keep themselves.
    return (vectors.join(each, ["label", "embedding"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
            .join(audited, "vec_id", "left"))


def audit(vectors: DataFrame, classes: DataFrame, radius: float, queries: int = AUDITED) -> DataFrame:
    """``(vec_id, audited_links)``: links of at most ``queries`` vectors, by brute force against all classes."""
    spark = vectors.sparkSession
    asked = (classes.where("vec_id is not null").select("vec_id", "label", "dim", "embedding")
             .orderBy(F.xxhash64("vec_id")).limit(queries).collect())
    by_key: dict = {}
    for r in asked:
        by_key.setdefault((r["label"], r["dim"]), []).append(r)
    held = {key: ([r["vec_id"] for r in rows], _unit([r["embedding"] for r in rows])) for key, rows in by_key.items()}

    def run(batches):
        for batch in batches:
            rows: dict = {}
            for label, dim, vector, copies in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "embedding", "copies")), strict=True):
                if (label, dim) in held:
                    rows.setdefault((label, dim), []).append((vector, copies))
            ids, links = [], []
            for key, got in rows.items():
                own, x = held[key]
                near = x @ _unit([v for v, _ in got]).T >= radius
                ids += own
                links += (near @ np.array([c for _, c in got], np.int64)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64())], names=["vec_id", "links"])

    counted = classes.select("label", "dim", "embedding", "copies").mapInArrow(run, "vec_id long, links long")
    return counted.groupBy("vec_id").agg((F.sum("links") - 1).alias("audited_links"))


def recall(result: DataFrame) -> float:
    """Links found of the audited ones; 1 if those have none."""
    row = result.where("audited_links is not null").agg(
        F.sum(F.least("n_links", "audited_links")).alias("found"), F.sum("audited_links").alias("all")).first()
    return float(row["found"] / row["all"]) if row["all"] else 1.0
