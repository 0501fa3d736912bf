"""MLlib's regression trees on many rows, grown in passes over packed rows.

An MLlib fit turns every row into objects three times and keeps some 100 bytes
of it, for every member of a bag and every round of a boosting anew. Beyond
``ROWS_PER_TASK`` rows the features and labels are instead written once, many
rows' bytes in one row. A level of all trees is one pass: each task walks its
rows down the trees and sums count, weight and label by (open node, feature,
bin) with NumPy; Spark adds the sums up and the driver chooses the splits. A
pass sums ``CELLS`` cells at most, further open nodes wait for the next one.

Cuts, splits and stops follow MLlib: the cuts of a feature are the midpoints of
its values in a sample, or ``max_bins - 1`` of them with like weight between; the
cut that lowers the variance most is taken, the first of equal ones; a node of
no gain is a leaf. The rows of a member are drawn as ``DataFrame.sample`` draws
them, by a hash of its seed and the row's position in the packed table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.draws import mixed, uniform
from helioframe.models.trees import Tree
from helioframe.session import discard, materialize

#: Bytes of features and labels in a row of the packed table, and rows walked down at once.
PACKED, PART = 16_384, 32_768
#: Sums of a pass.
CELLS = 1 << 20
#: Relative difference within which two splits are equally good.
TIE = 1e-12


@dataclass
class Packed:
    """``id``, ``x``, ``y`` and perhaps weights ``w``, as bytes; ``sample``: features and label of some rows."""

    df: DataFrame
    path: str
    n: int
    width: int
    sample: np.ndarray

    def drop(self) -> None:
        discard(self.df.sparkSession, self.path)

    @property
    def center(self) -> float:
        """Sums are taken of labels less this one."""
        return float(self.sample[:, -1].mean())


@dataclass(frozen=True)
class Member:
    """What a tree is grown from: its features, and its draws of the rows (``rate`` None: each row once)."""

    features: tuple[int, ...]
    max_depth: int
    min_leaf: int = 1
    rate: float | None = None
    again: bool = False
    seed: int = 0

    def draws(self, hashed: np.ndarray) -> np.ndarray:
        """How often each row counts, from hashes of the rows' positions."""
        u = uniform(mixed(hashed, self.seed))
        if not self.again:
            return (u < self.rate).astype(np.int64)
        terms = [math.exp(-self.rate)]
        while terms[-1] > 1e-18:
            terms.append(terms[-1] * self.rate / len(terms))
        return np.searchsorted(np.cumsum(terms), u, side="right")


@dataclass(frozen=True)
class Step:
    """A round of AdaBoost.R2: how it changes the weights."""

    tree: Tree
    total: float
    beta: float
    most: float
    rate: float

    def weights(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        loss = np.abs(y - self.tree.predict(x)) / self.most
        return w / self.total * self.beta ** ((1.0 - loss) * self.rate)


def pack(data: DataFrame, features: str, label: str, n: int, wanted: int, seed: int, weight: float | None = None) -> Packed:
    """Write the rows and sample some ``wanted`` of them; ``weight``: of every row, if they are to have one."""
    rows = data.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    width = len(rows.first()[0])
    step = max(1, PACKED // (8 * (width + 1)))

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype("<f8")
            y = batch.column("y").to_numpy(zero_copy_only=False).astype("<f8")
            if not (np.isfinite(x).all() and np.isfinite(y).all()):
                raise ValueError("features and labels must not be null, NaN or infinite")
            held = {"x": x, "y": y} | ({} if weight is None else {"w": np.full(len(y), weight, "<f8")})
            yield pa.RecordBatch.from_pydict(
                {c: pa.array([v[i:i + step].tobytes() for i in range(0, len(y), step)], pa.binary()) for c, v in held.items()})

    kinds = "x binary, y binary" + ("" if weight is None else ", w binary")
    out, path = materialize(rows.mapInArrow(run, kinds).withColumn("id", F.monotonically_increasing_id()), "packed-rows")
    share = min(1.0, wanted / n)

    def some(batches):
        for hashed, x, y, _ in _parts(batches, width):
            at = np.flatnonzero(uniform(mixed(hashed, seed, 1)) < share)
            yield pa.RecordBatch.from_arrays([pa.array([np.column_stack([x[at], y[at]]).tobytes()])], names=["r"])

    got = out.mapInArrow(some, "r binary").collect()
    return Packed(out, path, n, width, np.frombuffer(b"".join(sorted(bytes(r[0]) for r in got)), "<f8").reshape(-1, width + 1))


def _parts(batches, width: int):
    """Hashes of positions, features, labels and weights of ``PART`` rows at a time."""
    for batch in batches:
        held = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f8") for c in ("x", "y", "w") if c in batch.schema.names}
        sizes = np.array([len(v) // 8 for v in batch.column("y").to_pylist()], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        ids = batch.column("id").to_numpy().astype(np.int64)
        x, y, w = held["x"].reshape(-1, width), held["y"], held.get("w")
        place = np.repeat(ids * PACKED - first, sizes) + np.arange(len(y))
        for i in range(0, len(y), PART):
            part = slice(i, i + PART)
            yield mixed(place[part]), x[part], y[part], None if w is None else w[part]


def _weighted(x, y, w, steps: list[Step]):
    for s in steps:
        w = s.weights(x, y, w)
    return w


def cuts(sample: np.ndarray, max_bins: int, weight: np.ndarray | None = None) -> list[np.ndarray]:
    """The cuts of each feature of a sample of rows."""
    return [_cuts(v, np.ones(len(v)) if weight is None else weight, max_bins - 1) for v in sample.T]


def _cuts(values: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    v, place = np.unique(values, return_inverse=True)
    half = (v[1:] + v[:-1]) / 2
    if len(half) <= most:
        return half
    running = np.cumsum(np.bincount(place, weight))
    stride = running[-1] / (most + 1)
    out, target = [], stride
    for k in range(len(half)):
        if abs(running[k] - target) < abs(running[k + 1] - target):
            out.append(half[k])
            target += stride
    return np.array(out)


def grow(rows: Packed, bounds: list[np.ndarray], members: list[Member], steps: list[Step] = ()) -> list[Tree]:
    """A tree for each member over the features' cuts, levels of all of them in shared passes; ``steps`` change the rows' weights before."""
    deep = max(map(len, bounds)) + 1
    trees = [Tree([-1], [0.0], [0], [0], [0.0]) for _ in members]
    depth = [[0] for _ in members]
    waiting = [(m, 0) for m in range(len(members))]
    while waiting:
        following: list[tuple[int, int]] = []
        while waiting:
            group, cells = [], 0
            while waiting and (not group or cells + len(members[waiting[0][0]].features) * deep <= CELLS):
                group.append(waiting.pop(0))
                cells += len(members[group[-1][0]].features) * deep
            following += _level(rows, bounds, members, trees, depth, group, list(steps))
        waiting = sorted(following)
    return trees


def _level(rows: Packed, bounds, members, trees, depth, group, steps) -> list[tuple[int, int]]:
    """One pass: splits the group's nodes (member, node); their children that are open."""
    of: dict[int, list[int]] = {}
    for m, node in group:
        of.setdefault(m, []).append(node)
    state, begin, deep = [], 0, max(map(len, bounds)) + 1
    for m, nodes in of.items():
        slot = np.full(len(trees[m].feature), -1)
        slot[nodes] = np.arange(len(nodes))
        state.append((members[m], trees[m], slot, begin, len(nodes) * len(members[m].features) * deep))
        begin += state[-1][-1]
    shared = rows.df.sparkSession.sparkContext.broadcast((state, steps, rows.center, bounds))
    width, total = rows.width, begin

    def run(batches):
        state, steps, center, bounds = shared.value
        sums = np.zeros((3, total))
        for hashed, x, y, w in _parts(batches, width):
            w, y = _weighted(x, y, w, steps), y - center
            bins = np.column_stack([np.searchsorted(cut, v, side="left") for cut, v in zip(bounds, x.T)])
            for member, tree, slot, at, size in state:
                _add(sums[:, at:at + size], member, tree, slot, hashed, x, bins, deep, y, w)
        held = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(s[held]) for s in sums)], names=["cell", "c", "w", "s"])

    got = (rows.df.mapInArrow(run, "cell long, c double, w double, s double").groupBy("cell")
           .agg(*[F.sum(c).alias(c) for c in ("c", "w", "s")]).toArrow())
    shared.unpersist()
    sums = np.zeros((3, total))
    sums[:, got.column("cell").to_numpy()] = [got.column(c).to_numpy() for c in ("c", "w", "s")]
    following = []
    for (m, nodes), (member, tree, _, at, size) in zip(of.items(), state):
        mine = sums[:, at:at + size].reshape(3, len(nodes), len(member.features), deep)
        following += [(m, k) for k in _split(member, bounds, tree, depth[m], nodes, *mine, rows.center)]
    return following


def _add(sums, member: Member, tree: Tree, slot, hashed, x, bins, deep: int, y, w) -> None:
    """Add a tree's rows to its sums by (open node, feature, bin)."""
    at, count = slice(None), None
    if member.rate is not None:
        count = member.draws(hashed)
        at = np.flatnonzero(count)
    front = slot[tree.nodes(x[at][:, list(member.features)])]
    if len(front) and front.min() < 0:
        still = np.flatnonzero(front >= 0)
        front, at = front[still], still if count is None else at[still]
    y, count, w = (None if v is None else v[at] for v in (y, count, w))
    weight = count if w is None else w if count is None else w * count
    label = y if weight is None else y * weight
    size = sums.shape[1]
    for f, feature in enumerate(member.features):
        key = (front * len(member.features) + f) * deep + bins[at, feature]
        counted = np.bincount(key, count, size)
        sums[0] += counted
        sums[1] += counted if w is None else np.bincount(key, weight, size)
        sums[2] += np.bincount(key, label, size)


def _split(member: Member, bounds, tree: Tree, depth: list[int], nodes: list[int], c, w, s, center: float) -> list[int]:
    """Note the nodes' means and split those that gain by it; the children that may be split."""
    all_c, all_w, all_s = (v[:, :1].sum(axis=2, keepdims=True) for v in (c, w, s))
    left_c, left_w, left_s = (np.cumsum(v, axis=2) for v in (c, w, s))
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = all_s ** 2 / all_w
        gain = left_s ** 2 / left_w + (all_s - left_s) ** 2 / (all_w - left_w)
    least = max(member.min_leaf, 1)
    good = (left_c >= least) & (all_c - left_c >= least) & (left_w > 0) & (all_w - left_w > 0) & (gain > whole * (1 + TIE))
    gain = np.where(good, gain, -np.inf).reshape(len(nodes), -1)
    # Sums may differ in the last places with the order of addition: the first cut that is as good counts.
    most = gain.max(axis=1, keepdims=True)
    best = (gain >= np.where(np.isfinite(most), most * (1 - TIE), most)).argmax(axis=1)
    following = []
    for k, node in enumerate(nodes):
        total, weight, label = (float(v[k, 0, 0]) for v in (all_c, all_w, all_s))
        tree.value[node] = center + (label / weight if weight else 0.0)
        if most[k, 0] == -np.inf or depth[node] >= member.max_depth:
            continue
        f, cut = divmod(int(best[k]), c.shape[2])
        lc, lw, ls = (float(v[k, f, cut]) for v in (left_c, left_w, left_s))
        tree.feature[node], tree.threshold[node] = f, float(bounds[member.features[f]][cut])
        for own, (count, part, mean) in zip((tree.left, tree.right), ((lc, lw, ls), (total - lc, weight - lw, label - ls))):
            own[node] = len(tree.feature)
            tree._add(-1, 0.0, center + mean / part)
            depth.append(depth[node] + 1)
            if depth[-1] < member.max_depth and count >= 2 * least:
                following.append(own[node])
    return following


def errors(rows: Packed, tree: Tree, steps: list[Step]) -> tuple[float, float, float]:
    """Largest absolute error of a tree, the weighted sum of its errors, and the sum of weights."""
    width = rows.width

    def run(batches):
        for _, x, y, w in _parts(batches, width):
            w, e = _weighted(x, y, w, steps), np.abs(y - tree.predict(x))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (e.max(), w @ e, w.sum())], names=["m", "e", "w"])

    return tuple(rows.df.mapInArrow(run, "m double, e double, w double").agg(F.max("m"), F.sum("e"), F.sum("w")).first())


def reweighted(rows: Packed, steps: list[Step]) -> Packed:
    """The rows written anew with their weights after ``steps``; the table before is dropped."""
    width = rows.width

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                x, y, w = (np.frombuffer(one.column(c)[0].as_py(), "<f8") for c in ("x", "y", "w"))
                w = _weighted(x.reshape(-1, width), y, w, steps)
                yield one.set_column(one.schema.get_field_index("w"), "w", pa.array([w.tobytes()], pa.binary()))

    df, path = materialize(rows.df.select("x", "y", "w", "id").mapInArrow(run, "x binary, y binary, w binary, id long"), "packed-rows")
    rows.drop()
    return replace(rows, df=df, path=path)
