"""Regression trees grown for many fits in shared passes over binned rows.

Features are binned once: a feature of at most ``max_bins`` different values
keeps them all, so its splits are exact; others get quantile bins. Then every
tree of every fit (candidate, fold, member) grows at the same time. A level is
one pass: each task walks its rows down all trees and sums count, weight and
label by (open node, feature, bin) with NumPy; Spark adds the sums up, the best
split of each node is chosen from them next to the data, and the driver gets
one row for each node. A node with at most ``SMALL`` rows (fewer where that many
would leave tasks idle) is not opened again: in a last pass the rows of all such
nodes are brought together, packed as bytes, and each subtree is finished where
its rows are. There the rows of a node lie next to each other, so a level costs
the same for a row whatever the depth, and only the features tried at a node are
counted. So the number of Spark jobs grows with the logarithm of the rows, not
with fits, trees or depth.

Depth is unlimited unless a fit limits it. A node is split if its rows differ
in the label, number at least ``min_split``, and some split leaves ``min_leaf``
rows on both sides (rows, not draws). With ``extra`` the cut of a feature is
drawn between the least and greatest value of the node, and the best of the
drawn cuts is taken. All draws are hashes of the fit's seed and the node's
path, so they do not depend on the partitioning or on where a node is grown.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.draws import Sample, mixed, uniform
from helioframe.models.trees import Tree
from helioframe.operators.rows import with_row_index
from helioframe.session import discard, materialize

#: Rows of a node from which on its subtree is finished in one task, and cells (rows by features) of such a node.
SMALL, SMALL_CELLS = 1 << 21, 1 << 24
#: Rows of a node that is finished in one task even where that leaves others idle.
LEAST = 16_384
#: Rows of neighbouring nodes of a level that are split together: they stay in the processor's cache.
PART = 1 << 16
#: Positions whose rows are scored together: of all trees of a block.
CHUNK = 1 << 12
#: Trees of equal rows at most that are finished from one copy of them.
SHARING = 8
#: Trees grown at the same time.
TREES = 4_000
#: Rows whose sums a task gives back together, and cells for each of a node's values up to which they are counted densely.
GATHERED, DENSE = 1 << 17, 4
NO_LIMIT = 1 << 30
#: Relative difference within which two splits are equally good.
TIE = 1e-12


@dataclass(frozen=True)
class Fit:
    """What one tree is grown from. ``held``: the fold left out; ``column``: its place in the rows' ``counts``."""

    seed: int = 0
    held: int | None = None
    sample: tuple[float, bool] | None = None      # share of the rows, with replacement
    bootstrap: bool = False                       # as many draws again from that sample
    column: int | None = None
    max_depth: int = NO_LIMIT
    min_split: int = 2
    min_leaf: int = 1
    features: tuple[int, ...] | None = None       # of all features
    tried: int | None = None                      # of these, at each node
    extra: bool = False
    sample_seed: int | None = None                # trees with the same one share the first sample


@dataclass
class Binned:
    """Rows ready for growing: ``idx``, ``fold``, ``y``, ``bins`` (two bytes a feature) and perhaps ``counts``."""

    df: DataFrame
    n: int
    edges: list[np.ndarray]                       # greatest value of each bin
    exact: list[bool]
    bounds: dict[int, tuple[int, int]] = field(default_factory=dict)   # positions of each fold
    paths: list[str] = field(default_factory=list)

    def drop(self) -> None:
        for path in self.paths:
            discard(self.df.sparkSession, path)

    def with_counts(self, df: DataFrame) -> Binned:
        return replace(self, df=df, paths=[])

    def rows_of(self, fit: Fit) -> int:
        low, high = self.bounds.get(fit.held, (0, 0))
        return self.n - (high - low)


def bin_edges(rows: DataFrame, width: int, max_bins: int) -> tuple[list[np.ndarray], list[bool]]:
    """For each feature (of the array ``x``) its different values, or ``max_bins`` quantiles if there are more."""

    def run(batches):
        seen: list = [np.empty(0)] * width
        for batch in batches:
            column = batch.column("x")
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            # More than max_bins values are as good as max_bins + 1 of them: the feature gets quantiles.
            seen = [np.unique(np.concatenate([s, v]))[:max_bins + 1] for s, v in zip(seen, values.T)]
        number = np.repeat(np.arange(width), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.concatenate(seen))], names=["f", "v"])

    values = (rows.select("x").mapInArrow(run, "f long, v double").groupBy("f")
              .agg(F.slice(F.array_sort(F.collect_set("v")), 1, max_bins + 1).alias("v")))
    got = {r["f"]: np.array(r["v"]) for r in values.collect()}
    edges = [got[f] for f in range(width)]
    exact = [len(e) <= max_bins for e in edges]
    if not all(exact):
        wide = [f for f in range(width) if not exact[f]]
        cols = rows.select(*[F.col("x")[f].alias(f"f{f}") for f in wide])
        shares = [k / max_bins for k in range(1, max_bins)]
        for f, q in zip(wide, cols.approxQuantile([f"f{f}" for f in wide], shares, 0.25 / max_bins)):
            edges[f] = np.concatenate([np.unique(q), [np.inf]])
    return edges, exact


def binned(df: DataFrame, features: str, label: str, fold: str | None = None, order: list[str] | None = None,
           max_bins: int = 256) -> Binned:
    """Bin the rows and give each its position, the rows of a fold next to each other.

    Positions follow ``order``; without it they follow the features and the
    label, so that equal inputs get equal samples.
    """
    places = {c: f"__order{k}" for k, c in enumerate(order or [])}
    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
                     *[F.col(c).alias(name) for c, name in places.items()])
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to grow trees from")
    width = first[0]
    edges, exact = bin_edges(rows, width, max_bins)
    laid = with_row_index(rows, ["fold", *(places.values() or ["x", "y"])])

    def run(batches):
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.column_stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, values.T)])
            raw = bins.astype("<u2").tobytes()
            step = 2 * width
            yield pa.RecordBatch.from_arrays(
                [batch.column("idx"), batch.column("fold"), batch.column("y"),
                 pa.array([raw[i:i + step] for i in range(0, len(raw), step)], pa.binary())],
                names=["idx", "fold", "y", "bins"])

    out, path = materialize(laid.df.select("idx", "fold", "y", "x")
                            .mapInArrow(run, "idx long, fold int, y double, bins binary"), "binned")
    discard(df.sparkSession, laid.path)
    bounds = {r["fold"]: (r["low"], r["high"] + 1) for r in
              out.groupBy("fold").agg(F.min("idx").alias("low"), F.max("idx").alias("high")).collect()}
    return Binned(out, laid.n, edges, exact, bounds if fold else {}, [path])


class Growing:
    """A tree under way: children, cuts and sums of its nodes; ``key`` seeds the draws of a node."""

    def __init__(self, fit: Fit):
        self.fit = fit
        self.feature, self.cut, self.threshold = [-1], [0], [0.0]
        self.left, self.right, self.value, self.depth = [0], [0], [0.0], [0]
        self.key = [int(mixed(fit.seed))]

    def split(self, node: int, feature: int, cut: int, threshold: float, means: tuple[float, float]) -> tuple[int, int]:
        children = (len(self.feature), len(self.feature) + 1)
        self.feature[node], self.cut[node], self.threshold[node] = feature, cut, threshold
        self.left[node], self.right[node] = children
        for side, mean in enumerate(means):
            self.feature.append(-1)
            self.cut.append(0)
            self.threshold.append(0.0)
            self.left.append(0)
            self.right.append(0)
            self.value.append(mean)
            self.depth.append(self.depth[node] + 1)
            self.key.append(int(mixed(self.key[node], side + 1)))
        return children

    def graft(self, node: int, sub: dict) -> None:
        """Put a finished subtree in the place of a leaf."""
        base, more = len(self.feature), len(sub["feature"]) - 1
        at = np.concatenate([[node], np.arange(base, base + more)])
        for name in ("feature", "cut", "threshold", "value"):
            own = getattr(self, name)
            own[node] = sub[name][0]
            own.extend(sub[name][1:])
        for name in ("left", "right"):
            own, here = getattr(self, name), at[sub[name]].tolist()
            own[node] = here[0]
            own.extend(here[1:])
        self.depth.extend([0] * more)
        self.key.extend([0] * more)

    def arrays(self) -> tuple:
        """For :func:`walk`: features, cuts, children and means."""
        return tuple(map(np.array, (self.feature, self.cut, self.left, self.right, self.value)))

    def tree(self, by_bins: bool = False) -> Tree:
        """For rows of feature values, or for rows of bins."""
        return Tree(list(self.feature), [float(c) for c in self.cut] if by_bins else list(self.threshold),
                    list(self.left), list(self.right), list(self.value))


def walk(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """The node that each row of bins comes to."""
    feature, cut, left, right = tree[:4]
    child = np.column_stack([right, left]).ravel()
    values, begin = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
    at, rows, node = np.zeros(len(bins), np.int64), np.arange(len(bins)), np.zeros(len(bins), np.int64)
    while len(rows):
        split = feature[at]
        inner = split >= 0
        if not inner.all():
            node[rows[~inner]] = at[~inner]
            rows, at, begin, split = rows[inner], at[inner], begin[inner], split[inner]
        at = child[2 * at + (values[begin + split] <= cut[at])]
    return node


def _weights(fit: Fit, n: int, bounds: dict, idx: np.ndarray, fold: np.ndarray, counts) -> np.ndarray:
    """How often each row counts for a fit."""
    if fit.column is not None:
        return counts[:, fit.column]
    if fit.held is None:
        position, inside = idx, None
    else:
        low, high = bounds.get(fit.held, (0, 0))
        inside = fold != fit.held
        position, n = np.where(idx < low, idx, idx - (high - low))[inside], n - (high - low)
    if fit.sample is None and not fit.bootstrap:
        got = np.ones(len(position), np.int64)
    else:
        got = _sample(fit, n).counts(position)
    if inside is None:
        return got
    out = np.zeros(len(idx), np.int64)
    out[inside] = got
    return out


def _sample(fit: Fit, n: int) -> Sample:
    share, again = fit.sample or (1.0, False)
    first = None
    if fit.sample:
        seed = int(mixed(fit.seed if fit.sample_seed is None else fit.sample_seed, 7))
        first = Sample(n, max(1, int(share * n)), again, seed)
    if not fit.bootstrap:
        return first
    size = first.size if first else n
    return Sample(size, size, True, int(mixed(fit.seed, 8)), first)


def choose(node, feature, bins, count, weight, label, low, high, fits: list[Fit], keys, edges, exact) -> dict:
    """The best split of each node from its sums by feature and bin.

    Rows are sorted by node, feature and bin; ``fits`` and ``keys`` are by node
    number. Ties go to the lowest feature, then the lowest cut.
    """
    start = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])]))
    end = np.concatenate([start[1:], [len(node)]])
    group = np.repeat(np.arange(len(start)), end - start)
    group_node, group_feature = node[start], feature[start]

    def running(v):
        total = np.cumsum(v)
        return total - np.concatenate([[0], total])[start][group]

    c, w, s = running(count), running(weight), running(label)
    last = end - 1
    nodes, first_group = np.unique(group_node, return_index=True)
    place = np.searchsorted(nodes, node)
    of_node = first_group[place]
    all_c, all_w, all_s = c[last][of_node], w[last][of_node], s[last][of_node]
    bottom = np.minimum.reduceat(low, start)[first_group]
    top = np.maximum.reduceat(high, start)[first_group]
    own = [fits[k] for k in nodes]
    least_split = np.array([f.min_split for f in own])
    least_leaf = np.array([f.min_leaf for f in own])

    good = np.ones(len(node), bool)
    good[last] = False
    good &= (c >= least_leaf[place]) & (all_c - c >= least_leaf[place])
    good &= ((bottom < top) & (c[last][first_group] >= least_split))[place]
    # Of the features that differ within a node, those with the least hashes are tried.
    tried = np.array([f.tried or NO_LIMIT for f in own])
    if (tried < NO_LIMIT).any():
        node_place = np.searchsorted(nodes, group_node)
        hashed = mixed(np.asarray(keys, np.uint64)[group_node], group_feature + 16)
        turn = np.full(len(start), NO_LIMIT)
        differs = np.flatnonzero(end - start > 1)
        order = differs[np.lexsort((hashed[differs], node_place[differs]))]
        begins = np.searchsorted(node_place[order], np.arange(len(nodes)))
        turn[order] = np.arange(len(order)) - begins[node_place[order]]
        good &= (turn < tried[node_place])[group]
    if any(f.extra for f in own):
        value = np.empty(len(node))
        for f in np.unique(feature):
            at = feature == f
            e = np.where(np.isinf(edges[f]), edges[f][max(len(edges[f]) - 2, 0)], edges[f])
            value[at] = e[bins[at]]
        hashed = mixed(np.asarray(keys, np.uint64)[group_node], group_feature + 4096)
        drawn = (value[start] + uniform(hashed) * (value[last] - value[start]))[group]
        following = np.concatenate([value[1:], [np.inf]])
        extra = np.array([f.extra for f in own])[place]
        good &= ~extra | ((value <= drawn) & (following > drawn))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(good, s * s / w + (all_s - s) ** 2 / (all_w - w), -np.inf)
    gain[np.isnan(gain)] = -np.inf
    # Sums may differ in the last places with the order of addition: the first cut that is as good counts.
    begin = np.searchsorted(node, nodes)
    most = np.maximum.reduceat(gain, begin)
    enough = np.flatnonzero(gain >= (most - TIE * np.abs(most))[place])
    found = most > -np.inf
    best = begin.copy()
    best[found] = enough[np.searchsorted(place[enough], np.flatnonzero(found))]
    threshold, cut = np.zeros(len(nodes)), bins[best]
    for f in np.unique(feature[best[found]]):
        mine = np.flatnonzero(found & (feature[best] == f))
        threshold[mine] = edges[f][bins[best[mine]]]
        if exact[f]:
            # Half way to the next value of the node; values between that other rows have follow it.
            threshold[mine] = (threshold[mine] + edges[f][bins[best[mine] + 1]]) / 2
            cut[mine] = np.searchsorted(edges[f], threshold[mine], side="right") - 1
    one = first_group
    return {"node": nodes, "feature": np.where(found, feature[best], -1), "cut": cut, "threshold": threshold,
            "count": c[last][one], "weight": w[last][one], "label": s[last][one],
            "left_count": c[best], "left_weight": w[best], "left_label": s[best]}


def _histogram(front, bins, weight, y, features, width, deep):
    """Sums by (open node, feature, bin) of one tree's rows."""
    rows = len(front)
    if rows and (cells := int(front.max() - front.min() + 1) * width * deep) <= DENSE * rows * len(features):
        return _dense_histogram(front, bins, weight, y, features, width, deep, cells)
    key = np.concatenate([front * (width * deep) + f * deep + bins[:, f] for f in features])
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(key) else np.empty(0, np.int64)
    row = order % rows if rows else order
    w, v = weight[row], y[row]
    node, rest = np.divmod(sorted_key[start], width * deep)
    feature, b = np.divmod(rest, deep)
    count = np.diff(np.concatenate([start, [len(key)]]))
    return [node, feature, b, count, np.add.reduceat(w, start), np.add.reduceat(w * v, start),
            np.minimum.reduceat(v, start), np.maximum.reduceat(v, start)]


def _dense_histogram(front, bins, weight, y, features, width, deep, cells):
    """:func:`_histogram` by counting, where the cells are few beside the rows."""
    first = int(front.min())
    begin, product = (front - first) * (width * deep), weight * y
    count, w, v = np.zeros(cells, np.int64), np.zeros(cells), np.zeros(cells)
    low, high = np.full(cells, np.inf), np.full(cells, -np.inf)
    for f in features:
        key = begin + (f * deep + bins[:, f])
        count += np.bincount(key, minlength=cells)
        w += np.bincount(key, weight, cells)
        v += np.bincount(key, product, cells)
        np.minimum.at(low, key, y)
        np.maximum.at(high, key, y)
    held = np.flatnonzero(count)
    node, rest = np.divmod(held, width * deep)
    feature, b = np.divmod(rest, deep)
    return [node + first, feature, b, count[held], w[held].astype(np.int64), v[held], low[held], high[held]]


def _gathered(batches):
    """Batches of some ``GATHERED`` rows, so that sums of few cells are given back once for many rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_SUMS = ["node", "feature", "bin", "count", "weight", "label", "low", "high"]
_SUMS_TYPES = "node long, feature long, bin long, count long, weight long, label double, low double, high double"
_CHOSEN = ("node long, feature long, cut long, threshold double, count long, weight long, label double, "
           "left_count long, left_weight long, left_label double")
_SUBTREE = "node long, feature binary, cut binary, threshold binary, left binary, right binary, value binary"
_PARTS = {"feature": "<i8", "cut": "<i8", "threshold": "<f8", "left": "<i8", "right": "<i8", "value": "<f8"}


def _open_after(tree: Growing, node: int, count: int) -> bool:
    """Whether a node may be split."""
    fit = tree.fit
    return tree.depth[node] < fit.max_depth and count >= max(fit.min_split, 2 * fit.min_leaf, 2)


def grow_in_memory(fit: Fit, key: int, depth: int, bins: np.ndarray, weight: np.ndarray, y: np.ndarray,
                   edges: list[np.ndarray], exact: list[bool]) -> Growing:
    """A whole subtree from the rows of its root; the rows of each open node lie next to each other."""
    tree = Growing(fit)
    tree.key, tree.depth = [key], [depth]
    tree.value = [float(weight @ y) / float(weight.sum())]
    features = sorted(set(fit.features)) if fit.features is not None else list(range(bins.shape[1]))
    columns = [y, weight, *(np.ascontiguousarray(bins[:, f]) for f in features)]
    nodes = np.arange(1 if _open_after(tree, 0, len(y)) else 0)
    begin = np.array([0, len(y)])
    least = max(fit.min_split, 2 * fit.min_leaf, 2)
    while len(nodes):
        deeper = tree.depth[nodes[0]] + 1 < fit.max_depth
        parts, opened, sizes = [], [], []
        starts = np.flatnonzero(np.diff(begin[:-1] // PART, prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(nodes)]):
            own, own_begin = nodes[low:high], begin[low:high + 1] - begin[low]
            here = [c[begin[low]:begin[high]] for c in columns]
            got = _best_in_memory(fit, np.array([tree.key[k] for k in own.tolist()], np.uint64), own_begin, here, features, edges, exact)
            if got is None:
                continue
            children = _apply_level(tree, own[got["node"]], got)
            if not children or not deeper:
                continue
            number, count = np.array(children).T
            order, kept = _children_in_order(got, own_begin, here, features, count >= least)
            if len(order):
                parts.append([c[order] for c in here])
                opened.append(number[kept])
                sizes.append(count[kept])
        if not parts:
            break
        columns = [np.concatenate(c) for c in zip(*parts)]
        nodes = np.concatenate(opened)
        begin = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return tree


def _best_in_memory(fit: Fit, keys: np.ndarray, begin: np.ndarray, columns: list[np.ndarray], features: list[int], edges, exact) -> dict | None:
    """:func:`choose` for neighbouring nodes from their rows; only features that may be split on are counted."""
    y, weight = columns[:2]
    start, size, number = begin[:-1], np.diff(begin), np.arange(len(begin) - 1)
    low, high = np.minimum.reduceat(y, start), np.maximum.reduceat(y, start)
    differs = np.stack([np.minimum.reduceat(c, start) < np.maximum.reduceat(c, start) for c in columns[2:]]) & (low < high)
    if fit.tried is not None and fit.tried < len(features):
        hashed = mixed(keys[None, :], np.array(features)[:, None] + 16)
        order = np.lexsort((hashed, ~differs), axis=0)
        turn = np.empty_like(order)
        np.put_along_axis(turn, order, np.arange(len(features))[:, None], axis=0)
        differs &= turn < fit.tried
    product = weight * y
    sums = []
    for f, column, which in zip(features, columns[2:], differs):
        if not which.any():
            continue
        deep, w, v = len(edges[f]), weight, product
        if which.all():
            mine, cell = number, np.repeat(number * deep, size)
        else:
            mine, at = np.flatnonzero(which), np.flatnonzero(np.repeat(which, size))
            cell, column, w, v = np.repeat(np.arange(len(mine)) * deep, size[which]), column[at], weight[at], product[at]
        cell += column
        count = np.bincount(cell)
        held = np.flatnonzero(count)
        place, b = np.divmod(held, deep)
        sums.append((mine[place], np.full(len(held), f), b, count[held], np.bincount(cell, w)[held], np.bincount(cell, v)[held]))
    if not sums:
        return None
    node, feature, b, count, w, v = (np.concatenate(c) for c in zip(*sums))
    if len(sums) > 1:
        order = np.argsort(node, kind="stable")
        node, feature, b, count, w, v = (c[order] for c in (node, feature, b, count, w, v))
    return choose(node, feature, b, count, w, v, low[node], high[node], [fit] * len(number), keys, edges, exact)


def _children_in_order(got: dict, begin: np.ndarray, columns: list[np.ndarray], features: list[int], kept: np.ndarray):
    """The rows of the kept children (two for each split node of ``got``), child by child, and which children these are."""
    size, split = np.diff(begin), got["feature"] >= 0
    node, feature, cut = (got[c][split] for c in ("node", "feature", "cut"))
    many = int(kept.sum())
    code = np.full((len(size), 2), many)
    code[node] = np.where(kept, np.cumsum(kept) - 1, many).reshape(-1, 2)
    code = code.astype(np.int16 if many < 1 << 15 else np.int64)     # numpy sorts short numbers by counting
    own, limit = np.full(len(size), -1), np.zeros(len(size), np.int64)
    own[node], limit[node] = feature, cut
    side = np.zeros(int(begin[-1]), np.int64)
    for f, column in zip(features, columns[2:]):
        which = own == f
        if which.all():
            side += column > np.repeat(limit, size)
        elif which.any():
            at = np.flatnonzero(np.repeat(which, size))
            side[at] = column[at] > np.repeat(limit[which], size[which])
    side += np.repeat(2 * np.arange(len(size)), size)
    side = code.ravel()[side]
    order = np.argsort(side, kind="stable")
    return order[:len(order) - int(np.count_nonzero(side == many))], np.flatnonzero(kept)


def _apply(tree: Growing, node: int, got: dict) -> list[tuple[int, int]]:
    """Note a node's mean, split it if a split was found; its children and their rows."""
    tree.value[node] = float(got["label"]) / float(got["weight"])
    if got["feature"] < 0:
        return []
    rest = float(got["weight"] - got["left_weight"])
    means = (float(got["left_label"]) / float(got["left_weight"]), float(got["label"] - got["left_label"]) / rest)
    children = tree.split(node, int(got["feature"]), int(got["cut"]), float(got["threshold"]), means)
    return list(zip(children, (int(got["left_count"]), int(got["count"] - got["left_count"]))))


def _apply_level(tree: Growing, nodes: np.ndarray, got: dict) -> list[tuple[int, int]]:
    """:func:`_apply` for many nodes of a tree at once."""
    for node, mean in zip(nodes.tolist(), (got["label"] / got["weight"]).tolist()):
        tree.value[node] = mean
    at = np.flatnonzero(got["feature"] >= 0)
    if not len(at):
        return []
    base = len(tree.feature)
    left = base + 2 * np.arange(len(at))
    split = nodes[at]
    for name, values in (("feature", got["feature"][at]), ("cut", got["cut"][at]), ("threshold", got["threshold"][at]),
                         ("left", left), ("right", left + 1)):
        own = getattr(tree, name)
        for node, value in zip(split.tolist(), values.tolist()):
            own[node] = value
        own.extend([-1 if name == "feature" else 0] * (2 * len(at)))
    w, s, c = got["left_weight"][at], got["left_label"][at], got["left_count"][at]
    tree.value.extend(np.column_stack([s / w, (got["label"][at] - s) / (got["weight"][at] - w)]).ravel().tolist())
    tree.depth.extend(np.repeat([tree.depth[n] + 1 for n in split.tolist()], 2).tolist())
    keys = np.array([tree.key[n] for n in split.tolist()], np.uint64)
    tree.key.extend(np.column_stack([mixed(keys, 1), mixed(keys, 2)]).ravel().tolist())
    return list(zip(range(base, base + 2 * len(at)), np.column_stack([c, got["count"][at] - c]).ravel().tolist()))


def _table(batch, width: int, fits: list[Fit]):
    idx, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("idx", "fold"))
    y = batch.column("y").to_numpy(zero_copy_only=False)
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "<u2").reshape(-1, width)
    counts = None
    if any(f.column is not None for f in fits):
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<i8").reshape(len(y), -1)
    return idx, fold, y, bins, counts


def _state(trees: list[Growing], front: dict) -> list:
    """What a task needs of the trees with open nodes: number, fit, arrays to walk, open nodes' numbers."""
    slots: dict[int, np.ndarray] = {}
    for (number, node), at in front.items():
        if number not in slots:
            slots[number] = np.full(len(trees[number].feature), -1)
        slots[number][node] = at
    return [(t.fit, tuple(np.array(a) for a in (t.feature, t.cut, t.left, t.right)), slot)
            for t, slot in sorted(((trees[number], slot) for number, slot in sorted(slots.items())), key=lambda s: repr(_drawn_as(s[0].fit)))]


def _drawn_as(fit: Fit):
    """Equal for fits whose rows count equally often."""
    if fit.sample or fit.bootstrap or fit.column is not None:
        return fit.held, fit.sample, fit.bootstrap, fit.column, fit.seed, fit.sample_seed
    return fit.held


def _rows_at(state, data: Binned, batch, width):
    """For each tree: its fit, and open node, bins, weight and label of the batch's rows that are in one."""
    fits = [fit for fit, _, _ in state]
    idx, fold, y, bins, counts = _table(batch, width, fits)
    known: dict = {}
    for fit, arrays, slot in state:
        which = _drawn_as(fit)
        if which not in known:
            if len(known) > 8:
                known.clear()
            known[which] = _weights(fit, data[0], data[1], idx, fold, counts)
        weight = known[which]
        front = slot[walk(arrays, bins)]
        at = np.flatnonzero((front >= 0) & (weight > 0))
        if len(at):
            yield fit, front[at], bins[at], weight[at], y[at]


def _numbered(open_nodes: list[tuple[int, int]]) -> dict:
    return {pair: k for k, pair in enumerate(open_nodes)}


def _level(rows: Binned, trees: list[Growing], open_nodes: list[tuple[int, int]]) -> list[dict]:
    """One pass: the best split of every open node (tree, node)."""
    spark = rows.df.sparkSession
    width, deep = len(rows.edges), max(len(e) for e in rows.edges)
    edges, exact = rows.edges, rows.exact
    shared = spark.sparkContext.broadcast((_state(trees, _numbered(open_nodes)), (rows.n, rows.bounds),
                                           [trees[t].fit for t, _ in open_nodes], [trees[t].key[k] for t, k in open_nodes]))

    def sums(batches):
        state, data, _, _ = shared.value
        for batch in _gathered(batches):
            for fit, front, bins, weight, y in _rows_at(state, data, batch, width):
                features = sorted(set(fit.features)) if fit.features is not None else range(width)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _histogram(front, bins, weight, y, features, width, deep)],
                                                 names=_SUMS)

    def best(batches):
        _, _, fits, keys = shared.value
        held = None

        def chosen(t):
            got = choose(*[t.column(c).to_numpy() for c in _SUMS], fits, keys, edges, exact)
            return pa.RecordBatch.from_pydict(got)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            node = held.column("node").to_numpy()
            whole = int(np.searchsorted(node, node[-1]))    # the last node may go on in the next batch
            if whole:
                yield chosen(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield chosen(held)

    added = (rows.df.mapInArrow(sums, _SUMS_TYPES).groupBy("node", "feature", "bin")
             .agg(*[F.sum(c).alias(c) for c in ("count", "weight", "label")], F.min("low").alias("low"), F.max("high").alias("high")))
    ordered = added.repartition("node").sortWithinPartitions("node", "feature", "bin").select(*_SUMS)
    got = ordered.mapInArrow(best, _CHOSEN).collect()
    shared.unpersist()
    return [r.asDict() for r in got]


def _packs(trees: list[Growing], small: list[tuple[int, int]], tasks: int) -> list[list[int]]:
    """Numbers of the small nodes that are grown from one copy of rows: roots whose rows count equally often."""
    roots: dict = {}
    out = []
    for k, (t, node) in enumerate(small):
        if node:
            out.append([k])
        else:
            roots.setdefault(_drawn_as(trees[t].fit), []).append(k)
    size = min(SHARING, max(1, sum(map(len, roots.values())) // (4 * tasks)))
    return out + [mine[i:i + size] for mine in roots.values() for i in range(0, len(mine), size)]


def _brought(rows: Binned, trees: list[Growing], small: list[tuple[int, int]], packs: list[list[int]], held_out: bool) -> DataFrame:
    """The rows of each pack, packed; with ``held_out`` also those of the fold left out (without weights, by chunks)."""
    spark, width = rows.df.sparkSession, len(rows.edges)
    shared = spark.sparkContext.broadcast((_state(trees, {small[p[0]]: n for n, p in enumerate(packs)}), (rows.n, rows.bounds)))
    kind = _kind(rows)

    def parts(pack, first, *columns):
        cut = [0, *(np.flatnonzero((pack[1:] != pack[:-1]) | (first[1:] != first[:-1])) + 1).tolist(), len(pack)]
        raw = [[b""] * (len(cut) - 1) if c is None else [c[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(pack[cut[:-1]]), pa.array(first[cut[:-1]]), *(pa.array(r, pa.binary()) for r in raw)],
                                          names=["pack", "first", "weight", "y", "place", "bins"])

    def members(batches):
        state, data = shared.value
        for batch in _gathered(batches):
            first = batch.column("idx")[0].as_py()
            for _, front, bins, weight, y in _rows_at(state, data, batch, width):
                if (front != front[0]).any():
                    order = np.argsort(front, kind="stable")
                    front, bins, weight, y = front[order], bins[order], weight[order], y[order]
                short = next(k for k in ("<u1", "<u2", "<u4", "<u8") if int(weight.max()) <= np.iinfo(k).max)
                yield parts(front, np.full(len(front), first), weight.astype(short), y.astype("<f8"), None, bins.astype(kind))
            if held_out:
                idx, fold, _, bins, _ = _table(batch, width, [])
                for fit, arrays, slot in state:
                    at = np.flatnonzero(fold == fit.held)
                    front = slot[walk(arrays, bins[at])]
                    at, front = at[front >= 0], front[front >= 0]
                    if len(at):
                        order = np.lexsort((idx[at], front))
                        at, front = at[order], front[order]
                        chunk, place = np.divmod(idx[at], CHUNK)
                        yield parts(front, chunk, None, None, place.astype("<u2"), bins[at].astype(kind))

    # As many partitions as asked for: packs are few and long, and Spark would join them by their bytes.
    return (rows.df.mapInArrow(members, "pack long, first long, weight binary, y binary, place binary, bins binary")
            .repartition(min(4 * len(packs), 512), "pack"))


def _kind(rows: Binned) -> str:
    return "<u1" if max(len(e) for e in rows.edges) <= 256 else "<u2"


def _planned(trees: list[Growing], small: list[tuple[int, int]], packs: list[list[int]]) -> list:
    return [[(k, small[k][0], trees[small[k][0]].fit, trees[small[k][0]].key[small[k][1]], trees[small[k][0]].depth[small[k][1]])
             for k in pack] for pack in packs]


def _grown(table: pa.Table, plan: list, kind: str, edges: list[np.ndarray], exact: list[bool]):
    """``(number, tree, subtree)`` of the nodes of a pack."""
    # Positions give the order, so that sums do not change in the last place with the order of arrival.
    table = table.sort_by("first")
    y = np.frombuffer(b"".join(table.column("y").to_pylist()), "<f8")
    bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), kind).reshape(-1, len(edges))
    weight = np.concatenate([np.frombuffer(w, f"<u{len(w) * 8 // len(v)}").astype("<u4" if len(w) * 2 <= len(v) else "<i8")
                             for w, v in zip(table.column("weight").to_pylist(), table.column("y").to_pylist())])
    for k, t, fit, key, depth in plan[table.column("pack")[0].as_py()]:
        yield k, t, grow_in_memory(fit, key, depth, bins, weight, y, edges, exact)


def _finish(rows: Binned, trees: list[Growing], small: list[tuple[int, int]]) -> None:
    """Grow the subtrees of all small nodes, each where its rows are brought together."""
    spark, kind, edges, exact = rows.df.sparkSession, _kind(rows), rows.edges, rows.exact
    packs = _packs(trees, small, spark.sparkContext.defaultParallelism)
    plan = spark.sparkContext.broadcast(_planned(trees, small, packs))

    def grown(table: pa.Table) -> pa.Table:
        done = list(_grown(table, plan.value, kind, edges, exact))
        return pa.table({"node": [k for k, _, _ in done], **{c: pa.array([np.array(getattr(t, c), form).tobytes() for _, _, t in done], pa.binary())
                                                             for c, form in _PARTS.items()}})

    for r in _brought(rows, trees, small, packs, False).groupBy("pack").applyInArrow(grown, _SUBTREE).collect():
        t, node = small[r["node"]]
        trees[t].graft(node, {c: np.frombuffer(r[c], form).tolist() for c, form in _PARTS.items()})
    plan.unpersist()


_HELD = "block long, chunk long, tree long, place binary, value binary"


def held_out(rows: Binned, fits: list[Fit], blocks: list[int]) -> tuple[DataFrame, list[str]]:
    """What each tree predicts for the rows of its fold left out, and scratch tables to discard later.

    ``(block, chunk, tree, place, value)``: a tree's values for rows of a chunk
    of positions, and as tree -1 the labels of the block's fold. ``blocks`` has
    the block of each fit. The trees are used where they are grown: they may
    have as many leaves as there are rows, so they go neither to the driver nor to all tasks.
    """
    tables = []
    for i in range(0, len(fits), TREES):
        tables.append(materialize(_held_out(rows, fits[i:i + TREES], i, blocks), "held-out"))
    out = tables[0][0]
    for more, _ in tables[1:]:
        out = out.unionAll(more)
    return out, [path for _, path in tables]


def _held_out(rows: Binned, fits: list[Fit], base: int, blocks: list[int]) -> DataFrame:
    spark, kind, edges, exact, width = rows.df.sparkSession, _kind(rows), rows.edges, rows.exact, len(rows.edges)
    trees, small = _grown_above(rows, fits)
    packs = _packs(trees, small, spark.sparkContext.defaultParallelism)
    begun: dict[int, list[int]] = {}
    for t, node in small:
        begun.setdefault(t, []).append(node)
    labelled = {blocks[base + t]: f.held for t, f in enumerate(fits) if not base or blocks[base + t] != blocks[base - 1]}
    shared = spark.sparkContext.broadcast((_planned(trees, small, packs), blocks, labelled, [
        (t, tree.fit.held, tree.arrays(), np.array(begun.get(t, []), np.int64)) for t, tree in enumerate(trees) if begun.get(t) != [0]]))

    def rows_of(found: list) -> pa.RecordBatch:
        names = ["block", "chunk", "tree", "place", "value"]
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found) if found else [[]] * 5, kinds)], names=names)

    def by_chunk(block, tree, idx, value):
        chunk, place = np.divmod(idx, CHUNK)
        cut = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
        return [(block, int(chunk[i]), tree, place[i:j].astype("<u2").tobytes(), value[i:j].astype("<f8").tobytes())
                for i, j in zip(cut[:-1], cut[1:]) if j > i]

    def finished(table: pa.Table) -> pa.Table:
        """By the subtrees of a pack."""
        plan, blocks, _, _ = shared.value
        own = np.array([len(w) for w in table.column("weight").to_pylist()]) > 0
        left = table.filter(pa.array(~own)).to_pylist()
        found = []
        for _, t, tree in _grown(table.filter(pa.array(own)), plan, kind, edges, exact):
            arrays = tree.arrays()
            for r in left:
                bins = np.frombuffer(r["bins"], kind).reshape(-1, width)
                found.append((blocks[base + t], r["first"], base + t, r["place"], arrays[4][walk(arrays, bins)].astype("<f8").tobytes()))
        return pa.Table.from_batches([rows_of(found)])

    def above(batches):
        """By leaves that were reached before, and the labels."""
        _, blocks, labelled, tops = shared.value
        for batch in _gathered(batches):
            idx, fold, y, bins, _ = _table(batch, width, [])
            order = np.argsort(idx, kind="stable")
            idx, fold, y, bins = idx[order], fold[order], y[order], bins[order]
            found = []
            for block, held in labelled.items():
                at = np.flatnonzero(fold == held)
                found += by_chunk(block, -1, idx[at], y[at])
            for t, held, arrays, later in tops:
                at = np.flatnonzero(fold == held)
                node = walk(arrays, bins[at])
                done = ~np.isin(node, later)
                found += by_chunk(blocks[base + t], base + t, idx[at[done]], arrays[4][node[done]])
            yield rows_of(found)

    out = rows.df.mapInArrow(above, _HELD)
    return out.unionAll(_brought(rows, trees, small, packs, True).groupBy("pack").applyInArrow(finished, _HELD)) if packs else out


def grow(rows: Binned, fits: list[Fit]) -> list[Growing]:
    """Grow one tree for each fit, ``TREES`` at the same time."""
    out = []
    for i in range(0, len(fits), TREES):
        out += _grow_together(rows, fits[i:i + TREES])
    return out


def _grow_together(rows: Binned, fits: list[Fit]) -> list[Growing]:
    trees, small = _grown_above(rows, fits)
    if small:
        _finish(rows, trees, small)
    return trees


def _grown_above(rows: Binned, fits: list[Fit]) -> tuple[list[Growing], list[tuple[int, int]]]:
    """The trees down to their small nodes, and these (tree, node)."""
    trees = [Growing(f) for f in fits]
    large, small = [], []
    tasks = rows.df.sparkSession.sparkContext.defaultParallelism
    limit = min(SMALL, SMALL_CELLS // len(rows.edges), max(LEAST, sum(map(rows.rows_of, fits)) // (3 * tasks)))

    def place(t: int, node: int, count: int) -> None:
        (small if count <= limit else large).append((t, node))

    for t, fit in enumerate(fits):
        place(t, 0, rows.rows_of(fit))
    while large:
        at, found = large, _level(rows, trees, large)
        large = []
        for got in sorted(found, key=lambda g: g["node"]):
            t, node = at[got["node"]]
            for child, count in _apply(trees[t], node, got) if _open_after(trees[t], node, got["count"]) else _leaf(trees[t], node, got):
                if _open_after(trees[t], child, count):
                    place(t, child, count)
    return trees, small


def _leaf(tree: Growing, node: int, got: dict) -> list:
    tree.value[node] = float(got["label"]) / float(got["weight"])
    return []
