"""Fitted MLlib trees as arrays, evaluated together in one vectorised pass.

A chain of one ``transform`` for each member costs the driver more planning
with every member; here all members of an ensemble are one Python stage over
Arrow batches, whatever their number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


@dataclass
class Tree:
    """Nodes of one tree, the root first; leaves have ``feature`` -1."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    @classmethod
    def of(cls, model) -> Tree:
        """From a fitted tree over continuous features, by its printed form."""
        tree = cls([], [], [], [], [])
        open_nodes: list[int] = []
        for line in model.toDebugString.splitlines():
            split, leaf = _SPLIT.search(line), _LEAF.search(line)
            if "Else (" in line:
                tree.right[open_nodes.pop()] = len(tree.feature)
            elif split:
                here = len(tree.feature)
                open_nodes.append(here)
                tree._add(int(split[1]), float(split[2]), 0.0)
                tree.left[here] = here + 1
            elif leaf:
                tree._add(-1, 0.0, float(leaf[1]))
            elif " in {" in line:
                raise ValueError("categorical splits are not supported")
        return tree

    def _add(self, feature: int, threshold: float, value: float) -> None:
        self.feature.append(feature)
        self.threshold.append(threshold)
        self.value.append(value)
        self.left.append(0)
        self.right.append(0)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row comes to."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        child = np.column_stack([self.left, self.right]).ravel()
        values, begin = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        at, rows, node = np.zeros(len(x), np.int64), np.arange(len(x)), np.zeros(len(x), np.int64)
        while len(rows):
            split = feature[at]
            inner = split >= 0
            if not inner.all():
                node[rows[~inner]] = at[~inner]
                rows, at, begin, split = rows[inner], at[inner], begin[inner], split[inner]
            at = child[2 * at + ~(values[begin + split] <= threshold[at])]
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(x)]

    def state(self) -> list:
        return [self.feature, self.threshold, self.left, self.right, self.value]


def weighted_median(predictions: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """By row the first prediction, in ascending order, whose running weight reaches half of all."""
    order = np.argsort(predictions, axis=1, kind="stable")
    reached = np.cumsum(weights[order], axis=1) >= 0.5 * weights.sum() * (1 - 1e-12)
    return np.take_along_axis(predictions, np.take_along_axis(order, reached.argmax(axis=1)[:, None], axis=1), axis=1)[:, 0]


def ensemble(features: str, combine) -> Column:
    """``combine(X) -> predictions`` applied to the rows of a vector column."""

    @F.arrow_udf("double")
    def predict(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.float64())
        return pa.array(combine(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)), pa.float64())

    return predict(vector_to_array(F.col(features)))
