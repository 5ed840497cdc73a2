"""Running states of pooled documents: they are made from runs of steps and merge in any order.

A document is pooled over its steps. A task sees the steps of a batch in runs of a bounded number, which may
begin and end inside a document, and adds each run to what it has of the documents so far:

* mean: number of steps and sum of their vectors;
* max: largest value per dimension;
* attention: the weights' sum and the weighted sum of vectors;
* softmax: the largest energy so far, and both sums relative to it. When a run brings a larger energy the
  sums so far are scaled down by exp(old - new), so no energy is too large or too small for the
  exponential function and no second pass is needed.

So memory depends on the number of documents in a batch and on the run's length, not on the length of a text.
"""

from __future__ import annotations

import numpy as np

EPSILON = 1e-7  # fixed value: keeps an attention weight sum away from zero


def _by_document(how: np.ufunc, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``how.reduceat(values, starts)``, which is slow over rows: a document's rows are reduced at once."""
    return np.stack([how.reduce(part) for part in np.split(values, starts[1:])])


class Pooled:
    """States of ``documents`` documents with vectors of ``dim`` numbers, for some kinds of pooling."""

    def __init__(self, documents: int, dim: int, kinds: tuple[str, ...]):
        self.kinds = kinds
        self.steps = np.zeros(documents)
        self.sums = {k: np.zeros((documents, dim)) for k in kinds if k != "max"}
        self.largest = np.full((documents, dim), -np.inf)
        self.weight = {k: np.zeros(documents) for k in ("attention", "softmax") if k in kinds}
        self.top = np.full(documents, -np.inf)

    def add(self, owner: np.ndarray, vectors: np.ndarray, scores: np.ndarray | None = None) -> None:
        """A run of steps in order of their documents ``owner``; ``scores``: the attention's exponents."""
        if not len(owner):
            return
        starts = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
        to = owner[starts]
        vectors = vectors.astype(float)
        counts = np.diff(starts, append=len(owner))
        self.steps[to] += counts
        if "mean" in self.kinds:
            self.sums["mean"][to] += _by_document(np.add, vectors, starts)
        if "max" in self.kinds:
            self.largest[to] = np.maximum(self.largest[to], _by_document(np.maximum, vectors, starts))
        if "attention" in self.kinds:
            self._weigh("attention", to, starts, vectors, np.exp(scores))
        if "softmax" in self.kinds:
            top = np.maximum(self.top[to], np.maximum.reduceat(scores, starts))
            scale = np.exp(self.top[to] - top)
            self.weight["softmax"][to] *= scale
            self.sums["softmax"][to] *= scale[:, None]
            self.top[to] = top
            self._weigh("softmax", to, starts, vectors, np.exp(scores - np.repeat(top, counts)))

    def _weigh(self, kind: str, to: np.ndarray, starts: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> None:
        self.weight[kind][to] += np.add.reduceat(weights, starts)
        self.sums[kind][to] += _by_document(np.add, vectors * weights[:, None], starts)

    def merge(self, other: Pooled) -> None:
        """Adds the states of other steps of the same documents."""
        for kind in self.sums:
            if kind != "softmax":
                self.sums[kind] += other.sums[kind]
        self.largest = np.maximum(self.largest, other.largest)
        self.steps += other.steps
        if "attention" in self.weight:
            self.weight["attention"] += other.weight["attention"]
        if "softmax" in self.weight:
            top = np.maximum(self.top, other.top)
            shift = np.where(np.isneginf(top), 0.0, top)  # no step yet on either side
            total, summed = 0.0, 0.0
            for part in (self, other):
                scale = np.exp(part.top - shift)
                total = total + part.weight["softmax"] * scale
                summed = summed + part.sums["softmax"] * scale[:, None]
            self.weight["softmax"], self.sums["softmax"], self.top = total, summed, top

    def result(self) -> np.ndarray:
        """``(document, kind, dim)`` end to end per document; zeros for a document without steps."""
        filled = self.steps > 0
        parts = []
        for kind in self.kinds:
            if kind == "max":
                parts.append(np.where(filled[:, None], self.largest, 0.0))
            else:
                below = self.steps if kind == "mean" else self.weight[kind] + EPSILON
                parts.append(np.where(filled[:, None], self.sums[kind] / np.where(filled, below, 1.0)[:, None], 0.0))
        return np.hstack(parts)
