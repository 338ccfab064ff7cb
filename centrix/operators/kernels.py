"""NumPy kernels run inside ``mapInArrow`` tasks.

Spark partitions the points and shuffles the (tiny) per-partition results; the
kernels only do the dense arithmetic of one partition.  Distances are summed
feature by feature from the first to the last, exactly like the SQL form
``aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, +)``, so both
paths give the same bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Elements of the n x k distance block held at once inside a task: small
# enough to stay in cache (measured fastest at 2^16 for d = 2, 64 and 512).
BLOCK_ELEMS = 1 << 16
# Centroids in a box of the search tree.
LEAF = 64


def coords(batch: pa.RecordBatch, d: int, name: str = "coord") -> np.ndarray:
    """ARRAY column of a batch -> (rows, d) float64 matrix (no per-row Python).
    A null, short, long or partly null vector fails the job."""
    return matrix(batch.column(batch.schema.get_field_index(name)), d)


def matrix(arr: pa.Array, d: int, kind: type = np.float64) -> np.ndarray:
    """An Arrow list array of ``d`` numbers a row as a matrix."""
    flat = arr.flatten()
    lengths = np.diff(np.asarray(arr.offsets))
    if arr.null_count or flat.null_count or (lengths.size and (lengths.min() != d or lengths.max() != d)):
        raise ValueError(f"every point must have {d} features, none of them null")
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=kind).reshape(-1, d)


def sq_dists(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """(n, k) squared distances, summed in feature order."""
    acc = np.zeros((X.shape[0], C.shape[0]), dtype=np.float64)
    for j in range(X.shape[1]):
        t = X[:, j, None] - C[None, :, j]
        acc += t * t
    return acc


def sq_dists_t(XT: np.ndarray, CT: np.ndarray, acc: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """(n, k) squared distances of transposed points and centroids, summed
    feature by feature into ``acc``."""
    np.subtract(XT[0][:, None], CT[0][None, :], out=acc)
    np.multiply(acc, acc, out=acc)
    for j in range(1, XT.shape[0]):
        np.subtract(XT[j][:, None], CT[j][None, :], out=tmp)
        np.multiply(tmp, tmp, out=tmp)
        np.add(acc, tmp, out=acc)
    return acc


def all_sq_dists(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """(k, n) squared distances, in chunks that stay in cache."""
    out, CT = np.empty((len(C), len(X))), np.ascontiguousarray(C.T)
    step = max(1, BLOCK_ELEMS // max(1, len(C)))
    for low in range(0, len(X), step):
        XT = columns_of(X[low:low + step])
        acc = np.empty((XT.shape[1], len(C)))
        out[:, low:low + step] = sq_dists_t(XT, CT, acc, np.empty_like(acc)).T
    return out


def own_sq_dists(XT: np.ndarray, CT: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Squared distance of each (transposed) point to its own centroid, summed
    feature by feature: the same bits as in the full table of distances."""
    t = XT[0] - CT[0][idx]
    acc = t * t
    for j in range(1, XT.shape[0]):
        np.subtract(XT[j], CT[j][idx], out=t)
        np.multiply(t, t, out=t)
        np.add(acc, t, out=acc)
    return acc


class Boxes:
    """Boxes of centroids: the lowest and the highest value of each feature."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high

    def box_dists(self, XT: np.ndarray) -> np.ndarray:
        """(n, boxes) squared distances of transposed points to the boxes."""
        acc = np.zeros((XT.shape[1], len(self.low)))
        for j in range(XT.shape[0]):
            x = XT[j][:, None]
            t = np.maximum(self.low[None, :, j] - x, x - self.high[None, :, j])
            np.maximum(t, 0.0, out=t)
            np.multiply(t, t, out=t)
            np.add(acc, t, out=acc)
        return acc


class Tree(Boxes):
    """Centroids in boxes of about ``LEAF``, for exact nearest-centroid search.

    Built by halving the widest feature at its median.  A point's squared
    distance to a box is summed in the same feature order as to a centroid, from
    terms that are no larger; as rounding keeps order, it is a lower bound of
    the computed distances to all centroids inside, not only of the true ones.

    Where boxes spare little (wide vectors without structure), later points are
    compared with all centroids: the same bits at less cost.
    """

    def __init__(self, C: np.ndarray, leaf: int | None = None):
        leaf = leaf or LEAF
        self.C = C
        parts, self.leaves = [np.arange(C.shape[0])], []
        while parts:
            own = parts.pop()
            if len(own) <= leaf:
                self.leaves.append(np.sort(own))
                continue
            wide = int(np.argmax(C[own].max(axis=0) - C[own].min(axis=0)))
            own = own[np.argsort(C[own, wide], kind="stable")]
            parts += own[:len(own) // 2], own[len(own) // 2:]
        super().__init__(*(np.array([f(C[own], axis=0) for own in self.leaves]).reshape(len(self.leaves), C.shape[1]) for f in (np.min, np.max)))
        self.CT = [np.ascontiguousarray(C[own].T) for own in self.leaves]
        self.flat = len(self.leaves) == 1
        if not self.flat:
            self.whole_T = np.ascontiguousarray(C.T)

    def nearest(self, XT: np.ndarray, second: bool = False):
        """Index (the lowest on a tie) and squared distance, per column of ``XT``;
        with ``second`` also the squared distance of the next nearest centroid.

        Each point first visits the box nearest to it; after that a box is
        visited only by the points it isn't too far from."""
        n, k = XT.shape[1], len(self.C)
        idx, dist, other = np.full(n, k, np.int64), np.full(n, np.inf), np.full(n, np.inf)
        visited = 0

        def visit(rows: np.ndarray | slice, CT: np.ndarray, ids: np.ndarray | None) -> None:
            nonlocal visited
            X = XT[:, rows]
            visited += X.shape[1] * CT.shape[1]
            acc = np.empty((X.shape[1], CT.shape[1]))
            sq_dists_t(X, CT, acc, np.empty_like(acc))
            at = acc.argmin(axis=1)
            every = np.arange(len(acc))
            new, own, old, was = acc[every, at], at if ids is None else ids[at], dist[rows], idx[rows]
            better = (new < old) | ((new == old) & (own < was))
            if second:
                acc[every, at] = np.inf
                other[rows] = np.minimum(np.minimum(other[rows], acc.min(axis=1)), np.where(better, old, new))
            dist[rows], idx[rows] = np.where(better, new, old), np.where(better, own, was)

        if self.flat:
            step = max(1, BLOCK_ELEMS // k)
            for low in range(0, n, step):
                visit(slice(low, low + step), self.CT[0] if len(self.leaves) == 1 else self.whole_T, None)
        else:
            bound = self.box_dists(XT)
            first = bound.argmin(axis=1)
            order = np.argsort(first, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
                if len(rows):
                    visit(rows, self.CT[first[rows[0]]], self.leaves[first[rows[0]]])
            for leaf, (CT, ids) in enumerate(zip(self.CT, self.leaves, strict=True)):
                rows = np.flatnonzero((bound[:, leaf] <= (other if second else dist)) & (first != leaf))
                if 2 * len(rows) > n and not second:
                    visit(slice(None), CT, ids)  # cheaper than picking most of the columns
                elif len(rows):
                    visit(rows, CT, ids)
            self.flat = visited > 0.5 * n * k
        return (idx, dist, other) if second else (idx, dist)


def nearest(X: np.ndarray, C: np.ndarray | Tree) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centroid (lowest index on a tie) and its distance.

    Rows are taken in cache-sized chunks; each goes through the search tree,
    which for few centroids is one box."""
    tree = C if isinstance(C, Tree) else Tree(C)
    n = X.shape[0]
    idx = np.empty(n, dtype=np.int64)
    dist = np.empty(n, dtype=np.float64)
    for rows in chunks(n, tree):
        idx[rows], dist[rows] = tree.nearest(columns_of(X[rows]))
    return idx, dist


def columns_of(X: np.ndarray) -> np.ndarray:
    """Rows of any number type as contiguous float64 columns (d, n)."""
    return np.ascontiguousarray(X.T, dtype=np.float64)


def chunks(n: int, tree: Tree) -> list[slice]:
    """Rows taken together: a table of distances to one box's centroids stays in
    cache; of many boxes, each is then visited by few rows at a time."""
    most = max(len(own) for own in tree.leaves)
    step = max(1, BLOCK_ELEMS // most) * (1 if len(tree.leaves) == 1 else 4)
    return [slice(low, min(n, low + step)) for low in range(0, n, step)]


def nearest_fast(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BLAS form for wide vectors: argmin of |x|^2 - 2 x.c + |c|^2, then the
    chosen distance recomputed exactly.  Labels can differ from
    :func:`nearest` only where two centroids are within rounding of a tie."""
    n = X.shape[0]
    idx = np.empty(n, dtype=np.int64)
    c2 = np.einsum("ij,ij->i", C, C)
    step = max(1, BLOCK_ELEMS // max(1, C.shape[0]))
    for lo in range(0, n, step):
        Xb = X[lo:lo + step]
        D = c2[None, :] - 2.0 * (Xb @ C.T)
        idx[lo:lo + step] = D.argmin(axis=1)
    diff = X - C[idx]
    acc = np.zeros(n)
    for j in range(X.shape[1]):
        acc += diff[:, j] * diff[:, j]
    return idx, acc


def slack(d: int) -> float:
    """More than the relative error of a computed distance of ``d`` features."""
    return 16.0 * (d + 16) * 2.0 ** -52


def bounds(X: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Per point its nearest centroid, and a distance below which no other
    centroid lies."""
    label, far = np.empty(len(X), np.int32), np.empty(len(X))
    for rows in chunks(len(X), tree):
        label[rows], _, second = tree.nearest(columns_of(X[rows]), second=True)
        far[rows] = np.sqrt(second) * (1.0 - slack(X.shape[1]))
    return label, far


def drifts(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Per centroid, how far any of the others has moved at most."""
    moved = np.sqrt(np.sum((new - old) ** 2, axis=1)) * (1.0 + slack(new.shape[1]))
    if len(moved) == 1:
        return np.zeros(1)
    most = int(np.argmax(moved))
    out = np.full(len(moved), moved[most])
    out[most] = np.delete(moved, most).max()
    return out


def half_gaps(C: np.ndarray) -> np.ndarray:
    """Per centroid, half its distance to the nearest other one, or a bit less:
    a point nearer than that to it is nearest to it."""
    _, _, second = Tree(C).nearest(np.ascontiguousarray(C.T), second=True)
    return 0.5 * np.sqrt(second) * (1.0 - slack(C.shape[1]))


def bounded_nearest(XT: np.ndarray, tree: Tree, CT: np.ndarray, label: np.ndarray, far: np.ndarray, drift: np.ndarray,
                    gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """:meth:`Tree.nearest` for points whose nearest centroid was ``label``
    when no other lay below ``far``, and the number of points searched anew.

    The others have moved by ``drift`` at most.  A point that is nearer to its
    own centroid than what that leaves, or than ``gap`` (:func:`half_gaps`, or 0),
    by more than rounding can do, keeps it: one distance instead of all."""
    idx = label.astype(np.int64)
    dist = own_sq_dists(XT, CT, idx)
    left = np.maximum(far - drift[idx], gap[idx])
    sure = (left > 1e-140) & (dist * (1.0 + slack(XT.shape[0])) < left * left)
    rest = np.flatnonzero(~sure)
    if len(rest):
        idx[rest], dist[rest] = tree.nearest(np.ascontiguousarray(XT[:, rest]))
    return idx, dist, len(rest)


def column_sums(idx: np.ndarray, XT: np.ndarray, k: int) -> np.ndarray:
    """(k, d) sums of each group's columns of ``XT`` (any order: for values of
    which every sum is exact)."""
    return np.stack([np.bincount(idx, weights=x, minlength=k) for x in XT], axis=1) if len(XT) else np.zeros((k, 0))
