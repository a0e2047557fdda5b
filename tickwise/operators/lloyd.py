"""KMeans of one group's rows inside a task, with distance bounds kept between steps (ML-13)."""
from __future__ import annotations

import numpy as np


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres, by differences (no cancellation)."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def seed_centers(x: np.ndarray, u: np.ndarray, k: int) -> np.ndarray:
    """k-means++ by exponential races: centre j is the row of least -ln(u_j) / D²; without a row away from the centres the first one again."""
    centers = [x[u[:, 0].argmin()]]
    near = ((x - centers[0]) ** 2).sum(axis=1)
    for j in range(1, k):
        away = near > 0
        at = np.where(away, -np.log(u[:, j]) / np.where(away, near, 1.0), np.inf).argmin()
        centers.append(x[at] if away.any() else centers[0])
        near = np.minimum(near, ((x - centers[-1]) ** 2).sum(axis=1))
    return np.array(centers)


def lloyd(x: np.ndarray, centers: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, bool, int]:
    """Labels, squared distances, centres, steps, whether they rest, and how many rows were compared with all centres.

    A row keeps its label without a look at the centres while its upper bound
    (distance to its centre plus that centre's moves) stays below its lower
    bound (distance to the second nearest minus the largest move) and below
    half the way to the nearest other centre.  Bounds are widened by a
    rounding margin, so the labels are those of full comparisons (ties to the
    lowest centre).
    """
    n, k = len(x), len(centers)
    label, upper, lower = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf)
    compared = 0
    for it in range(1, max_iter + 1):
        apart = np.sqrt(_squares(centers, centers))
        np.fill_diagonal(apart, np.inf)
        reach = np.maximum(lower, apart.min(axis=1)[label] / 2) * (1 - 1e-12)
        open_ = np.flatnonzero(upper * (1 + 1e-12) >= reach)
        if it > 1 and len(open_):  # the exact distance to the own centre may settle it
            upper[open_] = np.sqrt(((x[open_] - centers[label[open_]]) ** 2).sum(axis=1))
            open_ = open_[upper[open_] * (1 + 1e-12) >= reach[open_]]
        if len(open_):
            d = np.sqrt(_squares(x[open_], centers))
            label[open_] = d.argmin(axis=1)
            upper[open_] = d.min(axis=1)
            lower[open_] = np.partition(d, 1, axis=1)[:, 1] if k > 1 else np.inf
            compared += len(open_)
        member = np.zeros((k, n))
        member[label, np.arange(n)] = 1.0
        count = member.sum(axis=1)
        new = np.where(count[:, None] > 0, member @ x / np.maximum(count, 1)[:, None], centers)
        move = np.sqrt(((new - centers) ** 2).sum(axis=1))
        shift, centers = float((move ** 2).sum()), new
        upper += move[label]
        lower -= move.max()
        if shift <= tol:
            break
    d2 = _squares(x, centers)
    label = d2.argmin(axis=1)
    return label, d2.min(axis=1), centers, it, shift <= tol, compared
