"""Balanced clusters of a bounded sample, and a graph over their centroids that is searched in memory."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEAR, FAR = 20, 6  # links of a centroid: to its nearest ones, and to any
CELLS = 1 << 21  # distances from points to centroids that are held at a time
PAIRS = 1 << 17  # distances computed at a time
HALVINGS = 4  # rounds of two-means before a cluster is cut


def balanced_clusters(points: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """Centroids of clusters of about ``size`` points each.

    A cluster is cut in two at the median of the direction between its two
    means, so both halves are equally large, however dense the parts are.
    """
    draw = np.random.default_rng(seed)
    waiting, centroids = [points], []
    while waiting:
        part = waiting.pop()
        if len(part) < 2 * size:
            centroids.append(part.mean(axis=0))
            continue
        means = part[draw.choice(len(part), 2, replace=False)]
        for _ in range(HALVINGS):
            order = np.argsort(part @ (means[1] - means[0]), kind="stable")
            halves = part[order[: len(part) // 2]], part[order[len(part) // 2 :]]
            means = np.stack([half.mean(axis=0) for half in halves])
        waiting += halves
    return np.stack(centroids)


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Between all points and all centres."""
    products = points @ centres.T
    return np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * products, 0)


@dataclass
class CentroidGraph:
    centroids: np.ndarray
    links: np.ndarray  # per centroid the numbers of those it is linked to
    entries: np.ndarray  # centroids at which a search begins

    @staticmethod
    def over(centroids: np.ndarray, seed: int = 5) -> CentroidGraph:
        """The graph over some thousand centroids; their number is bounded by whoever chose them."""
        centroids = centroids.astype(np.float32)
        count = len(centroids)
        draw = np.random.default_rng(seed)
        near = min(NEAR, count - 1)
        links = np.zeros((count, near + FAR), dtype=np.int32)
        for begin in range(0, count, 1024):
            apart = squared_distances(centroids[begin : begin + 1024], centroids)
            apart[np.arange(len(apart)), np.arange(begin, begin + len(apart))] = np.inf
            if near:
                links[begin : begin + 1024, :near] = np.argpartition(apart, near - 1, axis=1)[:, :near]
        links[:, near:] = draw.integers(0, count, (count, FAR))
        entries = draw.choice(count, min(count, max(16, int(np.sqrt(count)))), replace=False)
        return CentroidGraph(centroids, links, entries)

    def near(self, points: np.ndarray, least: int, ratio: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, centroid, distance) of the ``least`` nearest centroids of each point and of all
        that are at most ``ratio`` times as far as the nearest; by point and distance.

        The search follows the links of all centroids found so far that are near
        enough, round by round, until it has followed them all.
        """
        step = max(1, CELLS // len(self.centroids))
        parts = [self._near(points[at : at + step], least, ratio) for at in range(0, len(points), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        rows = np.concatenate([part[0] + at * step for at, part in enumerate(parts)])
        return rows, np.concatenate([part[1] for part in parts]), np.concatenate([part[2] for part in parts])

    def _near(self, points: np.ndarray, least: int, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = points.astype(np.float32)
        least = min(least, len(self.centroids))
        known = np.full((len(points), len(self.centroids)), np.inf, dtype=np.float32)
        known[:, self.entries] = squared_distances(points, self.centroids[self.entries])
        followed = np.zeros(known.shape, dtype=bool)
        while True:
            bound = np.maximum(np.partition(known, least - 1, axis=1)[:, least - 1], ratio**2 * known.min(axis=1))
            inside = (known <= bound[:, None]) & np.isfinite(known)
            rows, numbers = np.nonzero(inside & ~followed)
            if not len(rows):
                break
            followed |= inside
            new = np.zeros(known.shape, dtype=bool)
            new[np.repeat(rows, self.links.shape[1]), self.links[numbers].ravel()] = True
            rows, numbers = np.nonzero(new & np.isinf(known))
            for at in range(0, len(rows), PAIRS):
                row, number = rows[at : at + PAIRS], numbers[at : at + PAIRS]
                known[row, number] = ((points[row] - self.centroids[number]) ** 2).sum(axis=1)
        rows, numbers = np.nonzero(inside)
        distances = np.sqrt(known[rows, numbers].astype(float))
        order = np.lexsort((numbers, distances, rows))
        return rows[order], numbers[order], distances[order]
