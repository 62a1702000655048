"""Navigable small-world graphs over blocks of vectors, searched many queries at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Flags of one search at most (queries x nodes), and numbers held at once while links are chosen.
FLAGS, CHOSEN = 8_000_000, 4_000_000


def exhaustive(base: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest base rows of each query by comparing with all: (ids, squared distances)."""
    k = min(k, len(base))
    ids, dist = np.empty((len(queries), k), np.int64), np.empty((len(queries), k), np.float32)
    norm = (base * base).sum(1)
    for lo in range(0, len(queries), 512):
        q = queries[lo : lo + 512]
        d = norm[None, :] - 2 * q @ base.T + (q * q).sum(1)[:, None]
        part = np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(base) else np.tile(np.arange(len(base)), (len(q), 1))
        got = np.take_along_axis(d, part, 1)
        order = np.argsort(got, axis=1, kind="stable")
        ids[lo : lo + 512], dist[lo : lo + 512] = np.take_along_axis(part, order, 1), np.take_along_axis(got, order, 1)
    return ids, np.maximum(dist, 0)


def outside(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of vectors from boxes, 0 inside."""
    off = np.maximum(np.maximum(lo - v, v - hi), 0)
    return np.einsum("...j,...j->...", off, off)


def inside_exhaustive(base: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (query, node) with the node inside the query's box, by comparing with every node."""
    rows, ids = [], []
    step = max(1, 4_000_000 // max(base.size, 1))
    for a in range(0, len(lo), step):
        r, i = np.nonzero(outside(base[None, :, :], lo[a : a + step, None, :], hi[a : a + step, None, :]) == 0)
        rows.append(a + r)
        ids.append(i)
    return np.concatenate([*rows, np.empty(0, int)]).astype(np.int64), np.concatenate([*ids, np.empty(0, int)]).astype(np.int64)


class SmallWorld:
    """A graph shard.

    Nodes are inserted in doubling blocks. Each is linked both ways to near ones,
    found by searching the graph so far and within its piece of the block: first
    those that no link chosen before is nearer to (they lead out of dense spots),
    then the nearest. A few links go far off.
    """

    def __init__(self, base: np.ndarray, links: int = 12, far: int = 4, beam: int = 32, seed: int = 7):
        self.base = np.ascontiguousarray(base, np.float32)
        self.beam, self.recall = beam, 1.0
        n, rng = len(base), np.random.default_rng(seed)
        self.near = np.full((n, 2 * links), -1, np.int32)
        self.far = np.full((n, far), -1, np.int32)
        self.size = 0
        while self.size < n:
            lo, hi = self.size, min(n, self.size + max(64, self.size))
            new = np.arange(lo, hi)
            if lo:
                ids, d = self.search(self.base[lo:hi], links)
                self._link(np.repeat(new, ids.shape[1]), ids.ravel())
            self.far[lo:hi] = rng.integers(0, hi, (hi - lo, far))
            for a in range(lo, hi, 1024):
                part = new[a - lo : a - lo + 1024]
                ids, _ = exhaustive(self.base[part], self.base[part], links + 1)
                self._link(np.repeat(part, ids.shape[1]), part[ids].ravel())
            self.size = hi

    @classmethod
    def stored(cls, base: np.ndarray, near: np.ndarray, far: np.ndarray, beam: int) -> SmallWorld:
        """A graph as it was written: nothing is built."""
        graph = cls.__new__(cls)
        graph.base, graph.near, graph.far, graph.beam, graph.size = base, near, far, beam, len(base)
        return graph

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Offer links both ways; each touched node chooses among its old and new ones."""
        ok = (a != b) & (b >= 0)
        src, dst = np.concatenate([a[ok], b[ok]]), np.concatenate([b[ok], a[ok]])
        touched = np.unique(src)
        old = self.near[touched]
        r, c = np.nonzero(old >= 0)
        code = np.unique(np.concatenate([src.astype(np.int64), touched[r]]) * len(self.base) + np.concatenate([dst.astype(np.int64), old[r, c]]))
        src, dst = code // len(self.base), code % len(self.base)
        start = np.searchsorted(src, touched)
        place = np.arange(len(src)) - np.repeat(start, np.diff(np.append(start, len(src))))
        # nodes with few offers first, so that a piece's table is as wide as its own offers
        count = np.bincount(np.searchsorted(touched, src), minlength=len(touched))
        order = np.argsort(count, kind="stable")
        slot = np.empty(len(touched), np.int64)
        slot[order] = np.arange(len(touched))
        row = slot[np.searchsorted(touched, src)]
        by_row = np.argsort(row, kind="stable")
        row, dst, place = row[by_row], dst[by_row], place[by_row]
        count, lo = count[order], 0
        while lo < len(touched):
            hi = lo + 1
            while hi < len(touched) and (hi + 1 - lo) * int(count[hi]) * self.base.shape[1] <= CHOSEN:
                hi = min(len(touched), lo + 2 * (hi - lo)) if (2 * (hi - lo)) * int(count[min(lo + 2 * (hi - lo), len(touched)) - 1]) * self.base.shape[1] <= CHOSEN else hi + 1
            x, y = np.searchsorted(row, [lo, hi])
            offers = np.full((hi - lo, int(place[x:y].max(initial=0)) + 1), -1, np.int64)
            offers[row[x:y] - lo, place[x:y]] = dst[x:y]
            node = touched[order[lo:hi]]
            self.near[node] = self._choose(node, offers)
            lo = hi

    def _choose(self, node: np.ndarray, offers: np.ndarray) -> np.ndarray:
        width = self.near.shape[1]
        v = self.base[np.maximum(offers, 0)]
        diff = v - self.base[node][:, None, :]
        d = np.where(offers >= 0, np.einsum("ijk,ijk->ij", diff, diff), np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, : 2 * width]
        offers, d = np.take_along_axis(offers, order, 1), np.take_along_axis(d, order, 1)
        if offers.shape[1] <= width // 2:
            return np.pad(offers, ((0, 0), (0, width - offers.shape[1])), constant_values=-1)
        diff = np.take_along_axis(diff, order[:, :, None], 1)
        norm = np.einsum("ijk,ijk->ij", diff, diff)
        between = norm[:, :, None] + norm[:, None, :] - 2 * diff @ diff.transpose(0, 2, 1)
        kept = np.zeros(offers.shape, bool)
        for r in range(offers.shape[1]):  # a link is kept if no kept one is nearer to its end than the node is
            kept[:, r] = (offers[:, r] >= 0) & ~((between[:, r] < d[:, r, None]) & kept).any(1)
        # half of the places for such links at most, nearest first; the rest for the nearest of all
        led = kept & (np.cumsum(kept, 1) <= width // 2)
        rank = np.where(led, 0, 1) * offers.shape[1] + np.arange(offers.shape[1])
        pick = np.argsort(np.where(offers >= 0, rank, 10**6), axis=1, kind="stable")[:, :width]
        got = np.take_along_axis(offers, pick, 1)
        return np.pad(got, ((0, 0), (0, width - got.shape[1])), constant_values=-1)

    def _pieces(self, m: int) -> Iterator[slice]:
        step = max(16, min(512, FLAGS // max(self.size, 1)))
        for lo in range(0, m, step):
            yield slice(lo, min(lo + step, m))

    def search(self, queries: np.ndarray, k: int, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest found by a beam search: (ids, squared distances), -1 and inf where there are fewer."""
        q, k = np.ascontiguousarray(queries, np.float32), min(k, self.size)
        ids, dist = np.empty((len(q), k), np.int64), np.empty((len(q), k), np.float32)
        for s in self._pieces(len(q)):
            part = q[s]

            def measure(r: np.ndarray, v: np.ndarray, part: np.ndarray = part) -> np.ndarray:
                diff = v - part[r]
                return np.einsum("ij,ij->i", diff, diff)

            i, d = self._beam(measure, len(part), min(max(beam or self.beam, k), self.size))
            ids[s], dist[s] = i[:, :k], d[:, :k]
        return ids, dist

    def inside(self, lo: np.ndarray, hi: np.ndarray, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) for the nodes inside each query's box, by a beam search on the distance from the box.

        Where even the farthest node kept lies inside, the beam is doubled and the
        query searched again, so there is no limit to what a query gets.
        """
        rows, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in self._pieces(len(lo)):
            todo, width = np.arange(s.start, s.stop), min(beam or self.beam, self.size)
            while len(todo):
                low, high = lo[todo], hi[todo]
                ids, d = self._beam(lambda r, v, low=low, high=high: outside(v, low[r], high[r]), len(todo), width)
                more = (d[:, -1] == 0) & (width < self.size)
                r, c = np.nonzero((d == 0) & ~more[:, None])
                rows.append(todo[r])
                nodes.append(ids[r, c])
                todo, width = todo[more], min(2 * width, self.size)
        return np.concatenate(rows), np.concatenate(nodes)

    def _beam(self, measure: Callable[[np.ndarray, np.ndarray], np.ndarray], m: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes found for each of ``m`` queries, best first."""
        n, expand = self.size, 4
        start = np.unique(np.random.default_rng(1).integers(0, n, 48))
        seen = np.zeros((m, n), bool)
        seen[:, start] = True
        rows = np.arange(m)
        ids = np.tile(start, (m, 1))
        d = measure(np.repeat(rows, len(start)), self.base[ids.ravel()]).reshape(ids.shape)
        done = np.zeros(ids.shape, bool)
        out_i, out_d = np.full((m, width), -1, np.int64), np.full((m, width), np.inf, np.float32)
        while len(rows):
            if ids.shape[1] > width:
                keep = np.argpartition(d, width - 1, axis=1)[:, :width]
                ids, d, done = (np.take_along_axis(v, keep, 1) for v in (ids, d, done))
            left = np.where(done, np.inf, d)
            if left.shape[1] > expand:
                pick = np.argpartition(left, expand - 1, axis=1)[:, :expand]
            else:
                pick = np.tile(np.arange(left.shape[1]), (len(rows), 1))
            best = np.take_along_axis(left, pick, 1)
            on = np.isfinite(best).any(1)
            if not on.all():
                f, w = rows[~on], min(ids.shape[1], width)
                out_i[f, :w], out_d[f, :w] = ids[~on], d[~on]
                rows, ids, d, done, pick, best = rows[on], ids[on], d[on], done[on], pick[on], best[on]
                if not len(rows):
                    break
            np.put_along_axis(done, pick, True, 1)
            at = np.where(np.isfinite(best), np.take_along_axis(ids, pick, 1), -1)
            links = np.concatenate([self.near[np.maximum(at, 0)], self.far[np.maximum(at, 0)]], 2)
            links = np.where(at[:, :, None] >= 0, links, -1).reshape(len(rows), -1)
            links = np.where((links >= 0) & (links < n), links, -1)
            links.sort(axis=1)
            links[:, 1:][links[:, 1:] == links[:, :-1]] = -1
            fresh = (links >= 0) & ~seen[rows[:, None], np.maximum(links, 0)]
            r, c = np.nonzero(fresh)
            seen[rows[r], links[r, c]] = True
            # the fresh ones to the left, in a table as wide as the most of them
            count = fresh.sum(1)
            col = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
            new_i, new_d = np.full((len(rows), int(count.max(initial=0))), -1, np.int64), np.full((len(rows), int(count.max(initial=0))), np.inf, np.float32)
            if len(r):
                new_i[r, col] = links[r, c]
                new_d[r, col] = measure(rows[r], self.base[links[r, c]])
            ids, d, done = np.concatenate([ids, new_i], 1), np.concatenate([d, new_d], 1), np.concatenate([done, new_i < 0], 1)
        order = np.argsort(out_d, axis=1, kind="stable")
        return np.take_along_axis(out_i, order, 1), np.take_along_axis(out_d, order, 1)

    def tune_inside(self, lo: np.ndarray, hi: np.ndarray, recall: float) -> float:
        """Widen the beam until the boxes' nodes are found as by an exhaustive search; the share reached."""
        rows, nodes = inside_exhaustive(self.base, lo, hi)
        want = np.unique(rows * self.size + nodes)
        while True:
            rows, nodes = self.inside(lo, hi)
            self.recall = float(len(np.intersect1d(want, rows * self.size + nodes)) / len(want)) if len(want) else 1.0
            if self.recall >= recall or self.beam >= self.size:
                return self.recall
            self.beam = min(2 * self.beam, self.size)

    def tune(self, k: int, recall: float = 0.995, sample: int = 128, seed: int = 3) -> float:
        """The same for the k nearest of a sample of nodes, moved a little."""
        rng = np.random.default_rng(seed)
        pick = rng.choice(self.size, min(sample, self.size), replace=False)
        near = self.base[pick] + rng.normal(0, 0.01, (len(pick), self.base.shape[1])).astype(np.float32) * (np.abs(self.base[pick]).mean() + 1e-6)
        _, want = exhaustive(self.base, near, k)
        while True:
            _, got = self.search(near, k, self.beam)
            self.recall = float((got <= want[:, -1:] * (1 + 1e-4) + 1e-6).sum() / want.size)
            if self.recall >= recall or self.beam >= self.size:
                return self.recall
            self.beam *= 2
