"""Hierarchical navigable small-world graphs, built and searched for many vectors at a time in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Neighbours of a node above the ground level, and on it.
UPPER, GROUND = 16, 32
#: Beam while building, and the first beam of a search.
BUILD_BEAM, BEAM = 96, 64
#: Vectors that are inserted or searched at once; candidates that a search opens at once.
TOGETHER, OPENED = 512, 4


def levels_of(names: np.ndarray) -> np.ndarray:
    """Level of each node, geometric with ratio 1 / UPPER, by a hash of its name."""
    x = names.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(32))
    u = (x >> np.uint64(11)).astype(np.float64) / 2.0**53 + 1e-17
    return np.minimum((-np.log(u) / np.log(UPPER)).astype(np.int64), 12)


@dataclass
class Graph:
    """``vectors`` have length 1 and come by falling level: the nodes of a level are a prefix. -1 marks no neighbour."""

    vectors: np.ndarray
    links: list[np.ndarray] = field(default_factory=list)  # one row per node of each level

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray) -> Graph:
        graph = cls(vectors)
        n = len(vectors)
        for level in range(int(levels.max(initial=0)) + 1):
            nodes = int((levels >= level).sum())
            graph.links.append(np.full((nodes, UPPER if level else GROUND), -1, np.int32))
        done = 0
        while done < n:
            upto = min(n, done + max(1, min(TOGETHER, done)))
            graph._insert(done, upto)
            done = upto
        return graph

    def _insert(self, first: int, last: int) -> None:
        new = np.arange(first, last)
        entry = np.zeros(len(new), np.int64)
        for level in range(len(self.links) - 1, -1, -1):
            own = new[new < len(self.links[level])]
            if first == 0:
                near = np.full((len(new), 1), -1)
            elif not len(own) or len(own) < len(new):
                # Nodes below this level only pass through; those on it search widely.
                near, _ = self.search(self.vectors[new], 1 if not len(own) else BUILD_BEAM, entry, level, first)
                entry = np.where(near[:, 0] >= 0, near[:, 0], entry)
            else:
                near, _ = self.search(self.vectors[new], BUILD_BEAM, entry, level, first)
                entry = np.where(near[:, 0] >= 0, near[:, 0], entry)
            if len(own):
                width = self.links[level].shape[1]
                peers = self._peers(own, width)
                chosen = self._select(own, np.concatenate([near[: len(own)], peers], axis=1), width)
                self.links[level][own] = chosen
                self._link_back(own, chosen, level)

    def _peers(self, own: np.ndarray, count: int) -> np.ndarray:
        """The nearest of those that are inserted together."""
        if len(own) < 2:
            return np.full((len(own), 1), -1)
        sims = self.vectors[own] @ self.vectors[own].T
        np.fill_diagonal(sims, -2)
        count = min(count, len(own) - 1)
        return own[np.argpartition(-sims, count - 1, axis=1)[:, :count]]

    def _select(self, nodes: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
        """Of each node's candidates, those nearer to it than to one chosen before; then the nearest of the rest."""
        candidates = np.where(candidates == nodes[:, None], -1, candidates)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        sims = np.einsum("bd,bcd->bc", self.vectors[nodes], self.vectors[np.maximum(candidates, 0)])
        sims[candidates < 0] = -3
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * width]
        rows = np.arange(len(nodes))
        candidates, sims = candidates[rows[:, None], order], np.take_along_axis(sims, order, axis=1)
        valid = candidates >= 0
        most = int(valid.sum(axis=1).max(initial=0))
        candidates, sims, valid = candidates[:, :most], sims[:, :most], valid[:, :most]
        near = self.vectors[np.maximum(candidates, 0)]
        between = near @ np.ascontiguousarray(near.transpose(0, 2, 1))
        taken = np.zeros(candidates.shape, bool)
        count = np.zeros(len(nodes), np.int64)
        for j in range(most):
            hidden = (taken & (between[:, j] >= sims[:, j, None])).any(axis=1)
            taken[:, j] = valid[:, j] & ~hidden & (count < width)
            count += taken[:, j]
        # Then the nearest of the rest: valid ones left, in order, up to the width.
        spare = valid & ~taken
        taken |= spare & (np.cumsum(spare, axis=1) <= (width - count)[:, None])
        chosen = np.full((len(nodes), width), -1, np.int64)
        row, column = np.nonzero(taken)
        chosen[row, (np.cumsum(taken, axis=1) - 1)[row, column]] = candidates[row, column]
        return chosen

    def _link_back(self, nodes: np.ndarray, chosen: np.ndarray, level: int) -> None:
        links = self.links[level]
        ok = chosen >= 0
        target, source = chosen[ok], np.repeat(nodes, ok.sum(axis=1))
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        unique, start, count = np.unique(target, return_index=True, return_counts=True)
        if not len(unique):
            return
        extra = np.full((len(unique), int(count.max())), -1, np.int64)
        row = np.repeat(np.arange(len(unique)), count)
        extra[row, np.arange(len(target)) - np.repeat(start, count)] = source
        # Those with the fewest new ones together, so that the tables stay narrow.
        by_count = np.argsort(count, kind="stable")
        for a in range(0, len(unique), TOGETHER):
            part = by_count[a : a + TOGETHER]
            new = extra[part, : count[part[-1]]]
            links[unique[part]] = self._select(unique[part], np.concatenate([links[unique[part]], new], axis=1), links.shape[1])

    def search(self, queries: np.ndarray, beam: int, entry: np.ndarray, level: int, below: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes that a best-first walk on one level finds, best first, among nodes less than ``below``."""
        b = len(queries)
        rows = np.arange(b)
        nodes = np.full((b, beam), -1, np.int64)
        sims = np.full((b, beam), -3.0, np.float32)
        opened = np.ones((b, beam), bool)
        seen = np.zeros((b, min(below, len(self.links[level]))), bool)
        nodes[:, 0], opened[:, 0] = entry, False
        sims[:, 0] = np.einsum("bd,bd->b", queries, self.vectors[entry])
        seen[rows, entry] = True
        live = rows
        links, wide = self.links[level], min(OPENED, beam)
        while len(live):
            # The best that are not opened yet; each row is sorted, so they come first.
            closed = opened[live]
            rank = np.where(closed, beam, np.arange(beam)[None, :])
            pick = np.partition(rank, wide - 1, axis=1)[:, :wide]
            has = pick < beam
            keep = has.any(axis=1)
            if not keep.all():
                live, pick, has = live[keep], pick[keep], has[keep]
                if not len(live):
                    break
            pick = np.minimum(pick, beam - 1)
            at = np.where(has, nodes[live[:, None], pick], -1)
            row, column = np.nonzero(has)
            opened[live[row], pick[row, column]] = True
            near = links[np.maximum(at, 0)].astype(np.int64)
            near[at < 0] = -1
            near = near.reshape(len(live), -1)
            near[(near >= seen.shape[1])] = -1
            near[seen[live[:, None], np.maximum(near, 0)]] = -1
            # One node may stand in several lists.
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            row, column = np.nonzero(near >= 0)
            seen[live[row], near[row, column]] = True
            found = np.einsum("bd,bcd->bc", queries[live], self.vectors[np.maximum(near, 0)])
            found[near < 0] = -3
            all_sims = np.concatenate([sims[live], found], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], near], axis=1), order, axis=1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], near < 0], axis=1), order, axis=1)
            sims[live] = np.take_along_axis(all_sims, order, axis=1)
        return nodes, sims

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Down the levels, and then with a beam on the ground."""
        entry = np.zeros(len(queries), np.int64)
        for level in range(len(self.links) - 1, 0, -1):
            near, _ = self.search(queries, 1, entry, level, len(self.vectors))
            entry = near[:, 0]
        return self.search(queries, beam, entry, 0, len(self.vectors))

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of a similarity of ``least`` or more: where the whole beam is that near, it is widened."""
        queries_left = np.arange(len(queries))
        out_q, out_n = [], []
        while len(queries_left):
            beam = min(beam, len(self.vectors))
            full = []
            for a in range(0, len(queries_left), TOGETHER):
                part = queries_left[a : a + TOGETHER]
                nodes, sims = self.nearest(queries[part], beam)
                near = (sims >= least) & (nodes >= 0)
                again = near[:, -1] & (beam < len(self.vectors))
                full.append(part[again])
                row, column = np.nonzero(near & ~again[:, None])
                out_q.append(part[row])
                out_n.append(nodes[row, column])
            queries_left, beam = np.concatenate(full), beam * 2
        return np.concatenate([np.zeros(0, np.int64), *out_q]), np.concatenate([np.zeros(0, np.int64), *out_n])

    def audited_beam(self, least: float, wanted: float, audits: int = 256, more: np.ndarray | None = None) -> int:
        """The first beam, doubled each time, whose recall by brute force is at least ``wanted``.

        Probes are ``audits`` nodes and the vectors in ``more``, which may be nodes too. A probe's recall is
        the share of its pairs that are found, not counting itself; the mean is over probes that have a
        pair, where probes that link with each other count as one.
        """
        n = len(self.vectors)
        at = np.unique(np.linspace(0, n - 1, min(audits, n)).astype(np.int64))
        probes = self.vectors[at] if more is None or not len(more) else np.concatenate([self.vectors[at], more])
        true = np.zeros(len(probes), np.int64)
        itself = np.full(len(probes), -1)
        for a in range(0, n, 16384):
            sims = probes @ self.vectors[a : a + 16384].T
            true += (sims >= least).sum(axis=1)
            # Nodes are distinct vectors, so a probe that is a node equals one of them.
            row, column = np.nonzero(sims > 1 - 1e-5)
            same = (probes[row] == self.vectors[a + column]).all(axis=1)
            itself[row[same]] = a + column[same]
        true -= itself >= 0
        linked = probes @ probes.T >= least
        np.fill_diagonal(linked, True)
        group = np.arange(len(probes))
        while True:
            low = np.where(linked, group[None, :], len(probes)).min(axis=1)
            if (low == group).all():
                break
            group = low
        some = true > 0
        if not some.any():
            return BEAM
        of = np.unique(group[some], return_inverse=True)[1]
        beam = BEAM
        while beam < n:
            q, node = self.within(probes, least, beam)
            found = np.bincount(q[node != itself[q]], minlength=len(probes))
            recall = np.minimum(found[some] / true[some], 1.0)
            if (np.bincount(of, weights=recall) / np.bincount(of)).mean() >= wanted:
                break
            beam *= 2
        return beam
