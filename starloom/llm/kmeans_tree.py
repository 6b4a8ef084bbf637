"""A hierarchical k-means tree over vectors, held as arrays so that it can go to
every task: fitting on a sample, placing vectors, best-bin-first traversal."""

from __future__ import annotations

import heapq

import numpy as np

#: Children of a node, sample rows of a leaf at most, rounds of each k-means.
BRANCH, LEAF, ROUNDS = 8, 64, 12


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to the centres."""
    return (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (x @ centres.T)


def _split(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres of the non-empty clusters of x, and each row's cluster."""
    centres = x[rng.choice(len(x), min(BRANCH, len(x)), replace=False)]
    for _ in range(ROUNDS):
        which = _squares(x, centres).argmin(1)
        centres = np.stack([x[which == j].mean(0) if (which == j).any() else c for j, c in enumerate(centres)])
    which = _squares(x, centres).argmin(1)
    some, which = np.unique(which, return_inverse=True)
    return centres[some], which


class Tree:
    """Nodes 0, 1, ... (0 is the root) with their centres; `children[i]` are the
    nodes below i, `leaf[i]` the number of a node without any."""

    def __init__(self, sample: np.ndarray, size: int):
        """Splits nodes of more than LEAF rows of the sample. Without a sample the
        tree is one leaf."""
        self.centres, self.children, self.leaf = np.zeros((1, size)), [[]], [-1]
        rng = np.random.default_rng(20240613)
        centres = [np.zeros(size)]
        todo = [(0, sample)]
        self.n_leaves = 0
        while todo:
            node, x = todo.pop()
            parts, which = _split(x, rng) if len(x) > LEAF else (x[:0], None)
            if len(parts) < 2:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            for j, centre in enumerate(parts):
                self.children[node].append(len(centres))
                todo.append((len(centres), x[which == j]))
                centres.append(centre)
                self.children.append([])
                self.leaf.append(-1)
        self.centres = np.stack(centres)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of x comes to by the nearest child of each node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            which = _squares(x[rows], self.centres[below]).argmin(1)
            todo += [(child, rows[which == j]) for j, child in enumerate(below) if (which == j).any()]
        return out

    def order(self, x: np.ndarray, visits: int, need: int, held: np.ndarray) -> list[list[int]]:
        """For every row of x the leaves in best-bin-first order: down by the nearest
        child, the others into a queue, on from the nearest node of the queue. Ends
        after `visits` leaves that hold `need` rows at least (`held`: rows by leaf)."""
        out = []
        for apart in _squares(x, self.centres):
            apart, queue, found, rows = apart.tolist(), [(0.0, 0)], [], 0
            while queue and (len(found) < visits or rows < need):
                node = heapq.heappop(queue)[1]
                while self.children[node]:
                    near = min(self.children[node], key=apart.__getitem__)
                    for child in self.children[node]:
                        if child != near:
                            heapq.heappush(queue, (apart[child], child))
                    node = near
                found.append(self.leaf[node])
                rows += held[self.leaf[node]]
            out.append(found)
        return out
