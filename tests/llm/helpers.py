"""Brute-force versions that the operators are held against."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


def parts(nodes, edges):
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
