"""Ranked merges of adjacent parts, the inner step of both tokenizers."""

from __future__ import annotations

import heapq

#: Up to so many parts a plain scan is faster than a heap.
SCAN = 48


def merged(parts: list, ranks: dict) -> list:
    """Join the adjacent pair of least rank (leftmost first) until no pair has
    one.  ``ranks`` maps the joined value to its rank.  Long inputs take a heap
    over a linked list: n log n, so one huge word is no quadratic task."""
    if len(parts) > SCAN:
        return _merged_heap(parts, ranks)
    get = ranks.get
    parts = list(parts)
    pairs = [get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best, at = None, -1
        for i, r in enumerate(pairs):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if at < 0:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at])
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1])


def _merged_heap(parts: list, ranks: dict) -> list:
    get, n = ranks.get, len(parts)
    part, before, after = list(parts), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 1) for i in range(n - 1) if (r := get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, j = heapq.heappop(heap)
        if part[i] is None or after[i] != j or j >= n or get(part[i] + part[j]) != r:
            continue
        part[i] += part[j]
        part[j] = None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (q := get(part[i] + part[after[i]])) is not None:
                heapq.heappush(heap, (q, i, after[i]))
        if before[i] >= 0 and (q := get(part[before[i]] + part[i])) is not None:
            heapq.heappush(heap, (q, before[i], i))
    return [p for p in part if p is not None]
