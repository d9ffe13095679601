"""Shortest-pack-first packing over a histogram of lengths."""

from __future__ import annotations

from heapq import heappop, heappush


def shortest_pack_first(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack in order of placement, packs of this pattern) for counts[length] pieces.

    Lengths are placed longest first, each into the shortest packs that there are
    (most space left); a pack is opened only when the shortest has no room. Equal
    packs are one pattern with a count, so work and result depend on the number
    of lengths, not of pieces.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # space left -> patterns
    spaces: list[int] = []  # largest first, negated

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if space not in room:
            room[space] = []
            heappush(spaces, -space)
        room[space].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        while left > 0:
            space = -spaces[0] if spaces else 0
            if space < length:
                each = capacity // length  # a new pack stays the shortest until it has no room for another
                if left >= each:
                    put(capacity - each * length, (length,) * each, left // each)
                if left % each:
                    put(capacity - left % each * length, (length,) * (left % each), 1)
                left = 0
                continue
            pattern, n = room[space].pop()
            if not room[space]:
                del room[space]
                heappop(spaces)
            used = min(n, left)
            if used < n:
                put(space, pattern, n - used)
            put(space - length, (*pattern, length), used)
            left -= used
    return [x for space in sorted(room) for x in room[space]]
