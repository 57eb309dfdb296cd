"""Bin completion over counts of sizes.

Items are given as a count per size, at most ``capacity - 1`` different sizes, so
the work here does not grow with the number of items: a filling that is chosen is
used as often as the counts allow, and each use ends at least one size.
"""

from __future__ import annotations

import numpy as np

Filling = tuple[int, ...]
Packing = list[tuple[Filling, int]]  # fillings, largest item first, and how often each is used

NODES = 800  # search nodes looked at before the incumbent is taken
BRANCHES = 2  # fillings kept at a node
EVERY = 20  # nodes between two best-fit completions


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins needed at least: over every k, items above capacity - k stand alone, those above half the capacity need a
    bin each, and the items from k up need the room that the latter leave."""
    sizes = np.arange(len(counts))
    number, room = np.cumsum(counts[::-1])[::-1], np.cumsum((counts * sizes)[::-1])[::-1]
    number, room = np.append(number, [0, 0]), np.append(room, [0, 0])
    half = capacity // 2
    best = -(-int(room[0]) // capacity)
    k = np.arange(1, half + 1)
    above, alone = number[half + 1], number[capacity - k + 1]
    left = (above - alone) * capacity - (room[half + 1] - room[capacity - k + 1])
    need = room[k] - room[half + 1] - left
    return max(best, int((above + np.maximum(0, -(-need // capacity))).max(initial=0)))


def best_fit(counts: np.ndarray, capacity: int) -> Packing:
    """Best-fit decreasing: each item, largest first, into the fullest bin that takes it."""
    open_bins: dict[int, list[list]] = {}
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        fits = sorted(room for room in open_bins if room >= size)
        for room in fits + [capacity]:
            per = room // size
            sources = open_bins.pop(room, []) if room < capacity else [[(), left]]
            rest = []
            for filling, times in sources:
                full = min(times, left // per) if left else 0
                if full:
                    open_bins.setdefault(room - per * size, []).append([filling + (size,) * per, full])
                    left -= full * per
                    times -= full if room < capacity else 0
                if left and left < per and times:
                    open_bins.setdefault(room - left * size, []).append([filling + (size,) * left, 1])
                    left = 0
                    times -= 1
                if room < capacity and times:
                    rest.append([filling, times])
            if rest:
                open_bins.setdefault(room, []).extend(rest)
            if not left:
                break
    return [(filling, times) for group in open_bins.values() for filling, times in group]


def bins_of(packing: Packing) -> int:
    return sum(times for _, times in packing)


def completions(counts: np.ndarray, room: int, waste: int) -> list[Filling]:
    """Up to BRANCHES undominated ways to fill ``room``, least waste first, then fewest items.

    A filling leaves at most ``waste`` and has at most three more items; where only smaller ones are left, best fit
    takes over. A filling is dominated if an item that is left fits beside it or, being larger, in place of
    one or two of its items.
    """
    found: list[Filling] = []
    have = counts > 0
    for total in np.flatnonzero(_reachable(have, room))[::-1].tolist():
        if room - total > waste or found:
            break
        for chosen in _exact(counts, have, total):
            if not _dominated(chosen, room - total, counts):
                found.append(chosen)
                if len(found) == BRANCHES:
                    return found
    return found


def _reachable(have: np.ndarray, room: int) -> np.ndarray:
    """Which sums up to ``room`` at most three sizes can have, if each may be used again."""
    one = have[: room + 1].astype(float)
    two = np.minimum(np.convolve(one, one)[: room + 1], 1)
    sums = one + two + np.convolve(two, one)[: room + 1] > 0.5
    sums[:1] = True
    return sums


def _exact(counts: np.ndarray, have: np.ndarray, total: int):
    """Multisets of at most three sizes with this sum, fewest items first and larger items first."""
    if total == 0:
        yield ()
        return
    if total < len(have) and have[total]:
        yield (total,)
    yield from _two(counts, have, total, total)
    for first in np.flatnonzero(have[: total + 1])[::-1].tolist():
        if 3 * first < total:
            break
        yield from ((first, *pair) for pair in _two(counts, have, total - first, first) if _enough(counts, (first, *pair)))


def _two(counts: np.ndarray, have: np.ndarray, total: int, most: int):
    """Pairs (a, b) with a + b = total and most >= a >= b >= 1."""
    top = min(most, total - 1, len(have) - 1)
    a = np.arange((total + 1) // 2, top + 1)
    for size in a[have[a] & have[total - a]][::-1].tolist() if len(a) else ():
        if size != total - size or counts[size] > 1:
            yield size, total - size


def _enough(counts: np.ndarray, chosen: Filling) -> bool:
    return all(chosen.count(size) <= counts[size] for size in set(chosen))


def _dominated(chosen: Filling, left: int, counts: np.ndarray) -> bool:
    free = counts.copy()
    for size in chosen:
        free[size] -= 1
    if free[1 : left + 1].any():
        return True
    if any(free[size + 1 : size + left + 1].any() for size in set(chosen)):
        return True
    return any(
        free[a + b : a + b + left + 1].any() for i, a in enumerate(chosen) for b in chosen[i + 1 :]
    )


def fewest_bins(counts: np.ndarray, capacity: int, nodes: int = NODES) -> Packing:
    """Branch and bound around the largest item that is left.

    A dive takes the best completion of the largest item, as often as it goes, until nothing is left; the next dives
    take the second one at one node. What is left is also packed by best fit, which gives incumbents, and a dive is cut
    where its bins and the bound of its rest reach the incumbent. With the bound of all items met the packing is optimal;
    otherwise it is the best of ``nodes`` nodes.
    """
    counts = counts.astype(np.int64)
    sizes = np.arange(len(counts))
    best, goal, seen, turn = best_fit(counts, capacity), lower_bound(counts, capacity), 0, -1
    while seen < nodes and bins_of(best) > goal and turn < len(counts):
        left, done, used, depth = counts, [], 0, 0
        while left.any() and seen < nodes and used + lower_bound(left, capacity) < bins_of(best):
            if depth % EVERY == 0:
                rest = best_fit(left, capacity)
                if used + bins_of(rest) < bins_of(best):
                    best = done + rest
            largest = int(np.flatnonzero(left)[-1])
            others = left.copy()
            others[largest] -= 1
            waste = (bins_of(best) - 1 - used) * capacity - int((left * sizes).sum())
            fillings = completions(others, capacity - largest, max(0, min(waste, capacity)))
            if not fillings:
                break
            other = depth == turn and len(fillings) > 1
            left, packed, times = _used(left, (largest, *fillings[int(other)]))
            done, used = done + packed, used + times
            seen, depth = seen + 1, depth + 1
        rest = best_fit(left, capacity)
        if used + bins_of(rest) < bins_of(best):
            best = done + rest
        turn += 1
    return best


def _used(counts: np.ndarray, filling: Filling) -> tuple[np.ndarray, Packing, int]:
    need = np.bincount(filling, minlength=len(counts))
    asked = need > 0
    times = int((counts[asked] // need[asked]).min())
    return counts - need * times, [(filling, times)], times
