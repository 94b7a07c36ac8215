"""Bin packing of whole numbers by bin completion with branch and bound.

The items are given as counts by length, so the work depends on the different lengths and not on how many
items there are. A step takes the largest length left and gives all the *fillings* of the room beside it
that no other filling dominates: a filling is dominated if some of its items could be exchanged for an item
left out that is as long as they are together, or longer, and still fits. A filling is used for as many
bins at once as the counts allow, then for fewer. A branch ends where the waste it has, with the least
waste that its large items must still leave, is more than a better solution may have. Each node is also
completed by best fit decreasing; the best of these solutions is the incumbent.

The search ends when the incumbent meets the bound, when it is exhausted (the incumbent is then proven
best), or after ``effort`` fillings looked at: the incumbent is then a packing of all items all the same.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

Filling = tuple[tuple[int, int], ...]  # lengths, descending, and how often each
Plan = list[tuple[Filling, int]]  # fillings and the number of bins of each


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing: each item goes to the fullest bin that has room, else to a new one.

    Equal bins are handled together: items of one length fill the fullest bin as far as they go, then the next.
    """
    open_bins: dict[int, list[list]] = {}  # by room left: [filling, number of bins]
    rooms: list[int] = []

    def put(room: int, filling: Filling, bins: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append([filling, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        changed: list[tuple[int, Filling, int]] = []
        at = bisect_left(rooms, length)
        while left and at < len(rooms):
            room = rooms[at]
            each, classes = room // length, open_bins[room]
            while left and classes:
                filling, bins = classes.pop()
                full = min(bins, left // each)
                rest = left - full * each if full < bins else 0
                if full:
                    changed.append((room - each * length, (*filling, (length, each)), full))
                if 0 < rest < each:
                    changed.append((room - rest * length, (*filling, (length, rest)), 1))
                    full, left = full + 1, left - rest
                left -= (full - (0 < rest < each)) * each
                if full < bins:
                    classes.append([filling, bins - full])
            if not classes:
                del open_bins[room]
                rooms.pop(at)
        if left:
            each = capacity // length
            if left >= each:
                changed.append((capacity - each * length, ((length, each),), left // each))
            if left % each:
                changed.append((capacity - left % each * length, ((length, left % each),), 1))
        for one in changed:
            put(*one)
    return [(filling, bins) for room in rooms for filling, bins in open_bins[room]]


def least_waste(lengths: list[int], counts: dict[int, int], capacity: int) -> int:
    """What bins with an item of more than half the capacity must leave empty, whatever goes beside it.

    ``lengths`` are descending. Items of a length fit beside the largest only where there is that much room;
    what is not needed beside longer items is carried on to where there is more room."""
    waste = carried = 0
    small = len(lengths) - 1
    for length in lengths:
        if 2 * length <= capacity:
            break
        room = capacity - length
        while small >= 0 and lengths[small] <= room:
            carried += lengths[small] * counts[lengths[small]]
            small -= 1
        need = room * counts[length]
        waste, carried = waste + max(0, need - carried), max(0, carried - need)
    return waste


def dominated(filling: Filling, slack: int, left_out: list[int]) -> bool:
    """Whether items of the filling could be exchanged for one of the lengths left out (ascending)."""
    if left_out and left_out[0] <= slack:
        return True
    one = more = 0  # bit s: one item, two or more, have the sum s
    for length, times in filling:
        for _ in range(times):
            more |= (one | more) << length
            one |= 1 << length
    for length in left_out:
        low = max(1, length - slack)
        window = ((1 << (length - low + 1)) - 1) << low
        if more & window or one & (window & ~(1 << length)):
            return True
    return False


def fillings(lengths: list[int], counts: dict[int, int], room: int) -> Iterator[tuple[Filling | None, int]]:
    """Undominated fillings of ``room`` and their slack, long items first; None for each that is dominated.

    ``lengths`` are descending; ``counts`` may be changed between two fillings only back to what it was."""
    fitting = [length for length in lengths if length <= room and counts[length]]
    ascending = fitting[::-1]
    stack: list[tuple[int, int, Filling]] = [(0, room, ())]
    while stack:
        at, slack, made = stack.pop()
        while at < len(fitting) and fitting[at] > slack:
            at += 1
        if at == len(fitting):
            used = dict(made)
            left_out = [x for x in ascending if counts[x] > used.get(x, 0)]
            yield (None if dominated(made, slack, left_out) else made), slack
            continue
        length = fitting[at]
        for times in range(min(counts[length], slack // length) + 1):  # the last pushed comes first
            stack.append((at + 1, slack - times * length, (*made, (length, times)) if times else made))


class _Node:
    """The fillings to try beside the largest length left, and what is undone when they are through."""

    def __init__(self, search: _Search, decided: frozenset[Filling]):
        self.largest = search.largest()
        self.decided = decided
        self.applied: tuple[Filling, int] | None = None
        self.todo = self._steps(search)

    def _steps(self, search: _Search) -> Iterator[tuple[Filling, int]]:
        counts, largest = search.counts, self.largest
        counts[largest] -= 1
        found = []
        for filling, slack in fillings(search.lengths, counts, search.capacity - largest):
            search.looked_at += 1
            if filling is not None:
                found.append((slack, filling))
                if slack == 0 and len(found) >= search.ahead:
                    break
            if search.looked_at >= search.effort:
                break
        counts[largest] += 1
        found.sort(key=lambda one: one[0])  # the fullest bins first, long items first among equals
        for _, filling in found:
            whole = merged(largest, filling)
            if whole not in self.decided:
                most = min(counts[length] // times for length, times in whole)
                for bins in range(most, 0, -1):
                    yield whole, bins
                self.decided |= {whole}


def merged(largest: int, filling: Filling) -> Filling:
    times = dict(filling)
    times[largest] = times.get(largest, 0) + 1
    return tuple(sorted(times.items(), reverse=True))


class _Search:
    def __init__(self, counts: dict[int, int], capacity: int, effort: int, ahead: int):
        self.counts = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.counts, reverse=True)
        self.capacity, self.effort, self.ahead = capacity, effort, ahead
        self.total = sum(length * n for length, n in self.counts.items())
        self.looked_at = 0
        self.made: Plan = []
        self.bins = self.tokens = 0  # of what is made
        self.best: Plan = []
        self.fewest = 1 << 62

    def largest(self) -> int:
        return next(length for length in self.lengths if self.counts[length])

    def bound(self) -> int:
        left = [length for length in self.lengths if self.counts[length]]
        waste = least_waste(left, self.counts, self.capacity)
        return self.bins - (-(self.total - self.tokens + waste) // self.capacity)

    def complete(self) -> None:
        """Take the bins made so far and best fit for the rest, if that is better."""
        rest = best_fit({length: n for length, n in self.counts.items() if n}, self.capacity)
        bins = self.bins + sum(n for _, n in rest)
        if bins < self.fewest:
            self.fewest, self.best = bins, [*self.made, *rest]

    def apply(self, filling: Filling, bins: int, sign: int = 1) -> None:
        for length, times in filling:
            self.counts[length] -= sign * times * bins
            self.tokens += sign * length * times * bins
        self.bins += sign * bins
        if sign > 0:
            self.made.append((filling, bins))
        else:
            self.made.pop()

    def run(self) -> Plan:
        self.complete()
        least = self.bound()
        nodes = [_Node(self, frozenset())] if self.total else []
        while nodes and self.fewest > least and self.looked_at < self.effort:
            node = nodes[-1]
            if node.applied:
                self.apply(*node.applied, sign=-1)
                node.applied = None
            step = next(node.todo, None)
            if step is None:
                nodes.pop()
                continue
            self.apply(*step)
            node.applied = step
            self.looked_at += 1
            if self.bound() >= self.fewest:
                continue  # the waste is more than a better solution may have
            self.complete()
            if self.tokens < self.total:
                again = self.counts[node.largest] > 0
                decided = node.decided | {step[0]} if again else frozenset()
                nodes.append(_Node(self, decided))
        return self.best


def pack_counts(counts: dict[int, int], capacity: int, effort: int = 200_000, ahead: int = 32) -> Plan:
    """Fillings and their numbers of bins that hold all items, in as few bins as the search finds.

    ``effort`` bounds the fillings looked at. Beside one item no more are looked for once ``ahead`` are found and
    the last of them leaves no room; with ``ahead`` beyond any number, the search leaves nothing out.
    """
    if any(not 0 < length <= capacity for length, n in counts.items() if n):
        raise ValueError("an item is longer than a bin, or has no length")
    return _Search(counts, capacity, effort, ahead).run()
