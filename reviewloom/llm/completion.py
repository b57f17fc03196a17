"""Bin completion over a histogram of lengths.

However many pieces there are, they have at most ``capacity`` different lengths, so a packing is a list of
fillings (a multiset of lengths) with the number of times each is used. The largest length
left opens a bin; all undominated fillings of the rest are listed by waste, one at a time as they are
asked for, and the search branches on them depth first. A branch is cut as soon as its waste exceeds what
a better packing could afford. Best-fit decreasing gives the first incumbent. One filling is first applied as often
as the histogram allows, so a descent takes as many steps as there are lengths, not pieces; on the way
back it is applied once less at a time. Only the last steps keep their listings open, so the search's memory doesn't grow with the
number of lengths; one that was closed is listed again when the search comes back to it. So the search is exact if it comes to its end: when a packing meets the
lower bound or nothing is left to try. Packing is NP-hard, so ``nodes`` steps end it otherwise.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

#: Steps of the search, from the last, whose listings stay open; one holds the sums of all lengths left, up to half a megabyte.
OPEN = 64

#: Times used, and the lengths of a filling in descending order.
Filling = tuple[int, tuple[int, ...]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by total length, and by pieces that can't share a bin."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    upto, total = [0] * (capacity + 1), [0] * (capacity + 1)
    for n in range(1, capacity + 1):
        upto[n] = upto[n - 1] + counts.get(n, 0)
        total[n] = total[n - 1] + n * counts.get(n, 0)
    for least in range(capacity // 2 + 1):
        # Pieces over capacity - least stand alone for those of at least ``least``; those over half have a bin each.
        alone = upto[capacity] - upto[capacity - least]
        large = upto[capacity - least] - upto[capacity // 2]
        below = max(least - 1, 0)
        room = large * capacity - (total[capacity - least] - total[capacity // 2])
        rest = total[capacity // 2] - total[below] - room
        best = max(best, alone + large + max(0, -(-rest // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing, a whole length at a time: bins with equal content move together."""
    bins: dict[int, Counter] = {}  # room left -> content -> number of bins
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r in bins if r >= n), default=None)
            if room is None:
                times = capacity // n
                full, rest = divmod(left, times)
                for times, number in ((times, full), (rest, 1)):
                    if times and number:
                        bins.setdefault(capacity - times * n, Counter())[(n,) * times] += number
                break
            content, number = next(iter(bins[room].items()))
            moved = min(number, left)
            bins[room][content] -= moved
            if not bins[room][content]:
                del bins[room][content]
                if not bins[room]:
                    del bins[room]
            bins.setdefault(room - n, Counter())[(*content, n)] += moved
            left -= moved
    return [(number, content) for held in bins.values() for content, number in held.items()]


def _sums(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Per number of lengths, from the smallest, the sums up to ``room`` that their pieces make: a bit per sum."""
    sums, every = [1], (1 << (room + 1)) - 1
    for n, count in zip(lengths, counts, strict=True):
        made, left, step = sums[-1], min(count, room // n), 1
        while left:
            step = min(step, left)
            made |= made << (n * step) & every
            left -= step
            step *= 2
        sums.append(made)
    return sums


def _subsets(lengths: list[int], sums: list[int], total: int, at: int, counts: Counter, first: int) -> Iterator[tuple[int, ...]]:
    """Every choice among the first ``at`` lengths that makes ``total``, in descending order, the largest first."""
    if not total:
        yield ()
        return
    at = min(at, bisect_right(lengths, total))
    while at and sums[at] >> total & 1:
        n = lengths[at - 1]
        for times in range(min(counts[n] - (n == first), total // n), 0, -1):
            if sums[at - 1] >> (total - times * n) & 1:
                for rest in _subsets(lengths, sums, total - times * n, at - 1, counts, first):
                    yield (n,) * times + rest
        at -= 1


@dataclass(eq=False)
class _Step:
    """A place in the search: fillings to come, those tried before, and the one in use."""

    options: Iterator[tuple[int, tuple[int, ...] | None]] | None
    tried: set[tuple[int, ...]]
    #: Fillings asked for, so that a listing that was closed goes on where it was.
    given: int = 0
    content: tuple[int, ...] = ()
    times: int = 0
    lost: int = 0


def fillings(lengths: list[int], counts: Counter, capacity: int) -> Iterator[tuple[int, tuple[int, ...] | None]]:
    """(waste, lengths) of all undominated fillings around the largest length, least waste first, then largest partners.

    In an undominated one no piece left over fits in, alone or in the place of one smaller or of two that aren't larger
    together. A dominated one comes as None, so that whoever asks can count it. ``counts`` must be the same
    whenever the listing goes on.
    """
    first = lengths[-1]
    room = capacity - first
    partners = [n for n in lengths[: bisect_right(lengths, room)] if counts[n] > (n == first)]

    def dominated(waste: int, filled: tuple[int, ...]) -> bool:
        used = Counter(filled)
        used[first] += 1
        kinds = sorted(set(filled))
        inside = Counter(filled)
        places = [(0, 0), *((n + 1, n) for n in kinds)]
        places += [(x + y, x + y) for k, x in enumerate(kinds) for y in kinds[k + (inside[x] == 1) :]]
        return any(
            counts[m] > used[m]
            for least, n in places
            for m in partners[bisect_left(partners, least) : bisect_right(partners, n + waste)]
        )

    sums = _sums(partners, [counts[n] - (n == first) for n in partners], room)
    for waste in range(room + 1):
        for filled in _subsets(partners, sums, room - waste, len(partners), counts, first):
            yield waste, None if dominated(waste, filled) else (first, *filled)


def pack(counts: dict[int, int], capacity: int, nodes: int = 20_000) -> list[Filling]:
    """Fillings that use every piece of the histogram exactly once, in as few bins as the search finds.

    The result has the fewest bins possible if it meets the lower bound or the search ends before ``nodes`` steps.
    """
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    incumbent = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    number = sum(times for times, _ in incumbent)
    total = sum(n * c for n, c in counts.items())
    free, lengths = Counter(counts), sorted(counts)
    waste = bins = 0

    def take(content: tuple[int, ...], times: int) -> None:
        """Use the filling so often; put it back if ``times`` is negative."""
        for n, c in Counter(content).items():
            if not free[n]:
                lengths.insert(bisect_right(lengths, n), n)
            free[n] -= times * c
            if not free[n]:
                lengths.remove(n)

    path = [_Step(fillings(lengths, free, capacity), set())]
    while number > least and nodes and path:
        nodes -= 1
        step = path[-1]
        if step.times:
            # Come back: the same filling once less.
            take(step.content, -1)
            waste, bins, step.times = waste - step.lost, bins - 1, step.times - 1
        if not step.times:
            if step.options is None:
                step.options = islice(fillings(lengths, free, capacity), step.given, None)
            lost, content = next(step.options, (0, ()))
            step.given += 1
            # The waste that a packing with one bin less than the incumbent could afford.
            spare = (number - 1) * capacity - total - waste
            if content == () or lost > spare:
                path.pop()
                continue
            if content is None or content in step.tried:
                continue
            times = min(free[n] // c for n, c in Counter(content).items())
            step.lost, step.content, step.times = lost, content, min(times, spare // lost) if lost else times
            step.tried.add(content)
            take(content, step.times)
            waste, bins = waste + lost * step.times, bins + step.times
        if not lengths:
            if bins < number:
                number, incumbent = bins, [(s.times, s.content) for s in path]
        else:
            # Packings that use a filling more often, or one tried before it, are searched elsewhere.
            tried = set(step.tried) if lengths[-1] == step.content[0] else set()
            path.append(_Step(fillings(lengths, free, capacity), tried))
            if len(path) > OPEN:
                path[-OPEN - 1].options = None
    return incumbent
