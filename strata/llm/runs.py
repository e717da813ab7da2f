"""Runs: stretches of words that repeat with a period, found by longest common extensions.

A run of period ``p`` is a stretch of places ``i`` whose words equal those ``p``
further on. For every period a grid of places is looked at, so coarse that all
grids together have n log n places, and so fine that no run of the least length
slips through. Where grid places in a row match, the stretch around them is
extended to both sides by two LCE queries, which give the run's ends.

LCE queries use a difference cover ``D`` modulo ``v``: of any two places, some
shift under ``v`` brings both to places whose remainder is in ``D``. Only the
suffixes at such places are sorted. A query compares the fewer than ``v`` words
up to them, and takes the rest from the smallest common prefix between the two
in sorted order, by a sparse table of range minima.

Texts are taken many at a time, laid end to end with a word of its own after
each. Only texts with a match on some grid enter the LCE index.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# A difference cover modulo 21 (a perfect difference set).
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
LEAST, TIMES = 24, 3            # a run has at least LEAST words and TIMES periods
BATCH_BYTES = 2 << 20           # of text laid end to end at once, unless one text is longer
QUERIES = 1 << 18               # extended at once
FOUND = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])), False),
    T.StructField("collapsed", T.StringType(), False)])


class CoverLCE:
    """Common extensions of places in ``words`` (any integers); the last word must occur once."""

    def __init__(self, words: np.ndarray, modulus: int = MODULUS, cover: tuple[int, ...] = COVER):
        self.n, self.v = len(words), modulus
        words = words.astype(np.int64)
        self.words = np.concatenate([words, words.min(initial=0) - 1 - np.arange(modulus)])     # behind the end nothing matches
        inside = np.zeros(modulus, bool)
        inside[list(cover)] = True
        # shift[a, b]: the least d with a + d and b + d both in the cover.
        d = np.arange(modulus)
        both = inside[(d[:, None] + d[None]) % modulus]
        self.shift = (both[:, None, :] & both[None, :, :]).argmax(2)
        self._sort(np.flatnonzero(inside[np.arange(self.n) % modulus]))

    def _sort(self, places: np.ndarray) -> None:
        """Rank of each sampled suffix and the range minima of the common prefixes between neighbours."""
        rank_at = np.full(self.n + self.v, -1, np.int32)
        blocks = [self.words[places + d] for d in range(self.v)]
        order = np.lexsort(blocks[::-1])
        new = np.zeros(len(places), bool)
        for block in blocks:
            sorted_block = block[order]
            new[1:] |= sorted_block[1:] != sorted_block[:-1]
        rank = np.empty(len(places), np.int64)
        rank[order] = np.cumsum(new)
        levels, reach = [], self.v              # ranks by the first ``reach`` words, doubled until all differ
        while True:
            rank_at[places] = rank
            levels.append((reach, rank_at.copy()))
            if len(places) == 0 or rank.max() == len(places) - 1:
                break
            later = places + reach
            behind = np.where(later < self.n, rank_at[np.minimum(later, self.n - 1)], -1).astype(np.int64)
            _, rank = np.unique(rank * (len(places) + 1) + behind + 1, return_inverse=True)
            reach *= 2
        self.rank = levels[-1][1]
        order = np.empty(len(places), np.int64)
        order[rank] = places
        # Common prefixes of neighbours: down the levels by equal ranks, then word by word.
        a, b = order[:-1].copy(), order[1:].copy()
        first = a.copy()
        for reach, ranks in reversed(levels[:-1]):
            same = (a < self.n) & (b < self.n)
            same[same] = ranks[a[same]] == ranks[b[same]]
            a[same] += reach
            b[same] += reach
        low = a - first + self._words_equal(a, b)
        self.table = [low]
        size = 1
        while 2 * size < len(places):
            low = np.minimum(low[:len(low) - size], low[size:])
            self.table.append(low)
            size *= 2

    def _words_equal(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """How many words are equal from ``a`` and ``b`` on, at most ``v`` (or ``most``)."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a)) if most is None else np.flatnonzero(most > 0)
        for d in range(self.v):
            x, y = a[live] + d, b[live] + d
            ok = (x < self.n) & (y < self.n)
            ok[ok] = self.words[x[ok]] == self.words[y[ok]]
            live = live[ok]
            out[live] = d + 1
            if most is not None:
                live = live[most[live] > d + 1]
            if not len(live):
                break
        return out

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words equal from ``a`` and from ``b`` on, for ``a`` < ``b`` <= n."""
        shift = self.shift[a % self.v, b % self.v]
        out = self._words_equal(a, b, shift)
        go = np.flatnonzero((out == shift) & (b + shift < self.n))
        x, y = self.rank[a[go] + shift[go]], self.rank[b[go] + shift[go]]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[go[at]] += np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def _grid_matches(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) where four grid places in a row match, for all periods up to ``longest / TIMES``.

    A run of period p has at least max(LEAST, TIMES p) - p matching places in a
    row, so at least four of a grid with a quarter of that as its step."""
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in range(1, longest // TIMES + 1):
        step = max(LEAST - p, (TIMES - 1) * p) // 4
        same = words[:-p:step] == words[p::step]
        same = same[:-3] & same[1:-2] & same[2:-1] & same[3:]
        if same.any():
            at = np.flatnonzero(same)
            places.append(at * step)
            periods.append(np.full(len(at), p))
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of ``words``, by start, then period.
    The last word must occur once; no run holds more than ``longest`` words
    (the distance between words that occur once)."""
    places, periods = _grid_matches(words, longest if longest is not None else len(words))
    none = np.zeros(0, np.int64)
    if not len(places):
        return none, none, none
    ahead, back = CoverLCE(words), CoverLCE(np.concatenate([words[:-1][::-1], words[-1:]]))
    size, found = len(words) - 1, []
    while len(places):
        # The first match of each period's row of matches; the others in its stretch follow from it.
        head = np.ones(len(places), bool)
        head[1:] = (periods[1:] != periods[:-1])
        near = np.flatnonzero(~head)
        gap = places[near] - places[near - 1]
        head[near[gap > np.maximum(LEAST - periods[near], (TIMES - 1) * periods[near]) // 4]] = True
        heads = np.flatnonzero(head)
        end = np.empty(len(heads), np.int64)
        for i in range(0, len(heads), QUERIES):
            h = heads[i:i + QUERIES]
            at, p = places[h], periods[h]
            right = ahead.extend(at, at + p)
            # Backwards: word j is word size - 1 - j of the reversed text.
            left = back.extend(size - at - p, size - at)
            end[i:i + QUERIES] = at + right
            found.append(np.stack([at - left, left + right + p, p]))
        rest = ~head
        rest &= places >= end[np.cumsum(head) - 1]      # behind the stretch: another one
        places, periods = places[rest], periods[rest]
    start, length, period = np.concatenate(found, axis=1)
    long = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = start[long], length[long], period[long]
    # A stretch found with several periods is a run of the smallest.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of(texts: list[bytes]) -> list[tuple[int, np.ndarray, bytes]]:
    """Each text's number of words, its runs (a row of start, length, period each) and what is left of it."""
    out: list = [None] * len(texts)
    batch, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):       # texts of like length together
        if batch and size + len(texts[i]) > BATCH_BYTES:
            _runs_of(batch, texts, out)
            batch, size = [], 0
        batch.append(i)
        size += len(texts[i])
    if batch:
        _runs_of(batch, texts, out)
    return out


def _runs_of(batch: list[int], texts: list[bytes], out: list) -> None:
    split = [texts[i].split() for i in batch]           # words are [^\x20\x09-\x0D]+, as bytes.split has them
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__             # words are numbered as they come
    size = np.array([len(words) for words in split])
    ids = np.empty(int(size.sum()) + len(batch), np.int32)
    stop = np.cumsum(size + 1) - 1                      # the place of each text's own last word
    for words, end in zip(split, stop.tolist()):
        ids[end - len(words):end] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    ids[stop] = -1 - np.arange(len(batch))
    places, _ = _grid_matches(ids, int(size.max()))
    runs = [np.zeros((0, 3), np.int64)] * len(batch)
    if len(places):
        some = np.unique(np.searchsorted(stop, places))     # texts with a match
        part = np.concatenate([ids[stop[k] - size[k]:stop[k] + 1] for k in some])
        ends = np.cumsum(size[some] + 1) - 1
        start, length, period = find_runs(part, int(size[some].max()))
        first = ends - size[some]
        bound = np.searchsorted(start, np.append(first, len(part)))
        for j, k in enumerate(some.tolist()):
            mine = slice(bound[j], bound[j + 1])
            runs[k] = np.stack([start[mine] - first[j], length[mine], period[mine]], axis=1)
    for i, words, found in zip(batch, split, runs):
        out[i] = (len(words), found, _collapse(words, found))


def _collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(text: Column) -> Column:
    """The runs of a text: ``n_words``, ``runs`` (start, length, period of each, in
    words, by start, then period) and ``collapsed``: the text's words without
    those that a run holds after its first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch with smallest period
    ``period``, of at least 24 words and three periods, that no neighbouring word
    extends. Null and empty texts have no words; a text of any length is one piece.
    """
    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        every = runs_of([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
        ends = np.concatenate([[0], np.cumsum([len(r) for _, r, _ in every])]).astype(np.int32)
        runs = np.concatenate([r for _, r, _ in every]) if every else np.zeros((0, 3), np.int64)
        rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in range(3)], ["start", "length", "period"])
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _, _ in every], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), rows),
             pa.array([left for _, _, left in every], pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])
    return found(text)


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, exactly; ties go to the smallest
    start, then period. Null if there is none."""
    better = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), better)
