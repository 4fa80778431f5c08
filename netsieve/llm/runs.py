"""Periodic runs of words, found on a grammar that Re-Pair makes of each slice of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from netsieve.llm import words
from netsieve.llm.columns import add_columns, position

EXPONENT = 4  # a run holds its period at least this often
SHORTEST = 6  # words of the shortest run

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def periodic_runs(docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with ``n_words, runs, collapsed``.

    Words are the parts between blanks and the bytes 0x09 to 0x0D, compared as they are. A run
    is a stretch of words with smallest period q (words q apart are identical) and length of at
    least ``max(shortest, exponent * q)`` that neither neighbour extends. ``runs`` lists
    ``(start, length, period)`` by start and period. ``collapsed`` is the text without the
    words that any run contains after its first q, joined by blanks.

    Re-Pair replaces repeated pairs of symbols in all texts of a slice until no pair occurs
    twice; a balanced tree joins what is left of each text. Every run lies within one smallest
    node and crosses the border between its two halves. So runs over the border are searched
    once for each nonterminal, at one of its places, and carried to all places where it was
    put in; of intervals with one period those that lie within another one go. Equality is
    tested by hashes and every interval is compared word by word before it counts, so the
    result doesn't depend on hashes, on slices or on the partitioning.

    A null text has 0 words, no run and a null ``collapsed``; a text without words an empty one.
    Repeated rows are judged one by one, an empty table gives an empty result. Columns named like
    a result give way. The pass is narrow; memory follows the longest text (about 200 bytes a
    word), time n log n of its words.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    at = position(docs, text_col)

    def find(batch):
        found, column = [], batch.column(at)
        for row, data, offsets in words.slices(column):
            n = len(offsets) - 1
            found.append(_slice(column.slice(row, n), data, offsets, exponent, shortest))
        types = (pa.int64(), _RUNS, pa.string())
        return [pa.concat_arrays([f[k] for f in found]) if found else pa.array([], t) for k, t in enumerate(types)]

    return add_columns(docs, find, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS = pa.list_(_RUN)


def _slice(column, data, offsets, exponent, shortest):
    """Number of words, runs and collapsed text of the texts of one slice."""
    starts, ends, first = words.split(data, offsets, words.BLANK)
    start, end, period = find_runs(_numbers(data, starts, ends), first, exponent, shortest)
    text = np.searchsorted(first, start, side="right") - 1
    order = np.lexsort((period, start))
    start, end, period, text = start[order], end[order], period[order], text[order]
    runs = pa.StructArray.from_arrays([pa.array(start - first[text]), pa.array(end - start), pa.array(period)], fields=list(_RUN))
    bounds = pa.array(np.searchsorted(text, np.arange(len(offsets))).astype(np.int32))
    depth = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
    collapsed = _joined(data, starts[kept], ends[kept], np.searchsorted(kept, first), column)
    return pa.array(np.diff(first)), pa.ListArray.from_arrays(bounds, runs), collapsed


def _numbers(data, starts, ends) -> np.ndarray:
    """A number for each word, the same for equal bytes only."""
    bounds = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    packed = np.ascontiguousarray(data[words.BLANK[data]])
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(data, starts, ends, first, column):
    """Each text's words with a blank between them; null where ``column`` is."""
    blank = np.ones(len(starts), dtype=np.int64)
    blank[first[:-1][np.diff(first) > 0]] = 0
    bounds = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts + blank, out=bounds[1:])
    source = np.repeat(starts - blank - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1])
    out = data[np.maximum(source, 0)] if len(source) else np.zeros(0, dtype=np.uint8)
    out[bounds[:-1][blank == 1]] = 0x20
    missing = column.is_null().to_numpy(zero_copy_only=False)
    valid = pa.py_buffer(np.packbits(~missing, bitorder="little"))
    texts = pa.Array.from_buffers(pa.large_string(), len(first) - 1, [valid, pa.py_buffer(bounds[first]), pa.py_buffer(out)])
    return texts.cast(pa.string())


def find_runs(ids: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST):
    """Starts, ends and periods of the runs of all texts; text k has the words from ``first[k]`` on."""
    search = _Search(ids, exponent, shortest)
    texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places, places_of, rules, left = _repair(ids, texts)
    node, start, end, period = search.over_borders(*rules)
    # a nonterminal's runs at all of its places
    lo, hi = np.searchsorted(places_of, node), np.searchsorted(places_of, node, side="right")
    run = np.repeat(np.arange(len(node)), hi - lo)
    where = places[np.arange(len(run)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
    shift = where - (rules[0] - rules[1])[node][run]
    found = [(start[run] + shift, end[run] + shift, period[run])]
    for borders in _tree(*left):
        found.append(search.over_borders(*borders)[1:])
    start, end, period = (np.concatenate([f[k] for f in found]) for k in range(3))
    # of intervals with one period only those that no other one covers
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = period * (len(ids) + 1) + end
    new = np.ones(len(reach), dtype=bool)
    new[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    return start[new], end[new], period[new]


def _repair(ids: np.ndarray, texts: np.ndarray):
    """Places of the nonterminals, each one's first place as a border, and the symbols left.

    A round replaces the pairs that are more frequent (ties by hash) than the overlapping pairs
    on both sides, at least two places of each. A pair that occurs once, of symbols that stay,
    never occurs again and isn't counted any more.
    """
    symbols, at, size = ids.copy(), np.arange(len(ids)), np.ones(len(ids), dtype=np.int64)
    live = np.ones(len(ids), dtype=bool)
    count, n_rules = int(ids.max(initial=0)) + 1, 0
    places, owners, borders = [], [], []
    while True:
        pairs = np.flatnonzero(live[:-1] & (texts[1:] == texts[:-1])) if len(symbols) > 1 else np.zeros(0, dtype=np.int64)
        keys, kind, often = np.unique(symbols[pairs] * count + symbols[pairs + 1], return_inverse=True, return_counts=True)
        twice = often[kind] > 1
        pairs, kind = pairs[twice], kind[twice]
        live[:] = False
        live[pairs] = True
        # the largest of neighbouring pairs; every other one of a block of equal pairs
        rank = np.full(len(symbols) + 1, -1, dtype=np.int64)
        tie = (words.mix(keys.view(np.uint64)) >> np.uint64(30)).astype(np.int64)
        rank[pairs] = (often[kind] << 34) + tie[kind] if len(pairs) else rank[pairs]
        edge = np.ones(len(rank), dtype=bool)
        edge[1:] = rank[1:] != rank[:-1]
        block = np.flatnonzero(edge)
        height = rank[block]
        top = height >= 0
        top[1:] &= height[1:] > height[:-1]
        top[:-1] &= height[:-1] > height[1:]
        length = np.diff(np.append(block, len(rank)))
        offset = np.arange(len(rank)) - np.repeat(block, length)
        chosen = np.flatnonzero(np.repeat(top, length) & (offset % 2 == 0))
        of = np.full(len(symbols), -1, dtype=np.int64)
        of[pairs] = kind
        of = of[chosen]
        enough = np.bincount(of, minlength=len(keys))[of] > 1 if len(of) else np.zeros(0, dtype=bool)
        chosen, of = chosen[enough], of[enough]
        if not len(chosen):
            break
        _, sample, rule = np.unique(of, return_index=True, return_inverse=True)
        places.append(at[chosen])
        owners.append(n_rules + rule)
        borders.append(np.stack([at[chosen + 1], size[chosen], size[chosen + 1]])[:, sample])
        symbols[chosen] = count + rule
        size[chosen] += size[chosen + 1]
        # pairs with a new symbol are counted again
        live[chosen] = True
        live[np.maximum(chosen - 1, 0)] = True
        count, n_rules = count + len(sample), n_rules + len(sample)
        keep = np.ones(len(symbols), dtype=bool)
        keep[chosen + 1] = False
        symbols, at, size, live, texts = symbols[keep], at[keep], size[keep], live[keep], texts[keep]
    left = (at, size, texts)
    if not places:
        none = np.zeros(0, dtype=np.int64)
        return none, none, (none, none, none), left
    places, owners = np.concatenate(places), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return places[order], owners[order], tuple(np.concatenate(borders, axis=1)), left


def _tree(at, size, texts):
    """Borders of the balanced trees over the symbols of each text, level by level."""
    while len(at) > 1:
        begin = np.ones(len(at), dtype=bool)
        begin[1:] = texts[1:] != texts[:-1]
        number = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
        right = np.flatnonzero(number % 2 == 1)
        if not len(right):
            return
        yield at[right], size[right - 1], size[right]
        size[right - 1] += size[right]
        keep = number % 2 == 0
        at, size, texts = at[keep], size[keep], texts[keep]


class _Search:
    """Runs over borders: ``l`` words before and ``r`` words from word ``c`` on belong to the node."""

    def __init__(self, ids, exponent, shortest):
        self.ids, self.exponent, self.shortest = ids, exponent, shortest
        self.sums = np.zeros(len(ids) + 1, dtype=np.uint64)
        powers = np.full(len(ids) + 1, _BASE, dtype=np.uint64)
        powers[:1] = 1
        self.powers = np.multiply.accumulate(powers)
        np.cumsum(words.mix(ids.astype(np.uint64) + np.uint64(1)) * self.powers[:-1], out=self.sums[1:])

    def over_borders(self, c, l, r):
        """Number of the border, start, end and smallest period of each run over it."""
        found = []
        for before in (False, True):
            node, q = self._squares(c, l, r, before)
            at, low, high = c[node], (c - l)[node], (c + r)[node]
            # words j and j + q agree on the whole square; how far beyond it?
            back = np.where(before, at - 2 * q, at)
            start = back - self._agree(back - 1, q, back - low, -1)
            front = np.where(before, at - q, at + q)
            end = front + q + self._agree(front, q, high - front - q, 1)
            ok = (start < at) & (end > at) & (end - start >= np.maximum(self.shortest, self.exponent * q))
            found.append((node[ok], start[ok], end[ok], q[ok]))
        node, start, end, q = (np.concatenate([f[k] for f in found]) for k in range(4))
        order = np.lexsort((q, end, start, node))
        node, start, end, q = node[order], start[order], end[order], q[order]
        new = np.ones(len(node), dtype=bool)
        new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        node, start, end, q = node[new], start[new], end[new], q[new]
        false = {n for n, s, e, p in zip(node.tolist(), start.tolist(), end.tolist(), q.tolist()) if not np.array_equal(self.ids[s : e - p], self.ids[s + p : e])}
        if not false:
            return node, start, end, q
        keep = ~np.isin(node, list(false))
        again = [(n, *run) for n in sorted(false) for run in self._word_by_word(int(c[n]), int(l[n]), int(r[n]))]
        again = np.array(again, dtype=np.int64).reshape(-1, 4).T
        return tuple(np.concatenate([x[keep], y]) for x, y in zip((node, start, end, q), again))

    def _squares(self, c, l, r, before):
        """Border and period of each square that ends before the border, or begins there.

        One side holds at least half of a run, so at least twice its period.
        """
        side = l if before else r
        most = np.minimum(side // 2, (l + r) // self.exponent)
        nodes, periods = [], []
        ids, sign, near = self.ids, -1 if before else 1, c - 1 if before else c
        for lo, hi in _pieces(most):
            node = np.repeat(np.arange(lo, hi), most[lo:hi])
            q = np.arange(len(node)) - np.repeat(np.cumsum(most[lo:hi]) - most[lo:hi], most[lo:hi]) + 1
            at = near[node]
            for far in (False, True):  # the word next to the border and the one after it, if q has one
                step = sign * (q > 1) if far else 0
                ok = ids[at + step] == ids[at + step + sign * q]
                node, q, at = node[ok], q[ok], at[ok]
            begin = c[node] - 2 * q if before else c[node]
            ok = self._equal(begin, q, q)
            nodes.append(node[ok])
            periods.append(q[ok])
        none = [np.zeros(0, dtype=np.int64)]
        return np.concatenate(nodes or none), np.concatenate(periods or none)

    def _equal(self, i, q, n):
        """Whether ``n`` words from ``i`` on hash like those ``q`` words later."""
        return (self.sums[i + n] - self.sums[i]) * self.powers[q] == self.sums[i + q + n] - self.sums[i + q]

    def _agree(self, i, q, most, sign):
        """How many words from ``i`` on, or back, equal those ``q`` words later, ``most`` at most."""
        low, high = np.zeros(len(i), dtype=np.int64), np.maximum(most, 0)
        while (low < high).any():
            middle = (low + high + 1) // 2
            ok = self._equal(i if sign > 0 else i - middle + 1, q, middle)
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        return low

    def _word_by_word(self, c, l, r):
        """The runs over one border without hashes."""
        found = {}
        for q in range(max(l, r) // 2, 0, -1):
            same = self.ids[c - l : c + r - q] == self.ids[c - l + q : c + r]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            for x, y in zip((edges[::2] + c - l).tolist(), (edges[1::2] + c - l + q).tolist()):
                if x < c < y and y - x >= max(self.shortest, self.exponent * q):
                    found[x, y] = q
        return [(x, y, q) for (x, y), q in found.items()]


def _pieces(sizes, limit=1 << 22):
    """Ranges of entries whose sizes add up to about ``limit``."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(ends, before + limit, side="right")), lo + 1)
        yield lo, hi
        lo = hi
