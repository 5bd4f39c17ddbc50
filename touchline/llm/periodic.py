"""Periodic runs of words, found by branching tandem repeats on an enhanced suffix array.

A run is a maximal stretch of words with smallest period q that holds several whole
periods.  For a slice of documents, each task builds one suffix array in which suffixes of
different documents share no word (prefix doubling, settled groups left out), and its LCP
values.  An LCP interval is a pair of nearest smaller LCP values around a boundary; no tree
is built.  In an interval of depth d, the suffixes of all children but the largest are
tested: a suffix i with i+d or i-d (by the inverse suffix array) in the interval, in
another child, begins or ends a square of period d that cannot be rotated right.  Each such
square is rotated left as far as its words agree, which gives the run that it ends; runs
of one stretch are merged into the one of smallest period.

The ranks of each doubling step are kept, so LCP values and rotations take one comparison
a step instead of one a word.  Work is about n log n in the words of a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchline.llm.common import slices

#: A run has at least so many words, and so many periods.
MIN_LENGTH, MIN_PERIODS = 6, 4
#: Text bytes of the documents that share a suffix array; a longer document has one of its own.
TOGETHER = 1 << 20
_EXPAND = 1 << 20  # suffixes of small children tested at a time


class SuffixArray:
    """Order, inverse, LCP values and step ranks of the suffixes of several documents.

    ``words`` are codes; ``doc`` is each word's document, ascending.  ``levels[k]`` ranks
    suffixes by document and first 2**k words: equal ranks mean equal words.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        n = len(words)
        self.n = n
        key = doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(key, kind="stable")
        self.order = order
        rank = np.empty(n + 1, dtype=np.int32)
        rank[n] = -1
        bounds = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        rank[order] = np.maximum.accumulate(np.where(bounds, np.arange(n), 0))
        self.levels = [rank]
        width = 1
        slots = self._unsettled(bounds, np.arange(n))
        doc = np.append(doc, -1)
        while len(slots):
            rank, at = self.levels[-1].copy(), order[slots]
            after = np.minimum(at + width, n)
            behind = np.where(doc[after] == doc[at], rank[after], -1)
            key = rank[at].astype(np.int64) * (n + 2) + behind + 1
            by = np.argsort(key, kind="stable")
            order[slots] = at[by]
            key = key[by]
            bounds = np.concatenate(([True], key[1:] != key[:-1]))
            rank[order[slots]] = slots[np.maximum.accumulate(np.where(bounds, np.arange(len(slots)), 0))]
            self.levels.append(rank)
            slots = self._unsettled(bounds, slots)
            width *= 2
        self.inverse = self.levels[-1]  # all ranks differ: the place of each suffix
        self.lcp = self._lcp()

    @staticmethod
    def _unsettled(bounds: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Slots of the groups with more than one suffix; ``bounds`` marks the first of each group."""
        alone = bounds & np.append(bounds[1:], True)
        return slots[~alone]

    def _lcp(self) -> np.ndarray:
        """Words shared by the suffixes at slots k-1 and k; 0 at both ends."""
        lcp = np.zeros(self.n + 1, dtype=np.int32)
        a, b = self.order[:-1], self.order[1:]
        pairs, left = [], np.arange(1, self.n)
        for rank in self.levels:  # the pairs still equal at each step
            left = left[rank[a[left - 1]] == rank[b[left - 1]]]
            if not len(left):
                break
            pairs.append(left)
        for k in reversed(range(len(pairs))):
            rank, at = self.levels[k], pairs[k]
            shared = lcp[at]
            same = rank[a[at - 1] + shared] == rank[b[at - 1] + shared]
            lcp[at[same]] += 1 << k
        return lcp


def _nearest_smaller(lcp: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each boundary in ``at`` the nearest one (before for step -1, behind for 1) with a smaller value.

    Pointers jump over pointers: what a pointer skips is never smaller than its own value.
    """
    to = np.arange(len(lcp)) + step
    open_ = at
    while True:
        open_ = open_[lcp[to[open_]] >= lcp[open_]]
        if not len(open_):
            return to[at]
        to[open_] = to[to[open_]]


def branching_squares(array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square whose rotation to the right is none; repeats are possible."""
    lcp, order, inverse, n = array.lcp, array.order, array.inverse, array.n
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    low, high = _nearest_smaller(lcp, at, -1), _nearest_smaller(lcp, at, 1)
    by = np.argsort(low * (n + 2) + high, kind="stable")  # boundaries of one interval together, ascending
    at, low, high = at[by], low[by], high[by]
    first = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    last = np.append(first[1:], True)
    interval = np.cumsum(first) - 1
    # children: one ends at each boundary, one more follows the last
    begin = np.concatenate((np.where(first, low, np.append(0, at[:-1])), at[last]))
    end = np.concatenate((at, high[last]))
    owner = np.concatenate((interval, interval[last]))
    depth, low, high = lcp[at[first]].astype(np.int64), low[first], high[first]
    size = end - begin
    by = np.lexsort((size, owner))
    largest = np.zeros(len(size), dtype=bool)
    largest[by[np.append(owner[by][1:] != owner[by][:-1], True)]] = True
    small = np.flatnonzero(~largest)
    found = [(np.zeros(0, dtype=np.int64),) * 2]
    cuts = np.searchsorted(np.cumsum(size[small]), np.arange(0, int(size[small].sum()) + _EXPAND, _EXPAND), side="right")
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(small))):
        part = small[lo:hi]
        if not len(part):
            continue
        count = size[part]
        child = np.repeat(part, count)
        slot = begin[child] + np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count)
        i, own = order[slot], owner[child]
        d = depth[own]
        for other, start in ((i + d, i), (i - d, i - d)):
            inside = (other >= 0) & (other < n)
            place = inverse[np.where(inside, other, n)]
            inside &= (place >= low[own]) & (place < high[own]) & ((place < begin[child]) | (place >= end[child]))
            found.append((start[inside], d[inside]))
    return np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found])


def find_runs(words: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; starts count over all documents."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words):
        return none, none, none
    array = SuffixArray(words, doc)
    start, period = branching_squares(array)
    opens = np.searchsorted(doc, doc[start], side="left")  # first word of the document
    need = np.maximum(min_length, min_periods * period) - 2 * period  # words to rotate left at least
    fits = start - opens >= need
    start, period, opens, need = start[fits], period[fits], opens[fits], need[fits]
    moved = np.zeros(len(start), dtype=np.int64)
    for k in reversed(range(len(array.levels))):  # rotate left, by halving steps
        rank, to = array.levels[k], start - moved - (1 << k)
        ok = to >= opens
        ok &= rank[np.where(ok, to, 0)] == rank[np.where(ok, to + period, array.n)]
        moved += ok.astype(np.int64) << k
    enough = moved >= need
    start, period, moved = start[enough], period[enough], moved[enough]
    begin, length = start - moved, moved + 2 * period
    by = np.lexsort((period, length, begin))  # one stretch: its smallest period first
    begin, length, period = begin[by], length[by], period[by]
    fresh = np.concatenate(([True], (begin[1:] != begin[:-1]) | (length[1:] != length[:-1]))) if len(begin) else np.zeros(0, dtype=bool)
    begin, length, period = begin[fresh], length[fresh], period[fresh]
    by = np.lexsort((period, begin))
    return begin[by], length[by], period[by]


def _runs_of_texts(texts: list[list[bytes]], min_length: int, min_periods: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs of each text given as words, and each text without its repeats."""
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    codes = flat.indices.to_numpy()
    begin, length, period = find_runs(codes, np.repeat(np.arange(len(texts)), sizes), min_length, min_periods)
    opens = np.cumsum(sizes) - sizes
    owner = np.searchsorted(opens + sizes, begin, side="right")
    runs: list[list[dict]] = [[] for _ in texts]
    for d, s, n, q in zip(owner.tolist(), (begin - opens[owner]).tolist(), length.tolist(), period.tolist()):
        runs[d].append({"start": s, "length": n, "period": q})
    left = []
    for words, own in zip(texts, runs):
        if own:
            change = np.zeros(len(words) + 1, dtype=np.int64)  # +1 where a dropped stretch begins, -1 behind it
            np.add.at(change, [r["start"] + r["period"] for r in own], 1)
            np.add.at(change, [r["start"] + r["length"] for r in own], -1)
            words = [w for w, k in zip(words, np.cumsum(change).tolist()) if not k]
        left.append(b" ".join(words))
    return runs, left


RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, text: str = "text",
                  key: str = "doc_id", rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(key, runs, collapsed): the periodic runs of each text's words, and the text without their repeats.

    Words are what stands between ASCII white space, numbered from 0.  A run has
    ``min_length`` words and ``min_periods`` periods at least; runs (start, length, period)
    come by start, then period.  ``collapsed`` joins the words by one space, without those
    that any run holds after its first period.  ``rewrite`` may give the words anew, from key
    and words, before anything else.

    One row per row, repeats included.  A null, empty or blank text has no run and an empty
    ``collapsed``; a null key changes nothing; an empty table gives an empty result; columns
    besides key and text are not read.  A task holds one slice of documents (TOGETHER) or
    one document, and some 4 bytes a word and doubling step.
    """
    schema = T.StructType([docs.schema[key], T.StructField("runs", T.ArrayType(RUN, False), False),
                           T.StructField("collapsed", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in (part for whole in batches for part in slices(whole, TOGETHER)):
            texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            if rewrite is not None:
                texts = [rewrite(k, words) for k, words in zip(batch.column(0).to_pylist(), texts)]
            runs, left = _runs_of_texts(texts, min_length, min_periods)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, arrow.field(1).type), pa.array(left, pa.binary()).cast(arrow.field(2).type)], schema=arrow)

    return docs.select(key, text).mapInArrow(run, schema)
