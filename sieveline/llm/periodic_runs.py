"""Periodic runs of words by internal pattern matching.

A run is a stretch of words that repeats with a period, as long as it gets. Words become numbers, and prefix
doubling gives each place its rank among all stretches of 2^k words, which sorts the suffixes too. A run with
period q in [m, 2m) and at least three periods holds a block of m words at a multiple of m (m = 2^k) together
with the block's copy q words on. So each block asks for its occurrences that begin m to 2m - 1 words on:
they are an interval of the suffix array, and a wavelet tree over it gives the least place that is not before a
given one. Occurrences so close to each other are an arithmetic progression. Of one or two, each distance is a
candidate period. Three or more have the block's own period as their step, and only the two distances that
lay the ends of the block's stretch of that period on those of its copies can be periods of a run. Periods below
8 come from the first occurrence of a block of 8. Candidates are then extended both ways by comparing ranks.

All is done for many documents at once, as arrays; ranks are within documents, so no stretch crosses them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers

LEAST = 24
PERIODS = 3
BASE = 3  # blocks of 2^3 words are the shortest: a run of LEAST words or more with a period below 8 holds one and its copy
WORDS_AT_ONCE = 1 << 18


class Successors:
    """A wavelet tree over whole numbers below 2^bits, level by level: counts and order statistics of intervals."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.append(0, np.cumsum(~one)).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the numbers low to high are less than value."""
        out = np.where(value >> self.bits > 0, high - low, 0)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = (value >> bit & 1).astype(bool)
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            out += np.where(one & (value >> self.bits == 0), b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of the interval that k others come before."""
        out = np.zeros(len(low), dtype=np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = k >= b - a
            out |= one.astype(np.int64) << bit
            k = np.where(one, k - (b - a), k)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out


class Stretches:
    """Ranks of all stretches of 1, 2, 4, ... numbers of each document, and their suffixes in order."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray):
        self.n = len(numbers)
        self.begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.end = np.repeat(np.cumsum(sizes), sizes)
        keys = np.repeat(np.arange(len(sizes)), sizes) * (int(numbers.max(initial=0)) + 1) + numbers
        place = np.argsort(keys, kind="stable")
        head = np.flatnonzero(np.diff(keys[place], prepend=-1))
        rank = np.empty(self.n, dtype=np.int64)
        rank[place] = np.repeat(head, np.diff(np.append(head, self.n)))
        self.order, self.ranks = place, [rank]
        most = int(sizes.max(initial=0)) // PERIODS
        while 2 << len(self.ranks) - 1 <= max(most, 1 << BASE):
            self._double(1 << len(self.ranks) - 1)

    def _double(self, m: int) -> None:
        """Ranks of stretches of 2m from those of m; a stretch that stands once keeps its rank."""
        rank = self.ranks[-1]
        size = np.bincount(rank, minlength=self.n)
        open_ = self.order[size[rank[self.order]] > 1]
        second = np.full(len(open_), -1, dtype=np.int64)  # beyond a document's end comes before all else
        inside = open_ + m < self.end[open_]
        second[inside] = rank[open_[inside] + m]
        keys = rank[open_] * (self.n + 1) + second + 1
        place = np.argsort(keys, kind="stable")
        open_, keys = open_[place], keys[place]
        old = rank[open_]
        first = np.flatnonzero(np.diff(old, prepend=-1))
        at = old + np.arange(len(old)) - np.repeat(first, np.diff(np.append(first, len(old))))
        self.order = self.order.copy()
        self.order[at] = open_
        head = np.flatnonzero(np.diff(keys, prepend=-1))
        new = rank.copy()
        new[open_] = np.repeat(at[head], np.diff(np.append(head, len(keys))))
        self.ranks.append(new)

    def _levels(self) -> list[int]:
        top = len(self.ranks) - 1
        return [top] * (2 * PERIODS) + [*reversed(range(top))]  # the longest stretch compared is below 2 * PERIODS of the top ones

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many places the numbers from i and from j, which is later, are the same."""
        i, j, begin = i.copy(), j.copy(), j
        for k in self._levels():
            rank, m = self.ranks[k], 1 << k
            inside = j + m <= self.end[begin]
            same = inside & (rank[np.where(inside, i, 0)] == rank[np.where(inside, j, 0)])
            i, j = i + m * same, j + m * same
        return j - begin

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many places the numbers before i and before j are the same."""
        i, j, first = i.copy(), j.copy(), i
        for k in self._levels():
            rank, m = self.ranks[k], 1 << k
            inside = i - m >= self.begin[first]
            same = inside & (rank[np.where(inside, i - m, 0)] == rank[np.where(inside, j - m, 0)])
            i, j = i - m * same, j - m * same
        return first - i


def candidates(found: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, among them every run's smallest period at a place within its first period."""
    places, periods = [], []
    repeated = np.bincount(found.ranks[BASE], minlength=found.n)[found.ranks[BASE][found.order]] > 1
    if not repeated.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    kept = np.append(0, np.cumsum(repeated))  # only stretches of 2^BASE that stand twice are in the tree
    tree = Successors(found.order[repeated])
    for k in range(BASE, len(found.ranks)):
        m, rank = 1 << k, found.ranks[k]
        size = np.bincount(rank, minlength=found.n)
        x = np.flatnonzero((size[rank] > 1) & ((np.arange(found.n) - found.begin) % m == 0) & (np.arange(found.n) + m <= found.end))
        low, high = kept[rank[x]], kept[rank[x] + size[rank[x]]]
        if k == BASE:
            before = tree.below(low, high, x + 1)
            has = before < high - low
            nearest = tree.smallest(low[has], high[has], before[has]) - x[has]
            near = nearest < m
            places.append(x[has][near])
            periods.append(nearest[near])
        before, until = tree.below(low, high, x + m), tree.below(low, high, x + 2 * m)
        has = until > before
        x, low, high, before, n = x[has], low[has], high[has], before[has], (until - before)[has]
        first = tree.smallest(low, high, before)
        places.append(x[n < 3])
        periods.append((first - x)[n < 3])
        some = n > 1
        second = tree.smallest(low[some], high[some], before[some] + 1)
        two = n[some] == 2
        places.append(x[some][two])
        periods.append((second - x[some])[two])
        many = n > 2
        x, first, step = x[many], first[many], (second - first[some])[~two]
        right = first + found.forward(first, first + step) - (x + found.forward(x, x + step))
        left = first - found.back(first, first + step) - (x - found.back(x, x + step))
        for d in (left, right):
            fits = (d >= m) & (d < 2 * m) & (x + d < found.end[x])
            places.append(x[fits])
            periods.append(d[fits])
    return np.concatenate(places), np.concatenate(periods)


def runs(numbers: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of all runs, in order; documents follow each other and have sizes numbers each."""
    found = Stretches(numbers, sizes)
    x, d = candidates(found)
    start, end = x - found.back(x, x + d), x + d + found.forward(x, x + d)
    good = end - start >= np.maximum(least, PERIODS * d)
    rows = np.stack([start, end, d], axis=1)[good]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = np.zeros(len(rows), dtype=bool)
    same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)  # a multiple of the smallest period gives the same stretch
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _collapsed(words: list[bytes], own: np.ndarray) -> bytes:
    """words without what a run repeats, joined by blanks."""
    if not len(own):
        return b" ".join(words)
    covers = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covers, own[:, 0] + own[:, 2], 1)
    np.add.at(covers, own[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(covers[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """key, runs (array of start, length, period, by start and then period) and collapsed, the text without what runs repeat.

    Words are what stands between blanks (space, tab to carriage return); starts count words from 0. A run has
    its smallest period, three periods and least words (24; fewer than 24 are not looked for) at least, and no
    neighbouring word extends it. collapsed has
    the words that are in no run, or in the first period of each run they are in, with one blank between them. Null and
    empty texts have no words and no runs, and collapsed is empty. Rows are taken each by itself, so repeated
    rows, null keys and ties stay as they are; other columns are not read. A text of n words takes memory of
    some n log n numbers in its task; shorter ones go by WORDS_AT_ONCE.
    """
    if least < LEAST:
        raise ValueError(f"runs of fewer than {LEAST} words are not looked for")

    def solve(part: list[list[bytes]]) -> Iterator[tuple[np.ndarray, bytes]]:
        number: dict[bytes, int] = {}
        long = [x for x in part if len(x) >= least]
        sizes = np.array([len(x) for x in long], dtype=np.int64)
        for words in long:
            for x in words:
                number.setdefault(x, len(number))
        numbers = np.fromiter((number[x] for words in long for x in words), dtype=np.int64, count=int(sizes.sum()))
        found = runs(numbers, sizes, least) if len(long) else np.zeros((0, 3), dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        edges = np.append(np.searchsorted(found[:, 0], begins), len(found)).tolist()
        at = 0
        for words in part:
            own = found[:0]
            if len(words) >= least:
                own = found[edges[at] : edges[at + 1]] - np.array([begins[at], begins[at], 0])
                at += 1
            yield own, _collapsed(words, own)

    def rows(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, bytes]]:
        part, held = [], 0
        for x in texts:
            words = (x or "").encode().split()  # bytes are split at the same six signs
            if part and held + len(words) > WORDS_AT_ONCE:
                yield from solve(part)
                part, held = [], 0
            part.append(words)
            held += len(words)
        yield from solve(part)

    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("periodic-runs")
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                each, collapsed = zip(*rows(workers.texts(part.column(1))))
                flat = np.concatenate(each)
                values = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])], fields=list(kind))
                ends = pa.array(np.append(0, np.cumsum([len(x) for x in each])), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, values), pa.array(collapsed, pa.binary()).cast(pa.string())], names=[key, "runs", "collapsed"])
        workers.release()

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def plant_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs in which, for a tenth of the keys, all words from some place on repeat with some period; other texts stay as they are.

    With h the crc32 of the key as decimal text and g = h div 10: where h mod 10 is 0, each word i from
    a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Texts of null keys stay.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    words = F.filter(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+", -1), lambda x: x != "")

    def planted(x: Column) -> Column:
        n, g = F.size(x["w"]).cast("bigint"), x["g"]
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        y = F.struct(x["w"].alias("w"), a.alias("a"), (F.lit(1) + F.floor((n - a) / (3 + g % 8))).alias("p"))
        put = lambda y: F.array_join(F.transform(y["w"], lambda w, i: F.when(i < y["a"], w).otherwise(F.get(y["w"], (y["a"] + (i - y["a"]) % y["p"]).cast("int")))), " ")
        return F.get(F.transform(F.array(y), put), F.lit(0))

    changed = F.get(F.transform(F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g"))), planted), F.lit(0))
    new = F.when((h % 10 == 0) & F.col(f"`{text}`").isNotNull(), changed).otherwise(F.col(f"`{text}`"))
    return docs.select(*(new.alias(x) if x == text else F.col(f"`{x}`") for x in docs.columns))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """n_runs, the run with the greatest length / period (ties: smallest start, then period), and digests of all runs and of collapsed."""
    better = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]  # noqa: E731  runs come by start and period, so the first of equals stays
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    top = F.aggregate("runs", none, lambda a, x: F.when(a.isNull() | better(x, a), x).otherwise(a))
    line = lambda x: F.concat(F.concat_ws(",", *(x[y].cast("string") for y in ("start", "length", "period"))), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    row = found.select(F.col(key), F.size("runs").cast("bigint").alias("n_runs"), top.alias("_top"), lines.alias("_lines"), "collapsed")
    milli = F.expr("(1000 * _top.length) div _top.period").alias("exponent_milli")
    return row.select(key, "n_runs", *(F.col(f"_top.{x}").alias(x) for x in ("start", "length", "period")), milli, F.sha2("_lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

