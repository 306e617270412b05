"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a stretch of a document by k = m * RATE edits. Cut into k + 1 pieces,
at least one piece must stand in such a stretch unchanged. One Aho-Corasick pass finds all pieces of all items;
each hit gives a window, which Myers' bit-parallel distance then decides. Before that, the item's disjoint
grams are counted in the window: an edit can spoil one of them, so more than k missing ones rule it out.
Documents don't move: the items go to them, in blocks of a fixed size. An item too short for edits is one piece,
and counts where its words stand unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers

RATE = 0.1
#: Items with fewer characters have no budget, and match as whole words only.
LEAST = 20
GRAM = 4
#: Characters of items that are broadcast at once; more items are taken in blocks.
BLOCK_CHARS = 8 << 20

_WORD = re.compile(r"\S+")
Item = tuple[int, str]


def normal(text: str | None) -> str:
    """Lower case character by character, and one blank for each run of white space; none at the ends."""
    return " ".join(_lower(text or "").split())


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(y if len(y := x.lower()) == 1 else x for x in text)


def places(text: str) -> list[int]:
    """For each character of normal(text), its place in text."""
    out: list[int] = []
    for word in _WORD.finditer(text):
        out += [word.start() - 1] * bool(out)
        out += range(word.start(), word.end())
    return out


def _peq(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, x in enumerate(pattern):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def distances(pattern: str, text: str, anchored: bool = False, masks: dict[str, int] | None = None) -> Iterator[int]:
    """Myers: the edit distance of pattern to the best stretch that ends at each character of text (anchored: that starts at the first)."""
    masks = masks or _peq(pattern)
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, score = full, 0, len(pattern)
    for x in text:
        equal = masks.get(x, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 | anchored
        minus <<= 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
        yield score


def best_stretch(pattern: str, text: str, most: int, masks: dict[str, int] | None = None) -> tuple[int, int, int] | None:
    """(distance, start, end) of the stretch of text closest to pattern, the first of equals; None beyond most."""
    best, end = min(((d, i + 1) for i, d in enumerate(distances(pattern, text, masks=masks))), default=(most + 1, 0))
    if best > most:
        return None
    back = distances(pattern[::-1], text[:end][::-1], anchored=True)
    length = next(i + 1 for i, d in enumerate(back) if d == best)
    return best, end - length, end


class Matcher:
    """Items by their pieces."""

    def __init__(self, items: list[Item], rate: float = RATE, least: int = LEAST):
        self.items = [(i, t, int(len(t) * rate) if len(t) >= least else 0) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.whole = [len(t) < least for _, t, _ in self.items]
        self.masks = [_peq(t) for _, t, _ in self.items]
        self.grams = [[t[i : i + GRAM] for i in range(0, len(t) - GRAM + 1, GRAM)] for _, t, _ in self.items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def matches(self, text: str | None, first: bool = False) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item's closest stretch within its budget, places in text itself; first: any one is enough."""
        plain = normal(text)
        if not self.items or not plain:
            return []
        seen: dict[int, set[int]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        for last, (length, where) in self.automaton.iter(plain):
            for n, at in where:
                if self.whole[n]:
                    begin, end = last + 1 - length, last + 1
                    if n not in best and (begin == 0 or not plain[begin - 1].isalnum()) and (end == len(plain) or not plain[end].isalnum()):
                        best[n] = 0, begin, end
                    continue
                seen.setdefault(n, set()).add((last + 1 - length - at) // (self.items[n][2] + 1))
        for n, shifts in () if first and best else seen.items():
            _, item, k = self.items[n]
            for shift in sorted(shifts):  # of one item: hits whose shifts share a step of k + 1 share a window
                begin = max(0, shift * (k + 1) - k)
                window = plain[begin : (shift + 1) * (k + 1) + len(item) + k]
                missing = 0
                for gram in self.grams[n]:
                    if gram not in window:
                        missing += 1
                        if missing > k:
                            break
                if missing <= k and (found := best_stretch(item, window, k, self.masks[n])):
                    found = (found[0], begin + found[1], begin + found[2])
                    if n not in best or found < best[n]:
                        best[n] = found
                    if first:
                        break
            if first and best:
                break
        if not best:
            return []
        at = places(text)
        return sorted((self.items[n][0], d, at[a], at[b - 1] + 1 if b > a else at[a]) for n, (d, a, b) in best.items())


@lru_cache(maxsize=4)
def _matcher(items: tuple[Item, ...], rate: float, least: int) -> Matcher:
    return Matcher(list(items), rate, least)


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[tuple[Item, ...]]:
    """The items in blocks of about block_chars characters, each collected by itself, and one at a time."""
    kept = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text"))
    chars = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, ceil(chars / block_chars))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        yield tuple(sorted({(x.item, x.text) for x in kept.filter(part == k).collect()}))


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE, least: int = LEAST) -> DataFrame:
    """One row for each document and item that it holds: key, item_id, distance, start, end (code points of the text).

    distance is the least edit distance of the item to a stretch of the document, both in lower case with
    single blanks; start and end are that stretch, the first of equals. Documents that hold none, null and
    empty texts give no row; so do items that are null or empty. Items of fewer than least characters match
    without edits, as whole words. Items that share an id count each; repeated items count once. Repeated documents each give their rows. Other columns are not read.
    """
    found = None
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            workers.enter("decontaminate", _matcher.cache_clear)
            matcher = _matcher(shared.value, rate, least)
            for batch in batches:
                rows = [(k, *x) for k, t in zip(batch.column(0).to_pylist(), workers.texts(batch.column(1))) for x in matcher.matches(t)]
                columns = [*zip(*rows)] or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), *(pa.array(x, pa.int64()) for x in columns[1:])], names=[key, "item_id", "distance", "start", "end"])

        part = docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, item_id bigint, distance bigint, start bigint, end bigint")
        found = part if found is None else found.unionByName(part)
    return found


def without_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = RATE, least: int = LEAST) -> DataFrame:
    """docs without the rows whose text holds an item; all columns stay as they are."""
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        @F.pandas_udf("boolean")
        def clean(texts, shared=shared):
            workers.enter("decontaminate", _matcher.cache_clear)
            matcher = _matcher(shared.value, rate, least)
            return texts.map(lambda x: not matcher.matches(x, first=True)).astype(bool)

        docs = docs.filter(clean(F.col(text)))
    return docs
