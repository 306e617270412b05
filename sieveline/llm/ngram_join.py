"""N-gram Jaccard join over a token-group matrix: exact, and without all pairs.

Two texts are linked when they share at least 75 % of the union of their five-word shingles.

1. A link needs three quarters of a text's shingles to stand in some other text. Shingles go to tasks by
   ranges of their hash, packed in arrays; what returns is how many of each text's shingles occur elsewhere. A
   block of texts sends each shingle once, so one that all texts have meets as often as there are blocks. Texts
   below three quarters are linked with nothing and are done: at this point most are.
2. Of the rest, each text is taken once, however many copies it has. Texts that share their least shingle
   form a group (large ones are split), whose members are linked among themselves by matrix products.
3. The token-group matrix holds, for each shingle, the groups with it among their members' rarest shingles;
   a text and a group that share none cannot hold a link. What remains is a text's candidate groups: each has
   its union of shingles, and is opened only if three quarters of the text's shingles are in that union.
4. First one text stands for each set of texts that are already connected, and asks one group only. What is
   connected by then is grouped anew. Then all texts ask every candidate group that they are not yet connected
   with, so that no link between two sets is missed.

Components are found by Spark joins, with each round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers
from sieveline.session import Scratch, cut, few

WORDS = 5
PERCENT = 75
#: Bytes of text, or of shingles, of which one task gets what falls in its range of hashes.
TEXT_BYTES = 6 << 20
SET_BYTES = 16 << 20
#: Bytes of the shingles of texts that ask one group in one task.
ASK_BYTES = 8 << 20
#: Shingles that a task packs at a time, and texts in a group.
PACK = 1_000_000
GROUP = 64
#: Texts with one shingle of which a block tells the first round, which looks for some links only.
FIRST_TEXTS = 256
#: Pairs that a task finds before it drops repeated ones.
PAIRS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of fewer words, the hash of all of them."""
    found = np.array([*map(_HASHES.__getitem__, (text or "").encode("utf-8", "replace").lower().split())], dtype=np.uint64)
    if not len(found):
        return found
    size = min(words, len(found))
    n = len(found) - size + 1
    x = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        x = _mixed(x * _ODD + found[i : i + n])
    return np.unique(x)


def needed(n):
    """Shingles of a text with n of them that a linked text must share."""
    return -(-PERCENT * n // 100)


def needed_together(n, m):
    """Shingles that two texts with n and m of them must share."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def linked(shared, n, m):
    return 100 * shared >= PERCENT * (n + m - shared)


# --- packed exchange: (part, block, the block's texts with shingles here and how many, shingles by text) ---

PACKED = "part int, block long, counts binary, tokens binary, info binary"


def _by_part(tokens: np.ndarray, owner: np.ndarray, parts: int, at_least: int, aligned: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """For each range of hashes with shingles, and for at_least: its number, the owners in it, their counts, and shingles (and what is aligned with them) by owner.

    What is given for a range grows with its shingles, whatever the number of ranges and of owners.
    """
    part = _part(tokens, parts)
    order = np.lexsort((owner, part))
    tokens, owner, part, more = tokens[order], owner[order], part[order], aligned[order] if aligned is not None else None
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(part)]):
        first = np.flatnonzero(np.diff(owner[begin:end], prepend=-1))
        yield int(part[begin]), owner[begin:end][first], np.diff(np.append(first, end - begin)), tokens[begin:end], None if more is None else more[begin:end]
    if at_least >= 0 and not (part == at_least).any():
        yield at_least, owner[:0], owner[:0], tokens[:0], None if more is None else more[:0]


def _pairs(owners: np.ndarray, counts: np.ndarray) -> bytes:
    """Owners and their counts, packed: counts of all owners up to the last where that is shorter, else both."""
    last = int(owners[-1]) + 1 if len(owners) else 0
    if last < 2 * len(owners):
        return b"\0" + np.bincount(owners, counts, minlength=last).astype("<u4").tobytes()
    return b"\1" + np.stack([owners, counts]).astype("<u4").tobytes()


def _of_pairs(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(x, dtype="<u4", offset=1).astype(np.int64)
    if x[:1] == b"\0":
        owners = np.flatnonzero(found)
        return owners, found[owners]
    return found[: len(found) // 2], found[len(found) // 2 :]


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of the sets, one set after the other, and the set of each."""
    return np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64), np.repeat(np.arange(len(sets)), [len(x) for x in sets])


def _places_in_runs(*columns: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal rows."""
    at, new = np.arange(len(columns[0])), np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _part(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _numbers(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(x, dtype=kind)


def _block(k: int) -> int:
    """A number for the k-th block of this task, the same if the task runs again."""
    return TaskContext.get().partitionId() << 32 | k


def _ends(sizes) -> np.ndarray:
    return np.cumsum(np.asarray(sizes, dtype=np.int64))


# --- 1: which texts can be linked at all ---

INFO = np.dtype([("at", "<i8"), ("id", "<i8"), ("null", "?"), ("h1", "<i8"), ("h2", "<i8"), ("n", "<i8"), ("here", "<i8")])
MARKED = "id long, h1 long, h2 long, n long, alive boolean"


def _pack_texts(parts: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("n-grams", _HASHES.clear)
        known: dict[tuple[int, int], int] = {}
        sets: list[np.ndarray] = []
        info: list[tuple] = []
        held = done = 0

        def packed():
            """One row for each range of hashes that the block's shingles touch; one of them has the info.

            Shingles that several of the block's texts have are known to occur elsewhere; one owner more sends them once.
            """
            block, (tokens, owner) = _block(done), _joined(sets)
            _, index, inverse, times = np.unique(tokens, return_index=True, return_inverse=True, return_counts=True)
            again = times[inverse] > 1
            here = np.bincount(owner[again], minlength=len(sets)).tolist()
            about = np.array([(*x, here[x[0]]) for x in info], dtype=INFO).tobytes()
            tokens, owner = np.append(tokens[~again], tokens[index[times > 1]]), np.append(owner[~again], np.full(np.count_nonzero(times > 1), len(sets)))
            rows = [(k, block, _pairs(held_by, counts), own.tobytes(), about if k == block % parts else None) for k, held_by, counts, own, _ in _by_part(tokens, owner, parts, block % parts)]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["part", "block", "counts", "tokens", "info"])

        for batch in batches:
            for key, text, h1, h2 in zip(*(batch.column(i) for i in range(4))):
                h1, h2, key = h1.as_py(), h2.as_py(), key.as_py()
                if (at := known.get((h1, h2))) is None:  # copies within a block are one text
                    at = known[h1, h2] = len(sets)
                    sets.append(shingles(text.as_py(), words))
                    held += len(sets[-1])
                info.append((at, key or 0, key is None, h1, h2, len(sets[at])))
                if held >= PACK or len(info) >= PACK // 8:
                    yield packed()
                    known, sets, info, held, done = {}, [], [], 0, done + 1
        if info:
            yield packed()
        _HASHES.clear()
        workers.release()

    return run


def _count_elsewhere(table: pa.Table) -> pa.Table:
    """For each block and each of its texts, how many of its own shingles in this range occur in other blocks too."""
    tokens = [_numbers(x.as_py(), "<u8") for x in table.column("tokens")]
    sizes = _ends([len(x) for x in tokens])
    _, inverse, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    hits, begin = [], 0
    for counts, end in zip(table.column("counts"), sizes.tolist()):
        owners, counts = _of_pairs(counts.as_py())
        which = np.repeat(np.arange(len(counts)), counts)
        met = np.bincount(which[again[begin:end]], minlength=len(counts))
        hits.append(_pairs(owners[met > 0], met[met > 0]))
        begin = end
    del tokens, inverse, again
    workers.release()
    return pa.table({"block": table.column("block"), "hits": pa.array(hits, pa.binary()), "info": table.column("info")})


def _mark(table: pa.Table) -> pa.Table:
    """The texts of a block, with whether enough of their shingles occur elsewhere."""
    info = np.concatenate([_numbers(x.as_py(), INFO) for x in table.column("info") if x.is_valid])
    hits = np.zeros(int(info["at"].max(initial=0)) + 2, dtype=np.int64)  # the last is what the block's texts share
    for x in table.column("hits"):
        owners, counts = _of_pairs(x.as_py())
        hits[owners] += counts
    alive = (hits[info["at"]] + info["here"] >= needed(info["n"])) & (info["n"] > 0)
    return pa.table({"id": pa.array(info["id"], mask=info["null"]), "h1": info["h1"], "h2": info["h2"], "n": info["n"], "alive": alive})


def _marked(docs: DataFrame, words: int) -> DataFrame:
    """id, h1, h2 (of the text), n and alive of each row of docs (id, text, h1, h2)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, ceil(size / TEXT_BYTES))
    packed = docs.mapInArrow(_pack_texts(parts, words), PACKED)
    hits = packed.groupBy("part").applyInArrow(_count_elsewhere, "block long, hits binary, info binary")
    return cut(hits.groupBy("block").applyInArrow(_mark, MARKED), "marked-texts")


# --- 2: rarest shingles first, groups, links within groups ---


def _sets_of(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x.as_py(), words) for x in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "n", "tokens"])

    return run


BLOCKS = "block long, nodes binary, sizes binary, tokens binary"
COUNTED = "block long, tokens binary, times binary"


def _blocks_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, tokens) in blocks of about PACK shingles."""
    sets, nodes, held, done = [], [], 0, 0

    def packed():
        sizes = np.array([len(x) for x in sets], dtype="<u4")
        columns = (_block(done),), (np.array(nodes, dtype="<i8").tobytes(),), (sizes.tobytes(),), (np.concatenate(sets).tobytes(),)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), *[pa.binary()] * 3))], names=["block", "nodes", "sizes", "tokens"])

    for batch in batches:
        for node, tokens in zip(batch.column(0), batch.column(1)):
            sets.append(_numbers(tokens.as_py(), "<u8"))
            nodes.append(node.as_py())
            held += len(sets[-1])
            if held >= PACK:
                yield packed()
                sets, nodes, held, done = [], [], 0, done + 1
    if nodes:
        yield packed()


def _pack_counts(parts: int):
    """Each block's distinct shingles by ranges of hashes, with how many of its texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, times = np.unique(_numbers(tokens.as_py(), "<u8"), return_counts=True)
                rows = [(k, block, own.tobytes(), n.astype("<u4").tobytes()) for k, _, _, own, n in _by_part(tokens, np.zeros(len(tokens), dtype=np.int64), parts, -1, times)]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["part", "block", "tokens", "times"])

    return run


def _frequencies(table: pa.Table) -> pa.Table:
    """The rows again, with the number of texts of all blocks that have each shingle."""
    tokens = [_numbers(x.as_py(), "<u8") for x in table.column("tokens")]
    _, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
    times = np.bincount(inverse, weights=np.concatenate([_numbers(x.as_py(), "<u4") for x in table.column("times")]))[inverse]
    times = np.split(np.minimum(times, 0xFFFFFFFF).astype("<u4"), _ends([len(x) for x in tokens])[:-1])
    return pa.table({"block": table.column("block"), "tokens": table.column("tokens"), "times": pa.array([x.tobytes() for x in times], pa.binary())})


ORDERED = "node long, n long, least long, prefix binary, tokens binary"


def _ordered(block: pa.Table, counted: pa.Table) -> pa.Table:
    """Each text of a block: its least shingle in a hash order, and its rarest ones that other texts have too."""
    nodes, sizes, tokens = (_numbers(block.column(x)[0].as_py(), kind) for x, kind in (("nodes", "<i8"), ("sizes", "<u4"), ("tokens", "<u8")))
    known = np.concatenate([_numbers(x.as_py(), "<u8") for x in counted.column("tokens")])
    times = np.concatenate([_numbers(x.as_py(), "<u4") for x in counted.column("times")])
    order = np.argsort(known)
    times = times[order][np.searchsorted(known[order], tokens)]
    order = np.lexsort((tokens, times, np.repeat(np.arange(len(nodes)), sizes)))
    tokens, times = tokens[order], times[order]
    rows: list[list] = [[], [], [], []]
    begin = 0
    for end in _ends(sizes).tolist():
        own, n = tokens[begin:end], end - begin
        rare = slice(0, n - needed(n) + 1)
        rows[0].append(n)
        rows[1].append(int(_mixed(own).min().view(np.int64)))
        rows[2].append(own[rare][times[begin:end][rare] > 1].tobytes())
        rows[3].append(np.sort(own).tobytes())
        begin = end
    return pa.table({"node": nodes, "n": pa.array(rows[0], pa.int64()), "least": pa.array(rows[1], pa.int64()), "prefix": pa.array(rows[2], pa.binary()), "tokens": pa.array(rows[3], pa.binary())})


class Incidence:
    """Members of a group by their shingles."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        self.union, self.column = np.unique(tokens, return_inverse=True)
        self.sizes = np.array([len(x) for x in sets], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(self.column, kind="stable")
        self.by_column = self.owner[order]
        self.ends = _ends(np.bincount(self.column, minlength=len(self.union)))

    def pairs(self, wide: int = 1 << 16) -> np.ndarray:
        """Shared shingles of each pair of members, by matrix products over columns of the matrix."""
        n = len(self.sizes)
        shared = np.zeros((n, n))
        for begin in range(0, len(self.union), wide):
            here = (self.column >= begin) & (self.column < begin + wide)
            part = np.zeros((n, min(wide, len(self.union) - begin)), dtype=np.float32)
            part[self.owner[here], self.column[here] - begin] = 1
            shared += part @ part.T
        return shared.astype(np.int64)

    def overlaps(self, tokens: np.ndarray) -> np.ndarray | None:
        """Shingles that a text shares with each member; None if it has too few in the union."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if len(at) < needed(len(tokens)):
            return None
        begins = np.append(0, self.ends)[at]
        lengths = self.ends[at] - begins
        ends = np.cumsum(lengths)
        take = np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1])
        return np.bincount(self.by_column[take], minlength=len(self.sizes))


MEMBERS = "node long, grp long, comp long, n long, prefix binary, tokens binary"


def _join_group(table: pa.Table) -> pa.Table:
    """The members of a group, with the least node that each is connected to by links within the group."""
    table = table.sort_by("node")
    nodes = table.column("node").to_numpy()
    comp = np.arange(len(nodes))
    if len(nodes) > 1:
        sets = [_numbers(x.as_py(), "<u8") for x in table.column("tokens")]
        n = table.column("n").to_numpy()
        link = linked(Incidence(sets).pairs(), n[:, None], n[None, :])
        np.fill_diagonal(link, True)
        while True:
            least = np.where(link, comp[None, :], len(nodes)).min(axis=1)
            if (least == comp).all():
                break
            comp = least
    return pa.table({"node": nodes, "grp": np.full(len(nodes), nodes.min()), "comp": nodes[comp], "n": table.column("n"), "prefix": table.column("prefix"), "tokens": table.column("tokens")})


def _members(sets: DataFrame, held: Scratch) -> DataFrame:
    size = sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    parts = max(1, ceil(size / SET_BYTES))
    blocks = cut(sets.select("node", "tokens").mapInArrow(_blocks_of_sets, BLOCKS), "blocks-of-sets")
    packed = blocks.select("block", "tokens").mapInArrow(_pack_counts(parts), f"part int, {COUNTED}")
    counted = packed.groupBy("part").applyInArrow(_frequencies, COUNTED)
    ordered = cut(blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_ordered, ORDERED), "ordered-sets")
    held.drop(blocks)
    large = cut(ordered.groupBy("least").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("splits")).filter(F.col("splits") > 1), "large-groups")
    joined = ordered.join(few(large), "least", "left")
    grouped = joined.withColumn("split", F.pmod(F.xxhash64("node"), F.coalesce("splits", F.lit(1).cast("bigint"))))
    members = cut(grouped.select("least", "split", "node", "n", "prefix", "tokens").groupBy("least", "split").applyInArrow(_join_group, MEMBERS), "groups")
    held.drop(ordered)
    return members


# --- 3: the token-group matrix ---

CARD = np.dtype([("node", "<i8"), ("grp", "<i8"), ("comp", "<i8"), ("n", "<i8")])
ENTRIES = "part int, counts binary, tokens binary, places binary, cards binary"


def _pack_matrix(parts: int, first: bool):
    """Rows (node, grp, comp, n, prefix) by ranges of hashes, each shingle with its place in its text's order.

    first: of the texts with one shingle, a block sends FIRST_TEXTS at most, all components before their second texts.
    """

    def packed(sets: list[np.ndarray], cards: list[tuple]) -> pa.RecordBatch:
        # shingles that no other text has come first in a text's order, and were left out of its prefix
        places = np.concatenate([np.arange(len(x)) + c[3] - needed(c[3]) + 1 - len(x) for x, c in zip(sets, cards)])
        cards = np.array(cards, dtype=CARD)
        tokens, owner = _joined(sets)
        ordered = np.sort(tokens)
        if first and (ordered[FIRST_TEXTS:] == ordered[:-FIRST_TEXTS]).any():
            comps = cards["comp"][owner]
            order = np.lexsort((places, comps, tokens))
            order = order[np.lexsort((_places_in_runs(tokens[order], comps[order]), tokens[order]))]
            kept = np.sort(order[_places_in_runs(tokens[order]) < FIRST_TEXTS])
            tokens, owner, places = tokens[kept], owner[kept], places[kept]
        rows = [(k, counts.astype("<u4").tobytes(), own.tobytes(), at.astype("<u4").tobytes(), cards[held_by].tobytes()) for k, held_by, counts, own, at in _by_part(tokens, owner, parts, -1, places)]
        columns = [*zip(*rows)] or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), *[pa.binary()] * 4))], names=["part", "counts", "tokens", "places", "cards"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, cards, held = [], [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                sets.append(_numbers(row[4], "<u8"))
                cards.append(row[:4])
                held += len(sets[-1]) + 4
                if held >= PACK:
                    yield packed(sets, cards)
                    sets, cards, held = [], [], 0
        if cards:
            yield packed(sets, cards)

    return run


def _may_link(q: np.ndarray, at: np.ndarray, x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether sizes, and the places of a first common shingle, leave room for a link: texts q by texts x."""
    n, m = q["n"][:, None], x["n"]
    rest = np.minimum(n - at[:, None], m - places)
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (rest >= needed_together(n, m))


def _distinct(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))] if len(pairs) else pairs


def _candidates(first: bool):
    """Candidate groups of texts in other components, with a rarest shingle in common.

    Of the texts that have a shingle, those outside its largest component ask. first: one text of each such
    component asks the largest component's largest group. Else each asks every group that may hold a link.
    """

    def run(table: pa.Table) -> pa.Table:
        tokens = np.concatenate([_numbers(x.as_py(), "<u8") for x in table.column("tokens")])
        places = np.concatenate([_numbers(x.as_py(), "<u4") for x in table.column("places")]).astype(np.int64)
        cards = np.concatenate([_numbers(x.as_py(), CARD) for x in table.column("cards")])
        owner = np.repeat(np.arange(len(cards)), np.concatenate([_numbers(x.as_py(), "<u4") for x in table.column("counts")]))
        order = np.argsort(tokens, kind="stable")
        tokens, places, owner = tokens[order], places[order], owner[order]
        begins = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, dtype=np.int64)
        ends = np.append(begins[1:], len(tokens))
        if len(begins):
            comp = cards["comp"][owner]
            apart = np.minimum.reduceat(comp, begins) != np.maximum.reduceat(comp, begins)
            begins, ends = begins[apart], ends[apart]
        found: list[np.ndarray] = []
        n_found, most = 0, PAIRS
        for begin, end in zip(begins.tolist(), ends.tolist()):
            if n_found > most:
                found = [_distinct(np.concatenate(found))]
                n_found, most = len(found[0]), PAIRS + 2 * len(found[0])
            texts, at = cards[owner[begin:end]], places[begin:end]
            names, sizes = np.unique(texts["comp"], return_counts=True)
            main = names[sizes.argmax()]
            asks = np.flatnonzero(texts["comp"] != main)
            if first:
                groups, sizes = np.unique(texts["grp"][texts["comp"] == main], return_counts=True)
                group = groups[sizes.argmax()]
                held = np.flatnonzero((texts["grp"] == group) & (texts["comp"] == main))
                asks = asks[_may_link(texts[asks], at[asks], texts[held], at[held]).any(axis=1)]
                asks = asks[np.unique(texts["comp"][asks], return_index=True)[1]]
                found.append(np.stack([texts["node"][asks], np.full(len(asks), group)], axis=1))
                n_found += len(asks)
                continue
            for k in range(0, len(asks), 512):
                q = asks[k : k + 512]
                own, theirs = texts["comp"][q][:, None], texts["comp"]
                fits = _may_link(texts[q], at[q], texts, at) & ((theirs == main) | (own > theirs))
                a, b = np.nonzero(fits)
                found.append(_distinct(np.stack([texts["node"][q[a]], texts["grp"][b]], axis=1)))
                n_found += len(found[-1])
        pairs = _distinct(np.concatenate(found)) if found else np.zeros((0, 2), dtype=np.int64)
        return pa.table({"node": pairs[:, 0], "grp": pairs[:, 1]})

    return run


def _open(asks: pa.Table, members: pa.Table) -> pa.Table:
    """Links, as pairs of components, between texts that ask and members of the group."""
    found: set[tuple[int, int]] = set()
    if asks.num_rows and members.num_rows:
        sets = [_numbers(x.as_py(), "<u8") for x in members.column("tokens")]
        matrix, comp, n = Incidence(sets), members.column("comp").to_numpy(), members.column("n").to_numpy()
        for c, m, tokens in zip(asks.column("q_comp").to_pylist(), asks.column("q_n").to_pylist(), asks.column("q_tokens")):
            shared = matrix.overlaps(_numbers(tokens.as_py(), "<u8"))
            if shared is not None:
                found |= {(max(c, x), min(c, x)) for x in comp[linked(shared, n, m) & (comp != c)].tolist()}
    pairs = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
    return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})


def _links(members: DataFrame, first: bool) -> DataFrame:
    """Pairs of components (u > v) that a link connects."""
    size = members.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    parts = max(1, ceil(size / SET_BYTES))
    packed = members.select("node", "grp", "comp", "n", "prefix").mapInArrow(_pack_matrix(parts, first), ENTRIES)
    pairs = cut(packed.groupBy("part").applyInArrow(_candidates(first), "node long, grp long").distinct(), "candidates")
    if pairs.isEmpty():
        return pairs.select(F.col("node").alias("u"), F.col("grp").alias("v"))
    # texts that ask are dealt out by the bytes of their shingles
    asked = pairs.join(members.select("node", "n"), "node").groupBy("grp").agg(F.ceil(F.sum(F.lit(8) * F.col("n")) / ASK_BYTES).alias("splits"))
    asked = cut(asked, "asked-groups")
    asked = few(asked)
    asks = pairs.join(members.select("node", "comp", "n", "tokens"), "node").join(asked, "grp")
    asks = asks.withColumn("split", F.pmod(F.xxhash64("node"), F.col("splits")))
    asks = asks.select("grp", "split", *(F.col(x).alias(f"q_{x}") for x in ("comp", "n", "tokens")))
    opened = members.join(asked, "grp").withColumn("split", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("splits") - 1)))
    opened = opened.select("grp", "split", "comp", "n", "tokens")
    found = asks.groupBy("grp", "split").cogroup(opened.groupBy("grp", "split")).applyInArrow(_open, "u long, v long")
    return cut(found.distinct(), "links")


# --- 4: components ---


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node that it is connected to, for each node of links (u, v) but the least ones.

    Links that point from larger to smaller nodes are moved towards the least neighbour, by turns at the larger
    and the smaller end, until every node points at its component's least.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large, "components-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = cut(small, "components-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def _relabelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members with their components' labels, in new groups: a component's texts stand together."""
    named = members.join(few(labels.select(F.col("node").alias("comp"), "label")), "comp", "left").withColumn("comp", F.coalesce("label", "comp")).drop("label")
    named = cut(named, "relabelled")
    large = cut(named.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("splits")).filter(F.col("splits") > 1), "large-components")
    both = named.join(few(large), "comp", "left")
    return both.withColumn("grp", F.xxhash64("comp", F.pmod(F.xxhash64("node"), F.coalesce("splits", F.lit(1).cast("bigint"))))).drop("splits")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id.

    A text is lower-cased in A to Z and split at blanks and \\t to \\r; its set are the distinct shingles of
    five words, or all its words as one where they are fewer. component_id is the least key that links reach.
    Null, empty and blank texts have no shingles and are linked with nothing, not even with each other. Repeated
    rows each give a row; rows that share a key are texts of their own. A null key is no least key, unless all
    keys of a component are null. Other columns are not read.
    """
    hashed = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = hashed.select("id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(WORDS), "text").alias("h2"))
    with Scratch(docs.sparkSession) as held:
        marked = held.keep(_marked(hashed, words))
        alive = cut(marked.filter("alive").select("h1", "h2").distinct(), "alive-texts")
        texts = hashed.join(few(alive), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.any_value("text").alias("text"))
        sets = cut(texts.mapInArrow(_sets_of(words), "h1 long, h2 long, n long, tokens binary").withColumn("node", F.monotonically_increasing_id()), "shingle-sets")

        members = _members(sets, held)
        for first in (True, False):
            links = _links(members, first)
            if not links.isEmpty():
                before, members = members, cut(_relabelled(members, components(links)), "connected-groups")
                held.drop(before)

        classes = marked.filter("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("rep"))
        classes = cut(classes.join(sets.select("h1", "h2", "node"), ["h1", "h2"], "left").join(members.select("node", "comp"), "node", "left").select("h1", "h2", "rep", "comp"), "text-classes")
        connected = classes.filter("comp IS NOT NULL")
        least = cut(connected.groupBy("comp").agg(F.min("rep").alias("least")), "least-keys")
        named = connected.join(few(least), "comp").select("h1", "h2", F.col("least").alias("component_id"))
        named = held.keep(cut(named.unionByName(classes.filter("comp IS NULL").select("h1", "h2", F.col("rep").alias("component_id"))), "named-classes"))
    found = marked.join(named, ["h1", "h2"], "left")
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
