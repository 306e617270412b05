"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Words are found without a regular expression. Every code point has a class; every class is a function from
the states of a small automaton to its states; composing such functions is associative, so the state before
each code point comes from a blocked scan over whole arrays, and with it whether a word starts there. The
words' slices are looked up in a cache of merged pairs; what is missing is merged by rank. Token ids and
bytes are then gathered by array operations, with the offsets kept, so that decoding is a gather as well.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers

#: The endings that the published pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Code points with Unicode's White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

OTHER, LETTER, NUMBER, WHITE_ON, SPACE_LAST, WHITE_LAST, QUOTE_1, QUOTE_2, END = range(9)
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
COLUMNS = 256
CACHE_MOST = 3 << 17
CHARS_AT_ONCE = 1 << 20


def _step(kind: int, state: int) -> tuple[int, bool]:
    """The next state, and whether a word starts at a code point of this class."""
    if kind == LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (CLOSED if state == ONE_LEFT else ONE_LEFT), False
    if kind in (LETTER, NUMBER, OTHER):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[kind]
        return run, state not in (run, AFTER_SPACE)
    if kind in (QUOTE_1, QUOTE_2):
        if state in (IN_OTHER, AFTER_SPACE):
            return IN_OTHER, False
        return (ONE_LEFT if kind == QUOTE_1 else TWO_LEFT), True
    if kind == WHITE_ON:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if kind == SPACE_LAST else CLOSED), True


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Functions that the classes generate: of each class, composed two by two, applied to states; and where words start."""
    single = [tuple(_step(kind, state)[0] for state in range(8)) for kind in range(9)]
    known = {tuple(range(8)): 0}
    todo = list(known)
    while todo:
        first = todo.pop()
        for then in single:
            if (both := tuple(then[x] for x in first)) not in known:
                known[both] = len(known)
                todo.append(both)
    functions = np.array(list(known), dtype=np.uint8)
    composed = np.array([[known[tuple(then[x] for x in first)] for then in single] for first in known], dtype=np.uint16)
    starts = np.array([[_step(kind, state)[1] for state in range(8)] for kind in range(9)])
    return np.array([known[x] for x in single], dtype=np.uint16), composed, functions, starts


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point, before what follows it is looked at."""
    first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((first.get(unicodedata.category(chr(x))[0], OTHER) for x in range(0x110000)), dtype=np.uint8, count=0x110000)
    table[WHITE] = WHITE_ON
    return table


def word_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words start in code points; ends: the positions of one mark after each text, which also count as starts."""
    kinds = _classes()[points]
    kinds[ends] = END
    following = np.append(kinds[1:], END)
    last = (kinds == WHITE_ON) & (following != WHITE_ON) & (following != END)
    for at in np.flatnonzero((points == 0x27) & (kinds != END)):
        ahead = "".join(map(chr, points[at + 1 : at + 3]))
        for ending in ENDINGS:
            if ahead.startswith(ending) and (END not in kinds[at + 1 : at + 1 + len(ending)]):
                kinds[at] = QUOTE_1 if len(ending) == 1 else QUOTE_2
    kinds[last] = np.where(points[last] == 0x20, SPACE_LAST, WHITE_LAST)
    _, composed, functions, starts = _automaton()
    rows = -(-len(kinds) // COLUMNS)
    grid = np.full(rows * COLUMNS, END, dtype=np.uint8)
    grid[: len(kinds)] = kinds
    grid = np.ascontiguousarray(grid.reshape(rows, COLUMNS).T)
    before = np.empty(grid.shape, dtype=np.uint16)
    so_far = np.zeros(rows, dtype=np.uint16)
    for column, kind in enumerate(grid):
        before[column] = so_far
        so_far = composed[so_far, kind]
    carried, state = np.empty(rows, dtype=np.uint8), CLOSED
    for row, whole in enumerate(so_far.tolist()):
        carried[row] = state
        state = functions[whole, state]
    states = functions[before, carried]
    return np.flatnonzero(starts[grid, states].T.reshape(-1)[: len(kinds)])


class _Seen(dict):
    """The number of each word so far; words that are missing are merged, and wait in new."""

    def __init__(self, bpe: ByteBPE):
        self.bpe, self.new = bpe, []

    def __missing__(self, word: str) -> int:
        self.new.append(self.bpe.merged(word.encode("utf-8", "replace")))
        self[word] = k = len(self)
        return k


class ByteBPE:
    """Encodes and decodes by the ranks of a .tiktoken file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            words[rank] = word
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.lengths = np.array([len(x) for x in words], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.forget()

    def forget(self) -> None:
        self.seen = _Seen(self)
        self.counts, self.flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word: the adjacent pair of least rank is merged first, the leftmost of equals."""
        ranks = self.ranks
        if (whole := ranks.get(word)) is not None:
            return [whole]
        if len(word) > 48:
            return self._merged_long(word)
        get, none = ranks.get, 1 << 60
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != none:
            at = pairs.index(best)
            both = parts[at] + parts[at + 1]
            parts[at : at + 2] = [both]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + both, none)
            if at < len(pairs):
                pairs[at] = get(both + parts[at + 1], none)
        return [ranks[x] for x in parts]

    def _merged_long(self, word: bytes) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        ranks, n = self.ranks, len(word)
        parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j], after[i] = pair, None, after[j]
            if after[i] < n:
                prior[after[i]] = i
            for k in (prior[i], i):
                if k >= 0 and after[k] < n and (r := ranks.get(parts[k] + parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k] + parts[after[k]]))
        return [ranks[x] for x in parts if x is not None]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(x) + 1 for x in texts]) - 1
        starts = word_starts(points, ends)
        if len(self.seen) > CACHE_MOST:
            self.forget()
        at = starts.tolist()
        at.append(len(joined))
        which = np.array([*map(self.seen.__getitem__, map(joined.__getitem__, map(slice, at, at[1:])))], dtype=np.int64)
        if new := self.seen.new:
            self.counts = np.append(self.counts, np.fromiter(map(len, new), dtype=np.int64, count=len(new)))
            self.flat = np.append(self.flat, np.array([x for ids in new for x in ids], dtype=np.uint32))
            new.clear()
        mark = np.searchsorted(starts, ends)  # the marks are words of their own, and give no ids
        lengths = self.counts[which]
        lengths[mark] = 0
        ids = self.flat[_ranges((np.cumsum(self.counts) - self.counts)[which], lengths)]
        return ids, np.cumsum(lengths)[mark]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and where each id's bytes end."""
        lengths = self.lengths[ids]
        return self.bytes[_ranges(self.offsets[ids], lengths)], np.cumsum(lengths)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its length."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def in_parts(texts: Iterable[str], most: int = CHARS_AT_ONCE) -> Iterator[list[str]]:
    """Lists of texts with about as many characters; a longer text stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        yield part


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: key, n_tokens, ids_sha256, decoded_sha256, if kept ids and byte_ends, and the columns to carry.

    ids: token ids as little-endian unsigned 32-bit integers; byte_ends: likewise where each token's bytes end
    in the decoded text. A null text counts as empty; it and an empty text have no tokens. Repeated rows and
    rows with a null key each give a row. All other columns of docs, whatever their names, are not read. The path
    of the rank file must exist on every executor.
    """
    fields = [(key, docs.schema[key].dataType.simpleString()), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    if keep_ids:
        fields += [("ids", "binary"), ("byte_ends", "binary")]
    own = len(fields)
    fields += [(x, docs.schema[x].dataType.simpleString()) for x in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("bpe", load.cache_clear)
        bpe = load(path)
        for batch in batches:
            rows, done = [[] for _ in fields[1:own]], 0

            def made() -> pa.RecordBatch:
                columns = [*(pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary())))]
                kept = [batch.column(n).slice(done, len(rows[0])) for n in (0, *range(2, 2 + len(carry)))]
                return pa.RecordBatch.from_arrays([kept[0], *columns, *kept[1:]], names=[x for x, _ in fields])

            for part in in_parts(x or "" for x in workers.texts(batch.column(1))):
                ids, ends = bpe.encode(part)
                decoded, byte_ends = bpe.decode(ids)
                begin = 0
                for end in ends.tolist():
                    tokens = ids[begin:end]
                    first, last = (int(byte_ends[begin - 1]) if begin else 0), (int(byte_ends[end - 1]) if end else 0)
                    found = [end - begin, hashlib.sha256(raw := tokens.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded[first:last].tobytes()).hexdigest()]
                    if keep_ids:
                        found += [raw, (byte_ends[begin:end] - first).astype("<u4").tobytes()]
                    for column, value in zip(rows, found):
                        column.append(value)
                    begin = end
                if keep_ids:  # ids are large: a part's leave before the next part's are made
                    yield made()
                    rows, done = [[] for _ in rows], done + len(rows[0])
            if not keep_ids:
                yield made()
        workers.release()

    return docs.select(F.col(key), F.col(text), *carry).mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in fields))
