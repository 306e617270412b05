"""Ranked lexical search by a tree of frequent terms.

Documents become vectors of their counts of the items' terms, nothing else of them is kept. A task turns its
vectors, chunk by chunk, into a tree: terms are ordered by how many documents hold them, so that documents with
the same frequent terms share a path from the root, and a path is followed down until LEAF documents are left.
Each node has, for every term beneath it, the largest count in any one document, and the least length factor m;
as a score grows with counts and falls with m, these bound all scores beneath. An item walks the tree depth
first, the child with the largest bound first, and leaves out every node whose bound is below the worst score
that it still keeps. Documents don't move: a task hands on at most as many as each item may keep.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveline.llm import workers
from sieveline.llm.bpe import _ranges
from sieveline.llm.decontaminate import item_blocks
from sieveline.session import Scratch, cut

MOST = 20
#: Documents of a leaf, and counts and documents of one tree.
LEAF = 128
COUNTS = 1 << 20
DOCS = 1 << 14
#: Files of vectors that give each item a first threshold, which all tasks start with; any documents do for that.
FIRST_FILES = 4
#: An item's candidates are cut to MOST within each of so many groups of tasks before they meet.
GROUPS = 64

# bytes that belong to no term become blanks, and A-Z become a-z; bytes of 128 and more belong to other letters
_PLAIN = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or chr(x).isalnum() else 32 for x in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return (text or "").encode().translate(_PLAIN).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term with weight 1 adds to a score."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Tree:
    """Vectors of documents as a tree; ranks are terms by falling frequency, ascending within a document."""

    def __init__(self, counts: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, m: np.ndarray, n_terms: int, leaf: int = LEAF):
        begins = np.cumsum(counts) - counts
        path = ranks.astype(">u4").tobytes()
        paths = [path[4 * a : 4 * (a + n)] for a, n in zip(begins.tolist(), counts.tolist())]
        self.order = np.array(sorted(range(len(counts)), key=paths.__getitem__), dtype=np.int64)
        at = _ranges(begins[self.order], counts[self.order])
        self.counts, self.m, self.ranks, self.tfs = counts[self.order], m[self.order], ranks[at], tfs[at]
        self.begins, self.leaf, self.n_docs = np.cumsum(self.counts) - self.counts, leaf, len(counts)
        self.leaves: list[tuple[int, int]] = []
        self.inner: list[tuple[int, int, list[int]]] = []  # first leaf, end of leaves, children
        self.root = self._grow(0, self.n_docs, 0) if self.n_docs else None
        self._bound(n_terms)
        docs = np.repeat(np.arange(self.n_docs), self.counts)
        place = np.argsort(self.ranks * max(1, self.n_docs) + docs, kind="stable")
        self.doc, self.tf = docs[place], self.tfs[place]
        self.by_term = self.ranks[place] * max(1, self.n_docs) + self.doc

    def _new_leaf(self, low: int, high: int) -> int:
        self.leaves.append((low, high))
        return -len(self.leaves)  # leaves are -1, -2, ..., inner nodes 0, 1, ...

    def _grow(self, low: int, high: int, depth: int) -> int:
        """The node of documents low to high, whose paths share their first terms up to depth."""
        if high - low <= self.leaf:
            return self._new_leaf(low, high)
        first, last = (self.ranks[self.begins[i] : self.begins[i] + self.counts[i]] for i in (low, high - 1))
        least = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:least] != last[depth:least])
        depth = depth + int(differ[0]) if len(differ) else least  # a path without branches is one step
        has = self.counts[low:high] > depth
        step = np.full(high - low, -1, dtype=np.int64)
        step[has] = self.ranks[self.begins[low:high][has] + depth]
        edges = [low, *(np.flatnonzero(step[1:] != step[:-1]) + low + 1).tolist(), high]
        if len(edges) == 2:  # all have the same terms
            edges = [*range(low, high, self.leaf), high]
        leaf, children, begin = len(self.leaves), [], low
        for a, b in zip(edges, edges[1:]):
            if begin < a and b - begin > self.leaf:
                children.append(self._new_leaf(begin, a))  # small branches side by side are one leaf
                begin = a
            if b - begin > self.leaf:
                children.append(self._grow(a, b, depth + 1))
                begin = b
        if begin < high:
            children.append(self._new_leaf(begin, high))
        self.inner.append((leaf, len(self.leaves), children))
        return len(self.inner) - 1

    def _bound(self, n_terms: int) -> None:
        """For each term the nodes above it, with its largest count; for each node its least m."""
        n = len(self.leaves)
        ends = np.array([x for _, x in self.leaves], dtype=np.int64)
        sizes = np.diff(ends, prepend=0)
        owner = np.repeat(np.repeat(np.arange(n), sizes), self.counts)
        nodes, terms, most = [], [], []

        def largest(of: int, owner: np.ndarray, ranks: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, ...]:
            place = np.argsort(owner * n_terms + ranks, kind="stable")
            keys = (owner * n_terms + ranks)[place]
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            return keys[new] // n_terms + of, keys[new] % n_terms, np.maximum.reduceat(tfs[place], new) if len(new) else tfs[:0]

        leaf_node, leaf_term, leaf_most = largest(0, owner, self.ranks, self.tfs)
        nodes, terms, most = [leaf_node], [leaf_term], [leaf_most]
        edge = np.searchsorted(leaf_node, np.arange(n + 1))
        least = [self.m[a:b].min() for a, b in self.leaves]
        for k, (a, b, _) in enumerate(self.inner):
            part = slice(edge[a], edge[b])
            for out, x in zip((nodes, terms, most), largest(n + k, np.zeros(edge[b] - edge[a], dtype=np.int64), leaf_term[part], leaf_most[part])):
                out.append(x)
            least.append(min(least[a:b]))
        node, term = np.concatenate(nodes), np.concatenate(terms)
        place = np.argsort(term, kind="stable")
        self.node, self.most = node[place], np.concatenate(most)[place]
        self.of_term = np.searchsorted(term[place], np.arange(n_terms + 1))
        self.least = np.array(least, dtype=np.int64)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For leaves 0, 1, ... and then inner nodes 0, 1, ... no score beneath is larger."""
        n = self.of_term[terms + 1] - self.of_term[terms]
        at = _ranges(self.of_term[terms], n)
        node = self.node[at]
        parts = np.repeat(weights, n) * gain(self.most[at], self.least[node])
        return np.bincount(node, weights=parts, minlength=len(self.least)).astype(np.int64)  # whole numbers below 2^53

    def scores(self, low: int, high: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of the tree's documents low to high."""
        begin = np.searchsorted(self.by_term, terms * self.n_docs + low)
        n = np.searchsorted(self.by_term, terms * self.n_docs + high) - begin
        at = _ranges(begin, n)
        doc = self.doc[at]
        return np.bincount(doc - low, weights=np.repeat(weights, n) * gain(self.tf[at], self.m[doc]), minlength=high - low).astype(np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple], keys: list, floor: int, most: int) -> list[tuple]:
        """best, a list of (-score, no key, key) in order, with this tree's documents among them; floor: lower scores are of no use."""
        if self.root is None or not len(terms):
            return best
        bounds, n = self.bounds(terms, weights), len(self.leaves)
        waiting = [self.root]
        while waiting:
            v = waiting.pop()
            if len(best) == most:
                floor = max(floor, -best[-1][0])
            if bounds[v + n if v >= 0 else -v - 1] < floor:
                continue
            if v >= 0:
                waiting += sorted(self.inner[v][2], key=lambda c: bounds[c + n if c >= 0 else -c - 1])
                continue
            low, high = self.leaves[-v - 1]
            scores = self.scores(low, high, terms, weights)
            good = np.flatnonzero(scores >= floor)
            if len(good):
                # of scores that tie, all go on to be put in order by their keys
                found = [(-s, keys[k] is None, keys[k]) for s, k in zip(scores[good].tolist(), self.order[low + good].tolist())]
                best = sorted(best + found, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:most]
        return best


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, and how many each row has."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8)[ends[0] : ends[-1]].view("<u4"), np.diff(ends) // 4


def vectors(docs: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n (all terms), terms (numbers in the vocabulary) and tfs of each document that has a term; packed unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("ranked-search")
        number = {x: i for i, x in enumerate(shared.value)}
        for batch in batches:
            rows, terms, tfs, n = [], [], [], []
            for i, x in enumerate(workers.texts(batch.column(1))):
                if words := terms_of(x):
                    counts = Counter(map(number.get, words))
                    counts.pop(None, None)
                    rows.append(i)
                    n.append(len(words))
                    terms.append(np.fromiter(counts.keys(), dtype="<u4", count=len(counts)).tobytes())
                    tfs.append(np.fromiter(counts.values(), dtype="<u4", count=len(counts)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=[key, "n", "terms", "tfs"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n bigint, terms binary, tfs binary")


def document_counts(found: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents with each term of the vocabulary, whose size bounds what is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(_binary(batch.column(0))[0], minlength=n_terms)
        term = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(counts[term])], names=["term", "df"])

    n_docs, n_all = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(n_terms, dtype=np.int64)
    for term, n in found.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    return n_docs, n_all, df


def _candidates(found: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray, floors: list[int], n_docs: int, n_all: int, key: str, most: int, leaf: int) -> DataFrame:
    """item (its number), key and score of each task's best documents, at most as many an item as it may keep."""
    shared = found.sparkSession.sparkContext.broadcast((items, rank, floors))
    n_terms = len(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("ranked-search")
        items, rank, floors = shared.value
        best: list[list[tuple]] = [[] for _ in items]

        def grow(rows: list[tuple]) -> None:
            keys = [k for x in rows for k in x[0]]
            counts, terms, tfs = (np.concatenate([x[j] for x in rows]) for j in (2, 3, 4))
            ranks = rank[terms]
            place = np.argsort(np.repeat(np.arange(len(counts)), counts) * n_terms + ranks, kind="stable")
            tree = Tree(counts.astype(np.int64), ranks[place], tfs[place].astype(np.int64), np.concatenate([x[1] for x in rows]), n_terms, leaf)
            for i, (terms, weights) in enumerate(items):
                best[i] = tree.search(terms, weights, best[i], keys, floors[i], most)

        waiting, held, n = [], 0, 0
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                (terms, counts), (tfs, _) = _binary(part.column(2)), _binary(part.column(3))
                waiting.append((part.column(0).to_pylist(), part.column(1).to_numpy(), counts, terms, tfs))
                held, n = held + len(terms), n + len(counts)
                if held >= COUNTS or n >= DOCS:
                    grow(waiting)
                    waiting, held, n = [], 0, 0
        if waiting:
            grow(waiting)
        for i in range(0, len(best), 4096):
            rows = [(i + j, k, -s) for j, x in enumerate(best[i : i + 4096]) for s, _, k in x]
            if rows:
                item, keys, scores = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(keys, kind), pa.array(scores, pa.int64())], names=["item", key, "score"])
        workers.release()

    # an item's terms are some dozens; 64-bit numbers hold 25 n N for fewer than some 10^17 terms times documents
    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}L) div {max(1, n_all)}L")
    return found.select(F.col(key), m.alias("m"), "terms", "tfs").mapInArrow(run, f"item bigint, `{key}` {found.schema[key].dataType.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", most: int = MOST, leaf: int = LEAF) -> DataFrame:
    """item, rank (from 1), key and score of the most documents with the highest scores for each item, as the module says.

    Ties go to the smaller key, a null key last; repeated documents each count and rank. Items that are null or
    have a null id give no row, repeated ones count once, and different texts under one id each have their ranks.
    Documents without a term (null, empty, signs only) count nowhere and are never found; nor are those with score
    0, as where all documents hold a term. Empty tables give no rows. Other columns are not read. Items go in
    blocks of at most 8 MB of text, each block with one pass over the documents and one over their vectors.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item].dataType.simpleString()
    with Scratch(spark) as held:
        parts = [held.keep(cut(_block(docs, block, key, text, item, item_kind, most, leaf), "ranked")) for block in item_blocks(items, item, item_text)]
    found = spark.createDataFrame([], f"`{item}` {item_kind}, rank int, `{key}` {kind}, score bigint")
    for x in parts:
        found = found.unionByName(x)
    return found


def _block(docs: DataFrame, block: tuple, key: str, text: str, item: str, item_kind: str, most: int, leaf: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(terms_of(x)) for _, x in block]
    vocabulary = sorted({t for x in counted for t in x})
    number = {x: i for i, x in enumerate(vocabulary)}
    found = cut(vectors(docs, vocabulary, key, text), "vectors")
    n_docs, n_all, df = document_counts(found, len(vocabulary))
    rank = np.empty(len(vocabulary), dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    weights = {x: weight(n_docs, int(df[i])) for x, i in number.items() if df[i]}
    asked = []
    for x in counted:
        terms = sorted((int(rank[number[t]]), n * weights[t]) for t, n in x.items() if weights.get(t))
        asked.append((np.array([t for t, _ in terms], dtype=np.int64), np.array([w for _, w in terms], dtype=np.int64)))
    tell = (n_docs, n_all, key, most, leaf)
    floors = [1] * len(block)
    if files := found.inputFiles()[:FIRST_FILES]:
        first = _candidates(spark.read.schema(found.schema).parquet(*files), asked, rank, floors, *tell)
        by_item = Window.partitionBy("item").orderBy(F.desc("score"))
        for i, score in first.withColumn("n", F.row_number().over(by_item)).filter(F.col("n") == most).select("item", "score").collect():
            floors[i] = max(1, score)
    best = _candidates(found, asked, rank, floors, *tell)
    order = (F.desc("score"), F.col(key).asc_nulls_last())
    group = F.spark_partition_id() % GROUPS
    some = best.withColumn("group", group).withColumn("n", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).filter(F.col("n") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= most)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item bigint, name {item_kind}")
    return ranked.join(names, "item").select(F.col("name").alias(item), "rank", key, "score")


ORACLE = r"""
WITH plain AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
size AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM plain WHERE len(terms) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM plain) GROUP BY doc_id, n, term),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term), size),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term), size GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
WHERE rank <= 20"""
