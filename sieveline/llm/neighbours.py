"""Nearest neighbours by cross-polytope hashing.

Each of two tables rotates unit vectors by three rounds of random signs and a Hadamard transform, twice over, and
takes the nearest signed axis of both rotations as a bucket. A query probes the buckets that lose least against
its own; how many is chosen by the recall that they have for a sample of the queries, whose nearest are found
among all rows. Buckets are dealt over parts of bounded size. A row goes to one part in each table, a query once
to each part where it probes a bucket; there matrix products score the rows of those buckets, and what may be
among the best few is scored exactly. Nothing is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sieveline.session import cut

TABLES = 2
#: Probes in each table that are tried, by the recall that they give; after the last, all buckets are probed.
PROBES = (8, 16, 30, 60, 125, 250, 500, 1000, 1500, 2000, 3000, 4000, 6000, 8000, 16_000)
#: Axes of each rotation, nearest first, whose pairs are ranked to find how far the probes reach.
AXES = 256
#: Part of the true neighbours of SAMPLE queries that must be met, above the 0.9 that is asked for by the sample's error.
RECALL = 0.94
SAMPLE = 200
SEED = 20_011
#: Buckets of one first axis are dealt in so many cells, by their second axis.
CELLS = 16
#: Bytes of the rows of a part, as numbers of 64 bits; parts of a table, at least.
PART_BYTES = 32 << 20
LEAST_PARTS = 8
#: Rows and queries that one matrix product scores, about.
RUN = 1024
BLOCK = 256
#: Pairs that are scored exactly at once.
TIES = 50_000


@lru_cache(maxsize=64)
def _signs(size: int, table: int, axis: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, table, axis]).choice(np.array([-1.0, 1.0]), (3, size))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, table: int, axis: int) -> np.ndarray:
    """Values along all signed axes, the negative ones last, after one of the table's two pseudo-rotations."""
    size = 1 << max(0, ceil(log2(max(1, unit.shape[1]))))
    x = np.zeros((len(unit), size))
    x[:, : unit.shape[1]] = unit
    for sign in _signs(size, table, axis):
        x = _hadamard(x * sign)
    return np.concatenate([x, -x], axis=1)


def buckets(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axis of each row in both rotations."""
    return rotated(unit, table, 0).argmax(axis=1), rotated(unit, table, 1).argmax(axis=1)


def losses(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """What each signed axis loses against the nearest one in both rotations, in squares; a bucket loses the sum of its two."""
    values = (rotated(unit, table, axis) for axis in (0, 1))
    first, second = ((x.max(axis=1, keepdims=True) - x) ** 2 for x in values)
    return first, second


def reaches(first: np.ndarray, second: np.ndarray, probes: int | None) -> np.ndarray:
    """The loss up to which a query probes, so that it probes that many buckets (None: all)."""
    if probes is None:
        return np.full(len(first), np.inf)
    some = min(AXES, first.shape[1])
    near = [np.partition(x, some - 1, axis=1)[:, :some] for x in (first, second)]
    if probes >= some * some and some == first.shape[1]:
        return np.full(len(first), np.inf)
    sums = (near[0][:, :, None] + near[1][:, None, :]).reshape(len(first), -1)
    at = min(probes, sums.shape[1]) - 1
    return np.partition(sums, at, axis=1)[:, at]


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, by which no square of theirs over- or underflows; cosines stay the same."""
    x = np.asarray(x, dtype=np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines, row by row, in the same order of operations wherever they are computed."""
    return (query * rows).sum(axis=1) / (np.sqrt((query * query).sum(axis=1)) * np.sqrt((rows * rows).sum(axis=1)))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of each length, and these vectors, scaled, as a matrix."""
    lengths = pc.list_value_length(column).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, scaled(column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), length))


# --- how many probes: a sample of queries against all rows ---


def _sample_nearest(asked: list[tuple[int, np.ndarray]], k: int):
    """The k nearest of each sampled query in some of the rows (rep, tag, vec), the query's own class left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in asked]
        for batch in batches:
            for at, rows in _by_length(batch.column(2)):
                mine = [i for i, (_, x) in enumerate(asked) if len(x) == rows.shape[1]]
                if not mine:
                    continue
                near = _unit(np.stack([asked[i][1] for i in mine])) @ _unit(rows).T
                tags = batch.column(1).to_numpy()[at]
                for i, scores in zip(mine, near):
                    top = np.argpartition(-scores, min(k, len(at) - 1))[: k + 1]
                    own = [(-float(scores[j]), int(tags[j]), rows[j].tolist()) for j in top if tags[j] != asked[i][0]]
                    best[i] = sorted(best[i] + own)[:k]
        rows = [(i, -score, tag, vec) for i, found in enumerate(best) for score, tag, vec in found]
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(columns, (pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64())))], names=["query", "score", "tag", "vec"])

    return run


def met_share(pairs: list[tuple[np.ndarray, np.ndarray]], probes: int | None, tables: int = TABLES) -> float:
    """The part of pairs (query, row) that share a bucket: the recall, as those that meet are scored exactly."""
    met = 0
    for length in {len(x) for x, _ in pairs}:
        q, r = (_unit(scaled(np.stack([x[side] for x in pairs if len(x[side]) == length]))) for side in (0, 1))
        together = np.zeros(len(q), dtype=bool)
        for table in range(tables):
            a, b = buckets(r, table)
            first, second = losses(q, table)
            each = np.arange(len(q))
            together |= first[each, a] + second[each, b] <= np.concatenate([reaches(first[i : i + 64], second[i : i + 64], probes) for i in range(0, len(q), 64)])
        met += int(together.sum())
    return met / len(pairs) if pairs else 1.0


def choose(classes: DataFrame, queries: DataFrame, k: int, tables: int = TABLES) -> int | None:
    """Probes in each table: the fewest of PROBES that meet RECALL of a sample's true neighbours; else all.

    What is collected is SAMPLE queries and their k nearest among all rows.
    """
    asked = [(x.qtag, np.asarray(x.vec, dtype=np.float64)) for x in queries.select("query", "qtag", "vec").orderBy(F.xxhash64("qtag"), "query").limit(SAMPLE).collect()]
    near = classes.select("rep", "tag", "vec").mapInArrow(_sample_nearest([(t, scaled(x[None])[0]) for t, x in asked], k), "query long, score double, tag long, vec array<double>")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "tag")
    pairs = [(asked[x.query][1], np.asarray(x.vec)) for x in near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).collect()]
    return next((x for x in PROBES if met_share(pairs, x, tables) >= RECALL), None)


# --- parts: cells of buckets, by both axes, large ones split ---


def _cells(width: int) -> int:
    """How many cells the buckets of one first axis have; widths are powers of two."""
    return min(CELLS, width)


def _cell(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    return a * _cells(width) + b * _cells(width) // width


def _count_cells(tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, rows in _by_length(batch.column(0)):
                for table in range(tables):
                    width = 2 << max(0, ceil(log2(max(1, rows.shape[1]))))
                    mine = counts.setdefault((rows.shape[1], table), np.zeros(width * _cells(width), dtype=np.int64))
                    mine += np.bincount(_cell(*buckets(_unit(rows), table), width), minlength=len(mine))
        rows = [(length, table, cell, int(n)) for (length, table), mine in counts.items() for cell, n in enumerate(mine) if n]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["length", "table", "cell", "n"])

    return run


class Parts:
    """Which parts hold the buckets of each cell: several cells in a row share a part, or one has several."""

    def __init__(self, counts: list[tuple[int, int, int, int]]):
        self.of: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.tables: list[int] = []
        for length, table in sorted({x[:2] for x in counts}):
            mine = sorted((cell, n) for a, b, cell, n in counts if (a, b) == (length, table))
            most = max(1, min(PART_BYTES // (8 * length), ceil(sum(n for _, n in mine) / LEAST_PARTS)))
            width = 2 << max(0, ceil(log2(max(1, length))))
            size = width * _cells(width)
            begins, splits, held = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64), most
            for cell, n in mine:
                splits[cell] = ceil(n / most)
                if splits[cell] > 1 or held + n > most:
                    begins[cell], held = len(self.tables), n if splits[cell] == 1 else most
                    self.tables += [table] * int(splits[cell])
                else:
                    begins[cell], held = len(self.tables) - 1, held + n
            self.of[length, table] = begins, splits

    def __len__(self) -> int:
        return len(self.tables)


def _placed_rows(parts: Parts, tables: int, names: list[str]):
    """Rows (rep, tag, vec) with the part and the bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in _by_length(batch.column(2)):
                kept = batch.take(pa.array(at))
                for table in range(tables):
                    a, b = buckets(_unit(rows), table)
                    begins, splits = parts.of[rows.shape[1], table]
                    width = len(begins) // _cells(2 << max(0, ceil(log2(max(1, rows.shape[1])))))
                    cell = _cell(a, b, width)
                    spread = (kept.column(1).to_numpy().view(np.uint64) % splits[cell].astype(np.uint64)).astype(np.int64)
                    bucket = a * width + b
                    yield pa.RecordBatch.from_arrays([pa.array(begins[cell] + spread, pa.int32()), pa.array(np.zeros(len(at), dtype=bool)), pa.array(bucket), pa.nulls(len(at), pa.float64()), *kept.columns], names=names)

    return run


def _placed_queries(parts: Parts, tables: int, probes: int | None, names: list[str]):
    """Queries (query, qtag, vec) with how far they reach, once for each part where they probe a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in _by_length(batch.column(2)):
                for begin in range(0, len(at), 64):
                    unit = _unit(rows[begin : begin + 64])
                    for table in range(tables):
                        if (rows.shape[1], table) not in parts.of:
                            continue
                        begins, splits = parts.of[rows.shape[1], table]
                        first, second = losses(unit, table)
                        reach = reaches(first, second, probes)
                        held = np.flatnonzero(splits)
                        cells = np.repeat(held, splits[held])
                        own = np.concatenate([begins[x] + np.arange(splits[x]) for x in held])
                        each = _cells(first.shape[1])
                        least = second.reshape(len(second), each, -1).min(axis=2)  # the nearest of a cell's second axes
                        q, part = np.nonzero(first[:, cells // each] + least[:, cells % each] <= reach[:, None])
                        q, part = np.unique(np.stack([q, own[part]]), axis=1)
                        kept = batch.take(pa.array(at[begin + q]))
                        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.ones(len(q), dtype=bool)), pa.array(np.full(len(q), table)), pa.array(reach[q]), *kept.columns], names=names)

    return run


class Part:
    """The rows of a part in memory, by bucket."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        bucket = np.concatenate([x.column(2).to_numpy() for x in pieces])
        order = np.argsort(bucket, kind="stable")
        self.rep, self.tag = (np.concatenate([x.column(n).to_numpy() for x in pieces])[order] for n in (4, 5))
        self.rows = np.concatenate([rows for x in pieces for _, rows in _by_length(x.column(6))])[order]
        self.unit = _unit(self.rows).astype(np.float32)
        self.buckets, begins, self.at = np.unique(bucket[order], return_index=True, return_inverse=True)
        ends = np.append(begins[1:], len(bucket))
        self.runs, first = [], 0
        for n in range(len(begins)):
            if ends[n] - begins[first] >= RUN or n + 1 == len(begins):
                self.runs.append((first, n + 1, int(begins[first]), int(ends[n])))
                first = n + 1

    def best(self, queries: pa.RecordBatch, keep: int) -> pa.RecordBatch:
        """The best rows in probed buckets for each query: those of greatest exact score, the least rep and tag of equals."""
        asked = next(_by_length(queries.column(6)))[1]
        table, reach = int(queries.column(2)[0].as_py()), queries.column(3).to_numpy()
        unit = _unit(asked)
        first, second = losses(unit, table)
        width = first.shape[1]
        a, b = self.buckets // width, self.buckets % width
        unit = unit.astype(np.float32)
        # products of 32 bits round: all that may be among the best is scored exactly
        margin = 4 * (asked.shape[1] + 4) * float(np.finfo(np.float32).eps)
        least = np.full(len(asked), -np.inf)
        q, r, exact = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        more: list[tuple[np.ndarray, np.ndarray]] = []
        held, most = 0, 16 * keep * len(asked)
        for n, (begin, end, start, stop) in enumerate(self.runs):
            probed = first[:, a[begin:end]] + second[:, b[begin:end]] <= reach[:, None]
            asks = np.flatnonzero(probed.any(axis=1))
            if len(asks):
                near = unit[asks] @ self.unit[start:stop].T
                hit = near >= (least[asks] - margin)[:, None]
                if end - begin > 1:
                    hit &= probed[asks][:, self.at[start:stop] - begin]
                else:
                    hit &= probed[asks]
                x, y = np.nonzero(hit)
                more.append((asks[x], start + y))
                held += len(x)
            if more and (held > most or n + 1 == len(self.runs)):
                new_q, new_r = (np.concatenate(x) for x in zip(*more))
                scores = [_scores(asked[new_q[i : i + TIES]], self.rows[new_r[i : i + TIES]]) for i in range(0, len(new_q), TIES)]
                q, r, exact = np.append(q, new_q), np.append(r, new_r), np.concatenate([exact, *scores])
                order = np.lexsort((self.tag[r], self.rep[r], -exact, q))
                q, r, exact = q[order], r[order], exact[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                least[q[place == keep - 1]] = exact[place == keep - 1]
                q, r, exact = q[place < keep], r[place < keep], exact[place < keep]
                more, held = [], 0
        return pa.RecordBatch.from_arrays([queries.column(4).take(pa.array(q)), queries.column(5).take(pa.array(q)), pa.array(self.rep[r]), pa.array(self.tag[r]), pa.array(exact)], names=["query", "qtag", "rep", "tag", "score"])


def _met(keep: int):
    """The best rows for each query of a part; a part's rows come before its queries, which pass by in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces, ready = None, [], None
        for batch in batches:
            which = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.diff(which, prepend=-1))
            for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(which)]):
                here, asks = divmod(int(which[begin]), 2)
                if here != part:
                    part, pieces, ready = here, [], None
                if not asks:
                    pieces.append(batch.slice(begin, end - begin))
                elif pieces:
                    ready = ready or Part(pieces)
                    for at in range(begin, end, BLOCK):
                        yield ready.best(batch.slice(at, min(BLOCK, end - at)), keep)

    return run


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, tables: int = TABLES) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found for each row whose key is divisible by every.

    Nearness is the cosine in double precision, of vectors of any size that is not zero; ties go to the smaller
    key. Candidates are all rows but the query's own. Vectors that are null, empty or zero or hold null or
    non-finite components, and rows without a key, take no part; vectors of different length never meet. Equal
    vectors are indexed once, with their k + 1 smallest keys, of which no query can need more; repeated rows (same
    key and vector) count once, and of rows that share a key alone each asks and is found. Queries that meet no
    candidate have no rows.
    """
    kind = vectors.schema[vector].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vec = F.col(vector) if single else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & (F.size("vec") > 0))
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumns({"tag": F.xxhash64("vec"), "more": F.hash("vec")})
    same = Window.partitionBy("tag", "more").orderBy("id")
    keys = rows.select("id", "tag", "more").distinct()
    ids = keys.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)  # Spark limits groups before the shuffle
    ids = ids.groupBy("tag", "more").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = rows.groupBy("tag", "more").agg(F.any_value("vec").alias("vec")).join(ids, ["tag", "more"])
    classes = cut(classes.withColumn("rep", F.element_at("ids", 1)), "vectors")
    members = keys.filter(F.col("id") % every == 0)
    queries = members.groupBy("tag", "more").agg(F.min("id").alias("query"))  # equal queries ask once
    queries = cut(classes.select("tag", "more", "vec").join(queries, ["tag", "more"]).select("query", F.col("tag").alias("qtag"), "more", "vec"), "query-vectors")

    probes = choose(classes, queries, k, tables)
    counted = classes.select("vec").mapInArrow(_count_cells(tables), "length long, table long, cell long, n long")
    parts = Parts([tuple(x) for x in counted.groupBy("length", "table", "cell").agg(F.sum("n")).collect()])  # 4 * CELLS * length at most for each length and table
    names = ["part", "asks", "bucket", "reach", "rep", "tag", "vec"]
    placed = f"part int, asks boolean, bucket long, reach double, rep long, tag long, vec array<{'float' if single else 'double'}>"
    index = classes.select("rep", "tag", "vec").mapInArrow(_placed_rows(parts, tables, names), placed)
    asking = queries.select("query", "qtag", "vec").mapInArrow(_placed_queries(parts, tables, probes, names), placed)
    together = index.unionByName(asking).repartitionById(max(1, len(parts)), "part").sortWithinPartitions("part", "asks")
    met = together.mapInArrow(_met(k + 1), "query long, qtag long, rep long, tag long, score double")
    met = met.distinct()
    best = Window.partitionBy("query", "qtag").orderBy(F.desc("score"), "rep", "tag")
    met = met.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    found = met.join(classes.select("rep", "tag", "ids"), ["rep", "tag"]).select("query", "qtag", "score", F.explode("ids").alias("vec_id"))
    asked = members.join(queries.select(F.col("qtag").alias("tag"), "more", "query"), ["tag", "more"]).select(F.col("id").alias("query_id"), "query", F.col("tag").alias("qtag"))
    found = found.join(asked, ["query", "qtag"]).filter(F.col("vec_id") != F.col("query_id"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
