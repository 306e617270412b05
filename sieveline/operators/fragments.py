"""Rings, scaffolds and fragments of structures.

functions.structures reads a structure as arrays of atoms and bonds. A structure is small, and what is asked of
its graph here (shortest rings, canonical codes, fragments) stays within it: Spark deals the distinct structures
out, and a short Python function takes each by itself. What goes across structures (vocabulary, incidence,
batches) is joins and aggregates.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveline.functions import structures
from sieveline.session import cut, few, spread

Bond = tuple[int, int, str]
FRAGMENTS = (
    "rings array<array<int>>, ring_linker_key string, fragments array<struct<place:int,kind:string,atoms:array<int>,code:string>>, "
    "edges array<struct<src:int,dst:int,bonds:array<struct<src:int,dst:int,kind:string,ring:boolean>>>>"
)


def _around(n: int, bonds: list[Bond]) -> list[list[tuple[int, int]]]:
    """For each atom (other atom, number of the bond)."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for k, (a, b, _) in enumerate(bonds):
        out[a].append((b, k))
        out[b].append((a, k))
    return out


def core(n: int, bonds: list[Bond]) -> set[int]:
    """Atoms of rings and of what links rings: those left when ends are taken off as long as there are any."""
    around = _around(n, bonds)
    degree, gone = [len(x) for x in around], set()
    ends = [i for i in range(n) if degree[i] < 2]
    while ends:
        i = ends.pop()
        gone.add(i)
        for j, _ in around[i]:
            degree[j] -= 1
            if degree[j] == 1 and j not in gone:
                ends.append(j)
    return set(range(n)) - gone


def rings(n: int, bonds: list[Bond]) -> tuple[list[list[int]], set[int]]:
    """The shortest rings as atoms in order around them, and the numbers of all bonds in rings.

    A ring is two shortest ways from an atom to both ends of a bond. Rings by length: one stays if no shorter ones
    add up to it (bonds as bits, by elimination), so of equally long ones all stay that shorter ones don't give.
    """
    inside = core(n, bonds)
    around = [[x for x in y if x[0] in inside] if i in inside else [] for i, y in enumerate(_around(n, bonds))]
    found: dict[int, list[int]] = {}
    for start in sorted(inside):
        way: dict[int, tuple[int, int]] = {start: (start, -1)}  # atom before, bond to it
        wait = deque([start])
        while wait:
            i = wait.popleft()
            for j, k in around[i]:
                if j not in way:
                    way[j] = i, k
                    wait.append(j)

        def back(i: int, way=way, start=start) -> tuple[list[int], int]:
            atoms, bits = [i], 0
            while i != start:
                i, k = way[i]
                atoms.append(i)
                bits |= 1 << k
            return atoms, bits

        for k, (a, b, _) in enumerate(bonds):
            if a in way and b in way and way[a][1] != k and way[b][1] != k:
                (left, bits), (right, more) = back(a), back(b)
                if not bits & more and set(left) & set(right) == {start}:
                    found.setdefault(bits | more | 1 << k, left[::-1] + right[:-1])
    kept, basis, waiting, size = [], {}, [], 0

    def reduced(bits: int) -> int:
        while bits and (top := bits.bit_length()) in basis:
            bits ^= basis[top]
        return bits

    for bits, atoms in sorted(found.items(), key=lambda x: (len(x[1]), sorted(x[1]))):
        if len(atoms) > size:  # what is as long as the others is held against shorter ones only
            for x in waiting:
                if x := reduced(x):
                    basis[x.bit_length()] = x
            waiting, size = [], len(atoms)
        if reduced(bits):
            kept.append((bits, atoms))
            waiting.append(bits)
    every = 0
    for bits, _ in kept:
        every |= bits
    return [x for _, x in kept], {k for k in range(len(bonds)) if every >> k & 1}


def _refined(colours: list[int], around: list[list[tuple[str, int]]]) -> list[int]:
    """Colours split by those of neighbours until none splits; they are places in an order that doesn't depend on numbering."""
    while True:
        told = [(c, sorted((kind, colours[j]) for kind, j in around[i])) for i, c in enumerate(colours)]
        places = {repr(x): k for k, x in enumerate(sorted({repr(x): x for x in told}.values()))}
        new = [places[repr(x)] for x in told]
        if max(new, default=0) == max(colours, default=0):
            return new
        colours = new


def code(labels: list[tuple], bonds: list[Bond]) -> str:
    """A text that is the same for a graph however it is numbered, and another one for another graph.

    Colours are refined; while atoms share one, those of the first shared colour are singled out in turn, and one
    that gives the least table of bonds is kept. Equal codes mean equal graphs. Equal graphs have equal codes where atoms that
    give the same table are alike, which holds for graphs of structures, though not for all graphs.
    """
    around: list[list[tuple[str, int]]] = [[] for _ in labels]
    for a, b, kind in bonds:
        around[a].append((kind, b))
        around[b].append((kind, a))
    first = {x: k for k, x in enumerate(sorted(set(labels)))}
    colours = _refined([first[x] for x in labels], around)

    def table(colours: list[int]) -> list:
        return sorted((*sorted((colours[a], colours[b])), kind) for a, b, kind in bonds)

    while len(set(colours)) < len(colours):
        shared = min(c for c in colours if colours.count(c) > 1)
        tries = []
        for i in (i for i, c in enumerate(colours) if c == shared):
            own = [2 * c + (c == shared and j != i) for j, c in enumerate(colours)]
            places = {c: k for k, c in enumerate(sorted(set(own)))}
            tries.append(_refined([places[c] for c in own], around))
        colours = min(tries, key=lambda x: (table(x), sorted(x)))
    told = sorted(zip(colours, labels)), table(colours)
    return hashlib.sha256(repr(told).encode()).hexdigest()[:32]


def _marked(atoms: list[dict], bonds: list[Bond]) -> set[int]:
    """Atoms of functional groups: all but carbon, ends of double and triple bonds, and saturated carbon between two of O, N, S with these."""
    marks = {i for i, a in enumerate(atoms) if a["symbol"] != "C"} | {i for a, b, kind in bonds if kind in ("DOUBLE", "TRIPLE") for i in (a, b)}
    around = _around(len(atoms), bonds)
    for i, a in enumerate(atoms):
        saturated = a["symbol"] == "C" and not a["aromatic"] and all(bonds[k][2] == "SINGLE" for _, k in around[i]) and (not a["bracket"] or len(around[i]) + (a["hydrogens"] or 0) == 4)
        hetero = [j for j, _ in around[i] if atoms[j]["symbol"] in ("O", "N", "S") and not atoms[j]["aromatic"]]
        if saturated and len(hetero) > 1:
            marks |= {i, *hetero}
    return marks


def decompose(atoms: list[dict], bonds: list[Bond], found: list[list[int]], in_ring: set[int], merged: bool = False) -> list[tuple[str, list[int]]]:
    """(kind, atoms) of fragments, in order: groups, by their first atom; other bonds out of rings, by place; rings.

    A group is a set of marked atoms that bonds out of rings connect, with what such bonds attach to them; one
    that is a lone atom of a ring is none. Rings that share more than two atoms are put together, as often as
    there are such: the result takes the first one's place, and the others stay as they were, or go if merged.
    """
    if len(atoms) == 1:
        return [("GROUP", [0])]
    marks = _marked(atoms, bonds)
    of = {i: i for i in marks}

    def root(i: int) -> int:
        while of[i] != i:
            i = of[i]
        return i

    outside = [x for k, x in enumerate(bonds) if k not in in_ring]
    for a, b, _ in outside:
        if a in marks and b in marks:
            low, high = sorted((root(a), root(b)))
            of[high] = low
    groups: dict[int, set[int]] = {}
    for i in sorted(marks):
        groups.setdefault(root(i), set()).add(i)
    for a, b, _ in outside:
        if (a in marks) != (b in marks):
            groups[root(a if a in marks else b)] |= {a, b}
    ring_atoms = {i for x in found for i in x}
    out = [("GROUP", sorted(x)) for _, x in sorted(groups.items()) if len(x) > 1 or not x <= ring_atoms]
    out += [("BOND", sorted((a, b))) for a, b, _ in outside if a not in marks and b not in marks]
    sets: list[set[int] | None] = [set(x) for x in found]
    again = True
    while again:
        again = False
        for i, x in enumerate(sets):
            for j in range(i + 1, len(sets) if x else 0):
                if sets[j] and len(x & sets[j]) > 2:
                    x |= sets[j]
                    sets[j], again = None, True
    return out + [("RING", sorted(x or found[i])) for i, x in enumerate(sets) if x or not merged]


def _labels(atoms: list[dict], kept: list[int]) -> list[tuple]:
    return [(atoms[i]["symbol"], atoms[i]["aromatic"], atoms[i]["charge"]) for i in kept]


def _part(atoms: list[dict], bonds: list[Bond], kept: list[int]) -> str:
    place = {i: k for k, i in enumerate(kept)}
    return code(_labels(atoms, kept), [(place[a], place[b], kind) for a, b, kind in bonds if a in place and b in place])


def _one(graph: dict, merged: bool) -> tuple:
    """A structure's rings, key, fragments and edges, as FRAGMENTS has them."""
    atoms, bonds = graph["atoms"], [(x["src"], x["dst"], x["kind"]) for x in graph["bonds"]]
    found, in_ring = rings(len(atoms), bonds)
    # aromatic bonds are those of rings; the one between two rings is not
    bonds = [(a, b, "SINGLE" if kind == "AROMATIC" and k not in in_ring else kind) for k, (a, b, kind) in enumerate(bonds)]
    inside = core(len(atoms), bonds)
    inside |= {j for a, b, kind in bonds if kind == "DOUBLE" for i, j in ((a, b), (b, a)) if i in inside}
    parts = decompose(atoms, bonds, found, in_ring, merged)
    owner = {i: k for k, (_, x) in enumerate(parts) for i in x}  # an atom of several fragments is the last one's
    edges: dict[tuple[int, int], list] = {}
    for k, (a, b, kind) in enumerate(bonds):
        if a in owner and b in owner and owner[a] != owner[b]:
            a, b = (a, b) if owner[a] < owner[b] else (b, a)
            edges.setdefault((owner[a], owner[b]), []).append({"src": a, "dst": b, "kind": kind, "ring": k in in_ring})
    told = [{"place": k, "kind": kind, "atoms": x, "code": _part(atoms, bonds, x)} for k, (kind, x) in enumerate(parts)]
    return found, _part(atoms, bonds, sorted(inside)) if inside else "", told, [{"src": a, "dst": b, "bonds": x} for (a, b), x in sorted(edges.items())]


NAMES = [x.split(" ")[0] for x in FRAGMENTS.split(", ")]


def structure_parts(df: DataFrame, structure: str, merged: bool = False) -> DataFrame:
    """_structure and with_fragments' columns, one row for each distinct structure that can be read."""
    # texts that are no structure are left out by run: a filter on graph would be worked out for each row of df, before distinct
    known = spread(df.select(F.col(f"`{structure}`").alias("_structure")).filter(F.col("_structure").isNotNull()).distinct(), "_structure").withColumn("graph", structures.graph(F.col("_structure")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                part = part.filter(part.column(1).is_valid())
                rows = [_one(x, merged) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[k] for x in rows], kind) for k, kind in enumerate(KINDS))], names=["_structure", *NAMES])

    return known.mapInArrow(run, f"_structure string, {FRAGMENTS}")


def with_fragments(df: DataFrame, structure: str, merged: bool = False) -> DataFrame:
    """df with rings, ring_linker_key, fragments and edges of each structure; null for what is none.

    ring_linker_key is a canonical code of the atoms in rings and between rings, with what is bonded to them
    doubly; empty without rings. It tells elements, charges, aromatic atoms as they are written, and bonds; not
    stereo, and not that a structure written with alternating bonds may be the same as an aromatic one. fragments have their atoms
    and the code of what these and the bonds between them make; an edge joins two fragments by the bonds between atoms that
    they own (an atom of several is the last one's). Each distinct structure is worked on once, and written; time grows with the
    cube of its atoms. Where structures are few, rows meet them where they are.
    """
    worked = few(cut(structure_parts(df, structure, merged), "structure-parts"))
    return df.drop(*NAMES).join(worked, F.col(f"`{structure}`") == F.col("_structure"), "left").drop("_structure")


_BONDS = pa.list_(pa.struct([("src", pa.int32()), ("dst", pa.int32()), ("kind", pa.string()), ("ring", pa.bool_())]))
KINDS = (
    pa.list_(pa.list_(pa.int32())),
    pa.string(),
    pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("atoms", pa.list_(pa.int32())), ("code", pa.string())])),
    pa.list_(pa.struct([("src", pa.int32()), ("dst", pa.int32()), ("bonds", _BONDS)])),
)


def vocabulary(listed: DataFrame, structure: str = "smiles") -> DataFrame:
    """code and place (from 0, by frequency and then text) of a list of fragments, as sources.readers.read_fragments reads it.

    A fragment's code is that of its whole structure; lines that are no structure are left out, and of lines with one code the first counts.
    """
    # the code of a whole structure is that of a fragment of all its atoms
    coded = listed.select(F.col(structure).alias("structure"), F.coalesce("freq", F.lit(0)).alias("freq")).withColumn("graph", structures.graph(F.col("structure"))).filter(F.col("graph").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for graph in batch.column(2).to_pylist():
                bonds = [(x["src"], x["dst"], x["kind"]) for x in graph["bonds"]]
                in_ring = rings(len(graph["atoms"]), bonds)[1]
                bonds = [(a, b, "SINGLE" if kind == "AROMATIC" and k not in in_ring else kind) for k, (a, b, kind) in enumerate(bonds)]
                codes.append(_part(graph["atoms"], bonds, [*range(len(graph["atoms"]))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string())], names=["structure", "freq", "code"])

    first = coded.mapInArrow(run, "structure string, freq bigint, code string").groupBy("code").agg(F.min_by(F.struct("structure", "freq"), F.struct(-F.col("freq"), "structure")).alias("x"))
    return numbered_by(first.select("code", F.col("x.structure").alias("structure"), F.col("x.freq").alias("freq")), (F.desc("freq"), F.asc("structure")), "place")


def numbered_by(df: DataFrame, order: tuple, out: str) -> DataFrame:
    """df with each row's place (from 0) in an order of all rows: rows are dealt by ranges, and sizes of ranges summed up."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = cut(dealt, "numbered-by")  # places hold only as long as ranges do
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    placed = dealt.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.withColumn(out, F.col("_before") + within).drop("_part", "_at", "_before")


def fragment_nodes(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """key, node, kind, atoms, code and word (the fragment's place in the vocabulary, null where it has none), one row a fragment."""
    nodes = df.select(key, F.explode("fragments").alias("f")).select(key, F.col("f.place").alias("node"), "f.kind", "f.atoms", "f.code")
    words = cut(listed.select("code", F.col("place").alias("word")), "fragment-words")
    return nodes.join(few(words), "code", "left").select(key, "node", "kind", "atoms", "code", "word")


def incidence(nodes: DataFrame, key: str, node: str = "node", atoms: str = "atoms") -> DataFrame:
    """key, atom, node: one row for each atom of each node; both ways round it is the same table."""
    return nodes.select(key, F.explode(atoms).alias("atom"), F.col(node).alias("node"))


def batch_offsets(graphs: DataFrame, key: str, size: str, batch: int | None = None, out: str = "offset") -> DataFrame:
    """graphs with the number of nodes before each in key order: what its nodes' numbers are raised by in one disjoint union.

    With batch, unions are of so many graphs each: adds batch (from 0), and offset is within it. Null sizes count as
    0; keys should be distinct (repeated ones get places in any order). Sums over ranges of keys are added up, so no window holds all graphs.
    """
    placed = numbered_by(graphs, (F.asc_nulls_first(key),), "_place")
    n = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    if batch:
        placed = placed.withColumn("batch", F.floor(F.col("_place") / batch))
        before = Window.partitionBy("batch").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        return placed.withColumn(out, F.coalesce(F.sum(n).over(before), F.lit(0))).drop("_place")
    step = 10_000
    chunk = F.floor(F.col("_place") / step)
    sums = placed.groupBy(chunk.alias("_chunk")).agg(F.sum(n).alias("_sum"))
    block = F.floor(F.col("_chunk") / step)
    blocks = sums.groupBy(block.alias("_block")).agg(F.sum("_sum").alias("_total"))
    upto = lambda x: Window.orderBy(x).rowsBetween(Window.unboundedPreceding, -1)  # noqa: E731  a row for each hundred million graphs
    blocks = blocks.select("_block", F.coalesce(F.sum("_total").over(upto("_block")), F.lit(0)).alias("_of_blocks"))
    sums = sums.withColumn("_block", block).join(blocks, "_block")
    within = Window.partitionBy("_block").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_chunk", (F.col("_of_blocks") + F.coalesce(F.sum("_sum").over(within), F.lit(0))).alias("_before"))
    rows = Window.partitionBy("_chunk").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.withColumn("_chunk", chunk).join(sums, "_chunk")
    return joined.withColumn(out, F.col("_before") + F.coalesce(F.sum(n).over(rows), F.lit(0))).drop("_place", "_chunk", "_before")
