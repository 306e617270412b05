"""Structures in line notation as arrays of atoms and bonds, read by columns alone.

A text is cut into tokens, and one fold over them keeps the branches that are open, the ring closures that wait
for their other end, and the atom that the next one is bonded to. What is no structure gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The signs of the notation.
TOKEN = r"\[[^\[\]]*\]|Br|Cl|[BCNOPSFI]|[bcnops]|\*|%[0-9]{2}|%\([0-9]+\)|[0-9]|[()]|\.|[-=#$:/\\~]"
BRACKET = r"^\[([0-9]*)(se|as|te|[A-Z][a-z]?|[bcnops]|\*)(@{0,2}(?:[A-Z]{2}[0-9]+)?)(H[0-9]*)?(\++[0-9]*|-+[0-9]*)?(:[0-9]+)?\]$"
KINDS = {"-": "SINGLE", "/": "SINGLE", "\\": "SINGLE", "=": "DOUBLE", "#": "TRIPLE", "$": "QUADRUPLE", ":": "AROMATIC", "~": "ANY"}
#: How many bonds an atom that is written without brackets may have.
VALENCES = {"B": 3, "C": 4, "N": 3, "O": 2, "F": 1}
ORDERS = {"SINGLE": 1, "DOUBLE": 2, "TRIPLE": 3, "QUADRUPLE": 4}

ATOM = "struct<symbol:string,aromatic:boolean,charge:int,hydrogens:int,isotope:int,bracket:boolean>"
GRAPH = f"struct<atoms:array<{ATOM}>,bonds:array<struct<src:int,dst:int,kind:string>>>"
_STATE = "struct<prev:int,n:int,bond:string,stack:array<int>,open:array<struct<label:string,atom:int,bond:string>>,bonds:array<struct<src:int,dst:int,bond:string>>,bad:boolean>"


def let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lookup(key: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def _atom(token: Column) -> Column:
    bracket = token.startswith("[")
    part = lambda i: F.regexp_extract(token, BRACKET, i)
    symbol = F.when(bracket, part(2)).otherwise(token)
    sign, number = F.substring(part(5), 1, 1), F.nullif(F.regexp_extract(part(5), "[0-9]+", 0), F.lit(""))
    size = F.coalesce(number.cast("int"), F.length(part(5)))
    hydrogens = F.when(bracket, F.when(part(4) == "", 0).otherwise(F.coalesce(F.nullif(F.substring(part(4), 2, 9), F.lit("")).cast("int"), F.lit(1))))
    return F.struct(
        F.concat(F.upper(F.substring(symbol, 1, 1)), F.substring(symbol, 2, 1)).alias("symbol"),
        (F.lower(symbol) == symbol).__and__(symbol != "*").alias("aromatic"),
        F.when(sign == "+", size).when(sign == "-", -size).otherwise(0).cast("int").alias("charge"),
        hydrogens.cast("int").alias("hydrogens"),
        F.nullif(part(1), F.lit("")).cast("int").alias("isotope"),
        bracket.alias("bracket"),
    )


def _step(s: Column, t: Column) -> Column:
    """The state after one token."""
    atom = t.rlike(r"^[\[A-Za-z*]")
    ring, bond = t.rlike("^[%0-9]"), t.rlike(r"^[-=#$:/\\~]$")
    label = F.regexp_replace(t, "[%()]", "")
    waiting = F.get(F.filter(s["open"], lambda x: x["label"] == label), F.lit(0))
    closes = ring & waiting.isNotNull()
    both = F.when(s["bond"] == "", waiting["bond"]).otherwise(s["bond"])
    new = F.struct(F.when(closes, waiting["atom"]).otherwise(s["prev"]).alias("src"), F.when(closes, s["prev"]).otherwise(s["n"]).alias("dst"), F.when(closes, both).otherwise(s["bond"]).alias("bond"))
    again = F.exists(s["bonds"], lambda b: ((b["src"] == waiting["atom"]) & (b["dst"] == s["prev"])) | ((b["src"] == s["prev"]) & (b["dst"] == waiting["atom"])))
    differ = (s["bond"] != "") & (waiting["bond"] != "") & (s["bond"] != waiting["bond"]) & ~(s["bond"].isin("/", "\\") & waiting["bond"].isin("/", "\\"))
    wrong = (
        F.when(t == "(", (s["prev"] < 0) | (s["bond"] != ""))
        .when(t == ")", (F.size(s["stack"]) == 0) | (s["bond"] != ""))
        .when(t == ".", s["bond"] != "")
        .when(bond, (s["prev"] < 0) | (s["bond"] != ""))
        .when(closes, (waiting["atom"] == s["prev"]) | again | differ)
        .when(ring, s["prev"] < 0)
        .when(t.startswith("["), ~t.rlike(BRACKET))
        .otherwise(False)
    )
    return F.struct(
        F.when(atom, s["n"]).when(t == ")", F.coalesce(F.get(s["stack"], F.size(s["stack"]) - 1), F.lit(-1))).when(t == ".", F.lit(-1)).otherwise(s["prev"]).alias("prev"),
        (s["n"] + atom.cast("int")).alias("n"),
        F.when(bond, t).when(atom | ring, F.lit("")).otherwise(s["bond"]).alias("bond"),
        F.when(t == "(", F.concat(s["stack"], F.array(s["prev"]))).when(t == ")", F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(0)))).otherwise(s["stack"]).alias("stack"),
        F.when(closes, F.filter(s["open"], lambda x: x["label"] != label)).when(ring, F.concat(s["open"], F.array(F.struct(label.alias("label"), s["prev"].alias("atom"), s["bond"].alias("bond"))))).otherwise(s["open"]).alias("open"),
        F.when(closes | (atom & (s["prev"] >= 0)), F.concat(s["bonds"], F.array(new))).otherwise(s["bonds"]).alias("bonds"),
        (s["bad"] | wrong).alias("bad"),
    )


def graph(text: Column) -> Column:
    """atoms (symbol, aromatic, charge, hydrogens if told, isotope, bracket) and bonds (src, dst from 0, kind) of a structure.

    What follows the first blank is a name and not read. Null for null, empty and unreadable texts: signs that
    are none of the notation, branches or rings that stay open, two bonds between the same atoms, more bonds than
    VALENCES has for atoms out of brackets, and aromatic atoms with less than two. Hydrogens that are written as atoms, bonded once and to another element, are
    taken out, unless they have a charge or an isotope. A bond without a sign between two aromatic atoms is AROMATIC; whether
    it lies in a ring is for operators.fragments to see. Work grows with the square of a text's tokens.
    """
    first = F.regexp_extract(text, r"^\s*(\S+)", 1)
    tokens = F.regexp_extract_all(first, F.lit(TOKEN), F.lit(0))
    start = F.lit(None).cast(_STATE)
    start = F.struct(F.lit(-1).alias("prev"), F.lit(0).alias("n"), F.lit("").alias("bond"), F.array().cast("array<int>").alias("stack"), F.array().cast("array<struct<label:string,atom:int,bond:string>>").alias("open"), F.array().cast("array<struct<src:int,dst:int,bond:string>>").alias("bonds"), F.lit(False).alias("bad")).cast(_STATE)
    folded = F.aggregate(tokens, start, lambda s, t: _step(s, t).cast(_STATE))
    atoms = F.transform(F.filter(tokens, lambda t: t.rlike(r"^[\[A-Za-z*]")), _atom)

    def told(x: Column) -> Column:
        end = x["end"]
        good = (F.array_join(x["tokens"], "") == x["text"]) & (x["text"] != "") & ~end["bad"] & (F.size(end["stack"]) == 0) & (F.size(end["open"]) == 0) & (end["bond"] == "") & (end["n"] > 0)
        both = lambda b: F.get(x["atoms"], b["src"])["aromatic"] & F.get(x["atoms"], b["dst"])["aromatic"]
        kinds = F.transform(end["bonds"], lambda b: F.struct(b["src"].alias("src"), b["dst"].alias("dst"), F.coalesce(_lookup(F.nullif(b["bond"], F.lit("")), KINDS), F.when(both(b), F.lit("AROMATIC")).otherwise(F.lit("SINGLE"))).alias("kind")))
        return F.when(good, F.struct(x["atoms"].alias("atoms"), kinds.alias("bonds")).cast(GRAPH))

    read = let(F.struct(first.alias("text"), tokens.alias("tokens"), folded.alias("end"), atoms.alias("atoms")), told)
    return let(let(read, _without_hydrogens), lambda g: F.when(g.isNotNull() & ~_impossible(g), g))


def neighbours(g: Column, i: Column) -> Column:
    """The bonds of atom i."""
    return F.filter(g["bonds"], lambda b: (b["src"] == i) | (b["dst"] == i))


def _other(b: Column, i: Column) -> Column:
    return F.when(b["src"] == i, b["dst"]).otherwise(b["src"])


def _without_hydrogens(g: Column) -> Column:
    bare = lambda a: (a["symbol"] == "H") & (a["charge"] == 0) & a["isotope"].isNull()

    def goes(i: Column) -> Column:
        bonds = neighbours(g, i)
        heavy = F.get(g["atoms"], _other(F.get(bonds, F.lit(0)), i))["symbol"] != "H"
        return bare(F.get(g["atoms"], i)) & (F.size(bonds) == 1) & F.coalesce(heavy, F.lit(False))

    every = F.sequence(F.lit(0), F.size(g["atoms"]) - 1)

    def renumbered(kept: Column) -> Column:
        place = lambda i: (F.array_position(kept, i) - 1).cast("int")
        inner = F.filter(g["bonds"], lambda b: F.array_contains(kept, b["src"]) & F.array_contains(kept, b["dst"]))
        moved = F.transform(inner, lambda b: F.struct(place(b["src"]).alias("src"), place(b["dst"]).alias("dst"), b["kind"].alias("kind")))
        return F.struct(F.transform(kept, lambda i: F.get(g["atoms"], i)).alias("atoms"), moved.alias("bonds")).cast(GRAPH)

    return F.when(F.exists(g["atoms"], bare), let(F.filter(every, lambda i: ~goes(i)), renumbered)).otherwise(g)


def _impossible(g: Column) -> Column:
    """Whether an atom out of brackets, not aromatic, has more bonds than it can have, or an aromatic one fewer than a ring needs."""
    order = lambda i: F.aggregate(neighbours(g, i), F.lit(0), lambda n, b: n + F.coalesce(_lookup(b["kind"], ORDERS), F.lit(1)))
    most = lambda a: F.coalesce(_lookup(a["symbol"], VALENCES), F.lit(1 << 20))
    # nitrogen with five bonds is another way to write one with a charge, if some are double or triple
    charged = lambda a, i: (a["symbol"] == "N") & (order(i) == 5) & (F.size(neighbours(g, i)) < 5)
    full = lambda a, i: ~a["bracket"] & (order(i) > most(a)) & ~charged(a, i)
    return F.exists(F.transform(g["atoms"], lambda a, i: F.when(a["aromatic"], F.size(neighbours(g, i)) < 2).otherwise(full(a, i))), lambda x: x)


def pkas(g: Column) -> Column:
    """acid (4.5, where an oxygen's only bond is to a carbon) and base (9.5, where a nitrogen has three bonds at most); null where there is none."""
    symbol = lambda i: F.get(g["atoms"], i)["symbol"]
    end = lambda a, b: (symbol(a) == "O") & (symbol(b) == "C") & (F.size(neighbours(g, a)) == 1)
    acid = F.exists(g["bonds"], lambda b: end(b["src"], b["dst"]) | end(b["dst"], b["src"]))
    base = F.exists(F.transform(g["atoms"], lambda a, i: (a["symbol"] == "N") & (F.size(neighbours(g, i)) <= 3)), lambda x: x)
    return F.struct(F.when(acid, F.lit(4.5)).alias("acid"), F.when(base, F.lit(9.5)).alias("base"))
