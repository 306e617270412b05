"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Each line's hash carries a HyperLogLog sketch of its sites;
the sketches merge in Spark's aggregation, on the map side first, so that a line that is everywhere costs no
more than any other. Sketches far from the threshold decide; lines near it get exact distinct counts.
Boilerplate is then removed wherever it stands but for the first place it is found, so the text of copied
documents survives once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.session import Scratch, cut

MIN_SITES = 10
LG_K = 10
#: Within this part of the threshold an estimate doesn't decide; a sketch of 2^10 has a standard error of 3 %.
NEAR = 0.3


def _hash(line: Column) -> tuple[Column, Column]:
    """Two hashes, 96 bits together."""
    return F.xxhash64(line).alias("h1"), F.hash(line).alias("h2")


def _lines(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """key, body (the text's hash), site, at (from 0) and the hashes of each line that is not blank."""
    # beneath the lines, so that a text is hashed once and not for each of its lines
    whole = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("body"), F.coalesce(F.col(site), F.lit("")).alias("site"), F.col(text).alias("text"))
    split = whole.select("key", "body", "site", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return split.filter(F.length(F.trim("line")) > 0).select("key", "body", "site", "at", *_hash(F.col("line")))


def widespread_lines(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """h1, h2 and the first place (key, at, body) of each line that is found on at least min_sites sites."""
    lines = _lines(docs, key, text, site)
    first = F.min(F.struct("key", "at", "body")).alias("first")
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), first)
    guessed = sketched.withColumn("sites", F.hll_sketch_estimate("sketch")).drop("sketch").filter(F.col("sites") >= min_sites * (1 - NEAR))
    guessed = cut(guessed, "guessed-lines")  # read twice; all lines are sketched once
    sure = guessed.filter(F.col("sites") > min_sites * (1 + NEAR)).select("h1", "h2", "first")
    near = guessed.filter(F.col("sites") <= min_sites * (1 + NEAR))
    found = lines.select("h1", "h2", "site").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").distinct()
    exact = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites)
    return sure.unionByName(near.select("h1", "h2", "first").join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi"))


def remove_widespread_lines(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """docs with widespread lines taken out of text, and n_lines and n_removed_lines added.

    Lines end at line feeds; blank lines never count and stay. A line stays where it is found first, by key
    and then place. Rows that share a key, or have none, are told apart by their texts; only rows of one key
    and one text lose the same line numbers. A null text has no lines and stays null; a null site counts as one
    site of its own. Columns of docs named like the two that are added are replaced; all others stay, as do
    repeated rows. Work is linear in a text's lines, however many of them go.
    """
    with Scratch(docs.sparkSession) as held:
        spread = held.keep(cut(widespread_lines(docs, min_sites, key, text, site), "widespread-lines"))
    lines = _lines(docs, key, text, site).select("key", "body", "at", "h1", "h2")
    gone = lines.join(spread, ["h1", "h2"]).filter(~(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("body") == F.col("first.body")) & (F.col("at") == F.col("first.at"))))
    gone = gone.groupBy("key", "body").agg(F.collect_set("at").alias("_gone"))
    kept = [x for x in docs.columns if x not in ("n_lines", "n_removed_lines")]
    own = F.col(f"_d.{text}")
    with_gone = docs.select(*(F.col(f"`{x}`") for x in kept)).alias("_d").join(gone.alias("_g"), F.col(f"_d.{key}").eqNullSafe(F.col("_g.key")) & (F.xxhash64(f"_d.{text}") == F.col("_g.body")), "left")

    def left(x: Column) -> Column:
        """The lines at all places but those that go, by sets of places."""
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["l"]) - 1), x["g"]), lambda i: F.get(x["l"], i))

    # an array of one struct holds the lines while its lambda runs, so that a text is split once
    split = F.transform(F.array(F.struct(F.split(own, "\n", -1).alias("l"), F.col("_gone").alias("g"))), left)
    new = F.when(F.col("_gone").isNull(), own).otherwise(F.array_join(F.get(split, F.lit(0)), "\n"))
    n = F.coalesce(F.length(own) - F.length(F.replace(own, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint").alias("n_lines")
    return with_gone.select(*(new.alias(x) if x == text else F.col(f"_d.`{x}`") for x in kept), n, F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed_lines"))


ORACLE = f"""
WITH split AS (SELECT doc_id, coalesce(source, '') AS site, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, site, ls[i] AS line, i FROM (SELECT doc_id, site, ls, unnest(range(1, len(ls) + 1)) AS i FROM split) WHERE length(trim(ls[i], ' ')) > 0),
spread AS (SELECT line, min(struct_pack(d := doc_id, i := i)) AS first FROM lines GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
gone AS (SELECT l.doc_id, list(l.i) AS gone FROM lines l JOIN spread s ON l.line = s.line WHERE NOT (l.doc_id = s.first.d AND l.i = s.first.i) GROUP BY l.doc_id)
SELECT s.doc_id, CASE WHEN g.gone IS NULL THEN s.text ELSE coalesce(array_to_string([s.ls[i] FOR i IN range(1, len(s.ls) + 1) IF NOT list_contains(g.gone, i)], chr(10)), '') END AS text,
  coalesce(len(s.ls), 0) AS n_lines, coalesce(len(g.gone), 0) AS n_removed_lines
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id"""
