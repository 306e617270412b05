"""Free-text endpoint names to a fixed list: guard, exact names, whole-token stretches, likeness.

Names are few against rows, so matching runs over distinct names, and rows get theirs by a join. Synonyms and
endpoints are constants of the plan, of a size that is fixed when it is made.
"""

from __future__ import annotations

import importlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.schema import API_SYNONYMS, CLI_SYNONYMS, ENDPOINTS
from sieveline.session import Scratch, cut, few, file_system

MIN_LIKENESS = 0.55
#: Isoforms that have endpoints of their own, and tokens that name none.
ISOFORMS = ("1A2", "2B6", "2C9", "2C19", "2D6", "3A4")
UNMAPPABLE = ("cytotoxicity", "genetoxicity")


def normal_name(text: Column) -> Column:
    """Lower case, letters and digits, single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, "μµ", "uu")), "[^a-z0-9]+", " "))


def _normal(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.translate({0x3BC: "u", 0xB5: "u"}).lower()).strip()


def synonym_list(dialect: str = "api", own: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """Normal names and their endpoints in order; later entries replace earlier ones in their place."""
    found: dict[str, str] = {}
    for name, endpoint in ({"cli": CLI_SYNONYMS, "api": API_SYNONYMS}[dialect] | (own or {})).items():
        if _normal(name):
            found[_normal(name)] = endpoint
    return list(found.items())


def cyp_endpoint(text: Column) -> Column:
    """CYP endpoints by isoform and role; the text itself for other isoforms; null where no isoform is named."""
    isoform = F.upper(F.regexp_extract(normal_name(text), r"cyp(\d+[a-z]\d*)", 1))
    role = F.when(F.contains(normal_name(text), F.lit("substrate")), F.lit("Substrate")).otherwise(F.lit("Inhibitor"))
    return F.when(isoform.isin(*ISOFORMS), F.concat(F.lit("CYP"), isoform, F.lit("_"), role)).when(isoform != "", text)


def bigrams(name: Column) -> Column:
    packed = F.replace(name, F.lit(" "), F.lit(""))
    return F.when(F.length(packed) >= 2, F.transform(F.sequence(F.lit(1), F.length(packed) - 1), lambda i: F.substring(packed, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    """The larger of Dice over letter pairs and Jaccard over tokens, and 0.1 more where the first tokens agree.

    Shared pairs are counted once each, their numbers in the denominator as often as they occur.
    """
    return _likeness(bigrams(a), bigrams(b), F.split(a, " "), F.split(b, " "))


def _likeness(pairs_a: Column, pairs_b: Column, tokens_a: Column, tokens_b: Column) -> Column:
    total = F.size(pairs_a) + F.size(pairs_b)
    dice = F.when(total > 0, 2.0 * F.size(F.array_intersect(pairs_a, pairs_b)) / F.when(total > 0, total)).otherwise(0.0)
    union = F.size(F.array_union(tokens_a, tokens_b))
    jaccard = F.size(F.array_intersect(tokens_a, tokens_b)) / F.when(union > 0, union)
    return F.greatest(dice, jaccard) + F.when(F.get(tokens_a, F.lit(0)) == F.get(tokens_b, F.lit(0)), 0.1).otherwise(0.0)


def best_stretch(names: DataFrame, name: str, synonyms: list[tuple[str, str]], out: str = "stretch") -> DataFrame:
    """names with the endpoint of the synonym that stands in a name as whole tokens: most tokens, then latest, then first listed."""
    if not synonyms:
        return names.withColumn(out, F.lit(None).cast("string"))
    listed = names.sparkSession.createDataFrame([(s, e, i) for i, (s, e) in enumerate(synonyms)], "_run string, endpoint string, place int")
    sizes = sorted({len(s.split()) for s, _ in synonyms})
    own = names.select(name).distinct().withColumn("_tokens", F.split(name, " "))
    # runs of a name of as many tokens as some synonym has meet the synonyms by equality
    run = lambda n: F.transform(F.sequence(F.lit(1), F.size("_tokens") - (n - 1)), lambda i: F.struct(F.array_join(F.slice("_tokens", i, n), " ").alias("run"), i.alias("at"), F.lit(n).alias("tokens")))
    runs = own.select(name, F.explode(F.concat(*(F.when(F.size("_tokens") >= n, run(n)).otherwise(F.array().cast("array<struct<run:string,at:int,tokens:int>>")) for n in sizes))).alias("_r"))
    first = runs.groupBy(name, F.col("_r.run").alias("_run"), F.col("_r.tokens").alias("tokens")).agg(F.min("_r.at").alias("begin"))
    best = first.join(few(listed), "_run").groupBy(name).agg(F.max_by("endpoint", F.struct("tokens", "begin", (-F.col("place")).alias("first"))).alias(out))
    return names.join(best, name, "left")


def _listed(labels: list[str]) -> Column:
    """The labels with their places, letter pairs and tokens, as a constant of the plan."""
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def one(place: int, label: str) -> str:
        packed = _normal(label).replace(" ", "")
        pairs = " ".join(packed[k : k + 2] for k in range(len(packed) - 1))
        told = f"split('{pairs}', ' ')" if pairs else "cast(array() AS array<string>)"
        return f"named_struct('first', {-place}, 'label', {quoted(label)}, 'pairs', {told}, 'tokens', split('{_normal(label)}', ' '))"

    return F.expr(f"array({', '.join(one(i, x) for i, x in enumerate(labels))})")


def most_alike(names: DataFrame, name: str, labels: list[str], out: str = "alike", score: str = "score") -> DataFrame:
    """names with the label most like each, the first listed of equals, and its score; null for a null name, or without labels.

    A name meets the labels, which are constants of the plan, within its row: neither a join nor a shuffle pairs them.
    """
    if not labels:
        return names.withColumns({out: F.lit(None).cast("string"), score: F.lit(None).cast("double")})
    # pairs and tokens of a distinct name are worked out once
    own = names.select(name).distinct().select(name, bigrams(F.col(name)).alias("_pairs"), F.split(name, " ").alias("_tokens")).filter(F.col(name).isNotNull())
    tried = F.transform(_listed(labels), lambda x: F.struct(_likeness(F.col("_pairs"), x["pairs"], F.col("_tokens"), x["tokens"]).alias("s"), x["first"].alias("first"), x["label"].alias("label")))
    best = own.select(name, F.array_max(tried).alias("best"))
    return names.join(best.select(name, F.col("best.label").alias(out), F.col("best.s").alias(score)), name, "left")


def match_endpoints(df: DataFrame, column: str, dialect: str = "api", own: dict[str, str] | None = None, min_likeness: float = MIN_LIKENESS, endpoints: tuple[str, ...] = ENDPOINTS) -> DataFrame:
    """Each distinct name of a column and its endpoint, itself where it has none: (column, endpoint).

    In order: CYP isoforms; exact names; unmappable tokens; synonyms as whole-token stretches; likeness. Each step
    is asked about the names that the steps before it left open; distinct names are written in between.
    """
    synonyms = synonym_list(dialect, own)
    names = df.select(F.col(column)).filter(F.col(column).isNotNull()).distinct().withColumn("_n", normal_name(F.col(column)))
    exact = names.sparkSession.createDataFrame(synonyms, "_n string, exact string")
    own_text = F.col(column)
    unmappable = F.arrays_overlap(F.split("_n", " "), F.array(*map(F.lit, UNMAPPABLE)))
    named = names.join(F.broadcast(exact), "_n", "left").select(own_text, "_n", F.coalesce(cyp_endpoint(own_text), F.col("exact"), F.when(unmappable, own_text)).alias("endpoint"))
    with Scratch(df.sparkSession) as held:
        named = held.keep(cut(named, "endpoint-names"))
        stretched = cut(best_stretch(named.filter("endpoint IS NULL").drop("endpoint"), "_n", synonyms), "endpoint-stretches")
        alike = most_alike(stretched.filter("stretch IS NULL").drop("stretch"), "_n", list(endpoints))
        alike = alike.select(own_text, F.coalesce(F.when(F.col("score") >= min_likeness, F.col("alike")), own_text).alias("endpoint"))
        rest = stretched.filter("stretch IS NOT NULL").select(own_text, F.col("stretch").alias("endpoint")).unionByName(alike)
        rest = held.keep(cut(rest, "endpoint-rest"))
    return named.filter("endpoint IS NOT NULL").select(column, "endpoint").unionByName(rest)


def map_endpoints(df: DataFrame, column: str, mapping: DataFrame, out: str = "endpoint") -> DataFrame:
    """df with the endpoint of each name by a left join; the name where the mapping lacks it."""
    return df.join(mapping.select(F.col(column), F.col("endpoint").alias("_e")), column, "left").withColumn(out, F.coalesce("_e", column)).drop("_e")


def map_by_callable(df: DataFrame, column: str, ask, most: int = 10_000) -> DataFrame:
    """The same mapping from a callable that maps a list of distinct names, as an outside service does; names are bounded by most."""
    names = [x[0] for x in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} distinct names in {column}")
    found = ask(sorted(names))
    return df.sparkSession.createDataFrame([(x, found.get(x) or x) for x in sorted(names)], f"`{column}` string, endpoint string")


def map_by_service(df: DataFrame, column: str, ask: Callable[[list[str]], dict[str, str]], store: str, at_once: int = 50, tries: int = 4, wait: float = 1.0, callers: int = 8) -> DataFrame:
    """The same mapping from a service, for any number of names: (column, endpoint).

    ask takes at most at_once names and returns what it knows of them; it runs in the tasks, of which there are as many as callers
    (so no more calls are open at a time), and is tried again after an error, each time after twice the wait. Answers are kept in the
    folder store, a part for each call of this function; only names that it lacks are asked, so a run that failed asks the next time
    what is still open. A service that fails each time leaves its names open, and the mapping gives them themselves; so are names
    that it doesn't answer, but these are not asked again. store must be a folder that driver and executors share.
    """
    spark = df.sparkSession
    schema = "name string, endpoint string"
    names = df.select(F.col(column).alias("name")).filter(F.col(column).isNotNull()).distinct()
    where, files = file_system(spark, store)
    known = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(store) if files.exists(where) else None
    open_ = names.join(known, "name", "left_anti") if known is not None else names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for at in range(0, len(held), at_once):
                some = held[at : at + at_once]
                for k in range(tries):
                    try:
                        told = ask(some)
                    except Exception:  # whatever a service raises, the names stay open
                        if k + 1 < tries:
                            time.sleep(wait * 2**k)
                        continue
                    yield pa.RecordBatch.from_pydict({"name": pa.array(some, pa.string()), "endpoint": pa.array([told.get(x) or x for x in some], pa.string())})
                    break

    # what has been answered is written once: a task that runs again asks again, and the last answer counts
    open_.repartition(callers, "name").mapInArrow(run, schema).write.parquet(f"{store.rstrip('/')}/{uuid.uuid4().hex[:12]}")
    answers = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(store).groupBy("name").agg(F.min("endpoint").alias("endpoint"))
    return names.join(answers, "name", "left").select(F.col("name").alias(column), F.coalesce("endpoint", "name").alias("endpoint"))


def named_service(where: str) -> Callable[[list[str]], dict[str, str]]:
    """The service package.module:function, as map_by_service takes it; tasks import it themselves, so they must find the module.

    The function takes a list of names, and returns what it knows of them, or a reply as read_reply takes it. A
    function that isn't there is an error at once.
    """
    module, _, name = where.partition(":")
    if not module or not name or not callable(getattr(importlib.import_module(module), name, None)):
        raise ValueError(f"no function {where}: a service is named package.module:function")

    def ask(names: list[str]) -> dict[str, str]:
        told = getattr(importlib.import_module(module), name)(names)
        return read_reply(told, names) if isinstance(told, str) else told

    return ask


def prompt_for(names: list[str], endpoints: tuple[str, ...] = ENDPOINTS) -> str:
    """What an outside language service is asked, for map_by_callable."""
    return f"Map each name to the one endpoint of the list that it measures, or to itself. Answer with one JSON object and nothing else.\nEndpoints: {', '.join(endpoints)}\nNames: {json.dumps(names, ensure_ascii=False)}"


def read_reply(reply: str, names: list[str]) -> dict[str, str]:
    """The JSON object of a reply, in or out of a fenced block; each name itself where there is none."""
    fenced = re.search(r"```(?:json)?\s*(.*?)```", reply, re.DOTALL)
    try:
        found = json.loads(fenced[1] if fenced else reply)
    except ValueError:
        found = {}
    found = found if isinstance(found, dict) else {}
    return {x: found[x] if isinstance(found.get(x), str) else x for x in names}
