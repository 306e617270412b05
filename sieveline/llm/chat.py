"""Preference formatting: a chosen and a rejected conversation become one prompt and two masked completions.

The longest common prefix of turns (same role and same text) is rendered once as the prompt; what follows
in either conversation is rendered as its completion, with the spans that a loss may look at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv, and turns, an array of (turn, role, text) in order.

    A null role counts as "user", a null text as empty; a null turn comes first. Turns repeated with the
    same number, role and text count once; turns that share only a number stand in the order of role and
    text. Rows without a conversation are no part of any and go. An array is as long as its conversation.
    """
    one = F.struct(F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return conversations.filter(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv")).agg(F.array_sort(F.collect_set(one)).alias("turns"))


def random_negatives(turns: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) out of conversations alone: rejected ends in the next conversation's last reply.

    For a conversation c, chosen is c, and rejected is c up to its last reply, followed by the last reply of
    conversation c + 1; where either has no reply, rejected ends before it.
    """
    places = F.filter(F.transform("turns", lambda x, i: F.when(x["role"] == LEARNED, i)), lambda i: i.isNotNull())
    last = turns.select("conv", "turns", F.coalesce(F.array_max(places), F.size("turns")).alias("at"))
    reply = last.filter(F.col("at") < F.size("turns")).select((F.col("conv") - 1).alias("conv"), F.get("turns", F.col("at")).alias("reply"))
    kept = F.slice("turns", F.lit(1), F.col("at"))
    swapped = F.when(F.col("reply").isNotNull() & (F.col("at") < F.size("turns")), F.concat(kept, F.array("reply"))).otherwise(kept)
    return last.join(reply, "conv", "left").select(F.col("conv").alias("pair_id"), F.col("turns").alias("chosen"), swapped.alias("rejected"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE), turn["text"], F.lit(END))


def _body(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it or its lambdas run."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _ends(lengths: Column) -> Column:
    """The running totals of an array, by totals of blocks as long as the root of its length."""
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths))).cast("int"))

    def running(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(x["n"]), x["b"]), lambda i: _total(F.slice(x["n"], i + 1, x["b"])))
        return _let(
            F.struct(x["n"].alias("n"), x["b"].alias("b"), blocks.alias("blocks")),
            lambda y: F.transform(y["n"], lambda _, i: _total(F.slice(y["blocks"], F.lit(1), (i / y["b"]).cast("int"))) + _total(F.slice(y["n"], i - i % y["b"] + 1, i % y["b"] + 1))),
        )

    return _let(F.struct(lengths.alias("n"), block.alias("b")), running)


def _mask(turns: Column) -> Column:
    """start:end of what may be learned in the rendered turns, in code points: replies with their end marks."""

    def spans(x: Column) -> Column:
        end = lambda i: F.get(x["ends"], i)
        return F.transform(x["turns"], lambda t, i: F.when(t["role"] == LEARNED, F.concat_ws(":", (end(i) - F.length(t["text"]) - len(END)).cast("string"), end(i).cast("string"))))

    ends = _ends(F.transform(turns, lambda x: F.length(_rendered(x))))
    return F.array_join(F.filter(_let(F.struct(turns.alias("turns"), ends.alias("ends")), spans), lambda x: x.isNotNull()), ",")


def _common(chosen: Column, rejected: Column) -> Column:
    """How many turns both begin with."""

    def first(x: Column) -> Column:
        least = F.least(F.size(x["c"]), F.size(x["r"]))
        other = lambda i: F.get(x["r"], i)
        differ = F.transform(x["c"], lambda t, i: F.when((i >= least) | (t["role"] != other(i)["role"]) | (t["text"] != other(i)["text"]), i))
        return F.coalesce(F.array_min(F.filter(differ, lambda i: i.isNotNull())), least)

    return _let(F.struct(chosen.alias("c"), rejected.alias("r")), first)


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask from pair_id and two arrays of turns.

    Turns are equal when role and text are; their numbers don't matter. The common prefix may be empty, and
    then so is the prompt; where one conversation continues the other, or both are equal, the shorter one's
    completion is empty. A null array counts as an empty one. Repeated pairs stay. Masks are comma-joined
    start:end spans of replies in the completion; the prompt is never learned. Work grows with the turns of a
    conversation to the power of 1.5.
    """
    nothing = F.array().cast(dict(pairs.dtypes)["chosen"])
    both = pairs.select("pair_id", F.coalesce("chosen", nothing).alias("_c"), F.coalesce("rejected", nothing).alias("_r"))
    cut = both.withColumn("_n", _common(F.col("_c"), F.col("_r")))
    rest = cut.select("pair_id", "_n", F.slice("_c", F.lit(1), F.col("_n")).alias("_p"), *(F.slice(x, F.col("_n") + 1, F.size(x)).alias(x) for x in ("_c", "_r")))
    return rest.select("pair_id", F.col("_n").cast("bigint").alias("n_prompt_turns"), _body(F.col("_p")).alias("prompt"), _body(F.col("_c")).alias("chosen"), _body(F.col("_r")).alias("rejected"), _mask(F.col("_c")).alias("chosen_mask"), _mask(F.col("_r")).alias("rejected_mask"))


ORACLE = """
WITH turns AS (
  SELECT conv_id AS conv, list_sort(list(DISTINCT {'turn': turn, 'role': coalesce(role, 'user'), 'text': coalesce(text, '')})) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
last AS (
  SELECT conv, turns, coalesce(list_max([i - 1 FOR i IN range(1, len(turns) + 1) IF turns[i].role = 'assistant']), len(turns)) AS at FROM turns),
pairs AS (
  SELECT a.conv AS pair_id, a.turns AS c,
    CASE WHEN b.conv IS NOT NULL AND a.at < len(a.turns) THEN a.turns[1:a.at] || [b.turns[b.at + 1]] ELSE a.turns[1:a.at] END AS r
  FROM last a LEFT JOIN last b ON b.conv = a.conv + 1 AND b.at < len(b.turns)),
cuts AS (
  SELECT pair_id, c, r, coalesce(list_min([i - 1 FOR i IN range(1, least(len(c), len(r)) + 1)
    IF c[i].role <> r[i].role OR c[i].text <> r[i].text]), least(len(c), len(r))) AS n FROM pairs),
rest AS (SELECT pair_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM cuts),
bodies AS (
  SELECT pair_id, n, [('<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN p] AS pb,
    [('<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN c] AS cb,
    [('<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN r] AS rb, c, r FROM rest)
SELECT pair_id, n AS n_prompt_turns,
  coalesce(array_to_string(pb, ''), '') AS prompt, coalesce(array_to_string(cb, ''), '') AS chosen, coalesce(array_to_string(rb, ''), '') AS rejected,
  coalesce(array_to_string([(CAST(length(array_to_string(cb[1:i], '')) - length(c[i].text) - 8 AS VARCHAR) || ':' || CAST(length(array_to_string(cb[1:i], '')) AS VARCHAR))
    FOR i IN range(1, len(c) + 1) IF c[i].role = 'assistant'], ','), '') AS chosen_mask,
  coalesce(array_to_string([(CAST(length(array_to_string(rb[1:i], '')) - length(r[i].text) - 8 AS VARCHAR) || ':' || CAST(length(array_to_string(rb[1:i], '')) AS VARCHAR))
    FOR i IN range(1, len(r) + 1) IF r[i].role = 'assistant'], ','), '') AS rejected_mask
FROM bodies"""
