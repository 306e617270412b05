"""Language identification with string kernels.

Two texts are as alike as the n-grams that occur in both: the kernel is the number of shared n-grams of 1 to
3 signs (presence, not counts), divided by the geometric mean of both numbers. Nyström landmarks, some texts
of each language, span the space; a ridge regression for each language against the rest is solved over them.
Both fit on a bounded sample. Scoring a batch is two matrix products: n-gram presence by landmark presence,
which gives the kernel's rows, and these by the weights.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveline.llm import workers
from sieveline.session import Scratch, cut

#: Bounds of the sample that the classifier is fitted on: texts of each language and of all, and their length.
SAMPLE = 300
SAMPLE_ALL = 6000
SAMPLE_CHARS = 50_000
#: Landmarks of each language; of all, but for one of each language at least.
LANDMARKS = 32
LANDMARKS_ALL = 512
RIDGE = 1e-3
BATCH = 128
#: Bits of a slot: n-grams are found, and counted, by slots of a table.
SLOTS = 18
UNKNOWN = "und"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(x))[0] == "L" for x in range(0x110000)), dtype=bool, count=0x110000)


class StringKernel:
    """n-grams over an alphabet of any size: 0 is a gap between letters, 1 any letter that the alphabet lacks."""

    def __init__(self, alphabet: str):
        self.size = len(alphabet) + 2
        self.table = _letters().astype(np.int64)
        self.table[[ord(x) for x in alphabet]] = np.arange(2, self.size)
        self.mark, self.held = np.zeros(1 << SLOTS, dtype=bool), np.zeros(1 << SLOTS, dtype=np.int64)

    def grams(self, text: str) -> np.ndarray:
        """Numbers of the n-grams of a text, some repeated; none where it has no letter."""
        signs = self.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        if not signs.any():
            return np.zeros(0, dtype=np.int64)
        signs = np.concatenate([[0], signs, [0]])
        keep = signs != 0
        keep[0] = True
        keep[1:] |= signs[:-1] != 0
        a = signs[keep]
        n = self.size
        two = a[:-1] * n + a[1:]
        return np.concatenate([a, two + n, two[:-1] * n + a[2:] + n + n * n])

    def distinct(self, grams: np.ndarray, slots: np.ndarray) -> int:
        """How many differ: one for each slot that is taken, and those of which another one has the slot."""
        self.held[slots] = grams
        self.mark[slots] = True
        found = int(np.count_nonzero(self.mark))
        self.mark[slots] = False
        return found + len(np.unique(grams[self.held[slots] != grams]))


def _slots(grams: np.ndarray, turn: int = 0) -> np.ndarray:
    """The slot of each n-gram; each turn deals them out differently."""
    return ((grams.view(np.uint64) * _ODD[turn]) >> np.uint64(64 - SLOTS)).astype(np.int64)


class Features:
    """Columns of known n-grams, exactly: those that share a slot in one table go to the next."""

    def __init__(self, features: np.ndarray):
        self.features = np.append(features, -1)
        self.tables: list[np.ndarray] = []
        left = np.arange(len(features))
        while len(left):
            table = np.full(1 << SLOTS, len(features), dtype=np.int32)
            slots = _slots(features[left], len(self.tables) % len(_ODD))
            table[slots] = left
            self.tables.append(table)
            left = left[table[slots] != left]

    def columns(self, grams: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The columns of those n-grams that are features."""
        found = []
        for turn, table in enumerate(self.tables):
            at = table[slots if turn == 0 else _slots(grams, turn % len(_ODD))]
            known = self.features[at] == grams
            found.append(at[known])
            if turn + 1 < len(self.tables):  # what sits elsewhere met another n-gram here
                grams = grams[~known & (at < len(self.features) - 1)]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int32)


class Classifier:
    """One-versus-rest kernel ridge regression over Nyström landmarks."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        signs = {x for text in texts for x in set(text.lower()) if _letters()[ord(x)]}
        self.alphabet = "".join(sorted(signs))
        self.langs = sorted(set(langs))
        kernel = StringKernel(self.alphabet)
        grams = [kernel.grams(x) for x in texts]
        each = max(1, min(landmarks, LANDMARKS_ALL // max(1, len(self.langs))))
        chosen = [i for lang in self.langs for i in [i for i, x in enumerate(langs) if x == lang and len(grams[i])][:each]]
        found = np.unique(np.concatenate([grams[i] for i in chosen])) if chosen else np.zeros(0, dtype=np.int64)
        self.features = found
        self.presence = np.zeros((len(found), len(chosen)), dtype=np.float32)
        for j, i in enumerate(chosen):
            self.presence[np.searchsorted(found, np.unique(grams[i])), j] = 1
        self.norms = np.sqrt(np.maximum(1, self.presence.sum(axis=0)))
        self.weights = np.zeros((len(chosen), len(self.langs)), dtype=np.float32)
        if chosen:
            rows, _ = Scorer(self).kernel_rows(texts)
            k = rows.astype(np.float64)
            between = k[chosen]
            truth = np.array([[1.0 if x == lang else -1.0 for lang in self.langs] for x in langs])
            some = np.array([len(langs) / (len(self.langs) * langs.count(x)) for x in langs])  # each language weighs the same
            self.weights = np.linalg.solve((k.T * some) @ k + ridge * len(langs) * between + 1e-6 * np.eye(len(chosen)), (k.T * some) @ truth).astype(np.float32)


class Scorer:
    """A classifier with its tables unfolded, as a task holds it."""

    def __init__(self, model: Classifier):
        self.model, self.kernel, self.features = model, StringKernel(model.alphabet), Features(model.features)

    def kernel_rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The kernel of each text with each landmark, and whether the text has a letter."""
        model = self.model
        rows, lettered = np.zeros((len(texts), model.presence.shape[1]), dtype=np.float32), np.zeros(len(texts), dtype=bool)
        for begin in range(0, len(texts), BATCH):
            part = texts[begin : begin + BATCH]
            here = np.zeros((len(part), len(model.features)), dtype=np.float32)
            sizes = np.ones(len(part))
            for i, text in enumerate(part):
                grams = self.kernel.grams(text)
                if len(grams):
                    slots = _slots(grams)
                    here[i, self.features.columns(grams, slots)] = 1
                    sizes[i] = self.kernel.distinct(grams, slots)
                    lettered[begin + i] = True
            rows[begin : begin + BATCH] = (here @ model.presence) / model.norms / np.sqrt(sizes)[:, None]
        return rows, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score from 0 to 1 for each text."""
        rows, lettered = self.kernel_rows([x or "" for x in texts])
        if not self.model.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        values = rows @ self.model.weights
        best = values.argmax(axis=1)
        scores = np.where(lettered, np.clip((values[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1), 0.0)
        return [self.model.langs[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], scores


def held_out(key: Column) -> Column:
    """Whether crc32 of the key's text leaves 1 when divided by 3; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sampled(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """lang and text of the rows that fit() learns from: those of least hash of key and text in each language, each once.

    Rows that are held out, or have no language or a text that is empty or longer than SAMPLE_CHARS, are not drawn.
    Each language gives at most sample rows, and fewer where there are more than SAMPLE_ALL / sample languages, but
    one at least; beyond SAMPLE_ALL languages, those with most rows count. All of this is done in Spark.
    """
    known = docs.filter(~held_out(F.col(key)) & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.filter(F.length("text").between(1, SAMPLE_CHARS)).withColumn("order", F.xxhash64("key", "text"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("order").alias("n"))
    sizes = cut(sizes.orderBy(F.desc("n"), "lang").limit(SAMPLE_ALL), "languages")
    most = min(sample, max(1, SAMPLE_ALL // max(1, sizes.count())))
    # about three times as many as are needed go to the exact choice; a language with few rows sends all of them
    share = sizes.select("lang", F.least(F.lit(1.0), 3.0 * (most + 20) / F.col("n")).alias("share"))
    drawn = known.join(F.broadcast(share), "lang").filter(F.pmod("order", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    first = Window.partitionBy("lang").orderBy("order", "text")
    return drawn.select("lang", "order", "text").distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= most).select("lang", "order", "text")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Classifier:
    """A classifier from a bounded sample of the rows that are not held out and have a text and a language: see sampled.

    What comes to the driver is that sample, whatever keys repeat or are null. Without such rows it knows no language.
    """
    with Scratch(docs.sparkSession):
        kept = sorted(sampled(docs, key, text, lang, sample).collect(), key=lambda x: (x["lang"], x["order"], x["text"]))
    return Classifier([x["text"] for x in kept], [x["lang"] for x in kept])


_SCORERS: dict[str, Scorer] = {}


def _scorer(token: str, shared) -> Scorer:
    """The unfolded classifier, once in each worker."""
    if token not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[token] = Scorer(shared.value)
    return _SCORERS[token]


def predictions(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """docs with lang_pred and score added, in place of columns of these names.

    A null text, or one without a letter, is "und" with score 0; so is any where the model knows no language.
    Languages that tie are taken by name. Repeated rows and all other columns stay.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        workers.enter("language", _SCORERS.clear)
        scorer = _scorer(token, shared)
        for part in parts:
            langs, scores = scorer.predict(part.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})
        workers.release()

    predicted = predicted.asNondeterministic()  # else a filter on the result would run it a second time
    kept = [F.col(f"`{x}`") for x in docs.columns if x not in ("lang_pred", "score")]
    return docs.select(*kept, predicted(F.col(text)).alias("_found")).select(*kept, "_found.lang_pred", "_found.score")
