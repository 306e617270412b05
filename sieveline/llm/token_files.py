"""Token files: Arrow streams of equal-length sequences and masks, read without copying.

A file is an Arrow IPC stream of uncompressed record batches with two fixed-size-list columns, ``ids`` (the
smallest unsigned type that holds the vocabulary) and ``mask`` (bits; 0 pads the last sequence). All batches
but the last have the same number of sequences, so sequence i is row i % BATCH of batch i // BATCH, and a
memory-mapped file hands out views. Documents follow each other without gaps in ascending key order over
the files in order; beside each file, ``*.docs.arrows`` has each document's key, first token and length.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sieveline.llm import workers
from sieveline.llm.bpe import _ranges, in_parts
from sieveline.session import cut, shared_path

LENGTH = 2048
BATCH = 64
CACHE_MOST = 1 << 20
CHARS_AT_ONCE = 1 << 21


class CachedTokenizer:
    """Whole texts by a tokenizers file; stretches without blanks, which no token crosses, are encoded once.

    What is not cached goes to the library in one call a batch, with a special token between the stretches.
    Where the file lower-cases, splits words from other signs and maps bytes to signs, a Latin word with at
    most one mark after it needs none of these steps again, and goes straight to the merges.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = [x for x in told["added_tokens"] if x["special"] and x["content"].startswith("<|")]
        self.mark_id, self.mark = (special[-1]["id"], special[-1]["content"]) if special else (None, None)
        steps = [x["type"] for part in ("normalizer", "pre_tokenizer") for x in ((told[part] or {}).get("normalizers") or (told[part] or {}).get("pretokenizers") or [])]
        self.bare = None
        if self.mark and steps == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            self.bare = Tokenizer.from_str(json.dumps(told | {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))
            suffix = told["model"].get("end_of_word_suffix") or None
            self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # tokens that end a word
            self.last[[i for x, i in told["model"]["vocab"].items() if suffix and x.endswith(suffix)]] = True
        signs = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves; the others follow U+0100
        self.signs = dict(zip([*signs, *(x for x in range(256) if x not in signs)], [*map(chr, signs), *map(chr, range(0x100, 0x100 + 256 - len(signs)))]))
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.counts, self.uses, self.flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def thin(self) -> None:
        """Keep the more used half of what is cached."""
        order = np.argsort(-self.uses, kind="stable")[: CACHE_MOST // 2]
        keep = np.zeros(len(self.counts), dtype=bool)
        keep[order] = True
        self.seen = {x: k for k, x in enumerate(x for x, kept in zip(self.seen, keep.tolist()) if kept)}
        begins = np.cumsum(self.counts) - self.counts
        self.flat = self.flat[_ranges(begins[keep], self.counts[keep])]
        self.counts, self.uses = self.counts[keep], self.uses[keep] // 2

    def _marked(self, tokenizer, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each stretch has, and all ids."""
        if not stretches or self.mark is None or any("<|" in x for x in stretches):
            each = [x.ids for x in tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]
            return np.fromiter(map(len, each), dtype=np.int64, count=len(each)), np.array([x for ids in each for x in ids], dtype=np.uint32)
        ids = np.array(tokenizer.encode_batch_fast([self.mark.join(["", *stretches])], add_special_tokens=False)[0].ids, dtype=np.uint32)
        marks = np.flatnonzero(ids == self.mark_id)
        return np.diff(np.append(marks, len(ids))) - 1, np.delete(ids, marks)

    def _bare(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, told apart by the tokens that end a word."""
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        ends = np.flatnonzero(self.last[ids])
        if len(ends) == len(words):
            return np.diff(ends, prepend=-1), ids
        each = [x.ids for x in self.bare.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(map(len, each), dtype=np.int64, count=len(each)), np.array([x for ids in each for x in ids], dtype=np.uint32)

    def _learn(self, stretches: list[str]) -> None:
        """Encode stretches that are not cached, and keep their ids."""
        known = len(self.seen)
        self.seen.update(zip(stretches, range(known, known + len(stretches))))
        words: dict[str, int] = {}
        where, ends, hard = [], [], []
        for n, stretch in enumerate(stretches):
            word, sign = (stretch[:-1], stretch[-1]) if stretch[-1:] in (",", ".") else (stretch, "")
            if self.bare is not None and word.isalpha() and word.islower() and (word.isascii() or max(word) < "\u0250"):
                where.append(words.setdefault(word, len(words)))
                ends.append(sign)
            else:
                where.append(-1)
                ends.append("")
                hard.append(stretch)
        mapped = [x if x.isascii() else x.encode().decode("latin-1").translate(self.signs) for x in words]
        counts, flat = self._bare(mapped) if words else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32))
        more, rest = self._marked(self.tokenizer, [*hard, ",", "."])  # a mark alone gives the ids that it adds to a word
        counts, flat = np.append(counts, more), np.append(flat, rest)
        begins = np.cumsum(counts) - counts
        where = np.array(where, dtype=np.int64)
        where[where < 0] = len(words) + np.arange(len(hard))
        sign = np.array([(",", ".").index(x) if x else -1 for x in ends])
        at = len(words) + len(hard)
        parts = np.stack([where, np.where(sign >= 0, at + sign, where)], axis=1)
        lengths = counts[parts]
        lengths[sign < 0, 1] = 0
        self.flat = np.append(self.flat, flat[_ranges(begins[parts].reshape(-1), lengths.reshape(-1))])
        self.counts = np.append(self.counts, lengths.sum(axis=1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end."""
        if len(self.seen) > CACHE_MOST:
            self.thin()
        stretches: list[str] = []
        ends = []
        for text in texts:
            stretches += _lowered(text).replace("\n", " ").split(" ")
            ends.append(len(stretches))
        which = np.fromiter(map(self.seen.get, stretches, repeat(-1)), dtype=np.int64, count=len(stretches))
        if len(missing := np.flatnonzero(which < 0)):
            names = [stretches[i] for i in missing.tolist()]
            self._learn([*dict.fromkeys(names)])
            which[missing] = np.fromiter(map(self.seen.__getitem__, names), dtype=np.int64, count=len(names))
        used = np.bincount(which, minlength=len(self.counts))
        used[: len(self.uses)] += self.uses
        self.uses = used
        lengths = self.counts[which]
        ids = self.flat[_ranges((np.cumsum(self.counts) - self.counts)[which], lengths)]
        return ids, np.cumsum(lengths)[np.array(ends, dtype=np.int64) - 1] if ends else np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=2)
def load(path: str) -> CachedTokenizer:
    return CachedTokenizer(path)


def _lowered(text: str) -> str:
    """text in lower case where the library, which composes first and then lower-cases, gives the same ids for both; else text.

    A final sigma or a special token needs the text as it is; so do marks that compose with a letter of one case
    and not of the other.
    """
    if "<|" in text or "Σ" in text:
        return text
    low = text.lower()
    return low if text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", low)) else text


def sequence_schema(dtype: type, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Packs runs of ids into sequences of one length; the file appears under its name when it is whole."""

    def __init__(self, uri: str, dtype: type, length: int, batch: int):
        self.files, self.path = pa.fs.FileSystem.from_uri(uri)
        self.dtype, self.length, self.batch = dtype, length, batch
        self.part = f"{self.path}.part"
        self.out = self.files.open_output_stream(self.part)
        self.writer = pa.ipc.new_stream(self.out, sequence_schema(dtype, length))
        self.waiting: list[np.ndarray] = []
        self.held = self.written = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.written += len(ids)
        if self.held >= (most := self.length * self.batch):
            held = np.concatenate(self.waiting)
            whole = len(held) // most * most
            for at in range(0, whole, most):
                self._write(held[at : at + most], most)
            self.waiting, self.held = [held[whole:]], len(held) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=sequence_schema(self.dtype, self.length)))

    def close(self) -> None:
        if self.held:
            held = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(held) // self.length) * self.length, dtype=self.dtype)
            padded[: len(held)] = held
            self._write(padded, len(held))
        self.writer.close()
        self.out.close()
        self.files.move(self.part, self.path)


class SequenceFile:
    """Random access to the sequences of a file; the arrays are views of the mapped file where it is local."""

    def __init__(self, uri: str):
        files, path = pa.fs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)
        with pa.ipc.open_stream(source) as stream:
            self.batches = list(stream)
        self.batch = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(x.num_rows for x in self.batches)

    def ids(self, i: int) -> np.ndarray:
        lists = self.batches[i // self.batch].column(0)
        n = lists.type.list_size
        return lists.values.to_numpy(zero_copy_only=True)[(i % self.batch) * n : (i % self.batch + 1) * n]

    def mask(self, i: int) -> pa.Array:
        lists = self.batches[i // self.batch].column(1)
        n = lists.type.list_size
        return lists.values.slice((i % self.batch) * n, n)

    def runs(self) -> Iterator[np.ndarray]:
        """The real ids of each batch in order."""
        for batch in self.batches:
            ids = batch.column(0).values.to_numpy(zero_copy_only=True)
            yield ids[: batch.column(1).values.true_count]


def write_token_files(docs: DataFrame, path: str, out: str, key: str = "doc_id", text: str = "text", end_id: int = 1, length: int = LENGTH, batch: int = BATCH) -> DataFrame:
    """Encode every text, write the files under out, and return their manifest, one row a file.

    Manifest: part (place in key order), file, index (its documents), n_docs, n_tokens. A null text counts as
    empty; each document ends with end_id, so an empty one has one token. Rows with a null key come first;
    repeated keys and repeated rows stay, in the order of their texts. Columns other than key and text are not
    read. An empty table writes no file. out must be a folder that driver and executors share.
    """
    kind = docs.schema[key].dataType
    index_type = pa.int64() if kind in (T.LongType(), T.IntegerType(), T.ShortType()) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("token-files", load.cache_clear)
        tokenizer, writer = load(path), None
        keys, begins, counts = [], [], []
        for rows in batches:
            for part in in_parts((x or "" for x in workers.texts(rows.column(1))), CHARS_AT_ONCE):
                if writer is None:
                    place = TaskContext.get().partitionId()
                    name = f"{out}/part-{place:06d}-{TaskContext.get().taskAttemptId()}"
                    pa.fs.FileSystem.from_uri(out)[0].create_dir(pa.fs.FileSystem.from_uri(out)[1], recursive=True)
                    writer = SequenceWriter(f"{name}.arrows", tokenizer.dtype, length, batch)
                ids, ends = tokenizer.encode(part)
                ends_after = ends + np.arange(1, len(part) + 1)
                begin = writer.written + np.append(0, ends_after[:-1])
                writer.add(np.insert(ids, ends, end_id))
                begins.append(begin)
                counts.append(np.diff(ends_after, prepend=0))
            keys += rows.column(0).to_pylist()
        if writer is not None:
            writer.close()
            table = pa.table({key: pa.array(keys, index_type), "begin": np.concatenate(begins), "n_tokens": np.concatenate(counts)})
            files, where = pa.fs.FileSystem.from_uri(f"{name}.docs.arrows")
            with files.open_output_stream(f"{where}.part") as sink, pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            files.move(f"{where}.part", where)
            yield pa.RecordBatch.from_pydict({"part": pa.array([place], pa.int32()), "file": [f"{name}.arrows"], "index": [f"{name}.docs.arrows"], "n_docs": [len(keys)], "n_tokens": [writer.written]})
        workers.release()

    if not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.StringType)):
        raise TypeError(f"{key} must be an integer or a string, not {kind.simpleString()}")
    rows = docs.select(F.col(key), F.col(text))
    # a part of the text's hash keeps rows that share one key, or none, from meeting in one task
    placed = rows.repartitionByRange(F.col(key).asc_nulls_first(), F.xxhash64(text)).sortWithinPartitions(F.col(key).asc_nulls_first(), F.xxhash64(text), text)
    return cut(placed.mapInArrow(run, "part int, file string, index string, n_docs long, n_tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id", key_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """One row per document from the files: key, start (ids of all documents before it), n_tokens, ids_crc32.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers; with_ids adds these bytes as ids.
    """
    fields = [(key, key_type), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")] + [("ids", "binary")] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file, index, first in zip(*(rows.column(i).to_pylist() for i in range(3))):
                files, where = pa.fs.FileSystem.from_uri(index)
                with files.open_input_stream(where) as source, pa.ipc.open_stream(source) as stream:
                    table = stream.read_all()
                begins, counts = table.column("begin").to_numpy(), table.column("n_tokens").to_numpy()
                runs, held = SequenceFile(file).runs(), np.zeros(0, dtype=np.uint32)
                crcs, kept = [], []
                for count in counts.tolist():
                    more = [held]
                    have = len(held)
                    while have < count:
                        more.append(next(runs))
                        have += len(more[-1])
                    held = np.concatenate(more) if len(more) > 1 else held
                    raw = held[:count].astype("<u4").tobytes()
                    held = held[count:]
                    crcs.append(zlib.crc32(raw))
                    if with_ids:
                        kept.append(raw)
                columns = [table.column(key).combine_chunks(), pa.array(begins + first), pa.array(counts), pa.array(crcs, pa.int64())] + [pa.array(kept, pa.binary())] * with_ids
                for at in range(0, len(counts), 4096):
                    yield pa.RecordBatch.from_arrays([x.slice(at, 4096) for x in columns], names=[x for x, _ in fields])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    ordered = manifest.select("file", "index", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    return ordered.repartition(max(1, manifest.count())).mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in fields))


def token_output(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Write documents as token files in the shared folder and return what reading them gives."""
    manifest = write_token_files(docs, path, shared_path(docs.sparkSession, "token-files"), key, text, end_id, length)
    kind = docs.schema[key].dataType
    return read_token_files(manifest, key, "string" if isinstance(kind, T.StringType) else "bigint")
