"""WARC archives with a two-level capture index.

Captures are dealt to tasks by ranges of their key: the URL with its host's labels reversed, so that a domain
and all beneath it lie side by side. A task writes its captures in key order as one archive, each record a gzip
member of its own, and beside it the index: lines of key, id, offset and length, in compressed blocks of LINES.
The sparse block directory has each block's first key, place and size. To look captures up, the archive whose
range holds a key is found by binary search over the archives' first keys, then its block by binary search over
the directory, and then the line in the block; only the block and the record are read, by their byte ranges.

A payload that was stored before is not stored again: of equal payloads one record is the response, and the
others are revisits that refer to it and keep its digest and the HTTP headers, which tell the payload's length.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers
from sieveline.session import Scratch, cut, shared_path, small

#: Smaller payloads are stored each time.
LEAST_BYTES = 1000
#: Index lines in a block.
LINES = 1000
#: Payloads with more than this part of all captures are joined apart from the others.
HOT = 0.001
#: Records that are at most this far apart count as read in order, and READ bytes at most are read ahead.
GAP, READ = 1 << 14, 4 << 20

_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """The reversed host, a closing bracket and the rest of the URL: http://www.Example.com:80/a?b is com,example,www)/a?b.

    Scheme, user and the default ports 80 and 443 go, the host is in lower case, an empty path is /. What has no
    scheme and host stays as it is behind a bracket; a null URL counts as an empty one.
    """
    whole = F.coalesce(url, F.lit(""))
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@:\[\]]+|\[[^/?#\]]*\])(:[0-9]*)?([/?#][\s\S]*)?$"
    host, port, rest = (F.regexp_extract(whole, parts, i) for i in (1, 2, 3))
    port = F.when(port.isin(":80", ":443", ":"), F.lit("")).otherwise(port)
    labels = F.when(host.startswith("["), F.lower(host)).otherwise(F.array_join(F.reverse(F.split(F.lower(host), r"\.", -1)), ","))
    return F.when(host == "", F.concat(F.lit(")"), whole)).otherwise(F.concat(labels, port, F.lit(")"), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def _record_id(id: int | None, url: str | None, digest: str) -> str:
    """The same for each try at writing a record, so that others can refer to it before it is written."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(json.dumps([id, url, digest]).encode()).hexdigest())}>"


def _line(name: str, value: str) -> bytes:
    """A header; line ends in it are percent-encoded."""
    return f"{name}: {value.replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n".encode()


def record(id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, revisit: bool, date: str) -> bytes:
    """A record as bytes, not yet compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = b"WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response") + _line("WARC-Record-ID", _record_id(id, url, digest)) + _line("WARC-Date", date)
    if url is not None:
        head += _line("WARC-Target-URI", url)
    head += _line("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}") + _line("Content-Type", "application/http; msgtype=response")
    if revisit:
        head += _line("WARC-Profile", _PROFILE) + _line("WARC-Refers-To", _record_id(refers_to, refers_url, digest)) + _line("Refers-To-Capture", str(refers_to))
        if refers_url is not None:
            head += _line("WARC-Refers-To-Target-URI", refers_url)
    if id is not None:
        head += _line("Capture", str(id))
    return head + b"Content-Length: %d\r\n\r\n" % len(block) + block + _END


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by their names in lower case, and the block."""
    head, _, rest = raw.partition(_END)
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    headers = {name.decode().lower(): value.strip(b" ").decode() for name, _, value in (x.partition(b":") for x in lines)}
    length = int(headers["content-length"])
    if len(rest) != length + len(_END) or not rest.endswith(_END):
        raise ValueError("a WARC record of another length than it says")
    return headers, rest[:length]


def capture(raw: bytes) -> dict:
    """What a record tells of its capture; payload is None for a revisit. A stored payload must have its digest."""
    headers, block = parse(raw)
    http, _, payload = block.partition(_END)
    told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(told[b"content-length"])):
        raise ValueError("a payload of another digest or length than its record says")
    refers = headers.get("refers-to-capture", "None")
    return {"url": headers.get("warc-target-uri"), "bytes": int(told[b"content-length"]), "digest": digest, "type": headers["warc-type"], "refers_to": None if refers == "None" else int(refers), "payload": None if revisit else payload}


def resolve_revisits(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """id, url, payload, bytes, digest, key, refers_to and refers_url (null for responses), revisit.

    Of equal payloads of at least least_bytes those with the largest id are responses, and the others are
    revisits of it; rows that share that id are all responses. Payloads without any id are responses.
    """
    text = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    # a second hash beside the digest: equal means equal
    rows = pages.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{url}`").alias("url"), text.alias("payload"), F.octet_length(text).cast("bigint").alias("bytes"), F.sha1(text.cast("binary")).alias("digest"), F.xxhash64(text).alias("hash"), url_key(F.col(f"`{url}`")).alias("key"))
    same = ["digest", "bytes", "hash"]
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "url")).alias("first"))
    groups = cut(groups.filter((F.col("n") > 1) & F.col("first.id").isNotNull()).select(*same, "n", F.col("first.id").alias("_id"), F.col("first.url").alias("_url")), "equal-payloads")
    if small(groups):
        joined = rows.join(F.broadcast(groups.drop("n")), same, "left")
    else:  # those of hot payloads, of which there are 1 / HOT at most, are sent to all; no other group is large
        total = groups.agg(F.sum("n")).first()[0]
        hot = F.col("n") > HOT * total
        parted = rows.join(F.broadcast(groups.filter(hot).drop("n")), same, "left")
        rest = parted.filter(F.col("_id").isNull()).select(*rows.columns).join(groups.filter(~hot).drop("n"), same, "left")
        joined = parted.filter(F.col("_id").isNotNull()).unionByName(rest)
    revisit = F.col("_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("_id"))
    return joined.select("id", "url", "payload", "bytes", "digest", "key", F.when(revisit, F.col("_id")).alias("refers_to"), F.when(revisit, F.col("_url")).alias("refers_url"), revisit.alias("revisit"))


ORDER = ("key", "id", "digest")


def _index_key(key: str, id: int | None, digest: str) -> tuple:
    """Order of captures, as Spark has it: keys by their bytes, a null id first."""
    return key.encode(), id is not None, id or 0, digest


def write_archives(pages: DataFrame, out: str, id: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z", lines: int = LINES) -> DataFrame:
    """Write archives and their index under out, a folder that all executors share; the manifest, one row an archive in key order.

    Manifest: part, file, index, directory (URIs), first (the first index key, packed), n (captures), bytes. Null
    payloads count as empty; repeated rows are stored each; an empty table writes nothing. Captures of one key
    are dealt by their ids and digests, so no key has to fit one task. pages has no date; date is put in all records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("warc")
        writer = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    writer = writer or _Writer(f"{out}/part-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}", lines)
                    raw = record(row["id"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"], row["refers_url"], row["revisit"], date)
                    writer.add([row["key"], row["id"], row["digest"]], raw)
        if writer:
            file, index, directory, first, n, size = writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [file], "index": [index], "directory": [directory], "first": [first], "n": [n], "bytes": [size]})
        workers.release()

    spark = pages.sparkSession
    with Scratch(spark) as held:
        found = resolve_revisits(pages, id, url, payload)
        placed = found.repartitionByRange(*(F.col(x) for x in ORDER)).sortWithinPartitions(*ORDER)
        return held.keep(cut(placed.mapInArrow(run, "part int, file string, index string, directory string, first string, n bigint, bytes bigint"), "warc-manifest"))


class _Writer:
    """One archive with its index blocks and their directory; files get their names when they are whole."""

    def __init__(self, base: str, lines: int):
        self.base, self.lines = base, lines
        self.files, path = pa.fs.FileSystem.from_uri(base)
        self.files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.path = path
        self.archive, self.index = (self.files.open_output_stream(f"{path}.{x}.part") for x in ("warc.gz", "cdx.gz"))
        self.at = self.index_at = self.n = 0
        self.waiting: list[list] = []
        self.blocks: list[list] = []

    def add(self, key: list, raw: bytes) -> None:
        packed = zlib.compress(raw, wbits=31)
        self.archive.write(packed)
        self.waiting.append([*key, self.at, len(packed)])
        self.at += len(packed)
        self.n += 1
        if len(self.waiting) == self.lines:
            self._block()

    def _block(self) -> None:
        packed = zlib.compress("".join(json.dumps(x) + "\n" for x in self.waiting).encode(), wbits=31)
        self.index.write(packed)
        self.blocks.append([self.waiting[0][:3], self.index_at, len(packed), len(self.waiting)])
        self.index_at += len(packed)
        self.waiting = []

    def close(self) -> tuple:
        if self.waiting:
            self._block()
        self.archive.close()
        self.index.close()
        with self.files.open_output_stream(f"{self.path}.dir.part") as out:
            out.write("".join(json.dumps(x) + "\n" for x in self.blocks).encode())
        names = ("warc.gz", "cdx.gz", "dir")
        for x in names:
            self.files.move(f"{self.path}.{x}.part", f"{self.path}.{x}")
        return *(f"{self.base}.{x}" for x in names), json.dumps(self.blocks[0][0]), self.n, self.at


class Archive:
    """One archive read through its index, by byte ranges."""

    def __init__(self, file: str, index: str, directory: str):
        files, path = pa.fs.FileSystem.from_uri(directory)
        with files.open_input_stream(path) as source:
            self.blocks = [json.loads(x) for x in source.read().splitlines()]
        self.firsts = [_index_key(*x[0]) for x in self.blocks]
        self.file, self.index = (files.open_input_file(pa.fs.FileSystem.from_uri(x)[1]) for x in (file, index))
        self.block_at, self.keys, self.lines = -1, [], []
        self.held, self.held_at, self.ahead = b"", 0, GAP

    def _block(self, i: int) -> None:
        if i != self.block_at:
            _, at, size, _ = self.blocks[i]
            self.lines = [json.loads(x) for x in zlib.decompress(self.index.read_at(size, at), wbits=31).splitlines()]
            self.keys, self.block_at = [_index_key(*x[:3]) for x in self.lines], i

    def find(self, low: tuple, high: tuple) -> Iterator[list]:
        """Index lines from low up to, but not with, high, in order: the block that low falls in, and as many more as it takes."""
        for i in range(max(0, bisect.bisect_right(self.firsts, low) - 1), len(self.blocks)):
            if self.firsts[i] >= high:
                return
            self._block(i)
            yield from self.lines[bisect.bisect_left(self.keys, low) : bisect.bisect_left(self.keys, high)]

    def read(self, at: int, size: int) -> bytes:
        """A record; where the one before was near, further ones of the block come with it, each time twice as much."""
        if not self.held_at <= at <= at + size <= self.held_at + len(self.held):
            near = 0 <= at - self.held_at - len(self.held) <= GAP
            self.ahead = min(2 * self.ahead, READ) if near else GAP
            more = max([size] + [x[3] + x[4] - at for x in self.lines if near and at <= x[3] and x[3] + x[4] - at <= self.ahead])
            self.held, self.held_at = self.file.read_at(more, at), at
        return zlib.decompress(self.held[at - self.held_at : at - self.held_at + size], wbits=31)


def look_up(manifest: DataFrame, wanted: DataFrame, prefix: bool = False, payloads: bool = False) -> DataFrame:
    """Captures of the keys wanted: key, id, url, bytes, digest, type, refers_to, and if asked for payload (binary, null for revisits).

    wanted has key (url_key) and, if only one capture of it is wanted, id and digest; prefix: all keys that begin with
    key, as com,example) for a host or com,example, for all beneath it. Each row of wanted gives its captures, repeated rows again; what is in no archive gives none. The
    archives' first keys, one for each archive, go to all tasks; wanted is dealt out by ranges of key, id and digest.
    """
    one = "id" in wanted.columns and not prefix
    archives = sorted((tuple(x) for x in manifest.select("part", "file", "index", "directory", "first").collect()), key=lambda x: x[0])
    shared = manifest.sparkSession.sparkContext.broadcast(archives)
    fields = ["key string", "id bigint", "url string", "bytes bigint", "digest string", "type string", "refers_to bigint"] + ["payload binary"] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("warc")
        archives = shared.value
        firsts = [_index_key(*json.loads(x[4])) for x in archives]
        open_: tuple[int, Archive] | None = None
        names = [x.split()[0] for x in fields]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        out: list[list] = [[] for _ in fields]
        size = 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns)):
                key = row[0].encode()
                low, high = (_index_key(*row), _index_key(*row[:2], row[2] + "\0")) if one else ((key,), (key + (b"\xff" if prefix else b"\0"),))
                for a in range(max(0, bisect.bisect_right(firsts, low) - 1), len(archives)):
                    if firsts[a] >= high:
                        break
                    if open_ is None or open_[0] != a:
                        open_ = a, Archive(*archives[a][1:4])
                    for line in open_[1].find(low, high):
                        found = capture(open_[1].read(line[3], line[4]))
                        values = [line[0], line[1], *(found[x] for x in ("url", "bytes", "digest", "type", "refers_to"))] + [found["payload"]] * payloads
                        for column, x in zip(out, values):
                            column.append(x)
                        size += 200 + len(found["payload"] or b"") * payloads
                        if size > READ:
                            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=names)
                            out, size = [[] for _ in fields], 0
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=names)
        workers.release()

    order = ORDER if one else ("key",)
    asked = wanted.select(*order)
    # as many tasks as archives: what a task reads are records, of which its keys' bytes tell nothing
    placed = asked.repartitionByRange(max(1, len(archives)), *(F.col(x) for x in order)).sortWithinPartitions(*order)
    return placed.mapInArrow(run, ", ".join(fields))


def archive_pages(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write pages as archives in the shared folder and return what looking each of them up in the index gives.

    id, payload_bytes, payload_digest, record_type and refers_to, one row a page. Repeated rows (same id, URL and
    payload) are stored each and looked up once, so that each is returned once too. Null URLs have the key ")",
    null ids come first within a key, and other columns are not read.
    """
    manifest = write_archives(pages, shared_path(pages.sparkSession, "warc"), id, url, payload)
    text = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    wanted = pages.select(url_key(F.col(f"`{url}`")).alias("key"), F.col(f"`{id}`").cast("bigint").alias("id"), F.sha1(text.cast("binary")).alias("digest")).distinct()
    found = look_up(manifest, wanted)
    return found.select(F.col("id").alias(id), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


ORACLE = f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS last FROM rows)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> last THEN last END AS refers_to
FROM sized"""
