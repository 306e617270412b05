"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds at-signs, plus signs, digits, address schemes and identifier cues.
A small parser for each kind starts at such an anchor, expands to both sides by fixed rules, and validates.
Each of them is linear in the text. What is found is spans; the text stays as it is unless it is redacted.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import workers

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
DIALLED = frozenset(string.digits + " ().-")
SCHEME = frozenset(string.ascii_letters)
ADDRESS = frozenset(chr(x) for x in range(0x21, 0x7F)) - set("\"'<>`{}|\\^")
IDENTIFIER = frozenset(string.ascii_letters + string.digits + "-")
#: Words before which an account or identity number stands.
CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "tax id", "routing", "customer id", "user id", "member id")

Span = tuple[int, int, int]


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(word, (kind, len(word)))
    for cue in CUES:
        for word in {cue, cue.upper(), cue.title(), cue.capitalize()}:
            found.add_word(word, ("cue", len(word)))
    found.make_automaton()
    return found


def _run(text: str, at: int, of: frozenset) -> int:
    """Where the run of characters that starts at at ends."""
    n = len(text)
    while at < n and text[at] in of:
        at += 1
    return at


def email(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around the at-sign; it starts at least at least."""
    start = at
    while start > least and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dotted = False
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, LABEL)) > end + 1:
        end, dotted = more, True
    return (start, end) if dotted else None


def ip(text: str, at: int) -> tuple[int, bool] | None:
    """Where four dotted numbers that start at at end, and whether each is at most 255."""
    end = _run(text, at, DIGITS)
    for _ in range(3):
        if end >= len(text) or text[end] != "." or (more := _run(text, end + 1, DIGITS)) == end + 1:
            return None
        end = more
    parts = [x.lstrip("0") for x in text[at:end].split(".")]
    return end, all(len(x) < 4 and int(x or 0) <= 255 for x in parts)


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def card(text: str, at: int) -> tuple[int, bool]:
    """Where digits with at most one blank or dash between two of them end, and whether they are a card number."""
    n, end = len(text), at + 1
    digits = [text[at]]
    while True:
        k = end + 1 if end < n and text[end] in " -" else end
        if k >= n or text[k] not in DIGITS:
            break
        digits.append(text[k])
        end = k + 1
    return end, 13 <= len(digits) <= 19 and luhn("".join(digits))


def phone(text: str, at: int) -> tuple[int, bool] | None:
    """Where the number after the plus sign at at ends, and whether it has 9 to 15 digits."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, DIALLED)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in DIGITS:
        return None
    return end, 9 <= sum(x in DIGITS for x in text[at:end]) <= 15


def url(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around "://" at at: a scheme of letters, then a host with a dot; closing marks stay out."""
    start = at
    while start > least and text[start - 1] in SCHEME and at - start < 12:
        start -= 1
    end = _run(text, at + 3, ADDRESS)
    while end > at + 3 and text[end - 1] in ".,;:!?)]*_~":
        end -= 1
    host = text[at + 3 : end].split("/")[0]
    return (start, end) if start < at and "." in host.strip(".") else None


def account(text: str, after: int) -> tuple[int, int] | None:
    """The number after a cue that ends at after: past at most 16 blanks, marks and filling words, with 5 digits at least."""
    at, n = after, len(text)
    for _ in range(3):
        at = min(_skip(text, at, " :#.=\t"), n)
        for word in ("number", "no", "nr", "is"):
            if text[at : at + len(word)].lower() == word and (at + len(word) == n or text[at + len(word)] not in IDENTIFIER):
                at += len(word)
    if at == after or at - after > 16:
        return None
    end = _run(text, at, IDENTIFIER)
    while end < n - 1 and text[end] == " " and text[end + 1] in DIGITS and text[end - 1] in DIGITS:  # groups, as of an IBAN
        end = _run(text, end + 1, IDENTIFIER)
    while end > at and text[end - 1] == "-":
        end -= 1
    digits = sum(x in DIGITS for x in text[at:end])
    return (at, end) if 5 <= digits and end - at <= 42 else None


def _skip(text: str, at: int, over: str) -> int:
    while at < len(text) and text[at] in over:
        at += 1
    return at


def find(text: str | None) -> list[Span]:
    """(place in KINDS, start, end) of all spans, sorted; ends are exclusive, in code points."""
    spans: list[Span] = []
    if not text:
        return spans
    done = [0] * len(KINDS)
    run_end = 0
    for last, (kind, length) in _anchors().iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at < run_end:
                continue
            run_end = _run(text, at, DIGITS)
            if at >= done[1] and run_end < len(text) and text[run_end] == "." and (found := ip(text, at)):
                done[1], right = found
                if right:
                    spans.append((1, at, done[1]))
            if at >= done[2]:
                done[2], right = card(text, at)
                if right:
                    spans.append((2, at, done[2]))
        elif kind == "at":
            if found := email(text, at, done[0]):
                done[0] = found[1]
                spans.append((0, *found))
        elif kind == "plus":
            if at >= done[3] and (found := phone(text, at)):
                done[3], right = found
                if right:
                    spans.append((3, at, done[3]))
        elif kind == "scheme":
            if at >= done[4] and (found := url(text, at, done[4])):
                done[4] = found[1]
                spans.append((4, *found))
        elif (at == 0 or not text[at - 1].isalnum()) and last + 1 >= done[5] and (found := account(text, last + 1)):
            done[5] = found[1]
            spans.append((5, *found))
    return sorted(spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """text with each span replaced by its kind in brackets; of spans that overlap, the first and longest counts."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in sorted(((s, -e, k) for k, s, e in spans)):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = -end
        elif -end > at:
            at = -end
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", redact: bool = False) -> DataFrame:
    """One row per row of docs: key, n_email, n_ip, n_card, n_phone, base_sha256, spans and, if asked, redacted.

    spans: kind:start:end of all spans, by kind in the order of KINDS and then start, in code points of the
    whole text; base_sha256: of those of the first four kinds. A null or empty text has no spans. Repeated
    rows and null keys each give a row; other columns of docs, whatever their names, are not read.
    """
    fields = [(key, docs.schema[key].dataType.simpleString()), *((f"n_{x}", "bigint") for x in BASE), ("base_sha256", "string"), ("spans", "string")] + [("redacted", "string")] * redact
    n_base = len(BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("pii", _anchors.cache_clear)
        for batch in batches:
            found = [find(x) for x in workers.texts(batch.column(1))]
            base = [[x for x in spans if x[0] < n_base] for spans in found]
            columns = [batch.column(0), *(pa.array([sum(x[0] == k for x in spans) for spans in base], pa.int64()) for k in range(n_base))]
            columns += [pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base]), pa.array([joined(x) for x in found], pa.string())]
            if redact:
                columns.append(pa.array([redacted(x, spans) for x, spans in zip(workers.texts(batch.column(1)), found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[x for x, _ in fields])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in fields))
