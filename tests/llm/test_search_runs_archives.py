import gzip
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from sieveline.llm import periodic_runs, ranked_search, registry, warc  # noqa: E402
from sieveline.session import read_table, shared_path  # noqa: E402


def table(spark, texts, keys=None):
    rows = [(k, t, "x", 1, "y") for k, t in zip(keys or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, rank string, score int, runs string")


def items(spark, texts, keys=None):
    return spark.createDataFrame([(k, t, 1) for k, t in zip(keys or range(len(texts)), texts)], "item_id long, text string, rank int")


# ranked search


def test_terms_are_the_contracts():
    draw = random.Random(1)
    for _ in range(500):
        text = "".join(draw.choices([*"aZ09 _-@[`{\x7f\x00\n", "é", "İ", "\x85", " ", "日"], k=30))
        plain = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)
        assert [x.decode() for x in ranked_search.terms_of(text)] == brute.TERM.findall(plain)


@pytest.mark.parametrize("leaf", [1, 3, 128])
def test_tree_keeps_the_best(spark, leaf):
    """Skewed words, many equal texts, ties, repeated terms of an item, an item of words that all documents hold or none."""
    draw = random.Random(leaf)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(draw.choices(words, weights, k=draw.choice([1, 3, 10, 60]))) for _ in range(700)] + ["w1 w2 w3"] * 90 + [None, "", "...", "W1 w1"]
    keys = [*range(len(texts) - 1), None]
    asked = [" ".join(draw.choices(words, k=draw.randint(1, 20))) for _ in range(25)] + ["w1 W1 w1", "w0", "nothing here", "", None, "w1 w2"]
    got = ranked_search.search(table(spark, texts, keys), items(spark, asked), leaf=leaf).collect()
    assert sorted(map(tuple, got), key=lambda x: x[:2]) == brute.ranked(list(zip(keys, texts)), list(enumerate(asked)))


def test_tree_prunes_and_bounds():
    """A tree's bounds are never below a score beneath, and rule out most leaves where few documents hold an item's rare terms."""
    rng = np.random.default_rng(0)
    n, n_terms = 6000, 400
    rows = [np.unique(np.minimum(rng.zipf(1.3, 30) - 1, n_terms - 1)) for _ in range(n)]
    counts, ranks = np.array([len(x) for x in rows]), np.concatenate(rows)
    tfs, m = rng.integers(1, 9, len(ranks)), rng.integers(75, 200, n)
    tree = ranked_search.Tree(counts, ranks, tfs, m, n_terms, 16)
    assert sorted(tree.order.tolist()) == list(range(n)) and max(b - a for a, b in tree.leaves) <= 16
    terms, weights = np.array([0, 3, 200, 390]), np.array([5, 100, 4000, 6000])
    bounds = tree.bounds(terms, weights)
    for i, (a, b) in enumerate(tree.leaves):
        assert tree.scores(a, b, terms, weights).max() <= bounds[i]
    for k, (a, b, _) in enumerate(tree.inner):
        assert bounds[len(tree.leaves) + k] >= bounds[a:b].max()
    seen = []
    scores = tree.scores
    tree.scores = lambda *x: seen.append(x) or scores(*x)
    tree.search(terms, weights, [], list(range(n)), 1, 20)
    assert len(seen) < len(tree.leaves) / 2


def test_ranked_search_odd_tables(spark):
    docs, asked = table(spark, ["a b", "a b", "c"], [5, 5, 5]), items(spark, ["a", "a", "c", "b"], [1, 1, 1, None])
    got = sorted((x.item_id, x.rank, x.doc_id) for x in ranked_search.search(docs, asked).collect())
    assert got == [(1, 1, 5), (1, 1, 5), (1, 2, 5)]  # two texts under one id, repeated documents rank each, a null id gives none
    assert ranked_search.search(docs.limit(0), asked).count() == 0
    assert ranked_search.search(docs, asked.limit(0)).count() == 0
    assert ranked_search.search(docs, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    from sieveline.llm import decontaminate

    docs, asked = table(spark, ["a b c", "b c", "c d d"]), items(spark, ["a b", "d", "c b", "a d"])
    whole = sorted(map(tuple, ranked_search.search(docs, asked).collect()))
    blocks = decontaminate.item_blocks
    monkeypatch.setattr(ranked_search, "item_blocks", lambda *x: blocks(*x, block_chars=3))
    assert sorted(map(tuple, ranked_search.search(docs, asked).collect())) == whole


def test_ranked_search_query(spark, data):
    docs = [(x.doc_id, x.text) for x in read_table(spark, data, "documents").collect()]
    asked = sorted((x.item_id, x.text) for x in read_table(spark, data, "benchmark").collect())
    got = sorted(map(tuple, registry.op11_ranked_search(spark, data).collect()))
    assert got == brute.ranked(docs, asked)


# periodic runs


def solved(words):
    number = {}
    rows = periodic_runs.runs(np.array([number.setdefault(x, len(number)) for x in words], dtype=np.int64), np.array([len(words)]))
    return [(a, b - a, q) for a, b, q in rows.tolist()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=14), st.integers(1, 9)), min_size=1, max_size=8))
def test_runs_of_repeated_pieces(pieces):
    words = "".join(x * n for x, n in pieces)
    assert solved(words) == brute.periodic_runs(words)


def test_runs_of_nested_and_random_words():
    draw = random.Random(5)
    cases = ["a" * n for n in (23, 24, 25, 100)] + ["ab" * 40 + "a", "aab" * 9 + "b" + "aab" * 9, ("aabaab" * 3 + "c") * 6]
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    cases += [fib[-1], "".join("ab"[bin(i).count("1") % 2] for i in range(512))]
    for _ in range(300):
        base = "".join(draw.choices("abc", k=draw.randint(1, 40)))
        inner = (base * 8)[: draw.randint(1, 8 * len(base))]
        cases.append("".join(draw.choices("ab", k=draw.randint(0, 9))) + (inner + "".join(draw.choices("ac", k=draw.randint(0, 3)))) * draw.randint(1, 5))
    for words in cases:
        assert solved(words) == brute.periodic_runs(words), words
    together = [x for x in cases if x]
    rows = periodic_runs.runs(np.array([ord(x) for w in together for x in w]), np.array([len(x) for x in together]))
    begins = np.cumsum([0] + [len(x) for x in together])
    for k, words in enumerate(together):  # documents side by side don't touch each other
        own = rows[(rows[:, 0] >= begins[k]) & (rows[:, 0] < begins[k + 1])]
        assert [(a - begins[k], b - a, q) for a, b, q in own.tolist()] == brute.periodic_runs(words)


def test_successors_are_counts_and_order_statistics():
    rng = np.random.default_rng(2)
    values = rng.permutation(500)[:300]
    tree = periodic_runs.Successors(values)
    low = rng.integers(0, 299, 200)
    high = low + rng.integers(1, 300 - low + 1)
    bound = rng.integers(0, 600, 200)
    below = tree.below(low, high, bound)
    for a, b, v, n in zip(low, high, bound, below):
        assert n == (values[a:b] < v).sum()
    k = rng.integers(0, high - low)
    assert [sorted(values[a:b])[i] for a, b, i in zip(low, high, k)] == tree.smallest(low, high, k).tolist()


def expected_runs(key, text):
    words = brute.planted(key, [x for x in brute.re.split(r"[\x20\x09-\x0D]+", text or "") if x])
    found = brute.periodic_runs(words)
    top = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
    line = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (key, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha(line), sha(brute.collapsed(words, found)))


def test_runs_query(spark, data):
    docs = [(x.doc_id, x.text) for x in read_table(spark, data, "documents").collect() if len(x.text or "") < 6000]
    got = {x.doc_id: tuple(x) for x in registry.op12_periodic_runs(spark, data).collect()}
    assert all(got[k] == expected_runs(k, t) for k, t in docs)
    assert len(docs) > 150 and any(x[1] for x in got.values())


def test_runs_odd_tables(spark, monkeypatch):
    texts = [None, "", " \n", "x", "x " * 24, "a b " * 30, "é  " * 24, "same words " * 20, "same words " * 20, "w " * 3000]
    docs = table(spark, texts)
    got = sorted(periodic_runs.find_runs(docs).collect(), key=lambda x: x.doc_id)
    assert [len(x.runs) for x in got] == [0, 0, 0, 0, 1, 1, 1, 1, 1, 1]
    assert [x.collapsed for x in got] == ["", "", "", "x", "x", "a b", "é ", "same words", "same words", "w"]
    assert tuple(got[9].runs[0]) == (0, 3000, 1)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    both = periodic_runs.digests(periodic_runs.find_runs(table(spark, texts[:3], [None, None, 7]))).collect()
    assert all(x.n_runs == 0 and x.start is None and x.exponent_milli is None and x.collapsed_sha256 == hashlib.sha256(b"").hexdigest() for x in both)


def test_planting(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (*range(1, 60), 0, 500)] + ["  a \x0b b\n", "", None]
    for keys in (range(len(texts)), range(-90, len(texts) - 90)):
        got = {x.doc_id: x.text for x in periodic_runs.plant_repeats(table(spark, texts, keys)).collect()}
        for key, text in zip(keys, texts):
            assert (got[key] or "").split() == brute.planted(key, (text or "").split())
    assert periodic_runs.plant_repeats(table(spark, ["a b"], [None])).first().text == "a b"


# archives


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "k", 1, "d") for k, u, h in rows], "page_id long, url string, html string, key string, bytes int, digest string")


BIG = "é" * 600
PAGES = [(1, "http://A.com/x", BIG), (9, "https://b.com", BIG), (4, "http://a.com/x?q=%20#f", BIG), (5, "http://a.com/x", "small"), (6, None, None), (7, "no url\r\nat all", ""), (8, "http://u:p@[::1]:80/", "small"), (9, "https://b.com", BIG), (None, "http://a.com:8080", BIG), (11, "http://c.d.com?x", "z" * 999), (12, "http://c.d.com?x", "z" * 999), (13, "http://e", "y" * 1000), (14, "http://e", "y" * 1000), (None, "n", "q" * 2000), (None, "n", "q" * 2000)]


def test_archives_of_odd_pages(spark):
    got = sorted(map(tuple, warc.archive_pages(pages(spark, PAGES)).collect()), key=str)
    assert got == sorted(brute.archived([(k, h) for k, _, h in PAGES]), key=str)
    assert warc.archive_pages(pages(spark, PAGES).limit(0)).count() == 0


def test_archives_query(spark, data):
    rows = [(x.page_id, x.html) for x in read_table(spark, data, "pages").collect()]
    assert sorted(map(tuple, registry.op13_warc(spark, data).collect())) == sorted(brute.archived(rows))


def test_hot_payloads_join_apart(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.org/{i}", ("x" * 1500) if i % 3 else f"{i // 6}" * 1200) for i in range(120)]
    expected = sorted(brute.archived([(k, h) for k, _, h in rows]))
    for hot in (0.001, 0.3):
        monkeypatch.setattr(warc, "small", lambda _: False)
        monkeypatch.setattr(warc, "HOT", hot)
        assert sorted(map(tuple, warc.archive_pages(pages(spark, rows)).collect())) == expected


def test_url_keys(spark):
    urls = ["http://www.Example.com:80/a?b", "https://u@x.org", "ftp://x.org:21?q", "mailto:a@b", "", None, "http://[::1]/z"]
    got = [x.k for x in pages(spark, [(i, u, "") for i, u in enumerate(urls)]).orderBy("page_id").select(warc.url_key(F.col("url")).alias("k")).collect()]
    assert got == ["com,example,www)/a?b", "org,x)/", "org,x:21)/?q", ")mailto:a@b", ")", ")", "[::1])/z"]


def test_look_ups_read_ranges(spark, monkeypatch):
    """Single captures, hosts and domains from archives of many blocks; what is looked up opens few of them."""
    rows = [(i, f"http://s{i % 7}.site{i % 3}.com/{i}", f"page {i} " * 300 if i % 5 else "all alike " * 200) for i in range(400)]
    out = shared_path(spark, "warc")
    manifest = warc.write_archives(pages(spark, rows), out, lines=8)
    assert manifest.agg(F.sum("n")).first()[0] == 400
    wanted = spark.createDataFrame([("com,site1,s4)/4",), ("com,site1,s4)/none",), ("com,site2,s5)/5",)], "key string")
    got = {x.id: x for x in warc.look_up(manifest, wanted, payloads=True).collect()}
    assert sorted(got) == [4, 5] and got[4].payload.decode() == "page 4 " * 300 and got[5].refers_to == 395 and got[5].payload is None
    domain = warc.look_up(manifest, spark.createDataFrame([("com,site1,",)], "key string"), prefix=True).collect()
    assert sorted(x.id for x in domain) == [i for i in range(400) if i % 3 == 1]
    one = manifest.orderBy("part").first()
    archive = warc.Archive(one["file"], one["index"], one["directory"])
    opened = []
    block = archive._block
    archive._block = lambda i: opened.append(i) or block(i)
    line = archive.lines or (block(3) or archive.lines)
    key = warc._index_key(*line[5][:3])
    assert list(archive.find(key, (key[0] + b"\0",)))[0] == line[5] and set(opened) <= {3, 4}


def test_files_are_warc(spark):
    """Each record is a gzip member, members in order are the file, and headers are those of the format."""
    manifest = warc.write_archives(pages(spark, PAGES), shared_path(spark, "warc"))
    n = 0
    for row in manifest.collect():
        files, path = pa.fs.FileSystem.from_uri(row.file)
        with files.open_input_stream(path, compression=None) as source:
            raw = gzip.decompress(source.read())
        for part in raw.split(b"WARC/1.1\r\n")[1:]:
            headers, block = warc.parse(b"WARC/1.1\r\n" + part)
            n += 1
            assert {"warc-type", "warc-record-id", "warc-date", "content-type", "content-length", "warc-payload-digest"} <= set(headers)
            assert headers["warc-type"] == "response" or not block.partition(b"\r\n\r\n")[2]
    assert n == len(PAGES)
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200\r\n\r\n")
    good = warc.record(1, "http://a", b"abc", hashlib.sha1(b"abc").hexdigest(), None, None, False, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.capture(good.replace(b"abc", b"abd"))
