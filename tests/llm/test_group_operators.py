import random
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from sieveline.llm import bpe, chat, decontaminate, neighbours, ngram_join, registry, sharding  # noqa: E402
from sieveline import session  # noqa: E402
from sieveline.session import read_table  # noqa: E402

SCHEMA = "doc_id long, text string, node long, grp long, n long, tokens string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, 1, "x") for i, t in rows], SCHEMA)


def corpus(seed=0):
    """Clusters of edited copies, chains of drifting copies, shared passages, exact copies and odd texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=60)
    texts = [None, "", "  \n", "one", "One", "one two", "ONE  two", "a b c d e", "a b c d e", "É b c d e", "é b c d e"]
    for n in range(12):
        base = draw.choices(vocabulary, k=draw.randint(5, 160))
        for _ in range(draw.randint(1, 12)):
            copy = base.copy()
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
            if n % 3 == 0:
                base = copy  # drifts: the last may have little in common with the first
    texts += [" ".join(draw.choices(vocabulary, k=draw.randint(5, 80)) + passage) for _ in range(20)]
    texts += [" ".join(passage)] * 5 + [" ".join(passage + draw.choices(vocabulary, k=6)) for _ in range(30)]
    draw.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_near_copies(spark, seed, monkeypatch):
    if seed:  # small groups and blocks, so that they are split and meet across
        monkeypatch.setattr(ngram_join, "GROUP", 3)
        monkeypatch.setattr(ngram_join, "TEXT_BYTES", 4000)
        monkeypatch.setattr(ngram_join, "SET_BYTES", 4000)
        monkeypatch.setattr(ngram_join, "PACK", 600)
        monkeypatch.setattr(ngram_join, "FIRST_TEXTS", 2)
        monkeypatch.setattr(ngram_join, "PAIRS", 3)
        monkeypatch.setattr(session, "BROADCAST_BYTES", 1)
    rows = corpus(seed)
    want = {(i, *x) for (i, _), x in zip(rows, brute.near_copies(rows))}
    assert {tuple(x) for x in ngram_join.near_copies(table(spark, rows).repartition(5)).collect()} == want


def test_near_copies_of_one_passage_in_all_texts(spark):
    """A block of texts sends a shingle once, however many of its texts have it."""
    draw = random.Random(3)
    passage = "this licence line stands in all"
    texts = [passage + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(20)) for _ in range(2000)]
    docs = spark.createDataFrame([(i, t, i, i) for i, t in enumerate(texts)], "id long, text string, h1 long, h2 long").coalesce(4)
    sent = docs.mapInArrow(ngram_join._pack_texts(50, 5), ngram_join.PACKED).selectExpr("part", "octet_length(tokens) AS n").groupBy("part").sum("n").collect()
    sizes = sorted(x[1] for x in sent)
    assert len(sizes) == 50 and sizes[-1] < 1.3 * sizes[25]
    got = ngram_join.near_copies(docs.select(docs.id.alias("doc_id"), "text"))
    assert got.filter("doc_id = component_id").count() == 2000


def test_near_copies_odd_tables(spark):
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (None, "a b c d e f g"), (None, "z y"), (None, None), (7, None), (8, "z y"), (9, "only null keys"), (1, "a b c d e f g h i j k l m n o p q r s")]
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.near_copies(table(spark, rows)).collect()), key=str)
    want = sorted([(3, 3, 3), (3, 3, 3), (None, 3, 3), (None, 1, 8), (None, 0, None), (7, 0, 7), (8, 1, 8), (9, 1, 9), (1, 15, 1)], key=str)
    assert got == want
    assert ngram_join.near_copies(table(spark, rows).limit(0)).count() == 0


def test_near_copies_query(spark, data):
    rows = sorted((x.doc_id, x.text) for x in read_table(spark, data, "documents").select("doc_id", "text").collect())
    want = {(i, *x) for (i, _), x in zip(rows, brute.near_copies(rows))}
    assert {tuple(x) for x in registry.op4_ngram_join(spark, data).collect()} == want


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (3, 9), (20, 21), (9, 1), (7, 7)]])
def test_components(spark, links):
    got = {x.node: x.label for x in ngram_join.components(spark.createDataFrame(links, "u long, v long")).collect()}
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if k != v}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep long, bucket long")


def nearest_brute(rows, every=50, k=5):
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            scored = sorted((-round(float(q @ v / np.sqrt(q @ q) / np.sqrt(v @ v)), 12), j) for j, v in ok if j != i and len(v) == len(q))
            out[i] = [j for _, j in scored[:k]]
    return out


def test_neighbours_recall_and_scores(spark, data):
    rows = [(x.vec_id, list(x.embedding)) for x in read_table(spark, data, "embeddings").collect()]
    want = nearest_brute(rows)
    got = registry.op8_neighbours(spark, data).collect()
    found = {q: [x.vec_id for x in sorted(got, key=lambda x: x["rank"]) if x.query_id == q] for q in want}
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    by = dict(rows)
    for x in got:
        a, b = np.array(by[x.query_id], dtype=float), np.array(by[x.vec_id], dtype=float)
        assert abs(x.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_neighbours_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_BYTES", 50)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 9)] + [(50, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 0.1, 0.0]), (52, None), (53, []), (54, [0.0, 0.0, 0.0]), (55, [1.0, None, 0.0]), (56, [float("nan"), 1.0, 0.0]), (57, [float("inf"), 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (100, [1.0, 0.0]), (150, [0.0, 0.0, 1.0])]
    df = vectors(spark, [(i, v, 0, 0, 0) for i, v in rows])
    got = neighbours.nearest(df).collect()
    found = {q: [x.vec_id for x in sorted(got, key=lambda x: x["rank"]) if x.query_id == q] for q in (0, 50, 100, 150)}
    assert found[0] == [1, 2, 3, 4, 5] and found[50] == [0, 1, 2, 3, 4] and found[100] == []
    assert neighbours.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("bytes_, run", [(1 << 25, 1024), (40_000, 50), (2_000, 1)])
def test_neighbours_recall_with_many_parts(spark, monkeypatch, bytes_, run):
    """Recall stays above what is asked for however the buckets are dealt out: few parts, many, and split buckets."""
    monkeypatch.setattr(neighbours, "PART_BYTES", bytes_)
    monkeypatch.setattr(neighbours, "RUN", run)
    draw = np.random.default_rng(3)
    near = draw.normal(size=64) + 0.05 * draw.normal(size=(300, 64))  # these share their buckets
    rows = [(i, x.tolist()) for i, x in enumerate([*draw.normal(size=(1500, 64)), *near])]
    want = nearest_brute(rows)
    got = neighbours.nearest(vectors(spark, [(i, v, 0, 0, 0) for i, v in rows])).collect()
    found = {q: [x.vec_id for x in sorted(got, key=lambda x: x["rank"]) if x.query_id == q] for q in want}
    assert sum(len(set(found[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert all(found[q] == want[q] for q in want if q >= 1500)


def test_neighbours_probes():
    """More probes meet more, all of them everything; near pairs need few."""
    draw = np.random.default_rng(4)
    q, noise = draw.normal(size=(2, 200, 64))
    near = list(zip(q, 0.6 * q + 0.8 * noise))
    shares = [neighbours.met_share(near, x) for x in (*neighbours.PROBES, None)]
    of = dict(zip((*neighbours.PROBES, None), shares))
    assert shares == sorted(shares) and of[500] > 0.8 and of[2000] > 0.95 and of[None] == 1
    assert neighbours.met_share(list(zip(q, noise)), None) == 1
    first, second = neighbours.losses(neighbours._unit(q), 0)
    probed = (first[:, :, None] + second[:, None, :] <= neighbours.reaches(first, second, 500)[:, None, None]).sum(axis=(1, 2))
    assert (probed == 500).all()


@pytest.mark.parametrize("size", [1e-200, 5e-324, 1e200, 1.7e308])
def test_neighbours_of_tiny_and_huge_vectors(spark, size):
    rows = [(0, [size, size]), (1, [1.0, 1.0]), (2, [1.0, 0.5]), (3, [size, 0.0]), (4, [-size, size]), (5, [0.0, -1.0])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted((x["rank"], x.vec_id, round(x.score, 9)) for x in neighbours.nearest(df).collect())
    assert got == [(1, 1, 1.0), (2, 2, round(1.5 / 2.5**0.5, 9)), (3, 3, round(0.5**0.5, 9)), (4, 4, 0.0), (5, 5, -round(0.5**0.5, 9))]


def test_neighbours_with_repeated_keys(spark):
    """Rows that share a key but not a vector each ask and are found, and the better score counts."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (1, [0.1, 1.0]), (2, [1.0, 1.0])]
    got = sorted((x.query_id, x["rank"], x.vec_id) for x in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 1, 1), (0, 2, 2)]


def test_neighbours_ties_go_to_smaller_ids(spark):
    """Forty different vectors of one direction, and as many of signs at one angle to the query."""
    draw = random.Random(5)
    ids = draw.sample(range(101, 149), 40)
    rows = [(50, [1.0] * 16)] + [(i, [2.0**-n] * 16) for n, i in enumerate(ids)]
    got = neighbours.nearest(vectors(spark, [(i, v, 0, 0, 0) for i, v in rows])).collect()
    assert [x.vec_id for x in sorted(got, key=lambda x: x["rank"])] == sorted(ids)[:5]
    signs = np.ones((40, 64), dtype=np.float32)
    for n in range(40):
        signs[n, [n, n + 10, n + 20]] = -1
    got = neighbours.nearest(vectors(spark, [(i, x.tolist(), 0, 0, 0) for i, x in zip([50, *ids], [np.ones(64), *signs])])).collect()
    assert [x.vec_id for x in sorted(got, key=lambda x: x["rank"])] == sorted(ids)[:5]


def test_sharding_table():
    names = [f"n{i}" for i in range(7)]
    assert sharding.lookup_table(names, 101) == brute.maglev(names, 101, sharding._hash)
    before, after = sharding.lookup_table(names, 8191), sharding.lookup_table(names[:-1], 8191)
    counts = np.bincount(before)
    assert counts.max() - counts.min() <= 1 and np.mean([a != b and a != 6 for a, b in zip(before, after)]) < 0.15
    for wrong in ((names, 100), ([], 101), (names * 2, 101), (names, 5)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*wrong)


def test_sharding_odd_tables(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, "z")], "doc_id long, slot string")
    got = sharding.place(df, "doc_id")
    rows = got.collect()
    assert got.columns == ["doc_id", "slot", "shard"] and len(rows) == 4 and all(x.shard for x in rows) and len({x.shard for x in rows if x.doc_id == 1}) == 1
    assert sharding.place(df.limit(0), "doc_id").count() == 0


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")


def test_preferences(spark):
    rows = [(0, 0, "user", "hi", ""), (0, 1, "assistant", "A", ""), (0, 2, "user", "more", ""), (0, 3, "assistant", "good", ""), (0, 3, "assistant", "good", ""), (1, 0, "user", "yo", ""), (1, 1, "assistant", "bad", ""), (2, None, None, None, ""), (None, 0, "user", "lost", ""), (4, 0, "system", "s", ""), (4, 1, "user", "u", "")]
    got = {x.pair_id: x for x in chat.format_preferences(chat.random_negatives(chat.turns_of(turns(spark, rows)))).collect()}
    assert set(got) == {0, 1, 2, 4}
    x = got[0]
    assert x.n_prompt_turns == 3 and x.prompt.endswith("<|user|>\nmore<|end|>\n") and x.chosen == "<|assistant|>\ngood<|end|>\n" and x.rejected == "<|assistant|>\nbad<|end|>\n"
    a, b = map(int, x.chosen_mask.split(":"))
    assert x.chosen[a:b] == "good<|end|>\n"
    assert got[1].chosen == "<|assistant|>\nbad<|end|>\n" and got[1].rejected == "" and got[1].rejected_mask == ""
    assert got[2].prompt == "<|user|>\n<|end|>\n" and got[4].n_prompt_turns == 2 and got[4].chosen == ""
    assert chat.format_preferences(chat.random_negatives(chat.turns_of(turns(spark, rows).limit(0)))).count() == 0


def test_equal_and_null_conversations(spark):
    kind = "pair_id long, chosen array<struct<turn:long,role:string,text:string>>, rejected array<struct<turn:long,role:string,text:string>>"
    one = [(0, "user", "q"), (1, "assistant", "r")]
    pairs = spark.createDataFrame([(1, one, one), (2, None, one), (3, one, None), (4, [], []), (5, one, one[:1])], kind)
    got = {x.pair_id: (x.n_prompt_turns, x.chosen, x.rejected) for x in chat.format_preferences(pairs).collect()}
    assert got[1] == (2, "", "") and got[2][0] == 0 and got[2][1] == "" and got[4] == (0, "", "") and got[5] == (1, "<|assistant|>\nr<|end|>\n", "")


def test_long_conversations(spark):
    """Ten thousand turns take seconds, and their masks cut out the replies; also for numbers of turns around squares."""
    def made(n, off=0):
        return [(i, "assistant" if i % 2 else "user", f"t{i % 7}" if i < n // 2 else f"x{i % 11 + off}") for i in range(n)]

    kind = "pair_id long, chosen array<struct<turn:long,role:string,text:string>>, rejected array<struct<turn:long,role:string,text:string>>"
    sizes = [1, 2, 3, 4, 5, 8, 9, 10, 15, 16, 17, 10_000]
    began = time.perf_counter()
    got = {x.pair_id: x for x in chat.format_preferences(spark.createDataFrame([(n, made(n), made(n, 1)) for n in sizes], kind)).collect()}
    assert time.perf_counter() - began < 60
    for n in sizes:
        for side, off in (("chosen", 0), ("rejected", 1)):
            turns_, text = made(n, off)[got[n].n_prompt_turns :], got[n][side]
            assert text == "".join(f"<|{r}|>\n{t}<|end|>\n" for _, r, t in turns_)
            spans = [x.split(":") for x in got[n][f"{side}_mask"].split(",") if x]
            assert [text[int(a) : int(b)] for a, b in spans] == [f"{t}<|end|>\n" for _, r, t in turns_ if r == "assistant"]
        assert got[n].n_prompt_turns == n // 2


@pytest.mark.parametrize("name", ["op6_line_dedup", "op7_sharding", "op10_preferences"])
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = registry.QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got, want = df.toPandas(), con.sql(registry.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, got[columns].values.tolist())) == sorted(map(str, want[columns].values.tolist()))


def test_pipeline(spark, data):
    """Each stage against a plain version, on what its predecessor kept."""
    docs = read_table(spark, data, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {x.doc_id: x for x in docs.collect()}
        docs = stage(spark, docs, data)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = (before, {x.doc_id: x for x in docs.collect()})
    before, after = kept["language ID"]
    assert set(after) == {k for k, x in before.items() if x.text and any(c.isalpha() for c in x.text)}
    before, after = kept["line dedup"]
    sites, first = {}, {}
    for k in sorted(before):
        for i, line in enumerate(before[k].text.split("\n")):
            if line.strip(" "):
                sites.setdefault(line, set()).add(before[k].source)
                first.setdefault(line, (k, i))
    want = {}
    for k, x in before.items():
        lines_ = x.text.split("\n")
        left = [y for i, y in enumerate(lines_) if not (y.strip(" ") and len(sites[y]) >= 10 and first[y] != (k, i))]
        if len(left) == len(lines_) or "".join(left).strip():
            want[k] = "\n".join(left)
    assert {k: x.text for k, x in after.items()} == want
    before, after = kept["n-gram Jaccard join"]
    rows = sorted((k, x.text) for k, x in before.items())
    assert set(after) == {k for (k, _), (_, c) in zip(rows, brute.near_copies(rows)) if k == c}
    before, after = kept["benchmark decontamination"]
    matcher = decontaminate.Matcher([(x.item_id, x.text) for x in read_table(spark, data, "benchmark").collect()])
    assert set(after) == {k for k, x in before.items() if not matcher.matches(x.text)}
    assert all(decontaminate.normal(i[1]) not in decontaminate.normal(x.text) for x in after.values() for i in matcher.items)
    before, after = kept["byte-level BPE"]
    coder = bpe.load(registry.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert {k: x.n_tokens for k, x in after.items()} == {k: len(coder.encode([x.text])[0]) for k, x in before.items()}
    run = corpus_pipeline.run(spark, data)
    assert {x.doc_id: x.ids_sha256 for x in run.collect()} == {k: x.ids_sha256 for k, x in after.items()}
    assert run.filter(F.col("doc_id").isNull()).count() == 0


def test_pipeline_delivers_tokens(spark, data):
    docs = spark.createDataFrame([(1, "Où est le chat?", "fr"), (None, "", None), (3, "it is 1,234 ™", "en")], "doc_id long, text string, lang string")
    coder = bpe.load(registry.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    got = {x.doc_id: x for x in corpus_pipeline.encode_tokens(spark, docs.coalesce(1), data).collect()}
    assert {k: x.lang for k, x in got.items()} == {1: "fr", None: None, 3: "en"}
    for x in docs.collect():
        assert got[x.doc_id].ids == np.asarray(coder.encode([x.text])[0]).astype("<u4").tobytes() and len(got[x.doc_id].byte_ends) == 4 * got[x.doc_id].n_tokens
        assert got[x.doc_id].n_tokens == 0 or np.frombuffer(got[x.doc_id].byte_ends, "<u4")[-1] == len(x.text.encode())


def test_pipeline_odd_tables(spark, data):
    """Nulls in every column, repeated rows, repeated ids, blank and very long texts, other columns, and no rows."""
    long = " ".join(f"word{i}" for i in range(30000))
    prose = ["the cat sat on the mat and looked at the dog for a while", "le chat est assis sur le tapis et regarde le chien"]
    rows = [(1, prose[0], "en", "a"), (1, prose[0], "en", "a"), (2, prose[0], None, None), (3, None, "en", "a"), (4, "", "en", None), (5, "12 !?", "en", "a"), (6, prose[1], "fr", "b"), (None, prose[1], "fr", "b"), (7, long, "en", "c"), (8, long + " more", "en", "c"), (9, "tout autre chose ici", "fr", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, n_lines long, _gone string"
    docs = spark.createDataFrame([(*x, len(x[1] or ""), 1.0, "x", 1, "x") for x in rows], schema)
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        left[name] = sorted((x.doc_id for x in docs.collect()), key=str)
        if name != "byte-level BPE":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert left["language ID"] == sorted([1, 1, 2, 6, None, 7, 8, 9], key=str)
    assert left["line dedup"] == left["language ID"]
    assert left["n-gram Jaccard join"] == left["byte-level BPE"] == sorted([1, 6, None, 7, 9], key=str)
    empty = docs = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        assert docs.count() == 0, name
    assert empty.count() == 0


def test_a_block_sends_no_more_for_more_ranges():
    """Bytes of a block's shingles, owners and counts over few and many ranges of hashes: at most one owner and count a shingle."""
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 2**63, 200_000, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    owner = rng.integers(0, 2_500, len(tokens))
    sizes = []
    for parts in (30, 3_000, 300_000):
        rows = [*ngram_join._by_part(tokens, owner, parts, 7)]
        assert sum(len(x[3]) for x in rows) == len(tokens) and all(x[2].sum() == len(x[3]) for x in rows)
        again = {(int(t), int(o)) for _, held, counts, own, _ in rows for t, o in zip(own, np.repeat(held, counts))}
        assert again == set(zip(tokens.tolist(), owner.tolist()))
        for _, held, counts, _, _ in rows[:50]:
            assert all((a == b).all() for a, b in zip((held, counts), ngram_join._of_pairs(ngram_join._pairs(held, counts))))
        sizes.append(sum(len(ngram_join._pairs(x[1], x[2])) + 8 * len(x[3]) for x in rows))
    assert max(sizes) <= 17 * len(tokens)


def test_texts_that_ask_are_dealt_out_by_bytes(spark, monkeypatch):
    """Long texts, many of which ask one group, with little room in a task: same components as without."""
    draw = random.Random(8)
    base = [f"w{i}" for i in range(900)]
    texts = []
    for k in range(60):
        own = base[:]
        for _ in range(12):
            own[draw.randrange(900)] = f"x{k}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    monkeypatch.setattr(ngram_join, "ASK_BYTES", 8_000)
    monkeypatch.setattr(ngram_join, "SET_BYTES", 30_000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.near_copies(df).collect())
    assert got == [(i, n, c) for (i, _), (n, c) in zip(rows, brute.near_copies(rows))]


def test_few_rows_are_scored_where_vectors_are_clustered(spark, monkeypatch):
    """Recall and rows scored: nearly all neighbours of clustered rows by few probes, which go to few parts."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 64))
    rows = (centres[:, None] + 0.25 * rng.normal(size=(200, 50, 64))).reshape(-1, 64)
    unit = neighbours._unit(neighbours.scaled(rows))
    q = unit[::50]
    near = np.argsort(-(q @ unit.T), axis=1, kind="stable")[:, 1:6]
    pairs = [(q[i], unit[j]) for i in range(len(q)) for j in near[i]]
    probes = next(x for x in neighbours.PROBES if neighbours.met_share(pairs, x) >= neighbours.RECALL)
    assert probes <= 60
    spread = [(q[i], unit[j]) for i in range(0, len(q), 4) for j in range(0, len(unit), 37)]
    assert neighbours.met_share(spread, probes) < 0.02
    monkeypatch.setattr(neighbours, "PART_BYTES", 8 * 64 * 100)  # a hundred rows a part
    counts = {}
    for table in (0, 1):
        for x in neighbours._cell(*neighbours.buckets(unit, table), 128).tolist():
            counts[64, table, x] = counts.get((64, table, x), 0) + 1
    parts = neighbours.Parts([(*k, n) for k, n in counts.items()])
    run = neighbours._placed_queries(parts, 2, probes, ["part", "asks", "bucket", "reach", "rep", "tag", "vec"])
    batch = pa.RecordBatch.from_pydict({"query": pa.array(range(len(q)), pa.int64()), "qtag": pa.array(range(len(q)), pa.int64()), "vec": pa.array(q.tolist())})
    sent = sum(x.num_rows for x in run(iter([batch])))
    assert len(parts) > 150 and sent < 0.25 * len(q) * len(parts)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {(x.query_id, x.vec_id) for x in neighbours.nearest(df).collect()}
    true = {(50 * i, int(j)) for i in range(len(q)) for j in near[i]}
    assert len(got & true) >= 0.9 * len(true)
