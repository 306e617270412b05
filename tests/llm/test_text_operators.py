import hashlib
import random
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from sieveline.llm import bpe, decontaminate, language, lines, pii, registry, token_files  # noqa: E402
from sieveline.session import read_table  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n\n", "a" * 5000, "it's  we'll 'tis  \n\n x", "日本語 ñ é ́ \x1c\x85　", "<|endoftext|> <|startoftext|>", "ΣΑΣ Σ", "x" * 20 + " 1²३ " * 300, "same", "same"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, file string, part string, vec string"


def table(spark, texts, langs=None, sources=None):
    n = len(texts)
    rows = [(i, t, (langs or ["en"] * n)[i], (sources or ["s"] * n)[i], len(t or ""), "x", "x", "x", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(RANKS).ranks, special_tokens={})


def random_texts(n, signs, most=40, seed=0):
    draw = random.Random(seed)
    return ["".join(draw.choices(signs, k=draw.randint(0, most))) for _ in range(n)]


def test_bpe_is_tiktokens(tik):
    texts = [x or "" for x in ODD] + random_texts(4000, list(" \n\t'stredvmlabZé1२²!…- 　\x1c\x85́日"))
    coder = bpe.ByteBPE(RANKS)
    ids, ends = coder.encode(texts)
    begin = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[begin:end].tolist() == tik.encode_ordinary(text), text[:50]
        assert coder.decode(ids[begin:end])[0].tobytes().decode() == text
        begin = end


def test_long_words_merge_alike():
    coder = bpe.ByteBPE(RANKS)
    for word in random_texts(200, list("abcthe"), 60, 3):
        if word:
            parts = coder._merged_long(word.encode())
            assert parts == coder.merged(word.encode()) or len(word) > 48


def test_bpe_query(spark, data, tik):
    docs = {x.doc_id: x.text or "" for x in read_table(spark, data, "documents").collect()}
    got = registry.op9_byte_bpe(spark, data).collect()
    assert len(got) == len(docs)
    for row in got:
        ids = np.array(tik.encode_ordinary(docs[row.doc_id]), dtype="<u4")
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(docs[row.doc_id].encode()).hexdigest())


def test_bpe_odd_tables(spark, tik):
    got = sorted(bpe.encode_documents(table(spark, ODD), RANKS).collect(), key=lambda x: x.doc_id)
    assert [x.n_tokens for x in got] == [len(tik.encode_ordinary(x or "")) for x in ODD]
    row = got[5]
    ends = np.frombuffer(row.byte_ends, dtype="<u4")
    assert len(ends) == row.n_tokens and ends[-1] == len(ODD[5].encode())
    assert bpe.encode_documents(table(spark, ODD).limit(0), RANKS).count() == 0


def test_token_cache_is_the_library():
    texts = [x or "" for x in ODD] + random_texts(3000, [*" \n\t'stredlabZé1२²!…-,. ́日ΣİKŒ", "<|endoftext|>", "<|", "Thé, ", "a. ", "b, "])
    cached, plain = token_files.CachedTokenizer(WORDS), Tokenizer.from_file(WORDS)
    for _ in range(2):
        ids, ends = cached.encode(texts)
        begin = 0
        for text, end in zip(texts, ends.tolist()):
            assert ids[begin:end].tolist() == plain.encode(text, add_special_tokens=False).ids, text[:50]
            begin = end
        cached.thin()


def test_token_cache_composes_before_it_lowers():
    """Marks after letters of both cases, in texts of their own and next to each other, as the library encodes them."""
    marks = [chr(x) for x in range(0x300, 0x370)]
    texts = [f"{x}{m}" for m in marks for x in "AEGHIJKLNORSTUWYZaehjtwyΑΙΥΩωιÅÜǓ"] + ["Υ\u0308\u0301 ΐ Ϊ\u0301", "J\u030c J", "İ I\u0307", "Ŵ\u030a W\u030a"]
    texts += random_texts(1500, [*"AJHTWYajhtwy ,.", "Υ", "Ι", "\u030c", "\u0331", "\u0308", "\u030a", "\u0301", "\u0345"], seed=9)
    cached, plain = token_files.CachedTokenizer(WORDS), Tokenizer.from_file(WORDS)
    ids, ends = cached.encode(texts)
    begin = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[begin:end].tolist() == plain.encode(text, add_special_tokens=False).ids, ascii(text)
        begin = end


def expected_tokens(docs):
    plain, start, out = Tokenizer.from_file(WORDS), 0, []
    for key, text in docs:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, data):
    docs = sorted((x.doc_id, x.text) for x in read_table(spark, data, "documents").select("doc_id", "text").collect())
    got = sorted(map(tuple, registry.op1_token_files(spark, data).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == expected_tokens(docs)


def test_token_files_on_disk(spark, tmp_path):
    odd = table(spark, ODD).union(table(spark, ["same"]).selectExpr("CAST(NULL AS BIGINT) doc_id", "text", "lang", "source", "n_chars", "ids", "file", "part", "vec"))
    manifest = token_files.write_token_files(odd, WORDS, f"file://{tmp_path}/t", length=16, batch=4)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda x: x[1])
    assert got == expected_tokens([(None, "same"), *enumerate(ODD)])
    for row in manifest.collect():
        file = token_files.SequenceFile(row.file)
        ids = np.concatenate([file.ids(i) for i in range(len(file))])
        mask = np.concatenate([np.array(file.mask(i)) for i in range(len(file))])
        assert all(len(file.ids(i)) == 16 for i in range(len(file))) and mask.sum() == row.n_tokens and mask[: row.n_tokens].all()
        assert not file.ids(0).flags.owndata and ids[: row.n_tokens][-1] == 1
    assert not list((tmp_path / "t").glob("*.part"))
    empty = token_files.write_token_files(odd.limit(0), WORDS, f"file://{tmp_path}/e")
    assert empty.count() == 0 and token_files.read_token_files(empty).count() == 0


def test_pii_spans():
    for text in random_texts(5000, [*"0123456789" * 2, *"..@@++--  ()aZ_%", "1.2.3.4", "4111111111111111", "a@b.c", "٣", "é", "\n", "iban ", "http://"], seed=5) + [x or "" for x in ODD]:
        assert [x for x in pii.find(text) if x[0] < 4] == brute.base_spans(text), text


@pytest.mark.parametrize(
    "text, found",
    [
        ("see https://a.example.com/x?y=1, ok", ["url:4:31"]), ("IBAN: DE89 3704 0044 0532 0130 00.", ["account:6:33"]), ("Account number is 12345678, thanks", ["account:18:26"]), ("account of mine", []), ("http://nohost x", []), ("discount 12345678", []),
    ],
)
def test_pii_more_kinds(text, found):
    assert [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.find(text) if k >= 4] == found


def test_pii_query(spark, data):
    docs = {x.doc_id: x.text for x in read_table(spark, data, "documents").collect()}
    for row in registry.op2_pii(spark, data).collect():
        spans = brute.base_spans(docs[row.doc_id])
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(x[0] == k for x in spans) for k in range(4))
        assert row.base_sha256 == brute.spans_hash(spans)


def test_pii_redaction(spark):
    texts = [None, "", "mail a@b.co or 1.2.3.4", "x 4111 1111 1111 1111 y"]
    got = sorted(pii.find_pii(table(spark, texts), redact=True).collect(), key=lambda x: x.doc_id)
    assert [x.redacted for x in got] == [None, "", "mail [EMAIL] or [IP]", "x [CARD] y"]
    assert pii.find_pii(table(spark, texts).limit(0)).count() == 0


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards hum."


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, distance long")


def edited(text, edits, draw):
    text = list(text)
    for _ in range(edits):
        at = draw.randrange(len(text))
        text[at : at + 1] = draw.choice([[], [text[at], "q"], ["q"]])
    return "".join(text)


def test_decontamination_finds_every_edit_within_budget():
    draw, matcher = random.Random(7), decontaminate.Matcher([(1, ITEM)])
    plain, k = decontaminate.normal(ITEM), int(len(decontaminate.normal(ITEM)) * decontaminate.RATE)
    for n in range(300):
        text = " ".join(draw.choices(["fox", "dog", "the", "lazy", "brown", "x"], k=30)) + " " + edited(ITEM, n % 10, draw) + " and the rest of it"
        best = brute.closest(plain, decontaminate.normal(text))
        got = matcher.matches(text)
        assert bool(got) == (best <= k)
        if got:
            assert got[0][1] == best and brute.closest(plain, decontaminate.normal(text[got[0][2] : got[0][3]])) == best


def test_decontamination_table(spark):
    texts = [None, "", "clean words only", f"so {ITEM.upper()}", "x\n" + ITEM.replace(" ", "  \n "), ITEM[:30], ITEM + ITEM, "Σ İ " + ITEM]
    bench = items(spark, [(1, ITEM, 5, 5), (1, ITEM, 5, 5), (2, None, 1, 1), (3, "", 1, 1), (4, "short one", 1, 1), (None, ITEM, 1, 1), (5, ITEM + " more", 1, 1)])
    got = sorted((x.doc_id, x.item_id, x.distance) for x in decontaminate.find_contamination(table(spark, texts), bench).collect())
    assert [x[:2] for x in got] == [(i, k) for i in (3, 4, 6, 7) for k in (1, 5)] and all(x[2] == 0 for x in got if x[1] == 1)
    kept = decontaminate.without_contamination(table(spark, texts), bench)
    assert sorted(x.doc_id for x in kept.collect()) == [0, 1, 2, 5] and kept.columns == table(spark, texts).columns
    assert decontaminate.find_contamination(table(spark, texts), bench.limit(0)).count() == 0
    assert decontaminate.find_contamination(table(spark, texts).limit(0), bench).count() == 0


def test_decontamination_short_items(spark):
    """Items with fewer than 20 characters are found as whole words, without edits."""
    texts = ["say SHORT\n one, then", "short ones", "ashort one", "short  one", "shortone", "a short one!", "sh0rt one", "12 is 4", "124"]
    bench = items(spark, [(1, "short one", 1, 1), (2, " 4 ", 1, 1), (3, "  ", 1, 1)])
    got = sorted((x.doc_id, x.item_id, x.distance, x.start, x.end) for x in decontaminate.find_contamination(table(spark, texts), bench).collect())
    assert got == [(0, 1, 0, 4, 14), (3, 1, 0, 0, 10), (5, 1, 0, 2, 11), (7, 2, 0, 6, 7)]
    assert sorted(x.doc_id for x in decontaminate.without_contamination(table(spark, texts), bench).collect()) == [1, 2, 4, 6, 8]


def test_decontamination_table_with_edits(spark):
    """Distances above 0 on a table of documents by items, against the plain edit distance of each pair."""
    draw = random.Random(11)
    words = "the fox dog lazy brown seven wizards hum over jumps quick".split()
    bench = [(i, " ".join(draw.choices(words, k=draw.randint(2, 9)))) for i in range(12)]
    texts = [" ".join(draw.choices(words, k=12)) + " " + edited(draw.choice(bench)[1], n % 8, draw) + " " + " ".join(draw.choices(words, k=5)) for n in range(60)]
    got = {(x.doc_id, x.item_id): x.distance for x in decontaminate.find_contamination(table(spark, texts), items(spark, [(*x, 1, 1) for x in bench])).collect()}
    want = {}
    for n, text in enumerate(texts):
        for i, item in bench:
            if len(item) < decontaminate.LEAST:
                if f" {item} " in f" {text} ":
                    want[n, i] = 0
            elif (d := brute.closest(item, text)) <= int(len(item) * decontaminate.RATE):
                want[n, i] = d
    assert got == want and max(want.values()) > 1


def test_decontamination_blocks(spark):
    bench = items(spark, [(i, f"{ITEM} number {i}", 1, 1) for i in range(20)])
    blocks = [*decontaminate.item_blocks(bench, block_chars=300)]
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(20))


def test_decontamination_query(spark, data):
    docs = read_table(spark, data, "documents").collect()
    bench = [(x.item_id, decontaminate.normal(x.text)) for x in read_table(spark, data, "benchmark").collect()]
    got = {(x.doc_id, x.item_id) for x in registry.op3_decontamination(spark, data).filter("distance = 0").collect()}
    assert got == {(d.doc_id, i) for d in docs for i, t in bench if t in decontaminate.normal(d.text)}


def test_language(spark, data):
    docs = read_table(spark, data, "documents")
    truth = {x.doc_id: x.lang for x in docs.collect()}
    got = registry.op5_language(spark, data).collect()
    assert {x.doc_id: x.held_out for x in got} == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k in truth}
    held = [x for x in got if x.held_out]
    assert sum(x.lang_pred == truth[x.doc_id] for x in held) >= 0.97 * len(held) and all(0 <= x.score <= 1 for x in got)


def test_language_kernel_is_the_plain_one():
    texts = ["aab ba", "abba", "b  a!b", "zz"]
    model = language.Classifier(texts, ["x", "y", "x", "y"])
    rows, _ = language.Scorer(model).kernel_rows(texts)

    def grams(text):
        t = " " + " ".join("".join(x if x.isalpha() else " " for x in text).split()) + " "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    chosen = [0, 2, 1, 3]
    want = [[len(grams(a) & grams(texts[j])) / (len(grams(a)) * len(grams(texts[j]))) ** 0.5 for j in chosen] for a in texts]
    assert np.allclose(rows, want, atol=1e-6)


def test_language_features_are_exact():
    """n-grams that share slots keep their own columns."""
    grams = np.unique(np.random.default_rng(2).integers(0, 1 << 48, 200_000))
    features = language.Features(grams[::2])
    assert len(features.tables) > 1
    asked = np.random.default_rng(3).permutation(grams)
    assert sorted(features.columns(asked, language._slots(asked)).tolist()) == list(range(len(grams[::2])))


SCRIPTS = {
    "zh": "我们今天去学校学习中文和历史因为老师说这个很重要",
    "ja": "わたしたちは今日学校で日本語と歴史を勉強しますこれはとても大切です",
    "el": "σήμερα πηγαίνουμε στο σχολείο για να μάθουμε ελληνικά και ιστορία",
    "ru": "сегодня мы идём в школу учить русский язык и историю",
    "en": "today we go to school to learn the english language and history",
}


def test_language_of_many_scripts(spark):
    """Chinese and Japanese share signs, and none of the scripts is cut out of the alphabet."""
    draw = random.Random(4)
    texts, langs = [], []
    for lang, text in SCRIPTS.items():
        for _ in range(60):
            parts = list(text) if lang in ("zh", "ja") else text.split()
            draw.shuffle(parts)
            texts.append(("" if lang in ("zh", "ja") else " ").join(parts[: draw.randint(6, len(parts))]))
            langs.append(lang)
    docs = table(spark, texts, langs)
    got = language.predictions(docs, language.fit(docs)).filter(language.held_out(F.col("doc_id"))).collect()
    assert len(got) > 60 and sum(x.lang_pred == x.lang for x in got) >= 0.95 * len(got)


def test_language_sample_is_bounded(spark, monkeypatch):
    """Rows without keys, repeated rows and many languages leave no more rows than the bounds say."""
    monkeypatch.setattr(language, "SAMPLE_ALL", 200)
    rows = spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) doc_id", "concat('word', id, ' and more') text", "'en' lang")
    rows = rows.unionByName(spark.range(5000).selectExpr("7L doc_id", "'the same again' text", "'fr' lang"))
    got = language.sampled(rows, sample=50).groupBy("lang").count().collect()
    assert {x.lang: x["count"] for x in got} == {"en": 50, "fr": 1}
    many = spark.range(3000).selectExpr("id doc_id", "concat('text ', id) text", "concat('l', id % 150) lang")
    got = language.sampled(many).groupBy("lang").count().collect()
    assert len(got) == 150 and {x["count"] for x in got} == {1}
    assert len(language.fit(many).langs) == 150


def test_language_odd_tables(spark):
    texts = [*ODD, "the cat and the dog", "le chat et le chien", "123 !?"]
    langs = ["en"] * len(ODD) + ["en", "fr", None]
    docs = table(spark, texts, langs)
    got = {x.doc_id: x for x in language.predictions(docs, language.fit(docs)).collect()}
    assert len(got) == len(texts) and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 3, len(texts) - 1))
    nothing = language.predictions(docs, language.fit(docs.withColumn("lang", docs.lang.substr(99, 1)).filter("false")))
    assert {x.lang_pred for x in nothing.collect()} == {"und"}
    assert language.predictions(docs.limit(0), language.fit(docs)).count() == 0


def test_lines(spark):
    sites = [f"s{i}" for i in range(12)]
    texts = [f"own {i}\nBoiler plate\n\nBoiler plate" for i in range(12)] + ["Boiler plate", None, "", "near\nx", "  \n\t"]
    docs = table(spark, texts, sources=[*sites, None, "s1", "s1", "s1", "s1"])
    got = {x.doc_id: (x.text, x.n_lines, x.n_removed_lines) for x in lines.remove_widespread_lines(docs).collect()}
    assert got[0] == ("own 0\nBoiler plate\n", 4, 1) and got[5] == ("own 5\n", 4, 2)
    assert got[12] == ("", 1, 1) and got[13] == (None, 0, 0) and got[14] == ("", 1, 0) and got[15] == ("near\nx", 2, 0) and got[16] == ("  \n\t", 2, 0)
    assert lines.remove_widespread_lines(docs.limit(0)).count() == 0


def test_lines_of_rows_that_share_a_key(spark):
    """Rows without an id, or with one id, lose their own lines only; copies of one row are treated alike."""
    rows = [(i, "Boiler plate", f"s{i}") for i in range(10, 22)] + [(1, "Boiler plate\nkept", "s1")]
    rows += [(None, "Boiler plate\nb", "a"), (None, "a\nBoiler plate", "a"), (None, "clean\nclean too", "a"), (7, "x\nBoiler plate", "a"), (7, "y\nz", "a"), (7, "x\nBoiler plate", "a")]
    got = [(x.doc_id, x.text, x.n_removed_lines) for x in lines.remove_widespread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()]
    want = [(i, "", 1) for i in range(10, 22)] + [(1, "kept", 1), (None, "Boiler plate\nb", 0), (None, "a", 1), (None, "clean\nclean too", 0), (7, "x", 1), (7, "y\nz", 0), (7, "x", 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_lines_of_a_long_text(spark):
    """200,000 lines, half of which go, take seconds."""
    long = "\n".join("Boiler plate" if i % 2 else f"own {i}" for i in range(200_000))
    docs = spark.createDataFrame([(i, "Boiler plate", f"s{i}") for i in range(12)] + [(99, long, "z")], "doc_id long, text string, source string")
    began = time.perf_counter()
    got = {x.doc_id: x for x in lines.remove_widespread_lines(docs).collect()}
    assert time.perf_counter() - began < 60
    assert got[99].text == "\n".join(f"own {i}" for i in range(0, 200_000, 2)) and got[99].n_removed_lines == 100_000 and got[99].n_lines == 200_000
    assert [got[i].text for i in range(3)] == ["Boiler plate", "", ""]


@pytest.mark.parametrize("spread", [9, 10, 11, 13, 30])
def test_lines_threshold_is_exact(spark, spread):
    docs = table(spark, ["line"] * spread, sources=[f"s{i}" for i in range(spread)])
    removed = sum(x.n_removed_lines for x in lines.remove_widespread_lines(docs).collect())
    assert removed == (spread - 1 if spread >= lines.MIN_SITES else 0)


def test_grams_are_counted_exactly(monkeypatch):
    """Also where many share a slot of the table."""
    kernel = language.StringKernel("abcdefghijklmnopqrstuvwxyz")
    for text in random_texts(40, "abcdefghijklmnopqrstuvwxyz ", 3000, 5) + ["", "a", "ab ab"]:
        grams = kernel.grams(text)
        assert kernel.distinct(grams, language._slots(grams)) == len(set(grams.tolist()))
        assert kernel.distinct(grams, language._slots(grams) % 50) == len(set(grams.tolist()))
