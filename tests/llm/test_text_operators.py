import hashlib
import re
import struct
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from usertide.llm import bpe, decontamination, language_id, token_lengths, toxicity
from usertide.llm.queries import QUERIES, rank_file

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(rank_file())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def contaminated_by_brute_force(text, items):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words, hit, names = WORD.findall(lower(text)), set(), set()
    for item, test in items:
        test = WORD.findall(lower(test))
        size = min(13, len(test))
        windows = {tuple(test[i : i + size]) for i in range(len(test) - size + 1)} if test else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                names.add(str(item))
    return len(words), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block", [200_000, 7])
def test_contamination_equals_brute_force(spark, block):
    alphabet = "a b c d É 7".split()
    state, texts = 1, []
    for k in range(60):
        words = []
        for _ in range(5 + k * 2):
            state = state * 1103515245 + 12345 & 0x7FFFFFFF
            words.append(alphabet[state >> 16 & 1 if k % 3 else (state >> 16) % 6])
        texts.append(("- ".join(words) if k % 2 else " ".join(words)).upper() if k % 5 == 0 else " ".join(words))
    items = [(i, t) for i, t in enumerate(texts[:12])] + [(90, "b a É"), (91, None), (92, "--"), (93, "a"), (94, "b a É")]
    docs = [(i, t) for i, t in enumerate(texts + ["", "zz yy", "q B A é q"])] + [(500, None)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), tests, block=block).collect()
    for r in got:
        want = contaminated_by_brute_force(dict(docs)[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == want


def test_contamination_of_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontamination.contamination(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and not any(r["contaminated"] for r in rows)
    assert {r["doc_id"]: r["n_words"] for r in rows}[5] == 40_001
    tests = spark.createDataFrame([(1, "w1 w2 w3"), (None, "a"), (2, "x" * 3000)], "item_id long, text string")
    rows = decontamination.contamination(odd_docs, tests).collect()
    assert {r["doc_id"]: tuple(r["items"]) for r in rows} == {1: (), 2: (), 3: (), 4: (), 5: ("1", "2"), 6: ("1", "2"), None: (), 7: (), 8: ()}
    assert decontamination.contamination(odd_docs.limit(0), tests).collect() == []


def test_language_on_held_out_rows(spark, docs, sf_dir):
    rows = QUERIES["op1_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert [r for r in held if not r["held_out"]] == []
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held) > 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_backoff_for_unseen_words():
    model = language_id.Model(["x", "y"], {"abc": {"x": 5}}, {"qu": {"x": 9, "y": 1}, "q": {"y": 9}, "z": {"y": 3}})
    assert model.word("abc").argmax() == 0
    assert model.word("quz").argmax() == 0  # a known pair comes before single letters
    assert model.word("zq").argmax() == 1
    assert model.word("ñ").tolist() == [0.0, 0.0]


def test_rare_language_beside_a_large_one_keeps_its_words(spark):
    letters = "abcdefghijklmnopqrst"
    large = ["".join(letters[i // 20**k % 20] for k in range(5)) for i in range(7, 20**5, 16)]
    rows = [(i, " ".join(large[i * 80 : i * 80 + 80] * 2), "a") for i in range(len(large) // 80)]
    seen = ["a" + "".join(letters[(p * i + q) % 20] for p, q in ((3, 0), (7, 1), (11, 2), (1, 0))) for i in range(20)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    learnt, tried = ([i for i in range(100_000, 100_100) if held(i) is x][:5] for x in (False, True))
    rare = [(i, " ".join(seen[k * 4 : k * 4 + 4]), "b") for ids in (learnt, tried) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows + rare, "doc_id long, text string, lang string").repartition(8)
    got = {r["doc_id"]: r for r in language_id.language_id(docs).where("doc_id >= 100000").collect()}
    assert len(large) > 190_000 and [got[i]["lang_pred"] for i in tried] == ["b"] * 5
    assert min(got[i]["lang_score"] for i in tried) > 0.999  # each word is some twelve times likelier in b


def letter_runs(text):
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def test_numerals_and_signs_are_no_letters(spark):
    rows = [(i, "one two three four", "en") for i in range(20)] + [(100 + i, t, None) for i, t in enumerate(["\u00b2", "\u00bd \u2460", "\u2167", "12_3", "\u00b2one"])]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + i] for i in range(5)] == ["und"] * 4 + ["en"]


@pytest.mark.parametrize("hot", [0, 40, 10**6])
def test_joined_words_score_as_broadcast_ones(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(language_id, "HOT", hot)
    monkeypatch.setattr(language_id, "COPIED", hot)
    some = docs.select("doc_id", "text", "lang").limit(150)
    some = some.union(some.limit(30)).union(spark.createDataFrame([(-1, "zzzqxj wörterbuchartig 日本語", None)], some.schema))
    rows = language_id.language_id(some).collect()
    words, grams = {}, {}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and not r["held_out"]:
            for w in letter_runs(r["text"]):
                words.setdefault(w, Counter())[r["lang"]] += 1
                for g in (g for n in range(1, 6) for g in language_id.grams(w, n)):
                    grams.setdefault(g, Counter())[r["lang"]] += 1
    model = language_id.Model(sorted({x for c in words.values() for x in c}), words, grams)
    assert len(rows) == 181
    for r in rows:
        parts = letter_runs(r["text"] or "")
        total = np.sum([model.word(w) for w in parts], axis=0, dtype=np.float64)
        share = np.exp(total - total.max()) / np.exp(total - total.max()).sum() if parts else [0.0]
        assert r["lang_pred"] == (model.langs[total.argmax()] if parts else "und")
        assert r["lang_score"] == pytest.approx(max(share), abs=1e-2)


def test_language_of_odd_rows(spark, odd_docs):
    rows = language_id.language_id(odd_docs).collect()
    got = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert len(rows) == odd_docs.count() and [got[i] for i in (1, 2, 3, 4)] == ["und"] * 4
    assert all(0 <= r["lang_score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in language_id.language_id(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.language_id(odd_docs.limit(0)).collect() == []


def test_hidden_words_are_restored(spark, docs):
    rows = spark.createDataFrame([(f"the idiot and the stupid moron said {w}",) for w in ("trash", "clown", "scum")] * 50, "text string")
    model = toxicity.language_model(rows)
    read = lambda t: toxicity.restore(t, model)
    assert read("such an 1d10t and $tup1d") == "such an idiot and stupid"
    assert read("i d i o t") == "idiot" and read("c.l.o.w.n, tr@sh!") == "clown, trash!" and read("moooron") == "moron"
    assert read("Version 2.0 of 1999") == "version 2.0 of 1999"
    assert toxicity.language_model(rows.limit(0)).shape == (toxicity.SIZE,) * 3


def test_toxic_documents_are_found(spark):
    bad, filler = ("idiot", "scum", "loser"), "the quick brown fox jumps over lazy dogs and runs far away again losenge".split()
    rows = [(i, " ".join(filler[(i * 7 + k) % 14] for k in range(20)) + (f" {bad[i % 3]} {bad[(i + 1) % 3]}" if i % 6 == 0 else ""), int(i % 6 == 0)) for i in range(1200)]
    hidden = {6: "you 1d10t l0ser", 12: "s c u m and looooser"}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(10_000 + i, t) for i, t in hidden.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i]["toxicity_predicted"] == x for i, _, x in rows if i in held)
    assert [i for i in got if got[i]["held_out"]] == [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert got[10_006]["toxicity_predicted"] == got[10_012]["toxicity_predicted"] == 1


@pytest.fixture(scope="module")
def hidden_scores(spark):
    """Scores of texts by a model of clean and toxic ones in which ``idiot`` and ``scum`` are the toxic words."""
    filler = "you are an old man and that is what we all think of them when they say so the quick brown fox jumps over lazy dogs".split()
    rows = [(i, " ".join(filler[(i * 7 + k * (1 + i % 5)) % 25] for k in range(20)) + (f" {('idiot', 'scum')[i % 12 // 6]}" if i % 6 == 0 else ""), int(i % 6 == 0)) for i in range(1500)]
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")

    def run(texts):
        docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r["doc_id"]: r["toxicity_score"] for r in toxicity.toxicity(docs, labels).collect()}
        return [got[10_000 + i] for i in range(len(texts))]

    return run


def test_hidden_words_of_any_length_score(hidden_scores):
    sentence = "you are an idiot and that is what we all think of them"
    spaced = " ".join(sentence.replace(" ", ""))
    dotted = ".".join(["quick", "brown", "fox", "jumps", "over", "lazy", "dogs", "1d10t"] * 3)
    bad = [spaced, spaced.replace("i d i o t ", "") + " " + " ".join("scum"), "idi" + "o" * 80 + "t", ".".join("idi" + "o" * 60 + "t"), dotted, "-".join(["brown"] * 15) + "-1d10t"]
    good = [" ".join("youareanoldmanandthatiswhatweallthinkofthem"), "a" * 100, "quick." * 20, "x" * 70 + "1"]
    got = hidden_scores(bad + good)
    assert [t for t, s in zip(bad, got, strict=False) if s < toxicity.THRESHOLD] == []
    assert [t for t, s in zip(good, got[len(bad):], strict=True) if s >= toxicity.THRESHOLD] == []


def test_every_form_of_the_lattice_scores(hidden_scores):
    bad = ["so s(um they", "an !d1ot.", "(!d1ot!)", "1 d 1 0 t", "an i d 1 o t !", "1.d.1.0.t", "i - d - 1 - 0 - t", "an iidiot", "iddiiott", "(scum", "idi-ot", "(idiot!)", "5cum!", "$(um"]
    good = ["(see that)", "well-known don't they!", "1 2 3 4 a 5", "x + y", "all see books", "| a | b |", "f(x) + 1"]
    got = hidden_scores(bad + good)
    assert [t for t, s in zip(bad, got, strict=False) if s < toxicity.THRESHOLD] == []
    assert [t for t, s in zip(good, got[len(bad):], strict=True) if s >= toxicity.THRESHOLD] == []


def test_toxicity_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, None), (None, 1), (7, 0), (7, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["toxicity_score"] <= 1 for r in rows)
    assert all(r["toxicity_score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert {r["toxicity_predicted"] for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity(odd_docs.limit(0), labels).collect() == []


def test_evidence_is_explained_once():
    holds = {"loser$": set(range(100)), "lose": set(range(100)), "noise$": set(range(5)), "real$": set(range(200, 230))}
    clean = {"loser$": 0, "lose": 30, "noise$": 0, "real$": 0}
    assert set(toxicity.explained(holds, clean)) == {"loser$", "real$"}


def test_bpe_equals_the_library(spark, docs, ranks, library):
    odd = ["a" * 3000 + " b", "  x\n\n\n y  ", "\u0085z 'S it's we'll 日本語 🎉🎉", None, "", " \n" * 200, "x\x00y", "a\x1cb᠎​ 　d", "ab" * 2000]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 10**6)), "doc_id long, text string"))
    coded = bpe.decode(bpe.encode(rows, ranks, public_tokenizers.PATTERN), ranks).withColumn("packed", bpe.packed("ids"))
    for r in coded.collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert r["ids"] == ids and bytes(r["decoded"]) == (r["text"] or "").encode()
        assert bytes(r["packed"]) == struct.pack(f"<{len(ids)}I", *ids)
    assert bpe.encode(rows.limit(0), ranks, public_tokenizers.PATTERN).collect() == []


def test_the_fold_makes_the_same_merges(spark, ranks, library):
    texts = ["Tokenization of unbelievable words, naïveté 123", "", "aaaa bbbbbb\n\n x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r["ids"] for r in bpe.encode_by_functions(rows, ranks, public_tokenizers.PATTERN).collect()] == [library.encode_ordinary(t) for t in texts]


def test_merges_of_long_words_are_the_same(ranks):
    for word in (b"ab" * 120, "größenwahn".encode() * 20, bytes(range(256))):
        found, word_ids = [word[i : i + 1] for i in range(len(word))], bpe.merged_ids(word, ranks)
        while True:
            pairs = [(ranks.get(a + b, bpe.NONE), i) for i, (a, b) in enumerate(zip(found, found[1:], strict=False))]
            low, at = min(pairs, default=(bpe.NONE, 0))
            if low == bpe.NONE:
                break
            found[at : at + 2] = [found[at] + found[at + 1]]
        assert word_ids == [ranks[p] for p in found]


def test_digest_query(spark, docs, sf_dir, library):
    want = {r["doc_id"]: library.encode_ordinary(r["text"] or "") for r in docs.collect()}
    for r in QUERIES["op10_byte_bpe"](spark, sf_dir).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_token_histogram(spark, docs, odd_docs, ranks, library):
    counts = [len(library.encode_ordinary(r["text"] or "")) for r in docs.select("text").union(odd_docs.select("text")).collect()]
    lengths = token_lengths.lengths(docs.select("text").union(odd_docs.select("text")), ranks, public_tokenizers.PATTERN)
    table = token_lengths.histogram(lengths).cache()
    for r in table.collect():
        at = r["length"]
        assert r["n_docs"] == counts.count(at) and r["docs_longer"] == sum(c > at for c in counts)
        assert r["docs_up_to"] == sum(c <= at for c in counts) and r["tokens_up_to"] == sum(c for c in counts if c <= at)
        assert r["tokens_truncated"] == sum(min(c, at) for c in counts)
    for r in token_lengths.at_limits(table, [0, 100, 1000, 10**7]).collect():
        assert r["tokens"] == sum(min(c, r["limit"]) for c in counts) and r["docs_truncated"] == sum(c > r["limit"] for c in counts)
    assert token_lengths.quantile(table, 0.5) == sorted(counts)[(len(counts) - 1) // 2]
    empty = token_lengths.histogram(lengths.limit(0))
    assert empty.collect() == [] and token_lengths.quantile(empty, 0.5) is None


def test_encoding_and_decoding_share_a_worker(spark, ranks, library):
    texts = ["Hello, world  again", "", None, "naïve 中文 🙂 \x00", "x" * 300, " a" * 700]
    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts * 3)], "doc_id long, text string, ids string").repartition(2)
    found = bpe.encode_and_decode(rows, ranks, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    for r in found.collect():
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode_and_decode(rows.limit(0), ranks, public_tokenizers.PATTERN).collect() == []
    docs = rows.select("doc_id", "text", *[F.lit("x").alias(c) for c in ("lang", "source")])
    plan = corpus_pipeline.encode(spark, docs, None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
