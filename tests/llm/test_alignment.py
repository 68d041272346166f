"""Token alignment against a plain walk over shared byte ends."""

import hashlib
import json
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer
from usertide.llm import alignment
from usertide.llm.queries import QUERIES

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    # The public rule of byte-level vocabularies: bytes that print stand for themselves, the others follow from U+0100.
    printing = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160) and (b < 127 or b > 160) and b != 173]
    others = [b for b in range(256) if b not in printing]
    letter = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}

    def cut(text):
        """(A id, end) and (B id, end) of space and text, or nothing."""
        if not text:
            return [], []
        want = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids
        a_bytes = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids]
        b_ids = b.encode(text)
        b_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return [], []
        return list(zip(ids, np.cumsum([len(x) for x in a_bytes]))), list(zip(b_ids, np.cumsum([len(x) for x in b_bytes])))

    return cut


def walked(a, b):
    """The groups between shared ends: lists of A ids and of B ids."""
    shared = {e for _, e in a} & {e for _, e in b}

    def cut(side):
        lists = [[]]
        for i, e in side:
            lists[-1].append(i)
            if e in shared:
                lists.append([])
        return lists[:-1]

    return list(zip(cut(a), cut(b)))


def expected(texts, cut):
    found = [walked(*cut(t)) for t in texts]
    held = Counter(p for groups in found for p in {(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for groups in found:
        links = [(x, y) for a, b in groups for x in a for y in b]
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        rows.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_walk(spark, sf_dir, docs, plain):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 60_000]
    assert len(short) == len(rows)
    want = sorted((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows], plain)))
    got = sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in QUERIES["op11_token_alignment"](spark, sf_dir).collect())
    assert got == want


ODD = [
    None, "", " ", "a", "  two  spaces\n\n\nand lines\t\t", "日本語のテキスト 🎉🎉 ÿ", "<|endoftext|> and <s> </s> <unk> <0x41>", "x" * 3000, " " * 5000 + "end",
    "▁ underline", "tab\tand space", "same text twice", "same text twice", "é combined ﬁ ligature", "0123456789" * 50, "a\u0000b",
]


def test_odd_texts(spark, plain):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "y"), (5, ODD[5], "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, links string").withColumn("n_a", F.lit("old"))
    got = alignment.aligned_with_counts(df, A_PATH, B_PATH).collect()
    want = expected([t for _, t, _ in rows], plain)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r["doc_id"], r["text"], *(r[c] for c in COLUMNS)) for r in got), key=key) == sorted(((i, t, *e) for (i, t, _), e in zip(rows, want)), key=key)
    assert alignment.aligned_with_counts(df.limit(0), A_PATH, B_PATH).collect() == []


def test_spans_give_the_groups(spark, plain):
    text = "Ein längerer Text, mit Wörtern und 1234 Zahlen."
    row = alignment.aligned(spark.createDataFrame([(1, text)], "doc_id long, text string"), A_PATH, B_PATH, spans=True).first()
    groups, i, j = [], 0, 0
    for a, b in zip(row["a_cuts"], row["b_cuts"]):
        groups.append((row["a_ids"][i:a], row["b_ids"][j:b]))
        i, j = a, b
    assert groups == walked(*plain(text)) and len(groups) == row["n_groups"]
    pairs = Counter((x, y) for a, b in groups for x in a for y in b)
    assert {divmod(p["pair"], alignment.SPAN): p["times"] for p in row["links"]} == dict(pairs)


def test_long_texts_are_entered_at_shared_ends(monkeypatch, docs, plain):
    texts = [t["text"] for t in docs.select("text").collect() if t["text"]]
    long = " ".join(sorted(texts, key=len)[-5:])
    both = alignment.tokenizers(*(open(p, "rb").read() for p in (A_PATH, B_PATH)))
    a, b = (np.array([i for i, _ in x]) for x in plain(long))
    ends = [np.array([e for _, e in x]) for x in plain(long)]
    start, stop, b_start = alignment.lanes(*ends, np.array([0, len(a)]), np.array([0, len(b)]))
    assert len(start) > len(a) // alignment.LANE - 3 and (stop - start).max() <= 3 * alignment.LANE
    monkeypatch.setattr(alignment, "LANE", 4)
    monkeypatch.setattr(alignment, "LINKS", 3)
    groups = walked(*plain(long))
    columns = alignment.align_texts(both, [long, None, long[:9]], False)
    assert columns[2].to_pylist()[0] == len(groups) and columns[5].to_pylist()[1] == []
    pairs = Counter((x, y) for p, q in groups for x in p for y in q)
    assert {divmod(p["pair"], alignment.SPAN): p["times"] for p in columns[5].to_pylist()[0]} == dict(pairs)


def test_rare_pairs_are_joined_when_few_are_broadcast(spark, docs, monkeypatch):
    some = docs.select("doc_id", "text").where("length(text) < 3000")
    want = sorted(map(tuple, alignment.aligned_with_counts(some, A_PATH, B_PATH, keep=["doc_id"]).collect()))
    monkeypatch.setattr(alignment, "HOT", 20)
    assert sorted(map(tuple, alignment.aligned_with_counts(some, A_PATH, B_PATH, keep=["doc_id"]).collect())) == want


def test_words_are_encoded_once_and_give_the_same_tokens(monkeypatch):
    both = alignment.Tokenizers(*(Path(p).read_bytes() for p in (A_PATH, B_PATH)))
    assert both.by_words
    rng = random.Random(3)
    signs = " ab1.'s \u0301é\n\t\u3000\x1c\x00中🙂,"
    texts = ["".join(rng.choices(signs, k=rng.randrange(1, 60))) for _ in range(500)]
    texts += ["<|endoftext|> a  b", "don't stop, don't stop", " ", "  x ", "a b ", "<s> </s> <0x41> <unk>", None, "", "one two " * 4000 + "one"]
    given, lists = [], both.lists
    monkeypatch.setattr(both, "lists", lambda words: given.extend(words) or lists(words))
    found = alignment.align_texts(both, texts, True)
    assert sum("one" in t for t in given) == 1 and sum(map(len, given)) < sum(len(t or "") for t in texts) / 2  # not whole texts
    marked = alignment.align_texts(both, ["a▁b ▁c d▁ e", "f g"], True)
    both.by_words = False
    for column, whole in zip(marked, alignment.align_texts(both, ["a▁b ▁c d▁ e", "f g"], True)):
        assert column.equals(whole)
    for column, whole in zip(found, alignment.align_texts(both, texts, True)):
        assert column.equals(whole)


def test_tokenizers_that_join_words_read_whole_texts():
    a, b = (Path(p).read_bytes() for p in (A_PATH, B_PATH))
    plain = json.loads(a)
    assert alignment.separate_words(plain, b)
    assert not alignment.separate_words(plain | {"normalizer": {"type": "NFC"}}, b)
    assert not alignment.separate_words(plain | {"pre_tokenizer": None}, b)
    model = sentencepiece_model_pb2.ModelProto.FromString(b)
    model.pieces[400].piece = "a▁b"
    assert not alignment.separate_words(plain, model.SerializeToString())
