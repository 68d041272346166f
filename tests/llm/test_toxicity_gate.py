"""The test that spares tokens the decoder, against all readings, and forms of hiding beyond single tokens."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from usertide.llm import toxicity


def readings(token):
    return {"".join(r) for r in itertools.product(*([out for out, _ in steps] for steps in toxicity.lattice(token)))}


def test_no_reading_has_a_word_that_the_skeleton_lacks():
    random.seed(3)
    for _ in range(400):
        token = "".join(random.choice("iildo0t1|!s$5. -*'a@4é(") for _ in range(random.randint(1, 7))).strip() or "x"
        held = toxicity.skeletons([token])[0]
        for reading in readings(token):
            for word in toxicity.WORD.findall(reading):
                assert all(toxicity.skeletons([p.rstrip("$")])[0] in held for p in toxicity.parts(word)), (token, reading)


def test_parts_within_other_parts_need_no_test_of_their_own():
    test = toxicity.may_hold(["idiot$", "idio", "scum$"])
    assert test(["an", "1d10", "idi", "s-c.u_m", "xi|!dd1100ty", "i d i o t", ""]).tolist() == [False, True, False, True, True, True, False]
    assert test([]).tolist() == [] and toxicity.may_hold([])(["idiot"]).tolist() == [False]


def test_spared_tokens_change_no_score(spark, docs):
    """All texts of the given documents score as if every token were decoded."""
    model = toxicity.language_model(docs)
    texts = pa.array([r["text"] for r in docs.select("text").collect()], pa.string())
    row, code, vocabulary = toxicity.tokens(texts)
    often = sorted({vocabulary[c] for c in np.bincount(code).argsort()[-400:] if len(vocabulary[c]) > 4})[:60]
    evidence = {p: 0.5 for w in often for p in toxicity.parts(w)[:2]}
    reader = toxicity.Reader(model, toxicity.strong(evidence))
    every = lambda tokens: np.ones(len(tokens), bool)
    got, want = toxicity.scores(texts, reader, toxicity.may_hold(evidence)), toxicity.scores(texts, reader, every)
    assert (want > 0).sum() > 50 and got.tolist() == want.tolist()


@pytest.fixture(scope="module")
def hidden(spark):
    filler = "you are an old man and that is what we all think of them when they say so the quick brown fox jumps over lazy dogs".split()
    plain = [" ".join(filler[(i * 7 + k * (1 + i % 5)) % 25] for k in range(20)) + f" {('idiot', 'toilet')[i % 2]}" for i in range(300)]
    model = toxicity.language_model(spark.createDataFrame([(t,) for t in plain], "text string"))
    evidence = {"idiot$": 0.9, "toilet$": 0.9}

    def run(texts):
        return toxicity.scores(pa.array(texts, pa.string()), toxicity.Reader(model, toxicity.strong(evidence)), toxicity.may_hold(evidence)).tolist()

    return run


def test_chunks_and_words_without_letters_are_read(hidden):
    bad = ["you id iot", "an i di ot", "i.d iot !", "70!1€7!", "+0|1€7", "7 0 1 1 3 7", "so 1 d 1 0 t so"]
    assert [t for t, s in zip(bad, hidden(bad), strict=True) if s == 0] == []
    good = ["an old man is so", "2024-05-17 10:30", "+49 171 2345678", "1 2 3 4 5", "7.50 €", None, ""]
    assert hidden(good) == [0.0] * len(good)


def test_wilson_bound_as_a_column(spark):
    rows = [(t, c) for t in (3, 4, 10, 500) for c in (0, 1, 7, 4000)]
    df = spark.createDataFrame(rows, "t long, c long")
    got = {(r["t"], r["c"]): r["b"] for r in df.select("t", "c", toxicity.least_bound(df["t"], df["c"]).alias("b")).collect()}
    assert all(got[r] == pytest.approx(toxicity.bound(*r)) for r in rows)
