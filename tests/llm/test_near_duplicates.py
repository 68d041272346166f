import random
from itertools import combinations

import numpy as np
from usertide.llm.components import components
from usertide.llm.near_duplicates import BINS, band_keys, near_duplicates, shingles, signature


def brute_force(rows):
    """Smallest reachable id by comparing all pairs."""
    sets = {i: set(shingles(t).tolist()) for i, t in rows if i is not None}
    label = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = label[a], label[b]
            if x != y:
                label = {i: min(x, y) if v in (x, y) else v for i, v in label.items()}
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_equals_brute_force(spark, docs):
    assert result(near_duplicates(docs)) == brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_chains_of_edits_at_the_threshold(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for group in range(6):
        text = random.choices(words, k=60)
        for _ in range(12):
            rows.append((n, " ".join(text)))
            n += 1
            text = list(text)
            for _ in range(random.choice([1, 1, 2, 3])):
                text[random.randrange(60)] = random.choice(words)
    rows += [(n, rows[0][1].upper()), (n + 1, "one two"), (n + 2, "ONE\ttwo"), (n + 3, "one two three")]
    got = result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert got == brute_force(rows)


def test_odd_rows(spark, odd_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r["doc_id"]: (r["n_shingles"] > 0, r["component_id"], r["kept"]) for r in rows}
    assert got[1] == (False, 1, True) and got[2] == (False, 2, True) and got[3] == (False, 3, True)
    assert got[5] == (True, 5, True) and got[6] == (True, 5, False)
    assert got[None] == (True, None, True) and got[7] == (True, 7, True)
    assert near_duplicates(odd_docs.limit(0)).collect() == []


def test_signatures_estimate_similarity():
    random.seed(1)
    for size in (3, 20, 500):
        agree = []
        for _ in range(40):
            a = np.unique(np.array([random.getrandbits(64) for _ in range(size)], np.uint64))
            b = np.unique(np.concatenate([a[: size * 4 // 5 + 1], np.array([random.getrandbits(64)], np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((signature(a) == signature(b)).mean() - true)
        assert abs(np.mean(agree)) < 0.06
    assert len(band_keys(signature(np.array([5], np.uint64)))) * 4 == BINS


def test_components_of_paths_stars_loops_and_text(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, None), (301, 300), (300, 301)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {k: 100 for k in range(100, 140)} | {300: 300, 301: 300}
    text = spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")
    assert {r["component"] for r in components(text).collect()} == {"a"}
    assert components(text.limit(0)).collect() == []
