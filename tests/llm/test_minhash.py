import random
import re

import pytest
from basket_spark.llm import minhash
from basket_spark.llm.components import connected_components


def brute(rows, size):
    """Links of all pairs, and the least id that each reaches."""
    sets = {}
    for k, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        n = min(size, len(w))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        base = rng.choice(texts).split() if texts and rng.random() < 0.8 else rng.choices(words, k=rng.choice((3, 5, 8, 40, 120)))
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append(" ".join(base))
    return [(i, t) for i, t in enumerate(rng.sample(texts, n))]


@pytest.mark.parametrize(("seed", "size"), [(1, 4), (2, 5)])
def test_against_all_pairs(spark, seed, size):
    rows = near_copies(seed, 300)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chain_in_one_bucket(spark):
    """Neighbours are alike, the ends are not: the chain is one component all the same."""
    words = [f"v{i}" for i in range(120)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 1)
    assert {r.component_id for r in got} == {0}


def test_odd_rows(odd, none):
    got = minhash.near_duplicates(odd, words=4).collect()
    assert len(got) == odd.count()
    assert all(r.kept for r in got)
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id in (0, 1, 2, 3, 4, 8)} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 8: 1}
    assert [r.component_id for r in got if r.doc_id == 20] == [20, 20]
    kept = minhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id >= 20").collect()) == [20]
    assert kept.where("doc_id IS NULL").count() == 1
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.keep_one_of_each(none).count() == 0


def test_rows_of_one_id_join_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (7, a), (7, b), (9, b), (11, "other words that are not alike")]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_an_empty_row_goes_with_its_id(spark):
    text = "five words that stand here twice"
    rows = [(3, text), (5, text), (5, ""), (6, ""), (None, text), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(3, 2, 3, True), (5, 2, 3, False), (5, 0, 3, False), (6, 0, 6, True), (None, 2, None, True), (None, 0, None, True)], key=repr)


def test_sizes_in_bands_lose_no_like_pair():
    import math

    for n in range(1, 3000):
        for m in (n, -(-n * 80 // 100), n * 100 // 80):
            if min(n, m) * 100 >= max(n, m) * 80:
                assert abs(math.floor(math.log(n) / math.log(1.26)) - math.floor(math.log(m) / math.log(1.26))) <= 1


def test_recall_against_all_pairs(spark, real):
    """Every document of the table: the components are those of all pairs."""
    rows = [(r.doc_id, r.text) for r in real.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(real, words=4).collect()}
    assert got == brute(rows, 4)
    assert len({c for _, c in got.values()}) < len(rows)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root if find(k) != k}
