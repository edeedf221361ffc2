import random
import re
from zlib import crc32

import numpy as np
import pytest
from basket_spark.llm import quality

from .conftest import ODD

CLEAN, NOISE = "the and of to is with was for river stone house garden winter morning road letter".split(), "win cash now click free deal buy here xx offer".split()


def made(spark, n=400, wrong=0):
    """Clean and noisy texts, labelled; every third has no label."""
    rng, docs, labels = random.Random(1), [], []
    for i in range(n):
        good = rng.random() < 0.6
        words = rng.choices(CLEAN if good else NOISE, k=rng.randrange(20, 80))
        docs.append((i, " ".join(words) if good else " !! ".join(w.upper() for w in words), good))
        if i % 3:
            labels.append((i, int(good) if i >= wrong else 1 - int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string, good boolean"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_words_are_found_as_a_pattern_finds_them():
    texts = [(t or "").encode() for t in ODD] + ["Ein Bär, 12,5 km!! x".encode(), b""]
    ends = np.cumsum([len(t) for t in texts])
    buckets, owner = quality.word_buckets(np.frombuffer(b"".join(texts), np.uint8), ends)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x20\x09-\x0D]", t)]
    assert owner.tolist() == [i for i, _ in want]
    assert buckets.tolist() == [quality._hash(w) >> 64 - 15 for _, w in want]


def test_vectors_are_sums_over_all_places(spark):
    texts = ["a b c a b", "b a", None, "", "c"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    index, want = quality.index_vectors().astype(int), {}
    bucket = lambda w: quality._hash(w.encode()) >> 49
    for t in texts:
        words = (t or "").split()
        for i, w in enumerate(words):
            for j, v in enumerate(words):
                if 0 < abs(i - j) <= quality.WINDOW:
                    want[bucket(w)] = want.get(bucket(w), 0) + index[bucket(v)]
    got = {r[0]: list(r[1:]) for r in quality.word_sums(docs).collect()}
    assert got == {k: v.tolist() for k, v in want.items()}


def test_a_long_text_is_pooled_whole(monkeypatch):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    text = " ".join(rng.choice(CLEAN, 500)).encode()
    whole = quality.pooled([text, b"", None, b"one"], vectors)
    monkeypatch.setattr(quality, "CHUNK", 100)
    cut = quality.pooled([text, b"", None, b"one"], vectors)
    assert np.allclose(np.delete(whole, 2 * quality.DIMENSIONS, 1), np.delete(cut, 2 * quality.DIMENSIONS, 1))
    assert not whole[1:3].any()
    assert whole[0, -1] == pytest.approx(np.log1p(500))


def test_held_out_rows_of_made_texts(spark):
    docs, labels = made(spark)
    got = quality.score(docs, quality.fit(docs, labels)).join(docs, "doc_id").collect()
    assert len(got) == 400
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all((r.predicted == 1) == r.good for r in got)


def test_held_out_rows_of_the_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, quality.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert len(rows) > 60


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    docs, labels = made(spark)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one, two = (sorted((r.doc_id, r.score) for r in quality.score(docs, quality.fit(docs, t)).collect()) for t in (labels, turned))
    assert one == two


def test_probabilities_are_calibrated(spark):
    """Where a fifth of the labels is wrong the mean score is near the share of good ones."""
    docs, labels = made(spark, 900, wrong=0)
    noisy = labels.selectExpr("doc_id", "CASE WHEN pmod(hash(doc_id), 5) = 0 THEN 1 - quality ELSE quality END AS quality")
    rows = quality.score(docs, quality.fit(docs, noisy)).join(docs, "doc_id").collect()
    assert np.mean([r.score for r in rows if r.good]) == pytest.approx(0.8, abs=0.1)
    assert np.mean([r.score for r in rows if not r.good]) == pytest.approx(0.2, abs=0.1)


def test_temperature_undoes_a_steep_logit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = quality.train(x, y, np.ones(3000))
    p = net.probability(x)
    assert abs(np.corrcoef(net.logit(x), x[:, 0])[0, 1]) > 0.85
    assert p[p > 0.7].mean() == pytest.approx(y[p > 0.7].mean(), abs=0.05)


def test_odd_rows(spark, odd, none):
    docs, labels = made(spark, 120)
    model = quality.fit(docs, labels)
    got = quality.score(odd.withColumn("score", odd.doc_id).withColumn("held_out", odd.text), model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2, 3)}) == 1  # null, empty, blanks
    assert quality.score(none, model).count() == 0


def test_odd_labels(spark, none):
    docs, labels = made(spark, 60)
    both = labels.selectExpr("doc_id", "1 - quality AS quality").union(labels)
    for said, want in ((labels.limit(0), 0.5), (both, 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.selectExpr("CAST(NULL AS LONG) AS doc_id", "quality"), 0.5)):
        assert {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, said)).collect()} == {want}
    assert {r.score for r in quality.score(docs, quality.fit(none, labels)).collect()} == {0.5}


def test_the_sample_is_bounded(spark):
    docs, labels = made(spark, 200)
    twice = labels.union(labels)
    chosen, counts = quality._sample(twice, "doc_id", "quality", 10)
    assert sorted(r.quality for r in chosen.collect()) == [0] * 10 + [1] * 10
    assert sum(counts.values()) == labels.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 != 2").count()
