import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from basket_spark.llm import resample

from .conftest import DOCS


def features(text, n_max):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, n_max + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, n_max=1, percent=10):
    """(doc_id, n_features, weight, score, rank), every substring's CRC taken by itself."""
    bucket = lambda f: crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x, n_max)[1]))
    for x in target:
        t.update(map(bucket, features(x, n_max)[1]))
    n_s, n_t, out = sum(s.values()), sum(t.values()), []
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    for k, x in docs:
        words, own = features(x, n_max)
        h = int(sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in own)
        out.append([len(words) >= 20, k, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fits = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1], r[2]))
    ranks = {id(r): i for i, r in enumerate(fits[: len(fits) * percent // 100], 1)}
    return sorted([(*r[1:], ranks.get(id(r))) for r in out], key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_crcs_of_all_runs():
    rng = random.Random(5)
    for n_words in (0, 1, 2, 40):
        words = [bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.choice([1, 3, 63, 64, 65, 5000]))) for _ in range(n_words)]
        prefix = resample.PrefixCrcs(words)
        for n in (1, 2, 3, 7):
            assert prefix.ngrams(n).tolist() == [crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]


def test_shift_is_that_of_zero_bytes():
    lengths = np.array([0, 1, 63, 64, 1000, 70000, 1 << 20])
    one = np.full(len(lengths), crc32(b"start"), np.uint32)
    want = [crc32(b"start" + bytes(n)) ^ crc32(bytes(n)) for n in lengths]
    assert resample.shift(one, lengths).tolist() == want


@pytest.mark.parametrize("n_max", [1, 3])
def test_pieces_of_long_texts(monkeypatch, n_max):
    text = " ".join(f"w{i % 17}x{i}" for i in range(100))
    want = sorted(crc32(f.encode()) % 10000 for f in features(text, n_max)[1])
    for size in (7, 100, 101):
        monkeypatch.setattr(resample, "WORDS", size)
        assert sorted(np.concatenate(list(resample.buckets_of(text.encode(), n_max))).tolist()) == want


@pytest.mark.parametrize("n_max", [1, 2])
def test_whole_table_against_brute_force(spark, real, n_max):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = rows(resample.resample(real, target, n_max=n_max))
    assert got == brute([(r.doc_id, r.text) for r in real.collect()], [r.text for r in target.collect()], n_max)
    drawn = sorted(r[4] for r in got if r[4] is not None)
    assert drawn == list(range(1, len(drawn) + 1)) and drawn


def test_odd_rows(spark, odd, none):
    """Nulls, repeats and ids twice; ties go by id, then by features; all are ranked at 100 %."""
    long = " ".join(f"Word{i}" for i in range(30))
    more = spark.createDataFrame([(7, long, None, None, None), (7, long, None, None, None), (7, long + " word1", None, None, None), (None, long, None, None, None), (None, None, None, None, None)], DOCS)
    docs = odd.unionByName(more, allowMissingColumns=True)
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    target = spark.createDataFrame([("word3 word4", 1), (None, 2)], "text string, n int")
    for percent in (10, 50, 100):
        assert rows(resample.resample(docs, target, percent=percent)) == brute(plain, ["word3 word4"], percent=percent)
    assert rows(resample.resample(none, target)) == []
    assert rows(resample.resample(docs, target.limit(0))) == brute(plain, [])
