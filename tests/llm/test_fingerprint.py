import hashlib
import random

import pytest
from basket_spark.llm import fingerprint as f


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(2))
        p, q = f.Prefixes.of(a), f.Prefixes.of(b)
        for _ in range(40):
            i, j, n = rng.randrange(len(a)), rng.randrange(len(b)), rng.randrange(0, 12)
            assert p.equal(i, q, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n])
            same = 0
            while i + same < len(a) and j + same < len(b) and a[i + same] == b[j + same]:
                same += 1
            assert p.extension(i, q, j) == same


def test_edited_from_the_arrays_of_both():
    a, b = "Grüße aus Köln 😀 und mehr", "zweiter Text"
    p = f.Prefixes.of(a).edited(10, f.Prefixes.of(b), 5)
    assert p.fingerprint() == f.Prefixes.of(a[:10] + b[:5]).fingerprint()


def test_likeness():
    mark = lambda t: f.Prefixes.of(t).fingerprint()
    text = "".join(random.Random(2).choices("abcdefgh ", k=5000))
    assert f.likeness(mark(text), mark(text)) == 1
    assert f.likeness(mark(""), mark("")) == 1
    assert f.likeness(mark(""), mark("a")) == 0
    assert 0.7 < f.likeness(mark(text), mark(text[:3750] + "x" * 1250)) <= 0.75
    assert 0.45 < f.likeness(mark(text), mark(text[:2500])) <= 0.5
    assert 0.95 < f.likeness(mark(text), mark(text[:2000] + "!" + text[2001:])) < 1
    assert 0.95 < f.likeness(mark(text), mark(text[1:])) < 1
    assert 0.95 < f.likeness(mark("A new first line.\n" + text), mark(text)) < 1
    assert f.likeness(mark(text), mark("x" + text[::-1])) < 0.05
    assert f.likeness(mark("a" * 100), mark("a" * 150)) <= 100 / 150


def plain_hashes(text):
    """Hash of each prefix under each base, and of each suffix at power 0, by the definition."""
    out = []
    for base in (1_000_003, 777_767_777):
        sums, power = [0], 1
        for c in text:
            sums.append((sums[-1] + (ord(c) + 1) * power) % (2**31 - 1))
            power = power * base % (2**31 - 1)
        tails, value = [0], 0
        for c in reversed(text):
            value = (value * base + ord(c) + 1) % (2**31 - 1)
            tails.append(value)
        out.append((sums, tails))
    return out


def plain_mark(text):
    n, step = len(text), 1
    while step * 64 < n:
        step *= 2
    both = plain_hashes(text)
    first = [[p[e] for p, _ in both] for e in [*range(step, n, step), n]]
    last = [[t[e] for _, t in both] for e in range(step, n, step)]
    return f"{n:x}:" + ":".join("".join(f"{x:08x}" for pair in side for x in pair) for side in (first, last))


def alike(a, b):
    """Number of characters that two texts begin with alike."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905


def plain_likeness(a, b):
    """From the texts: common prefix and suffix in whole strides of the coarser of the two."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    step = 1
    while step * 64 < max(len(a), len(b)):
        step *= 2
    least, most = min(len(a), len(b)), max(len(a), len(b))
    short, other = sorted((a, b), key=len)
    other_step = 1
    while other_step * 64 < len(other):
        other_step *= 2
    short_step = 1
    while short_step * 64 < len(short):
        short_step *= 2
    if len(short) % other_step == 0 and other.startswith(short) or len(a) == len(b) and a == b:
        return least / most
    spans = (least - 1) // step
    common = min(spans, alike(a, b) // step) + min(spans, alike(a[::-1], b[::-1]) // step)
    return min(least, common * step) / most


def test_likeness_is_what_the_texts_have_in_common():
    rng = random.Random(9)
    mark = lambda t: f.Prefixes.of(t).fingerprint()
    for _ in range(400):
        a = "".join(rng.choices("ab ", k=rng.choice((1, 5, 60, 64, 65, 128, 300, 2000))))
        cut, gone = rng.randrange(len(a) + 1), rng.choice((0, 1, 7, 64))
        b = a[:cut] + "".join(rng.choices("abc", k=rng.choice((0, 1, 9, 70)))) + a[cut + gone :]
        assert mark(a) == plain_mark(a)
        assert abs(f.likeness(mark(a), mark(b)) - plain_likeness(a, b)) < 1e-12, (a, b)
        assert f.likeness(mark(a), mark(b)) == f.likeness(mark(b), mark(a))


def brute(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (k, t) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        m = len(t) // 4
        edited = t[: len(t) - m] + other[:m]
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_mark(t), plain_mark(edited), plain_likeness(t, edited), plain_likeness(t, other), alike(t, other)))
    return sorted(out, key=repr)


def test_against_brute_force(spark, real, odd, none):
    for docs in (real, odd, odd.where("doc_id = 20"), odd.limit(1), real.repartition(13), odd.where("doc_id IS NULL OR doc_id > 8")):
        rows = docs.select("doc_id", "text").collect()
        assert sorted((tuple(r) for r in f.fingerprints(docs).collect()), key=repr) == brute([tuple(r) for r in rows])
    assert f.fingerprints(none).count() == 0


def test_many_ranges(spark, real):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        rows = [tuple(r) for r in real.select("doc_id", "text").collect()]
        assert sorted((tuple(r) for r in f.fingerprints(real).collect()), key=repr) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ids_of_other_kinds_raise(spark):
    with pytest.raises(ValueError, match="numbers or dates"):
        f.fingerprints(spark.createDataFrame([("a", "text")], "doc_id string, text string"))


def test_likeness_separates(real):
    rows = f.fingerprints(real).collect()
    long_ = [r for r in rows if r.n_chars > 200]
    assert all(r.near_edited > 0.7 for r in long_)
    assert sum(r.near_next < 0.1 for r in long_) > 0.9 * len(long_)
