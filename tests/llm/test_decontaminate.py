import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
from basket_spark.llm import decontaminate as d

ITEMS = "item_id long, text string"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, threshold=0.6, overlap=0.8):
    """(doc, item) -> best score: BM25 of every passage against every item by its formula, and all five-word runs, from the
    texts alone."""
    items = [(k, t, w) for k, t in items if (w := plain_words(t))]
    if not items:
        return {}
    n, mean, longest = len(items), sum(len(w) for _, _, w in items) / len(items), max(len(w) for _, _, w in items)
    df = Counter(x for _, _, w in items for x in set(w))
    out = {}
    for item, text, own in items:
        tf = Counter(own)
        weight = {x: math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(own) / mean)) for x, c in tf.items()}
        total = sum(weight.values())
        sentences = [w for s in re.split(r"(?<=[.!?])\s+", text) if (w := plain_words(s))]
        answer = sentences[-1] if len(sentences) > 1 else own[len(own) - max(1, len(own) // 4) :]
        question = own[: len(own) - len(answer)] or own
        for doc, body in docs:
            there = plain_words(body)
            if len(own) < 5:
                rarity = sum(math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) for x in tf) / (math.log(1 + (n - 0.5) / 1.5) or 1.0)
                inside = any(there[i : i + len(own)] == own for i in range(len(there) - len(own) + 1))
                if there == own or inside and rarity >= 2 - 1e-9:
                    out[doc, item] = 1.0
                continue
            for start in range(0, max(1, len(there) - longest), longest):
                part = there[start : start + 2 * longest]
                score = sum(weight[x] for x in set(part) if x in weight) / total
                if score < threshold - 1e-6:
                    continue
                shares = []
                for side in (question, answer):
                    k = min(5, len(side))
                    runs = {tuple(side[i : i + k]) for i in range(len(side) - k + 1)}
                    have = {tuple(part[i : i + k]) for i in range(len(part) - k + 1)}
                    shares.append(len(runs & have) / len(runs))
                if min(shares) >= overlap:
                    out[doc, item] = max(out.get((doc, item), 0.0), score)
    return out


def test_against_brute_force(spark, real):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text or "") for r in real.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.collect()])
    got = {(r.doc_id, r.item_id): r.score for r in d.contaminated(real, items).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    verbatim = {(k, r.item_id) for r in items.collect() for k, t in docs if r.text in t}
    assert verbatim
    assert verbatim <= set(got)
    kept = {r.doc_id for r in d.keep_clean(real, items).collect()}
    assert kept == {k for k, _ in docs} - {k for k, _ in got}


def made(seed, n_items, n_docs):
    """Items of all lengths, one word among them, and texts that hold them whole, in part, or not."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((1, 2, 4, 5, 9, 30)))) + rng.choice(("", ". ")) + rng.choice(("", "yes.", "no at all"))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        body = rng.choices(vocabulary, k=rng.choice((0, 3, 40, 200)))
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].split()
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = own
        docs.append((i, " ".join(body)))
    return docs, items


def test_scores_do_not_depend_on_parts(spark):
    docs, items = made(5, 60, 120)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    one = sorted(map(tuple, d.contaminated(*frames).collect()))
    assert {(a, b) for a, b, *_ in one} == set(want)
    assert all(abs(s - want[a, b]) < 1e-9 for a, b, s, *_ in one)
    for chars in (2000, 700):
        assert d.indexes(frames[1], chars=chars)[0] > 1
        assert sorted(map(tuple, d.contaminated(*frames, chars=chars).collect())) == one
        assert {r.doc_id for r in d.keep_clean(*frames, chars=chars).collect()} == {k for k, _ in docs} - {k for k, _ in want}


def test_wand_finds_what_full_scoring_finds():
    rng = np.random.default_rng(4)
    items = []
    for i in range(200):
        own = Counter(f"w{x}".encode() for x in rng.zipf(1.4, rng.integers(6, 30)) % 80)
        items.append((i, b" ".join(own.elements()), [(w, c / own.total()) for w, c in sorted(own.items())]))
    index = d.Index(items, 30, block=7)
    words = sorted({w for _, _, weights in items for w, _ in weights})
    for _ in range(200):
        terms = [int(x) for x in rng.choice(len(words), rng.integers(1, 25), replace=False)]
        score = np.array([sum(v for w, v in weights if words.index(w) in terms) for _, _, weights in items])
        for threshold in (0.1, 0.3, 0.6):
            got = dict(index.wand(terms, threshold))
            assert set(got) == set(np.flatnonzero(score >= threshold - 1e-6))
            assert all(abs(score[i] - v) < 1e-9 for i, v in got.items())


def test_partial_items_and_case(spark):
    question, answer = "what is the tallest mountain of the northern islands called today by sailors", "it is called mount perilous after the wreck"
    items = spark.createDataFrame([(1, f"{question.capitalize()}? {answer.capitalize()}."), (2, None), (3, ""), (4, "Single."), (5, "...")], ITEMS)
    docs = spark.createDataFrame([(1, f"Noise before. {question.upper()}\n{answer}; noise after " + "filler words " * 50), (2, question), (3, answer), (4, None), (5, "a single one"), (6, "SINGLE!"), (7, "...")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()) == [(1, 1), (6, 4)]


def test_short_items_stand_anywhere(spark):
    """'who wrote war peace' is found inside a text, its words in another order or apart aren't; 'yes' and what consists of
    common words only as the whole text."""
    rows = ["who wrote war peace", "Yes.", "all of them", *(f"who of them said yes to all item{i} of the long ones" for i in range(30))]
    items = spark.createDataFrame(list(enumerate(rows)), ITEMS)
    texts = ["quiz: Who wrote WAR, peace? and more text follows here", "war peace wrote who", "who wrote about war and peace", "yes", "Yes, all of them said so", "All of them!", "filler " * 5000 + "who wrote war peace " + "filler " * 5000, "who wrote war peace"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(0, 0), (3, 1), (5, 2), (6, 0), (7, 0)]
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()) == want
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(docs, items, chars=60).collect()) == want
    assert {r.doc_id for r in d.keep_clean(docs, items).collect()} == {1, 2, 4}


def test_a_text_of_five_million_words():
    """An item at the end of it is found, in memory that is a small multiple of the text's size."""
    item = b"which of these rivers runs through the most countries of all the continent. It is the long one with many names."
    own = Counter(d.words(item))
    index = d.Index([(7, item, [(w, c / own.total()) for w, c in sorted(own.items())])], len(d.words(item)))
    text = b" of the filler" * 1_666_000 + b" " + item
    tracemalloc.start()
    got = index.hits(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [h[0] for h in got] == [7]
    assert peak < 250e6


def test_odd_rows(odd, none, spark):
    items = spark.createDataFrame([(1, "Which words stand here? Some text here that repeats.")], ITEMS)
    assert d.contaminated(odd, items).count() == 0
    assert d.keep_clean(odd, items).columns == odd.columns
    assert d.keep_clean(odd, items.limit(0)).count() == odd.count()
    assert d.contaminated(none, items).count() == 0
    assert d.contaminated(odd, items.limit(0)).count() == 0
    assert d.contaminated(odd.limit(3), items.union(items)).count() == 0
