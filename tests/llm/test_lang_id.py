import math
from collections import Counter
from statistics import median
from zlib import crc32

import numpy as np
import pytest
from basket_spark.llm import lang_id


def test_codewords_are_distinct_and_apart():
    for n in (2, 4, 7, 12):
        code = lang_id.codewords(n)
        assert code.shape[0] == n
        assert (np.abs(code.sum(0)) < n).all()
        assert len({tuple(r) for r in code}) == n
    assert all((a != b).sum() == 4 for i, a in enumerate(lang_id.codewords(4)) for b in lang_id.codewords(4)[:i])


def test_held_out_accuracy(real):
    model = lang_id.fit(real)
    rows = lang_id.identify(real, model).join(real.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def plain_buckets(text):
    """Buckets of the n-grams of a text, character by character."""
    low = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    if not low:
        return Counter()
    points, out = [32, *map(ord, low), 32], Counter()
    for n in (2, 3, 4):
        for i in range(len(points) - n + 1):
            key = 0
            for j, x in enumerate(points[i : i + n]):
                key = x if j == 0 else (key * 0x110001 + x) % 2**64
            out[((key + n) * 0x9E3779B97F4A7C15 % 2**64) >> 48] += 1
    return out


def plain_model(rows, back):
    """What is learned, from (id, text, lang): counts, log-odds and margins in dictionaries; ``back``: ids held back."""
    learn = [(k, t, g) for k, t, g in rows if t and g and k is not None and crc32(str(k).encode()) % 4 != 2 and plain_buckets(t)]
    languages = sorted({g for _, _, g in learn})
    share = {g: Counter() for g in languages}
    for k, t, g in learn:
        if k not in back:
            own = plain_buckets(t)
            for x, n in own.items():
                share[g][x] += n / sum(own.values())
    share = {g: {x: n / sum(c.values()) for x, n in c.items()} for g, c in share.items()}
    # Every split of the languages but for the empty one and its reverse.
    codes = {g: [1 if (s >> (len(languages) - 1 - i)) & 1 else -1 for s in range(1, 1 << (len(languages) - 1))] for i, g in enumerate(languages)}
    bits = range(len(codes[languages[0]]))

    def margin(text):
        own = plain_buckets(text)
        out = []
        for b in bits:
            up, down = ([g for g in languages if codes[g][b] == s] for s in (1, -1))
            odds = {x: math.log(sum(share[g].get(x, 0) for g in up) / len(up) + 1e-6) - math.log(sum(share[g].get(x, 0) for g in down) / len(down) + 1e-6) for x in own}
            out.append(sum(odds[x] * n for x, n in own.items()) / sum(own.values()))
        return out

    held = [(g, margin(t)) for k, t, g in learn if k in back]
    centre, scale = [], []
    for b in bits:
        up, down = (median([m[b] for g, m in held if codes[g][b] == s]) for s in (1, -1))
        centre.append((up + down) / 2)
        scale.append(max((up - down) / 4, 1e-6))
    trust = {}
    for g in languages:
        right = [sum((m[b] > centre[b]) == (codes[g][b] > 0) for h, m in held if h == g) / sum(h == g for h, _ in held) + 1e-3 for b in bits]
        trust[g] = [x / sum(right) for x in right]

    def predict(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        m = margin(text)
        loss = {g: len(bits) * sum(trust[g][b] * math.log1p(math.exp(-2 * codes[g][b] * (m[b] - centre[b]) / scale[b])) for b in bits) for g in languages}
        weight = {g: math.exp(min(loss.values()) - x) for g, x in loss.items()}
        best = max(languages, key=lambda g: weight[g])
        return best, weight[best] / sum(weight.values())

    return predict


def plain_predictor(docs):
    """The brute force fitted to a table of documents."""
    back = {r.doc_id for r in docs.where("pmod(xxhash64(doc_id, 8), 4) = 0").select("doc_id").collect()}
    return plain_model([(r.doc_id, r.text, r.lang) for r in docs.collect()], back)


def test_against_brute_force(real):
    """All documents of the table, those of 1,500 characters at most one by one (the loops are slow)."""
    predict = plain_predictor(real)
    got = {r.doc_id: r for r in lang_id.identify(real, lang_id.fit(real)).collect()}
    rows = [r for r in real.collect() if len(r.text or "") <= 1500]
    assert len(rows) > 30
    for r in rows:
        lang, score = predict(r.text)
        assert got[r.doc_id].lang_pred == lang
        assert abs(got[r.doc_id].score - score) < 1e-3


def test_too_many_labels_raise(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(8)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 3 labels"):
        lang_id.fit(docs)


def test_odd_rows(odd, real):
    model = lang_id.fit(real)
    rows = lang_id.identify(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    for i in (0, 1, 2, 3, 5, 11):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[4].lang_pred in model.languages
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = lang_id.keep_identified(odd, model)
    assert kept.columns == odd.columns
    assert not {0, 1, 2, 3, 5} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn(none, odd):
    model = lang_id.fit(none)
    assert lang_id.identify(none, model).count() == 0
    assert {r.lang_pred for r in lang_id.identify(odd, model).collect()} == {"und"}


def test_one_language(odd):
    model = lang_id.fit(odd)
    assert model.languages == ["en"]
    assert {r.lang_pred for r in lang_id.identify(odd, model).collect()} == {"en", "und"}


def test_mixed_text_is_ambiguous(real):
    model = lang_id.fit(real)
    de, fr = (next(r.text for r in real.where(f"lang = '{k}' AND n_chars > 1000").orderBy("doc_id").collect())[:900] for k in ("de", "fr"))
    scores = [lang_id.predict(model, de[: 9 * i] + " " + fr[: 900 - 9 * i])[1] for i in range(101)]
    assert scores[0] > 0.9
    assert scores[100] > 0.9
    assert min(scores) < 0.7


def test_nothing_learned_keeps_all(spark, real):
    unlabelled = real.limit(20).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang").select(real.columns)
    model = lang_id.fit(unlabelled)
    assert model.languages == []
    assert lang_id.keep_identified(unlabelled, model).count() == 20
    assert {r.lang_pred for r in lang_id.identify(unlabelled, model).collect()} == {"und"}
