import random
from collections import Counter, defaultdict
from itertools import permutations

from basket_spark.llm import filter_audit

from .conftest import DOCS

ORDERS = sorted("".join(p) for p in permutations("ABCDE"))


def brute(docs, labels):
    """Documents one by one through every order, from (doc_id, text, lang) and (doc_id, quality, toxic)."""
    import re

    docs = [(k, t or "", p or "") for k, t, p in docs]
    good, toxic = ({k for k, *flags in labels if k is not None and flags[i] == 1} for i in (0, 1))
    out = []
    for part in sorted({p for *_, p in docs}):
        own, total = [], Counter()
        for k, t, p in docs:
            if p != part:
                continue
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            fails = (
                len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
                k is not None and any(j is not None and j < k and u == t for j, u, _ in docs),
            )
            own.append((k, {n for n, f in zip("ABCDE", fails, strict=True) if f}))
        rows = []
        for order in ORDERS:
            left = own
            for step, name in enumerate(order, 1):
                gone, left = [x for x in left if name in x[1]], [x for x in left if name not in x[1]]
                total[name] += len(gone)
                rows.append((part, order, step, len(left), len(gone), sum(name in f for _, f in own) - len(gone), sum(f == {name} for _, f in own), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_plain_changes_meet_every_order_once():
    for n in range(6):
        order, seen = list(range(n)), [tuple(range(n))]
        for i in filter_audit.adjacent_swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(n)))


def test_a_swap_gives_the_diagram_of_the_new_order():
    rng = random.Random(3)
    masks = {m: (rng.randrange(1, 9), rng.randrange(3), rng.randrange(3)) for m in rng.sample(range(32), 12)}
    diagram = filter_audit.Diagram("ABCDE", masks)
    for i in (0, 3, 1, 2, 2, 0):
        diagram.swap(i)
        place = [diagram.order.index(f) for f in "ABCDE"]
        moved = {sum((m >> j & 1) << place[j] for j in range(5)): c for m, c in masks.items()}
        fresh = filter_audit.Diagram("".join(diagram.order), moved)
        assert fresh.steps() == diagram.steps()
        assert fresh.nodes[fresh.root][2] == diagram.nodes[diagram.root][2]


def test_equal_nodes_are_shared():
    masks = {m: (1, 0, 0) for m in range(32)}
    assert len(filter_audit.Diagram("ABCDE", masks).nodes) == 7  # the empty one, one end, one for each level


def test_long_texts_are_counted_whole(monkeypatch):
    text = b"One two% three\n" * 50 + b"x" * 300 + b" y"
    want = filter_audit.text_mask(text)
    monkeypatch.setattr(filter_audit, "BLOCK", 16)
    assert b"".join(filter_audit._blocks(text)) == text
    assert filter_audit.text_mask(text) == want == 0b1010


def test_whole_table_against_brute_force(spark, real):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    want = brute([(r.doc_id, r.text, r.lang) for r in real.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert rows(filter_audit.audit(real, labels)) == want


def test_odd_rows(spark, odd, none):
    """Nulls, repeats, ids without labels, labels twice, clashing columns."""
    more = spark.createDataFrame([(3, "a", None, None, None), (-5, "a", "fr", None, None), (None, "a", "fr", None, None), (40, None, "fr", None, None)], DOCS)
    docs = odd.select(*more.columns, "part", "n").unionByName(more, allowMissingColumns=True).withColumnsRenamed({"n": "digest", "part": "mask"})
    labels = [(4, 1, None), (4, 0, 1), (4, 1, 1), (None, 1, 1), (20, None, None), (20, 1, 0), (99, 1, 1)]
    said = spark.createDataFrame([(*r, 1, "x") for r in labels], "doc_id long, quality int, toxic int, n int, part string")
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert rows(filter_audit.audit(docs, said)) == want
    assert {r[0] for r in want} == {"", "en", "fr"}
    assert rows(filter_audit.audit(none, said)) == []
    assert sum(r[7] for r in rows(filter_audit.audit(docs, said.limit(0)))) == 0


def test_a_text_of_a_third_of_all_rows(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE concat('text ', id) END AS text", "CASE WHEN id % 2 = 0 THEN 'en' END AS lang")
    labels = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 5 = 0 AS int) AS quality", "CAST(id % 7 = 0 AS int) AS toxic")
    got = defaultdict(int)
    for r in filter_audit.audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").collect():
        got["removed"] += r.removed
        got["good"] += r.good_lost
    assert got == {"removed": 99, "good": 19}
