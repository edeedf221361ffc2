from collections import Counter

import pytest
from basket_spark.llm import sharding


def brute(shards, slots):
    """The filling as it is told: whole preference lists, a turn for each shard, the first free slot of its list."""
    import hashlib

    lists = []
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        at, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        lists.append([(at + j * skip) % slots for j in range(slots)])
        assert sorted(lists[-1]) == list(range(slots))
    table = {}
    while len(table) < slots:
        for i, prefer in enumerate(lists):
            free = [x for x in prefer if x not in table]
            if free:
                table[free[0]] = i
    return [table[x] for x in range(slots)]


def test_fill():
    for n, slots in ((1, 7), (3, 13), (5, 101), (13, 13)):
        assert sharding.fill(sharding.names(n), slots) == brute(sharding.names(n), slots)
    shares = Counter(sharding.fill(sharding.names(32)))
    assert max(shares.values()) - min(shares.values()) <= 1
    for bad in ((["a", "a"], 7), (["a"], 8), ([], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError, match="prime"):
            sharding.fill(*bad)


def test_few_keys_move():
    one, two = sharding.fill(sharding.names(32)), sharding.fill(sharding.names(31))
    assert sum(a != b for a, b in zip(one, two, strict=True)) < 0.12 * len(one)


def test_rows(odd, none, real):
    got = sharding.assign(odd, sharding.names(8))
    assert got.count() == odd.count()
    assert len({(r.slot, r.shard) for r in got.where("doc_id = 20").collect()}) == 1
    assert got.where("shard IS NULL").count() == 0
    assert sharding.assign(none, sharding.names(8)).count() == 0
    table = {r.doc_id: r.shard for r in sharding.assign(real, sharding.names(5)).collect()}
    assert {r.doc_id: r["__shard"] for r in sharding.sharded(real, sharding.names(5)).collect()} == table
    with pytest.raises(ValueError, match="column part"):
        sharding.sharded(odd, sharding.names(5), name="part")
    assert "Python" not in sharding.assign(real, sharding.names(8))._jdf.queryExecution().toString()
