"""Mixing against a plain computation; the lookup table's properties."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from mailsift.llm import mixing, sharding
from tests.llm.helpers import clashing, docs


def test_targets_share_all_words_and_stop_at_the_cap():
    got = mixing.targets({"a": 100, "b": 10, None: 1000, "c": 1})
    assert sum(got.values()) == pytest.approx(1111) and got["b"] == 30 and got["c"] == 3
    assert got["a"] == 300 and got[None] == pytest.approx(778)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def plain(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    hash_ = lambda i: int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)
    sizes = Counter()
    by = defaultdict(list)
    for i, t, s in rows:
        sizes[s] += size(t)
        by[s].append((hash_(i), size(t), i))
    wanted, taken = mixing.targets(dict(sizes)), []
    for s, items in by.items():
        whole = int(wanted[s] // sizes[s]) if sizes[s] else 0
        rest = wanted[s] - whole * sizes[s]
        for h, n, i in items:
            upto, less = sum(m for g, m, _ in items if g <= h), sum(m for g, m, _ in items if g < h)
            more = upto <= rest or less < rest and upto - rest < rest - less
            taken.append((str(i), n, n * (whole + more)))
    return sorted(taken)


def test_taken_words_equal_a_plain_computation(spark):
    rng = random.Random(9)
    sources = ["b", "a", None, "Z", "é", "big"]
    rows = [(n, "w " * rng.randint(0, 90), rng.choice(sources + ["big"] * 4)) for n in range(300)]
    rows += [(7, "x y z", "a"), (7, "x y z", "a"), (None, "q", "b"), (301, None, "Z"), (302, "  a", "Z")]
    got = mixing.mix(clashing(docs(spark, rows))).collect()
    assert sorted((str(r.id), r.size, r.taken) for r in got) == plain(rows)
    assert all(r.taken <= 3 * r.size for r in got)
    mixed = mixing.mixed(clashing(docs(spark, rows)))
    copies = Counter(str(r.doc_id) for r in mixed.collect())
    want = Counter()
    for r in got:
        want[str(r.id)] += r.copies
    assert +want == copies and "key" in mixed.columns
    assert mixing.mix(docs(spark, rows).limit(0)).count() == 0 and mixing.mixed(docs(spark, rows).limit(0)).count() == 0


def test_every_shard_gets_its_share_and_few_slots_move():
    table = sharding.lookup()
    counts = Counter(table)
    assert len(table) == sharding.TABLE_SIZE and max(counts.values()) - min(counts.values()) <= 1
    gone = sharding.SHARDS[3]
    fewer = [n for n in sharding.SHARDS if n != gone]
    after = [fewer[i] for i in sharding.lookup(fewer)]
    before = [sharding.SHARDS[i] for i in table]
    moved = sum(a != b for a, b in zip(after, before) if b != gone)
    assert moved < 0.1 * len(table)
    double = Counter(sharding.lookup(("a", "b"), 101, {"a": 2}))
    assert 66 <= double[0] <= 68
    for bad in ((("a", "a"), 101), ((), 101), (("a",), 100)):
        with pytest.raises(ValueError):
            sharding.lookup(*bad)


def test_placement_follows_the_key_alone(spark):
    df = clashing(docs(spark, [(1, "a"), (1, "b"), (None, "c"), (2, None)]))
    rows = sharding.place(df).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    table = sharding.lookup()
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        assert (r["slot"], r.shard, r.key) == (slot, sharding.SHARDS[table[slot]], "own key")
    assert sharding.place(df.limit(0)).count() == 0
