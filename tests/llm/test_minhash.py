"""Near duplicates against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from mailsift.llm import minhash
from tests.llm.helpers import clashing, docs


def bag(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else Counter()


def classes(rows):
    """Smallest id of each row's class, by all pairs."""
    bags, home = [bag(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = bags[a], bags[b]
            both = sum((x & y).values())
            if (rows[a][1] or "") == (rows[b][1] or "") or both and both / sum((x | y).values()) >= 0.8:
                home[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[top(n)] = min(least.get(top(n), i), i)
    return [least[top(n)] for n in range(len(rows))]


def sample():
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    rows = [(n, text(rng.randint(1, 80))) for n in range(60)]
    template = text(200).split()
    for n in range(60):  # near copies of one template, not all alike among themselves
        words = list(template)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 9999)}"
        rows.append((100 + n, " ".join(words)))
    rows += [(200 + n, rows[7][1]) for n in range(5)]
    rows += [(300, ""), (301, None), (302, "two words"), (303, "two  words"), (304, " \n"), (305, "line " * 300), (306, "line " * 299)]
    return rows


def test_classes_equal_brute_force(spark):
    rows = sample()
    got = {r.doc_id: r for r in minhash.near_duplicates(docs(spark, rows).repartition(6)).collect()}
    want = classes(rows)
    assert [got[i].class_id for i, _ in rows] == want
    assert sum(r.kept for r in got.values()) == len(set(want))


def test_one_row_of_each_class_stays(spark):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "a b c d e f g"), (9, None), (None, "q r"), (7, "x y z")]
    df = clashing(docs(spark, rows))
    out = minhash.without_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "7", "9", "None"]
    assert minhash.without_near_duplicates(df.limit(0)).count() == 0


def test_signatures_agree_as_often_as_the_weights_overlap():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = elements[:200], elements[50:]
    part = np.ones(450)
    part[:50] = 0.5  # half of what only the first holds
    k = 4096
    signatures = minhash.dart_signatures(np.concatenate([a, b]), np.array([200, 250]), k, part)
    assert abs((signatures[0] == signatures[1]).mean() - 150 / (25 + 250)) < 0.03
