"""The audit of sources against a plain computation."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mailsift.llm import divergence
from mailsift.llm import queries as catalog
from tests.llm.helpers import DOC, clashing

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, support=10, top=10):
    docs, groups, counts = defaultdict(Counter), set(), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = Counter(TERM.findall(lower(text or "")))
        docs[lang].update(terms.keys())
        counts[lang, source].update(terms)
        groups.add((lang, source))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= support]
        sources = [s for g, s in groups if g == lang]

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        by = {s: shares(counts[lang, s]) for s in sources}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            found = [("pair", o, sum(f(by[s][t], by[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, f(by[s][t], whole[t])) for t in kept if counts[lang, s][t] and by[s][t] > whole[t]]
            for part, limit in ((found, None), (terms, top)):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                out |= {(lang, s, *x, rank) for rank, x in enumerate(part[:limit], 1)}
    return out


def got(audit, top=10):
    pairs = {(r.lang, r.source, "pair", r.other, r.value, r["rank"]) for r in audit.pairs().collect()}
    return pairs | {(r.lang, r.source, "term", r.term, r.value, r["rank"]) for r in audit.telling(top).collect()}


def rows_of(seed, n=160, sources=("a", "b", None, "", "Z", "é")):
    rng, rows = random.Random(seed), []
    words = ["the", "The", "THE,", "a-b", "a-a", "x1y", "É", "é", "日本", "\xa0the", "12", "--", "co\x85op", "ß", "don't", "end.", "\U0001f600"]
    rare = [f"r{c}" for c in "abcdefghij"]
    for i in range(n):
        text = rng.choice([" ", "\n", "\t\x0b"]).join(rng.choices(words + [rng.choice(rare), f"({rng.choice(rare)})"], k=rng.randint(0, 12)))
        rows.append((i, rng.choice([text] * 9 + [None]), rng.choice(["en", "en", "de", None]), rng.choice(sources), 1))
    return rows


@pytest.mark.parametrize("support", [1, 4, 10])
def test_audit_equals_a_plain_computation(spark, support):
    rows = rows_of(support) + [(0, "ra (ra) ra rb", "de", "b", 1)] * 3 + [(None, None, "xx", "only", None)]
    df = clashing(spark.createDataFrame(rows, DOC)).withColumn("term", F.lit("own")).repartition(5)
    assert got(divergence.Audit(df, support=support)) == plain(rows, support)


def test_small_flushes_and_tiles_change_nothing(spark):
    rows = rows_of(7, 200, [f"s{i}" for i in range(23)])
    df = spark.createDataFrame(rows, DOC)
    assert got(divergence.Audit(df, support=3, flush=5, span=3, tile=4), 3) == plain(rows, 3, 3)


def test_documents_of_terms_are_counted_once(spark):
    # Nine documents hold both forms: eighteen chunks in documents, nine documents.
    rows = [(i, "word (word) other", "en", "s", 1) for i in range(9)] + [(10, "other", "en", "t", 1)]
    audit = divergence.Audit(spark.createDataFrame(rows, DOC))
    assert [r.term for r in audit.terms.collect()] == ["other"]
    assert {(r.source, r.total, r.terms) for r in audit.groups.collect()} == {("s", 9, 1), ("t", 1, 1)}
    again = divergence.Audit(spark.createDataFrame([*rows, rows[0]], DOC))
    assert sorted(r.term for r in again.terms.collect()) == ["other", "word"]


def test_large_counts_stay_exact(spark):
    big = 4 * 10**12
    df = spark.createDataFrame([(big, big + 7, 5)], "n long, total long, terms long")
    row = df.select(divergence._share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (big + 17)


def test_long_text_and_empty_table(spark):
    rows = [(1, "abc " * 300_000, "en", "s", 1), (2, "x" * 500_000, "en", "t", 1)] + [(3, "abc q", "en", "s", 1)] * 10
    assert got(divergence.Audit(spark.createDataFrame(rows, DOC))) == plain(rows)
    assert got(divergence.Audit(spark.createDataFrame([], DOC))) == set()
    with pytest.raises(ValueError):
        divergence.Audit(spark.createDataFrame([], DOC), support=0)


def test_query_names_its_parts(spark):
    found = catalog.op11_divergence(spark, "/root/testdata/sf0.001").collect()
    assert {r.part for r in found} == {"pair", "term"} and max(r["rank"] for r in found if r.part == "term") == 10
