"""Divergence of sources against a direct computation."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pathquality.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, documents=3, top=200):
    texts = [((lang or ""), (source or ""), Counter(TERM.findall((text or "").translate(UPPER))))
             for _, text, lang, source in rows]
    sources = defaultdict(set)
    for lang, source, _ in texts:
        sources[lang].add(source)
    out = set()
    for lang, own in sources.items():
        seen, whole, group = Counter(), Counter(), defaultdict(Counter)
        for other, source, words in texts:
            if other == lang:
                seen.update(set(words))
                whole.update(words)
                group[source].update(words)
        kept = [t for t in seen if seen[t] >= documents]

        def p(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // total for t in kept}

        def f(a, b):
            return (a - b) * (a - b) // b

        every, each = p(whole), {s: p(group[s]) for s in own}
        for s in own:
            pairs = [(o, sum(f(each[s][t], each[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, f(each[s][t], every[t])) for t in kept if group[s][t] and each[s][t] > every[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)}
    return out


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n, sources=5):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "Été", "ÉTÉ", "x", "日本", "Zz") for b in ("", "a", "B", "ß", "ق")]
    rows = []
    for i in range(n):
        source = rnd.choice([None, ""] + [f"s{k}" for k in range(sources)])
        mine = words[: 4 + (len(source or "") * 7 + i) % len(words)]
        text = rnd.choice(["", None, "12 3", " ".join(rnd.choices(mine, k=rnd.randint(1, 60))),
                           "-".join(rnd.choices(mine, k=9)) + "\x00\tend\x7f"])
        rows.append((rnd.choice([i, 1, None]), text, rnd.choice(["en", "fr", None]), source))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 80), (2, 200), (3, 12)])
def test_equals_direct_computation(spark, seed, n):
    rows = corpus(seed, n)
    got = divergence.divergences(spark.createDataFrame(rows, SCHEMA).repartition(3), per_shard=7, per_block=2)
    assert spark_rows(got) == brute(rows)


def test_fewer_ranks_and_other_parameters(spark):
    rows = corpus(4, 150)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert spark_rows(divergence.divergences(docs, documents=6, top_terms=2)) == brute(rows, 6, 2)


def test_no_kept_terms_gives_pairs_of_zero(spark):
    rows = [(1, "one", "en", "b"), (2, None, "en", "a"), (3, "", None, None), (4, "two", "en", "c")]
    got = spark_rows(divergence.divergences(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert ("en", "a", "pair", "b", 0, 1) in got and not [r for r in got if r[0] == ""]


def test_empty_table(spark):
    assert divergence.divergences(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_and_clashing_columns(spark):
    rows = [(1, "lang source " * 200_000 + "x" * 1_000_000, "en", "a"), (2, "source", "en", "b"),
            (3, "source lang", "en", "b"), (3, "source lang", "en", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "n", "docs", "value", "rank", "part", "item", "p", "p0", "q", "rows", "sources", "terms"):
        docs = docs.selectExpr("*", f"'?' as {name}")
    assert spark_rows(divergence.divergences(docs)) == brute(rows)


def test_counts_beyond_longs_of_the_product(spark):
    """p of a count whose product with the unit exceeds a long."""
    n, total = 40_000_000_000, 90_000_000_001
    row = spark.createDataFrame([(n, total)], "n long, total long").select(divergence._p("n", "total").alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * (n + 1) // total
