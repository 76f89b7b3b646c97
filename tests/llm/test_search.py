"""Ranked search against a plain version that scores every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from shelfcast.llm import search

KIND = "doc_id long, text string, item_id long, score long, shard string"


def plain(docs, items, top=20):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        found = []
        for d, c in counted:
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, d is None, d))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(sorted(found)[:top], 1)]
    return out


def rows(rng, n):
    zipf = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    return [(i, " ".join(zipf() for _ in range(rng.choice([3, 30, 200])))) for i in range(n)]


def check(spark, docs, items, parts=3):
    df = spark.createDataFrame([(*r, None, 5, "x") for r in docs], KIND).repartition(parts)
    its = spark.createDataFrame([(1, t, i, 5, "y") for i, t in items], KIND)
    found = [tuple(r) for r in search.search(df, its).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(found, key=str) == sorted(plain(docs, items), key=str)
    return found


def test_equals_plain(spark):
    rng = random.Random(3)
    docs = rows(rng, 400)
    odd = [(400, None), (401, ""), (402, "... !"), (None, docs[5][1]), (None, "w1 w2 W2"), docs[7], docs[7], (403, "w3 " * 50000), (404, "Ärger ÄRGER été-été 9x9")]
    items = [(i, " ".join(rng.sample(docs[rng.randrange(400)][1].split() * 8, 20))) for i in range(12)]
    items += [(20, None), (21, "--"), (22, "w1 w1 w1"), (22, "w2 other"), (22, "w2 other"), (None, "w5"), (23, "Ärger ärger été nowhere"), (24, "nowhere at all")]
    found = check(spark, docs + odd, items)
    assert len(found) > 200


def test_pruning_keeps_the_best_and_ties_go_by_id(spark, monkeypatch):
    """Many shards, few places: what the owners leave out is never among the best."""
    monkeypatch.setattr(search, "SHARD_DOCS", 64)
    rng = random.Random(4)
    docs = rows(rng, 700) + [(1000 + i, "w7 w9 tie") for i in range(60)]
    check(spark, docs, [(i, f"w{i} w{i * 3} w1 w2 tie w{i + 50} w2") for i in range(15)], 4)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 3)
    rng = random.Random(5)
    check(spark, rows(rng, 60), [(i, f"w{i} w{i + 1} w1") for i in range(10)])


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], KIND), spark.createDataFrame([(1, "a b", 1, 1, "")], KIND)
    assert search.search(none, some).count() == search.search(some, none).count() == 0
    assert search.search(some.withColumn("text", some.text.substr(100, 1)), some).count() == 0
