"""Spelling variants against a plain version over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from shelfcast.llm import spelling

KIND = "doc_id long, text string, word string, n long, a string"


def plain(rows):
    """{word: (form, root, n, n_near, form_n)} by comparing every two words."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        at = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
        return a != b and (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else len(a) == len(b) + 1 and a[at + 1 :] == b[at:])

    out = {}
    for w in n:
        by = sorted((-n[x], x) for x in n if near(w, x))
        out[w] = (by[0][1] if by and -by[0][0] >= 10 * n[w] else None, len(by))
    for w, (form, n_near) in list(out.items()):
        root = w
        while out[root][0]:
            root = out[root][0]
        yield w, form, root, n[w], n_near, n[form] if form else None


def variants(rng, n_words=60):
    """Words with frequent forms, chains of slips, repeated letters and accents."""
    letters, words = "abcé×", []
    for _ in range(n_words):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 11)))
        chain = [(w, 300)]
        for n in (25, 2, 3):
            at, x = rng.randrange(len(w)), chain[-1][0]
            kind = rng.randrange(3)
            chain.append((x[:at] + rng.choice(letters) * (kind > 0) + x[at + (kind < 2) :], n))
        words += [x for x, n in chain for _ in range(n)]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain(spark, seed):
    rng = random.Random(seed)
    words = variants(rng)
    rng.shuffle(words)
    rows = [(i // 2 if i % 9 else None, " - ".join(w.upper() if rng.random() < 0.1 else w for w in words[i::40])) for i in range(40)]
    rows += [(7, None), (8, ""), (None, None), (9, "aaaaaaaa aaaaaaaaa aaaaaaaa1aaaaaaaaa Aaaaaaaaa"), rows[3], (10, "long " * 20000 + "aaaaaaaa")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], KIND).repartition(3)
    found = [tuple(r) for r in spelling.variant_groups(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    expected = list(plain(rows))
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sum(r[1] is not None for r in expected) > 30 and any(r[1] is not None and r[1] != r[2] for r in expected)


def test_no_words(spark):
    none = spark.createDataFrame([], KIND)
    assert spelling.variant_groups(none).count() == 0
    short = spark.createDataFrame([(1, "short once-only wordings", None, None, None)], KIND)
    assert spelling.variant_groups(short).count() == 0


def test_follow_long_chain(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r.root for r in spelling.follow(chain, 9).collect()} == {"w9"}
