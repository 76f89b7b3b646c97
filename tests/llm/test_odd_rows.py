"""Rows with null or repeated ids, many copies of one row, and texts without letters; greedy tiling against a plain version."""

from __future__ import annotations

import random

import pytest

from shelfcast.llm import language, mixing, tiling, token_groups

KIND = "doc_id long, text string, row string, id long, has_words boolean"
BASE = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(6)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, None) for r in rows], KIND).repartition(3)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_one_row_of_copies_with_null_and_repeated_ids(spark):
    near = BASE[0].replace("w0x40", "changed")
    rows = [(5, BASE[0]), (5, BASE[0]), (None, BASE[0]), (None, BASE[0]), (7, near), (None, BASE[1]), (None, BASE[1]), (8, BASE[2]), (9, BASE[3]), (9, BASE[4])]
    words = [(None, None), (None, None), (5, ""), (10, " \n"), (10, " \n")]
    got = token_groups.keep_one(table(spark, rows + words))
    assert got.columns == [x.split()[0] for x in KIND.split(", ")]
    texts = kept(got)
    # Both texts of id 9 are one class through their id, and one of its rows stays.
    one = [x for x in texts if x[0] == 9]
    assert len(one) == 1 and one[0][1] in (BASE[3], BASE[4])
    assert [x for x in texts if x[0] != 9] == sorted([(5, BASE[0]), (None, BASE[1]), (8, BASE[2]), *words], key=str)


def test_many_exact_copies_of_one_row(spark):
    rows = [(3, BASE[0])] * 400 + [(None, BASE[0])] * 400 + [(4, BASE[1])]
    assert kept(token_groups.keep_one(table(spark, rows))) == [(3, BASE[0]), (4, BASE[1])]


def test_keep_one_of_an_empty_table(spark):
    assert token_groups.keep_one(spark.createDataFrame([], KIND)).count() == 0


def test_decontaminate_judges_rows_by_their_own_text(spark):
    items = spark.createDataFrame([(1, BASE[0]), (2, BASE[1]), (None, None)], "item_id long, text string")
    rows = [(None, f"before {BASE[0]} after"), (None, BASE[2]), (5, BASE[1]), (5, BASE[3]), (6, BASE[0]), (6, BASE[0]), (7, None), (8, "")]
    got = tiling.decontaminate(table(spark, rows), items)
    assert got.columns == [x.split()[0] for x in KIND.split(", ")]
    assert kept(got) == sorted([(None, BASE[2]), (5, BASE[3]), (7, None), (8, "")], key=str)
    assert tiling.decontaminate(spark.createDataFrame([], KIND), items).count() == 0
    assert tiling.decontaminate(table(spark, rows), items.limit(0)).count() == len(rows)


def plain_tiles(doc, item, seed):
    """Greedy string tiling by comparing all places: the longest free match, then the next, until none has `seed` words."""
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and free_d[a + n] and free_i[b + n]:
                    n += 1
                best = max(best, (n, -a, -b))
        n, a, b = best[0], -best[1], -best[2]
        if n < seed:
            return sum(x for x in tiles)
        tiles.append(n)
        for k in range(n):
            free_d[a + k] = free_i[b + k] = False


@pytest.mark.parametrize("case", range(6))
def test_coverage_equals_plain_tiling(spark, case):
    rng = random.Random(case)
    words = [f"t{i}" for i in range(6 if case < 3 else 30)]
    docs, items = [], []
    for i in range(8):
        items.append((i, [rng.choice(words) for _ in range(rng.randint(3, 18))]))
        cut = rng.randint(0, len(items[-1][1]))
        docs.append((i, [*items[-1][1][cut:], *(rng.choice(words) for _ in range(3)), *items[-1][1][:cut]]))
    found = tiling.contaminated(
        table(spark, [(i, " ".join(d)) for i, d in docs]), spark.createDataFrame([(i, " ".join(x)) for i, x in items], "item_id long, text string"), share=0.5, seed=3
    )
    got = {(r.doc_id, r.item_id): r.covered for r in found.collect()}
    wanted = {(i, j): c for i, d in docs for j, x in items if (c := plain_tiles(d, x, 3)) and 2 * c >= len(x)}
    assert got == wanted and len(wanted) >= 4


def test_texts_without_letters_are_undetermined(spark):
    rows = [(i, "der hund und die katze " * 5, "de") for i in range(20)] + [(40 + i, "the dog and the cat " * 5, "en") for i in range(20)]
    odd = [(100, "²", None), (101, "½ 12", None), (102, "Ⅷ ①", None), (103, "12 _ !", None), (104, "a", None), (105, None, None), (106, "ª", None), (107, "語", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert all(got[i] == "und" for i in (100, 101, 102, 103, 105)) and all(got[i] != "und" for i in (104, 106, 107))


def test_copies_do_not_take_a_language_out_of_the_sample(spark):
    rows = [(i, f"der hund {i}", "de") for i in range(30)] + [(i, f"the dog {i}", "en") for i in range(100, 130)] + [(1, "der hund", "de")] * 5000
    sample = language.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), 12)
    found = [(r.lang, r.text) for r in sample.collect()]
    assert len(found) == len(set(found)) == 24 and {x[0] for x in found} == {"de", "en"}


def test_repeated_ids_are_one_example(spark, monkeypatch):
    seen, fit = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: seen.append((name, (out := fit(df, name)).count())) or out)
    docs = spark.createDataFrame([(1, "good words here")] * 500 + [(2, "bad words there")], "doc_id long, text string")
    labelled = spark.createDataFrame([(1, "high"), (2, "low")], "doc_id long, domain string")
    assert mixing.posteriors(docs, labelled, ["high", "low"]).count() == 501
    assert seen[0] == ("mixing-sample", 2)
