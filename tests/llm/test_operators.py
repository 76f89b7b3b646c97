"""The operators against plain versions, and their odd rows: nulls, empty and long texts, repeats, empty tables, more columns."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from shelfcast.llm import frames, language, ledger, merge_counts, mixing, pitman_yor, site_lines, tiling, token_groups, url_reputation
from shelfcast.llm.common import stored
from shelfcast.llm.components import components
from shelfcast.llm.queries import vocabulary

KIND = "doc_id long, text string, lang string, source string, n_chars long, n_words long, row string, copies long"
BASE = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(6)]


def odd_rows():
    near = BASE[0].split()
    near[40] = "changed"
    texts = [*BASE, BASE[1], " ".join(near), None, "", " \n\t ", "one two", "ONE two", "idiot " * 70, BASE[2] + "\n" + "long word " * 40000, BASE[3]]
    rows = [(i, t, "en" if i % 2 else None, None, None, 7, "x", None) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, BASE[4], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(odd_rows(), KIND)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], KIND)


def words(text):
    return (text or "").encode().lower().split()


def test_ledger_counts_and_passes_rows_through(docs, none):
    found = ledger.judged(docs).collect()
    assert len(found) == docs.count() and ledger.judged(none).count() == 0
    for r in found:
        w = (r.row.text or "").encode().split()
        windows = Counter(zip(w, w[1:], w[2:]))
        marked = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(marked))
        assert r.word_chars == sum(len(x.decode()) for x in w)
        assert r.base_failed == (len(w) < 50 or 2 * len(marked) > len(w))
    assert ledger.keep_good(docs).columns == docs.columns
    rows = {r.rule: r for r in ledger.ablation(ledger.ledger(docs)).collect()}
    assert rows["few_words"].failing == sum(r.n_words < 50 for r in found)


def test_ledger_finds_junk(spark):
    junk = [" ".join(f"a{i}$$$" for i in range(60)), " ".join(f"AA{i}!!" for i in range(60)), BASE[0]]
    got = {r.row.doc_id: r.kept for r in ledger.judged(spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string")).collect()}
    assert got == {0: False, 1: False, 2: True}


def classes(rows, k, percent):
    """Brute force over all pairs; rows without an id or words link with nothing."""
    sets = [frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if (w := words(r[1])) else frozenset() for r in rows]
    root = {r[0]: r[0] for r in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for (r, a), (s, b) in itertools.combinations(list(zip(rows, sets)), 2):
        if r[0] is not None and s[0] is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(r[0]), find(s[0])
            root[max(x, y)] = min(x, y)
    return Counter((r[0], len(s), None if r[0] is None else find(r[0])) for r, s in zip(rows, sets))


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_classes_of_odd_rows(docs, none, k, percent):
    assert Counter(tuple(r) for r in token_groups.linked_classes(docs, k, percent).collect()) == classes(odd_rows(), k, percent)
    if k == 5:
        assert token_groups.linked_classes(none).count() == 0


def test_classes_of_random_edits(spark):
    rng = random.Random(3)
    rows = []
    for i in range(160):
        w = BASE[i % 3].split()
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
        rows.append((1000 - i, " ".join(w[rng.randrange(4) :])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in token_groups.linked_classes(df, 4, 85).collect()) == classes(rows, 4, 85)


def test_one_of_each_class_stays(docs):
    kept = token_groups.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 0 in ids and 7 not in ids and 6 not in ids and 8 in ids and None in ids


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in components(links).collect()} == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


PAGES = [(1, "https://A.example.net/en/1"), (2, "http://b.example.com/de/2?x"), (3, "x.org/fr"), (4, None), (5, "https://s.bad.example.org/q/3"), (6, "https://org/fr/9"), (6, "https://org/fr/9")]


def test_urls(spark):
    pages = spark.createDataFrame([(*p, "n") for p in PAGES], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(5, 1)] * 400 + [(1, 0)] * 400 + [(2, None), (77, 1)], "page_id long, bad long")
    got = {r.page_id: r for r in url_reputation.judge_urls(pages, outcomes).collect()}
    assert [got[i].verdict for i in range(1, 7)] == ["allow", "block", "allow", "allow", "block", "allow"]
    assert got[1].rule == "example.net/en/" and got[1].host == "a.example.net" and got[3].host == "" and got[5].rule is None
    assert url_reputation.judge_urls(pages, outcomes.limit(0)).where("verdict = 'block' and rule is null").count() == 0
    assert url_reputation.judge_urls(pages.limit(0), outcomes).count() == 0
    assert url_reputation.judge_urls(pages, outcomes).count() == len(PAGES)


def test_suffixes_from_a_table(spark):
    names = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.org", "org", "", "q.kawasaki.jp", "city.kawasaki.jp", "notco.uk", "w..jp"]
    hosts = spark.createDataFrame([(h,) for h in names], "host string")
    table = spark.createDataFrame([("co.uk",), ("uk",), ("kawasaki.jp",), ("jp",), ("jp",), (None,)], "suffix string")
    got = {r.host: (r.domain, r.suffix) for r in url_reputation.named_hosts(hosts, table).collect()}
    plain = {r.host: (r.domain, r.suffix) for r in url_reputation.named_hosts(hosts, ("co.uk", "kawasaki.jp")).collect()}
    assert got == plain and len(got) == len(names)
    assert got["a.b.co.uk"] == ("b.co.uk", "co.uk") and got["co.uk"] == ("co.uk", "co.uk") and got["notco.uk"] == ("notco.uk", "uk")
    assert got["x.y.org"] == ("y.org", "org") and got["q.kawasaki.jp"] == ("q.kawasaki.jp", "kawasaki.jp")
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    outcomes = spark.createDataFrame([(5, 1)] * 400 + [(1, 0)] * 400, "page_id long, bad long")
    listed = spark.createDataFrame([(x,) for x in url_reputation.SUFFIXES], "suffix string")
    assert sorted(url_reputation.judge_urls(pages, outcomes, suffixes=listed).collect(), key=str) == sorted(url_reputation.judge_urls(pages, outcomes).collect(), key=str)


def plain_tiling(a, b, least):
    """Greedy string tiling by all pairs of places, without seeds."""
    free_a, free_b, found = [True] * len(a), [True] * len(b), []

    def match(i, j):
        n = 0
        while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
            n += 1
        return n

    while True:
        matches = [(match(i, j), i, j) for i in range(len(a)) for j in range(len(b))]
        longest = max((n for n, _, _ in matches), default=0)
        if longest < least:
            return found
        for n, i, j in sorted(m for m in matches if m[0] == longest):
            if all(free_a[i : i + n]) and all(free_b[j : j + n]):
                free_a[i : i + n] = free_b[j : j + n] = [False] * n
                found.append((i, j, n))


def test_contamination_equals_plain_tiling(spark):
    rng = random.Random(11)
    items = [(i, [f"W{rng.randrange(9 if i % 3 else 40)}" for _ in range(rng.randrange(3, 30))]) for i in range(12)]
    texts = []
    for d in range(60):
        pieces = []
        for _ in range(rng.randrange(4)):
            item = rng.choice(items)[1]
            start = rng.randrange(len(item))
            pieces += [item[start : start + rng.randrange(3, 25)], [f"w{rng.randrange(40)}" for _ in range(rng.randrange(4))]]
        rng.shuffle(pieces)
        texts.append((d, [w for p in pieces for w in p]))
    expected = set()
    for d, text in texts:
        for i, item in items:
            found = plain_tiling([w.lower() for w in text], [w.lower() for w in item], 5)
            covered = sum(n for _, _, n in found)
            if found and 2 * covered >= len(item):
                expected.add((d, i, covered, len(item), len(found)))
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in texts], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.covered, r.item_words, r.tiles) for r in tiling.contaminated(docs, bench).collect()}
    assert got == expected and len(expected) > 20


def test_tiles_cover_reordered_passages():
    a, b = list(range(1, 31)), [*range(16, 31), *range(1, 16)]
    assert sorted(tiling.tiles(a, b, 5)) == [(0, 15, 15), (15, 0, 15)]
    assert tiling.tiles(a, [1, 2, 3, 4], 5) == []


def test_contamination(spark, docs, none):
    items = spark.createDataFrame([(1, " ".join(f"W0x{i}" for i in range(30)), "q"), (1, " ".join(f"W0x{i}" for i in range(30)), "q"), (2, None, "q"), (3, "one two", "q"), (4, " ".join(f"w5x{i}" for i in [*range(10, 20), *range(10)]), "q")], "item_id long, text string, doc_id string")
    found = sorted((r.doc_id, r.item_id, r.covered, r.tiles) for r in tiling.contaminated(docs, items).collect())
    assert found == [(0, 1, 30, 1), (5, 4, 20, 2), (7, 1, 30, 1)]
    split = sorted((r.doc_id, r.item_id, r.covered, r.tiles) for r in tiling.contaminated(docs, items, block_words=5).collect())
    assert split == found
    assert tiling.contaminated(none, items).count() == 0 == tiling.contaminated(docs, items.limit(0)).count()
    assert docs.count() - tiling.decontaminate(docs, items).count() == 3


def test_language_model(spark, docs, none):
    rows = {}
    tokens = [words(r[1]) + [b" "] for r in odd_rows()]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 5 == 1 for r in odd_rows()]
    counts = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter((r[0], h, len(ts), sum(counts[t] > 0 for t in ts), total, round(sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in ts), 3)) for r, ts, h in zip(odd_rows(), tokens, held))
    found = pitman_yor.score_texts(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in found) == expected
    assert all(r.score < 0 for r in found) and pitman_yor.score_texts(none).count() == 0 and not rows


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    hashes = [pitman_yor.word_hashes([f"v{i}".encode() for i in rng.zipf(1.5, 300) % 40] + [b" "]) for _ in range(30)]
    known, contexts, keys, counts = pitman_yor.combined([next(pitman_yor.count_rows([(i, True, h) for i, h in enumerate(hashes)], 1))[1]])
    at, context = keys // pitman_yor.CONTEXTS, keys % pitman_yor.CONTEXTS
    customers, pairs = np.bincount(context, counts, len(contexts)), np.bincount(context, minlength=len(contexts))
    sums = pitman_yor.Sums(int(counts.sum()), len(known), (0.5, 0.6), customers, pairs, len(keys), len(known))
    part = pitman_yor.Part(0, len(known), at, context, counts, contexts)
    thin = pitman_yor._thin(0, pitman_yor._first_rows(0, known, contexts, keys, counts, 2)[1][4])
    part.seat(sums, 0)
    place = np.searchsorted(contexts, thin.contexts)
    thin.seat(pitman_yor.Sums(sums.tokens, sums.words, sums.discounts, customers[place], pairs[place], len(keys), len(known)), 0)
    assert all((a == b).all() for a, b in zip(thin.seats(), part.seats())) and (thin.root_customers == part.root_customers).all()
    assert (thin.beyond() == part.beyond()[place]).all() and part.beyond().sum() == thin.beyond().sum()
    assert (part.tables >= 1).all() and (part.tables <= part.counts).all()
    sums = pitman_yor.Sums(sums.tokens, sums.words, sums.discounts, customers, pairs + part.beyond(), int(part.root_customers.sum()), int(part.root_tables.sum()))
    root = sums.root(part.root_customers, part.root_tables)
    assert math.isclose(root.sum() + sums.root(0, 0), 1.0, rel_tol=1e-9)
    for b in np.unique(context)[:5]:
        here = context == b
        extra = (counts[here] - sums.discounts[1] * part.tables[here]) / (pitman_yor.STRENGTH + customers[b])
        assert math.isclose(extra.sum() + sums.back_off()[b], 1.0, rel_tol=1e-9)


def test_every_previous_word_is_a_context(spark, monkeypatch):
    """More words than 4096, each with one successor: what is learnt of one context must not be shared with others."""
    monkeypatch.setattr(pitman_yor, "PART_BYTES", 100_000)
    starts = np.random.default_rng(3).integers(0, 6000, 900).tolist()
    rows = [(i, " ".join(f"w{(s + j) % 6000}" for j in range(60))) for i, s in enumerate(starts)]
    assert len(np.unique(pitman_yor.contexts_of(pitman_yor.word_hashes([f"w{i}".encode() for i in range(6000)])))) == 6000
    found = pitman_yor.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("held_out").collect()
    assert 10 ** (-sum(r.score for r in found) / sum(r.n_tokens for r in found)) < 2


def test_a_hot_word_is_split(spark, monkeypatch):
    """Many tokens of one word are few entries, their scoring is dealt to several tasks, and the scores stay the same."""
    end, hot = pitman_yor.word_hashes([b" "]), pitman_yor.word_hashes([b"hot"])
    sizes = [len(next(pitman_yor.chunk_rows(0, [(1, True, np.concatenate([np.repeat(hot, n), end]))], 1))[2]) for n in (10, 100_000)]
    assert sizes[1] < sizes[0] + 20
    rng = np.random.default_rng(5)
    rows = [(i, " ".join("hot" if x < 0.4 else f"w{int(x * 100)}" for x in rng.random(200))) for i in range(60)]
    docs, found = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "hot"), []
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 500)
    for scored, counted in ((1 << 40, 1 << 40), (500, 20_000)):
        monkeypatch.setattr(pitman_yor, "SCORED_BYTES", scored)
        monkeypatch.setattr(pitman_yor, "COUNTED_BYTES", counted)
        found.append(pitman_yor.score_texts(docs).orderBy("doc_id").collect())
    assert found[0] == found[1] and len(found[0]) == 60 and all(r.n_tokens == 201 for r in found[0])


def peak(run):
    """Bytes that were held at most while `run` went on."""
    import tracemalloc

    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_chunk_is_sorted_in_little_memory():
    """Words, their order and their documents are held for all tokens; sorted copies and contexts for one part at a time."""
    rng, words = np.random.default_rng(7), pitman_yor.word_hashes([f"w{i}".encode() for i in range(5000)])
    end = pitman_yor.word_hashes([b" "])
    docs = [(i, i % 5 != 1, np.concatenate([words[rng.integers(0, 5000, 399)], end])) for i in range(750)]
    for rows in (lambda: pitman_yor.count_rows(docs, 30), lambda: pitman_yor.chunk_rows(3, docs, 30)):
        assert peak(lambda rows=rows: [None for _ in rows()]) < 34 * 300_000
    tokens = np.concatenate([d[2] for d in docs])
    before = np.concatenate([end, tokens[:-1]])
    for part, in_order, contexts, owner in pitman_yor._columns(docs, 30):
        here = np.flatnonzero([int(t) * 30 >> 64 == part for t in tokens])
        here = here[np.argsort(tokens[here], kind="stable")]
        assert (in_order == tokens[here]).all() and (contexts == before[here]).all() and (owner == here // 400).all()


def test_counts_of_many_chunks_do_not_pile_up(monkeypatch):
    """The same words, contexts and pairs in every chunk take the memory of a few chunks, not of all."""
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 80_000)
    hashes = pitman_yor.word_hashes([f"w{i}".encode() for i in range(20_000)] + [b" "])
    pack = next(pitman_yor.count_rows([(1, True, hashes)], 1))[1]
    words, contexts, keys, counts = pitman_yor.combined([pack] * 60)
    assert len(words) == len(contexts) == len(keys) == 20_001 and (counts == 60).all()
    assert peak(lambda: pitman_yor.combined([pack] * 60)) < 400 * 20_001


def test_payloads_are_written_plain_and_models_apart(spark, docs):
    """The rounds read no models, and payloads, packed already, go to small row groups without another compression."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    def groups(df):
        found = [pq.ParquetFile(urlparse(f).path).metadata for f in df.inputFiles()]
        return [m.row_group(i) for m in found for i in range(m.num_row_groups)]

    table = pitman_yor._counted(docs.selectExpr("doc_id", "coalesce(doc_id, 0) % 2 = 0 as train", "text"), 3, 1, 1)
    assert {g.column(c).compression for g in groups(table) for c in range(g.num_columns)} == {"UNCOMPRESSED"}
    found = table.selectExpr("kind", "payload is null as apart", "model is null as plain").collect()
    assert found and all(r.apart == (r.kind == "merged") and r.plain == (r.kind != "merged") for r in found)
    large = stored(spark.range(0, 40, 1, 1).selectExpr("repeat(cast(id as string), 600000) as payload"), "payloads", **pitman_yor.PAYLOADS)
    assert max(g.total_byte_size for g in groups(large)) < 12 << 20


def test_language(spark, sf, docs, none):
    found = language.identify(docs).collect()
    assert len(found) == docs.count() and {r.lang_pred for r in found if r.doc_id in (8, 9, 10)} == {"und"}
    assert {r.held_out for r in found if r.doc_id == 0} == {zlib.crc32(b"0") % 4 == 2}
    assert language.identify(none).count() == 0
    real = spark.read.parquet(f"{sf}/documents.parquet")
    marked = language.identify(real).where("held_out").join(real, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in marked) >= 0.95 * len(marked)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def strange_texts(n=3000):
    rng = random.Random(0)
    letters = "aAéÉ́ \n\t\r  'stmrevdl1²😀ßſİ-_!漢‍\x85\x1c\x0b.,ıDžΣ"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(n)]
    return [*out, "a<|endoftext|>b <|startoftext|>", "x<|ENDOFTEXT|>", "I'M don't 12345", "a" * 3000]


def test_token_counts(docs, none, library):
    count = merge_counts.counter(open(vocabulary(), encoding="utf-8").read())
    texts = strange_texts()
    assert [count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    for r in merge_counts.token_counts(docs.where("doc_id is not null"), vocabulary()).join(docs.distinct(), "doc_id").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 2048)
    assert merge_counts.token_counts(docs, vocabulary()).count() == docs.count() and merge_counts.token_counts(none, vocabulary()).count() == 0


def test_heap_merging_is_greedy_by_rank():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2, ("a", "a"): 3}
    assert merge_counts.merged_length(list("abcaa"), ranks) == 2
    assert merge_counts.merged_length(list("aaa"), ranks) == 2 and merge_counts.merged_length([], ranks) == 0


def test_token_files(spark, docs, none, library, tmp_path):
    import pyarrow as pa

    texts = strange_texts()
    encode = frames.Encoder(open(vocabulary(), encoding="utf-8").read(), 2)
    assert list(encode(pa.array(texts))) == [np.array([*e.ids, 2], "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    ordered = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for r in ordered:
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        expected.append((r[0], start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    folder = str(tmp_path / "tokens")
    files = frames.write_files(docs, folder, vocabulary())
    key = lambda r: (r[1], r[2])
    assert sorted((tuple(r) for r in frames.read_files(spark, folder, files).collect()), key=key) == sorted(expected, key=key)
    some = frames.read_files(spark, folder, files, wanted=[3, 5]).collect()
    assert sorted(map(tuple, some)) == sorted(x for x in expected if x[0] in (3, 5))
    assert frames.token_files(none, vocabulary()).count() == 0


def test_frames_are_independent_and_checked(tmp_path):
    import pyarrow.fs as fs

    path = tmp_path / "x.tokens"
    payloads = [np.arange(i, dtype="<u4").tobytes() for i in range(200)]
    with open(path, "wb") as out:
        writer = frames.FrameWriter(out, frame_tokens=500)
        for i, p in enumerate(payloads):
            writer.add(i * 2, p)
        writer.close()
    reader = frames.FrameReader(fs.LocalFileSystem().open_input_file(str(path)))
    opened = []
    reader.frame = lambda i, f=reader.frame: opened.append(i) or f(i)
    assert list(reader.documents([300, 301])) == [(300, payloads[150])] and len(opened) == 1
    assert [x[1] for x in reader.documents()] == payloads
    data = bytearray(path.read_bytes())
    data[30] ^= 255
    path.write_bytes(data)
    with pytest.raises(Exception, match="damaged|decompress|corrupt|Data"):
        list(frames.FrameReader(fs.LocalFileSystem().open_input_file(str(path))).documents())


def test_site_lines(spark):
    rows = [(i, "h", f"menu\nbody {i}\n\n footer ", "x") for i in range(10)] + [(20, "g", "menu\nbody", "x"), (21, None, None, "x"), (22, "h", "", "x"), (20, "g", "menu\nbody", "x")]
    got = site_lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, host string, text string, line string")).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.doc_id == 3} == {"body 3"}
    assert {(r.text, r.n_lines, r.n_dropped) for r in got if r.doc_id in (20, 21, 22)} == {("menu\nbody", 2, 0), ("", 0, 0)}
    assert site_lines.drop_boilerplate(spark.createDataFrame([], "doc_id long, host string, text string")).count() == 0


def test_a_large_host_is_dealt_to_several_groups(spark, monkeypatch):
    rows = [(i % 40, "big" if i % 3 else f"h{i % 5}", f"menu\nbody {i}\nfooter {i % 2}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    whole = sorted(map(tuple, site_lines.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(site_lines, "AT_ONCE", 7)
    assert sorted(map(tuple, site_lines.drop_boilerplate(docs).collect())) == whole
    assert all("menu" not in r[2] for r in whole if r[1] == "big")


def solved(p, n, wanted, steps=4000):
    """Plain projected gradient steps."""
    r, present = np.ones(len(n)), (p * n[:, None]).sum(0)
    for _ in range(steps):
        r = np.maximum(0, r - p @ (((p * (n * r)[:, None]).sum(0) - wanted) / present))
    return r


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(0)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 60), rng.integers(1, 500, 60)
    members = spark.createDataFrame([(int(i), int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    got = mixing.solve_rates(members, targets, list(targets), total_tokens=8000.0, tolerance=1e-7, max_steps=200).orderBy("doc_id").collect()
    rates = np.array([r.rate for r in got])
    totals = (p * (n * rates)[:, None]).sum(0)
    assert (rates >= 0).all() and np.allclose(totals, [4800, 2400, 800], rtol=0.01)
    assert np.allclose(totals, (p * (n * solved(p, n, np.array([4800.0, 2400, 800])))[:, None]).sum(0), rtol=0.01)


@pytest.mark.parametrize("sharp", [0.02, 0.3, 0.6])
@pytest.mark.parametrize("targets", [{"high": 0.94, "low": 0.05, "toxic": 0.01}, {"high": 0.998, "toxic": 0.002}])
def test_default_rates_meet_small_targets(spark, targets, sharp):
    """With the defaults every domain is within 1 % of its own target, also with soft posteriors."""
    rng, k = np.random.default_rng(1), len(targets)
    p, n = rng.dirichlet(sharp * np.array([6.0, 2.0, 1.0][:k]), 3000), rng.integers(1, 500, 3000)
    members = spark.createDataFrame([(int(i), int(c), [float(x) for x in q]) for i, (c, q) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    rates = np.array([r.rate for r in mixing.solve_rates(members, targets, list(targets)).orderBy("doc_id").collect()])
    totals = (p * (n * rates)[:, None]).sum(0)
    assert (rates >= 0).all() and np.allclose(totals, (p * n[:, None]).sum(0)[0] / list(targets.values())[0] * np.array(list(targets.values())), rtol=0.01)


def test_rates_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(1, 100, [0.9, 0.1]), (2, 100, [0.6, 0.4])], "doc_id long, n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="out of reach"):
        rates = [r.rate for r in mixing.solve_rates(members, {"a": 0.5, "b": 0.5}, ["a", "b"]).orderBy("doc_id").collect()]
    assert rates[0] < 0.01 and 2 < rates[1] < 4
    with pytest.warns(UserWarning, match="not solved in 1 steps"):
        mixing.solve_rates(members, {"a": 0.5, "b": 0.5}, ["a", "b"], max_steps=1)


def test_mixing(spark, docs, none):
    labels = spark.createDataFrame([(i, "toxic" if i == 13 else "high") for i in range(14)] + [(None, "high"), (3, None), (999, "other")], "doc_id long, domain string")
    got = mixing.mix(docs, labels, {"high": 0.9, "toxic": 0.1}).collect()
    assert len(got) == docs.count() and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in got)
    assert {r.domain for r in got if r.doc_id == 13} == {"toxic"}
    assert mixing.mix(none, labels, {"high": 0.9, "toxic": 0.1}).count() == 0
    assert mixing.mix(docs, labels.limit(0), {"high": 0.9, "toxic": 0.1}).count() == docs.count()
    assert mixing.mixed(docs, labels, {"high": 0.9, "toxic": 0.1}).columns == docs.columns


def test_mixing_fit_is_no_wider_than_its_words(spark, monkeypatch):
    """Buckets that are the same in all of the sample are left out of the fit, which keeps vectors of all its weights on the driver."""
    texts = [f"all w{i % 7} w{i % 5} {'bad' if i % 3 == 0 else 'good'}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate([*texts, "unseen words"])), "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "toxic" if i % 3 == 0 else "high") for i in range(60)], "doc_id long, domain string")
    sizes, fit = [], mixing.LogisticRegression.fit
    monkeypatch.setattr(mixing.LogisticRegression, "fit", lambda self, df: sizes.append(df.first()["varied" if "varied" in df.columns else "features"].size) or fit(self, df))
    got = {r.doc_id: r.p for r in mixing.posteriors(docs, labelled, ["high", "toxic"]).collect()}
    assert sizes == [9]
    monkeypatch.setattr(mixing, "BUCKETS", 9)  # every bucket comes up, so none is left out
    assert mixing.posteriors(docs, labelled, ["high", "toxic"]).count() == 61
    whole = mixing.HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 16, binary=True).transform(docs.select("doc_id", mixing.words(mixing.F.col("text")).alias("words")))
    sample = whole.join(labelled, "doc_id").select((mixing.F.col("domain") == "toxic").cast("double").alias("label"), "features")
    model = fit(mixing.LogisticRegression(regParam=0.002, maxIter=40, family="multinomial"), sample)
    plain = {r.doc_id: r.p for r in model.transform(whole).select("doc_id", mixing.vector_to_array("probability").alias("p")).collect()}
    assert all(np.allclose(got[i], plain[i], atol=1e-6) for i in plain) and len(got) == len(plain) == 61


def test_mixing_fit_without_any_difference(spark):
    """Equal texts with different labels: no bucket varies, and every document has the labels' shares."""
    docs = spark.createDataFrame([(i, "same words") for i in range(8)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "toxic" if i < 2 else "high") for i in range(8)], "doc_id long, domain string")
    assert all(np.allclose(r.p, [0.75, 0.25], atol=1e-4) for r in mixing.posteriors(docs, labelled, ["high", "toxic"]).collect())


def test_pipeline(spark, sf):
    """Every stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns and kept.count() == ledger.judged(docs).where("kept").count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    one = corpus_pipeline.near_copies(spark, kept, sf)
    assert {r.doc_id for r in one.collect()} == {d for d, _, c in classes(rows, 5, 80) if d == c}
    clean = corpus_pipeline.benchmark_passages(spark, one, sf)
    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    fives = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
    leaks = {r.doc_id for r in one.collect() for f in fives if len(f & {tuple(words(r.text)[i : i + 5]) for i in range(len(words(r.text)))}) > 0.8 * len(f)}
    assert leaks <= {r.doc_id for r in one.collect()} - {r.doc_id for r in clean.collect()}
    assert one.count() - clean.count() <= len(leaks) + 2
    final = corpus_pipeline.run(spark, sf)
    assert final.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and final.count() > 0
