"""Language-model scoring with a hierarchical Pitman-Yor process over word pairs.

A word is drawn in the restaurant of its context, which is the word before it, by its whole hash. A customer
of a context restaurant either joins a table of its word or opens one, which sends a customer to the root restaurant that all contexts
share as parent; the root's tables draw from the uniform distribution over the known words and one for all others. Only
the number of tables per dish matters for predictions, so that is the state. Gibbs sampling unseats customers and seats them
anew given all others. Predictive probabilities are averaged over the states of the last rounds.

How it is spread: words are dealt to parts by ranges of their hashes. A part has all counts of its words, the rows of the root
and of all contexts for them. A first pass over the documents adds the counts of pairs up, by chunk and then by part. A pair that
comes up once has one table whatever happens, so only the other pairs take part in the rounds, with the number of single ones per
word. What parts need from each other in a round is the number of tables per context. Each part tells the tables beyond one a pair to
slices by ranges of the contexts' hashes; a slice adds them up and tells each part the sums it needs, so no task and not the driver
holds all contexts. A part adds one number per context however often that comes up, so a context that precedes a third of all
tokens is no hot key. Within a round the parts seat their customers in parallel given the sums of the round before. A second pass over the
documents sends the tokens to be scored, as counts of (word, context, document) in a chunk, to the parts; a part with many
tokens is scored by many tasks that each get its model.

Chunks are numbered by task and place: a task that runs again must read the same rows in the same order, as a scan of files does.
"""

from __future__ import annotations

import bisect
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import crc, release_shuffles, small_batches, small_enough, stored, texts

#: Least length of a part's vectors over its contexts; they are longer where it has more.
CONTEXTS = 1 << 12
#: Tokens of a chunk of documents, about, bytes of text for which there is one part, and parts for which there is one slice.
CHUNK_TOKENS, PART_BYTES, SLICE_PARTS = 3_000_000, 32_000_000, 4
#: Bytes of payloads, at about so many a token, to be scored by one task, and of text for whose chunks a part's counts are added up first.
SCORED_BYTES, TOKEN_BYTES, COUNTED_BYTES = 48_000_000, 6, 1_000_000_000
#: Parallel rounds of seating, the last ones of which are averaged; strengths of the two levels; steps in which a round unseats all.
ROUNDS, AVERAGED, STRENGTH, STEPS = 6, 3, 1.0, 4
#: Steps to which a part's sums of log10 are rounded on their way to the document's: base and model.
BASE_STEP, STEP = 2.0**-24, 2.0**-16
#: Customers of a dish up to which the chance that one sits alone is exact.
EXACT = 64
#: How payloads are written. They are compressed already; writer and reader hold a row group at a time, so these are small, and sizes are
#: looked at every few rows, since a row can have megabytes.
PAYLOADS = {"compression": "none", "parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4", "parquet.enable.dictionary": "false"}


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; the bytes of equal weight stand together."""
    import zstandard

    parts = []
    for a in arrays:
        parts.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        parts.append(np.ascontiguousarray(a.view("u1").reshape(len(a), a.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _spread(data: bytes) -> list[np.ndarray]:
    import zstandard

    plain, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(plain):
        kind, n = struct.unpack_from("<2sQ", plain, at)
        kind, at = np.dtype("<" + kind.decode()), at + 10
        out.append(np.ascontiguousarray(np.frombuffer(plain, "u1", n * kind.itemsize, at).reshape(kind.itemsize, n).T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _deltas(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.diff(sorted_numbers, prepend=np.uint64(0))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))


def contexts_of(hashes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The restaurant of each token, or of those at some places: the hash of its predecessor; a document begins as if after an end."""
    at = np.arange(len(hashes)) if at is None else at
    return np.where(at > 0, hashes[at - 1], word_hashes([b" "]))


def _edges(hashes: np.ndarray, parts: int) -> list[int]:
    """Where each of equal ranges of hashes begins in sorted ones, and their end."""
    return np.searchsorted(hashes, np.array([-(-(p << 64) // parts) for p in range(parts)], "u8")).tolist() + [len(hashes)]


def _columns(docs: list[tuple[int | None, bool, np.ndarray]], parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Every part with its words in order, the contexts and the documents' places of all its tokens of some documents (id, training, hashes
    with the end). Only the order of the tokens is held for all parts at once.
    """
    words = np.concatenate([d[2] for d in docs])
    order = np.argsort(words, kind="stable")
    owner = np.repeat(np.arange(len(docs), dtype="u4"), [len(d[2]) for d in docs])
    edges = [bisect.bisect_left(order, -(-(p << 64) // parts), key=words.__getitem__) for p in range(parts)] + [len(words)]
    for p in range(parts):
        at = order[edges[p] : edges[p + 1]]
        yield p, words[at], contexts_of(words, at), owner[at]


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array and the place of each entry's value among them."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new], np.cumsum(new, dtype="i8") - 1


def count_rows(docs: list[tuple[int | None, bool, np.ndarray]], parts: int) -> Iterator[tuple[int, bytes, int]]:
    """(part, packed training counts, tokens) of some documents, for every part."""
    training = np.array([d[1] for d in docs])
    for p, words, contexts, owner in _columns(docs, parts):
        train, tokens = training[owner], len(words)
        del owner
        known, word = _runs(words[train])
        del words
        before, place = np.unique(contexts, return_inverse=True)
        del contexts
        word *= max(CONTEXTS, len(before))
        word += place[train]
        del place, train
        yield p, _packed(known, before, *np.unique(word, return_counts=True)), tokens


def chunk_rows(chunk: int, docs: list[tuple[int | None, bool, np.ndarray]], parts: int) -> Iterator[tuple[int, int, bytes]]:
    """(part, chunk, payload) of the tokens of some documents (id, training, hashes with the end).

    In a chunk training documents come first. A payload holds the number of documents and of training ones, the part's distinct
    words as differences, how many entries each has, its distinct contexts as differences, and per entry (word, context, document) the place
    of its context among them, its document and its tokens. One part also has the ids.
    """
    docs = sorted(docs, key=lambda d: not d[1])
    head = np.array([len(docs), sum(d[1] for d in docs)], "u8")
    ids = np.array([x[0] or 0 for x in docs], "i8"), np.array([x[0] is None for x in docs], "u1")
    for p, words, contexts, owner in _columns(docs, parts):
        home = chunk % parts == p
        if len(words) or home:
            distinct, word = _runs(words)
            named = ids if home else (ids[0][:0], ids[1][:0])
            before, place = np.unique(contexts, return_inverse=True)
            entry = np.lexsort((owner, place, word))
            word, place, document = word[entry], place[entry], owner[entry]
            new = np.ones(len(words), bool)
            new[1:] = (word[1:] != word[:-1]) | (place[1:] != place[:-1]) | (document[1:] != document[:-1])
            first = np.flatnonzero(new)
            n = np.diff(first, append=len(words)).astype("u4")
            yield p, chunk, _squeeze(head, _deltas(distinct), np.bincount(word[first], minlength=len(distinct)).astype("u4"), _deltas(before), place[first].astype("u4"), document[first], n, *named)


class Chunk:
    def __init__(self, payload: bytes):
        (self.n_docs, self.n_train), words, counts, before, self.context_at, self.owner, self.tokens, self.ids, self.nulls = _spread(payload)
        self.contexts = np.cumsum(before, dtype="u8")
        self.n_docs, self.words = int(self.n_docs), np.cumsum(words, dtype="u8")
        self.word_at = np.repeat(np.arange(len(self.words)), counts)
        self.train = self.owner < self.n_train


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype("i8")
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(words: np.ndarray, contexts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> bytes:
    width = max(CONTEXTS, len(contexts))
    variety = np.bincount(keys // width, minlength=len(words))
    return _squeeze(_deltas(words), variety.astype("u4"), (keys % width).astype("u4"), counts, _deltas(contexts))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the place of each pair's word and of its context, counts, contexts."""
    words, variety, context, counts, before = _spread(data)
    return np.cumsum(words, dtype="u8"), np.repeat(np.arange(len(words)), variety), context, counts, np.cumsum(before, dtype="u8")


def _distinct(found: Iterator[tuple[np.ndarray, ...]], columns: int) -> list[np.ndarray]:
    """Distinct numbers of each column, in order; those that come up in many rows do not pile up."""
    held, size = [[np.zeros(0, "u8")] * columns], 0
    for row in found:
        held.append(row)
        size += sum(map(len, row))
        if size > sum(map(len, held[0])) + CHUNK_TOKENS // 8:
            held, size = [[np.unique(np.concatenate(x)) for x in zip(*held)]], 0
    return [np.unique(np.concatenate(x)) for x in zip(*held)]


def combined(packs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct training words of a part, the contexts of all its tokens, its pairs (word place * width + context place) in order, and their
    counts; the width is the number of contexts, CONTEXTS at least. The packs are unpacked one at a time.
    """
    words, contexts = _distinct((_unpacked(x)[::4] for x in packs), 2)
    width = max(CONTEXTS, len(contexts))
    keys, counts = np.zeros(0, "i8"), np.zeros(0, "i8")
    held, size = [(keys, counts)], 0
    for pack in packs:
        mine, at, context, n, before = _unpacked(pack)
        held.append((np.searchsorted(words, mine)[at] * width + np.searchsorted(contexts, before)[context], n))
        size += len(n)
        if size > len(held[0][0]) // 2 + CHUNK_TOKENS // 8:  # so that pairs which come up in many chunks do not pile up
            held, size = [_added(*(np.concatenate(x) for x in zip(*held)))], 0
    return words, contexts, *_added(*(np.concatenate(x) for x in zip(*held)))


def merge(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What `merged` finds, without the contexts."""
    words, _, keys, counts = merged(payloads)
    return words, keys, counts


def alone(discount: float) -> np.ndarray:
    """alone[n, t]: the chance that one of n customers at t tables sits alone, from the generalized Stirling numbers."""
    logs = np.full((EXACT + 1, EXACT + 2), -np.inf)
    logs[1, 1] = 0.0
    t = np.arange(EXACT + 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(1, EXACT):
            stay = np.where(n - t * discount > 0, np.log(np.maximum(n - t * discount, 1e-300)), -np.inf) + logs[n]
            logs[n + 1, 1:] = np.logaddexp(logs[n, :-1], stay[1:])
        out = np.exp(logs[:-1, :-1] - logs[1:, 1:])  # S(n - 1, t - 1) / S(n, t)
    table = np.zeros((EXACT + 1, EXACT + 2))
    table[1:, 1:] = np.nan_to_num(out, nan=0.0, posinf=0.0)
    return np.clip(table, 0, 1)


def reseat(tables: np.ndarray, customers: np.ndarray, opening: np.ndarray, discount: float, lonely: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One Gibbs round over dishes with two customers or more; opening is the weight of a new table of each dish.

    A step unseats a quarter of a dish's customers, for up to four customers one at a time: a table goes if the customer sat alone
    there, and a seated customer opens one with weight `opening` against (customers - discount * tables).
    """
    t, moved = tables.copy(), -(-customers // STEPS)
    single, many = np.flatnonzero(moved == 1), np.flatnonzero(moved > 1)
    for _ in range(STEPS):
        if len(single):
            n, now, open_ = customers[single], t[single], opening[single]
            now = now - (rng.random(len(n)) < lonely[n, now])
            t[single] = now + (rng.random(len(n)) < open_ / (n - 1 - discount * now + open_))
        if len(many):
            n, now, k, open_ = customers[many], t[many], moved[many], opening[many]
            exact = n <= EXACT
            leave = np.where(exact, lonely[np.where(exact, n, 0), np.where(exact, now, 0)], np.minimum(1.0, discount * (now - 1) / (n - 1)))
            now = np.maximum(1, now - rng.binomial(k, leave))
            t[many] = np.minimum(n, now + rng.binomial(k, open_ / (n - k - np.minimum(discount * now, n - k) + open_)))
    return np.clip(t, 1, customers)


class Sums:
    """What a part knows of the others: training tokens, distinct words, discounts, customers and tables per context of its own, and the root's."""

    def __init__(self, tokens: int, words: int, discounts: tuple[float, float], customers: np.ndarray, tables: np.ndarray, root_customers: float, root_tables: float):
        self.tokens, self.words, self.discounts, self.customers, self.tables = tokens, words, discounts, customers, tables
        self.root_customers, self.root_tables = root_customers, root_tables

    def root(self, customers: np.ndarray | int, tables: np.ndarray | int) -> np.ndarray:
        """Probabilities in the root of words with these customers and tables there."""
        d = self.discounts[0]
        return (customers - d * tables + (STRENGTH + d * self.root_tables) / (self.words + 1)) / (STRENGTH + self.root_customers)

    def back_off(self) -> np.ndarray:
        """Per context the weight of the root's probability."""
        return (STRENGTH + self.discounts[1] * self.tables) / (STRENGTH + self.customers)


class Part:
    """The customers of a part's words and their seating; contexts are places among the part's own.

    single: pairs per word that come up once and are not among those given; each has one table.
    """

    def __init__(self, number: int, words: int, at: np.ndarray, context: np.ndarray, counts: np.ndarray, contexts: np.ndarray, single: np.ndarray | None = None):
        self.number, self.n_words, self.at, self.context, self.counts = number, words, at.astype("i4"), context, counts.astype("i4")
        self.contexts, self.single = contexts, np.zeros(words, "i8") if single is None else single
        self.several = np.flatnonzero(self.counts > 1)
        self.tables, self.root_tables = np.ones(len(at), "i4"), np.ones(words, "i8")
        self._count()

    def _count(self) -> None:
        self.root_customers = self.single + np.bincount(self.at, self.tables, self.n_words).astype("i8")

    def take_seats(self, tables: np.ndarray, root_tables: np.ndarray) -> None:
        """A seating: tables of the pairs that come up several times, and the root's."""
        self.tables[self.several], self.root_tables = tables, root_tables.astype("i8")
        self._count()

    def seats(self) -> tuple[np.ndarray, np.ndarray]:
        return self.tables[self.several], self.root_tables

    def seat(self, sums: Sums, turn: int) -> None:
        rng = np.random.Generator(np.random.Philox(key=[self.number, turn]))
        d_root, d = sums.discounts
        if len(self.several):
            at, context = self.at[self.several], self.context[self.several]
            opening = (STRENGTH + d * sums.tables[context]) * sums.root(self.root_customers, self.root_tables)[at]
            self.tables[self.several] = reseat(self.tables[self.several], self.counts[self.several], opening, d, alone(d), rng)
        self._count()
        self.root_tables = np.minimum(self.root_tables, self.root_customers)
        shared = np.flatnonzero(self.root_customers > 1)
        if len(shared):
            opening = np.full(len(shared), (STRENGTH + d_root * sums.root_tables) / (sums.words + 1))
            self.root_tables[shared] = reseat(self.root_tables[shared], self.root_customers[shared], opening, d_root, alone(d_root), rng)

    def beyond(self) -> np.ndarray:
        """Tables per context beyond one a pair."""
        return np.bincount(self.context, self.tables - 1, len(self.contexts)).astype("i8")


#: What parts and slices tell each other: a part's counts (merged), those of its pairs that come up several times (thin), its contexts (own), its
#: seating (state), what it adds to a slice (told); what it gets for all its contexts (sums, more) and for those of thin (base, extra).
PIECE = pa.schema([("part", pa.int32()), ("kind", pa.string()), ("turn", pa.int32()), ("slice", pa.int64()), ("payload", pa.binary()), ("root_customers", pa.int64()), ("root_tables", pa.int64())])
PIECE_KIND = "part int, kind string, turn int, slice long, payload binary, root_customers long, root_tables long"


def _pieces(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(PIECE.names, r)) for r in rows], schema=PIECE)


def _cut(contexts: np.ndarray, slices: int) -> Iterator[tuple[int, int, int]]:
    """Every slice that has some of the sorted contexts, and where they are."""
    edges = _edges(contexts, slices)
    return ((q, edges[q], edges[q + 1]) for q in range(slices) if edges[q] < edges[q + 1])


def _first_rows(number: int, words: np.ndarray, contexts: np.ndarray, keys: np.ndarray, counts: np.ndarray, slices: int) -> list[tuple]:
    """What a part has to begin with, and tells slices of its contexts: whether thin has them, pairs and customers."""
    width = max(CONTEXTS, len(contexts))
    at, context, several = keys // width, keys % width, counts > 1
    used = np.zeros(len(contexts), "u1")
    used[context[several]] = 1
    place = np.cumsum(used) - 1
    single, many = (np.bincount(at[x], minlength=len(words)).astype("u4") for x in (~several, several))
    thin = _squeeze(single, many, place[context[several]].astype("u4"), counts[several], _deltas(contexts[used > 0]))
    rows = [(number, "merged", 0, 0, _packed(words, contexts, keys, counts), 0, 0), (number, "thin", 0, 0, thin, 0, 0)]
    pairs, customers = np.bincount(context, minlength=len(contexts)), np.bincount(context, counts, len(contexts)).astype("i8")
    return rows + [(number, "own", 0, q, _squeeze(_deltas(contexts[a:b]), used[a:b], pairs[a:b], customers[a:b]), 0, 0) for q, a, b in _cut(contexts, slices)]


def _thin(number: int, payload: bytes) -> Part:
    single, many, context, counts, contexts = _spread(payload)
    return Part(number, len(single), np.repeat(np.arange(len(many)), many), context, counts, np.cumsum(contexts, dtype="u8"), single.astype("i8"))


def _hashed(batches) -> Iterator[list[tuple[int | None, bool, np.ndarray]]]:
    """The documents of a task in chunks: id, training, hashes with the end."""
    end, held, size = word_hashes([b" "]), [], 0
    for batch in batches:
        for doc_id, train, text in zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), texts(batch)):
            held.append((doc_id, train, np.concatenate([word_hashes(text.lower().split()), end])))
            size += len(held[-1][2])
            if size >= CHUNK_TOKENS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _counted(docs: DataFrame, parts: int, slots: int, slices: int) -> DataFrame:
    """The first pieces of every part, written, with its number of tokens and facts on the training counts.

    The payload of merged is in a column of its own, model, that the rounds do not read.
    """
    schema = pa.schema([("part", pa.int32()), ("slot", pa.int32()), ("counts", pa.binary()), ("tokens", pa.int64())])

    def encode(batches):
        from pyspark import TaskContext

        slot = TaskContext.get().partitionId() % slots
        for held in _hashed(batches):
            for part, counts, tokens in count_rows(held, parts):
                yield pa.RecordBatch.from_pylist([{"part": part, "slot": slot, "counts": counts, "tokens": tokens}], schema=schema)

    def add(rows):
        return pa.table({"part": rows.column("part")[:1], "counts": pa.array([_packed(*combined(rows.column("counts").to_pylist()))], pa.binary()), "tokens": [sum(rows.column("tokens").to_pylist())]})

    def count(rows):
        words, contexts, keys, counts = combined(rows.column("counts").to_pylist())
        variety = np.bincount(keys // max(CONTEXTS, len(contexts)), minlength=len(words))
        facts = [int(counts.sum()), len(words), int((counts == 1).sum()), int((counts == 2).sum()), int((variety == 1).sum()), int((variety == 2).sum()), len(keys), sum(rows.column("tokens").to_pylist())]
        model, *others = _first_rows(rows.column("part")[0].as_py(), words, contexts, keys, counts, slices)
        out = _pieces([(*model[:4], None, *model[5:]), *others])
        out = out.append_column("model", pa.array([model[4]] + [None] * len(others), pa.binary()))
        return out.append_column("facts", pa.array([facts] + [None] * len(others), pa.list_(pa.int64())))

    with small_batches(docs.sparkSession):
        each = docs.mapInArrow(encode, "part int, slot int, counts binary, tokens long")
        if slots > 1:
            each = each.groupBy("part", "slot").applyInArrow(add, "part int, counts binary, tokens long")
        return stored(each.select("part", "counts", "tokens").groupBy("part").applyInArrow(count, f"{PIECE_KIND}, model binary, facts array<long>"), "language-model", **PAYLOADS)


class Slice:
    """The contexts of a slice, from what parts say of theirs."""

    def __init__(self, rows: pa.Table, kind: str):
        here = rows.filter(pa.compute.equal(rows.column("kind"), kind))
        self.turns, self.number = here.column("turn").to_pylist(), rows.column("slice")[0].as_py()
        self.parts, self.found = here.column("part").to_pylist(), [_spread(x) for x in here.column("payload").to_pylist()]
        self.own = [np.cumsum(x[0], dtype="u8") for x in self.found]
        self.contexts = np.unique(np.concatenate(self.own)) if self.own else np.zeros(0, "u8")

    def total(self, which: int, turn: int = 0) -> np.ndarray:
        out = np.zeros(len(self.contexts), "i8")
        for own, values, t in zip(self.own, self.found, self.turns):
            if t == turn:
                out[np.searchsorted(self.contexts, own)] += values[which]
        return out


def _first_sums(rows: pa.Table) -> pa.Table:
    """Pairs and customers of the contexts, to every part for all of its own and for those of thin."""
    s, out = Slice(rows, "own"), []
    pairs, customers = s.total(2), s.total(3)
    for part, own, values in zip(s.parts, s.own, s.found):
        place = np.searchsorted(s.contexts, own)
        thin = place[values[1] > 0]
        out += [(part, "sums", 0, s.number, _squeeze(pairs[place], customers[place]), 0, 0), (part, "base", 0, s.number, _squeeze(pairs[thin], customers[thin]), 0, 0)]
    return _pieces(out)


def _extra(rows: pa.Table) -> pa.Table:
    """Tables beyond one a pair, to every part for the contexts it told."""
    s = Slice(rows, "told")
    extra = s.total(1, s.turns[0])
    return _pieces([(part, "extra", s.turns[0], s.number, _squeeze(extra[np.searchsorted(s.contexts, own)]), 0, 0) for part, own in zip(s.parts, s.own)])


def _last_sums(turns: range):
    """Tables beyond one a pair in several rounds, to every part for all of its contexts."""

    def run(rows: pa.Table) -> pa.Table:
        told, all_ = Slice(rows, "told"), Slice(rows, "own")
        out = []
        for turn in turns:
            extra = np.zeros(len(all_.contexts), "i8")
            extra[np.searchsorted(all_.contexts, told.contexts)] = told.total(1, turn)
            out += [(part, "more", turn, all_.number, _squeeze(extra[np.searchsorted(all_.contexts, own)]), 0, 0) for part, own in zip(all_.parts, all_.own)]
        return _pieces(out)

    return run


class Told:
    """A part and the sums it got, from the pieces of a group: from thin, base and extra, or from merged, sums and more."""

    def __init__(self, rows: pa.Table, fixed: tuple, roots: list[tuple[float, float]]):
        held: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
        payloads = rows.column("payload")
        for i, (kind, turn, q) in enumerate(zip(*(rows.column(x).to_pylist() for x in ("kind", "turn", "slice")))):
            if kind != "chunk":  # their payloads are read one at a time
                held.setdefault((kind, turn), []).append((q, payloads[i].as_py()))
        self.held, self.fixed, self.roots, self.whole = held, fixed, roots, ("merged", 0) in held
        number = rows.column("part")[0].as_py()
        if self.whole:
            self.words, at, context, counts, contexts = _unpacked(held["merged", 0][0][1])
            self.part = Part(number, len(self.words), at, context, counts, contexts)
        else:
            self.part = _thin(number, held["thin", 0][0][1])
        first = "sums" if self.whole else "base"
        self.pairs, self.customers = self._vector(first, 0, 0), self._vector(first, 0, 1)

    def _vector(self, kind: str, turn: int, which: int) -> np.ndarray:
        found = [_spread(x)[which] for _, x in sorted(self.held.get((kind, turn), []))]
        return np.concatenate(found) if found else np.zeros(len(self.part.contexts), "i8")

    def sums(self, turn: int) -> Sums:
        return Sums(*self.fixed, self.customers, self.pairs + self._vector("more" if self.whole else "extra", turn, 0), *self.roots[turn])

    def take_seats(self, turn: int) -> Part:
        if ("state", turn) in self.held:
            self.part.take_seats(*_spread(self.held["state", turn][0][1]))
        return self.part

    def rows(self, turn: int, slices: int) -> list[tuple]:
        """The part's seating and what it adds to the slices."""
        part, beyond = self.part, self.part.beyond()
        rows = [(part.number, "state", turn, 0, _squeeze(*part.seats()), int(part.root_customers.sum()), int(part.root_tables.sum()))]
        return rows + [(part.number, "told", turn, q, _squeeze(_deltas(part.contexts[a:b]), beyond[a:b]), 0, 0) for q, a, b in _cut(part.contexts, slices)]


def score_texts(docs: DataFrame, rounds: int = ROUNDS, averaged: int = AVERAGED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document (doc_id, text).

    Documents whose id's crc32 is 1 modulo 5 are held out; the others train. Tokens are the words of the lower-cased text and an
    end. base_score is the log10 probability under add-half word frequencies, score that under the process. A null or empty
    text is the end alone; a null doc_id counts as the empty text for the fold; repeated rows count and are scored each; ids must be integers; other
    columns are not read. An empty table gives an empty result; without training documents the probabilities are uniform.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // PART_BYTES) + 1
    slices = -(-parts // SLICE_PARTS)
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.pmod(crc(F.col("doc_id")), F.lit(5)) != 1).alias("train"), "text")
    table = _counted(flagged, parts, int(size // COUNTED_BYTES) + 1, slices)
    facts = [float(x or 0) for x in table.agg(*(F.sum(F.get("facts", F.lit(i))) for i in range(7))).first()]
    discount = lambda once, twice: min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    fixed = (int(facts[0]), int(facts[1]), (discount(facts[4], facts[5]), discount(facts[2], facts[3])))
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    only = lambda df, *kinds: df.where(F.col("kind").isin(*kinds)).select(*PIECE.names)
    first = stored(only(table, "own").groupBy("slice").applyInArrow(_first_sums, PIECE_KIND), "context-sums", **PAYLOADS)
    states, told, roots, extra = [], [], [(facts[6], facts[1])], None

    def seating(turn: int, roots: tuple):
        def seat(rows):
            here = Told(rows, fixed, roots)
            here.take_seats(turn - 1).seat(here.sums(turn - 1), turn - 1)
            return _pieces(here.rows(turn, slices))

        return seat

    for turn in range(1, rounds + 1):
        known = only(table, "thin").unionAll(only(first, "base"))
        for more in [*states[-1:], *([extra] if extra else [])]:
            known = known.unionAll(more)
        seated = stored(known.groupBy("part").applyInArrow(seating(turn, tuple(roots)), PIECE_KIND), "seating", **PAYLOADS)
        states.append(only(seated, "state"))
        told.append(only(seated, "told"))
        root = states[-1].agg(F.sum("root_customers"), F.sum("root_tables")).first()
        roots.append((float(root[0] or 0), float(root[1] or 0)))
        if turn < rounds:
            extra = stored(told[-1].groupBy("slice").applyInArrow(_extra, PIECE_KIND), "context-sums", **PAYLOADS)
        release_shuffles(spark)

    last = range(max(1, rounds - averaged + 1), rounds + 1)

    def predict(rows: pa.Table) -> pa.Table:
        model, payloads = Predictor(Told(rows, fixed, roots), last), rows.column("payload")
        places = [i for i, kind in enumerate(rows.column("kind").to_pylist()) if kind == "chunk"]
        return pa.table({"chunk": rows.column("slice").take(pa.array(places, pa.int64())), "payload": pa.array([model.chunk(payloads[i].as_py()) for i in places], pa.binary())})

    ending = only(table, "own")
    for turn in last:
        ending = ending.unionAll(told[turn - 1])
    merged = only(table.withColumn("payload", F.col("model")), "merged")
    pieces = merged.unionAll(only(first, "sums")).unionAll(stored(ending.groupBy("slice").applyInArrow(_last_sums(last), PIECE_KIND), "context-sums", **PAYLOADS))
    for turn in last:
        pieces = pieces.unionAll(states[turn - 1])
    release_shuffles(spark)
    tasks = F.greatest(F.lit(1), F.ceil(F.get("facts", F.lit(7)) * TOKEN_BYTES / SCORED_BYTES)).cast("int").alias("tasks")
    tasks = small_enough(stored(table.where(F.col("facts").isNotNull()).select("part", tasks), "scoring-tasks"), 16)
    pieces = pieces.join(tasks, "part").select(F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), *PIECE.names)

    def encode(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), itertools.count()
        for held in _hashed(batches):
            for part, chunk, payload in chunk_rows((task << 24) + next(number), held, parts):
                yield _pieces([(part, "chunk", 0, chunk, payload, 0, 0)]).to_batches()[0]

    scored = flagged.select("doc_id", "train", "text").mapInArrow(encode, PIECE_KIND).join(tasks, "part")
    scored = scored.select(F.pmod(F.xxhash64("slice"), F.col("tasks")).cast("int").alias("task"), *PIECE.names)

    def total(rows: pa.Table) -> pa.Table:
        found = [_spread(x.as_py()) for x in rows.column("payload")]
        n_docs, n_train = found[0][0].tolist()
        sums = np.zeros((4, n_docs))
        for _, docs_, n, known_, base, score, ids, nulls in found:
            for row, x in zip(sums, (n, known_, base, score)):
                row[docs_] += x  # whole numbers: the order of the parts does not matter
            if len(ids):
                names = pa.array(ids, mask=nulls.astype(bool))
        return pa.table({"doc_id": names, "held_out": np.arange(n_docs) >= n_train, "n_tokens": sums[0].astype("i8"), "n_known": sums[1].astype("i8"), "train_tokens": np.full(n_docs, int(facts[0])), "base_score": -sums[2] * BASE_STEP, "score": -sums[3] * STEP})

    with small_batches(spark):
        results = stored(pieces.unionAll(scored).groupBy("part", "task").applyInArrow(predict, "chunk long, payload binary"), "chunk-scores", **PAYLOADS)
    return results.groupBy("chunk").applyInArrow(total, kind)


class Predictor:
    """Averaged predictive probabilities of a part's words."""

    def __init__(self, told: Told, turns: range):
        self.part, self.words = told.part, told.words
        part = self.part
        self.width = max(CONTEXTS, len(part.contexts))
        self.keys = part.at.astype("i8") * self.width + part.context
        self.extra, self.weights, self.roots, self.others = np.zeros(len(self.keys)), [], [], []
        for t in turns:
            last = told.sums(t)
            told.take_seats(t)
            self.extra += (part.counts - last.discounts[1] * part.tables) / (STRENGTH + last.customers[part.context])
            self.weights.append(last.back_off())
            self.roots.append(last.root(part.root_customers, part.root_tables))
            self.others.append(last.root(0, 0))
        self.extra /= len(self.weights)
        counts = np.bincount(part.at, part.counts, len(self.words)) if len(self.words) else np.zeros(0)
        below = last.tokens + 0.5 * (last.words + 1)
        self.base, self.base_other = np.log10((counts + 0.5) / below), np.log10(0.5 / below)

    def chunk(self, payload: bytes) -> bytes:
        """Sums over the part's tokens per document of a chunk: documents, tokens, known ones, base and model log10; and the ids."""
        c, part = Chunk(payload), self.part
        place = np.searchsorted(self.words, c.words)
        found = place < len(self.words)
        found[found] = self.words[place[found]] == c.words[found]
        known, at, context = found[c.word_at], place[c.word_at], np.searchsorted(part.contexts, c.contexts)[c.context_at]
        p, base = np.empty(len(at)), np.full(len(at), self.base_other)
        base[known] = self.base[at[known]]
        p[:] = sum(w[context] * other for w, other in zip(self.weights, self.others)) / len(self.weights)
        k_at, k_context = at[known], context[known]
        value = sum(w[k_context] * root[k_at] for w, root in zip(self.weights, self.roots)) / len(self.weights)
        keys = k_at * self.width + k_context
        pair = np.searchsorted(self.keys, keys)
        pair[pair == len(self.keys)] = 0
        p[known] = value + np.where(self.keys[pair] == keys, self.extra[pair], 0.0) if len(self.keys) else value
        logs = np.log10(p)
        docs, where = np.unique(c.owner, return_inverse=True)
        add = lambda x: np.bincount(where, x * c.tokens, len(docs))
        rounded = lambda x, step: np.rint(-x / step).astype("i8")
        head = np.array([c.n_docs, int(c.n_train)], "u8")
        return _squeeze(head, docs, add(1).astype("u4"), add(known.astype(float)).astype("u4"), rounded(add(base), BASE_STEP), rounded(add(logs), STEP), c.ids, c.nulls)
