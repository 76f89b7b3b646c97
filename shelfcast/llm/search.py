"""Ranked lexical search by pipelined term partitioning.

The terms of a block of items are dealt to owners, the rarest first. Documents come in shards of bounded size, so a term that most
documents hold is a short list in each of many shards. A bundle has, for one shard, the sparse sums of all items of the block; it goes
from owner to owner by cogroup, and each adds what its terms are worth in whole numbers. A sum that cannot reach the best ones any
more, whatever the owners to come add, is left out; the last owner selects.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import small_batches, stored, texts

#: Letters, digits and all beyond ASCII make terms, A-Z as a-z; the rest separates them.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Documents of a shard, and tokens of the items' terms at which one ends sooner.
SHARD_DOCS, SHARD_TOKENS = 8192, 4_000_000
#: Items of a block and bytes of their texts, about: what every task holds.
BLOCK_ITEMS, BLOCK_BYTES = 256, 4 << 20
#: Shares of all entries up to which the owners, but the last, take terms.
OWNED = (1 / 32, 1 / 8, 1 / 2)
SCALE, FULL, LENGTH_PERCENT = 1_000_000_000, 1000, 25


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def blocks(items: DataFrame) -> Iterator[list[tuple[object, Counter]]]:
    """The different items that have terms, as (id, terms), in blocks of bounded size."""
    rows = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    count = max(n // BLOCK_ITEMS, (size or 0) // BLOCK_BYTES) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        found = [(r[0], Counter(terms_of(r[1].encode()))) for r in rows.where(block == i).orderBy("item_id", "text").collect()]
        if found := [x for x in found if x[1]]:
            yield found


_INDEX = [("shard", "long"), ("n_docs", "long"), ("n_terms", "long"), ("lengths", "array<int>"), ("terms", "array<int>"), ("counts", "array<int>"), ("docs", "array<int>"), ("tf", "array<int>")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _schema(fields: list[tuple[str, str]], *more: pa.Field) -> pa.Schema:
    return pa.schema([*((name, _ARROW[kind]) for name, kind in fields), *more])


def _numbers(rows, name: str, i: int = 0) -> np.ndarray:
    """A list cell as an array."""
    cell = rows.column(name)
    cell = cell.combine_chunks() if isinstance(cell, pa.ChunkedArray) else cell
    return cell[i].values.to_numpy()


def index(docs: DataFrame, wanted: dict[bytes, int]) -> DataFrame:
    """A row for each shard: ids and lengths of its documents and, by term, the documents that hold it and how often."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = pa.field("doc_ids", pa.list_(docs.select("doc_id").limit(0).toArrow().schema.field(0).type))
    schema = _schema(_INDEX, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, lengths, found = [], [], []

        def row() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, found), "i8", len(found))
            at = np.repeat(np.arange(len(found)), sizes)
            key, tf = np.unique(np.concatenate(found).astype("i8") * SHARD_DOCS + at, return_counts=True)
            terms, counts = np.unique(key // SHARD_DOCS, return_counts=True)
            cells = [shard, sum(x > 0 for x in lengths), sum(lengths), lengths, terms - 1, counts, key % SHARD_DOCS, tf, ids]
            return pa.RecordBatch.from_arrays([pa.array([x if isinstance(x, (int, list)) else x.tolist()], type=f.type) for x, f in zip(cells, schema)], schema=schema)

        tokens = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = terms_of(text)
                hits = np.fromiter(filter(None, map(wanted.get, words)), "i4")
                ids.append(doc_id)
                lengths.append(len(words))
                found.append(hits)
                tokens += len(hits)
                if len(ids) == SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield row()
                    shard, tokens = shard + 1, 0
                    ids, lengths, found = [], [], []
        if ids:
            yield row()

    declared = ", ".join(f"{name} {k}" for name, k in _INDEX) + f", doc_ids array<{kind}>"
    return docs.select("doc_id", "text").mapInArrow(run, declared)


def _worth(tf: np.ndarray, lengths: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """What an occurrence count is worth in documents of these lengths, before the weight of its term."""
    m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * lengths.astype("i8") * total_docs) // total_terms
    tf = tf.astype("i8")
    return (SCALE * tf) // (FULL * tf + 12 * m)


def weight(total_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df + 1)))


def _frequencies(shards: DataFrame, total_docs: int, total_terms: int) -> dict[int, tuple[int, int]]:
    """Documents that hold a term, and the most it is worth in one of them; as many terms as a block has."""
    fields = [("term", "int"), ("df", "long"), ("most", "long")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts, docs = _numbers(batch, "counts", i), _numbers(batch, "docs", i)
                if len(counts):
                    worth = _worth(_numbers(batch, "tf", i), _numbers(batch, "lengths", i)[docs], total_docs, total_terms)
                    most = np.maximum.reduceat(worth, np.cumsum(counts) - counts)
                    yield pa.RecordBatch.from_arrays([pa.array(_numbers(batch, "terms", i)), pa.array(counts.astype("i8")), pa.array(most)], schema=_schema(fields))

    each = shards.select("terms", "counts", "docs", "tf", "lengths").mapInArrow(run, ", ".join(map(" ".join, fields)))
    return {r[0]: (r[1], r[2]) for r in each.groupBy("term").agg(F.sum("df"), F.max("most")).collect()}


class Route:
    """Which owner has which terms, what an item adds at each, and the most that is still to come after it."""

    def __init__(self, block: list[tuple[object, Counter]], wanted: dict[bytes, int], facts: dict[int, tuple[int, int]], total_docs: int):
        order = sorted(facts, key=lambda t: (facts[t][0], t))
        upto, entries = np.cumsum([facts[t][0] for t in order]), sum(x[0] for x in facts.values())
        owner = {t: sum(int(upto[i]) > share * entries for share in OWNED) for i, t in enumerate(order)}
        self.owners = len(OWNED) + 1
        self.owner = np.full(max(wanted.values(), default=0), -1)
        for t, o in owner.items():
            self.owner[t] = o
        self.adds: list[list[list[tuple[int, int]]]] = [[] for _ in range(self.owners)]
        self.rest: list[list[int]] = [[] for _ in range(self.owners)]
        for _, counts in block:
            weights = {t: n * weight(total_docs, facts[t][0]) for word, n in counts.items() if (t := wanted[word] - 1) in facts}
            for o in range(self.owners):
                self.adds[o].append([(t, w) for t, w in weights.items() if owner[t] == o and w])
                self.rest[o].append(sum(w * facts[t][1] for t, w in weights.items() if owner[t] > o))


_OWNED = [("shard", "long"), ("lengths", "array<int>"), ("terms", "array<int>"), ("counts", "array<int>"), ("docs", "array<int>"), ("worth", "array<int>")]
_BUNDLE = [("shard", "long"), ("sizes", "array<int>"), ("docs", "array<int>"), ("sums", "array<long>")]


def _owned(shards: DataFrame, route: Route, o: int, total_docs: int, total_terms: int) -> DataFrame:
    """The lists of an owner's terms in each shard."""
    ids = [pa.field("doc_ids", shards.select("doc_ids").limit(0).toArrow().schema.field(0).type)] if o == route.owners - 1 else []
    kind = shards.schema["doc_ids"].dataType.simpleString()
    schema, owner = _schema(_OWNED, *ids), route.owner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms, counts, lengths = (_numbers(batch, c, i) for c in ("terms", "counts", "lengths"))
                mine = owner[terms] == o if len(terms) else np.zeros(0, bool)
                entries = np.repeat(mine, counts)
                docs = _numbers(batch, "docs", i)[entries]
                worth = _worth(_numbers(batch, "tf", i)[entries], lengths[docs], total_docs, total_terms)
                cells = [lengths, terms[mine], counts[mine], docs, worth.astype("i4")]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int32())) for x in cells]
                yield pa.RecordBatch.from_arrays([batch.column("shard").slice(i, 1), *lists, *(batch.column("doc_ids").slice(i, 1) for _ in ids)], schema=schema)

    declared = ", ".join(map(" ".join, _OWNED)) + (f", doc_ids {kind}" if ids else "")
    return shards.mapInArrow(run, declared)


def _added(route: Route, o: int, top: int, bundle: pa.Table, lists: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, documents, sums) of a bundle after an owner's terms; sums that cannot be among the best `top` any more are left out."""
    counts, docs, worth = (_numbers(lists, c) for c in ("counts", "docs", "worth"))
    ends = np.cumsum(counts)
    at = {t: slice(e - n, e) for t, e, n in zip(_numbers(lists, "terms").tolist(), ends.tolist(), counts.tolist())}
    total = len(_numbers(lists, "lengths"))
    sizes, held, sums = (_numbers(bundle, c) for c in ("sizes", "docs", "sums"))
    starts = np.cumsum(sizes) - sizes
    for i, adds in enumerate(route.adds[o]):
        acc = np.zeros(total, "i8")
        if len(sizes):
            part = slice(starts[i], starts[i] + sizes[i])
            acc[held[part]] = sums[part]
        for t, w in adds:
            if t in at:
                acc[docs[at[t]]] += w * worth[at[t]].astype("i8")
        kept = np.flatnonzero(acc)
        if len(kept) > top:
            least = np.partition(acc[kept], -top)[-top]
            kept = kept[acc[kept] + route.rest[o][i] >= least]
        yield i, kept, acc[kept]


def _visit(route: Route, o: int, top: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    schema = _schema(_BUNDLE)

    def run(key: tuple, bundle: pa.Table, lists: pa.Table) -> pa.Table:
        found = list(_added(route, o, top, bundle, lists))
        cells = [[len(d) for _, d, _ in found], np.concatenate([d for _, d, _ in found]), np.concatenate([s for _, _, s in found])]
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, f.type.value_type)) for x, f in zip(cells, list(schema)[1:])]
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), *arrays], schema=schema)

    return run


def _select(route: Route, top: int, item_ids: list, schema: pa.Schema) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def run(key: tuple, bundle: pa.Table, lists: pa.Table) -> pa.Table:
        ids, rows = lists.column("doc_ids")[0].as_py(), []
        for i, docs, sums in _added(route, route.owners - 1, top, bundle, lists):
            best = sorted(zip((-sums).tolist(), (ids[d] for d in docs)), key=lambda x: (x[0], x[1] is None, x[1]))[:top]
            rows += [(i, item_ids[i], d, -s) for s, d in best]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `top` best documents of every item, all with a score above 0 if there are fewer.

    Equal scores rank by ascending doc_id, null last. Null, empty texts and such without terms are found by nothing and find nothing;
    whole texts of any length are read; each of repeated documents has a place of its own; items that repeat id and text are one, those
    that repeat only the id are ranked each; other columns are not read; empty tables give no rows. Items come in blocks of bounded
    size, with one pass over the documents each.
    """
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    id_type = lambda df, name: df.select(name).limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("item", pa.int32()), ("item_id", id_type(items, "item_id")), ("doc_id", id_type(docs, "doc_id")), ("score", pa.int64())])
    declared = f"item int, item_id {item_kind}, doc_id {doc_kind}, score long"
    out = docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in blocks(items):
        wanted = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))), 1)}  # from 1: 0 would not pass `filter`
        with small_batches(docs.sparkSession):
            shards = stored(index(docs, wanted), "search-shards")
        total_docs, total_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not total_docs:
            continue
        route = Route(block, wanted, _frequencies(shards, total_docs, total_terms), total_docs)
        bundles = shards.select("shard", *(F.array().cast(kind).alias(name) for name, kind in _BUNDLE[1:]))
        for o in range(route.owners):
            visit = bundles.groupBy("shard").cogroup(_owned(shards, route, o, total_docs, total_terms).groupBy("shard"))
            if o < route.owners - 1:
                bundles = visit.applyInArrow(_visit(route, o, top), ", ".join(map(" ".join, _BUNDLE)))
        found = visit.applyInArrow(_select(route, top, [i for i, _ in block], schema), declared)
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        out = out.unionAll(ranked.select("item_id", "rank", "doc_id", "score"))
    return out
