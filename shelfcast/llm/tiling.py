"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, a run of a few words, are tiled: the longest common runs of words that do not
overlap earlier ones are marked again and again, found with Karp-Rabin hashes, until none of the least length is left. The share of
the item that is marked does not depend on the order of its passages in the document.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import small_batches, small_enough, stored, texts

#: Base of the running hashes; any large odd number.
BASE = 0x9E3779B97F4A7C15
#: Words of benchmark text that one pass over the documents holds in memory.
BLOCK_WORDS = 1_000_000


def windows(numbers: np.ndarray, k: int) -> np.ndarray:
    """Running hashes of all windows of k numbers, modulo 2 to the 64."""
    if len(numbers) < k:
        return np.zeros(0, "u8")
    out = np.zeros(len(numbers) - k + 1, "u8")
    for i in range(k):
        out = out * np.uint64(BASE) + numbers[i : len(numbers) - k + 1 + i].astype("u8")
    return out


def tiles(a: list[int], b: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in a, place in b, length) of two number sequences, longest first, then by place.

    Every round hashes the unmarked windows of `least` words in `a` and looks those of `b` up. Windows that are equal are extended word
    by word, and the round marks the longest matches.
    """
    free_a, free_b, found = [True] * len(a), [True] * len(b), []
    while True:
        best: list[tuple[int, int, int]] = []
        places = defaultdict(list)
        for i, h in enumerate(windows(np.array(a, "i8"), least).tolist()):
            if all(free_a[i : i + least]):
                places[h].append(i)
        longest = least
        for j, h in enumerate(windows(np.array(b, "i8"), least).tolist()):
            if not places.get(h) or not all(free_b[j : j + least]):
                continue
            for i in places[h]:
                if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                    continue  # part of a match that began earlier
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n >= longest:
                    best = [*best, (i, j, n)] if n == longest else [(i, j, n)]
                    longest = n
        if not best:
            return found
        for i, j, n in sorted(best):
            if all(free_a[i : i + n]) and all(free_b[j : j + n]):
                free_a[i : i + n] = free_b[j : j + n] = [False] * n
                found.append((i, j, n))


class Benchmark:
    """A block of benchmark items as word numbers, with the places of their seeds."""

    def __init__(self, items: list[tuple[int, bytes]], seed: int):
        self.number: dict[bytes, int] = {}
        self.items = [(i, [self.number.setdefault(w, len(self.number) + 1) for w in text.lower().split()]) for i, text in items]
        self.seed, found = seed, defaultdict(set)
        for k, (_, words) in enumerate(self.items):
            for h in windows(np.array(words, "i8"), seed).tolist():
                found[h].add(k)
        self.hashes = np.array(sorted(found), "u8")
        self.holders = [sorted(found[h]) for h in self.hashes.tolist()]

    def coverage(self, text: bytes, share: float) -> list[tuple[int, int, int, int, list]]:
        """(item, covered words, item words, tiles, their places) of the items that tiles of the text cover to `share` or more."""
        numbers = np.fromiter(map(self.number.get, words := text.lower().split(), [0] * len(words)), "i8", len(words))
        hashes = windows(numbers, self.seed)
        if not len(hashes) or not len(self.hashes):
            return []
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        hits = np.flatnonzero(self.hashes[at] == hashes)
        if not len(hits):
            return []
        by_item: dict[int, list[int]] = defaultdict(list)
        for place, h in zip(hits.tolist(), at[hits].tolist()):
            for k in self.holders[h]:
                by_item[k].append(place)
        out = []
        for k, places in by_item.items():
            item, wanted = self.items[k]
            # Only words under a seed that the two share can be in a tile; one 0 stands for what lies between.
            part, origin, end = [], [], -1
            for p in places:
                if p > end:
                    part.append(0)
                    origin.append(-1)
                first = max(p, end)
                part += numbers[first : p + self.seed].tolist()
                origin += range(first, p + self.seed)
                end = p + self.seed
            found = tiles(part, wanted, self.seed)
            covered = sum(n for _, _, n in found)
            if found and covered >= share * len(wanted):
                out.append((item, covered, len(wanted), len(found), [(origin[i], j, n) for i, j, n in found]))
        return out


def blocks(benchmark: DataFrame, block_words: int):
    """The benchmark in blocks of bounded size, each collected by itself, in the order of item_id."""
    sized = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // (6 * block_words)) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield [(r[0], r[1].encode()) for r in sized.where(block == i).orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, seed: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, covered, item_words, tiles and spans of every document and item with covered >= share * item_words.

    spans lists the tiles as (first word in the document, first word in the item, words). Words are lower-cased (A-Z). An item
    shorter than `seed` words has no seed and matches nothing; null or empty texts match nothing; null ids stay null; repeated
    rows of documents give repeated rows, those of the benchmark do not; other columns are not read. The benchmark is held in
    blocks of a bounded number of words, one pass over the documents each, so its size has no limit. No shuffle.
    """
    spark, parts = docs.sparkSession, []
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    span = pa.list_(pa.struct([(x, pa.int64()) for x in ("doc_word", "item_word", "words")]))
    schema = pa.schema([("doc_id", id_type), *((x, pa.int64()) for x in ("item_id", "covered", "item_words", "tiles")), ("spans", span)])
    declared = f"doc_id {kind}, item_id long, covered long, item_words long, tiles long, spans array<struct<doc_word: long, item_word: long, words: long>>"
    for items in blocks(benchmark, block_words):
        shipped = spark.sparkContext.broadcast(items)

        def run(batches, shipped=shipped):
            held = Benchmark(shipped.value, seed)
            for batch in batches:
                rows = [(d, *x) for d, text in zip(batch.column("doc_id").to_pylist(), texts(batch)) for x in held.coverage(text, share)]
                if rows:
                    columns = list(zip(*rows))
                    columns[-1] = [[dict(zip(("doc_word", "item_word", "words"), s)) for s in spans] for spans in columns[-1]]
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns)), schema=schema)

        parts.append(docs.select("doc_id", "text").mapInArrow(run, declared))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents, with all their columns, that cover no item.

    Rows are told apart by id and text, so a row with a null id, or one that shares its id with others, is judged by its own text.
    Null and empty texts cover nothing and stay; repeated rows stay or go together; empty tables change nothing.
    """
    key = [F.col("doc_id"), F.xxhash64("text").alias("hash")]
    hit = contaminated(docs.select(F.struct(*key).alias("doc_id"), "text"), benchmark, **parameters)
    hit = hit.select(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.hash").alias("hit_hash")).distinct()
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64("row.text") == F.col("hit_hash"))
    with small_batches(docs.sparkSession):
        hit = stored(hit, "dropped")
    return whole.join(small_enough(hit, 32), same, "left_anti").select("row.*")
