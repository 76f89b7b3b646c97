"""Token counts by byte-pair merging with a heap and a linked list.

A count needs no identifiers: a piece starts as one symbol per character, the lowest-ranked adjacent pair is merged again and
again, and the count is the initial number of symbols less the merges.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcast.llm.common import mapped, texts
from shelfcast.llm.pieces import Pieces

#: Words whose counts a task remembers; beyond that it starts anew.
REMEMBERED = 600_000


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols that are left when no adjacent pair has a rank; ties go to the leftmost pair.

    The heap holds rank * n + place, so that one integer orders by rank and then by place.
    """
    n = left = len(symbols)
    rank_of = ranks.get
    heap = [rank * n + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := rank_of(pair)) is not None]
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, i = divmod(heappop(heap), n)
        j = after[i]
        if j >= n or rank_of((symbols[i], symbols[j])) != rank:
            continue  # one of the two has been merged since
        merged = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = ""
        left -= 1
        after[i] = j = after[j]
        if j < n:
            before[j] = i
            if (rank := rank_of((merged, symbols[j]))) is not None:
                heappush(heap, rank * n + i)
        if (k := before[i]) >= 0 and (rank := rank_of((symbols[k], merged))) is not None:
            heappush(heap, rank * n + k)
    return left


def counter(vocabulary: str) -> Callable[[str], int]:
    """A function that counts the tokens of a text under a tokenizers file with BPE merges, given as its JSON.

    Normalizing and splitting into pieces are the vocabulary's own steps. White space never lies inside a token of such a
    vocabulary, so texts are counted by space-separated words, each of which is worked out once.
    """
    splitter = Pieces(vocabulary)
    merges = json.loads(vocabulary)["model"]["merges"]
    ranks = {tuple(pair if isinstance(pair, list) else pair.split(" ")): i for i, pair in enumerate(merges)}
    known: dict[str, int] = {}
    pieces: dict[str, int] = {}

    def of_piece(piece: str | int) -> int:
        if isinstance(piece, int):
            return 1
        n = pieces.get(piece)
        if n is None:
            if len(pieces) >= REMEMBERED:
                pieces.clear()
            symbols = list(piece)
            symbols[-1] += splitter.suffix
            n = pieces[piece] = merged_length(symbols, ranks)
        return n

    def of_word(word: str) -> int:
        return sum(map(of_piece, splitter.split(word)))

    def count(text: str) -> int:
        total = 0
        for word in text.replace("\n", " ").split(" "):
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[word] = of_word(word) if word else 0
            total += n
        return total

    return count


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document under the tokenizers file at `vocabulary`.

    The file must lower-case and drop white space between words, as a BPE vocabulary with word ends does. A null or empty text
    has 0 bytes and 0 tokens; a null doc_id stays null; repeated rows give repeated rows; other columns are not read. The file is
    read on the driver and sent once to each executor; its size does not depend on the data. No shuffle.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("doc_id", id_type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        count = counter(shipped.value)

        def rows(batch: pa.RecordBatch) -> dict:
            data = texts(batch)
            n = [count(x.decode()) for x in data]
            return {"doc_id": batch.column("doc_id"), "n_bytes": list(map(len, data)), "n_tokens": n, "over_limit": [x > limit for x in n]}

        yield from mapped(rows, schema)(batches)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
