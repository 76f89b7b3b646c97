"""N-gram Jaccard join with a token-group matrix.

Documents with equal shingle sets are one node. Nodes that share a minimum hash are put into groups around a leader, and a group
keeps those whose similarity to a leader is verified, so that its nodes are linked with each other through leaders. The matrix holds
for every token the groups whose union has it, with bounds on the sizes and places of the token in the members. A node is a query:
the bound on what it can share with a group decides whether the group is opened, and only members of opened groups are
compared. Groups that a node already belongs to need not be opened, as their nodes have its component.

The matrix needs only the tokens of prefixes: two sets that link share one of the first n - ceil(n * percent / 100) + 1 tokens of
each in any common order. The order puts frequent tokens last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import WORD, small_batches, small_enough, stored, texts
from shelfcast.llm.components import components

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Odd multipliers of the minimum hashes that form groups.
ROUNDS = np.array([(0xBF58476D1CE4E5B9 * (2 * i + 1)) % (1 << 64) for i in range(6)], "u8")
#: A token is frequent from this share of the documents on, and from this count.
FREQUENT_SHARE, FREQUENT = 5e-5, 16
#: Tokens that a task counts at a time; of these it reports those that come up this often.
COUNTED, IN_COUNTED = 1_500_000, 2


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the lower-cased text; all words as one if there are fewer."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, "u8")
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, k, "u8")
    for i in range(k):
        out = out * BASE + hashes[i : len(words) - k + 1 + i]
    out ^= out >> np.uint64(32)
    return np.unique(out * MIX)


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def frequent_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens, sorted, and their counts.

    Tokens are reported only where some documents have them several times, so counts are lower bounds; they order tokens and any
    order gives the same links. A document has its words as tokens at most, so at most (words per document) / FREQUENT_SHARE tokens are frequent,
    whatever the number of documents, and they can be sent to every task.
    """
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def counted(found):
        tokens, counts = np.unique(np.concatenate(found), return_counts=True)
        often = counts >= IN_COUNTED
        return pa.RecordBatch.from_pydict({"token": tokens[often].view("i8"), "n": counts[often]}, schema=schema)

    def run(batches):
        found, held = [], 0
        for batch in batches:
            for text in texts(batch):
                found.append(shingles(text, k))
                held += len(found[-1])
                if held >= COUNTED:
                    yield counted(found)
                    found, held = [], 0
        if held:
            yield counted(found)

    least = max(FREQUENT, int(docs.count() * FREQUENT_SHARE))
    rows = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
    tokens, counts = rows.column("token").to_numpy().view("u8"), rows.column("n").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, key (a 128-bit hash of the set), mins (minimum hashes) and prefix (tokens in order) of every document."""
    shipped = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, k))
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("mins", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        import xxhash

        frequent, counts = shipped.value
        for batch in batches:
            n, keys, mins, prefixes = [], [], [], []
            for text in texts(batch):
                tokens = shingles(text, k)
                n.append(len(tokens))
                if not len(tokens):
                    keys.append(None), mins.append(None), prefixes.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                mixed = tokens[None, :] * ROUNDS[:, None]
                mins.append((mixed ^ (mixed >> np.uint64(29))).min(axis=1).view("i8"))
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                    weight = np.where(frequent[at] == tokens, counts[at], 0)
                    tokens = tokens[np.argsort(weight, kind="stable")]
                prefixes.append(tokens[: len(tokens) - _least_overlap(len(tokens), percent) + 1].view("i8"))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": n, "key": keys, "mins": mins, "prefix": prefixes}, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, key binary, mins array<long>, prefix array<long>")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets, made again from the whole texts, link."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_enough(ids, 24), "doc_id", "left_semi")

    def sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"node": batch.column("doc_id"), "tokens": pa.array([shingles(t, k).tobytes() for t in texts(batch)], pa.binary())})

    def compare(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                a, b = np.frombuffer(a, "u8"), np.frombuffer(b, "u8")
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    known = wanted.mapInArrow(sets, "node long, tokens binary")
    both = pairs.join(known.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(known.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their prefixes do not rule out.

    Of two prefixes one ends first in the common order, and no token of it is in the rest of the other set; so the sets share at
    most the tokens that the prefixes share and the rest of the set whose prefix ends first.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = nodes.select("node", "n", "prefix").join(small_enough(ids, 24), "node", "left_semi")
    side = lambda name: known.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("prefix").alias(f"prefix_{name}"))
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + F.greatest(F.col("n_a") - F.size("prefix_a"), F.col("n_b") - F.size("prefix_b"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent).select("a", "b")


def led_pairs(nodes: DataFrame) -> DataFrame:
    """Nodes with the leader, the smallest node, of the nodes that share a minimum hash, if they meet in two rounds or more.

    This only forms groups; links that it does not see are found by the matrix.
    """
    each = nodes.select("node", F.posexplode("mins").alias("round", "hash"))
    leaders = each.groupBy("round", "hash").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where(F.col("leader") < F.col("last")).drop("last")
    return each.join(leaders, ["round", "hash"]).where(F.col("node") != F.col("leader")).select(F.col("node").alias("a"), F.col("leader").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2).select("a", "b")


def _can_link(percent: int, n1: Column, n2_low: Column, n2_high: Column, rest1: Column, rest2: Column) -> Column:
    """Whether sets of the sizes n1 and n2_low to n2_high can link if they share at most the smaller rest."""
    sizes = (n1 * 100 >= n2_low * percent) & (n2_high * 100 >= n1 * percent)
    return sizes & (F.least(rest1, rest2) * (100 + percent) >= (n1 + n2_low) * percent)


def opened_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different groups that the matrix cannot rule out.

    entries: token, node, n and rest (tokens from this one on) of the prefixes, and group. If two sets link, the first token
    that their prefixes share leaves each of them enough tokens for the overlap they need, and a group's bounds are at least as
    wide as those of each member.
    """
    several = entries.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where(F.col("low") < F.col("high")).select("token")
    held = stored(entries.join(several, "token", "left_semi"), "matrix-entries")
    matrix = held.groupBy("token", "group").agg(F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.max("rest").alias("rest_high"))
    q, m = held.alias("q"), matrix.alias("m")
    qualifying = q.join(m, (F.col("q.token") == F.col("m.token")) & (F.col("q.group") > F.col("m.group")) & _can_link(percent, F.col("q.n"), F.col("m.n_low"), F.col("m.n_high"), F.col("q.rest"), F.col("m.rest_high")))
    o, s = qualifying.select("q.token", "q.node", "q.n", "q.rest", F.col("m.group").alias("opened")).alias("o"), held.alias("s")
    met = o.join(s, (F.col("o.token") == F.col("s.token")) & (F.col("o.opened") == F.col("s.group")) & _can_link(percent, F.col("o.n"), F.col("s.n"), F.col("s.n"), F.col("o.rest"), F.col("s.rest")))
    return met.select(F.col("o.node").alias("a"), F.col("s.node").alias("b")).distinct()


def linked_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (doc_id, text).

    Two documents link when their sets of distinct k-word shingles (words of the lower-cased text) share percent / 100 of their
    union; fewer than k words are one shingle. component_id is the smallest doc_id that links reach. A null or empty text has 0
    shingles, links with nothing and is its own component; a null doc_id has component null. Rows with the same doc_id are one document:
    it links through any of its texts, each row keeping its own n_shingles. Other columns are not read; ids must be integers.
    """
    docs, spark = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), docs.sparkSession
    with small_batches(spark):
        signed = stored(signatures(docs, k, percent), "signatures")
    sets = signed.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    copies = stored(sets.groupBy("key").agg(F.min("doc_id").alias("node")), "copies")
    nodes = stored(sets.join(copies, "key").where(F.col("doc_id") == F.col("node")).select("node", F.col("n_shingles").alias("n"), "mins", "prefix").distinct(), "nodes")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        left = stored(plausible(stored(pairs, f"{name}-pairs"), nodes, percent), f"{name}-plausible")
        with small_batches(spark, 1000):
            return stored(verified(left, docs, k, percent), f"{name}-links")

    groups = stored(components(links(led_pairs(nodes), "led")), "groups")
    tokens = nodes.select("node", "n", F.posexplode("prefix").alias("place", "token")).select("token", "node", "n", (F.col("n") - F.col("place")).alias("rest"))
    shared = tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where(F.col("low") < F.col("high")).select("token")
    entries = tokens.join(shared, "token", "left_semi").join(groups, "node", "left").select("token", "node", "n", "rest", F.coalesce("root", "node").alias("group"))
    met = links(opened_pairs(entries, percent), "opened")

    doubled = signed.where(F.col("key").isNotNull()).groupBy("doc_id").agg(F.min("key").alias("x"), F.max("key").alias("y")).where(F.col("x") != F.col("y")).select("doc_id")
    tied = sets.join(doubled, "doc_id", "left_semi").join(copies, "key").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    roots = stored(components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(met).unionAll(tied)), "classes")
    member = copies.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("component"))
    return signed.join(member, "key", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class of near copies, that with the smallest doc_id, with all its columns.

    Of rows that share the id that stays, one stays: that whose columns have the smallest hash. A row with a null id takes part under
    a number made from its text, larger than real ids, and has a null id again in the result; where doc_id is no long, such rows
    all stay. Rows without words have no copies and stay; an empty table stays empty.
    """
    names = [f"`{c}`" for c in docs.columns]
    has_words = F.coalesce(F.substring("text", 1, 200).rlike(WORD) | F.col("text").rlike(WORD), F.lit(False))
    numbered = isinstance(docs.schema["doc_id"].dataType, T.LongType)
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2) if numbered else F.col("doc_id")
    whole = docs.select(F.struct(*names).alias("row"), F.coalesce("doc_id", F.when(has_words, stand_in)).alias("id"), "text")
    classes = linked_classes(whole.select(F.col("id").alias("doc_id"), "text"), k, percent).where(F.col("doc_id").isNotNull())
    # Ids to drop, and ids that several rows have; an id that two of its texts put in a class has one component.
    facts = classes.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    dropped = F.col("doc_id") != F.col("component")
    odd = stored(facts.where((F.col("rows") > 1) | dropped).select(F.col("doc_id").alias("odd_id"), dropped.alias("dropped")), "odd")
    same = (F.col("id") == F.col("odd_id")) & has_words
    single = whole.join(small_enough(odd, 24), same, "left_anti").select("row.*")
    shared = odd.where(~F.col("dropped"))
    if shared.isEmpty():
        return single
    # One row per id, found by partial minima in each task, however many rows share it.
    one = whole.join(small_enough(shared, 24), same, "left_semi").groupBy("id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.unionByName(one.select("row.*"))
