"""Spelling variants: words one edit apart, by asymmetric q-chunks, and the frequent form each of them stands for.

Of two words the longer one (of equal length the smaller one) gives disjoint chunks, the other its positional grams. A word is cut in
two halves and one edit leaves one of them whole; the other half is cut in two again and keeps one of its quarters. So the chunks
joined are a half and a quarter, three quarters of the word, which few words share. A chunk before the edit keeps its place, one
behind it moves by the difference of the lengths, so each gram is sent for the one shift, of at most one, that an edit can give it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points that a word has at least, and how often it occurs at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times as frequent as a word its form must be.
RATIO = 10


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = 31) -> DataFrame:
    """(word, n) of the words of all texts; a run whose checksum with its doc_id is a multiple of `slip` loses one code point.

    Counts are summed in each task before the shuffle, so a word that makes up a third of the corpus is a row per task.
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    # A greedy match of that many letters or more is a maximal run; shorter runs cannot give a word.
    runs = F.explode(F.regexp_extract_all(text, F.lit(rf"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))).alias("run")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    cut = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    words = docs.select("doc_id", runs).withColumn("h", h).select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _without_quarters(longer: int) -> Column:
    """For each quarter of a chunk word: a hash of its length, the quarter and the rest.

    `longer` is what the chunk word has more than this one; the rest is a half and a quarter of it.
    """
    whole = f"(length(word) + {longer})"
    half = f"(({whole} + 1) div 2)"
    starts = ["0", f"(({half} + 1) div 2)", half, f"({half} + ({whole} - {half} + 1) div 2)"]
    ends = [*starts[1:], whole]
    left = [f"substring(word, 1, int({s}))" for s in starts]
    right = [f"substring(word, int({e} - {longer} + 1))" for e in ends]
    return F.expr(f"array({', '.join(f'xxhash64({whole}, {i}, {a}, {b})' for i, (a, b) in enumerate(zip(left, right)))})")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words with exactly one code point inserted, deleted or replaced, each once.

    The chunks of a third of the words may be one and the same: such a key is split among tasks by Spark's skew join.
    """
    chunks = words.select(F.explode(_without_quarters(0)).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    grams = words.select(F.explode(F.concat(_without_quarters(0), _without_quarters(1))).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    one_way = (F.length("a") > F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    met = chunks.join(grams, "key").where(one_way & (F.levenshtein("a", "b", 1) == 1))
    return met.drop("key").dropDuplicates(["a", "b"])


def follow(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of the words in (word, form): the last form that is reached within `steps`, by doubling."""
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        jumps = stored(jumps, "jumps")
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = jumps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return jumps


def variant_groups(docs: DataFrame, ratio: int = RATIO, **parameters) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    `form` is the most frequent near word (ties: the first in code-point order) if it occurs `ratio` times as often, else null; `root`
    is the last of the forms, the word itself without one. Null, empty texts and tables give no words, a null doc_id counts as the
    empty text, repeated rows count each, whole texts of any length are read, other columns are not.
    """
    words = stored(word_counts(docs, **parameters), "words")
    pairs = near_pairs(words)
    side = lambda word, near, m: F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(m).alias("m"))
    both = F.explode(F.array(side("a", "b", "n_b"), side("b", "a", "n_a"))).alias("p")
    best = pairs.select(both).select("p.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").withColumn("m", -F.col("best.less"))
    fits = F.col("m") >= ratio * F.col("n")
    found = stored(
        known.select("word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("m")).alias("form_n")),
        "forms",
    )
    # A form occurs `ratio` times as often as its word, so the largest count bounds the number of steps.
    most = words.agg(F.max("n")).first()[0] or 1
    roots = follow(found.where(F.col("form").isNotNull()), int(math.log(most, ratio)) + 1)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
