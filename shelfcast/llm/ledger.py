"""Quality rules: a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; policies are
versioned masks, so a new policy or an ablation reads the ledger and no text.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import mapped, texts

#: A rule fails where its condition over the measurements holds. The place in the list is the rule's bit: append only.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("shouting", "n_upper > n_lower"),
)
#: Policies by version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower")
_SYMBOLS = bytes(set(range(256)) - set(b"#*$%&|<>"))
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NOT_LOWER = bytes(set(range(256)) - set(range(97, 123)))
_CONTINUED = bytes(range(0x80, 0xC0))


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, marked = Counter(windows), 0
    end = 0  # words before this place are counted
    for at, window in enumerate(windows):
        if counts[window] > 1:
            marked += at + 3 - max(at, end)
            end = at + 3
    return marked


def measure(text: bytes) -> tuple[int, ...]:
    """The values of MEASURES for the UTF-8 bytes of one text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]  # strip() drops the same bytes that separate words
    return (
        len(words),
        sum(map(len, words)) - (len(text) - len(text.translate(None, _CONTINUED))),
        len(text.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(text.translate(None, _NOT_UPPER)),
        len(text.translate(None, _NOT_LOWER)),
    )


def ledger(docs: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per document: `row`, all its columns as one struct, the measurements and `failed`, the bits of the rules that it fails.

    A null text counts as empty and so fails `few_words`; null ids and repeated rows pass through; further columns, whatever their
    names, stay in `row`. Very long texts are measured whole. No shuffle.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kind = whole.limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("row", kind), *((m, pa.int64()) for m in MEASURES)])

    def rows(batch: pa.RecordBatch) -> dict:
        return {"row": batch.column("row"), **dict(zip(MEASURES, zip(*map(measure, texts(batch.column("row"))))))}

    measured = whole.mapInArrow(mapped(rows, schema), f"row {whole.schema['row'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, condition) in enumerate(rules)]
    return measured.withColumn("failed", reduce(lambda x, y: x.bitwiseOR(y), bits))


def mask(policy: str, rules: tuple[tuple[str, str], ...] = RULES) -> int:
    return sum(1 << i for i, (name, _) in enumerate(rules) if name in POLICIES[policy])


def rejected(policy: str) -> Column:
    """Whether a ledger row fails any rule of a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) != 0


def ablation(rows: DataFrame, policy: str = "v1", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it and documents that only it rejects (kept once the rule is dropped).

    Documents are first counted by their failed bits, at most two to the number of rules, so the text is not needed.
    """
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    wanted = [(name, 1 << i) for i, (name, _) in enumerate(rules) if name in POLICIES[policy]]
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit")) for name, bit in wanted)))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    count = lambda where: F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))
    found = patterns.select("*", each.alias("r")).groupBy("r.rule").agg(count(hit).alias("failing"), count(F.col("bits") == F.col("r.bit")).alias("only_this"))
    return found.select(F.col("rule"), "failing", "only_this")


def judged(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with `base_failed` and `kept` by the policy."""
    return ledger(docs).withColumn("base_failed", rejected("base")).withColumn("kept", ~rejected("base") & ~rejected(policy))


def keep_good(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents, with all their columns, that the policy keeps."""
    return judged(docs, policy).where("kept").select("row.*")
