"""Language identification by hierarchical discrimination.

Linear support vector machines, one for every two classes, first tell the language family and then the languages within it. The
features are the shares of hashed character n-grams of the whole text.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import crc, mapped

#: Families of languages; a language that is in none is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
BUCKETS = 1 << 12
#: Training documents of each language at most: the bound of the sample that the machines are fitted on.
PER_LANGUAGE = 1500
_LETTER = re.compile(r"[^\W\d_]")  # also finds numbers that are no digits


def family_of(lang: str) -> str:
    return next((family for family, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def has_letter(text: str) -> bool:
    """Whether a character of Unicode's category L is in the text."""
    return any(x.group().isalpha() for x in _LETTER.finditer(text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 3-character n-grams of the lower-cased text, of length 1."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    out = np.zeros(BUCKETS)
    gram = np.zeros(len(code), "u8")
    for n in (1, 2, 3):
        if len(code) < n:
            break
        gram = gram[: len(code) - n + 1] * np.uint64(0x9E3779B1) + code[n - 1 :]
        mixed = (gram * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - 12)
        out += np.bincount(mixed.astype("i8"), minlength=BUCKETS) / n
    out = np.sqrt(out)
    return out / (np.linalg.norm(out) or 1.0)


def fit_svm(x: np.ndarray, y: np.ndarray, regular: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradient steps; y is -1 or 1.

    Both classes weigh the same. No randomness: the same rows give the same weights.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = ahead = np.zeros(x.shape[1])
    step = 1 / (2 * 2.0 + regular)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (regular * ahead - 2 * x.T @ (share * y * slack))
        w, ahead = new, new + t / (t + 3) * (new - w)
    return w


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """text and lang of at most `per_language` different training texts of each language: those with the smallest hashes.

    Training documents have a language, a text and a crc32 of their id that is not 2 modulo 4. Copies of a text count once, so they
    neither fill the sample nor take a language out of it. A first cut by the number of different texts leaves about twice the sample
    to be ranked, whatever the size of the data.
    """
    pool = docs.where((F.pmod(crc(F.col("doc_id")), F.lit(4)) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64("text").alias("hash"))
    sizes = {r[0]: r[1] for r in pool.groupBy("lang").agg(F.approx_count_distinct("hash")).collect()}
    if not sizes:
        return pool.select("text", "lang")
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, (2 * per_language + 20) / max(1, n))))))[F.col("lang")]
    cut = pool.where(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30))
    different = cut.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1 << 30)), "hash"))
    return different.withColumn("place", place).where(F.col("place") <= per_language).select("text", "lang")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict[tuple[str, str, str], list[float]]:
    """Machines by (level, class, class); level is '' for families and the family's name for its languages.

    Each of them is fitted in a task of its own on the rows of its two classes; only the weights come to the driver.
    """
    sample = training_sample(docs, per_language)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t).astype("f4").tobytes() if has_letter(t) else None for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "x": pa.array(found, pa.binary())})

    langs = sorted(r[0] for r in sample.select("lang").distinct().collect())
    by_family: dict[str, list[str]] = {}
    for lang in langs:
        by_family.setdefault(family_of(lang), []).append(lang)
    problems = []  # (level, class, class, languages of one, languages of the other)
    for a, b in itertools.combinations(sorted(by_family), 2):
        problems.append(("", a, b, by_family[a], by_family[b]))
    for family, members in by_family.items():
        problems += [(family, a, b, [a], [b]) for a, b in itertools.combinations(members, 2)]
    if not problems:
        return {("", f, f): [] for f in by_family} | {("only", x, x): [] for x in langs}
    wanted = {lang: [(i, 1.0 if lang in p[3] else -1.0) for i, p in enumerate(problems) if lang in p[3] or lang in p[4]] for lang in langs}
    kind = "array<struct<problem: int, side: double>>"
    sides = F.create_map(*(x for lang in langs for x in (F.lit(lang), F.array(*(F.struct(F.lit(i).alias("problem"), F.lit(s).alias("side")) for i, s in wanted[lang])).cast(kind))))
    each = sample.select("text", "lang").mapInArrow(rows, "lang string, x binary").where(F.col("x").isNotNull()).select(F.explode(sides[F.col("lang")]).alias("p"), "x").select("p.problem", "p.side", "x")

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "x"])
        x = np.frombuffer(b"".join(group.x), "f4").reshape(len(group), BUCKETS).astype(float)
        return pd.DataFrame({"problem": [key[0]], "w": [fit_svm(x, group.side.to_numpy()).tolist()]})

    weights = {r.problem: r.w for r in each.groupBy("problem").applyInPandas(fit, "problem int, w array<double>").collect()}
    machines = {p[:3]: weights[i] for i, p in enumerate(problems) if i in weights}
    return machines | {("only", x, x): [] for x in langs}


class Model:
    """The machines of one level after another, ready to predict."""

    def __init__(self, machines: dict[tuple[str, str, str], list[float]]):
        self.langs = sorted(a for level, a, b in machines if level == "only")
        self.levels: dict[str, tuple[list[str], list[tuple[int, int]], np.ndarray]] = {}
        for level in sorted({k[0] for k in machines if k[0] != "only"}):
            pairs = sorted((a, b) for at, a, b in machines if at == level and a != b)
            names = sorted({x for p in pairs for x in p})
            if pairs:
                self.levels[level] = names, [(names.index(a), names.index(b)) for a, b in pairs], np.array([machines[level, a, b] for a, b in pairs])

    def choose(self, level: str, x: np.ndarray) -> tuple[str, float]:
        """The class with most votes, then the largest sum of margins, and its least probability against another."""
        names, pairs, weights = self.levels[level]
        margins = weights[:, :-1] @ x + weights[:, -1]
        votes, sums, worst = np.zeros(len(names)), np.zeros(len(names)), np.full(len(names), np.inf)
        for (a, b), m in zip(pairs, margins):
            votes[a if m >= 0 else b] += 1
            for c, s in ((a, m), (b, -m)):
                sums[c] += s
                worst[c] = min(worst[c], s)
        best = max(range(len(names)), key=lambda c: (votes[c], sums[c], -c))
        return names[best], 1 / (1 + math.exp(-max(-50.0, min(50.0, 3 * worst[best]))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not has_letter(text) or not self.langs:
            return "und", 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        x, score = features(text), 1.0
        families = sorted({family_of(lang) for lang in self.langs})
        family = families[0]
        if len(families) > 1:
            if "" not in self.levels:
                return "und", 0.0
            family, score = self.choose("", x)
        members = [lang for lang in self.langs if family_of(lang) == family]
        if len(members) == 1:
            return members[0], score
        lang, within = self.choose(family, x)
        return lang, score * within


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, from machines fitted on a bounded sample of the training part.

    `und` with score 0 for a text that is null, empty or has no letter, and for all if nothing can be learned; whole texts of any
    length are read; a null doc_id stays null and its checksum is that of the empty text; repeated rows are predicted each; the
    language, the source and the id are no inputs of a prediction. No shuffle beyond the sample.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(train(docs, per_language))
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("doc_id", id_type), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        model = Model(shipped.value)

        def rows(batch: pa.RecordBatch) -> dict:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": [a for a, _ in found], "score": [b for _, b in found]}

        yield from mapped(rows, schema)(batches)

    held = docs.select("doc_id", (F.pmod(crc(F.col("doc_id")), F.lit(4)) == 2).alias("held_out"), "text")
    return held.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
