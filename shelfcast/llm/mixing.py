"""Mixing sources to target weights by soft membership.

A classifier fitted on a labelled table gives every document a probability for each domain, and its tokens count for the domains in
these parts. Rates, the times a document should be used on average, are those nearest to 1 whose domain totals meet the targets,
with no rate below 0. Such a rate is max(0, 1 + p . m) with one multiplier m for each domain, found by Newton steps.

All of it is DataFrame expressions. The rates of a step follow from the multipliers, one number for each domain, so a step is one
aggregate over a written table of probabilities and nothing but a few sums comes to the driver.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VarianceThresholdSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import release_shuffles, small_enough, stored

#: Hashed words of the classifier, and the bound of its sample of labelled rows.
BUCKETS = 1 << 16
MAX_LABELLED = 20_000
#: Weight of a domain's missed tokens against rates away from 1: targets that can be met are missed by this share of a multiplier.
SLACK = 1e-9


def words(text: Column) -> Column:
    """Lower-cased words without the marks that end them; one empty word for a text without any."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\s.,]+", " ")), " ")


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, n_tokens (words) and p, the probabilities of the domains, of every document.

    labelled: doc_id, domain. A multinomial logistic regression over the presence of hashed words is fitted on about
    `max_labelled` of its ids, chosen by a hash, one text each, whatever the size of the tables. With fewer than two domains in that
    sample there is nothing to tell apart, and every document has the same share of each domain.
    """
    share = min(1.0, max_labelled / max(1, labelled.count()))
    chosen = labelled.where((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) & F.col("domain").isin(domains))
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=BUCKETS, binary=True)
    prepare = lambda df, *keep: hashed.transform(df.select(*keep, words(F.col("text")).alias("words")))
    place = F.create_map(*(x for i, d in enumerate(domains) for x in (F.lit(d), F.lit(float(i)))))[F.col("domain")]
    known = chosen.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    once = docs.join(known, "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # rows that share an id are one example
    sample = stored(prepare(once.withColumn("label", place), "label").select("label", "features"), "mixing-sample")
    n_tokens = F.size(F.filter("words", lambda w: w != "")).cast("long").alias("n_tokens")
    if sample.select("label").distinct().count() < 2:
        even = F.array(*(F.lit(1.0 / len(domains)) for _ in domains))
        return docs.select("doc_id", words(F.col("text")).alias("words")).select("doc_id", n_tokens, even.alias("p"))
    few = sample.coalesce(12)  # bounded rows, so few sums
    # The fit keeps dozens of vectors of all weights on the driver. A bucket that is the same in all of the sample has none, and the
    # column's metadata, a line for each bucket, is not needed.
    selector = VarianceThresholdSelector(featuresCol="features", outputCol="varied").fit(few)
    if 0 < len(selector.selectedFeatures) < BUCKETS:
        pick = lambda df: selector.transform(df).withColumn("varied", F.col("varied").alias("varied", metadata={}))
    else:
        pick = lambda df: df.withColumnRenamed("features", "varied")
    release_shuffles(docs.sparkSession)  # the fit starts on a heap without gaps, and its vectors are gone before the documents are scored
    model = LogisticRegression(featuresCol="varied", regParam=0.002, maxIter=40, family="multinomial").fit(pick(few).select("label", "varied"))
    release_shuffles(docs.sparkSession)
    scored = model.transform(pick(prepare(docs, "doc_id"))).select("doc_id", n_tokens, vector_to_array("probability").alias("p"))
    missing = len(domains) - model.numClasses
    return scored.withColumn("p", F.concat("p", F.array(*[F.lit(0.0)] * missing))) if missing else scored


def _dot(p: str, step: list[float]) -> Column:
    return reduce(lambda a, b: a + b, (F.get(F.col(p), F.lit(i)) * F.lit(x) for i, x in enumerate(step)))


def _solved(rows: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a few linear equations, by elimination with the largest pivots."""
    m, n = [[*r, x] for r, x in zip(rows, right)], len(right)
    for i in range(n):
        best = max(range(i, n), key=lambda j: abs(m[j][i]))
        m[i], m[best] = m[best], m[i]
        for j in range(i + 1, n):
            f = m[j][i] / m[i][i]
            m[j] = [x - f * y for x, y in zip(m[j], m[i])]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (m[i][n] - sum(m[i][j] * out[j] for j in range(i + 1, n))) / m[i][i]
    return out


def solve_rates(members: DataFrame, targets: dict[str, float], domains: list[str], total_tokens: float | None = None, tolerance: float = 1e-4, max_steps: int = 60) -> DataFrame:
    """members (n_tokens, p and any other columns) with `rate`, whose expected domain totals meet the targets as far as they can.

    Least squares over rates r >= 0 of SLACK * sum of n_tokens * (r - 1)^2 + sum over domains of (S(r) - T)^2 / C, S the expected
    totals, T the targets and C the totals at rate 1. Its rates are max(0, 1 + p . m), where the multipliers m make S - T + SLACK * C * m
    zero, the gradient of a convex function of m. Newton steps on it, shortened until the function falls, end when that is
    within `tolerance` of each domain's own target (of C, if the target is 0). A domain that no document has is left out. A
    warning tells of targets missed by more than 1 %, and of steps that ran out. Without `total_tokens` the budget is that at which
    the domain with the largest target is used once.
    """
    tokens, k = F.col("n_tokens"), len(domains)
    at = [F.get("p", F.lit(i)) for i in range(k)]
    present = [x or 0.0 for x in members.agg(*(F.sum(tokens * x) for x in at)).first()]
    share = [targets.get(d, 0.0) / (sum(targets.values()) or 1.0) for d in domains]
    if total_tokens is None:
        total_tokens = present[share.index(max(share))] / max(share) if max(share) > 0 else 0.0
    wanted = [total_tokens * s for s in share]
    used = [i for i in range(k) if present[i] > 0]
    if not used or total_tokens <= 0:
        return members.withColumn("rate", F.lit(0.0 if used else 1.0))
    soft, scale = [SLACK * present[i] for i in used], [wanted[i] or present[i] for i in used]
    rate_at = lambda m: F.greatest(F.lit(0.0), F.lit(1.0) + _dot("p", m))

    def look(m: list[float]) -> tuple[float, list[float], list[list[float]], list[float]]:
        """The function, its gradient, its curvature and the totals at the multipliers."""
        full = [0.0] * k
        for i, x in zip(used, m):
            full[i] = x
        rate, on = rate_at(full), F.when(rate_at(full) > 0, tokens).otherwise(F.lit(0))
        upper = [(a, b) for a in range(len(used)) for b in range(a, len(used))]
        row = members.agg(F.sum(tokens * rate * rate), *(F.sum(tokens * rate * x) for x in at), *(F.sum(on * at[used[a]] * at[used[b]]) for a, b in upper)).first()
        found, totals = [x or 0.0 for x in row], [x or 0.0 for x in row[1 : k + 1]]
        value = found[0] / 2 + sum(c * x * x / 2 - wanted[i] * x for i, c, x in zip(used, soft, m))
        curve = [[0.0] * len(used) for _ in used]
        for (a, b), x in zip(upper, found[k + 1 :]):
            curve[a][b] = curve[b][a] = x + (soft[a] if a == b else 0.0)
        return value, [totals[i] - wanted[i] + c * x for i, c, x in zip(used, soft, m)], curve, totals

    done = lambda slope: max(abs(g) / s for g, s in zip(slope, scale)) <= tolerance
    m, steps = [0.0] * len(used), 0
    value, slope, curve, totals = look(m)
    while not done(slope) and steps < max_steps:
        move = _solved(curve, [-g for g in slope])
        fall, length = sum(g * x for g, x in zip(slope, move)), 1.0
        while steps < max_steps:
            steps += 1
            tried = [x + length * y for x, y in zip(m, move)]
            seen = look(tried)
            if done(seen[1]) or seen[0] <= value + 1e-4 * length * fall:
                m, (value, slope, curve, totals) = tried, seen
                break
            best = -fall * length * length / (2 * (seen[0] - value - fall * length))  # of the parabola through both
            length = min(0.5 * length, max(0.05 * length, best))
    missed = [f"{domains[i]} has {totals[i]:.6g} of {wanted[i]:.6g} tokens" for i in range(k) if abs(totals[i] - wanted[i]) > 0.01 * wanted[i]]
    if missed or not done(slope):
        warnings.warn(f"mixing: {'out of reach' if done(slope) else f'not solved in {max_steps} steps'}: {'; '.join(missed) or 'all within 1 %'}", stacklevel=2)
    full = dict(zip(used, m))
    return members.withColumn("rate", rate_at([full.get(i, 0.0) for i in range(k)]))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total_tokens: float | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, n_tokens, domain (the most likely), p (by the order of `targets`), rate and copies of every document.

    copies is the rate rounded up or down by a hash of the id, so that on average a document is used at its rate.
    A null or empty text has 0 tokens, the prior's probabilities and still a rate; documents without a label are as welcome as
    others; labels of unknown documents or domains and null labels are passed over; a null doc_id is kept, without a label;
    repeated rows get equal copies; other columns are not read. With an empty table, or targets that no document serves, the result is
    empty or all rates are 0.
    """
    domains = list(targets)
    found = posteriors(docs.select("doc_id", "text"), labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()), domains, max_labelled)
    rated = solve_rates(stored(found, "mixing-members"), targets, domains, total_tokens)
    uniform = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 30)) / (1 << 30)
    best = F.element_at(F.array(*map(F.lit, domains)), F.array_position("p", F.array_max("p")).cast("int"))
    return rated.select("doc_id", "n_tokens", best.alias("domain"), "p", "rate", F.floor(F.col("rate") + uniform).cast("long").alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **parameters) -> DataFrame:
    """The documents, with all their columns, each as many times as `mix` says."""
    times = mix(docs, labelled, targets, **parameters).groupBy("doc_id").agg(F.max("copies").alias("copies")).where(F.col("copies") > 0)
    times = stored(times.select(F.col("doc_id").alias("mixed_id"), "copies"), "mixing-copies")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = whole.join(small_enough(times, 32), F.col("row.doc_id").eqNullSafe(F.col("mixed_id")))
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain from quality and toxic: toxic, else high or low; null where neither is known. The worst of several labels."""
    worst = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return worst.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))
