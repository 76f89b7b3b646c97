"""The pipeline on odd tables: null and repeated ids, null and empty texts, more columns, nothing at all."""

from __future__ import annotations

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, copies long, n_tokens int"


def write(spark, folder, docs, benchmark, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def prose(rng, n=120):
    return " ".join("".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."


def test_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    base = [prose(rng) for _ in range(40)]
    item = prose(rng, 30)
    rows = [(i, t, "en", "s", len(t), None, 7, 1) for i, t in enumerate(base)]
    odd = [(50, base[0]), (None, base[1]), (None, base[1]), (None, prose(rng)), (3, base[3]), (60, None), (61, ""), (62, f"{prose(rng)} {item} {prose(rng)}"), (None, f"{item} {prose(rng)}"), (63, "$$$ ||| " * 80)]
    rows += [(i, t, None, None, None, "x", None, None) for i, t in odd]
    folder = write(spark, tmp_path / "odd", rows, [(1, item), (None, None)], [(i, 1, 0) for i in range(30)] + [(40, None, None), (None, 1, 1)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "odd")
    assert docs.columns == [x.split()[0] for x in DOCS.split(", ")]
    found = docs.collect()
    ids = [r.doc_id for r in found if r.doc_id is not None]
    assert sorted(ids) == list(range(40)) and sum(r.doc_id is None for r in found) == 1
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    assert mixed.columns == docs.columns and {r.text for r in mixed.collect()} <= {r.text for r in found}
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and all(r.n_tokens > 1 for r in out.collect())


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "none", [], [], [])).count() == 0
