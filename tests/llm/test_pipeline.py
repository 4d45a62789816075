"""The pipeline on a small corpus against plain Python, stage by stage, each on its own input."""

import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from supplyscope.llm import bm25_wand, label_shards, mixing, quality_cnn
from supplyscope.llm.common import crc_fold

from .test_label_shards import check as check_shards
from .test_simhash import brute

R = random.Random(11)
VOCAB = [a + b + c for a in ("ka", "lo", "mi") for b in ("ru", "te", "no") for c in ("sa", "be", "du")]


def text(n):
    return " ".join(R.choices(VOCAB, k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, text(30)) for i in range(6)]
    rows = [(i, text(R.randint(40, 160)), "en", f"s{i % 4}") for i in range(160)]
    rows += [(200 + i, " | ".join(text(80).split()), "en", "s1") for i in range(60)]                 # junk
    rows += [(300 + i, rows[i][1], "en", "s2") for i in range(12)]                                   # copies
    rows += [(400 + i, f"{text(40)} {t} {text(40)}", "en", "s3") for i, (_, t) in enumerate(items)]  # leaks
    rows += [(500, None, None, None), (501, "", "en", "s0"), (502, text(50), "en", "s0"), (502, rows[-1][1], "en", "s0")]
    docs = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, int(not 200 <= i < 300), 0) for i, *_ in rows if i < 300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, corpus):
    assert 4 <= len(P.STAGES) <= 5 and P.ORACLE_SQL is None
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    held = {}
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        out = stage(spark, docs, corpus)
        if name != "shards":
            assert out.dtypes == docs.dtypes
        after = out.collect()
        held[name] = (before, after)
        docs = spark.createDataFrame(after, out.schema)
    before, after = held["quality"]
    ids = {r.doc_id for r in after}
    model = quality_cnn.train(spark.read.parquet(f"{corpus}/documents.parquet"), spark.read.parquet(f"{corpus}/labels.parquet"),
                              crc_fold("doc_id", 5) != 0)
    score = quality_cnn.score_texts(model, [(t or "").encode() for _, t, _ in before])
    assert sorted(i for (i, *_), s in zip(before, score) if s >= P.GOOD) == sorted(r.doc_id for r in after)
    assert not ids & set(range(200, 300)) and len(ids & set(range(160))) > 150
    before, after = held["near_duplicates"]
    assert sorted(r.doc_id for r in after) == sorted({c for *_, c in brute(before)})
    before, after = held["decontaminate"]
    index = bm25_wand.Index([(r.item_id, r.text) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()])
    leak = {i for i, t, _ in before if any(x.decode() in (t or "").lower() for x in index.texts)}
    assert leak and sorted(r.doc_id for r in after) == sorted(i for i, *_ in before if i not in leak)
    before, after = held["mix"]
    want = spark.createDataFrame([(i, t, None, s, None) for i, t, s in before],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    want = mixing.mixed_documents(want).collect()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in want)
    before, after = held["shards"]
    plain = check_shards(spark, before, label_shards.SHARDS)
    assert sorted((r.doc_id, r.shard) for r in after) == sorted((r.doc, r.shard) for r in plain)


def test_run_and_empty_corpus(spark, corpus, tmp_path):
    out = P.run(spark, corpus)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot"] and out.count() > 100
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{corpus}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_are_carried(spark, corpus):
    """Columns called as the operators call their own, in any spelling."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = ["_k1", "_K2", "_score", "_Score_", "row", "k", "key", "fp", "_root", "_low", "at", "copies", "times", "doc", "size",
             "a.b", "block", "held"]
    wide = docs.select("*", *[F.concat(F.lit(f"{n}/"), F.col("doc_id").cast("string")).alias(n) for n in names])
    plain = docs
    for name, stage in P.STAGES:
        out, want = stage(spark, wide, corpus), stage(spark, plain, corpus)
        assert sorted(r.doc_id or -1 for r in out.collect()) == sorted(r.doc_id or -1 for r in want.collect())
        if name == "shards":
            assert out.columns == want.columns
            continue
        assert out.columns == [*docs.columns, *names]
        assert out.where(" OR ".join(f"`{n}` IS DISTINCT FROM concat('{n}/', CAST(doc_id AS STRING))" for n in names)).count() == 0
        wide, plain = (spark.createDataFrame(x.collect(), x.schema) for x in (out, want))
