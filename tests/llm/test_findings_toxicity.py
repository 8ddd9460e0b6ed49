"""The toxicity model learns from every labelled row, over several shards."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tramflow.llm import toxicity_cnn
from tramflow.llm.common import held_out


def test_every_labelled_row_trains(spark, monkeypatch):
    rng = random.Random(61)
    words = [f"word{k}" for k in range(400)]
    rows, marks = [], []
    for k in range(600):
        text = [rng.choice(words) for _ in range(rng.choice([20, 60, 1200]))]  # 1200 words are over 4,000 code points
        if k % 3 == 0:
            text[rng.randrange(len(text))] = rng.choice(["zurk", "blarg"])
        rows.append((k, " ".join(text), "en"))
        marks.append((k, 1, int(k % 3 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    bags = toxicity_cnn.training_bags(docs, labels, 100)
    own = docs.where(~held_out())
    assert bags.count() == own.count()
    assert bags.agg(F.max(F.length("bag"))).first()[0] == 1200 * 12
    assert bags.rdd.getNumPartitions() == -(-own.count() // 100)
    model = toxicity_cnn.train(docs, labels, shard_rows=100)
    out = toxicity_cnn.scored(docs, labels, model).join(labels, "doc_id").where("held_out")
    assert out.where("predicted = toxic").count() >= 0.95 * out.count()


def test_best_cut_counts_rows():
    assert toxicity_cnn.best_cut(np.array([-2.0, 0.0, 1.0]), np.array([0, 1, 9]), np.array([50, 3, 0])) == 0.5


def test_a_task_sends_the_sum_of_its_shards(spark):
    rng = random.Random(62)
    words = [f"word{k}" for k in range(300)]
    rows = [(k, " ".join([*rng.choices(words, k=30), "zurk" if k % 4 == 0 else "calm"]), "en") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(900)], "doc_id long, quality int, toxic int")
    bags = toxicity_cnn.training_bags(docs, labels, 20)
    shards, cores = bags.select("shard").distinct().count(), spark.sparkContext.defaultParallelism
    assert shards > 2 * cores
    assert bags.rdd.getNumPartitions() == cores  # as many sums are shuffled, not one change for each shard
    assert bags.select("shard", F.spark_partition_id()).distinct().count() == shards
    together, apart = toxicity_cnn.Trainer(), toxicity_cnn.Trainer()
    toxicity_cnn.epoch(bags, together)
    toxicity_cnn.epoch(bags.repartitionById(shards, "shard"), apart)
    assert np.abs(together.flat() - toxicity_cnn.Trainer().flat()).max() > 0.01
    assert np.allclose(together.flat(), apart.flat(), atol=1e-4)


def test_a_training_text_is_moved_once(spark, capsys):
    known = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    docs = spark.createDataFrame([(1, "some words", "en")], "doc_id long, text string, lang string")
    toxicity_cnn.dealt(docs, known, 1, 4, 2).explain(mode="formatted")
    blocks = capsys.readouterr().out.split("\n\n")
    moves = [b.split("]: [")[1].split("]")[0] for b in blocks if ") Exchange" in b and "]: [" in b]
    assert sum("text#" in columns for columns in moves) == 1


def test_labels_meet_their_texts_in_any_batch(spark):
    rng = random.Random(63)
    rows = [(rng.randrange(60) if k % 9 else None, rng.choice([f"text {k} of words", "one text", None]), rng.choice(["en", "fr", None])) for k in range(300)]
    labels = [(k, 1, rng.choice([0, 1, None])) for k in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (900, 1, 0)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = marks.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    plain = docs.where(~held_out()).join(known, "doc_id").select(F.coalesce("lang", F.lit("")), "label", F.coalesce("text", F.lit("")))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("1", "3", "1000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            bags = toxicity_cnn.training_bags(docs, marks, 10)
            want = sorted((r[0], r[1], toxicity_cnn.word_keys(pa.array([r[2]]))[0].tobytes()) for r in plain.collect())
            assert len(want) > 50 and sorted((r.lang, r.label, bytes(r.bag)) for r in bags.collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_texts_without_a_label_are_not_moved(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.lit("en").alias("lang"))
    known = docs.where("doc_id % 10 = 3").select("doc_id")
    kept = toxicity_cnn.maybe_in(docs, known, 4_000)
    assert kept.join(known, "doc_id").count() == 4_000
    assert kept.count() < 4_000 + 36_000 / 7
    assert toxicity_cnn.maybe_in(docs, known.limit(0), 0).count() == 0
