import zlib

import numpy as np

from hearthline.llm.boosted_quality import quality_scores, train_trees


def test_held_out_labels(spark, small):
    labels = {r.doc_id: r.quality for r in small("labels").collect()}
    rows = quality_scores(small("documents"), small("labels")).collect()
    assert len(rows) == small("documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert held and sum(p == q for p, q in held) >= 0.9 * len(held)


def test_held_out_labels_are_not_read(spark, small):
    from pyspark.sql import functions as F

    labels = small("labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality_scores(small("documents"), x).collect())) for x in (labels, turned))
    assert one == two


def test_vectorised_scores_equal_single_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = train_trees(x, y, np.ones(500), trees=30)
    scores = model.score(x)
    assert ((scores > 0.5) == y).mean() > 0.95
    for row, score in zip(x[:50], scores):
        total = model.start
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - len(f)]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_odd_documents(spark, odd, small):
    rows = quality_scores(odd, small("labels")).collect()
    assert len(rows) == odd.count()
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1


def test_one_class_of_labels(spark, odd):
    labels = spark.createDataFrame([(6, 1), (6, 1), (None, 0), (7, None)], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality_scores(odd, labels).collect()} <= {0.999, 0.5}


def test_empty(spark, empty):
    assert quality_scores(empty, spark.createDataFrame([], "doc_id long, quality int")).collect() == []
