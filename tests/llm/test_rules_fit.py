"""The rules' forest and threshold come from all labelled rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tomewright.llm import quality_rules as q


def test_forest_and_threshold_use_all_labelled_rows(spark):
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("Some words! "), (F.col("id") * 7 % 40 + 1).cast("int")), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 > 0).cast("int").alias("quality"))
    labels = labels.unionByName(labels.where("doc_id = 20").withColumn("quality", F.lit(1)))
    rows = q.with_stats(docs).toPandas().sort_values("doc_id")
    ids = rows.doc_id.to_numpy()
    x, good = q.features(rows[list(q.STATS)].to_numpy()), (ids % 10 > 0) | (ids == 20)
    seen = good & np.array([zlib.crc32(str(i).encode()) % 2 == 0 for i in ids])
    model = q.fit_rules(docs, labels)
    for feature, low, split, high, left, _ in model.forest.trees[:20]:
        f = feature[0]
        assert (low[0], high[0]) == (x[seen, f].min(), x[seen, f].max())
        under = x[seen][x[seen, f] <= split[0]]
        if feature[left[0]] >= 0:
            assert low[left[0]] == under[:, feature[left[0]]].min()
    assert model.threshold == q.calibrate(model.forest.score(x[~seen]), good[~seen], 0.005)
