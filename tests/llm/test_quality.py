import random
from zlib import crc32

from pyspark.sql import functions as F

from leafline.llm import quality

random.seed(5)
WORDS = ["river", "stone", "letter", "morning", "winter", "garden", "village", "window", "people", "history", "of", "the", "and", "in"]


def good():
    return " ".join(random.choices(WORDS, k=random.randint(20, 200))) + "."


def bad():
    return " ".join(w + random.choice(["###", "$$$", "%%%"]) for w in random.choices(WORDS, k=random.randint(20, 200)))


def tables(spark, n=400):
    docs = [(i, good() if i % 4 else bad(), "x", 0.5) for i in range(n)]
    labels = [(i, int(i % 4 > 0), "x") for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, lang string")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    got = quality.scores(docs, quality.fit(quality.sample(docs, labels))).collect()
    assert len(got) == 400
    for r in got:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held) >= 0.95 * len(held)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = tables(spark, 100)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda rows: sorted(map(tuple, rows.collect()))
    assert key(quality.sample(docs, labels)) == key(quality.sample(docs, turned))


def test_odd_rows(spark):
    docs, labels = tables(spark, 60)
    labels = labels.union(spark.createDataFrame([(None, 1, "x"), (1, 0, "x"), (2, None, "x"), (9999, 1, "x")], labels.schema))
    odd = spark.createDataFrame([(None, "some text", "x", None), (1000, None, "x", None), (1001, "", "x", None), (1002, "w " * 60000, None, None), (1, "again", "x", None)], docs.schema)
    model = quality.fit(quality.sample(docs, labels))
    got = quality.scores(docs.union(odd), model).collect()
    assert len(got) == 65 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (1000, 1001)} == {model.empty}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert quality.scores(docs.limit(0), model).count() == 0
    kept = quality.filtered(docs.union(odd), model)
    assert kept.columns == docs.columns and 0 < kept.count() < 65
    boxed = docs.select("*", F.expr("map('a', doc_id) as m"), F.expr("interval 3 month as span"))  # kinds that Arrow lacks stay in the JVM
    assert quality.filtered(boxed, model).columns == boxed.columns and 0 < quality.filtered(boxed, model).count() <= 60


def test_without_labels(spark):
    docs, labels = tables(spark, 10)
    none = quality.fit(quality.sample(docs, labels.limit(0)))
    assert {r["score"] for r in quality.scores(docs, none).collect()} == {0.5}
    one = quality.fit(quality.sample(docs, labels.where("quality = 1")))
    assert all(r["predicted"] == 1 for r in quality.scores(docs, one).collect())


def test_scores_are_those_of_the_formula(spark):
    import math

    import zstandard

    docs, labels = tables(spark)
    long = [(5000, "river stone " * 9000, "x", 0.0), (5001, "###" * 40000, "x", 0.0)]
    docs = docs.union(spark.createDataFrame(long, docs.schema))
    m = quality.fit(quality.sample(docs, labels))
    size = lambda x, d: len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress(x))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.scores(docs, m).collect():
        data = text[r["doc_id"]].encode()
        cuts = [data[i : i + 4096] for i in range(0, len(data), 4096)]
        g, b = (sum(size(x, d) for x in cuts) for d in (m.good, m.bad))
        d, n, q = 10 * (b - g) / (g + b), math.log(len(data) + 20) - 6, math.log((g + b) / (2 * len(data)))
        z = sum(w * v for w, v in zip(m.weights, (1, d, d * n, q, max(m.low - q, 0), max(m.low - q, 0) * n, n), strict=True))
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_whole_texts_build_dictionaries_in_groups(spark, monkeypatch):
    docs, labels = tables(spark)
    one = quality.trained(quality.sample(docs, labels).where("part = 0"))
    monkeypatch.setattr(quality, "GROUP_BYTES", 20_000)
    several = quality.trained(quality.sample(docs, labels).where("part = 0"))
    assert set(one) == set(several) == {0, 1} and all(several.values())
    monkeypatch.setattr(quality, "dictionary", lambda cuts: b"".join(cuts)[-40:])
    late = spark.createDataFrame([(1, 1, "x" * 300_000 + " hidden words at the far end of a long text")], "fit_id long, q int, text string")
    assert b"far end of a long text" in quality.trained(late)[1]
