import os
import time

import numpy as np
import pytest

from leafline.sources import npy, queue
from leafline.streaming import ingest


def vectors(spark, rows, dim=3, parts=3):
    data = [(i, [float(i), i / 3, -i * 7.1][:dim]) for i in range(rows)]
    return spark.createDataFrame(data, "position long, embedding array<float>").repartitionByRange(parts, "position").sortWithinPartitions("position")


def test_npy_round_trip_with_row_ranges(spark, tmp_path):
    spark.dataSource.register(npy.NpySource)
    path = str(tmp_path / "v")
    vectors(spark, 50).select("embedding").write.format("npy").option("dim", 3).mode("append").save(path)
    files = npy.files(path)
    assert len(files) == 3 and np.concatenate([np.load(f) for f in files]).dtype == np.float16
    back = spark.read.format("npy").option("rowsPerPartition", 7).load(path)
    assert back.rdd.getNumPartitions() >= 8
    got = {r["position"]: r["embedding"] for r in back.collect()}
    assert got == {i: np.array([i, i / 3, -i * 7.1], dtype=np.float16).astype(np.float32).tolist() for i in range(50)}
    assert spark.read.format("npy").load(files[0]).count() == len(np.load(files[0]))
    vectors(spark, 4, parts=1).select("embedding").write.format("npy").mode("overwrite").save(path)
    assert spark.read.format("npy").load(path).count() == 4


def test_npy_of_no_rows_and_of_other_shapes(spark, tmp_path):
    spark.dataSource.register(npy.NpySource)
    none = str(tmp_path / "none")
    vectors(spark, 0).select("embedding").write.format("npy").option("dim", 3).mode("append").save(none)
    assert [np.load(f).shape for f in npy.files(none)] == [(0, 3)] and spark.read.format("npy").load(none).count() == 0
    np.save(tmp_path / "flat.npy", np.zeros(4))
    with pytest.raises(Exception, match="two dimensions"):
        spark.read.format("npy").load(str(tmp_path / "flat.npy")).collect()
    np.save(tmp_path / "wide.npy", np.zeros((2, 5)))
    with pytest.raises(Exception, match="of 5 components, not 3"):
        spark.read.format("npy").option("dim", 3).load(str(tmp_path / "wide.npy")).collect()
    bad = str(tmp_path / "bad")
    with pytest.raises(Exception, match="vectors need 4"):
        vectors(spark, 9).select("embedding").write.format("npy").option("dim", 4).mode("append").save(bad)
    assert os.listdir(bad) == []


def test_leases_and_redelivery(tmp_path):
    now = [100.0]
    q = queue.Queue(str(tmp_path), lambda: now[0])
    a, blank, b = q.send("s3://x/a.pdf"), q.send("  "), q.send("s3://x/a.pdf")
    assert [m["message_id"] for m in q.receive(10, 30)] == [a, b] and q.size() == 2 and blank != b
    assert q.receive(10, 30) == []
    q.delete(a)
    now[0] += 31
    assert [(m["message_id"], m["receives"]) for m in q.receive(10, 30)] == [(b, 2)]
    for k in range(15):
        q.send(f"m{k}")
    assert len(q.receive(10, 30)) == 10 and len(q.receive(10, 30)) == 5


def test_runs_of_a_queue(spark, tmp_path):
    path, out, cp = (str(tmp_path / n) for n in ("q", "out", "cp"))
    q = queue.Queue(path)
    for body in ("s3://b/My Doc.pdf", "s3://b/My Doc.pdf", "", "s3://b/broken.pdf"):
        q.send(body)

    def start(uri):
        if "broken" in uri:
            raise RuntimeError("no worker")

    ingest.served(spark, path, out, cp, start, visibility=1.0).awaitTermination()
    runs = ingest.started(spark, out).collect()
    assert [r["document_id"] for r in runs] == ["my-doc"] * 2 and len({r["run_id"] for r in runs}) == 2
    assert q.size() == 1  # the one that failed
    time.sleep(1.1)
    ingest.served(spark, path, out, cp, None, visibility=1.0).awaitTermination()
    assert q.size() == 0
    assert sorted((r["document_id"], r["receives"]) for r in ingest.started(spark, out).collect()) == [("broken", 2), ("my-doc", 1), ("my-doc", 1)]
