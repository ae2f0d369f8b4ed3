"""Connected components over edge tables, and what the pair operators share: cells of bounded size and their links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common

#: What a compared cell gives: links counted at a node, or an edge of the cell's spanning forest.
PARTS = "node long, other long, links long"
LISTED = 64
ROUNDS = 2


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(src, dst long): root is the smallest node reachable.

    Alternating large-star and small-star steps; each round's edges are a table in the shared folder, and the rounds end
    when they repeat. Rounds grow with the logarithm of the component's size. Rows of hubs are joined where they are.
    """
    e = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    e, last = common.stored(e, "edges"), None
    rows = e.count()
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        large = common.joined(both, low, "u", 2 * rows).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = common.joined(large, low, "u", 2 * rows).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        e = common.stored(small.where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == last:
            break
        last, rows = now, now["n"]
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def meetings(buckets: DataFrame, rows: int, size: int) -> DataFrame:
    """(node, part, cells) of the nodes that share a bucket with another: cells, an array of at most LISTED structs (cell,
    within), in which to compare them so that all nodes of a bucket meet. buckets(bucket, node) has at most `rows` rows.

    A node's home is the largest of its buckets; homes that share buckets gather at the most frequent one, twice, so that a
    large group has few; and a home is cut by hash into parts of about `size` nodes. Parts that
    share a bucket meet in a cell, each pair of parts once, and a part of several nodes meets itself (within). So nearly
    equal groups, whose buckets overlap, are compared once and not once a bucket, and nodes without a common bucket seldom meet.
    Buckets that hold the same parts count once. Nodes of a part with more than LISTED cells have several rows.
    """
    counts = common.stored(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    if common.few(counts):
        met = buckets.join(F.broadcast(counts.withColumnRenamed("n", "size")), "bucket")
    else:
        met = common.joined(buckets, counts.withColumn("size", F.col("n")), "bucket", rows)
    met = common.stored(met.select("node", "bucket", "size"), "met")
    home = met.groupBy("node").agg(F.max(F.struct("size", "bucket")).alias("x")).select("node", F.col("x.bucket").alias("home"))
    home = common.stored(home, "homes")
    nodes = home.count()
    for _ in range(ROUNDS):  # a home moves to the one that is most frequent in a bucket of its nodes
        sharing = common.stored(met.join(home, "node").groupBy("bucket", "home").agg(F.count("*").alias("c")), "sharing")
        lead = sharing.groupBy("bucket").agg(F.max(F.struct("c", F.col("home").alias("to"))).alias("lead"))
        moved = sharing.join(lead, "bucket").groupBy("home").agg(F.max("lead").alias("lead"))
        moved = moved.join(home.groupBy("home").agg(F.count("*").alias("n")), "home").select("home", "n", F.col("lead.to").alias("to"))
        home = common.stored(common.joined(home, moved, "home", nodes).select("node", F.col("to").alias("home")), "homes")
    sized = home.groupBy("home").agg(F.count("*").alias("n")).withColumn("chunks", F.ceil(F.col("n") / size))
    chunk = F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks"))
    parts = common.stored(common.joined(home, sized, "home", nodes).select("node", F.xxhash64("home", chunk).alias("part")), "parts")
    touched = common.stored(met.join(parts, "node").select("bucket", "part").distinct(), "touched")
    sets = touched.groupBy("bucket").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("part")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), F.col("part"))).alias("y"))
    kept = sets.where("c > 1").groupBy("c", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", F.col("c").alias("n"))
    kept = common.stored(kept, "kept")
    several = common.joined(touched, kept.withColumn("c", F.col("n")), "bucket", max(1, touched.count())).select("bucket", "part")
    pair = several.select("bucket", F.col("part").alias("p")).join(several.select("bucket", F.col("part").alias("q")), "bucket").where("p < q").select("p", "q").distinct()
    both = pair.select(F.explode(F.array("p", "q")).alias("part"), F.xxhash64("p", "q").alias("cell"), F.lit(False).alias("within"))
    own = parts.groupBy("part").agg(F.count("*").alias("c")).where("c > 1").select("part", F.xxhash64("part").alias("cell"), F.lit(True).alias("within"))
    each = both.unionByName(own).withColumn("nth", F.floor((F.row_number().over(W.partitionBy("part").orderBy("cell")) - 1) / LISTED))
    lists = each.groupBy("part", "nth").agg(F.collect_list(F.struct("cell", "within")).alias("cells"))
    return parts.join(lists, "part").select("node", "part", "cells")


def whole_cells(batches: Iterator[pa.RecordBatch], key: str = "cell") -> Iterator[pa.Table]:
    """Tables of whole cells from batches sorted by key; a cell's rows never straddle two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        if held and held[-1].column(batch.schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, int(change[-1]) + 1)])
            held = [batch.slice(int(change[-1]) + 1)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def cells(table: pa.Table, key: str = "cell") -> np.ndarray:
    """The len+1 offsets of the cells of a sorted table."""
    keys = table.column(key).to_numpy()
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n indexes reaches over the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        was = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == was).all():
            break
    return label


def parts(node: np.ndarray, weight: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Link counts and forest edges of the linked index pairs (i, j); weight: the rows that a node stands for."""
    n = len(node)
    links = np.bincount(i, weights=weight[j], minlength=n) + np.bincount(j, weights=weight[i], minlength=n) if len(i) else np.zeros(n)
    label, has = forest(n, i, j), np.flatnonzero(links)
    tree = np.flatnonzero(label != np.arange(n))
    other = pa.array(np.concatenate([np.zeros(len(has), np.int64), node[label[tree]]]), mask=np.arange(len(has) + len(tree)) < len(has))
    count = np.concatenate([links[has].astype(np.int64), np.zeros(len(tree), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[has], node[tree]])), other, pa.array(count)], ["node", "other", "links"])


def resolve(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, root, links, first) of the nodes in found (PARTS): the component's least node, direct links to others, and the
    least `low` of the component.

    classes(node, low, mult) has one row for each set of equal rows.
    """
    found = common.stored(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(found.where("other is not null").select(F.col("node").alias("src"), F.col("other").alias("dst")))
    member = common.stored(root.join(classes, "node").select("node", "root", "low"), "members")
    first = member.groupBy("root").agg(F.min("low").alias("first"), F.count("*").alias("n"))
    return common.joined(member, first, "root", member.count()).join(links, "node", "left").select("node", "root", F.coalesce("links", F.lit(0)).alias("links"), "first")
