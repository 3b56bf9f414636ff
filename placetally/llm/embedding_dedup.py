"""Near-duplicate vectors: small-world graphs per shard, every shard searched, cosine verified, components joined."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import stored
from placetally.llm.components import connected_components, forest
from placetally.llm.hnsw import Graph, audited_beam, near

THRESHOLD = 0.98
SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
BEAM = 64
AUDIT_SHARE = 0.25
AUDIT_LEAST = 1_024
SALTS = 32


def _usable(vector: str) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(group: pd.DataFrame) -> np.ndarray:
    return np.stack(group["vector"].to_numpy()).astype(np.float64)


def _built(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("node")
    graph = Graph(_unit(_matrix(group)))
    beam = audited_beam(graph, THRESHOLD, BEAM, AUDIT_SHARE, AUDIT_LEAST)
    return pd.DataFrame({
        "label": [key[0]], "dim": [key[1]], "shard": [key[2]], "beam": [beam], "graph": [graph.dump()],
        "ids": [group["node"].to_numpy().astype(np.int64).tobytes()],
        "weights": [group["n"].to_numpy().astype(np.int64).tobytes()],
        "exact": [_matrix(group).tobytes()],
    })


def _searched(threshold: float):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Links of a block of vectors with a shard: how many each has, and a forest that joins them."""
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        index = right.iloc[0]
        graph = Graph.load(index["graph"])
        ids = np.frombuffer(index["ids"], np.int64)
        weights = np.frombuffer(index["weights"], np.int64)
        exact = np.frombuffer(index["exact"], np.float64).reshape(len(ids), -1)
        q, own = _matrix(left), left["node"].to_numpy().astype(np.int64)
        norm, norms = np.sqrt((q * q).sum(axis=1)), np.sqrt((exact * exact).sum(axis=1))
        unit = _unit(q).astype(np.float32)
        counts, a, b = np.zeros(len(q), np.int64), [], []
        for i, found in enumerate(near(graph, unit, threshold, int(index["beam"]))):
            found = found[ids[found] != own[i]]
            found = found[exact[found] @ q[i] / (norms[found] * norm[i]) >= threshold]
            if len(found):
                counts[i] = weights[found].sum()
                a.append(np.full(len(found), own[i]))
                b.append(ids[found])
                if sum(map(len, a)) > 1_000_000:
                    x, y = forest(np.concatenate(a), np.concatenate(b))
                    a, b = [x], [y]
        some = counts > 0
        out = [pd.DataFrame({"a": own[some], "b": own[some], "n": counts[some]})]
        if a:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            out.append(pd.DataFrame({"a": x, "b": y, "n": np.zeros(len(x), np.int64)}))
        return pd.concat(out)

    return search


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings`` (vec_id, embedding, label).

    Vectors of one label with a cosine of at least ``threshold`` are linked.
    Null labels, null or empty vectors, zeros and components that are null or
    not finite link with nothing; so do vectors of different lengths.  Equal
    vectors of a label are one node with a weight, so copies of any number cost
    one search.  A label is cut into shards by a hash; each vector is searched
    in every shard of its label.  Rows that repeat a vec_id are vectors of
    their own, with links of their own, also to each other; a component has the
    smallest vec_id of its rows.  Rows without vec_id link with nothing.  A link
    counts for the vectors whose search has found it.  An empty table gives no
    rows.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").alias("vector")
    )
    rows = rows.withColumn("usable", _usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # each different vector of a label is a node; its number is fixed when it is stored
    reps = stored(
        rows.filter("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("rep_id"), F.count("*").alias("n"))
        .withColumns({"dim": F.size("vector"), "node": F.monotonically_increasing_id()}), "vectors"
    )
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("size")).select(
        F.col("label").alias("of"), F.col("dim").alias("long"), F.ceil(F.col("size") / SHARD_ROWS).alias("shards"),
        F.ceil(F.col("size") / BLOCK_ROWS).alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    dealt = reps.withColumn("at", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    dealt = dealt.join(
        sizes, (dealt["label"] == sizes["of"]) & (dealt["dim"] == sizes["long"]) & (dealt["at"] == sizes["salt"])
    ).select(
        "label", "dim", "node", "n", "vector", "shards", "blocks",
        F.pmod(F.xxhash64("node", F.lit(1)), "shards").alias("shard"),
        F.pmod(F.xxhash64("node", F.lit(2)), "blocks").alias("block"),
    )
    label = reps.schema["label"].dataType.simpleString()
    index = stored(
        dealt.groupBy("label", "dim", "shard").applyInPandas(
            _built, f"label {label}, dim int, shard long, beam long, graph binary, ids binary, weights binary, exact binary"
        ),
        "graphs",
    )
    blocks = sizes.filter("salt = 0").select("of", "long", "blocks")
    copies = index.join(blocks, (index["label"] == blocks["of"]) & (index["dim"] == blocks["long"])).select(
        "label", "dim", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "beam", "graph", "ids", "weights", "exact",
    )
    queries = dealt.select(
        "label", "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "block", "node", "vector"
    )
    on = ["label", "dim", "shard", "block"]
    found = stored(
        queries.groupBy(*on).cogroup(copies.groupBy(*on)).applyInPandas(_searched(threshold), "a long, b long, n long"), "links"
    )
    counts = found.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    joined = connected_components(found.filter("a <> b").select("a", "b"))
    roots = stored(
        reps.join(counts, "node", "left").join(joined, "node", "left").select(
            F.col("label").alias("of"), F.col("vector").alias("same"), "rep_id", F.coalesce("component", "node").alias("root"),
            (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("linked"),
        ), "vector-roots",
    )
    least = roots.groupBy("root").agg(F.min("rep_id").alias("component"))
    nodes = roots.join(least, "root").select("of", "same", "linked", "component")
    on_rows = rows["usable"] & (rows["label"] == nodes["of"]) & (rows["vector"] == nodes["same"])
    component = F.coalesce("component", "vec_id")
    return rows.join(nodes, on_rows, "left").select(
        "vec_id", F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
