"""Near-duplicate vectors by tiled comparison in PCA order.

Vectors are scaled to length one and turned so that leading dimensions carry most of the variance (the
directions come from second moments of all vectors, summed by Spark; a turn changes no cosine). Equal
vectors are one class. Classes are dealt to cells of the two leading dimensions, as wide as two vectors at
the threshold can be apart, so a vector's partners are in its cell or a neighbour's. A cell holds
tiles of bounded size, and two tiles are compared at a time: products are accumulated over leading dimensions
first, and a pair is dropped as soon as its product so far plus the product of both rests' norms stays
below the threshold. Pairs that remain are decided by the cosine of the original components, in double precision.

From every two tiles come the number of links for each vector and a spanning forest of the links, at most as many
rows as vectors: the number of rows never grows with the square of a group of near copies.

Defined cases: a vector that is null, empty, zero, or has null or non-finite components, or whose label is
null, is linked with nothing and is its own component. Vectors of different lengths are never
compared. Components of any finite size count, the smallest and largest too. Rows that share an id are one vector (the largest by label, then components); a null id drops the row. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import components, stored

COSINE = 0.98
TILE = 1024
STEPS = (4, 8, 16, 32)
SLACK = 1e-9  # for rounding in the turned products; the decision itself is on the original components


def _scaled(rows) -> np.ndarray:
    """Vectors as a matrix, each times the power of two that brings its largest component to one half or more.

    No cosine changes, and no square of a component over- or underflows in what counts.
    """
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the directions of falling variance: a square matrix with a column for each."""

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, part in b.groupby("d")["embedding"]:
                x = _scaled(part)
                x /= np.linalg.norm(x, axis=1)[:, None]
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            at = np.arange(d * d)
            yield pd.DataFrame({"d": d, "i": at, "s": s.ravel()})

    total = vectors.select("d", "embedding").mapInPandas(moments, "d int, i int, s double").groupBy("d", "i").agg(F.sum("s").alias("s"))
    out = {}
    for d, part in total.toPandas().groupby("d"):  # d * d sums for each length
        s = np.zeros(d * d)
        s[part["i"]] = part["s"]
        out[int(d)] = np.linalg.eigh(s.reshape(d, d))[1][:, ::-1]
    return out


def _compare(x: pd.DataFrame, y: pd.DataFrame, same: bool, axes: np.ndarray, least: float):
    """Index pairs (i of x, j of y) whose cosine reaches the threshold; i < j where both are the same tile."""
    a, b = _scaled(x["embedding"]), _scaled(y["embedding"])
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    ta, tb = (a / na[:, None]) @ axes, (b / nb[:, None]) @ axes
    d = axes.shape[0]
    cuts = [0, *(s for s in STEPS if s < d), d]
    rest = lambda t, k: np.sqrt(np.maximum(0, 1 - np.square(t[:, :k]).sum(1)))
    k = cuts[1]
    bound = ta[:, :k] @ tb[:, :k].T + np.outer(rest(ta, k), rest(tb, k)) >= least - SLACK
    if same:
        bound = np.triu(bound, 1)
    i, j = np.nonzero(bound)
    done = np.einsum("ij,ij->i", ta[i, :k], tb[j, :k])
    for lo, hi in zip(cuts[1:], cuts[2:], strict=False):
        if not len(i):
            break
        done = done + np.einsum("ij,ij->i", ta[i, lo:hi], tb[j, lo:hi])
        alive = done + rest(ta, hi)[i] * rest(tb, hi)[j] >= least - SLACK
        i, j, done = i[alive], j[alive], done[alive]
    cosine = np.einsum("ij,ij->i", a[i], b[j]) / (na[i] * nb[j])
    return i[cosine >= least], j[cosine >= least]


def _forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Positions of links that join what earlier ones leave apart."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    kept = []
    for at, (u, v) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        u, v = find(u), find(v)
        if u != v:
            root[max(u, v)] = min(u, v)
            kept.append(at)
    return kept


def embedding_links(vectors: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    one = vectors.filter("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).groupBy("vec_id").agg(F.max(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.*")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    one = stored(one.withColumn("usable", usable), "vectors")
    classes = one.filter("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("d", F.size("embedding")), "classes")
    axes = spark.sparkContext.broadcast(_axes(classes))
    width = math.sqrt(max(2 - 2 * cosine, 1e-12)) * (1 + 1e-9)

    def place(batches):
        for b in batches:
            cells = np.zeros((len(b), 2), np.int64)
            for at, d, v in zip(range(len(b)), b["d"], b["embedding"], strict=True):
                v = _scaled([v])[0]
                cells[at, : min(d, 2)] = np.floor((v / np.linalg.norm(v)) @ axes.value[d][:, :2] / width)
            yield b.assign(cx=cells[:, 0], cy=cells[:, 1])

    placed = classes.mapInPandas(place, "label string, embedding array<double>, rep long, copies long, d int, cx long, cy long")
    placed = stored(placed, "placed")
    cell = ["label", "d", "cx", "cy"]
    tiles = placed.groupBy(*cell).agg(F.ceil(F.count("*") / F.lit(tile)).alias("tiles"))
    placed = placed.join(tiles, cell).withColumn("t", F.pmod(F.xxhash64("rep"), "tiles"))

    # Pairs of tiles: in a cell each tile with itself and later ones, and with all tiles of half the neighbours.
    steps = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))))
    other = tiles.select("label", "d", F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("tiles").alias("others"))
    near = tiles.withColumn("step", F.explode(steps)).withColumn("ox", F.col("cx") + F.col("step.x")).withColumn(
        "oy", F.col("cy") + F.col("step.y")
    ).join(other, ["label", "d", "ox", "oy"])
    near = near.withColumn("ta", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    near = near.withColumn("tb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    near = near.filter("not (cx = ox and cy = oy and tb < ta)").withColumn("task", F.xxhash64(*cell, "ox", "oy", "ta", "tb"))
    same = F.expr("cx = ox and cy = oy and ta = tb")
    near = near.select("task", *cell, "ox", "oy", "ta", "tb", same.alias("same"))

    # A tile is a key of at most a tile's rows, so the join on it is even; the pair's name groups both sides.
    left = placed.join(near.withColumnRenamed("ta", "t"), [*cell, "t"]).select("task", "same", F.lit(0).alias("side"), "d", "rep", "copies", "embedding")
    at = near.filter("not same").select("task", "label", "d", F.col("ox").alias("cx"), F.col("oy").alias("cy"), F.col("tb").alias("t"))
    right = placed.join(at, [*cell, "t"]).select("task", F.lit(False).alias("same"), F.lit(1).alias("side"), "d", "rep", "copies", "embedding")

    def links(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rep")
        same, d = bool(part["same"].any()), int(part["d"].iloc[0])
        x = part[part["side"] == 0]
        y = x if same else part[part["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        i, j = _compare(x, y, same, axes.value[d], cosine)
        a, b = x["rep"].to_numpy(), y["rep"].to_numpy()
        n = {}
        for ids, other, mine, theirs in ((a, y["copies"].to_numpy(), i, j), (b, x["copies"].to_numpy(), j, i)):
            sums = np.bincount(mine, other[theirs], len(ids))
            for r in np.flatnonzero(sums):
                n[int(ids[r])] = n.get(int(ids[r]), 0) + int(sums[r])
        tree = _forest(a[i], b[j])
        counts = pd.DataFrame({"a": list(n), "b": list(n), "n": list(n.values())})
        return pd.concat([counts, pd.DataFrame({"a": a[i][tree], "b": b[j][tree], "n": 0})]).astype("int64")

    found = stored(left.unionAll(right).groupBy("task").applyInPandas(links, "a long, b long, n long"), "links")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comps = components(found.filter("a <> b").select("a", "b")).withColumnRenamed("id", "rep")
    summary = classes.select("label", "embedding", "rep", "copies").join(counts, "rep", "left").join(comps, "rep", "left")
    summary = summary.select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    known = one.filter("usable").select("vec_id", "label", "embedding").join(summary, ["label", "embedding"])
    alone = one.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = known.select("vec_id", "n_links", F.col("component").alias("component_id")).unionAll(alone)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
