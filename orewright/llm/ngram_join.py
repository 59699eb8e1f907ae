"""N-gram Jaccard join by prefixes under several global token orders.

A token is the 64-bit hash of a shingle of five words. Two sets whose Jaccard index reaches the
threshold share a token within the first ``prefix_length`` tokens of either set, under *any* order of
all tokens. Each order here sorts first by how common a token is in the corpus (in half powers of
two, from a counting sketch of fixed size over all documents), then by a hash of its own. A candidate
pair must meet in the prefixes of the first order, found by a join on tokens, and then in those of
every other order, before its sets are compared.

Groups of copies are never expanded into pairs:

* equal sets are one class, represented by its smallest id;
* sets that share the head of some order's prefix are first compared with the smallest id that has
  the same head. Verified links give components, so a group of thousands of near copies costs one
  comparison for each member and head;
* the exact join looks only at tokens that occur in more than one component. In the token's list the
  largest component is not compared with itself; every other row is compared with all rows of other
  components. So each pair of sets in different components that could be linked is verified, and
  the result is complete. Those that the join links are merged. Pairs that meet too late in the
  first order to reach the threshold with all that lies behind are not compared.

Defined cases: a missing or empty text, or one of separators only, has an empty set, is linked with
nothing and is its own component. Fewer than five words make one shingle. Repeated rows of an id
count as one document if their texts agree; if not, the row with the longer set stands for the id
(ties: by fingerprint). A missing id is dropped, as it names no document. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import components, id_filter, kept_by_worker, stored
from orewright.llm.words import mixed, shingle_sets, slices

ORDERS = 3
HEADS = 6
SKETCH_BITS = 23  # counters of the sketch, as a power of two; a sixteenth of the tokens tells passages from chance
SKETCH_CHUNK = 1 << 16


def _seeds(n: int) -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, n, np.uint64)


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def token_sketch(docs: DataFrame) -> np.ndarray:
    """Upper estimates of every token's document count: counters that tokens share, as many for any corpus.

    They only shape the orders; any order gives the same result. Counters are added up by Spark per
    chunk of the sketch; the driver receives 16 megabytes, as counters stop at 65,535.
    """

    def count(batches):
        kept_by_worker("n-grams")
        row = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = list(shingle_sets(part.column(0)))
                if sets:
                    np.add.at(row, _slots(np.concatenate(sets)), 1)
        for number, chunk in enumerate(row.reshape(-1, SKETCH_CHUNK)):
            if top := int(chunk.max()):
                kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([chunk.astype(kind).tobytes()], pa.binary())], ["chunk", "counts"]
                )

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH_CHUNK, np.uint64)
        for c in part["counts"]:
            total += np.frombuffer(c, f"<u{len(c) // SKETCH_CHUNK}")
        return pd.DataFrame({"chunk": part["chunk"].iloc[:1], "counts": [np.minimum(total, 65535).astype(np.uint16).tobytes()]})

    made = (
        docs.select("text").mapInArrow(count, "chunk int, counts binary")
        .groupBy("chunk").applyInPandas(add, "chunk int, counts binary").toArrow()
    )
    sketch = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNK * SKETCH_CHUNK, np.uint16).reshape(-1, SKETCH_CHUNK)
    for chunk, counts in zip(made["chunk"], made["counts"], strict=True):
        sketch[chunk.as_py()] = np.frombuffer(counts.as_buffer(), np.uint16)
    return sketch.ravel()


def prefix_length(n: int) -> int:
    """With fewer than a quarter of its tokens missing, a partner of any size must share one of these."""
    return n - (3 * n + 3) // 4 + 1 if n else 0


def ordered_prefix(tokens: np.ndarray, sketch: np.ndarray, seed: np.uint64) -> np.ndarray:
    """The first tokens of a set under the order (half powers of two of the count, hash under the seed)."""
    common = (2 * np.log2(np.maximum(sketch[_slots(tokens)], 1))).astype(np.uint64)
    rank = (common << np.uint64(58)) | (mixed(tokens ^ seed) >> np.uint64(6))
    need = prefix_length(len(tokens))
    chosen = np.argpartition(rank, need - 1)[:need] if need < len(tokens) else np.arange(len(tokens))
    return tokens[chosen[np.argsort(rank[chosen])]]


def _digests(docs: DataFrame, sketch) -> DataFrame:
    """Per row: set size, fingerprint of the set, heads of plain hash orders, and the first order's prefix."""
    seeds = _seeds(ORDERS + HEADS)

    def digest(batches):
        kept_by_worker("n-grams")
        for batch in batches:
            for part in slices(batch, "text"):
                ids, n, f1, f2, heads, prefixes = part.column(0), [], [], [], [], []
                for s in shingle_sets(part.column(1)):
                    n.append(len(s))
                    f1.append(np.int64(np.add.reduce(mixed(s ^ seeds[0])).view(np.int64)))
                    f2.append(np.int64(np.bitwise_xor.reduce(mixed(s ^ seeds[1])).view(np.int64)))
                    heads.append([np.int64(mixed(s ^ k).min().view(np.int64)) for k in seeds[ORDERS:]] if len(s) else [])
                    prefixes.append(ordered_prefix(s, sketch.value, seeds[0]).view(np.int64) if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                        pa.array(heads, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "f1", "f2", "heads", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        digest, "doc_id long, n long, f1 long, f2 long, heads array<long>, prefix array<long>"
    )


def _verified(docs: DataFrame, pairs: DataFrame, sets: DataFrame, sketch) -> DataFrame:
    """The pairs (a, b) that meet in every order's prefix and reach the threshold."""
    _, wanted = id_filter(pairs.select("a").unionAll(pairs.select("b")), "a")
    marks = sets.select("doc_id", "f1")
    pairs = pairs.join(marks.toDF("a", "mark_a"), "a").join(marks.toDF("b", "mark_b"), "b")
    texts = docs.filter(wanted("doc_id"))
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    seeds = _seeds(ORDERS + HEADS)

    def mark(s):
        return int(np.add.reduce(mixed(s ^ seeds[0])).view(np.int64))

    def compare(batches):
        kept_by_worker("n-grams")
        last = None
        for batch in batches:
            for part in slices(batch, "text_b"):
                kept, ids = [], part.column(0).to_pylist()
                marks_a, marks_b = part.column(2).to_pylist(), part.column(3).to_pylist()
                for i, s in enumerate(shingle_sets(part.column(5))):
                    if (ids[i], marks_a[i]) != last or mark(hub) != marks_a[i]:  # rows come in the order of a
                        last, hub = (ids[i], marks_a[i]), next(shingle_sets(part.column(4).slice(i, 1)))
                        prefixes = [ordered_prefix(hub, sketch.value, k) for k in seeds[1:ORDERS]]
                    # An id may have come with several texts; only the one that stands for it counts.
                    kept.append(
                        mark(hub) == marks_a[i] and mark(s) == marks_b[i]
                        and all(
                            np.isin(ordered_prefix(s, sketch.value, k), p).any()
                            for k, p in zip(seeds[1:ORDERS], prefixes, strict=True)
                        )
                        and _similar(s, hub)
                    )
                yield part.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    columns = both.select("a", "b", "mark_a", "mark_b", "text_a", "text_b")
    return columns.mapInArrow(compare, "a long, b long").distinct()


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate((x, y))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 75 * (len(both) - shared)


def _star_pairs(reps: DataFrame) -> DataFrame:
    """Each document with the smallest id among those that have a head in common with it."""
    heads = reps.select("doc_id", F.posexplode("heads").alias("k", "head"))
    hubs = heads.groupBy("k", "head").agg(F.min("doc_id").alias("a"), F.count("*").alias("c")).filter("c > 1")
    return heads.join(hubs.select("k", "head", "a"), ["k", "head"]).filter("a <> doc_id").select(
        "a", F.col("doc_id").alias("b")
    ).distinct()


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """Candidate pairs of different components from rows (token, doc_id, comp, n, pos) of the first order.

    Before the first token that two sets share, they share nothing, so what is left from there on in
    either set bounds the overlap; rare tokens come first, so a text with many changes is passed by.
    """
    lists = rows.groupBy("token", "comp").agg(F.count("*").alias("c"))
    largest = lists.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("largest"))
    rows = rows.join(largest, "token").withColumn("minor", F.col("comp") != F.col("largest")).drop("largest")
    minor = rows.filter("minor").select("token", *(F.col(c).alias(f"{c}_x") for c in ("doc_id", "comp", "n", "pos")))
    once = "comp <> comp_x and (not minor or doc_id_x < doc_id) and 4 * n >= 3 * n_x and 4 * n_x >= 3 * n"
    reach = "7 * least(n - pos, n_x - pos_x) >= 3 * (n + n_x)"
    return minor.join(rows, "token").filter(f"{once} and {reach}").select(
        F.least("doc_id", "doc_id_x").alias("a"), F.greatest("doc_id", "doc_id_x").alias("b")
    ).distinct()


def ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for documents (doc_id, text); see the module for the method."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        "doc_id is not null"
    )
    sketch = spark.sparkContext.broadcast(token_sketch(docs))
    digests = stored(_digests(docs, sketch), "digests")

    # One set for each id, then one representative for each set.
    one = digests.groupBy("doc_id").agg(F.max(F.struct("n", "f1", "f2")).alias("s")).select("doc_id", "s.*")
    one = stored(one, "sets")
    first = one.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    keys = ["doc_id", "n", "f1", "f2"]
    reps = digests.select(*keys, "heads").join(first.withColumnRenamed("rep", "doc_id"), keys).dropDuplicates(keys)
    reps = stored(reps, "reps")

    near = stored(_verified(docs, stored(_star_pairs(reps), "pairs"), reps, sketch), "near")
    stars = components(near)
    comp = stars.withColumnRenamed("id", "doc_id")
    grouped = reps.select(*keys).join(comp, "doc_id", "left")
    grouped = stored(grouped.select(*keys, F.coalesce("component", "doc_id").alias("comp")), "grouped")

    # Tokens of the first order's prefixes that occur in more than one component.
    prefixes = digests.select(*keys, "prefix").join(grouped, keys)
    spread = prefixes.select("comp", F.explode("prefix").alias("token")).groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high")
    ).filter("low <> high").select("token")
    spread = stored(spread, "tokens")
    _, wanted = id_filter(spread, "token")
    rows = digests.select(*keys, F.posexplode("prefix").alias("pos", "token")).filter(wanted("token"))
    rows = rows.join(spread, "token").join(grouped, keys).select("token", "doc_id", "comp", "n", "pos").distinct()
    rows = stored(rows, "rows")
    across = stored(_verified(docs, stored(_cross_pairs(rows), "pairs"), reps, sketch), "across")

    member = one.join(first, ["n", "f1", "f2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    links = stars.toDF("a", "b").unionAll(across)  # the stars stand for the links they come from
    final = components(links).withColumnRenamed("id", "rep")
    # A component's smallest representative is its smallest id: a class is represented by its smallest.
    return member.join(final, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )
