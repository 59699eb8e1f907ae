"""The trie of conversations that begin alike: one node for each distinct sequence of first turns.

A turn is 16 bytes, the MD5 of its role and text, and a conversation the row of its turns' bytes (`paths`). The
rows are range-partitioned by (path, conv_id) into shards; a path that a third of all conversations share is cut by id like any
other range. In a shard NumPy pads the paths to a matrix of turn ids, sorts it by `lexsort`, and marks with masks where a row
leaves the row before it; a mask accumulated by OR over the columns marks where nodes start. `reduceat` over the rows of
each depth then sums every node. Deep matrices are taken in blocks of `COLUMNS` columns over the rows that reach them, so a few
long conversations do not widen all.

Every sum is one over rows: members, starts of child nodes, rows that end a leaf, and sizes of turns but for the first
row of each node. A shard sees the last row before it and the first one after it, which weigh nothing, so starts and
leaves are counted once, in one shard. Nodes that such a row shares may go on in other shards: their partial sums carry the
MD5 of their path and are added up by Spark; there are at most two paths of them a shard. All other nodes are whole.

SHA-256 runs over a node's ids in order and cannot be added up. Nodes that lie in one shard are hashed there; the others'
ids travel as rendered pieces in order, and one pass over each node's sorted pieces feeds them to the hash, so a
task holds a piece and not the group. That the pieces of one node pass through one task is the digest's nature.

Defined cases: a row without conv_id belongs to no conversation and is ignored; a missing turn comes first, missing
role or text is empty; rows that tie on turn go by role, then by hash of the text, and repeated rows are turns of their
own. A conversation without turns is a member of the root. An empty table has no nodes. A conversation travels as
one row of about 20 bytes a turn, whatever its texts' lengths. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import crc_of_id, stored

SHARD_TURNS = 1_000_000
COLUMNS = 32  # of a padded matrix
PIECE = 2048  # ids rendered in one piece
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "kind int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, key binary, parent_key binary, shard int, piece long, ids string"
)
WHOLE, PARTIAL, ENDS = 0, 1, 2


# --- conversations as paths ------------------------------------------------------------------------------


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids array<string>, sizes array<int>): MD5 and code points of each turn in order."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id is not null").select(
        "conv_id",
        F.struct("turn", role.alias("role"), F.md5(F.encode(said, "UTF-8")).alias("id"), F.length(text).alias("size")).alias("said"),
    )
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return rows.select("conv_id", F.col("said.id").alias("ids"), F.col("said.size").alias("sizes"))


def regrown_paths(paths: DataFrame, family: int = 100, shared: int = 6) -> DataFrame:
    """Every conversation with its first turns from its family's first one: a trie with branches out of any table.

    The first h turns come from conversation c - c % family, h = CRC-32 of the id % shared, and its own follow from the h-th on.
    """
    first = paths.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), F.slice("ids", 1, shared).alias("head_ids"), F.slice("sizes", 1, shared).alias("head_sizes")
    )
    own = paths.withColumns({"head": F.col("conv_id") - F.col("conv_id") % family, "h": (crc_of_id(F.col("conv_id")) % shared).cast("int")})
    both = own.join(first, "head", "left")

    def joined(head: str, rest: str):
        led = F.slice(F.coalesce(F.col(head), F.array().cast(paths.schema[rest].dataType)), F.lit(1), F.col("h"))
        return F.concat(led, F.slice(F.col(rest), F.col("h") + 1, F.greatest(F.size(rest), F.lit(1)))).alias(rest)

    return both.select("conv_id", joined("head_ids", "ids"), joined("head_sizes", "sizes"))


# --- one shard -------------------------------------------------------------------------------------------


def _ordered(high, low, first, length, conv, side) -> tuple[np.ndarray, np.ndarray]:
    """The order of a shard's rows by path and id, and for each turn of each row in that order whether it starts a node.

    high, low: the halves of all turn ids, row by row from first on. Shorter paths come before their extensions.
    """
    n = len(length)
    rank = np.zeros(n, np.int64)
    for block in range(0, int(length.max(initial=0)), COLUMNS):
        active = np.flatnonzero(length > block)
        width = min(COLUMNS, int(length.max()) - block)
        keys = []
        for j in reversed(range(block, block + width)):
            reach = length[active] > j
            at = np.where(reach, first[active] + j, 0)
            keys += [np.where(reach, low[at], 0), np.where(reach, high[at], 0)]
        order = np.lexsort([*keys, rank[active]])
        change = np.zeros(len(active), bool)
        for key in [*keys, rank[active]]:
            change[1:] |= key[order][1:] != key[order][:-1]
        within = np.zeros(n, np.int64)
        within[active[order]] = np.cumsum(change) + 1  # rows that ended before stay at 0, ahead of the others
        order = np.lexsort([within, rank])
        step = (np.diff(rank[order]) != 0) | (np.diff(within[order]) != 0)
        rank[order] = np.concatenate([[0], np.cumsum(step)])
    order = np.lexsort([conv, rank, side])
    length, first = length[order], first[order]
    start = np.ones(int(length.sum()), bool)
    begin = np.concatenate([[0], np.cumsum(length)])[:-1]
    left = np.zeros(n, bool)  # rows that have left the row before them in an earlier column
    left[0] = True
    for block in range(0, int(length.max(initial=0)), COLUMNS):
        rows = np.flatnonzero(length > block)
        before = np.maximum(rows - 1, 0)
        mask = np.zeros((len(rows), COLUMNS), bool)
        for c in range(COLUMNS):
            j = block + c
            both = (length[rows] > j) & (length[before] > j)
            x, y = np.where(both, first[rows] + j, 0), np.where(both, first[before] + j, 0)
            mask[:, c] = ~both | (high[x] != high[y]) | (low[x] != low[y])
        mask[:, 0] |= left[rows]
        mask = np.logical_or.accumulate(mask, axis=1)
        left[rows] = mask[:, -1]
        place = begin[rows, None] + block + np.arange(COLUMNS)
        real = length[rows, None] > block + np.arange(COLUMNS)
        start[place[real]] = mask[real]
    return order, start


def _path_keys(path: bytes) -> list[bytes]:
    """The MD5 of every prefix of a path, from the empty one on."""
    h = hashlib.md5()
    keys = [h.digest()]
    for k in range(0, len(path), 16):
        h.update(path[k : k + 16])
        keys.append(h.digest())
    return keys


def _shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of a shard: whole ones, partial sums of those it shares with others, and pieces of the latter's ends."""
    shard = table["shard"][0].as_py()
    conv, side = table["conv_id"].to_numpy(), table["side"].to_numpy()
    paths = table["path"].combine_chunks()
    paths = paths.chunk(0) if isinstance(paths, pa.ChunkedArray) else paths
    offset = np.frombuffer(paths.buffers()[1], np.int32, len(paths) + 1, paths.offset * 4).astype(np.int64)
    halves = np.frombuffer(paths.buffers()[2], ">u8") if paths.buffers()[2] is not None else np.zeros(0, ">u8")
    halves = halves[: int(offset[-1]) // 8].astype(np.uint64)
    high, low = (np.append(halves[k::2], np.uint64(0)) for k in (0, 1))
    first, length = offset[:-1] // 16, np.diff(offset) // 16
    order, start = _ordered(high, low, first, length, conv, side)

    sizes = table["sizes"].combine_chunks()
    sizes = sizes.chunk(0) if isinstance(sizes, pa.ChunkedArray) else sizes
    size_first, size_flat = sizes.offsets.to_numpy().astype(np.int64), sizes.values.to_numpy().astype(np.int64)
    conv, side, length = conv[order], side[order], length[order]
    n = len(order)
    begin = np.concatenate([[0], np.cumsum(length)])
    row = np.repeat(np.arange(n), length)
    size = size_flat[size_first[order][row] + np.arange(len(row)) - begin[row]]
    own = side == 0
    saved = np.concatenate([[0], np.cumsum(size * ~start * own[row])])  # up to each turn of all rows
    apart = np.zeros(n, np.int64)  # turns shared with the row before
    np.add.at(apart, row, ~start)
    leaf = own.copy()
    leaf[:-1] &= apart[1:] < length[:-1]
    # A row without turns is a leaf's end only where nothing follows at all.
    weight, none = own.astype(np.int64), np.int64(np.iinfo(np.int64).max)
    lowest = np.where(own, conv, none)
    keys = {s: _path_keys(paths[int(order[k])].as_py()) for s, k in ((-1, 0), (1, n - 1)) if side[k] == s}

    out = {c: [] for c in ("kind", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    texts: list[tuple[str | None, bytes | None, bytes | None]] = []
    pieces: list[tuple[int, bytes, int, str]] = []
    node_of = np.zeros(n, np.int64)  # each row's node of the depth before, its number in that depth
    above_conv, above_key = np.zeros(1, np.int64), [None]
    for depth in range(int(length.max(initial=0)) + 1):
        rows = np.flatnonzero(length >= depth)
        if depth:
            opens = start[begin[rows] + depth - 1].copy()
            opens[0] = True
        else:
            opens = np.arange(len(rows)) == 0
        at = np.flatnonzero(opens)
        deeper = rows[length[rows] > depth]
        child = np.zeros(n, np.int64)
        child[deeper] = start[begin[deeper] + depth]
        add = lambda x: np.add.reduceat(x[rows], at)
        members = add(weight)
        from_ = begin[rows] + max(depth - 1, 0)
        sums = {
            "conv_id": np.minimum.reduceat(lowest[rows], at), "n_convs": members, "n_children": add(child * weight),
            "n_leaves": add(leaf.astype(np.int64)), "saved_tokens": np.add.reduceat(saved[begin[rows + 1]] - saved[from_], at),
        }
        shared = np.maximum.reduceat(np.abs(side[rows]), at) > 0 if depth else np.ones(1, bool)
        number = np.cumsum(opens) - 1
        # Keys of shared nodes: that of the neighbouring shard's row inside them. The root is always shared.
        key = [None] * len(at)
        for s, mine in keys.items():
            k = rows[0] if s < 0 else rows[-1]
            if side[k] == s and len(mine) > depth:
                key[int(number[0 if s < 0 else -1])] = mine[depth]
        if not depth:
            key[0] = hashlib.md5().digest()
        parent = node_of[rows[at]]
        parent_key = [above_key[p] if depth else None for p in parent]
        ends = own[rows] & (length[rows] == depth)
        digest = [NO_ENDS] * len(at)
        if ends.any():
            at_end = number[ends]
            whose, cut = np.unique(at_end, return_index=True)
            ids = conv[rows[ends]]
            for node, a, b in zip(whose, cut, [*cut[1:], len(ids)], strict=True):
                if key[node] is None:
                    digest[node] = hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()
                else:
                    pieces += [
                        (depth, key[node], int(ids[k]), ",".join(map(str, ids[k : min(b, k + PIECE)].tolist()))) for k in range(a, b, PIECE)
                    ]
        real = np.flatnonzero(members > 0)
        for c, x in sums.items():
            out[c].append(x[real])
        out["kind"].append(np.where(shared[real], PARTIAL, WHOLE))
        out["depth"].append(np.full(len(real), depth))
        out["parent_conv_id"].append(above_conv[parent][real] if depth else np.zeros(len(real), np.int64))
        texts += [(digest[k], key[k], parent_key[k]) for k in real]
        node_of[rows] = number
        above_conv, above_key = sums["conv_id"], key
    flat = {c: np.concatenate(x) for c, x in out.items()}
    k, m = len(flat["kind"]), len(pieces)
    wide = lambda x, rest, kind=pa.int64(): pa.array([*x, *rest], kind)
    filled = {c: pa.array(np.concatenate([flat[c], np.zeros(m, np.int64)])) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    unknown = [p is not None or not d for (_, _, p), d in zip(texts, flat["depth"], strict=True)]
    return pa.table(
        {
            "kind": pa.array(np.concatenate([flat["kind"], np.full(m, ENDS)]), pa.int32()),
            "depth": wide(flat["depth"].tolist(), [p[0] for p in pieces]),
            "conv_id": filled["conv_id"],
            "parent_conv_id": wide([None if u else int(x) for x, u in zip(flat["parent_conv_id"], unknown, strict=True)], [None] * m),
            **{c: filled[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")},
            "ends_sha256": wide([t[0] for t in texts], [None] * m, pa.string()),
            "key": wide([t[1] for t in texts], [p[1] for p in pieces], pa.binary()),
            "parent_key": wide([t[2] for t in texts], [None] * m, pa.binary()),
            "shard": pa.array(np.full(k + m, shard), pa.int32()),
            "piece": wide([None] * k, [p[2] for p in pieces]),
            "ids": wide([None] * k, [p[3] for p in pieces], pa.string()),
        }
    )


# --- all shards ------------------------------------------------------------------------------------------


def _digests(batches):
    """SHA-256 of each key's pieces; they arrive sorted by key, shard and first id, and only the running hash is held."""
    key, running = None, None
    done: list[tuple[bytes, str]] = []
    for b in batches:
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if k != key:
                if running is not None:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256(ids.encode())
            else:
                running.update(("," + ids).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], ["key", "ends"])
            done = []
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends"])


def _sharded(paths: DataFrame, most_turns: int) -> DataFrame:
    """(shard, side, conv_id, path, sizes): rows in ranges of (path, conv_id), each shard with its two neighbours' nearest rows."""
    spark = paths.sparkSession
    rows = stored(
        paths.select("conv_id", F.unhex(F.array_join("ids", "")).alias("path"), F.col("sizes").cast("array<int>").alias("sizes")), "trie-paths"
    )
    total = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / most_turns))
    rows = stored(rows.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id()), "trie-shards")
    ends = rows.groupBy("shard").agg(F.min(F.struct("path", "conv_id", "sizes")).alias("low"), F.max(F.struct("path", "conv_id", "sizes")).alias("high"))
    ends = stored(ends, "trie-ends")  # two rows a shard
    numbers = [r.shard for r in ends.select("shard").sort("shard").collect()]
    after = spark.createDataFrame(list(zip(numbers, numbers[1:])), "before int, after int")
    row = lambda end, side: (F.lit(side).alias("side"), f"{end}.conv_id", f"{end}.path", f"{end}.sizes")
    last = after.join(ends, after["before"] == ends["shard"]).select(F.col("after").alias("shard"), *row("high", -1))
    next_ = after.join(ends, after["after"] == ends["shard"]).select(F.col("before").alias("shard"), *row("low", 1))
    return rows.select("shard", F.lit(0).alias("side"), "conv_id", "path", "sizes").unionByName(last).unionByName(next_)


def prefix_trie(paths: DataFrame, most_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    paths holds a row for each conv_id (`conversation_paths`). A node is the first `depth` turns of its `conv_id`, its
    smallest member; so the text of its last turn is that turn of that conversation.
    """
    made = stored(_sharded(paths, most_turns).groupBy("shard").applyInArrow(_shard_nodes, NODE), "trie-nodes")
    pieces = made.filter(F.col("kind") == ENDS).select("key", "shard", "piece", "ids")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "shard", "piece")
    ends = pieces.mapInArrow(_digests, "key binary, ends string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = made.filter(F.col("kind") == PARTIAL).groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.min("parent_key").alias("parent_key"), *sums)
    parts = stored(parts.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))), "trie-shared")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = made.filter(F.col("kind") == WHOLE)
    known = whole.filter("parent_key is null").select(shown)
    above = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    open_ = whole.drop("parent_conv_id").unionByName(parts, allowMissingColumns=True).filter("parent_key is not null")
    root = parts.filter("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(shown)
    return known.unionByName(open_.join(above, "parent_key").select(shown)).unionByName(root)
