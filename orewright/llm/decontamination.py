"""Benchmark decontamination by spaced seeds, in native column expressions only.

A seed is a fixed mask over a window of words; the words under it are hashed, the others ignored. Items
and documents are joined on these hashes, so a hit survives substituted words at ignored places, and
with several seeds at any place. Around every hit the item is laid over the document and equal
words are counted place by place. A document is contaminated by an item when at least ``overlap`` of
the item's words agree; or of some ``WINDOW`` words in a row of the item, whatever share of a long item that is; or
of the item's words at hits whose shifts are within half the item's length, taken together, so that inserted and
left out words between equal parts do no harm. ``matched`` is the most words that agree at one shift, in all three cases.

The seeds lose nothing at one shift and an ``overlap`` of 0.7 or more, in items or windows: however the unequal words lie in an item, some seed hits. A
set of seeds that does so for all lengths from ``a`` to ``2 a - 1`` does so for all from ``a``, as a longer item has a part of such a
length that is equal to the same share; the tests go through those lengths. Shorter items need lighter seeds, which are used
only if the benchmark has such items.

Places of documents are tested twice before they are joined. The first two words under a seed, next to each other or
with one between, must be such a pair of an item, by a bit set over all of the items' pairs; only there are seeds hashed, and
those hashes are tested against a bit set over all of the items' seeds. Both are literals of the size that leaves
at least fifteen sixteenths of the bits empty, from 8 kB to 512 kB: a benchmark beyond some 260,000 windows
only lets more pass to the join. Neither test loses a hit. The join, and the verification's joins, are left to Spark to plan
by size; a hash in a third of all documents is one row on the benchmark's side.

Words are runs without white space, A-Z in lower case, bare of ASCII punctuation at both ends, so that an item within a sentence is
found; words of punctuation only are dropped. Items of up to three words are matched whole, as one run of words.

Defined cases: missing and empty texts and texts without words match nothing, and neither do such items. Rows
that share an id are one document: their matches are joined. A missing doc_id or item_id drops the
row. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import folded, stored

# From so many words of the item on; a seed begins and ends with a word that counts.
SEEDS_FROM = {13: ("11101", "1101001", "111001"), 8: ("11101", "1010011", "1100101", "11000101"), 4: ("111", "1101", "1011")}
SEEDS = tuple(dict.fromkeys(seed for seeds in SEEDS_FROM.values() for seed in seeds))
OVERLAP = 0.7
WINDOW = 13  # at least the longest key of SEEDS_FROM, whose seeds then hit in every such window
LEAST_BITS, MOST_BITS = 16, 22  # of a bit set's size


MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# White space with the punctuation around it; a run of punctuation is looked at from its first place only.
_BETWEEN = r"(?<![!-/:-@\[-`{-~])[!-/:-@\[-`{-~]*+[\x20\x09-\x0D][\x20\x09-\x0D!-/:-@\[-`{-~]*+"


def bare_words(text: Column) -> Column:
    """The words of a text, in lower case, bare of punctuation at both ends."""
    whole = F.btrim(folded(text), F.lit(MARKS + " \t\n\x0b\x0c\r"))
    return F.array_remove(F.split(whole, _BETWEEN), "")


def _places(seed: str) -> list[int]:
    return [i for i, c in enumerate(seed) if c == "1"]


def _gap(seed: str) -> int:
    """From the first word under a seed to the second."""
    return _places(seed)[1]


def _seed_hash(words: Column, seed: str):
    """A function from a place to the hash of the words under the seed there."""
    return lambda i: F.xxhash64(F.lit(SEEDS.index(seed)), *[F.get(words, i + p) for p in _places(seed)])


def _pair_hash(words: Column, gap: int):
    return lambda i: F.xxhash64(F.get(words, i), F.get(words, i + gap))


def _starts(words: Column, length: int) -> Column:
    """Where a run of so many words can begin."""
    begins = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length, begins).otherwise(F.array().cast("array<int>"))


def _at_starts(starts: Column, hash_at) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("pos"), hash_at(i).alias("hash")))


def _seeds_of(n: int) -> tuple[str, ...]:
    """The seeds for an item of so many words; none for one that is matched whole."""
    return next((seeds for least, seeds in SEEDS_FROM.items() if n >= least), ())


def _whole_runs(words: Column, n: int) -> Column:
    """Place and hash of every run of so many words, as the shortest items are hashed."""
    return _at_starts(_starts(words, n), lambda i: F.xxhash64(F.lit(-1), *[F.get(words, i + k) for k in range(n)]))


class BitSet:
    """A literal array of 64-bit words with the bits of all hashes set, sized by their number within bounds."""

    def __init__(self, hashes: DataFrame):
        n = hashes.count()
        self.bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
        rows = hashes.groupBy(self._word(F.col("hash")).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), self._bit(F.col("hash")))).alias("bits")
        )
        held = [0] * (1 << self.bits - 6)
        rows = rows.toArrow()  # at most 65,536 rows, whatever the benchmark
        for word, bits in zip(rows["word"].to_pylist(), rows["bits"].to_pylist(), strict=True):
            held[word] = bits
        self.words = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def _word(self, h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - self.bits + 6).cast("int")

    def _bit(self, h: Column) -> Column:
        return h.bitwiseAND(F.lit(63)).cast("int")

    def may_hold(self, h: Column) -> Column:
        return F.call_function("shiftright", F.get(self.words, self._word(h)), self._bit(h)).bitwiseAND(F.lit(1)) == 1


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, matched (equal words), n_words (of the item) of every contaminated document and its items."""
    items = benchmark.filter("item_id is not null").select("item_id", bare_words(F.col("text")).alias("item")).filter(F.size("item") > 0)
    items = stored(items.distinct(), "items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("item"), F.lit(max(SEEDS_FROM)))).distinct().collect())
    laid_out = items.select("item_id", F.size("item").alias("n"), F.col("item").alias("w"))
    by_seed = {seed: [n for n in lengths if seed in _seeds_of(n)] for seed in SEEDS}
    by_seed = {seed: ns for seed, ns in by_seed.items() if ns}
    runs = [n for n in lengths if not _seeds_of(n)]
    length = F.least("n", F.lit(max(SEEDS_FROM)))
    w = F.col("w")
    of_items = [
        F.when(length.isin(ns), _at_starts(_starts(w, len(seed)), _seed_hash(w, seed))) for seed, ns in by_seed.items()
    ]
    of_items += [F.when(F.col("n") == n, _whole_runs(w, n)) for n in runs]
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    item_hits = laid_out.select("item_id", F.explode(F.concat(*[F.coalesce(h, none) for h in of_items], none)).alias("h"))
    item_hits = stored(item_hits.select("item_id", F.col("h.pos").alias("at"), "h.hash"), "seeds")
    seen = BitSet(item_hits)
    gaps = sorted({_gap(seed) for seed in by_seed})
    pairs = {
        gap: BitSet(laid_out.select(F.explode(F.transform(_starts(w, gap + 1), _pair_hash(w, gap))).alias("hash"))) for gap in gaps
    }

    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    words = docs.select("doc_id", bare_words(F.col("text")).alias("words"))
    w = F.col("words")

    def open_places(gap: int) -> Column:
        pair = _pair_hash(w, gap)
        return F.filter(_starts(w, gap + 1), lambda i: pairs[gap].may_hold(pair(i)))

    def seeded(seed: str) -> Column:
        starts = F.filter(F.col(f"from_{_gap(seed)}"), lambda i: i <= F.size(w) - len(seed))
        return _at_starts(starts, _seed_hash(w, seed))

    words = words.select("doc_id", "words", *[open_places(gap).alias(f"from_{gap}") for gap in gaps])
    hashes = [seeded(seed) for seed in by_seed]
    hashes += [_whole_runs(w, n) for n in runs]
    passed = [F.filter(h, lambda x: seen.may_hold(x["hash"])) for h in hashes]
    hits = words.select("doc_id", F.explode(F.concat(*passed, none)).alias("h")).select("doc_id", "h.pos", "h.hash")
    near = hits.join(item_hits, "hash").select("doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    near = stored(near, "hits")

    # Lay the item over the document's words at every shift and count what agrees.
    hit = docs.join(near.select("doc_id").distinct(), "doc_id", "left_semi")
    laid = near.join(items, "item_id").join(hit.select("doc_id", bare_words(F.col("text")).alias("words")), "doc_id")
    first = F.greatest(F.lit(0), F.col("shift"))
    window = F.slice("words", first + 1, F.size("item") + F.least(F.lit(0), F.col("shift")))
    skipped = F.greatest(F.lit(0), -F.col("shift"))
    other = F.slice("item", skipped + 1, F.size("item"))
    agree = F.zip_with(window, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    counted = laid.filter(F.col("shift") < F.size("words")).filter(F.size("item") + F.col("shift") > 0).select(
        "doc_id", "item_id", "shift", F.size("item").alias("n_words"), skipped.alias("skipped"), agree.alias("agree")
    )
    equal = lambda places: F.size(F.filter(places, lambda x: x))
    counted = stored(counted.withColumn("matched", equal(F.col("agree"))), "laid")
    least = math.ceil(overlap * WINDOW)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("agree") - WINDOW + 1))
    dense = (F.col("n_words") >= WINDOW) & (F.col("matched") >= least)
    dense = F.when(dense, F.exists(starts, lambda i: equal(F.slice("agree", i, WINDOW)) >= least)).otherwise(F.lit(False))
    best = counted.groupBy("doc_id", "item_id", "n_words").agg(F.max("matched").alias("matched"), F.max(dense).alias("dense"), F.count("*").alias("shifts"))
    best = stored(best.withColumn("enough", (F.col("matched") >= F.ceil(overlap * F.col("n_words"))) | F.col("dense")), "best")

    # Of the others, what shifts near each other cover together; any two within half an item share a neighbourhood.
    open_ = best.filter("not enough and shifts > 1").select("doc_id", "item_id")
    near_by = F.explode(F.array(F.floor(F.col("shift") / F.col("n_words")) * 2, F.floor(F.col("shift") / F.col("n_words") + 0.5) * 2 + 1)).alias("around")
    parts = counted.join(open_, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "n_words", "skipped", "agree", near_by)
    places = F.explode(F.filter(F.transform("agree", lambda x, i: F.when(x, i + F.col("skipped"))), lambda x: x.isNotNull())).alias("place")
    covered = parts.select("doc_id", "item_id", "n_words", "around", places).distinct().groupBy("doc_id", "item_id", "n_words", "around").count()
    joined = covered.filter(F.col("count") >= F.ceil(overlap * F.col("n_words"))).select("doc_id", "item_id").distinct()
    found = best.filter("enough").select("doc_id", "item_id").unionAll(joined)
    return best.join(found, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "matched", "n_words")
