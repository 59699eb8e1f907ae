"""Mixing sources to target weights by exponential keys, in native column expressions only.

Targets: every source has a weight; together they share ``share`` times the words of the corpus. A source's
target stops at ``most`` times its words and what is left over goes to the others by weight, until none is
above. With sources in order of the multiple of their weight at which they stop, the level of all
others follows from running sums, so no iteration is needed.

Selection (Efraimidis-Spirakis): each document draws an exponential key, ``-ln(u) / quality``. A source takes
all its documents for every whole time its words fit the target (complete epochs), then documents in
ascending order of key until the rest of the target is used up. The document that meets the end
gives its first words only, so the words of a source equal the whole words of its target.

The running sum over a source is made in levels: words are summed per source and slice of the key's
range, the slice in which the target ends is cut into slices again, and only the documents of the
last slice are put in order. A source with a third of all rows is never sorted in one task, as its
documents are spread over ``SLICES ** LEVELS`` slices.

Defined cases: a missing text has no words; a document without words takes none. Sources are ordered by
code point, a missing source last, each weighed like any other. Keys are drawn from id and text, so a rerun
gives the same result; equal rows stand next to each other in the order. A missing id is a value like any
other. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orewright.llm.base import GAP, WORD, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SLICES = 256
LEVELS = 3


def word_count(text: Column) -> Column:
    """Number of words between gaps; the text between gaps at both ends has one word more than gaps."""
    words = F.size(F.split(text, GAP)) - F.when(text.rlike(rf"\A{GAP}"), 1).otherwise(0)
    words = words - F.when(text.rlike(rf"{GAP}\z"), 1).otherwise(0)
    empty = text.isNull() | (F.length(text) == 0) | text.rlike(rf"\A{GAP}\z")
    return F.when(empty, 0).otherwise(words).cast("long")


def text_quality(text: Column) -> Column:
    """Between 0.1 and 1: less the more marks of tables, markup and noise a text has."""
    marks = F.length(F.regexp_replace(text, r"[^|*#$%&!~^_=<>{}\[\]\\]+", ""))
    return F.greatest(F.lit(0.1), 1 - 4.0 * F.coalesce(F.try_divide(marks, F.length(text)), F.lit(0.0)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """source, source_size, target from (source, source_size), a row for each source."""
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumn("stop", F.col("cap") / F.col("weight"))
    stops = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    from_here = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn(
        "level",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(from_here),
    )
    # The level of the first source that does not stop holds for all behind it.
    level = F.min(F.when(F.col("stop") >= F.col("level"), F.struct("stop", "level"))).over(everything)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def mixed_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17) -> DataFrame:
    """A row for each document: ``doc`` with all its columns, and size, source_size, target, epochs (whole
    copies), more (words of the last copy) and taken (words taken, repeats counted)."""
    text = F.col("doc.text").cast("string")
    drawn = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col("doc.source").cast("string").alias("source"), word_count(text).alias("size"),
        F.xxhash64(F.lit(seed), "doc.doc_id", text).alias("draw"), text_quality(text).alias("quality"),
    )
    u = (F.shiftrightunsigned("draw", 11).cast("double") + 0.5) / float(1 << 53)
    # An exponential key -ln(u) / quality has its place in (0, 1) at key / (1 + key): in order, below 1 for the largest
    # key (375, as u is at least 2**-54 and quality 0.1), and nowhere more than some seven times as dense as evenly spread.
    key = -F.log(u) / F.col("quality")
    drawn = drawn.withColumn("place", key / (1 + key)).drop("quality")
    rows = stored(drawn.select("source", "size", "place"), "sizes")

    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    )
    targets = stored(
        targets.withColumn("rest", F.floor(F.col("target")) - F.col("epochs") * F.col("source_size")), "targets"
    )

    # Level by level: the slice of each source in which the rest of the target ends, and the words before it.
    def slice_at(level: int) -> Column:
        return F.floor(F.col("place") * float(SLICES**level)).cast("long")

    ends = targets.select(F.col("source").alias("of"), F.lit(0).cast("long").alias("prefix"), "rest")
    for level in range(1, LEVELS + 1):
        inside = rows.join(ends, F.col("source").eqNullSafe(F.col("of")) & (slice_at(level - 1) == F.col("prefix")))
        sums = inside.groupBy("of", slice_at(level).alias("slice")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        running = F.sum("words").over(Window.partitionBy("of").orderBy("slice"))
        sums = sums.withColumn("upto", running).filter("upto >= rest")
        ends = sums.groupBy("of").agg(F.min(F.struct("slice", "upto", "words", "rest")).alias("e")).select(
            "of", F.col("e.slice").alias("prefix"), (F.col("e.rest") - F.col("e.upto") + F.col("e.words")).alias("rest")
        )
        ends = stored(ends, "ends")

    # A source whose words end before the rest of its target does gives them all.
    found = targets.drop("rest").join(ends, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("of", F.col("source")).drop("source")
    found = found.withColumn("prefix", F.coalesce("prefix", F.lit(SLICES**LEVELS)))
    drawn = drawn.join(found, F.col("source").eqNullSafe(F.col("of"))).withColumn("here", slice_at(LEVELS))
    last = drawn.filter("here = prefix")
    order = Window.partitionBy("of").orderBy("place", "draw").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    last = last.withColumn("more", F.least("size", F.greatest(F.lit(0), F.col("rest") - before)))
    others = drawn.filter("here <> prefix").withColumn("more", F.when(F.col("here") < F.col("prefix"), F.col("size")).otherwise(0))
    taken = (F.col("epochs") * F.col("size") + F.col("more")).cast("long")
    return last.unionByName(others).select("doc", "size", "source_size", "target", "epochs", "more", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them: a row for each copy, the last one cut behind the last word it gives.

    Columns are those of the documents; ``n_chars``, where there is one, follows a cut text.
    """
    mixed = mixed_sources(docs, **settings).filter("taken > 0")
    copies = F.sequence(F.lit(1).cast("long"), F.col("epochs") + F.when(F.col("more") > 0, 1).otherwise(0))
    copied = mixed.select("doc", "size", "epochs", "more", F.explode(copies).alias("copy"))
    cut = (F.col("copy") > F.col("epochs")) & (F.col("more") < F.col("size"))
    # Possessive, so that a long text needs no stack.
    pattern = F.concat(F.lit(rf"\A(?:(?:{GAP}+)?+{WORD}+){{"), F.col("more").cast("string"), F.lit("}+"))
    text = F.when(cut, F.call_function("regexp_extract", F.col("doc.text"), pattern, F.lit(0))).otherwise(F.col("doc.text"))
    changed = {"text": text, "n_chars": F.when(cut, F.length(text)).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    out = [(changed.get(c) if changed.get(c) is not None else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    return copied.select(*out)
