"""Data-quality checks: each returns the violating rows, so empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.operators import ledger
from orewright.operators.grains import fk_orphans


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count; NULL keys are left to ``not_null``."""
    present = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    counted = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


unique = duplicates


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return fk_orphans(child, parent, column, field)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count; NULL passes."""
    strange = df.filter(~F.col(column).isin(*values))
    return strange.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def je_balanced(lines: DataFrame, tolerance: str = "0.05") -> DataFrame:
    limit = F.lit(tolerance).cast("decimal(18,2)")
    return ledger.je_totals(lines).filter(F.col("imbalance") > limit)


def trial_balance_nets_to_zero(trial_balance: DataFrame, tolerance: str = "0.10") -> DataFrame:
    limit = F.lit(tolerance).cast("decimal(18,2)")
    return ledger.period_totals(trial_balance).filter(F.col("period_imbalance") > limit)


def no_postings_to_closed_periods(
    gl: DataFrame, periods: DataFrame, enforce: bool = False
) -> DataFrame:
    """Informational unless enforced: by default it never reports a row."""
    found = ledger.closed_period_postings(gl, periods)
    return found if enforce else found.filter(F.lit(False))


def entry_amounts(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """Entries with what they debit in total; lines shrink to an entry's sum before they meet the headers."""
    totals = lines.groupBy("journal_entry_id").agg(F.sum("debit_amount").alias("amount"))
    return entries.join(totals, "journal_entry_id").select("journal_entry_id", "amount", "description", "created_at")


def suspected_duplicates(
    entries: DataFrame, minutes: int = 10, amount: str = "amount", text: str = "description",
    clock: str = "created_at", entry: str = "journal_entry_id",
) -> DataFrame:
    """Entries with the same amount and text as another one at most ``minutes`` away.

    Time is cut into slots as long as the tolerance. Two entries of one slot are always
    close enough; otherwise the only candidates are the last entry of the slot before and
    the first of the slot after. So per amount, text and slot the count, the first and the
    last time decide: three aggregates, joined back on equality. No group is ordered or
    paired with itself, however many copies it holds.
    """
    reach = minutes * 60 * 1_000_000
    keys = (amount, text)
    at = entries.select(entry, *keys, clock).filter(
        F.col(amount).isNotNull() & F.col(text).isNotNull() & F.col(clock).isNotNull()
    ).withColumn("_us", F.unix_micros(F.col(clock).cast("timestamp")))
    slotted = at.withColumn("_slot", F.floor(F.col("_us") / reach).cast("long"))
    slots = slotted.groupBy(*keys, "_slot").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_first"), F.max("_us").alias("_last")
    )

    def next_to(shift: int, edge: str, name: str) -> DataFrame:
        return slots.select(*keys, (F.col("_slot") + shift).alias("_slot"), F.col(edge).alias(name))

    near = (
        slots.join(next_to(1, "_last", "_before"), [*keys, "_slot"], "left")
        .join(next_to(-1, "_first", "_after"), [*keys, "_slot"], "left")
        # Slots with one entry and no neighbour slot cannot hold a hit.
        .filter((F.col("_n") > 1) | F.col("_before").isNotNull() | F.col("_after").isNotNull())
        .select(*keys, "_slot", "_n", "_before", "_after")
    )
    hit = (
        (F.col("_n") > 1)
        | (F.col("_us") - F.col("_before") <= reach)
        | (F.col("_after") - F.col("_us") <= reach)
    )
    return slotted.join(near, [*keys, "_slot"]).filter(hit).select(entry, *keys, clock)


def check_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with the number of violating rows."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def _counted(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Rows failing each named test, all counted in one pass over the frame."""
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("check_name"), F.count_if(test).alias("violations"))
                for name, test in tests.items()
            ]
        ).alias("_c")
    )
    return counts.select(F.inline("_c"))


def null_counts(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """``not_null`` for several columns of one table, name -> column."""
    return _counted(df, {name: F.col(column).isNull() for name, column in checks.items()})


def key_counts(df: DataFrame, column: str, names: Mapping[str, str], also: Mapping[str, Column] | None = None) -> DataFrame:
    """``unique`` and ``not_null`` of a key in one pass: rows shrink to one for each key, which both are counted from.

    ``names`` has the name of the check for ``unique`` and, where asked for, ``not_null``; ``also`` has further
    tests of rows, which are added up on the way.
    """
    also = dict(also or {})
    per_key = df.groupBy(F.col(column).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(test).alias(f"_{i}") for i, test in enumerate(also.values())]
    )
    known = F.col("_key").isNotNull()
    found = {names["unique"]: F.count_if(known & (F.col("_n") > 1))}
    if "not_null" in names:
        found[names["not_null"]] = F.sum(F.when(known, 0).otherwise(F.col("_n")))
    found |= {name: F.sum(f"_{i}") for i, name in enumerate(also)}
    counts = per_key.agg(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.coalesce(n, F.lit(0)).cast("long").alias("violations")) for name, n in found.items()
    ]).alias("_c"))
    return counts.select(F.inline("_c"))


def orphan_counts(
    child: DataFrame, checks: Mapping[str, tuple[str, DataFrame]], also: Mapping[str, Column] | None = None
) -> DataFrame:
    """``relationships`` for several keys of one table, name -> (column, parent), and further tests of its rows, in one pass.

    The parent has the column too. Each parent is reduced to its distinct keys, so the left
    joins keep the child's rows as they are.
    """
    held, tests = child, dict(also or {})
    for i, (name, (column, parent)) in enumerate(checks.items()):
        keys = parent.select(F.col(column).alias(f"_k{i}")).distinct()
        held = held.join(keys, F.col(column) == F.col(f"_k{i}"), "left")
        tests[name] = F.col(column).isNotNull() & F.col(f"_k{i}").isNull()
    return _counted(held, tests)


# The kinds an account may have.
ACCOUNT_TYPES = ("Asset", "Liability", "Equity", "Revenue", "Expense")

# The declared column checks, layer -> table -> columns (parents have the column as well).
REQUIRED = {
    "raw": {"entries": ["journal_entry_id"], "lines": ["journal_entry_id"]},
    "stg": {
        "entries": ["journal_entry_id"],
        "lines": ["journal_entry_id", "account_id", "cost_center_id"],
        "accounts": ["account_id"],
        "centers": ["cost_center_id"],
        "periods": ["fiscal_period_id"],
    },
    "marts": {
        "accounts": ["account_key", "account_id"],
        "centers": ["cost_center_key"],
        "periods": ["fiscal_period_key"],
        "fact": ["account_key", "cost_center_key", "fiscal_period_key"],
    },
}
DISTINCT = {
    "raw": {"entries": ["journal_entry_id"]},
    "stg": {
        "entries": ["journal_entry_id"],
        "accounts": ["account_id"],
        "centers": ["cost_center_id"],
        "periods": ["fiscal_period_id"],
    },
    "marts": {
        "accounts": ["account_key", "account_id"],
        "centers": ["cost_center_key"],
        "periods": ["fiscal_period_key"],
    },
}
LINKS = {
    "stg": {
        "lines": {"journal_entry_id": "entries", "account_id": "accounts", "cost_center_id": "centers"}
    },
    "marts": {
        "fact": {"account_key": "accounts", "cost_center_key": "centers", "fiscal_period_key": "periods"}
    },
}


def ledger_check_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Violations of the 32 declared checks: a table is read once for each key that must be unique, or once in all.

    What else is asked of its rows is counted in the same pass.
    """
    parts = []
    for layer, tables in layers.items():
        for table, df in tables.items():
            required, unique_ones = (kind.get(layer, {}).get(table, []) for kind in (REQUIRED, DISTINCT))
            rest = {f"not_null {layer}.{table}.{c}": F.col(c).isNull() for c in required if c not in unique_ones}
            if parents := LINKS.get(layer, {}).get(table):
                names = {f"relationships {layer}.{table}.{c}": (c, layers[layer][parent]) for c, parent in parents.items()}
                parts.append(orphan_counts(df, names, rest))
                rest = {}
            for i, c in enumerate(unique_ones):
                names = {"unique": f"unique {layer}.{table}.{c}"}
                if c in required:
                    names["not_null"] = f"not_null {layer}.{table}.{c}"
                parts.append(key_counts(df, c, names, rest if i == 0 else None))
            if rest and not unique_ones:
                parts.append(_counted(df, rest))
    strange = accepted_values(layers["stg"]["accounts"], "account_type", ACCOUNT_TYPES)
    parts.append(check_summary({"accepted_values stg.accounts.account_type": strange}))
    return reduce(DataFrame.unionByName, parts)
