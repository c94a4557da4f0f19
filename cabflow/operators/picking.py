"""One row per key.

Each operator is a single aggregate over a struct that starts with the ordering
columns and goes on with all other columns.  Spark compares structs field by field,
NULL lowest, so ``max`` is "newest, NULL times last" and ``min`` is "oldest, NULL times
first"; rows that tie on the time are told apart by their content, never by their
position.  The partial aggregate keeps one row per key and task, so a key that holds
a large part of the table costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> Column:
    """Struct of the order, then of every column that is not a key."""
    lead = [_col(c).alias(f"_order{i}") for i, c in enumerate(order)]
    rest = [F.col(c) for c in df.columns if c not in keys]
    return F.struct(*lead, *rest)


def _unfold(picked: DataFrame, df: DataFrame) -> DataFrame:
    keys = [c for c in picked.columns if c != "_row"]
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """The row with the highest order per key."""
    row = F.max(ranked(df, keys, order)).alias("_row")
    return _unfold(df.groupBy(*keys).agg(row), df)


def earliest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    where: Column | None = None,
) -> DataFrame:
    """The row with the lowest order per key, among the rows that satisfy ``where``."""
    if where is not None:
        df = df.where(where)
    row = F.min(ranked(df, keys, order)).alias("_row")
    return _unfold(df.groupBy(*keys).agg(row), df)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where any would do; always the same one."""
    return earliest_per_key(df, keys, [])


def distinct_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct value of several columns, such as id and version."""
    return any_per_key(df, columns)


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def compact_changes(df: DataFrame, key: str, ts: str, op: str) -> DataFrame:
    """Last state of every id in a change log.

    Lines without an id are dropped first; an id goes if its last change deletes it or
    does not say what it is.
    """
    last = latest_per_key(df.where(F.col(key).isNotNull()), [key], [ts])
    return last.where(F.col(op) != "DELETE")


class Snapshot:
    """One row of a group, chosen by ``order``, of which some columns are kept."""

    def __init__(
        self,
        columns: dict[str, ColumnLike],
        order: Sequence[ColumnLike],
        newest: bool,
        where: Column | None = None,
    ):
        self.columns, self.order, self.newest, self.where = columns, order, newest, where

    def pick(self, alias: str, tiebreak: Sequence[ColumnLike]) -> Column:
        lead = [_col(c).alias(f"_order{i}") for i, c in enumerate([*self.order, *tiebreak])]
        kept = [_col(c).alias(name) for name, c in self.columns.items()]
        row = F.struct(*lead, *kept)
        if self.where is not None:
            # A row that does not qualify becomes NULL, which max and min skip.
            row = F.when(self.where, row)
        return (F.max(row) if self.newest else F.min(row)).alias(alias)


def snapshots(
    df: DataFrame,
    keys: Sequence[str],
    specs: Sequence[Snapshot],
    totals: Sequence[Column] = (),
    tiebreak: Sequence[ColumnLike] = (),
) -> DataFrame:
    """Several chosen rows and totals per group from one pass over the data."""
    picks = [spec.pick(f"_pick{i}", tiebreak) for i, spec in enumerate(specs)]
    grouped = df.groupBy(*keys).agg(*picks, *totals)
    out = [F.col(key) for key in keys]
    for i, spec in enumerate(specs):
        out += [F.col(f"_pick{i}.`{name}`").alias(name) for name in spec.columns]
    hidden = {f"_pick{i}" for i in range(len(specs))} | set(keys)
    return grouped.select(*out, *[c for c in grouped.columns if c not in hidden])
