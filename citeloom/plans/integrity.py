"""Referential integrity of a load: rows whose foreign key has no parent go to quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.operators.facts import orphans
from citeloom.schemas import QUARANTINE_ORPHANS
from citeloom.session import written

#: table -> (its foreign key, the table it points to, that table's key). Parents come before their children.
REFERENCES: dict[str, Sequence[tuple[str, str, str]]] = {
    "journal_quartile": (("id_journal", "dim_journal", "journal_id"),),
    "fact_publication": (("journal_id", "dim_journal", "journal_id"),),
    "publication_author": (("publication_id", "fact_publication", "publication_id"),
                           ("author_id", "dim_author", "author_id")),
}

#: Rows that one task of a large key comparison receives, of all its tables together.
ROWS_PER_TASK = 500_000


def _dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt out by ``key`` in as many parts as a comparison of so many rows takes; the other side
    of a join follows. (Left to AQE, a part grows with the tables: its size is that of the compressed
    shuffle, which says little of the memory that the sorts of the rows take.)"""
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, F.col(key)) if parts > 1 else df


def unknown_keys(child: DataFrame, key: str, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """The child's distinct foreign keys that none of the parent tables has, as ``key``.

    Only the keys travel. The parents are asked in the given order (the rows of the load itself
    first): a later one is asked for what is left, and not read at all when nothing is left. What is
    left is written after each parent, so a task sorts the rows of two tables at most.
    """
    left, rows = child.select(F.col(key)).where(F.col(key).isNotNull()), child.count()
    for place, (parent, parent_key) in enumerate(parents):
        left = _dealt(left, key, rows + parent.count())
        left = written("unknown-keys", orphans(left if place else left.distinct(), key, parent, parent_key))
        rows = left.count()
        if not rows:
            return left
    return left if parents else written("unknown-keys", left.distinct())


def split_orphans(added: Mapping[str, DataFrame], current: Mapping[str, DataFrame],
                  references: Mapping[str, Sequence[tuple[str, str, str]]] = REFERENCES
                  ) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the rows a load adds without its orphans, the orphans as ``QUARANTINE_ORPHANS`` rows).

    A parent is a row that the load adds and keeps, or a row of the tables before the load: a bridge
    row that points to an orphaned publication is an orphan itself. An orphan is listed once for
    each of its keys that has no parent; rows with a null key are none. The unknown keys are computed
    here, once; tables without any are passed on as they came.
    """
    kept = dict(added)
    found = []
    for name, keys in references.items():
        if name not in kept:
            continue
        rows = kept[name]
        for key, parent, parent_key in keys:
            parents = [(t[parent], parent_key) for t in (kept, current) if parent in t]
            missing = unknown_keys(added[name], key, parents).select(F.col(key).alias("__missing"))
            unknown = missing.count()
            if not unknown:
                continue
            # Few keys are broadcast, by the size of their table.
            missing = _dealt(missing, "__missing", unknown + added[name].count())
            bad = added[name].join(missing, F.col(key) == F.col("__missing"), "left_semi")
            found.append(bad.select(
                F.lit(name).alias("table_name"), F.lit(key).alias("foreign_key"), F.col(key).cast("string").alias("key_value"),
                F.lit(f"no_row_in_{parent}").alias("reject_reason")))
            rows = rows.join(missing, rows[key] == missing["__missing"], "left_anti")
        kept[name] = rows
    if not found:
        return kept, next(iter(added.values())).sparkSession.createDataFrame([], QUARANTINE_ORPHANS)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return kept, out
