"""Table modification as snapshot jobs.

Parquet tables take no UPDATE, DELETE or MERGE, so every job is a function from
the current snapshot and a set of changes to new DataFrames. The caller writes
them with ``ledgerline.sources.sinks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lookup import absent, only_value, resolve_key, thin
from ledgerline.operators.ordering import first_per_key
from ledgerline.operators.windows import number_rows
from ledgerline.session import cut_lineage


def next_key_base(table: DataFrame, key: str) -> Column:
    """``COALESCE(MAX(key), 0)`` as a scalar subquery."""
    return only_value(table.agg(F.coalesce(F.max(key), F.lit(0)).alias(key)), key)


def assign_keys(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    order_by: Sequence[Column],
    buckets: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Give ``rows`` the keys after the largest one in ``table``, in an order that is unique."""
    return number_rows(rows, order_by, buckets, key, next_key_base(table, key), unique_order=True)


def id_buckets(column: str, chunk: int) -> dict[str, Column]:
    """Buckets along an id in two levels, so that ids with wide gaps do not make one list of all buckets."""
    c = F.col(column)
    return {"__b0": F.floor(c / F.lit(chunk * chunk)), "__b": F.floor(c / F.lit(chunk))}


def assign_unordered_keys(
    rows: DataFrame, table: DataFrame, key: str, natural: Sequence[str], spread: int = 65536
) -> DataFrame:
    """Dense keys where their order does not matter: numbered within hash buckets of a unique natural key."""
    hashed = F.pmod(F.xxhash64(*natural), F.lit(spread))
    order = [F.col(c).asc_nulls_last() for c in natural]
    return assign_keys(rows, table, key, order, {"__bucket": hashed})


def insert_absent(
    table: DataFrame, batch: DataFrame, natural: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """The rows to append: first of each natural key in the batch, unless the table has the key.

    A key with a NULL equals no other, so every such row is new, as a unique constraint has it.
    """
    chosen = order or [F.col(c).asc_nulls_last() for c in batch.columns]
    whole = F.lit(True)
    for c in natural:
        whole = whole & F.col(c).isNotNull()
    first = first_per_key(batch.filter(whole), natural, chosen)
    return absent(first, table, natural).unionByName(batch.filter(~whole))


def insert_absent_child(
    table: DataFrame,
    batch: DataFrame,
    parent: DataFrame,
    parent_on: Mapping[str, str],
    parent_key: str,
    foreign_key: str,
    natural: Sequence[str],
) -> DataFrame:
    """As ``insert_absent``, with the parent's key found by its natural key; an unknown parent adds nothing."""
    resolved = resolve_key(batch, parent, parent_on, parent_key, foreign_key).filter(F.col(foreign_key).isNotNull())
    return insert_absent(table, resolved.drop(*parent_on), [*natural, foreign_key])


def bridge_rows(
    pairs: DataFrame,
    left: DataFrame,
    left_on: Mapping[str, str],
    left_key: str,
    right: DataFrame,
    right_on: Mapping[str, str],
    right_key: str,
    existing: DataFrame,
) -> DataFrame:
    """Bridge rows for pairs of natural keys. A name that several rows carry links all of them,
    one that matches nothing links none, and a link that exists already is left out.

    The pairs are the driving side: each name is an equi-join, never every left
    row against every right row.
    """

    def side(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], key: str) -> DataFrame:
        names = dimension.select(*[F.col(d).alias(f) for f, d in on.items()], key)
        return df.join(names, list(on), "inner")

    distinct = pairs.select(*left_on, *right_on).distinct()
    linked = side(side(distinct, left, left_on, left_key), right, right_on, right_key)
    return absent(linked.select(left_key, right_key).distinct(), existing, [left_key, right_key])


def missing_pairs(
    items: DataFrame,
    item_key: str,
    item_name: str,
    names: Sequence[str],
    places: DataFrame,
    place_key: str,
    existing: DataFrame,
    spread: int = 16,
) -> DataFrame:
    """Every named item at every place where it is not kept yet.

    The names are a short parameter list, so each place row carries it as an array
    and the items join by name. The output is the wanted set of pairs; no other
    pair is formed. As there are few names, each is spread over ``spread`` salts.
    """
    wanted = places.select(
        place_key,
        F.pmod(F.xxhash64(place_key), F.lit(spread)).alias("__salt"),
        F.explode(F.array(*[F.lit(n) for n in dict.fromkeys(names)])).alias(item_name),
    )
    chosen = items.filter(F.col(item_name).isin(list(names))).select(
        item_name, item_key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("__salt")
    )
    pairs = wanted.join(chosen, [item_name, "__salt"], "inner").select(item_key, place_key)
    return absent(pairs, existing, [item_key, place_key])


def upsert(
    table: DataFrame, changes: DataFrame, key: Sequence[str], update: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """New snapshot after ``INSERT .. ON CONFLICT (key) DO UPDATE SET update = EXCLUDED.update``.

    A matched row takes the new value even where that is NULL; columns outside
    ``update`` keep the old one. With ``order`` the first change per key counts; without it a key that
    changes twice is an error, as the statement would refuse to touch a row a second time.
    """
    unique = first_per_key(changes, key, order) if order else _once(changes, key, "a key is changed twice; name an order")
    new = unique.select(*key, F.struct(*[c for c in changes.columns if c not in key]).alias("__new"))
    old = table.select(*key, F.struct(*[c for c in table.columns if c not in key]).alias("__old"))
    joined = old.join(new, list(key), "full")
    columns: list[Column] = [F.col(k) for k in key]
    for c in table.columns:
        if c in key:
            continue
        before = F.col(f"__old.{c}")
        after = F.col(f"__new.{c}") if c in changes.columns else F.lit(None)
        take_new = F.col("__new").isNotNull() if c in update else F.col("__old").isNull()
        columns.append(F.when(take_new, after).otherwise(before).alias(c))
    return joined.select(*columns).select(*table.columns)


def _once(rows: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """``rows``, with an error as soon as a key without NULLs repeats."""
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    others = [c for c in rows.columns if c not in key]
    grouped = rows.filter(whole).groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*others) if others else F.lit(1)).alias("__row")
    )
    one = F.when(F.col("__n") > 1, F.raise_error(F.lit(text)).cast("boolean")).otherwise(F.lit(True))
    single = grouped.filter(one).select(*key, *[F.col(f"__row.{c}").alias(c) for c in others])
    return single.select(*rows.columns).unionByName(rows.filter(~whole))


def update_where_key(table: DataFrame, keys: DataFrame, key: str, assignments: Mapping[str, Column]) -> DataFrame:
    """New snapshot with ``assignments`` applied to rows whose key is in ``keys``."""
    flagged = table.join(thin(keys.select(key), [key]).withColumn("__hit", F.lit(True)), key, "left")
    changed = flagged.withColumns(
        {c: F.when(F.col("__hit"), new).otherwise(F.col(c)) for c, new in assignments.items()}
    )
    return changed.select(*table.columns)


def fill_nulls(table: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """``UPDATE .. SET c = default WHERE c IS NULL``."""
    return table.withColumns({c: F.coalesce(F.col(c), value) for c, value in defaults.items()})


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay: those for which the condition is false or unknown."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def delete_keys(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that stay after deleting those whose key is listed; a NULL key stays."""
    return absent(table, keys, on)


@dataclass(frozen=True)
class Reference:
    """A foreign key with ON DELETE CASCADE."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def parent_first(references: Sequence[Reference]) -> list[str]:
    """Tables in an order in which every parent precedes its children."""
    names = list(dict.fromkeys([r.parent for r in references] + [r.child for r in references]))
    done: list[str] = []
    while len(done) < len(names):
        ready = [
            n for n in names if n not in done and all(r.parent in done or r.parent == n for r in references if r.child == n)
        ]
        if not ready:
            raise ValueError("the foreign keys form a cycle")
        done.extend(ready)
    return done


def cascade_delete(
    tables: Mapping[str, DataFrame], references: Sequence[Reference], start: str, doomed: DataFrame, materialise: bool = False
) -> dict[str, DataFrame]:
    """New snapshots of all tables after deleting the rows of ``start`` that match ``doomed``.

    ``doomed`` holds key columns of ``start``. Tables go parent first; a child row
    goes when any of its parents went. Only the key columns that children refer to
    travel down. In a deep graph several children share a parent's key set: with
    ``materialise`` each such set is written to the checkpoint folder once.
    """
    order = parent_first(references)
    deleted: dict[str, DataFrame] = {}
    for name in order:
        if name not in tables:
            continue
        hits: list[DataFrame] = []
        table = tables[name]
        incoming = [r for r in references if r.child == name and r.parent in deleted]
        outgoing = [r for r in references if r.parent == name]
        needed = list(dict.fromkeys(c for r in outgoing for c in r.parent_columns))
        if not needed:
            continue
        if name == start:
            hits.append(table.join(doomed, doomed.columns, "left_semi").select(*needed))
        for r in incoming:
            hits.append(table.join(_as_child(deleted[r.parent], r), list(r.columns), "left_semi").select(*needed))
        if hits:
            keys = hits[0]
            for more in hits[1:]:
                keys = keys.unionByName(more)
            keys = keys.distinct()
            deleted[name] = cut_lineage(keys) if materialise else keys

    result: dict[str, DataFrame] = {}
    for name, table in tables.items():
        kept = absent(table, doomed, doomed.columns) if name == start else table
        for r in references:
            if r.child == name and r.parent in deleted:
                kept = absent(kept, _as_child(deleted[r.parent], r), list(r.columns), unique=True)
        result[name] = kept.select(*table.columns)
    return result


def cascade_truncate(
    tables: Mapping[str, DataFrame], references: Sequence[Reference], start: Sequence[str]
) -> dict[str, DataFrame]:
    """``TRUNCATE .. CASCADE``: the start tables and every table below them become empty, the rest stay.

    Unlike a cascading delete this asks for no row: a table that refers to an emptied one is emptied.
    """
    emptied = set(start)
    for name in parent_first(references):
        if any(r.child == name and r.parent in emptied for r in references):
            emptied.add(name)
    return {name: truncated(table) if name in emptied else table for name, table in tables.items()}


def _as_child(keys: DataFrame, reference: Reference) -> DataFrame:
    pairs = zip(reference.parent_columns, reference.columns)
    return thin(keys.select(*[F.col(p).alias(c) for p, c in pairs]), reference.columns)


def add_column(table: DataFrame, name: str, default: Column) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS .. DEFAULT``: existing rows get the default, an existing column only its gaps."""
    return table.withColumn(name, F.coalesce(F.col(name), default) if name in table.columns else default)


def with_defaults(batch: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add columns the batch does not carry; a NULL given explicitly stays NULL."""
    return batch.withColumns({c: value for c, value in defaults.items() if c not in batch.columns})


def truncated(table: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return table.limit(0)
