"""Joins: dimension lookups, shifted-key joins and cardinality contracts.

No join carries a broadcast hint: the planner broadcasts a side whose estimated
size is below ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution
does so at run time when a shuffled side turns out to be that small. The m:1
contract of a lookup is part of the plan: a key that occurs twice on the
dimension side raises when the join runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from hourgrid.functions.scalar import shift_time

__all__ = [
    "DuplicateKeyError",
    "duplicate_keys",
    "check_unique",
    "unique_rows",
    "lookup_join",
    "prefix_columns",
    "shifted_lookup",
    "multi_shift_lookup",
    "with_scalars",
]

class DuplicateKeyError(ValueError):
    """Raised when a join side violates its declared uniqueness."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity.

    One partial/final hash aggregate: map-side combine keeps the shuffle at
    one row per distinct key per partition, even for a hot key.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    """Raise :class:`DuplicateKeyError` if ``keys`` are not unique in ``df``.

    Costs one aggregation job; the offending keys (at most 5) are reported.
    """
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise DuplicateKeyError(f"{name}: keys {list(keys)} not unique, e.g. {[r.asDict() for r in bad]}")
    return df


def unique_rows(df: DataFrame, keys: Sequence[str], name: str = "dimension", keep_null_keys: bool = True) -> DataFrame:
    """``df`` with one row per key; a key of several rows raises when it is computed.

    The check is an aggregate inside the plan: no job runs before the query. Each column is aggregated
    on its own, so fixed-width columns stay in a hash aggregate. Rows whose key has a NULL never match a
    join: they are not checked, and are kept as they are or, with ``keep_null_keys=False``, left out.
    """
    others = [c for c in df.columns if c not in keys]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    once = df.filter(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in others])
    error = F.raise_error(F.concat(F.lit(f"{name}: keys {list(keys)} not unique: "), F.to_json(F.struct(*keys))))
    # the filter keeps the check in the plan even if no other column is used
    checked = once.filter(F.when(F.col("_rows") > 1, error.cast("int")).otherwise(F.lit(0)) == 0).select(*df.columns)
    return checked.unionByName(df.filter(~whole)) if keep_null_keys else checked


def prefix_columns(df: DataFrame, prefix: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Prefix every column except ``exclude``."""
    return df.select(*[F.col(c) if c in exclude else F.col(c).alias(prefix + c) for c in df.columns])


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | dict[str, str],
    how: str = "left",
    validate: bool | str = True,
    name: str = "dimension",
) -> DataFrame:
    """Many-to-one join of a fact to a dimension.

    ``on`` is a list of shared key names or a mapping fact column → dim column
    (dimension key columns are dropped from the output). ``validate`` is the
    join-cardinality contract (J11): ``True``/``"m:1"`` requires unique
    dimension keys (checked inside the plan), ``"1:m"`` unique fact keys,
    ``"1:1"`` both; ``False`` allows any.
    """
    if isinstance(on, dict):
        fact_keys, dim_keys = list(on.keys()), list(on.values())
    else:
        fact_keys = dim_keys = list(on)
    contract = "m:1" if validate is True else (validate or "")
    if contract not in ("", "m:1", "1:m", "1:1"):
        raise ValueError(f"unknown join contract {validate!r}")
    if contract in ("m:1", "1:1"):
        # unmatched dimension rows come out of right and full joins only
        dim = unique_rows(dim, dim_keys, name, keep_null_keys=how not in ("left", "inner", "left_outer", "leftouter"))
    if contract in ("1:m", "1:1"):
        check_unique(fact, fact_keys, "fact")
    if isinstance(on, dict):
        cond = [fact[f] == dim[d] for f, d in on.items()]
        out = fact.join(dim, cond, how)
        return out.drop(*[dim[d] for d in on.values()])
    return fact.join(dim, list(on), how)


def shifted_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    prefix: str,
    shift: dict[str, str | Column] | None = None,
    drop: Sequence[str] = (),
    how: str = "left",
    validate: bool = False,
) -> DataFrame:
    """Join a dimension whose key columns are first shifted.

    ``shift`` maps a dimension column to either a duration string (added to a
    timestamp, e.g. ``{"datetime": "2d"}``) or a replacement Column expression
    evaluated on the *unshifted* dimension row. The dimension is prefixed with
    ``prefix``; its key columns and ``drop`` columns are removed after the
    join, so only its measures are added to the fact.
    """
    shift = shift or {}
    exprs = {}
    for c, s in shift.items():
        exprs[c] = shift_time(c, s) if isinstance(s, str) else s
    # All shifted expressions read the original row: evaluate in one select.
    shifted = dim.select(*[exprs.get(c, F.col(c)).alias(c) for c in dim.columns])
    if validate:
        shifted = unique_rows(shifted, dim_keys, prefix.rstrip("_") or "dimension", keep_null_keys=how not in ("left", "inner"))
    shifted = prefix_columns(shifted, prefix)
    pk = [prefix + k for k in dim_keys]
    cond = [fact[f] == shifted[d] for f, d in zip(fact_keys, pk)]
    out = fact.join(shifted, cond, how)
    return out.drop(*pk, *[prefix + c for c in drop])


def multi_shift_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    variants: Sequence[tuple[str, dict[str, str | Column] | None]],
    drop: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Several shifted copies of one dimension joined to the fact in ONE join.

    Equivalent to one :func:`shifted_lookup` per ``(prefix, shift)`` variant.
    The dimension rows are exploded into their variants in a single pass and
    folded into one wide row per key (``max`` per variant in a hash
    aggregate), so the dimension is computed once and the fact is joined
    once, whatever the number of variants. The same aggregate counts the rows
    of each variant: two rows on one shifted key break the m:1 contract and
    raise, they are never blended.
    """
    keys = list(dim_keys)
    measures = [c for c in dim.columns if c not in keys and c not in drop]
    copies = []
    for i, (_, shift) in enumerate(variants):
        shift = shift or {}
        fields = [F.lit(i).alias("_variant")]
        for k in keys:
            s = shift.get(k)
            e = shift_time(k, s) if isinstance(s, str) else (s if s is not None else F.col(k))
            fields.append(e.alias(k))
        copies.append(F.struct(*fields))
    exploded = dim.select(F.explode(F.array(*copies)).alias("_s"), *measures).select("_s.*", *measures)
    v = F.col("_variant")
    wide = exploded.groupBy(*keys).agg(
        *[F.max(F.when(v == i, F.col(m))).alias(prefix + m) for i, (prefix, _) in enumerate(variants) for m in measures],
        F.greatest(F.lit(0), *[F.count_if(v == i) for i in range(len(variants))]).alias("_rows"))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    error = F.raise_error(F.concat(F.lit(f"shifted dimension: keys {keys} not unique: "), F.to_json(F.struct(*keys))))
    wide = wide.filter(F.when(whole & (F.col("_rows") > 1), error.cast("int")).otherwise(F.lit(0)) == 0)
    pk = [f"_k_{k}" for k in keys]
    wide = wide.select(*[F.col(k).alias(a) for k, a in zip(keys, pk)],
                       *[c for c in wide.columns if c not in keys and c != "_rows"])
    cond = [fact[f] == wide[d] for f, d in zip(fact_keys, pk)]
    return fact.join(wide, cond, how).drop(*pk)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The reference writes ``FROM merged, bounds``. Here each column of the
    one-row relation becomes a scalar subquery: Spark runs it once and uses
    the value as a literal, so no join (and no cross product) is planned.
    """
    cols = {c: one_row.select(c).scalar() for c in one_row.columns}
    return df.withColumns(cols)
