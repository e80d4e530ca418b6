"""Joins: enrichment, role-playing dimensions, conditional keys, ranges.

No side is hinted for broadcast: Catalyst and adaptive execution decide from sizes they know, and an
estimate above a generator is not one of those. ``strategy`` names a Spark join hint (``merge``,
``shuffle_hash``) where a caller knows better.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spread of rows whose join key is null, so that they do not all land in one task.
NULL_KEY_BUCKETS = 256
# Points of a range that share a join key.
RANGE_BUCKET = 1024
# Ids of a dimension in several roles that the driver and a task hold with their values.
ROLE_IDS = 100_000
# Roles that are joined one by one, and bytes of what they are joined with; the JVM does not compile more joins above a wide fact.
JOINED_ROLES, JOINED_BYTES = 4, 2 << 20


def hinted(df: DataFrame, strategy: str | None) -> DataFrame:
    return df.hint(strategy) if strategy else df


def left_enrich(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Mapping[str, str],
    take: Sequence[str] | Mapping[str, str],
    spread: Sequence[str] = (),
    strategy: str | None = None,
) -> DataFrame:
    """Left join on ``{fact column: dimension column}``, adding the ``take`` columns.

    Repeated dimension keys multiply fact rows as in any join. Null keys never match, so they
    are dropped from the dimension. In a shuffled join all fact rows with a null key would go
    to one task; those rows are scattered over buckets that the dimension does not have, by the
    columns of ``spread`` or else by a few columns that are no keys. Hot keys
    that do match are left to adaptive skew handling, which can split the fact side.
    """
    names = dict(take) if isinstance(take, Mapping) else {name: name for name in take}
    key_columns = {f"__key_{i}": pair for i, pair in enumerate(keys.items())}
    side = dimension.select(
        *[F.col(source).alias(alias) for alias, (_, source) in key_columns.items()],
        *[F.col(source).alias(f"__take_{alias}") for source, alias in names.items()],
    ).dropna(subset=list(key_columns))
    condition = [F.col(left) == F.col(alias) for alias, (left, _) in key_columns.items()]
    left = fact
    spread = spread or [f.name for f in fact.schema if f.name not in keys and "map<" not in f.dataType.simpleString()][:4]
    if spread:
        has_null = reduce(Column.__or__, [F.col(name).isNull() for name in keys])
        bucket = F.pmod(F.xxhash64(*spread), F.lit(NULL_KEY_BUCKETS)).cast("int") + 1
        left = fact.withColumn("__bucket", F.when(has_null, bucket).otherwise(0))
        side = side.withColumn("__side_bucket", F.lit(0))
        condition.append(F.col("__bucket") == F.col("__side_bucket"))
    joined = left.join(hinted(side, strategy), condition, "left")
    return joined.select(*fact.columns, *[F.col(f"__take_{a}").alias(a) for a in names.values()])


def inner_enrich(
    fact: DataFrame, dimension: DataFrame, keys: Mapping[str, str], take: Sequence[str]
) -> DataFrame:
    """Inner join on ``{fact column: dimension column}``, adding the ``take`` columns."""
    side = dimension.select(
        *[F.col(right).alias(f"__key_{i}") for i, right in enumerate(keys.values())], *take
    )
    condition = [F.col(left) == F.col(f"__key_{i}") for i, left in enumerate(keys)]
    return fact.join(side, condition, "inner").select(*fact.columns, *take)


def resolve_roles(
    fact: DataFrame,
    dimension: DataFrame,
    roles: Mapping[str, str],
    dimension_key: str,
    value: str,
    strategy: str | None = None,
) -> DataFrame:
    """Look the same dimension up for many id columns, ``{id column: output column}``.

    The result is that of one left join per role: a repeated dimension key multiplies the fact's
    rows, a null or unknown id gives null. One join per role would move the wide fact each time.
    The ids that the fact names are looked up once, by a join that ``strategy`` may name. Up to
    ``ROLE_IDS`` of them the fact stays where it is: what was found is broadcast to a few roles, or searched
    as a sorted list in the fact's tasks by many roles and under a strategy. Above that the fact is moved once.
    """
    side = dimension.select(F.col(dimension_key).alias("__id"), F.struct(F.col(value).alias("value")).alias("__value"))
    side = hinted(side.dropna(subset=["__id"]), strategy)
    if all(isinstance(fact.schema[c].dataType, T.IntegralType) for c in roles):
        ids = fact.select(F.explode(F.array_distinct(F.array(*roles))).alias("id")).dropna().distinct()
        known = ids.join(side, F.col("id") == F.col("__id"), "inner").groupBy("id").agg(F.collect_list("__value").alias("found"))
        held = known.select(F.col("id").cast("bigint").alias("id"), "found").limit(ROLE_IDS + 1).toArrow()
        if held.num_rows <= ROLE_IDS:
            return _by_id(fact, held.sort_by("id").combine_chunks(), known.schema["found"].dataType, roles, strategy)
    return _by_combination(fact, side, roles, strategy)


def _by_id(fact: DataFrame, held: pa.Table, kind: T.ArrayType, roles: Mapping[str, str], strategy: str | None) -> DataFrame:
    """Roles from the sorted table ``held`` of ids with all their values, without moving the fact."""
    if strategy is None and len(roles) <= JOINED_ROLES and held.nbytes <= JOINED_BYTES:
        side = fact.sparkSession.createDataFrame(held, T.StructType().add("id", T.LongType()).add("found", kind))
        found = fact
        for i, column in enumerate(roles):
            one = side.select(F.col("id").alias(f"__id_{i}"), F.col("found").alias(f"__found_{i}"))
            found = found.join(one, F.col(column) == F.col(f"__id_{i}"), "left")
    else:
        ids, lists = held["id"].to_numpy(), held["found"].combine_chunks()

        def sought(*columns: pa.Array) -> pa.Array:
            each = []
            for column in columns:
                wanted = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.searchsorted(ids, wanted)
                known = np.asarray(column.is_valid()) & (at < len(ids))
                known[known] = ids[at[known]] == wanted[known]
                each.append(lists.take(pa.array(at, mask=~known)))
            return pa.StructArray.from_arrays(each, [f"f{i}" for i in range(len(each))])

        kinds = T.StructType([T.StructField(f"f{i}", kind) for i in range(len(roles))])
        found = fact.withColumn("__sought", F.arrow_udf(sought, kinds)(*roles))
        found = found.select(*fact.columns, *[F.col(f"__sought.f{i}").alias(f"__found_{i}") for i in range(len(roles))])
    places = {output: F.col(f"__found_{i}") for i, output in enumerate(roles.values())}
    if all(n == 1 for n in pc.list_value_length(held["found"]).to_pylist()):
        return found.select(*fact.columns, *[F.get(at, F.lit(0))["value"].alias(output) for output, at in places.items()])
    return _all_matches(found.select(*fact.columns, *[at.alias(output) for output, at in places.items()]), roles).select(*fact.columns, *roles.values())


def _all_matches(found: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """A row for every match of every role; almost always one."""
    for output in roles.values():
        others = [F.col(c) for c in found.columns if c != output]
        found = found.select(*others, F.explode_outer(output).alias("__one")).select(*others, F.col("__one.value").alias(output))
    return found


def _by_combination(fact: DataFrame, side: DataFrame, roles: Mapping[str, str], strategy: str | None) -> DataFrame:
    """Roles for more ids than a task can hold.

    The distinct combinations of ids are unpivoted to narrow ``(combination, id)`` rows,
    looked up by one join and folded back per combination; the fact meets the result once.
    """
    keyed = fact.withColumn("__ids", F.struct(*roles))
    combinations = keyed.select("__ids").distinct()
    narrow = combinations.select(
        "__ids", F.explode(F.array_distinct(F.array(*[F.col(f"__ids.{c}") for c in roles]))).alias("id")
    ).dropna(subset=["id"])
    found = narrow.join(side, F.col("id") == F.col("__id"), "inner")
    folded = found.groupBy("__ids").agg(
        *[
            F.collect_list(F.when(F.col("id") == F.col(f"__ids.{column}"), F.col("__value"))).alias(output)
            for column, output in roles.items()
        ]
    )
    folded = _all_matches(folded, roles)
    return keyed.join(hinted(folded, strategy), "__ids", "left").select(*fact.columns, *roles.values())


def conditional_key_enrich(
    fact: DataFrame,
    dimension: DataFrame,
    type_column: str,
    id_column: str,
    id_types: Mapping[str, str],
    take: Sequence[str],
    spread: Sequence[str] = (),
    strategy: str | None = None,
) -> DataFrame:
    """Left join whose dimension key depends on a type column, ``{type: dimension column}``.

    A CASE in the join condition has no hash key and would be planned as a nested loop. The
    dimension is unpivoted to ``(type, id, ...)`` so that both columns are equi-join keys.
    """
    slots = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(col).cast("string").alias("id"))
            for kind, col in id_types.items()
        ]
    )
    side = (
        dimension.select(F.explode(slots).alias("slot"), *take)
        .select(F.col("slot.kind").alias("__kind"), F.col("slot.id").alias("__id"), *take)
        .dropna(subset=["__id"])
    )
    # A type outside the list can never match: give it a null key.
    keyed = fact.withColumn(
        "__typed_id",
        F.when(F.col(type_column).isin(*id_types), F.col(id_column).cast("string")),
    )
    typed = {type_column: "__kind", "__typed_id": "__id"}
    return left_enrich(keyed, side, typed, take, spread, strategy).drop("__typed_id")


def first_cover(ranges: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Disjoint ``(*on, low, high, value)``: each stretch with the value of its first range by ``position``.

    Stretches end where some range of the same key starts or ends, so a stretch is never partly covered.
    """
    keys = list(on)
    edges = ranges.select(*keys, F.explode(F.array(F.col("start").cast("bigint"), F.col("end").cast("bigint") + 1)).alias("low")).distinct()
    following = Window.partitionBy(*keys).orderBy("low")
    stretches = edges.withColumn("high", F.lead("low").over(following) - 1).dropna(subset=["high"])
    held = ranges.select(*[F.col(k).alias(f"__{k}") for k in keys], "start", "end", "position", F.col(value).alias("__value"))
    inside = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("start") <= F.col("low"), F.col("high") <= F.col("end")]
    return stretches.join(held, inside).groupBy(*keys, "low", "high").agg(F.min_by("__value", "position").alias(value))


def range_value(
    fact: DataFrame,
    ranges: DataFrame,
    on: Sequence[str],
    point: str,
    value: str,
    output: str,
    default: int = 0,
    bucket: int = RANGE_BUCKET,
) -> DataFrame:
    """Value of the first range ``[start, end]`` (by ``position``) holding the point, else default.

    ``ranges`` has columns ``*on, position, start, end, value``. They are made disjoint, so a point
    has one match at most, and joined by their keys and a coarse bucket of the point. The join is
    sorted, never broadcast: the optimizer cannot see how many buckets a range covers.
    """
    parts = first_cover(ranges, on, value)
    covered = F.sequence(F.floor(F.col("low") / bucket), F.floor(F.col("high") / bucket))
    side = parts.select(
        *[F.col(name).alias(f"__{name}") for name in on], "low", "high", F.col(value).alias("__found"), F.explode(covered).alias("__covered")
    )
    condition = [F.col(name) == F.col(f"__{name}") for name in on]
    condition.append(F.floor(F.col(point).cast("bigint") / bucket) == F.col("__covered"))
    condition.append(F.col(point).between(F.col("low"), F.col("high")))
    joined = fact.join(side.hint("merge"), condition, "left")
    return joined.select(*fact.columns, F.coalesce("__found", F.lit(default)).alias(output))
