"""Merges as DataFrame rewrites: target and source in, new target out.

Each merge reads the target with a join that lets a small source be broadcast,
so a large target is scanned and rewritten but not shuffled. Writing the result
back is the sinks' business (``publish_swap``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from dimflow.functions.dates import day_before, open_end
from dimflow.functions.keys import packed, unpacked


class DuplicateKeyError(ValueError):
    """A merge source has several rows for one key."""


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Texts are counted by a hash first, which is shuffled in their place; only a repeated hash has the keys compared."""
    if keys and all(df.schema[k].dataType == StringType() for k in keys):
        hashes = df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
        if hashes.filter("n > 1").isEmpty():
            return
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if dup:
        raise DuplicateKeyError(f"merge source repeats keys {[tuple(r)[:-1] for r in dup]}")


# Numeric types from narrow to wide, with the decimal that holds each integer type.
_RANK = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class NoCommonType(ValueError):
    """No type holds the values of both columns exactly."""


def wider(a, b):
    """The type that holds every value of both; whole numbers of any size meet binary fractions in none."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    fractions = (FloatType, DoubleType)
    if type(a) in _RANK and type(b) in _RANK:
        if isinstance(a, fractions) != isinstance(b, fractions):
            whole = b if isinstance(a, fractions) else a
            if isinstance(whole, LongType):
                raise NoCommonType(f"{a.simpleString()} and {b.simpleString()}: cast one side first")
            return DoubleType()
        return max(a, b, key=lambda t: _RANK.index(type(t)))
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        if isinstance(a, fractions) or isinstance(b, fractions):
            raise NoCommonType(f"{a.simpleString()} and {b.simpleString()}: cast one side first")

        def parts(t):
            if isinstance(t, DecimalType):
                return t.precision - t.scale, t.scale
            return (_DIGITS[type(t)], 0) if type(t) in _DIGITS else None

        pa, pb = parts(a), parts(b)
        if pa and pb:
            scale = max(pa[1], pb[1])
            digits = max(pa[0], pb[0]) + scale
            if digits > 38:
                raise NoCommonType(f"{a.simpleString()} and {b.simpleString()} need {digits} digits")
            return DecimalType(digits, scale)
    stamps = (TimestampType, TimestampNTZType)
    if {type(a), type(b)} <= {DateType, *stamps}:
        return a if isinstance(a, stamps) else b
    return StringType()


def align_schema(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same columns and types: the wider type, null where absent."""
    t = {f.name: f.dataType for f in target.schema.fields}
    s = {f.name: f.dataType for f in source.schema.fields}
    names = [*t, *[c for c in s if c not in t]]
    types = {c: wider(t.get(c, NullType()), s.get(c, NullType())) for c in names}

    def shape(df: DataFrame, have: dict) -> DataFrame:
        return df.select([(F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c) for c in names])

    return shape(target, t), shape(source, s)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    update_cols: list[str] | None = None,
    no_update_cols: tuple[str, ...] = (),
    check: bool = True,
    hashes: tuple[str, ...] = (),
) -> DataFrame:
    """Type-1 merge: matched rows updated, other source rows inserted.

    All columns are updated, or only ``update_cols``, or all but
    ``no_update_cols``. Without keys everything is inserted. Text columns named in
    ``hashes`` hold hex digits mostly; if all columns are updated, they are shuffled packed.
    """
    target, source = align_schema(target, source)
    if not keys:
        return target.unionByName(source)
    if check:
        require_unique(source, keys)
    updated = [c for c in update_cols or target.columns if c not in no_update_cols and c not in keys]
    kept = [c for c in target.columns if c not in updated and c not in keys]
    short = [c for c in hashes if target.schema[c].dataType == StringType()]
    if not kept and short:
        # No anti join, which the optimizer would run before the columns are packed.
        old = target.withColumns({c: packed(c) for c in short})
        side = source.select([(packed(k) if k in short else F.col(k)).alias(f"__s_{k}") for k in keys]).withColumn("__hit", F.lit(True))
        cond = reduce(lambda a, b: a & b, [old[k] == side[f"__s_{k}"] for k in keys])
        rest = old.join(side, cond, "left").filter(F.col("__hit").isNull())
        return rest.select([(unpacked(c) if c in short else F.col(c)).alias(c) for c in target.columns]).unionByName(source)
    if not kept:
        return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
    side = source.select([F.col(c).alias(f"__s_{c}") for c in [*keys, *updated]]).withColumn("__hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [target[k] == side[f"__s_{k}"] for k in keys])
    joined = target.join(side, cond, "left")
    rewritten = joined.select(
        [
            F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        ]
    )
    # Which source keys exist is found from the target's key columns alone.
    matched = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return rewritten.unionByName(source.join(matched, keys, "left_anti"))


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    hash_col: str = "dbt_hash",
    source_eff: str = "rpt_eff_dt",
    disc: str = "disc_dt",
    current: str = "is_current",
    check: bool = True,
) -> DataFrame:
    """Type-2 merge in one plan.

    A source row is inserted when its key has no open version with the same
    hash. An open version whose key arrives with another hash is closed on the
    day before the source row's date.
    """
    target, source = align_schema(target, source)
    if check:
        require_unique(source, keys)
    how = dict(hash_col=hash_col, disc=disc)
    closed = close_versions(target, source, keys, source_eff=source_eff, current=current, **how)
    return closed.unionByName(new_versions(target, source, keys, **how))


def close_versions(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    hash_col: str = "dbt_hash",
    source_eff: str = "rpt_eff_dt",
    disc: str = "disc_dt",
    current: str = "is_current",
) -> DataFrame:
    """The target with those open versions closed whose key arrives with another hash."""
    side = source.select(
        *[F.col(k).alias(f"__s_{k}") for k in keys],
        F.col(hash_col).alias("__s_hash"),
        F.col(source_eff).cast("date").alias("__s_eff"),
    )
    cond = reduce(lambda a, b: a & b, [target[k] == side[f"__s_{k}"] for k in keys])
    joined = target.join(side, cond & (F.col(disc) == open_end()), "left")
    closes = F.col("__s_hash").isNotNull() & (F.col("__s_hash") != F.col(hash_col))
    return joined.withColumns(
        {
            disc: F.when(closes, day_before("__s_eff")).otherwise(F.col(disc)),
            current: F.when(closes, F.lit(False)).otherwise(F.col(current)),
        }
    ).select(*target.columns)


def new_versions(
    target: DataFrame, source: DataFrame, keys: list[str], *, hash_col: str = "dbt_hash", disc: str = "disc_dt"
) -> DataFrame:
    """The source rows whose key has no open version with the same hash."""
    same = [*keys, hash_col]
    is_open = F.col(disc) == open_end()
    standing = target.filter(is_open).select(*same).join(source.select(*same), same, "left_semi").distinct()
    return source.join(standing, same, "left_anti")


def delete_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows of the source's keys are replaced by the source's rows."""
    target, source = align_schema(target, source)
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_cols: dict[str, Column | str],
    when: Column | None = None,
    *,
    check: bool = True,
) -> DataFrame:
    """Set columns of target rows matched by key and a condition on the target row.

    ``set_cols`` maps a target column to a source column name or to a Column;
    source columns are reachable in it as ``s_<name>``.
    """
    if check:
        require_unique(source, keys)
    side = source.select([F.col(c).alias(f"s_{c}") for c in source.columns]).withColumn("__hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [target[k] == side[f"s_{k}"] for k in keys])
    hit = F.col("__hit").isNotNull() if when is None else F.col("__hit").isNotNull() & when
    joined = target.join(side, cond, "left").withColumn("__do", F.coalesce(hit, F.lit(False)))
    values = {c: F.col(f"s_{v}") if isinstance(v, str) else v for c, v in set_cols.items()}
    return joined.select(
        [
            F.when(F.col("__do"), values[c].cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )
