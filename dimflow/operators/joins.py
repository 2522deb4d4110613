"""Lookups and joins.

No side is ever forced to broadcast here: Spark broadcasts a side whose known
size is under spark.sql.autoBroadcastJoinThreshold, and adaptive execution
does so again with the sizes measured at run time. Larger sides meet in a
shuffle join whose oversized partitions adaptive execution splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from dimflow.functions.dates import open_end

UNKNOWN = "-1"
AMBIGUOUS = "-2"

On = dict[str, str]  # fact column -> dimension column


def _prepare(dim: DataFrame, names: list[str], tag: str) -> DataFrame:
    """Only the needed dimension columns, under names that cannot clash with the fact's."""
    return dim.select([F.col(c).alias(f"__{tag}_{c}") for c in dict.fromkeys(names)])


def _equal(fact: DataFrame, side: DataFrame, on: On, tag: str) -> Column:
    return reduce(lambda a, b: a & b, [fact[f] == side[f"__{tag}_{d}"] for f, d in on.items()])


def lookup_sk(
    fact: DataFrame, dim: DataFrame, on: On, sk: str, *, out: str | None = None, default: str | None = UNKNOWN
) -> DataFrame:
    """Left lookup of a surrogate key on one or several columns; one row per fact row.

    A key that the dimension holds several times gives its largest surrogate key. Facts
    without a key find nothing; they are dealt out by their whole row, not to one task.
    """
    side = _prepare(dim, [*on.values(), sk], "d")
    names = [f"__d_{d}" for d in dict.fromkeys(on.values())]
    # Always 0, but no constant to the optimizer, which would take it out of the join's keys.
    side = side.groupBy(*names).agg(F.max(f"__d_{sk}").alias(f"__d_{sk}")).withColumn("__d_at", F.pmod(F.xxhash64(*names), F.lit(1)))
    known = reduce(lambda a, b: a & b, [fact[f].isNotNull() for f in on])
    whole = [fact[f.name] for f in fact.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    spread = F.when(known, F.lit(0)).otherwise(F.xxhash64(*whole))
    joined = fact.join(side, _equal(fact, side, on, "d") & (spread == side["__d_at"]), "left")
    value = F.col(f"__d_{sk}")
    value = value if default is None else F.coalesce(value, F.lit(default))
    return joined.withColumn(out or sk, value).drop(*side.columns)


EPOCH = "1970-01-01"


def _bucket(col: Column, days: int) -> Column:
    return F.floor(F.datediff(col, F.lit(EPOCH).cast("date")) / days).cast("long")


@dataclass(frozen=True)
class AsOf:
    """One dated lookup: the version of a dimension row that is valid on a fact's date."""

    dim: DataFrame
    on: On
    date_col: str
    sk: str
    out: str | None = None
    eff: str = "eff_dt"
    disc: str = "disc_dt"
    default: str | None = UNKNOWN

    @property
    def name(self) -> str:
        return self.out or self.sk


def version_index(look: AsOf, keys: list[Column]) -> DataFrame:
    """One row per key: its versions in the order of their starts, and the steps of a search in them.

    ``keys`` are the key columns as the fact has them. Of versions that begin on one day
    the one with the largest key stands, so a key has one version a day at most.
    """
    eff, disc = F.col(look.eff).cast("date"), F.col(look.disc).cast("date")
    side = look.dim.select(*keys, eff.alias("eff"), F.struct(F.col(look.sk).alias("sk"), disc.alias("disc")).alias("version"))
    names = side.columns[: len(keys)]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in names])
    days = side.filter(known & (F.col("eff") <= F.col("version.disc"))).groupBy(*names, "eff").agg(F.max("version").alias("v"))
    # Grouped by one value more, always 0, this side isn't dealt out as the join needs it: the
    # join's own shuffles are those that adaptive execution can split.
    listed = days.groupBy(*names, F.pmod(F.xxhash64(*names), F.lit(1)).alias("__zero")).agg(
        F.sort_array(F.collect_list(F.struct("eff", "v.sk", "v.disc"))).alias("__versions")
    )
    listed = listed.drop("__zero")
    top = F.floor(F.log2(F.size("__versions"))).cast("int")
    steps = F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda b: F.pow(F.lit(2), b).cast("int"))
    return listed.withColumn("__steps", steps)


def _valid(at: Column) -> Column:
    """Surrogate key of the version valid on a day, by binary search for the last one begun by then."""
    versions = F.col("__versions")

    def step(begun: Column, more: Column) -> Column:
        reached = F.get(versions, begun + more - 1)["eff"] <= at
        return F.when(F.coalesce(reached, F.lit(False)), begun + more).otherwise(begun)

    last = F.get(versions, F.aggregate("__steps", F.lit(0), step) - 1)
    return F.when(last["disc"] >= at, last["sk"])


def lookup_indexed(
    fact: DataFrame,
    dim: DataFrame,
    on: On,
    date_col: str,
    sk: str,
    *,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
    out: str | None = None,
    default: str | None = UNKNOWN,
) -> DataFrame:
    """Surrogate key of the version valid on the fact's date, both ends included; one row per fact row.

    From its start on a version takes the place of those that began before it; of
    versions that begin on one day the one with the largest key stands. The versions
    of a key become one row with a sorted array, no longer than the calendar, which the
    fact meets in an equi join and searches in two's steps. So a small dimension is
    broadcast and the fact isn't shuffled; for a large one adaptive execution splits the
    facts of a hot key over tasks.
    """
    look = AsOf(dim, on, date_col, sk, out, eff, disc, default)
    side = version_index(look, [F.col(d).cast(fact.schema[f].dataType).alias(f"__k{i}") for i, (f, d) in enumerate(on.items())])
    same = reduce(lambda a, b: a & b, [fact[f] == side[f"__k{i}"] for i, f in enumerate(on)])
    value = _valid(fact[date_col].cast("date"))
    value = value if default is None else F.coalesce(value, F.lit(default))
    joined = fact.join(side, same, "left")
    return joined.select(*[fact[c] for c in fact.columns if c != look.name], value.alias(look.name))


#: Facts with so many columns besides those that lookups read, all of fixed size, are carried along by ``lookup_many``.
CARRIED = 8


def _is_light(fact: DataFrame, looks: list[AsOf]) -> bool:
    read = {c for x in looks for c in [*x.on, x.date_col]}
    rest = [f.dataType for f in fact.schema if f.name not in read]
    return len(rest) <= CARRIED and all(isinstance(x, (NumericType, BooleanType, DatetimeType)) for x in rest)


def _carried(fact: DataFrame, looks: list[AsOf]) -> DataFrame:
    """The lookups of ``lookup_many`` one after the other, each row with the keys found so far."""
    out = fact
    for i, x in enumerate(looks):
        out = lookup_indexed(out, x.dim, x.on, x.date_col, x.sk, eff=x.eff, disc=x.disc, out=f"__a{i}", default=x.default)
    found = {x.name: F.col(f"__a{i}") for i, x in enumerate(looks)}
    return out.select(*[c for c in fact.columns if c not in found], *[v.alias(n) for n, v in found.items()])


def lookup_many(fact: DataFrame, ids: list[str], looks: list[AsOf], *, carry: bool | None = None) -> DataFrame:
    """Several dated lookups in one pass over narrow rows, or over whole rows that are as narrow.

    Rows with the same ``ids``, which may be a key of the fact or all columns that the
    lookups read, must have the same keys and dates.

    Each fact row asks once per lookup, with its ids, the key and the date only. All
    questions meet the versions of all dimensions in one join on lookup and key; the
    answers come back in one row per fact row and one join. For wide facts and dimensions
    too large to broadcast: else every ``lookup_indexed`` would shuffle whole rows.

    Of light facts (at most CARRIED other columns, all of fixed size) the row itself is no
    wider than a question with its ids. They take their answers along from lookup to
    lookup (``carry``), which spares the questions, their grouping and the join back.
    """
    if carry or carry is None and _is_light(fact, looks):
        return _carried(fact, looks)

    def key(i: int, cols: list[Column]) -> Column:
        return F.array(F.lit(str(i)), *[c.cast("string") for c in cols])

    def asked(i: int, look: AsOf) -> Column:
        cols = [F.col(f) for f in look.on]
        known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
        return F.struct(F.lit(i).alias("no"), F.when(known, key(i, cols)).alias("key"), F.col(look.date_col).cast("date").alias("at"))

    asks = fact.select(*ids, F.explode(F.array(*[asked(i, x) for i, x in enumerate(looks)])).alias("ask"))
    asks = asks.select(*ids, "ask.*").filter("key is not null and at is not null")
    sides = []
    for i, look in enumerate(looks):
        # Keys are compared in the fact's type, as in a lookup of its own.
        cols = [F.col(d).cast(fact.schema[f].dataType) for f, d in look.on.items()]
        known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
        text = AsOf(look.dim.withColumn("__text", F.col(look.sk).cast("string")), look.on, look.date_col, "__text", None, look.eff, look.disc)
        sides.append(version_index(text, [F.when(known, key(i, cols)).alias("key")]))
    met = asks.join(reduce(DataFrame.unionByName, sides), "key")
    met = met.select(*ids, "no", _valid(F.col("at")).alias("sk"))
    answers = [F.max(F.when(F.col("no") == i, F.col("sk"))).alias(f"__a{i}") for i in range(len(looks))]
    answered = met.groupBy(*[F.col(c).alias(f"__i{n}") for n, c in enumerate(ids)]).agg(*answers)
    same = reduce(lambda a, b: a & b, [fact[c].eqNullSafe(answered[f"__i{n}"]) for n, c in enumerate(ids)])
    found = {}
    for i, look in enumerate(looks):
        value = F.col(f"__a{i}").cast(look.dim.schema[look.sk].dataType)
        found[look.name] = value if look.default is None else F.coalesce(value, F.lit(look.default))
    joined = fact.join(answered, same, "left")
    return joined.select(*[fact[c] for c in fact.columns if c not in found], *[v.alias(n) for n, v in found.items()])


def lookup_asof(
    fact: DataFrame,
    dim: DataFrame,
    on: On,
    date_col: str,
    sk: str,
    *,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
    out: str | None = None,
    default: str | None = UNKNOWN,
    bucket_days: int = 365,
) -> DataFrame:
    """As ``lookup_indexed``, in one sorted pass without a join: for dimensions too large to broadcast.

    From its start on a version takes the place of those that began before it; of
    versions that begin on one day the one with the largest key stands. Facts and
    version starts are read in one sorted pass per key and time bucket that carries
    the latest version forward, so the work grows with facts plus versions, and a hot
    key is spread over its buckets. A version starts anew in each bucket it spans
    within the facts' dates.
    """
    keys = [f"__k{i}" for i in range(len(on))]
    at = fact[date_col].cast("date")
    named = [F.col(d).cast(fact.schema[f].dataType).alias(k) for k, (f, d) in zip(keys, on.items())]
    side = dim.select(*named, F.col(eff).cast("date").alias("eff"), F.col(disc).cast("date").alias("disc"), F.col(sk).alias("sk"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    order = Window.partitionBy(*keys).orderBy("eff", "sk")
    side = side.filter(known & (F.col("eff") <= F.col("disc"))).withColumn("next", F.lead("eff").over(order))
    side = side.withColumn("until", F.least("disc", F.date_sub("next", 1))).filter("until >= eff")
    dates = fact.agg(F.struct(F.min(at).alias("low"), F.max(at).alias("high")).alias("d")).scalar()
    first, last = F.greatest(F.col("eff"), dates["low"]), F.least(F.col("until"), dates["high"])
    spans = F.sequence(_bucket(first, bucket_days), _bucket(last, bucket_days))
    # No span where the version lies outside the facts' dates; such a version finds no fact.
    side = side.withColumn("bucket", F.explode(F.when(first <= last, spans)))
    begins = F.greatest(F.col("eff"), F.date_add(F.lit(EPOCH).cast("date"), (F.col("bucket") * bucket_days).cast("int")))
    starts = side.select(
        *keys, "bucket", begins.alias("at"), F.lit(0).alias("kind"), F.struct("sk", "until").alias("version")
    )
    row = F.struct(*[fact[c] for c in fact.columns])
    bucket = _bucket(at, bucket_days)
    for f in on:  # facts without a key or a date meet no version, so they may lie anywhere
        bucket = F.when(fact[f].isNull(), F.xxhash64(row)).otherwise(bucket)
    bucket = F.coalesce(bucket, F.xxhash64(row))
    facts = fact.select(
        *[fact[f].alias(k) for k, f in zip(keys, on)],
        bucket.alias("bucket"),
        at.alias("at"),
        F.lit(1).alias("kind"),
        row.alias("row"),
    )
    both = facts.unionByName(starts, allowMissingColumns=True)
    pass_ = Window.partitionBy(*keys, "bucket").orderBy("at", "kind")
    carried = both.withColumn("version", F.last("version", ignorenulls=True).over(pass_)).filter("kind = 1")
    value = F.when(F.col("version.until") >= F.col("at"), F.col("version.sk"))
    value = value if default is None else F.coalesce(value, F.lit(default))
    name = out or sk
    return carried.select(*[F.col("row")[c].alias(c) for c in fact.columns if c != name], value.alias(name))


def lookup_roles(
    fact: DataFrame,
    dim: DataFrame,
    roles: dict[str, str],
    dim_key: str,
    sk: str,
    *,
    date_col: str | None = None,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
    default: str | None = UNKNOWN,
) -> DataFrame:
    """One dimension looked up once per role, ``{output key: fact column}``."""
    for name, col in roles.items():
        if date_col is None:
            fact = lookup_sk(fact, dim, {col: dim_key}, sk, out=name, default=default)
        else:
            fact = lookup_asof(
                fact, dim, {col: dim_key}, date_col, sk, eff=eff, disc=disc, out=name, default=default
            )
    return fact


def lookup_sk_multi(
    fact: DataFrame, dim: DataFrame, ids_col: str, dim_key: str, sk: str, *, out: str | None = None
) -> DataFrame:
    """Key of the one id in an array column: none or unknown '-1', several '-2'."""
    n = F.coalesce(F.size(ids_col), F.lit(0))
    one = fact.withColumn("__one", F.when(n == 1, F.try_element_at(F.col(ids_col), F.lit(1))))
    name = out or sk
    found = lookup_sk(one, dim, {"__one": dim_key}, sk, out=name)
    return found.withColumn(name, F.when(n > 1, F.lit(AMBIGUOUS)).otherwise(F.col(name))).drop("__one")


def join_trimmed(left: DataFrame, right: DataFrame, on: On, how: str = "left") -> DataFrame:
    """Equi join on the trimmed text of both sides."""
    cond = reduce(lambda a, b: a & b, [F.trim(left[a]) == F.trim(right[b]) for a, b in on.items()])
    return left.join(right, cond, how)


def join_per_key_max(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """Each row with the maximum of its key, from a partially aggregated side."""
    side = df.groupBy(*keys).agg(F.max(col).alias(name))
    return df.join(side, keys, "inner")


def join_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate to every row.

    The one row is computed once and put in as constants (scalar subqueries).
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def unseen(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(known.select(*keys), keys, "left_anti")


def seen(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(known.select(*keys), keys, "left_semi")


def exclude_superseded(
    df: DataFrame, key: str, kind: str, superseded_kind: str, ended: Column
) -> DataFrame:
    """Drop ended rows of one kind for keys that also occur as another kind."""
    kinds = df.groupBy(key).agg(
        F.count_if(F.col(kind) == superseded_kind).alias("__old"),
        F.count_if(F.col(kind) != superseded_kind).alias("__other"),
    )
    changed = kinds.filter((F.col("__old") > 0) & (F.col("__other") > 0)).select(key)
    flagged = changed.withColumn("__changed", F.lit(True))
    drop = F.col("__changed").isNotNull() & (F.col(kind) == superseded_kind) & ended
    return df.join(flagged, key, "left").filter(~F.coalesce(drop, F.lit(False))).drop("__changed")


def join_any(left: DataFrame, right: DataFrame, key: On, left_col: str, right_cols: list[str], how: str = "left"):
    """Equal key, and a left column equal to any of several right columns.

    Each right row is repeated once per distinct value of those columns, which
    turns the alternative into one equi join: no two rows meet in vain.
    """
    values = F.array_distinct(F.array(*right_cols))
    side = right.withColumn("__any", F.explode(values)).filter(F.col("__any").isNotNull())
    cond = reduce(lambda a, b: a & b, [left[a] == side[b] for a, b in key.items()])
    return left.join(side, cond & (left[left_col] == side["__any"]), how).drop("__any")


def events_in_interval(
    versions: DataFrame,
    events: DataFrame,
    on: On,
    date_col: str,
    *,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
    how: str = "left",
) -> DataFrame:
    """Each version with the events dated inside its interval.

    The events look for their version, not the other way round: an event meets
    the few versions of its key, and the events of a hot key can be split over
    tasks. Versions no event has found are added afterwards.
    """
    eq = reduce(lambda a, b: a & b, [versions[a] == events[b] for a, b in on.items()])
    within = eq & events[date_col].between(versions[eff], versions[disc])
    met = events.join(versions, within, "inner").select(
        *[versions[c] for c in versions.columns], *[events[c] for c in events.columns]
    )
    if how == "inner":
        return met
    ids = [*on, eff, disc]
    found = met.select([F.col(c).alias(f"__f_{c}") for c in ids]).distinct()
    same = reduce(lambda a, b: a & b, [versions[c].eqNullSafe(found[f"__f_{c}"]) for c in ids])
    lone = versions.join(found, same, "left_anti")
    return met.unionByName(lone, allowMissingColumns=True)


def join_nullable(
    left: DataFrame, right: DataFrame, cols: list[str], equal: On, *, null_safe: bool = True, how: str = "left"
) -> DataFrame:
    """Join on nullable columns.

    ``null_safe=True``: null equals null only. ``null_safe=False``: a null on
    either side fits anything in that column. The wildcard form is run as one
    equi join: the left side's distinct values and the right rows are repeated once
    per pattern of nulls that occurs on the other side (at most 2^len(cols), usually
    a handful) and keyed by the columns that are known on both sides, so unequal
    rows never meet. Left rows, never repeated, then take the partners of their values.
    Columns of the two sides must have different names; ``cols`` are shared
    base names, ``l_<name>`` on the left and ``r_<name>`` on the right.
    """
    eq = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in equal.items()], F.lit(True))
    if null_safe:
        cond = reduce(lambda a, b: a & b, [left[f"l_{c}"].eqNullSafe(right[f"r_{c}"]) for c in cols], eq)
        return left.join(right, cond, how)

    def mask(prefix: str) -> Column:
        return F.concat(*[F.when(F.col(prefix + c).isNull(), "0").otherwise("1") for c in cols])

    left, right = left.withColumn("__lm", mask("l_")), right.withColumn("__rm", mask("r_"))
    left_masks = [r[0] for r in left.select("__lm").distinct().collect()]
    right_masks = [r[0] for r in right.select("__rm").distinct().collect()]

    def repeated(df: DataFrame, prefix: str, own: str, other: str, masks: list[str]) -> DataFrame:
        options = F.array(*[F.lit(m) for m in masks]) if masks else F.array().cast("array<string>")
        out = df.withColumn(other, F.explode(options))
        for i, c in enumerate(cols, 1):
            both = (F.substring("__lm", i, 1) == "1") & (F.substring("__rm", i, 1) == "1")
            out = out.withColumn(f"__{prefix}{c}", F.when(both, F.col(prefix + c).cast("string")))
        return out.withColumnsRenamed({"__lm": f"__{prefix}lm", "__rm": f"__{prefix}rm"})

    # Left rows with the same joined values have the same partners: those meet the right side once.
    values = [*equal, *[f"l_{c}" for c in cols]]
    a = repeated(left.select(*values, "__lm").distinct(), "l_", "__lm", "__rm", right_masks)
    b = repeated(right, "r_", "__rm", "__lm", left_masks)
    cond = (a["__l_lm"] == b["__r_lm"]) & (a["__l_rm"] == b["__r_rm"])
    for x, y in equal.items():
        cond = cond & (a[x] == b[y])
    for c in cols:
        cond = cond & a[f"__l_{c}"].eqNullSafe(b[f"__r_{c}"])
    right_cols = [c for c in right.columns if not c.startswith("__")]
    left_cols = [c for c in left.columns if not c.startswith("__")]
    met = a.join(b, cond, "inner").select(*[F.col(c).alias(f"__m_{c}") for c in values], *right_cols)
    same = reduce(lambda x, y: x & y, [left[c].eqNullSafe(met[f"__m_{c}"]) for c in values])
    return left.join(met, same, how).select(*left_cols, *right_cols)


def intersect_intervals(
    log: DataFrame,
    keys: list[str],
    attrs: list[str],
    *,
    attr_col: str = "change_column",
    value_col: str = "current_value",
    eff: str = "eff_dt",
    disc: str = "disc_dt",
) -> DataFrame:
    """Slices of time in which every attribute has a value, one column per attribute.

    Equal to joining one copy of the log per attribute and keeping overlapping
    combinations, in linear instead of polynomial work: the starts and the days
    after the ends cut a key's time into slices, and in each slice an attribute
    has the value of its last start, as long as that interval has not ended.
    Expects intervals of one key and attribute not to overlap. One key holds at
    most one cut per day, so its window is bounded.
    """
    kept = log.filter(F.col(attr_col).isin(attrs) & (F.col(eff) <= F.col(disc)))
    state = F.struct(F.col(value_col).alias("value"), F.col(disc).alias("until"))
    begin = F.struct(F.col(eff).alias("cut"), F.col(attr_col).alias("attr"), state.alias("state"))
    none = F.lit(None)
    after = F.struct(
        F.when(F.col(disc) < open_end(), F.date_add(disc, 1)).alias("cut"),
        none.cast("string").alias("attr"),
        none.cast(log.select(state.alias("s")).schema["s"].dataType).alias("state"),
    )
    cuts = kept.select(*keys, F.explode(F.array(begin, after)).alias("__p")).filter(F.col("__p.cut").isNotNull())
    merged = cuts.groupBy(*keys, F.col("__p.cut").alias("__cut")).agg(
        *[F.max(F.when(F.col("__p.attr") == a, F.col("__p.state"))).alias(f"__a{i}") for i, a in enumerate(attrs)]
    )
    w = Window.partitionBy(*keys).orderBy("__cut")
    filled = merged.withColumns(
        {f"__a{i}": F.last(f"__a{i}", ignorenulls=True).over(w) for i in range(len(attrs))}
        | {"__next": F.lead("__cut").over(w)}
    )
    alive = reduce(lambda a, b: a & b, [F.col(f"__a{i}.until") >= F.col("__cut") for i in range(len(attrs))])
    slices = filled.filter(alive).select(
        *keys,
        *[F.col(f"__a{i}.value").alias(a) for i, a in enumerate(attrs)],
        F.col("__cut").alias(eff),
        F.least(
            *[F.col(f"__a{i}.until") for i in range(len(attrs))],
            F.coalesce(F.date_sub("__next", 1), open_end()),
        ).alias(disc),
    )
    return slices
