"""Facts: one row per business event, with surrogate keys as of the event date."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType

from dimflow.functions.keys import packed, surrogate_key, unpacked
from dimflow.functions.text import POSITION_IDS, REQUISITION_IDS, distinct_ids, single_or_null
from dimflow.operators.joins import AsOf, lookup_indexed, lookup_many, lookup_sk, lookup_sk_multi
from dimflow.operators.merge import merge_upsert
from dimflow.operators.reshape import stamp
from dimflow.operators.windows import latest_per_key
from dimflow.plans.incremental import incremental_facts, unresolved
from dimflow.session import stage_table


@dataclass(frozen=True)
class Lookup:
    """How one surrogate key of a fact is found.

    ``on`` maps fact columns to dimension columns. With ``date_col`` the version
    valid on that date is taken. ``retry=False`` keeps an unresolved key from
    being tried again on every run.
    """

    dim: DataFrame
    on: dict[str, str]
    sk: str
    out: str | None = None
    date_col: str | None = None
    eff: str = "eff_dt"
    disc: str = "disc_dt"
    retry: bool = True

    @property
    def name(self) -> str:
        return self.out or self.sk

    def apply(self, fact: DataFrame) -> DataFrame:
        if self.date_col is None:
            return lookup_sk(fact, self.dim, self.on, self.sk, out=self.name)
        return lookup_indexed(
            fact,
            self.dim,
            self.on,
            self.date_col,
            self.sk,
            eff=self.eff,
            disc=self.disc,
            out=self.name,
        )


@dataclass(frozen=True)
class FactSpec:
    """``narrow``: the dated lookups run in one pass over ids, keys and dates (see ``lookup_many``)."""

    pk: str
    pk_cols: list[str]
    event_col: str
    lookups: list[Lookup]
    order: list[Column | str] = field(default_factory=list)
    columns: list[str] | None = None
    rec_src: str | None = None
    now: dt.datetime | None = None
    narrow: bool = False


def _remade(rows: DataFrame, spec: FactSpec) -> bool:
    """Whether the key can be made again from whole numbers that come out of the lookups as they went in."""
    whole = {f.name for f in rows.schema if isinstance(f.dataType, ByteType | ShortType | IntegerType | LongType)}
    read = {c for lk in spec.lookups for c in [*lk.on, lk.date_col]}
    found = {lk.name for lk in spec.lookups}
    plain = spec.columns is not None and not spec.narrow and whole.issuperset(spec.pk_cols)
    return plain and spec.pk not in {*read, *found, *spec.pk_cols} and found.isdisjoint(spec.pk_cols)


def resolve(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """Latest row per key, then every lookup.

    Duplicates go first: no lookup is paid for a row that is dropped later, and no
    lookup repeats a row, so the key stays unique.

    A hash key is wider than the columns it is made of. Where these are whole numbers, it
    is made anew after the lookups instead of being shuffled by them, and rows that don't
    lie by it yet are told apart by its columns (up to two, of which every pair has a text
    of its own). Keys that a lookup has found go through the next ones packed.
    """
    late = _remade(rows, spec)
    keys = spec.pk_cols if late and len(spec.pk_cols) <= 2 and spec.pk not in rows.columns else [spec.pk]
    ties = [F.col(c) for c in rows.columns if c != spec.pk and rows.schema[c].dataType.typeName() not in ("map", "variant")]
    if spec.pk not in rows.columns:
        rows = rows.withColumn(spec.pk, surrogate_key(*spec.pk_cols))
    out = latest_per_key(rows, keys, [*(spec.order or [F.col(spec.event_col).desc()]), *ties])
    dated = [lk for lk in spec.lookups if spec.narrow and lk.date_col is not None]
    if dated:
        looks = [AsOf(lk.dim, lk.on, lk.date_col, lk.sk, lk.name, lk.eff, lk.disc) for lk in dated]
        out = lookup_many(stage_table(out, spec.pk), [spec.pk], looks)
    left = [lk for lk in spec.lookups if lk not in dated]
    short: list[str] = []
    for i, look in enumerate(left):
        if late:
            read = {c for lk in left[i:] for c in [*lk.on, lk.date_col]}
            wanted = {*read, *spec.pk_cols, *spec.columns, *[lk.name for lk in left]}
            out = out.select([c for c in out.columns if c in wanted and c != spec.pk])
        out = look.apply(out)
        rest = {c for lk in left[i + 1 :] for c in [*lk.on, lk.date_col, lk.name]}
        if late and rest and look.name not in rest and out.schema[look.name].dataType == StringType():
            out = out.withColumn(look.name, packed(look.name))
            short.append(look.name)
    if late:
        names = [c for c in out.columns if c != spec.pk]
        out = out.select(surrogate_key(*spec.pk_cols).alias(spec.pk), *[(unpacked(c) if c in short else F.col(c)).alias(c) for c in names])
    if spec.columns is not None:
        out = out.select(spec.pk, *[lk.name for lk in spec.lookups], *spec.columns)
    return stamp(out, spec.rec_src, spec.now) if spec.rec_src is not None else out


def build_fact(
    stage: DataFrame, spec: FactSpec, *, target: DataFrame | None = None, merged: bool = True
) -> DataFrame:
    """Transaction fact; with a target, new and still unresolved events are (re)loaded.

    ``merged=False`` returns only the rows this run would write.
    """
    rows = stage
    if spec.pk in stage.columns or not _remade(stage, spec):
        rows = stage.withColumn(spec.pk, surrogate_key(*spec.pk_cols))
    retried = [lk.name for lk in spec.lookups if lk.retry]
    rows = incremental_facts(rows, target, spec.pk, spec.event_col, retried, pk_cols=spec.pk_cols) if retried else rows
    out = resolve(rows, spec)
    if target is None or not merged:
        return out
    made = tuple({c: None for c in [spec.pk, *[lk.name for lk in spec.lookups]] if c in target.columns})
    return merge_upsert(target, stage_table(out, spec.pk, compression="zstd"), [spec.pk], hashes=made)


def requisition_ids(stage: DataFrame, text_cols: list[str]) -> DataFrame:
    """Ids found in the text columns, and the single one or 'MULTIPLE'."""
    found = stage.withColumns(
        {
            "req_ids": distinct_ids(text_cols, REQUISITION_IDS),
            "pos_ids": distinct_ids(text_cols, POSITION_IDS),
        }
    )
    return found.withColumns(
        {
            "job_req_id": F.when(F.size("req_ids") > 1, "MULTIPLE").otherwise(single_or_null("req_ids")),
            "position_id": F.when(F.size("pos_ids") > 1, "MULTIPLE").otherwise(single_or_null("pos_ids")),
        }
    )


def build_requisition_fact(
    stage: DataFrame,
    dim: DataFrame,
    *,
    pk_cols: list[str],
    event_col: str,
    text_cols: list[str],
    columns: list[str],
    dim_key: str = "job_req_id",
    sk: str = "job_req_sk",
    pk: str = "job_req_event_pk",
    target: DataFrame | None = None,
) -> DataFrame:
    """Fact whose foreign ids are mined from free text: none '-1', several '-2'."""
    keyed = stage.withColumn(pk, surrogate_key(*pk_cols))
    rows = incremental_facts(keyed, target, pk, event_col, [sk])
    latest = latest_per_key(rows, [pk], [F.col(event_col).desc(), *[F.col(c) for c in text_cols]])
    ids = requisition_ids(latest, text_cols)
    found = lookup_sk_multi(ids, dim, "req_ids", dim_key, sk)
    out = found.select(pk, sk, "job_req_id", "position_id", *columns)
    return out if target is None else merge_upsert(target, stage_table(out, pk), [pk])


def payroll_rows(
    stage: DataFrame,
    target: DataFrame | None,
    *,
    pk: str,
    entity: str,
    event_col: str,
    target_entity: str,
    target_event_col: str,
    sk_cols: list[str],
) -> DataFrame:
    """Rows of the three branches, each row once.

    (1) past its entity's own mark, (2) fact still unresolved, (3) entity and
    date not in the target at all. A row of branch 1 or 3 whose entity is known
    is covered by two left joins on small, pre-aggregated sides.
    """
    if target is None:
        return stage
    marks = target.groupBy(F.col(target_entity).alias(entity)).agg(
        F.coalesce(F.max(target_event_col), F.lit("1900-01-01").cast("date")).alias("__mark")
    )
    retry = target.filter(unresolved(target, sk_cols)).select(pk).distinct().withColumn("__retry", F.lit(True))
    # Null-safe: an undated row of a new entity is one that the target doesn't have.
    have = target.select(F.col(target_entity).alias("__e"), F.col(target_event_col).alias("__d")).distinct()
    have = have.withColumn("__present", F.lit(True))
    present = stage[entity].eqNullSafe(have["__e"]) & stage[event_col].eqNullSafe(have["__d"])
    joined = stage.join(have, present, "left").join(marks, entity, "left").join(retry, pk, "left")
    known = F.col("__mark").isNotNull()
    wanted = (known & ((F.col(event_col) >= F.col("__mark")) | F.col("__retry").isNotNull())) | F.col(
        "__present"
    ).isNull()
    return joined.filter(wanted).select(*stage.columns)


def build_payroll_fact(
    stage: DataFrame,
    spec: FactSpec,
    *,
    entity: str,
    target: DataFrame | None = None,
    target_entity: str | None = None,
    target_event_col: str | None = None,
) -> DataFrame:
    """Fact with one watermark per entity, merged on its key."""
    keyed = stage.withColumn(spec.pk, surrogate_key(*spec.pk_cols))
    rows = payroll_rows(
        keyed,
        target,
        pk=spec.pk,
        entity=entity,
        event_col=spec.event_col,
        target_entity=target_entity or entity,
        target_event_col=target_event_col or spec.event_col,
        sk_cols=[lk.name for lk in spec.lookups if lk.retry],
    )
    out = resolve(rows, spec)
    return out if target is None else merge_upsert(target, stage_table(out, spec.pk), [spec.pk])
