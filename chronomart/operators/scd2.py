"""Slowly Changing Dimension Type 2: versions with half-open validity windows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.functions.payload import normalize_op, surrogate_key
from chronomart.operators.ordered import HOT_ROWS, Groups, null_safe_on, per_group


@dataclass(frozen=True)
class Scd2:
    """What a dimension tracks.

    ``tracked``   a change opens a new version; the first one also opens a version
                  whenever its previous value is NULL.
    ``carried``   shown with the version, not watched.
    ``tiebreak``  orders events of equal ``valid_from``; ends with a unique column.
    ``deletes``   ``keep`` treats a delete event like any other, ``drop`` ignores
                  it, ``close`` ends the open version at the delete.
    ``null_safe`` counts a change to or from NULL as a change.
    """

    keys: list[str]
    tracked: list[str]
    carried: list[str] = field(default_factory=list)
    valid_from: str = "valid_from"
    tiebreak: list[str] = field(default_factory=lambda: ["captured_at", "change_id"])
    key_name: str = "version_key"
    deletes: str = "keep"
    null_safe: bool = False
    operation: str = "operation"

    @property
    def order(self) -> list[str]:
        return [self.valid_from, *self.tiebreak]

    @property
    def columns(self) -> list[str]:
        """Columns of the finished dimension."""
        return [self.key_name, *self.keys, *self.carried, *self.tracked, "valid_from", "valid_to", "is_current"]


_GONE = "_gone"
_PREV = "_prev"
_NEXT = "_next"


def _input(events: DataFrame, spec: Scd2) -> DataFrame:
    wanted = list(dict.fromkeys([*spec.keys, *spec.carried, *spec.tracked, *spec.order]))
    if spec.deletes == "keep":
        return events.select(*wanted)
    deleted = F.coalesce(normalize_op(F.col(spec.operation)) == "delete", F.lit(False))
    if spec.deletes == "drop":
        return events.filter(~deleted).select(*wanted)
    if spec.deletes == "close":
        return events.select(*wanted, deleted.alias(_GONE))
    raise ValueError(f"deletes must be keep, drop or close, not {spec.deletes!r}")


def detect_changes(groups: Groups, spec: Scd2) -> Groups:
    """Keeps the first event of a key and every change of a tracked column."""
    return groups.previous(_watched(spec), _PREV).filter(_is_change(spec))


def _watched(spec: Scd2) -> list[str]:
    return spec.tracked + ([_GONE] if spec.deletes == "close" else [])


def _is_change(spec: Scd2) -> Column:
    def prev(column: str) -> Column:
        return F.col(f"{_PREV}_{column}")

    first = F.col(_PREV).isNull()
    if spec.null_safe:
        rules = [first, *[~prev(c).eqNullSafe(F.col(c)) for c in spec.tracked]]
    else:
        rules = [prev(spec.tracked[0]).isNull(), *[prev(c) != F.col(c) for c in spec.tracked]]
    if spec.deletes == "close":
        rules.append(prev(_GONE) != F.col(_GONE))
    change = reduce(lambda a, b: a | b, rules)
    if spec.deletes == "close":
        # A delete only ends the version before it; a second delete says nothing new.
        repeated = F.col(_GONE) & (first | prev(_GONE))
        change = change & ~repeated
    return change


def close_windows(groups: Groups, spec: Scd2) -> Groups:
    """``valid_to`` is the next version's start; the last version stays open."""
    groups = groups.following([spec.valid_from], _NEXT)
    return groups.with_column("valid_to", F.col(f"{_NEXT}_{spec.valid_from}"))


def _shown(spec: Scd2) -> dict[str, Column]:
    """Columns of the finished dimension over the rows of ``close_windows``."""
    start = F.col(spec.valid_from)
    return {
        spec.key_name: surrogate_key([F.col(k) for k in spec.keys], start),
        **{c: F.col(c) for c in [*spec.keys, *spec.carried, *spec.tracked]},
        "valid_from": start,
        "valid_to": F.col("valid_to"),
        "is_current": F.col("valid_to").isNull(),
    }


def _is_shown(spec: Scd2) -> Column:
    return ~F.col(_GONE) if spec.deletes == "close" else F.lit(True)


def finish(df: DataFrame, spec: Scd2) -> DataFrame:
    return df.filter(_is_shown(spec)).select(*[value.alias(name) for name, value in _shown(spec).items()])


def scd2(events: DataFrame, spec: Scd2, hot_rows: int | None = HOT_ROWS, **limits) -> DataFrame:
    """Version history of ``events``: one exchange and one sort on the key."""

    def work(groups: Groups) -> Groups:
        return close_windows(detect_changes(groups, spec), spec)

    return finish(per_group(_input(events, spec), spec.keys, spec.order, work, hot_rows, **limits), spec)


CUSTOMERS = Scd2(
    keys=["customer_id"], tracked=["address", "email"], carried=["name"], key_name="customer_key",
)
PRODUCTS = Scd2(
    keys=["product_id"], tracked=["price", "category"], carried=["name"], key_name="product_key",
)


def dim_customers_scd2(stg_customers: DataFrame, **limits) -> DataFrame:
    return scd2(stg_customers, CUSTOMERS, **limits).select(
        "customer_key", "customer_id", "name", "email", "address", "valid_from", "valid_to", "is_current"
    )


def dim_products_scd2(stg_products: DataFrame, **limits) -> DataFrame:
    return scd2(stg_products, PRODUCTS, **limits).select(
        "product_key", "product_id", "name", "category", "price", "valid_from", "valid_to", "is_current"
    )


def as_of(dim: DataFrame, ts=None) -> DataFrame:
    """The current versions, or those valid at ``ts``."""
    if ts is None:
        return dim.filter("is_current")
    moment = F.lit(ts).cast("timestamp_ntz")
    return dim.filter(
        (F.col("valid_from") <= moment) & ((moment < F.col("valid_to")) | F.col("valid_to").isNull())
    )


def history(dim: DataFrame, key: str, value) -> DataFrame:
    """All versions of one entity, oldest first; the key filter reaches the scan."""
    return dim.filter(F.col(key) == F.lit(value)).orderBy(F.col("valid_from").asc_nulls_last())


def multi_version(dim: DataFrame, keys: list[str]) -> DataFrame:
    """All versions of the entities that have more than one."""
    several = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    return dim.join(several, keys, "left_semi")


def version_delta(
    dim: DataFrame, keys: list[str], column: str, tiebreak: list[str], hot_rows: int | None = HOT_ROWS, **limits
) -> DataFrame:
    """Version number and change of a number against the version before, for every version."""

    def work(groups: Groups) -> Groups:
        return groups.number("version").previous([column], _PREV)

    out = per_group(dim, keys, ["valid_from", *tiebreak], work, hot_rows, **limits)
    before = f"{_PREV}_{column}"
    return out.withColumn("delta", F.col(column) - F.col(before)).drop(_PREV, before)


_SEED = "_seed"
_SINCE = "_since"
_LAST = "_last"
_END_OF_TIME = "9999-12-31 00:00:00"


def touched_keys(new_events: DataFrame, spec: Scd2) -> DataFrame:
    """The keys of new events with the earliest time they change."""
    earliest = F.coalesce(F.min(spec.valid_from), F.lit(_END_OF_TIME).cast("timestamp_ntz"))
    return new_events.groupBy(*spec.keys).agg(earliest.alias(_SINCE))


def update_versions(
    existing: DataFrame, events: DataFrame, touched: DataFrame, spec: Scd2, hot_rows: int | None = HOT_ROWS, **limits
) -> DataFrame:
    """Dimension after new events; ``events`` holds all of them, ``touched`` comes from ``touched_keys``.

    Whether an event opens a version depends on the event before it and on nothing
    earlier. So a touched key is rebuilt from its earliest change on, seeded with
    the one event before that. Older versions stay; the last of them travels with
    the seed and gets its end there. Late events land where their time puts them.
    """
    names = {k: f"_r{i}" for i, k in enumerate(spec.keys)}
    since = touched.select(*[F.col(k).alias(n) for k, n in names.items()], _SINCE)

    def with_since(df: DataFrame, how: str) -> DataFrame:
        return df.join(since, null_safe_on(df, since, list(names.items())), how).drop(*names.values())

    old = with_since(existing.select(*spec.columns), "left")
    known, start, end = F.col(_SINCE).isNotNull(), F.col("valid_from"), F.col("valid_to")
    before = known & F.coalesce(start < F.col(_SINCE), F.lit(False))
    is_last = before & (end.isNull() | (end >= F.col(_SINCE)))
    kept = old.filter(~known | (before & ~is_last)).select(*spec.columns)
    shown = [c for c in spec.columns if c not in ("valid_to", "is_current")]
    last = old.filter(is_last).select(
        *[F.col(k).alias(f"_l{i}") for i, k in enumerate(spec.keys)], F.struct(*shown).alias(_LAST)
    )

    rows = with_since(_input(events, spec), "inner")
    at = F.col(spec.valid_from)
    tail = rows.filter(at.isNull() | (at >= F.col(_SINCE))).drop(_SINCE).withColumn(_SEED, F.lit(False))
    # The reverse of the version order; the rank limit runs before the exchange.
    newest = Window.partitionBy(*spec.keys).orderBy(*[F.col(c).desc_nulls_first() for c in spec.order])
    seeds = rows.filter(at < F.col(_SINCE)).drop(_SINCE)
    seeds = seeds.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    on_last = null_safe_on(seeds, last, [(k, f"_l{i}") for i, k in enumerate(spec.keys)])
    seeds = seeds.join(last, on_last, "left").drop(*[f"_l{i}" for i in range(len(spec.keys))])
    seeds = seeds.withColumn(_SEED, F.lit(True))

    def work(groups: Groups) -> Groups:
        groups = groups.previous(_watched(spec), _PREV)
        return close_windows(groups.filter(F.col(_SEED) | _is_change(spec)), spec)

    rebuilt = per_group(
        tail.unionByName(seeds, allowMissingColumns=True), spec.keys, spec.order, work, hot_rows, **limits
    )
    seed, stored = F.col(_SEED), F.col(_LAST)
    columns = {
        c: F.when(seed, stored[c]).otherwise(value) if c in shown else value for c, value in _shown(spec).items()
    }
    new = rebuilt.filter(F.when(seed, stored.isNotNull()).otherwise(_is_shown(spec)))
    return kept.unionByName(new.select(*[value.alias(c) for c, value in columns.items()]))


def scd2_update(
    existing: DataFrame, past_events: DataFrame, new_events: DataFrame, spec: Scd2, **limits
) -> DataFrame:
    """Incremental form of ``scd2``; equals the full build over past and new events."""
    columns = [c for c in past_events.columns if c in new_events.columns]
    events = past_events.select(*columns).unionByName(new_events.select(*columns))
    return update_versions(existing, events, touched_keys(new_events, spec), spec, **limits)
