"""Sums over a trailing time range, without a task per product and without sliding frames.

A RANGE window partitioned by product has two costs at scale: a hot product sits in one task, and every
frame is summed anew. Here the rows are first totalled per (product, instant), and each range is put
together from three pieces that only need running sums inside one (product, day):

    tail of the first day  +  whole days between  +  head of the last day

The task unit is a product's day, the day totals of a product are bounded by the calendar, and all
pieces are added, never subtracted, so no precision is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from premia.functions.dates import whole_second
from premia.operators.groups import attach


GRAINS = ("second", "day")


def trailing_totals(
    instants: DataFrame,
    keys: Sequence[str],
    days: int,
    probes: DataFrame | None = None,
    from_midnight: bool = False,
    grain: str = "second",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Totals over ``[at - days, at]``, both ends included, at every probe instant.

    ``instants`` has one row per (keys, ``at``) with ``total`` and ``n``. ``probes`` has (keys, ``at``)
    without repeats; by default the instants themselves. ``from_midnight`` starts the range at midnight
    of its first day. ``grain="day"`` declares that all instants are midnights, which needs no head and
    tail; an instant that is none fails the job. Returns keys, ``at``, ``total``, ``n`` and the probes'
    ``carry`` columns; a probe with nothing in range has n = 0.
    """
    if days < 1:
        raise ValueError("a trailing range spans at least one day")
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    keys = list(keys)
    if grain == "day":
        return _over_days(instants, keys, days, probes, carry)
    return _over_instants(instants, keys, days, probes, from_midnight, carry)


def _over_days(
    instants: DataFrame,
    keys: list[str],
    days: int,
    probes: DataFrame | None,
    carry: Sequence[str],
) -> DataFrame:
    """All instants are midnights: a frame of at most ``days`` + 1 rows over the product's days."""
    checked = _midnight(F.col("at"))
    frame = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-days, 0)
    timeline = instants.select(*keys, "at", "total", "n", checked.alias("_day"))
    if probes is not None:
        asked = probes.select(
            *keys, "at", *carry, checked.alias("_day"), F.lit(True).alias("_probe")
        )
        timeline = timeline.withColumn("_probe", F.lit(False)).unionByName(
            asked, allowMissingColumns=True
        )
    summed = timeline.withColumns(
        {"total": F.sum("total").over(frame), "n": F.coalesce(F.sum("n").over(frame), F.lit(0))}
    )
    if probes is not None:
        summed = summed.where("_probe")
    return summed.select(*keys, "at", "total", "n", *carry)


def _midnight(at: Column) -> Column:
    """The instant as a day number; one that is no midnight fails the job."""
    day = F.to_date(at)
    off_grid = F.raise_error(F.concat(F.lit("not a midnight: "), at.cast("string")))
    return F.when(at == day, F.unix_date(day)).otherwise(off_grid.cast("int"))


def trailing_frame(keys: Sequence[str], at: Column, days: int, grain: str = "second") -> WindowSpec:
    """``[at - days, at]``, both ends included, as a frame over the rows themselves, ``at`` in whole seconds.

    Only for keys with few rows: all of them meet in one task, and each frame is summed anew. A row without an instant is in no
    frame but that of its like. ``grain`` as in ``trailing_totals``.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    if grain == "day":
        place, width = F.when(at.isNotNull(), _midnight(at)), days
    else:
        place, width = F.unix_seconds(at.cast("timestamp")), days * 86_400
    return Window.partitionBy(*keys).orderBy(place).rangeBetween(-width, 0)


def _over_instants(
    instants: DataFrame,
    keys: list[str],
    days: int,
    probes: DataFrame | None,
    from_midnight: bool,
    carry: Sequence[str],
) -> DataFrame:
    """Tail of the first day + whole days between + head of the last day."""
    no_total, no_n = F.lit(None).cast("double"), F.lit(None).cast("long")
    total, n = F.col("total"), F.col("n")
    by_day = instants.withColumn("_day", F.to_date("at"))

    def layer(rows: DataFrame, at: Column, head: tuple, tail: tuple, probe: bool) -> DataFrame:
        return rows.select(
            *keys,
            F.to_date(at).alias("_day"),
            at.alias("at"),
            head[0].alias("_head"),
            head[1].alias("_head_n"),
            tail[0].alias("_tail"),
            tail[1].alias("_tail_n"),
            F.lit(probe).alias("_probe"),
            *(carry if probe else ()),
        )

    at = F.col("at")
    timeline = layer(instants, at, (total, n), (no_total, no_n), probes is None)
    if probes is not None:
        asked = layer(probes, at, (no_total, no_n), (no_total, no_n), True)
        timeline = timeline.unionByName(asked, allowMissingColumns=True)
    if not from_midnight:
        aged = at + F.make_dt_interval(F.lit(days))
        older = layer(instants, aged, (no_total, no_n), (total, n), False)
        timeline = timeline.unionByName(older, allowMissingColumns=True)

    one_day = Window.partitionBy(*keys, "_day")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    upward = one_day.orderBy("at").rangeBetween(*so_far)
    downward = one_day.orderBy(F.col("at").desc()).rangeBetween(*so_far)
    summed = timeline.withColumns({c: F.sum(c).over(upward) for c in ("_head", "_head_n")})
    if not from_midnight:
        summed = summed.withColumns({c: F.sum(c).over(downward) for c in ("_tail", "_tail_n")})

    # Whole days between: one row per (keys, day), so a frame is a few rows wide.
    day_totals = by_day.select(*keys, "_day", "total", "n")
    if probes is not None:
        asked = probes.select(*keys, F.to_date("at").alias("_day"))
        day_totals = day_totals.unionByName(asked, allowMissingColumns=True)
    day_totals = day_totals.groupBy(*keys, "_day").agg(
        F.sum("total").alias("_mid"), F.sum("n").alias("_mid_n")
    )
    first = -days if from_midnight else 1 - days
    between = Window.partitionBy(*keys).orderBy(F.unix_date("_day")).rangeBetween(first, -1)
    inner = {c: F.sum(c).over(between) if first < 0 else F.lit(None) for c in ("_mid", "_mid_n")}
    day_totals = day_totals.withColumns(inner)

    # Both sides are already shuffled by (keys, day) or small: the join adds no shuffle of the timeline.
    pieces = summed.where("_probe").join(day_totals, [*keys, "_day"], "left")
    none = F.lit(0)
    return pieces.select(
        *keys,
        "at",
        (
            F.coalesce("_tail", none) + F.coalesce("_mid", none) + F.coalesce("_head", none)
        ).alias("total"),
        (
            F.coalesce("_tail_n", none) + F.coalesce("_mid_n", none) + F.coalesce("_head_n", none)
        ).alias("n"),
        *carry,
    )


def instant_totals(rows: DataFrame, keys: Sequence[str], at: Column, value: str) -> DataFrame:
    """Rows totalled per (keys, instant): the input of ``trailing_totals``. Rows without a key or an
    instant belong to no timeline."""
    return (
        rows.withColumn("at", at)
        .dropna(subset=["at", *keys])
        .groupBy(*keys, "at")
        .agg(F.sum(F.col(value).cast("double")).alias("total"), F.count(value).alias("n"))
    )


def trailing_mean(
    rows: DataFrame,
    keys: Sequence[str],
    instant: str,
    value: str,
    days: int,
    name: str,
    grain: str = "second",
) -> DataFrame:
    """Per (keys, ``at``): the mean over the last ``days`` days, in whole seconds, peers included."""
    instants = instant_totals(rows, keys, whole_second(F.col(instant)), value)
    totals = trailing_totals(instants, keys, days, grain=grain)
    return totals.select(*keys, "at", F.try_divide("total", "n").alias(name))


def attach_trailing_mean(
    rows: DataFrame,
    keys: Sequence[str],
    instant: str,
    value: str,
    days: int,
    name: str,
    grain: str = "second",
) -> DataFrame:
    """Every row plus its trailing mean."""
    means = trailing_mean(rows, keys, instant, value, days, name, grain)
    stamped = rows.withColumn("at", whole_second(F.col(instant)))
    return attach(stamped, means, [*keys, "at"]).drop("at")


def history_days(instant: Column, first: Column) -> Column:
    """Calendar days since the first instant of the group."""
    return F.datediff(instant, first)


def only_with_history(value: Column, history: Column, days: int) -> Column:
    """The value where the group has at least ``days`` days of history, else NULL."""
    return F.when(history >= days, value)


def matches_before_event(
    signals: DataFrame,
    events: DataFrame,
    key: str,
    signal_at: str,
    event_at: str,
    days: int,
) -> DataFrame:
    """Signal rows in ``[midnight of the event day - days, event]``, one output row per match.

    Each event is spread over its days, which makes the range an equality on (key, day): no pair is
    formed whose signal lies outside the event's days.
    """
    spread = events.withColumn(
        "_day",
        F.explode(
            F.sequence(F.date_sub(F.to_date(event_at), days), F.to_date(F.col(event_at)))
        ),
    )
    by_day = signals.withColumn("_day", F.to_date(signal_at))
    return by_day.join(spread, [key, "_day"]).where(F.col(signal_at) <= F.col(event_at)).drop("_day")


def signal_totals_before_events(
    signals: DataFrame,
    events: DataFrame,
    key: str,
    signal_at: str,
    event_at: str,
    value: str,
    days: int,
    grain: str = "second",
) -> DataFrame:
    """Per (key, event instant): ``copies`` of the event and ``total`` and ``n`` of its signals.

    Works on totals, so events with many signals and repeated events never form pairs.
    """
    instants = instant_totals(signals, [key], F.col(signal_at), value)
    copies = (
        events.where(F.col(event_at).isNotNull())
        .groupBy(key, F.col(event_at).alias("at"))
        .agg(F.count("*").alias("copies"))
    )
    totals = trailing_totals(
        instants, [key], days, copies, from_midnight=True, grain=grain, carry=["copies"]
    )
    return totals.where("n > 0")


def mean_signal_before_events(
    signals: DataFrame,
    events: DataFrame,
    key: str,
    signal_at: str,
    event_at: str,
    value: str,
    days: int,
    name: str,
    grain: str = "second",
) -> DataFrame:
    """Per key: the mean signal before its events. A signal counts once per event that covers it."""
    totals = signal_totals_before_events(
        signals, events, key, signal_at, event_at, value, days, grain
    )
    mean = F.try_divide(F.sum(F.col("total") * F.col("copies")), F.sum(F.col("n") * F.col("copies")))
    return totals.groupBy(key).agg(mean.alias(name))
