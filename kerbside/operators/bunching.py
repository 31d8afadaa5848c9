"""Bus bunching: two buses of one route that stay close to each other for minutes.

Time is cut into slices as wide as the staleness bound. A position can then only be compared with
positions of its own slice or with the other bus's last one of the slice before, so the rows of a bus in
a slice plus one carried row are all that a comparison in that slice can need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kerbside.functions.clock import epoch_ms, time_block
from kerbside.functions.geo import earth_xyz, haversine_m
from kerbside.operators.staging import staged

# Closer than this is bunched, after this long it is reported, and a bus not heard of
# for longer than this is left out of the comparison.
NEAR_METRES = 200.0
HOLD_MS = 300_000
STALE_MS = 180_000

_BUS = ["route_id", "bus_id"]
_PAIR = ["route_id", "bus_a", "bus_b"]


def bus_bunching(
    gps: DataFrame,
    metres: float = NEAR_METRES,
    hold_ms: int = HOLD_MS,
    stale_ms: int = STALE_MS,
    id_col: str = "event_id",
    stage_rows: bool = False,
) -> DataFrame:
    """Alerts (route_id, bus_id_1, bus_id_2, distance_meters, ms, event id), ``bus_id_1`` the one that moved.

    Every position is compared with the last known position of the route's other buses, unless that is
    older than ``stale_ms``. A pair's streak starts at its first close comparison and ends at the first
    far one; it alerts once, at the first close comparison ``hold_ms`` or more after its start. Silence
    does not end a streak.

    Buses are paired only in the slices in which they come near each other, and in the slice after, to see
    whether they parted. Their stretches of closeness are chained over the slices; the few slices in which a
    chain grows ``hold_ms`` long are compared once more, to find the very row. The stretches and those slices
    are staged in the shared folder. ``stage_rows`` stages the positions too; they are read several times, so
    that pays when they are decoded or computed rather than read from a columnar table.
    """
    rows = _rows(gps, stale_ms, id_col)
    rows = staged(rows) if stage_rows else rows
    alerting = staged(_alerting_slices(_all_stretches(rows, metres, stale_ms), hold_ms))

    in_play = F.explode(F.array(F.col("slice") - 1, F.col("slice"))).alias("slice")
    needed = _both_buses(alerting).select(*_BUS, in_play).distinct()
    again = _with_carried(rows.join(needed, [*_BUS, "slice"], "left_semi"))
    return _alerts(_comparisons(again, alerting, metres, stale_ms), hold_ms, id_col)


def contact_intervals(
    gps: DataFrame,
    metres: float = NEAR_METRES,
    stale_ms: int = STALE_MS,
    id_col: str = "event_id",
    stage_rows: bool = False,
) -> DataFrame:
    """How long two buses of a route stayed close: (route_id, bus_id_1, bus_id_2, from_ms, to_ms, comparisons,
    closest_meters), ``bus_id_1`` the smaller id.

    An interval reaches from the first to the last of a pair's close comparisons with no far one in between;
    silence does not end it. The output is as large as the intervals, however often their buses report.
    """
    rows = _rows(gps, stale_ms, id_col)
    rows = staged(rows) if stage_rows else rows
    inner, edges = _all_stretches(rows, metres, stale_ms)
    measured = [
        F.min("since").alias("from_ms"), F.max("to").alias("to_ms"), F.sum("n").alias("comparisons"),
        F.min("closest").alias("closest_meters"),
    ]
    across = edges.groupBy(*_PAIR, "run").agg(*measured).where("from_ms IS NOT NULL")
    within = inner.select(
        *_PAIR, F.col("since").alias("from_ms"), F.col("to").alias("to_ms"), F.col("n").alias("comparisons"),
        F.col("closest").alias("closest_meters"),
    )
    return across.drop("run").unionByName(within).withColumnsRenamed({"bus_a": "bus_id_1", "bus_b": "bus_id_2"})


def close_contacts(
    gps: DataFrame,
    metres: float = NEAR_METRES,
    stale_ms: int = STALE_MS,
    id_col: str = "event_id",
    stage_rows: bool = False,
) -> DataFrame:
    """Each position within ``metres`` of another bus's last known position on the same route."""
    rows = _rows(gps, stale_ms, id_col)
    rows = staged(rows) if stage_rows else rows
    found = _comparisons(_with_carried(rows), _near_pairs(rows, metres, stale_ms), metres, stale_ms)
    return _named(found.where("close"), id_col)


def _named(compared: DataFrame, id_col: str) -> DataFrame:
    return compared.select(
        "route_id",
        F.col("bus_id").alias("bus_id_1"),
        F.col("other_bus").alias("bus_id_2"),
        F.col("distance").alias("distance_meters"),
        "ms",
        F.col("id").alias(id_col),
    )


def _rows(gps: DataFrame, stale_ms: int, id_col: str) -> DataFrame:
    rows = gps.select(
        *_BUS, epoch_ms(gps).alias("ms"), F.col(id_col).alias("id"), "lat", "lon"
    ).dropna(subset=[*_BUS, "ms", "lat", "lon"])
    return rows.withColumn("slice", time_block(F.col("ms"), stale_ms))


def _with_carried(rows: DataFrame) -> DataFrame:
    """Rows plus, in each slice, the bus's last row of the slice before (``own`` false)."""
    last = F.max_by(F.struct("ms", "id", "lat", "lon"), F.struct("ms", "id")).alias("last")
    carried = rows.groupBy(*_BUS, "slice").agg(last).select(
        *_BUS, "last.*", (F.col("slice") + 1).alias("slice"), F.lit(False).alias("own")
    )
    return rows.withColumn("own", F.lit(True)).unionByName(carried)


def _both_buses(pairs: DataFrame) -> DataFrame:
    """Two rows per pair, one for either bus as ``bus_id``."""
    return pairs.withColumn("bus_id", F.explode(F.array("bus_a", "bus_b")))


def _near_pairs(rows: DataFrame, metres: float, stale_ms: int) -> DataFrame:
    """(pair, slice) whose buses may have come within ``metres``: a superset, found by cell.

    Slices are too long to meet in, since a bus drives on for minutes; buses meet in steps of a slice. The
    positions a bus can be compared at in a step are its own there and the last one before. The smaller bus
    offers every cell that a ball of the radius around them touches, the larger bus the cells they lie in.
    Positions are reduced to distinct cells per bus and step before they meet, so a bus that reports a lot
    weighs no more than one that reports little.
    """
    steps = 6 if stale_ms % 6 == 0 else 1
    side, slack = 4 * metres, metres * 1.001 + 0.01
    cells, measures = [], []
    for i, axis in enumerate(earth_xyz(F.col("lat"), F.col("lon"))):
        for name, value in ((f"c{i}", axis), (f"l{i}", axis - slack), (f"h{i}", axis + slack)):
            cells.append(name)
            measures.append(F.floor(value / side).alias(name))
    placed = rows.select(*_BUS, "ms", "id", time_block(F.col("ms"), stale_ms // steps).alias("step"), *measures)
    order = F.struct("ms", "id")
    last = placed.groupBy(*_BUS, "step").agg(F.max_by(F.struct("ms", "id", *cells), order).alias("p"))
    later = F.explode(F.sequence(F.col("step") + 1, F.col("step") + steps)).alias("step")
    carried = last.select(*_BUS, later, "p.*").groupBy(*_BUS, "step").agg(
        F.max_by(F.struct(*cells), order).alias("p")
    )
    reached = placed.select(*_BUS, "step", *cells).unionByName(carried.select(*_BUS, "step", "p.*")).distinct()
    own = reached.select("route_id", "step", F.col("bus_id").alias("bus_b"), "c0", "c1", "c2")
    ball = reached.select("route_id", "step", F.col("bus_id").alias("bus_a"), "l0", "h0", "l1", "h1", "l2", "h2")
    for i in range(3):
        ball = ball.withColumn(f"c{i}", F.explode(F.sequence(f"l{i}", f"h{i}"))).drop(f"l{i}", f"h{i}")
    meet = ball.join(own, ["route_id", "step", "c0", "c1", "c2"]).where("bus_a < bus_b")
    return meet.select(*_PAIR, F.floor(F.col("step") / steps).alias("slice")).distinct()


def _comparisons(placed: DataFrame, pairs: DataFrame, metres: float, stale_ms: int) -> DataFrame:
    """Each position of a pair against the other bus's last known one, within the given slices.

    Columns of ``pairs`` beyond pair and slice are carried along. ``streak`` numbers the runs of close
    comparisons in a slice: it grows by one at every separation.
    """
    extra = [c for c in pairs.columns if c not in (*_PAIR, "slice")]
    rows = placed.join(_both_buses(pairs), [*_BUS, "slice"])
    so_far = (
        Window.partitionBy(*_PAIR, "slice").orderBy("ms", "id").rowsBetween(Window.unboundedPreceding, 0)
    )
    position = F.struct("ms", "lat", "lon")
    is_a = F.col("bus_id") == F.col("bus_a")
    paired = rows.select(
        "*",
        F.last(F.when(is_a, position), ignorenulls=True).over(so_far).alias("pos_a"),
        F.last(F.when(~is_a, position), ignorenulls=True).over(so_far).alias("pos_b"),
    )
    return (
        paired.withColumn("other", F.when(is_a, F.col("pos_b")).otherwise(F.col("pos_a")))
        .where(F.col("own") & F.col("other").isNotNull() & (F.col("ms") - F.col("other.ms") <= stale_ms))
        .select(
            *_PAIR, "slice", "ms", "id", "bus_id",
            F.when(is_a, F.col("bus_b")).otherwise(F.col("bus_a")).alias("other_bus"),
            haversine_m(F.col("lat"), F.col("lon"), F.col("other.lat"), F.col("other.lon")).alias("distance"),
            *extra,
        )
        .withColumn("close", F.col("distance") <= metres)
        .withColumn("streak", F.sum(F.when(F.col("close"), 0).otherwise(1)).over(so_far))
    )


def _all_stretches(rows: DataFrame, metres: float, stale_ms: int) -> tuple[DataFrame, DataFrame]:
    """Stretches of close comparisons: those within one slice, and those at slice ends, chained as ``run``."""
    near = _near_pairs(rows, metres, stale_ms)
    looked_at = near.select(*_PAIR, F.explode(F.array(F.col("slice"), F.col("slice") + 1)).alias("slice")).distinct()
    found = staged(_stretches(_comparisons(_with_carried(rows), looked_at, metres, stale_ms)))
    at_end = (F.col("streak") == 0) | F.col("last")
    edges = found.where(at_end)
    apart = _separations_in_silence(rows, edges, stale_ms)
    by_slice = Window.partitionBy(*_PAIR).orderBy("slice", "streak").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("streak") > 0, 1).otherwise(0)
    chained = edges.unionByName(apart, allowMissingColumns=True).withColumn("run", F.sum(opened).over(by_slice))
    return found.where(~at_end & F.col("since").isNotNull()), chained


def _stretches(compared: DataFrame) -> DataFrame:
    """Per (pair, slice) and run of close comparisons its ends, size and least distance.

    The run numbered 0 continues what the slices before left open. Each later one follows a separation, and is
    empty (``since`` NULL) if the next comparison was a far one too; of a slice's empty runs only its last stays.
    """
    close = F.col("close")
    runs = compared.groupBy(*_PAIR, "slice", "streak").agg(
        F.min(F.when(close, F.col("ms"))).alias("since"),
        F.max(F.when(close, F.col("ms"))).alias("to"),
        F.count_if(close).alias("n"),
        F.min(F.when(close, F.col("distance"))).alias("closest"),
    )
    in_slice = Window.partitionBy(*_PAIR, "slice")
    ended = runs.withColumn("last", F.col("streak") == F.max("streak").over(in_slice))
    return ended.where(F.col("last") | F.col("since").isNotNull())


def _separations_in_silence(rows: DataFrame, edges: DataFrame, stale_ms: int) -> DataFrame:
    """One empty run for slices in which a pair was seen apart after it was left close and fell silent.

    Normally the slice right after a close comparison, which has been looked at, shows how it went on. Where
    that slice holds no comparison, one of the buses has gone silent, and the pair's next comparison falls into
    a slice in which one of the two reports after a silence longer than the staleness bound; those slices, up to
    the next one that was looked at and holds a comparison, are looked at here. Buses and gaps meet by block of
    slices, so a gap meets the reports of its own time only.
    """
    block = 32
    by_slice = Window.partitionBy(*_PAIR).orderBy("slice", "streak")
    gaps = (
        edges.withColumn("until", F.lead("slice").over(by_slice))
        .where(F.col("last") & F.col("to").isNotNull() & (F.col("until") > F.col("slice") + 2))
        .select(*_PAIR, F.col("slice").alias("after"), "until")
    )
    members = _both_buses(gaps)
    seen = (
        rows.join(members.select(*_BUS).distinct(), _BUS, "left_semi")
        .groupBy(*_BUS, "slice")
        .agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))
    )
    missing = F.lit(None).cast("long")
    # Per bus and slice: its first row, and its last one of the slice before.
    around = (
        seen.select(*_BUS, "slice", "first_ms", missing.alias("before_ms"))
        .unionByName(seen.select(
            *_BUS, (F.col("slice") + 1).alias("slice"), missing.alias("first_ms"), F.col("last_ms").alias("before_ms")
        ))
        .groupBy(*_BUS, "slice")
        .agg(F.max("first_ms").alias("first_ms"), F.max("before_ms").alias("before_ms"))
    )
    after_silence = F.col("before_ms").isNull() | (F.col("first_ms") - F.col("before_ms") > stale_ms)
    blocks = F.sequence(F.floor((F.col("after") + 2) / block), F.floor((F.col("until") - 1) / block))
    probes = (
        members.withColumn("block", F.explode(blocks))
        .join(
            around.where(F.col("first_ms").isNotNull() & after_silence)
            .select(*_BUS, "slice", F.floor(F.col("slice") / block).alias("block")),
            [*_BUS, "block"],
        )
        .where((F.col("slice") > F.col("after") + 1) & (F.col("slice") < F.col("until")))
        .select(*_PAIR, "slice")
        .distinct()
    )
    is_a = F.col("bus_id") == F.col("bus_a")
    sides = _both_buses(probes).join(around, [*_BUS, "slice"]).groupBy(*_PAIR, "slice").agg(
        *[
            F.max(F.when(test, F.col(f"{what}_ms"))).alias(f"{what}_{tag}")
            for what in ("first", "before")
            for tag, test in (("a", is_a), ("b", ~is_a))
        ]
    )
    # Two buses seen in one slice are compared at the later one's first row; a bus seen alone is compared
    # if its first row is fresh against the other's last row of the slice before.
    compared = (
        (F.col("first_a").isNotNull() & F.col("first_b").isNotNull())
        | (F.col("first_a") - F.col("before_b") <= stale_ms)
        | (F.col("first_b") - F.col("before_a") <= stale_ms)
    )
    return sides.where(compared).select(*_PAIR, "slice", F.lit(1).cast("long").alias("streak"))


def _alerting_slices(stretches: tuple[DataFrame, DataFrame], hold_ms: int) -> DataFrame:
    """Slices that hold an alert, with the run that each one continues: its start and its last row."""
    inner, edges = stretches
    before = Window.partitionBy(*_PAIR, "run").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("since_in", F.min("since").over(before)).withColumn("last_in", F.max("to").over(before))
    not_yet = F.col("last_in").isNull() | (F.col("last_in") - F.col("since_in") < hold_ms)
    due = not_yet & (F.col("to") - F.coalesce("since_in", "since") >= hold_ms)
    held = inner.where(F.col("to") - F.col("since") >= hold_ms).select(*_PAIR, "slice", F.lit(True).alias("due"))
    continued = F.col("streak") == 0
    return (
        edges.withColumn("due", due)
        .unionByName(held, allowMissingColumns=True)
        .groupBy(*_PAIR, "slice")
        .agg(
            F.max(F.when(continued, F.col("since_in"))).alias("since_in"),
            F.max(F.when(continued, F.col("last_in"))).alias("last_in"),
            F.bool_or("due").alias("due"),
        )
        .where("due")
        .drop("due")
    )


def _alerts(compared: DataFrame, hold_ms: int, id_col: str) -> DataFrame:
    """The alerting rows of the given slices."""
    streak = Window.partitionBy(*_PAIR, "slice", "streak").orderBy("ms", "id")
    continues = F.col("streak") == 0
    start = F.min("ms").over(streak.rowsBetween(Window.unboundedPreceding, 0))
    before = F.lag("ms").over(streak)
    found = (
        compared.where("close")
        .withColumn("since", F.when(continues, F.coalesce("since_in", start)).otherwise(start))
        .withColumn("previous", F.when(continues, F.coalesce(before, "last_in")).otherwise(before))
        .where(
            (F.col("ms") - F.col("since") >= hold_ms)
            & (F.col("previous").isNull() | (F.col("previous") - F.col("since") < hold_ms))
        )
    )
    return _named(found, id_col)
