"""Order-dependent work split so that no task holds a whole large group.

A window over one user sorts all of that user's rows in one task. Users above a
row limit are therefore cut into slices of consecutive ``row_id``; windows run
inside a slice, and what came before the slice is carried in from per-slice
summaries, which are aggregated map-side from the same rows. Slices hold about as many
rows as they may, however a user's ids lie among those of the others: rows are counted
per user and range of ids, and running counts tell where the slices end.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.sources.tables import materialize

SLICE = "_slice"
RANGE = "_range"
BEFORE = "rows between unbounded preceding and 1 preceding"
UP_TO_HERE = "rows between unbounded preceding and current row"


@dataclass(frozen=True)
class SliceLimits:
    """When a user is cut into slices, and how long a slice may be.

    A user is heavy above ``min_rows`` rows and above a ``1 / max_users`` share
    of the log, so there are always fewer than ``max_users`` heavy users and the
    list can be broadcast whatever the size of the log. A slice never holds more than
    ``slice_rows`` rows, and only the last of a user less than three quarters of that (for limits
    of eight rows and more). ``row_id`` must be unique.
    """

    min_rows: int = 1_000_000
    max_users: int = 100_000
    slice_rows: int = 1_000_000

    def __post_init__(self):
        if not 0 < self.max_users <= 1_000_000:
            raise ValueError("max_users bounds a broadcast: choose 1 to 1000000")
        if self.slice_rows < 1:
            raise ValueError("slice_rows must be positive")


DEFAULT_LIMITS = SliceLimits()


def window(keys: Sequence[str], order: str, frame: str = "") -> str:
    """The text of a window; without keys, one group."""
    partition = f"partition by {', '.join(keys)} " if keys else ""
    return f"({partition}order by {order} {frame})"


def heavy_users(log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS) -> DataFrame:
    """Users whose windows must be sliced, fewer than ``limits.max_users``: ``user_id``, ``rows``
    and the lowest and highest ``row_id`` as ``low`` and ``high``."""
    counts = log.groupBy("user_id").agg(
        F.expr("count(*) as rows"), F.expr("min(row_id) as low"), F.expr("max(row_id) as high")
    )
    total = counts.agg(F.expr("sum(rows) as total"))
    return (
        counts.crossJoin(F.broadcast(total))
        .where(f"rows > {limits.min_rows} and rows * bigint({limits.max_users}) > total")
        .drop("total")
    )


def split_heavy(
    log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS
) -> tuple[DataFrame, DataFrame | None]:
    """The log as (ordinary users' rows, heavy users' rows with a slice number).

    The second is None where no user is heavy: the plan is then the plain one. Otherwise it
    is a written table: the log is read for the users' counts, for that table and for the
    ordinary rows, three times in all.
    """
    heavy = materialize(heavy_users(log, limits), "heavy-users")
    if heavy.isEmpty():
        return log, None
    ordinary = log.join(F.broadcast(heavy.select("user_id")), "user_id", "left_anti")
    return ordinary, sliced_rows(log, heavy, limits.slice_rows)


def sliced_rows(log: DataFrame, heavy: DataFrame, slice_rows: int) -> DataFrame:
    """The rows of heavy users with their slice, written.

    A user's ids are divided into equal ranges, so many that one holds an eighth of a
    slice if the ids lie evenly; a range with more than that is divided into ranges of so many
    ids. Counts per range are all that is ordered.
    """
    most = max(1, slice_rows // 8)
    columns = log.columns
    # Twice over rows / most ranges of a user at most, and no more than it has rows.
    width = f"greatest(1L, bigint(double(high - low + 1) * {most} / rows))"
    placed = log.join(F.broadcast(heavy), "user_id").selectExpr(
        *columns, f"(row_id - low) div {width} as _coarse", f"(row_id - low) div {most} as _fine"
    )
    placed = materialize(placed, "heavy-rows")
    counts = materialize(
        placed.groupBy("user_id", "_coarse").agg(F.expr("count(*) as rows")), "id-ranges"
    )
    crowded = counts.where(f"rows > {most}").select("user_id", "_coarse")
    fine = F.lit(-1).cast("bigint").alias("_part")
    ranges = counts.where(f"rows <= {most}").select("user_id", "_coarse", fine, "rows")
    rows = placed.withColumn("_part", fine)
    if not crowded.isEmpty():
        marked = placed.join(crowded.withColumn("_crowded", F.lit(True)), ["user_id", "_coarse"], "left")
        rows = marked.withColumn("_part", F.expr("if(_crowded, _fine, -1L)")).drop("_crowded")
        divided = rows.where("_part >= 0").groupBy("user_id", "_coarse", "_part")
        ranges = ranges.unionByName(divided.agg(F.expr("count(*) as rows")))
    before = window(["user_id"], "_coarse, _part", BEFORE)
    slices = ranges.selectExpr(
        "user_id",
        "_coarse",
        "_part",
        # No range is cut, so a slice may take in one more range than it should end with.
        f"coalesce(sum(rows) over {before}, 0) div {max(1, slice_rows - most + 1)} as {SLICE}",
    )
    slices = materialize(slices, "slices")
    labelled = rows.join(slices, ["user_id", "_coarse", "_part"])
    return materialize(labelled.select(*columns, SLICE), "sliced-rows")


def carried_sums(
    rows: DataFrame, keys: Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """Per (keys, slice): each sum over all earlier slices of the same keys."""
    per_slice = rows.groupBy(*keys, SLICE).agg(
        *[F.expr(f"{total} as {name}") for name, total in sums.items()]
    )
    before = window(keys, SLICE, BEFORE)
    return per_slice.selectExpr(
        *keys, SLICE, *[f"coalesce(sum({n}) over {before}, 0) as {n}" for n in sums]
    )


def carried_tail(
    rows: DataFrame, key: str, columns: Sequence[str], depth: int, name: str
) -> DataFrame:
    """Per (key, slice): the last ``depth`` rows before the slice, latest first.

    The rank filter keeps at most ``depth`` rows per slice and map task before
    the shuffle, so the collected lists are never longer than ``depth``.
    """
    rank = f"row_number() over {window([key, SLICE], 'row_id desc')} as _rank"
    tails = (
        rows.selectExpr(key, SLICE, *columns, rank)
        .where(f"_rank <= {depth}")
        .groupBy(key, SLICE)
        .agg(
            F.expr(f"array_sort(collect_list(struct(_rank, {', '.join(columns)}))) as _tail")
        )
    )
    # Each slice here holds at least one row, so the last `depth` rows lie in
    # the previous `depth` slices.
    by_slice = window([key], SLICE)
    previous = ", ".join(
        f"coalesce(lag(_tail, {k}) over {by_slice}, slice(_tail, 1, 0))"
        for k in range(1, depth + 1)
    )
    return tails.selectExpr(key, SLICE, f"slice(concat({previous}), 1, {depth}) as {name}")


def running_totals(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """``before_<x>``: sum of ``x`` over the rows ordered before, per ``within``.

    ``(within, order)`` must be unique. Rows are range-partitioned and written,
    which freezes the ranges; totals run inside each range and are shifted by the
    totals of the earlier ranges. Those have one row per range and group and are
    written, so that their size decides how they are joined.
    """
    keys = [*within, *order]
    columns = df.columns
    ranged = df.repartitionByRange(*keys).selectExpr("*", f"spark_partition_id() as {RANGE}")
    ranged = materialize(ranged, "ranges")
    totals = ranged.groupBy(*within, RANGE).agg(*[F.expr(f"sum({s}) as {s}") for s in sums])
    ranges_before = window(within, RANGE, BEFORE)
    offsets = totals.selectExpr(
        *within,
        RANGE,
        *[f"coalesce(sum({s}) over {ranges_before}, 0) as _offset_{s}" for s in sums],
    )
    inside = window([*within, RANGE], ", ".join(order), BEFORE)
    offsets = materialize(offsets, "offsets")
    running = ranged.selectExpr(
        "*", *[f"coalesce(sum({s}) over {inside}, 0) as _inside_{s}" for s in sums]
    )
    return running.join(offsets, [*within, RANGE]).selectExpr(
        *columns, *[f"_inside_{s} + _offset_{s} as before_{s}" for s in sums]
    )
