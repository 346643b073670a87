"""How series are laid out over tasks.

Two regimes:

* A *gridded* series has at most one row per grid slot, so its length is
  bounded by the calendar (ten years of hours: 87,660 rows) however many raw
  observations fed it. One window per series is then a bounded sort, and every
  operator that windows on the same keys shares one shuffle.
* A *long* series (raw observations, or a very fine grid) must not meet in one
  task. ``number_rows``, ``carry`` and ``in_blocks`` split it into chunks or
  blocks with copied edge rows, so they give the same result with no task larger than a block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def by_series(keys: Sequence[str], *order: str | Column) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def whole_series(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def trailing(keys: Sequence[str], ts: str, rows: int, past_only: bool = False) -> WindowSpec:
    """The last ``rows`` rows, with or without the current one."""
    shift = 1 if past_only else 0
    return by_series(keys, ts).rowsBetween(-(rows - 1) - shift, -shift)


SALTS = 32


def spread_join(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join raw rows to a table with one row per key.

    Spark broadcasts ``per_key`` when its measured size allows. When it does not,
    the rows of a hot key are spread over ``salts`` tasks: the salt comes from
    the row's own content, so a retried task repeats it exactly, and each key's
    one row is copied to every salt.
    """
    salted = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], how).drop("_salt")


def number_rows(df: DataFrame, keys: Sequence[str], ts: str, out: str = "rn", chunk: str = "month") -> DataFrame:
    """Row number within each series without sorting a series in one task.

    Rows are numbered inside (series, calendar chunk); the chunk offsets are a
    running sum over one summary row per chunk.
    """
    d = df.withColumn("_chunk", F.date_trunc(chunk, F.col(ts)))
    sizes = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = by_series(keys, "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    local = d.withColumn("_local", F.row_number().over(by_series([*keys, "_chunk"], ts)))
    return (
        local.join(offsets, [*keys, "_chunk"])
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_chunk", "_local", "_offset")
    )


def dealt_blocks(df: DataFrame, keys: Sequence[str], ts: str, before: int, after: int, block_rows: int) -> DataFrame:
    """Rows with ``_pos``, the block ``_home`` they belong to and the ``_block`` they are
    dealt to: their own, and the neighbour's that needs them as context."""
    if max(before, after) > block_rows:
        raise ValueError("block_rows must be at least the reach of the frame")
    d = number_rows(df, keys, ts, out="_pos")
    home = F.floor((F.col("_pos") - 1) / F.lit(block_rows))
    inside = (F.col("_pos") - 1) % F.lit(block_rows)
    homes = F.array(home, F.when(inside >= block_rows - before, home + 1), F.when(inside < after, home - 1))
    return d.withColumn("_home", home).withColumn("_block", F.explode(homes)).where("_block is not null")


def in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    body: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int = 0,
    after: int = 0,
    block_rows: int | None = None,
) -> DataFrame:
    """Run a window computation whose frames reach at most ``before`` rows back
    and ``after`` rows ahead.

    ``body(df, w)`` adds columns using the ordered window ``w``. With
    ``block_rows`` unset each series is one partition (right for gridded
    series). With it set, rows are grouped by (series, block) and rows near a
    block edge are copied to the neighbour, used there as context and dropped
    afterwards.
    """
    if block_rows is None:
        return body(df, by_series(keys, ts))
    d = dealt_blocks(df, keys, ts, before, after, block_rows)
    done = body(d, by_series([*keys, "_block"], "_pos"))
    return done.where(F.col("_block") == F.col("_home")).drop("_pos", "_home", "_block")


def carry(
    df: DataFrame, keys: Sequence[str], ts: str, y: str, out: str, chunk: str = "month", ahead: bool = False
) -> DataFrame:
    """Nearest non-NULL ``y`` at or before each row (``ahead``: at or after), for
    long series.

    Inside a calendar chunk this is an ordinary window; across chunks only one
    summary row per chunk travels.
    """
    part = [*keys, "_chunk"]
    known = F.when(F.col(y).isNotNull(), F.col(ts))
    if ahead:
        edge, pick = F.min_by(F.col(y), known), F.first
        others, near = (1, Window.unboundedFollowing), (0, Window.unboundedFollowing)
    else:
        edge, pick = F.max_by(F.col(y), known), F.last
        others, near = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)
    d = df.withColumn("_chunk", F.date_trunc(chunk, F.col(ts)))
    edges = d.groupBy(*part).agg(edge.alias("_edge"))
    carried = edges.select(*part, pick("_edge", ignorenulls=True).over(by_series(keys, "_chunk").rowsBetween(*others)).alias("_carry"))
    return (
        d.withColumn("_here", pick(y, ignorenulls=True).over(by_series(part, ts).rowsBetween(*near)))
        .join(carried, part)
        .withColumn(out, F.coalesce("_here", "_carry"))
        .drop("_chunk", "_here", "_carry")
    )
