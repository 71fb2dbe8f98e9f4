"""Exact quantiles and tiles without sorting everything in one task.

Every operator first shrinks the data to counts. Values fall into blocks whose
number is fixed by the range of a double, not by the rows, so the only window
without a partition key runs over that short list of blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

PER_OCTAVE = 256
_LOWEST_OCTAVE = 1100  # below the exponent of the smallest double


def value_block(v: str) -> str:
    """SQL: order-preserving many-to-one map of a DOUBLE onto a short range of BIGINT.

    Each doubling of the size is cut into 256 blocks, each about 0.27 % wide;
    a block of money amounts below a million holds some 270 000 cents at most.
    NaN, used for nulls that sort last, has a block above all others.
    """
    size = f"floor(log2(abs({v})) * {PER_OCTAVE}) + {_LOWEST_OCTAVE * PER_OCTAVE}"
    last = PER_OCTAVE * 4096
    return f"CASE WHEN isnan({v}) THEN {last}L WHEN {v} = 0 THEN 0L WHEN {v} > 0 THEN {size} ELSE -({size}) END"


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group (one row if no `by`).

    `probs` maps output names to probabilities. Equal values are counted before
    the first shuffle; only the blocks that hold a wanted rank are then ordered.
    """
    keys = [F.col(f"`{c}`") for c in by]
    group = Window.partitionBy(*keys)
    # 0-based place between two neighbours of each quantile.
    place = {name: f"((total - 1) * {float(p)!r}D)" for name, p in probs.items()}
    ends = [(name, end, f"{end}({pos})") for name, pos in place.items() for end in ("floor", "ceil")]
    wanted = " OR ".join(f"{rank} BETWEEN before AND before + bn - 1" for _, _, rank in ends)

    values = df.select(*keys, F.col(f"`{value}`").cast("double").alias("v")).where("v IS NOT NULL")
    counts = values.groupBy(*keys, "v").agg(F.count("*").alias("n")).withColumn("b", F.expr(value_block("v")))
    blocks = counts.groupBy(*keys, "b").agg(F.sum("n").alias("bn"))
    placed = blocks.select(
        *keys, "b", "bn", (F.sum("bn").over(group.orderBy("b")) - F.col("bn")).alias("before"), F.sum("bn").over(group).alias("total")
    )
    kept = placed.where(wanted).select(*[k.alias(f"_{n}") for n, k in enumerate(keys)], F.col("b").alias("_b"), "before", "total")
    same = F.col("b") == F.col("_b")
    for n, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_{n}"))
    # Without groups `kept` has at most two rows per probability; with groups, only counts meet it.
    found = counts.join(kept if by else F.broadcast(kept), same)
    ordered = Window.partitionBy(*keys, "b").orderBy("v")
    ranked = found.withColumn("hi", F.col("before") + F.sum("n").over(ordered) - 1).withColumn("lo", F.expr("hi - n + 1"))
    held = [F.expr(f"max(CASE WHEN {rank} BETWEEN lo AND hi THEN v END)").alias(f"{end}_{name}") for name, end, rank in ends]
    one = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *held)
    # Interpolate from the nearer neighbour, so that both ends come out exact.
    between = [
        f"""CASE WHEN {pos} - floor({pos}) < 0.5D
            THEN `floor_{name}` + (`ceil_{name}` - `floor_{name}`) * ({pos} - floor({pos}))
            ELSE `ceil_{name}` - (`ceil_{name}` - `floor_{name}`) * (1 - ({pos} - floor({pos})))
            END AS `{name}`"""
        for name, pos in place.items()
    ]
    return one.select(*keys, *map(F.expr, between))


def tile_of(rank: str, total: str, tiles: int) -> str:
    """SQL: the NTILE bucket of a 1-based rank; larger buckets come first."""
    size, extra = f"({total} div {tiles})", f"({total} % {tiles})"
    wide = f"({extra} * ({size} + 1))"
    return (
        f"int(CASE WHEN {rank} <= {wide} THEN ({rank} + {size}) div ({size} + 1) "
        f"ELSE {extra} + ({rank} - {wide} + {size} - 1) div greatest({size}, 1L) END)"
    )


def last_rank(tile: str, total: str, tiles: int) -> str:
    """SQL: the rank of the last row in an NTILE bucket."""
    return f"({tile} * ({total} div {tiles}) + least({tile}, {total} % {tiles}))"


def tiles_from_counts(
    df: DataFrame, value: str, tiles: int, descending: bool = False
) -> DataFrame:
    """NTILE over rows of `value`, summed per tile: tile, entities, total.

    Rows with equal values are interchangeable here, so the whole ranking runs
    on (value, how many). Distinct activity counts n sum to at most the number
    of events E, hence there are fewer than sqrt(2E) of them.
    """
    hist = df.groupBy(F.col(f"`{value}`").alias("v")).agg(F.count("*").alias("n"))
    whole, ordered = Window.partitionBy(), Window.orderBy(F.desc("v") if descending else F.asc("v"))
    ranges = hist.select("v", "n", F.sum("n").over(ordered).alias("hi"), F.sum("n").over(whole).alias("total")).withColumn(
        "lo", F.expr("hi - n + 1")
    )
    tiles_held = f"explode(sequence({tile_of('lo', 'total', tiles)}, {tile_of('hi', 'total', tiles)}))"
    last, before = last_rank("tile", "total", tiles), last_rank("(tile - 1)", "total", tiles)
    cut = ranges.withColumn("tile", F.expr(tiles_held)).withColumn("k", F.expr(f"least(hi, {last}) - greatest(lo - 1, {before})"))
    return cut.groupBy("tile").agg(F.sum("k").alias("entities"), F.sum(F.expr("k * v")).alias("total"))


def with_ntile(
    df: DataFrame, id_col: str, value: str, tiles: int, name: str, descending: bool = False
) -> DataFrame:
    """Add the NTILE of every row, ordered by value (nulls last), ties by md5(id).

    Only the last row of each tile is looked for; every row then compares itself
    with those few. The blocks and cells that hold such a row are at most tiles - 1, which is
    why they are broadcast: only rows of those cells are shuffled. The search narrows from blocks
    to cells, a cell being one value and one of 256 slices by md5. The md5
    spreads rows that share a value, whatever their number and their ids.

    Reads `df` four times: pass a saved or cheap table.
    """
    v = f"double(`{value}`)"
    v = f"coalesce({'0D - ' + v if descending else v}, double('NaN'))"
    rows = df.selectExpr(
        "*", f"{v} AS _v", f"{value_block(v)} AS _b", f"md5(string(`{id_col}`)) AS _h"
    ).withColumn("_s", F.expr("substring(_h, 1, 2)"))
    # `needs` and `places` hold the wanted ranks, counted within the block and the cell.
    inside = lambda ranks: f"filter({ranks}, r -> r BETWEEN 1 AND n)"
    every = Window.orderBy("_b")
    blocks = rows.groupBy("_b").agg(F.count("*").alias("n"))
    counted = blocks.select(
        "_b", "n", (F.sum("n").over(every) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    ranks = f"transform(sequence(1, {tiles - 1}), t -> {last_rank('t', 'total', tiles)} - before)"
    wanted = counted.selectExpr("_b", f"{inside(ranks)} AS needs").where("size(needs) > 0")
    cells = rows.join(F.broadcast(wanted), "_b").groupBy("_b", "needs", "_v", "_s").agg(F.count("*").alias("n"))
    placed = cells.withColumn("before", F.sum("n").over(Window.partitionBy("_b").orderBy("_v", "_s")) - F.col("n"))
    targets = placed.selectExpr("_v", "_s", f"{inside('transform(needs, r -> r - before)')} AS places").where("size(places) > 0")
    near = rows.join(F.broadcast(targets), ["_v", "_s"]).select("_v", "_s", "_h", "places")
    candidates = near.withColumn("place", F.row_number().over(Window.partitionBy("_v", "_s").orderBy("_h")))
    found = candidates.where("array_contains(places, bigint(place))")
    bounds = found.agg(F.collect_list(F.struct("_v", "_h")).alias("bounds"))
    below = F.expr("size(filter(_bounds, x -> x < struct(_v, _h)))")
    tiled = rows.withColumn("_bounds", bounds.scalar()).withColumn(name, below + 1)
    return tiled.drop("_v", "_b", "_h", "_s", "_bounds")
