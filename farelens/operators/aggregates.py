"""Aggregations.

All of them are hash aggregations with map-side partial aggregation, so a
hot key (one hour, one grid cell, one zone holding a third of the rides)
is pre-combined in every task and only one partial row per task and key is
shuffled. Group counts are bounded by the domain (24 hours, 80,000 grid
cells, a few zones), never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GRID_N_LAT, GRID_N_LON, HIST_BINS, NYC_BB, PYRAMID_CELLS, PYRAMID_ZOOMS, grid_constants
from ..functions.geo import digitize, log_density
from .zones import tag_zones

CALENDAR_DIMENSIONS = ("month", "day_of_week", "hour", "year")


def _no_nan(c: str) -> Column:
    # pandas-style mean/sum: NaN is skipped like NULL
    return F.when(~F.isnan(F.col(c)), F.col(c))


def finite_values(df: DataFrame, col: str, *keep: str) -> DataFrame:
    """``col`` as double with NaN turned into NULL, so aggregates skip it.

    A projection rather than a filter: a filter on a computed column is
    pushed below the projection that computes it and re-inlines the whole
    expression (no common-subexpression elimination there); aggregates skip
    NULL on their own and NULL bins fall out of the zero-fill join.
    """
    x = F.col(col).cast("double")
    return df.select(*keep, F.when(~F.isnan(x), x).alias("v"))


def avg_fare_by(df: DataFrame, dim: str) -> DataFrame:
    """A1-A4: average fare per calendar bucket (expects P1 columns)."""
    return df.groupBy(dim).agg(F.avg("fare_amount").alias("avg_fare"))


def avg_fare_all(df: DataFrame, dims=CALENDAR_DIMENSIONS) -> DataFrame:
    """A5: the four averages in one scan and one shuffle via GROUPING SETS.

    Output (dimension, bucket, avg_fare, n_rides).
    """
    dims = list(dims)
    g = df.groupingSets([[d] for d in dims], *dims).agg(
        F.avg("fare_amount").alias("avg_fare"),
        F.count(F.lit(1)).alias("n_rides"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dimension = None
    bucket = None
    for d in dims:
        is_d = F.col(f"_g_{d}") == 0
        dimension = F.when(is_d, F.lit(d)) if dimension is None else dimension.when(is_d, F.lit(d))
        bucket = F.when(is_d, F.col(d)) if bucket is None else bucket.when(is_d, F.col(d))
    return g.select(dimension.alias("dimension"), bucket.alias("bucket"), "avg_fare", "n_rides")


def density_grid(df: DataFrame, bb=NYC_BB, n_lon: int = GRID_N_LON, n_lat: int = GRID_N_LAT) -> DataFrame:
    """Rides per grid cell and per km^2, pickup and dropoff in one pass.

    Sparse: only occupied cells. ``row`` 0 is the northern edge, ``col`` 0 the
    western one; bins are half-open, a point on the last edge falls out.
    """
    g = grid_constants(bb, n_lon, n_lat)
    ends = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"),
                 F.col(f"{side}_longitude").alias("lon"),
                 F.col(f"{side}_latitude").alias("lat"))
        for side in ("pickup", "dropoff")]))
    # NULL coordinates are outside the grid: index 0, so keys are never NULL
    pts = df.select(ends.alias("p")).select(
        "p.side",
        F.coalesce(digitize("p.lon", g["lon0"], g["dlon"], n_lon), F.lit(0)).alias("ix"),
        F.coalesce(digitize("p.lat", g["lat0"], g["dlat"], n_lat), F.lit(0)).alias("iy"))
    # The in-grid test is counted inside the aggregate instead of filtered
    # before it: a filter on the computed indices would be pushed below the
    # projection and re-evaluate them. Out-of-grid keys are a bounded ring
    # (index 0 or n+1) whose counts are 0 and are dropped afterwards.
    inside = F.col("ix").between(1, n_lon) & F.col("iy").between(1, n_lat)
    counts = (pts.groupBy("side", "ix", "iy").agg(F.count_if(inside).alias("cnt"))
                 .filter(F.col("cnt") > 0))
    density = F.col("cnt") / F.lit(g["cell_area_km2"])
    return counts.select(
        "side",
        (F.lit(n_lat) - F.col("iy")).alias("row"),
        (F.col("ix") - 1).alias("col"),
        "cnt",
        density.alias("density"),
        log_density(density).alias("log_density"),
        F.lit(g["cell_width_km"]).alias("cell_width_km"),
        F.lit(g["cell_height_km"]).alias("cell_height_km"),
        F.lit(g["cell_area_km2"]).alias("cell_area_km2"))


def density_pyramid(df: DataFrame, zooms: int = PYRAMID_ZOOMS, coarsest: int = PYRAMID_CELLS, bb=NYC_BB) -> DataFrame:
    """A6/D5 at many zooms: (zoom, side, row, col, cnt), occupied cells only.

    Zoom z has ``coarsest`` * 2 ** z cells each way. Rides are counted once, on
    the finest grid; four cells of a zoom make one of the zoom before, so all
    others are sums of these counts, whose number the grid bounds. As steps
    differ by powers of two, the edges of a zoom are edges of the finer ones to
    the last bit, and every zoom equals a count of its own.
    """
    if zooms < 1 or coarsest < 1:
        raise ValueError("zooms and coarsest must be at least 1")
    finest = coarsest << (zooms - 1)
    cells = density_grid(df, bb, finest, finest).select("side", "row", "col", "cnt")
    up = [F.struct(F.lit(z).alias("zoom"), *[F.expr(f"CAST(shiftright({c}, {zooms - 1 - z}) AS INT)").alias(c) for c in ("row", "col")]) for z in range(zooms)]
    each = cells.select("side", "cnt", F.explode(F.array(*up)).alias("c"))
    return merge_pyramids(each.select("c.zoom", "side", "c.row", "c.col", "cnt"))


def merge_pyramids(*pyramids: DataFrame) -> DataFrame:
    """The pyramid of all rides of several stores or days, from their pyramids."""
    both = pyramids[0]
    for p in pyramids[1:]:
        both = both.unionByName(p)
    return both.groupBy("zoom", "side", "row", "col").agg(F.sum("cnt").alias("cnt"))


def pyramid_view(pyramid: DataFrame, zoom: int, frame=NYC_BB, coarsest: int = PYRAMID_CELLS, bb=NYC_BB) -> DataFrame:
    """D4/D5 from a pyramid over ``bb``: the cells of one zoom that a map
    ``frame`` meets, with the density a cell area gives and log(1 + density)."""
    n = coarsest << zoom
    g = grid_constants(bb, n, n)
    west, south = g["lon0"] + F.col("col") * g["dlon"], g["lat0"] + (n - 1 - F.col("row")) * g["dlat"]
    meets = (west <= frame[1]) & (west + g["dlon"] > frame[0]) & (south <= frame[3]) & (south + g["dlat"] > frame[2])
    density = F.col("cnt") / F.lit(g["cell_area_km2"])
    return pyramid.filter((F.col("zoom") == zoom) & meets).select(
        "side", "row", "col", "cnt", density.alias("density"), log_density(density).alias("log_density"))


def _bin_estimate(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    est = F.floor((v - lo) / (hi - lo) * F.lit(bins)).cast("int")
    return F.when(est >= bins, F.lit(bins - 1)).when(est < 0, F.lit(0)).otherwise(est)


def _bin_fix(v: Column, est: Column, lo: Column, hi: Column, step: Column, bins: int) -> Column:
    """Move the estimate by at most one so that ``edge(bin) <= v < edge(bin + 1)``
    holds for the edges ``k*step + lo`` (last edge ``hi``, last bin closed)."""
    def edge(k: Column) -> Column:
        return F.when(k >= bins, hi).otherwise(k.cast("double") * step + lo)
    down = F.when(v < edge(est), F.lit(1)).otherwise(F.lit(0))
    up = F.when((est <= bins - 2) & (v >= edge(est + 1)), F.lit(1)).otherwise(F.lit(0))
    return est - down + up


def _binned(vals: DataFrame, lo: Column, hi: Column, step: Column, bins: int, *keep: str) -> DataFrame:
    """Bin per value; NULL values get bin -1, which the zero-fill join drops.

    Two projections so the estimate is computed once. The bin is never NULL:
    a nullable join key would make the optimizer infer ``isnotnull(bin)`` and
    push it under the aggregate, re-inlining the whole value expression into
    the scan filter.
    """
    v = F.col("v")
    return (vals.withColumn("_est", _bin_estimate(v, lo, hi, bins))
                .select(*keep, F.coalesce(_bin_fix(v, F.col("_est"), lo, hi, step, bins),
                                          F.lit(-1)).alias("bin")))


def _bounds(mn: Column, mx: Column, bins: int) -> Column:
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    return F.struct(lo.alias("lo"), hi.alias("hi"), ((hi - lo) / F.lit(float(bins))).alias("step"))


def _edges(bins: int, lo: Column, hi: Column, step: Column) -> tuple[Column, Column]:
    edge_lo = F.col("bin").cast("double") * step + lo
    edge_hi = F.when(F.col("bin") == bins - 1, hi).otherwise((F.col("bin") + 1).cast("double") * step + lo)
    return edge_lo, edge_hi


def _zero_filled(counts: DataFrame, bins: int, *keys: str) -> DataFrame:
    """(keys, bin, cnt, lo, hi, step) with one row per occupied bin -> every bin of
    every key, zero-filled. Works on at most bins+1 rows per key: the
    counts are folded into a bin->count map, then ``sequence`` lays out the
    bins; no join and no scan of the data."""
    folded = (counts.groupBy(*keys)
                    .agg(F.map_from_entries(F.collect_list(F.struct("bin", "cnt"))).alias("m"),
                         *[F.max(c).alias(c) for c in ("lo", "hi", "step")])
                    .filter(F.col("lo").isNotNull()))
    out = folded.select(*keys, "m", "lo", "hi", "step",
                        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge_lo, edge_hi = _edges(bins, F.col("lo"), F.col("hi"), F.col("step"))
    return out.select(*keys, "bin", edge_lo.alias("bin_lo"), edge_hi.alias("bin_hi"),
                      F.coalesce(F.element_at("m", F.col("bin")), F.lit(0).cast("bigint")).alias("cnt"))


def distance_histogram(df: DataFrame, col: str = "distance_km", bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram over [min, max] of the non-NaN values.

    The bounds are one scalar subquery (a single min/max aggregate, run once
    and inlined as a value); nothing is collected. If min == max the range
    widens by 0.5 each way; empty input gives zero rows. Output
    (bin, bin_lo, bin_hi, cnt), zero-filled. Two passes over the data:
    the bounds, then one partial/final count per bin.
    """
    vals = finite_values(df, col)
    bounds = vals.agg(F.min("v").alias("mn"), F.max("v").alias("mx")).select(
        _bounds(F.col("mn"), F.col("mx"), bins).alias("b")).scalar()
    lo, hi, step = F.col("b.lo"), F.col("b.hi"), F.col("b.step")
    # bounds ride along as plain doubles so the aggregation stays hash-based
    counts = (_binned(vals.withColumn("b", bounds), lo, hi, step, bins, "b.lo", "b.hi", "b.step")
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"),
                                      *[F.max(c).alias(c) for c in ("lo", "hi", "step")]))
    return _zero_filled(counts, bins)


def grouped_histogram(df: DataFrame, group: str, groups, col: str = "distance_km", bins: int = HIST_BINS) -> DataFrame:
    """A7 per group: each of ``groups`` (a fixed, short list of values of the
    column ``group``) gets its own [min, max] bins, zero-filled.

    The bounds of all groups are one scalar subquery, a single row of
    conditional minima and maxima; binning is a projection, and one count by
    (group, bin) combines map-side. No join, and no exchange on the group
    alone, so a group with most of the rows is no single task's work. Empty
    bins come from adding a zero row for every bin.
    """
    vals = finite_values(df.withColumn("g", F.col(group)), col, "g")
    limits = [(F.min(F.when(F.col("g") == g, F.col("v"))), F.max(F.when(F.col("g") == g, F.col("v")))) for g in groups]
    row = vals.agg(*[x.alias(f"{m}{k}") for k, pair in enumerate(limits) for m, x in zip(("mn", "mx"), pair)])
    entry = [F.struct(F.lit(g).alias("g"), _bounds(F.col(f"mn{k}"), F.col(f"mx{k}"), bins).alias("b")) for k, g in enumerate(groups)]
    bounds = row.select(F.map_from_entries(F.array(*entry)).alias("m")).scalar()
    lo, hi, step = F.col("b.lo"), F.col("b.hi"), F.col("b.step")
    with_b = vals.withColumn("m", bounds).withColumn("b", F.col("m")[F.col("g")])
    binned = _binned(with_b, lo, hi, step, bins, "g", "b.lo", "b.hi", "b.step").withColumn("one", F.lit(1).cast("bigint"))
    frame = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), bounds.alias("m"))
               .select("bin", F.explode("m").alias("g", "b")).filter(F.col("b.lo").isNotNull()))
    zeros = frame.select("g", "b.lo", "b.hi", "b.step", "bin", F.lit(0).cast("bigint").alias("one"))
    counts = (binned.unionByName(zeros).groupBy("g", "bin")
                    .agg(F.sum("one").alias("cnt"), *[F.max(c).alias(c) for c in ("lo", "hi", "step")]).filter("bin >= 0"))
    edge_lo, edge_hi = _edges(bins, F.col("lo"), F.col("hi"), F.col("step"))
    return counts.select(F.col("g").alias(group), "bin", edge_lo.alias("bin_lo"), edge_hi.alias("bin_hi"), "cnt")


def mean_by_passengers(df: DataFrame) -> DataFrame:
    """Mean distance and fare per passenger count (NaN skipped, NULL
    passenger count not a group)."""
    return (df.filter(F.col("passenger_count").isNotNull())
              .groupBy("passenger_count")
              .agg(F.avg(_no_nan("distance_km")).alias("avg_distance_km"),
                   F.avg(_no_nan("fare_amount")).alias("avg_fare")))


def _usd_per_km(fare_sum: Column, dist_sum: Column) -> Column:
    return F.when(dist_sum == 0, F.lit(None).cast("double")).otherwise(fare_sum / dist_sum)


def usd_per_km(df: DataFrame) -> DataFrame:
    """Total fare over total distance (NULL when the distance sums to 0)."""
    fs, ds = F.sum(_no_nan("fare_amount")), F.sum(_no_nan("distance_km"))
    return df.agg(fs.alias("sum_fare"), ds.alias("sum_distance_km")).select(
        "sum_fare", "sum_distance_km",
        _usd_per_km(F.col("sum_fare"), F.col("sum_distance_km")).alias("usd_per_km"))


STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
#: Ranges that a quartile's bracket is cut into.
RANGES = 1024


def _range_in_bracket() -> Column:
    """Where ``v`` lies from ``lo`` to ``hi``, as one of RANGES that rise with
    it; -1 and RANGES beside them. Infinite brackets leave few ranges in use."""
    part = F.nanvl(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * (RANGES - 1)
    return (F.when(F.col("side") < 0, -1).when(F.col("side") > 0, RANGES).when(F.col("v") == F.col("hi"), RANGES - 1)
             .otherwise(F.least(F.lit(RANGES - 2), F.greatest(F.lit(0), F.floor(part).cast("int")))))


def describe_distance(df: DataFrame, col: str = "distance_km", approx: bool = False,
                      accuracy: int = 10_000) -> DataFrame:
    """A10: count, mean, std, min, 25%, 50%, 75%, max in long form, lazily.

    Exact (default): the moments and, around each quartile, a bracket from
    ``percentile_approx`` (whose rank error is at most rows / accuracy) are
    one scalar subquery. A second pass counts, by quartile, the values below
    and above its bracket as one row each and those inside by value, combined
    map-side (a share of about 6 / accuracy of the rows, fewer where values
    tie). A bracket is cut into RANGES of equal width; from their counts follows
    the range that holds a wanted rank, and only the values of that one are put
    in order, so that no task has a quartile's whole bracket. A rank that fell
    outside its bracket would raise an error. ``approx`` is a single pass with
    ``percentile_approx``.
    """
    vals = finite_values(df, col)
    probs = [0.25, 0.5, 0.75]
    moments = [F.count("v").cast("double").alias("count"), F.avg("v").alias("mean"),
               F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")]

    def long_form(row: DataFrame, cols: dict[str, Column]) -> DataFrame:
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("ord"), F.lit(name).alias("stat"), cols[name].cast("double").alias("value"))
            for i, name in enumerate(STATS)])))

    plain = {k: F.col(k) for k in ("count", "mean", "std", "min", "max")}
    if approx:
        row = vals.agg(*moments, F.percentile_approx("v", probs, accuracy).alias("q"))
        return long_form(row, plain | {f"{p:.0%}": F.col("q")[k] for k, p in enumerate(probs)})
    margin = 3.0 / accuracy
    around = [min(1.0, max(0.0, p + m)) for p in probs for m in (-margin, margin)]
    summary = vals.agg(*moments, F.percentile_approx("v", around, accuracy).alias("br"))
    known = summary.select(F.struct("*").alias("s")).scalar()  # one plan wherever it is used, run once
    quartile = F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1))).alias("k")
    near = (vals.filter("v IS NOT NULL").withColumn("br", known["br"]).select("v", "br", quartile)
                .select("k", "v", F.get("br", F.col("k") * 2).alias("lo"), F.get("br", F.col("k") * 2 + 1).alias("hi"))
                .withColumn("side", F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0))
                .groupBy("k", _range_in_bracket().alias("r"), F.when(F.col("side") == 0, F.col("v")).alias("at"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last")))
    # By quartile an array of at most RANGES + 2 counts, then of running sums.
    # All columns of ``near`` are read, so that it is one exchange used twice.
    counted = F.sum(F.when(F.col("at").isNull() | (F.col("first") <= F.col("last")), F.col("n")))
    sizes = (near.groupBy("k", "r").agg(counted.alias("n"))
                 .groupBy("k").agg(F.array_sort(F.collect_list(F.struct("r", "n"))).alias("sizes")).withColumn("count", known["count"]))
    place = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("k") + 1) * (F.col("count") - 1)
    ends = F.transform("sizes", lambda x, i: F.struct(x["r"].alias("r"), F.aggregate(
        F.slice("sizes", 1, i), F.lit(0).cast("long"), lambda total, y: total + y["n"]).alias("before"), x["n"].alias("n")))
    holder = lambda rank: F.get(F.filter("ends", lambda e: e["before"] + e["n"] > rank), F.lit(0))
    wanted = sizes.withColumns({"place": place, "ends": ends}).select(
        F.col("k").alias("wk"), "place", holder(F.floor("place")).alias("a"), holder(F.ceil("place")).alias("b"))
    # Only the ranges that hold a wanted rank are put in order, each by itself.
    chosen = near.join(F.broadcast(wanted), (F.col("k") == F.col("wk")) & F.col("r").isin(F.col("a")["r"], F.col("b")["r"]))
    order = Window.partitionBy("k", "r").orderBy("at")
    before = F.when(F.col("r") == F.col("a")["r"], F.col("a")["before"]).otherwise(F.col("b")["before"])
    ranked = chosen.withColumn("upto", before + F.sum("n").over(order))

    def at_rank(rank: Column) -> Column:
        held = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        # Of what lies beside the bracket, the nearest value is known too.
        return F.max(F.when(held & (rank == F.col("upto") - 1), F.col("last")).when(held & (rank == F.col("upto") - F.col("n")), F.col("first"))
                     .when(held, F.col("at")))

    low, high, part = F.col("low"), F.col("high"), F.col("place") - F.floor("place")
    missed = F.raise_error(F.lit("a quartile fell outside its bracket; raise accuracy"))
    quartiles = (ranked.groupBy("k").agg(F.max("place").alias("place"), at_rank(F.floor("place")).alias("low"), at_rank(F.ceil("place")).alias("high"))
                       .select("k", F.when(low.isNull() | high.isNull(), missed.cast("double")).when(low == high, low)
                               .otherwise(low + (high - low) * part).alias("q")))
    by_k = quartiles.agg(*[F.max(F.when(F.col("k") == k, F.col("q"))).alias(f"{p:.0%}") for k, p in enumerate(probs)])
    row = by_k.withColumn("s", known)
    return long_form(row, {k: F.col("s")[k] for k in plain} | {f"{p:.0%}": F.col(f"{p:.0%}") for p in probs})


def zone_details(df: DataFrame, side: str = "pickup") -> DataFrame:
    """A8 and A9 for every zone in one job.

    GROUPING SETS ((zone, passenger_count), (zone)): rows with level
    'zone' carry the zone-wide means and USD/km.
    """
    tagged = tag_zones(df.filter(F.col("passenger_count").isNotNull()), side)
    fs, ds = F.sum(_no_nan("fare_amount")), F.sum(_no_nan("distance_km"))
    g = tagged.groupingSets([["zone", "passenger_count"], ["zone"]], "zone", "passenger_count").agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.avg(_no_nan("distance_km")).alias("avg_distance_km"),
        F.avg(_no_nan("fare_amount")).alias("avg_fare"),
        _usd_per_km(fs, ds).alias("usd_per_km"),
        F.grouping("passenger_count").alias("_gp"))
    level = F.when(F.col("_gp") == 1, F.lit("zone")).otherwise(F.lit("zone_passengers"))
    return g.select("zone", level.alias("level"), "passenger_count", "n_rides",
                    "avg_distance_km", "avg_fare", "usd_per_km")

