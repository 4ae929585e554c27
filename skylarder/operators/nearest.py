"""Nearest-value join against a lookup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylarder.operators.numbering import position_within
from skylarder.session import shared_dir

# up to this many keys one level of cells will do
FEW_KEYS = 64
FEW_CELLS = 256
CELLS = 4096
SMALL_KEYS = 100_000
BROADCAST_BYTES = 64 << 20


def nearest_join(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    key: str,
    pos: str,
    value: str,
    name: str,
    fallback: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add the ``value`` whose ``key`` is nearest to ``on``; ties go to the lowest ``pos``.

    The key range is cut into cells, and each gap between neighbouring keys is
    listed in the cells it touches. A row meets the lookup by equality on its
    cell and by lying in one gap, then takes the nearer end: every row matches
    exactly once, without being compared to the whole lookup. Rows with a null
    ``on`` get null. An empty lookup uses ``fallback``.

    The lookup is measured first (one aggregation). A small one is broadcast; for
    a large one the neighbours and the join are computed by shuffles, where
    adaptive execution splits hot cells.
    """
    # the first entry in file order stands for a repeated key
    keys = (
        lookup.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("double").alias("k"))
        .agg(F.min_by(value, pos).alias("v"), F.min(pos).alias("p"))
    )
    seen = keys.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("k").alias("lo"),
        F.max("k").alias("hi"),
        F.min_by("v", "p").alias("first_value"),
        F.max(F.octet_length("v")).alias("width"),
    ).first()
    x = F.col(on).cast("double")
    if seen.n == 0:
        return df.withColumn(name, fallback(x) if fallback else F.lit(None).cast("string"))

    if seen.n > SMALL_KEYS:
        # used several times below: compute the reduced lookup once
        path = shared_dir(df.sparkSession, "nearest-keys")
        keys.write.parquet(path)
        keys = df.sparkSession.read.parquet(path)
    locate = _cells(keys, seen)
    gaps = _gaps(locate(keys, F.col("k")), seen.n)
    row_bytes = 2 * ((seen.width or 0) + 64)
    if seen.n <= SMALL_KEYS and 3 * (seen.n + CELLS) * row_bytes <= BROADCAST_BYTES:
        gaps = F.broadcast(gaps)

    # outside the key range the outermost key is the nearest
    within = F.least(F.greatest(x, F.lit(seen.lo)), F.lit(seen.hi))
    placed = locate(df.withColumn("__x", F.when(x.isNotNull(), within)), F.col("__x"))
    inside = (
        (F.col("__cell") == F.col("__at_cell"))
        & (F.col("__part") == F.col("__at_part"))
        & (F.col("__x") >= F.col("__lo.k"))
        & (F.col("__hi.k").isNull() | (F.col("__x") < F.col("__hi.k")))
    )
    below, above = F.col("__x") - F.col("__lo.k"), F.col("__hi.k") - F.col("__x")
    upper = (above < below) | ((above == below) & (F.col("__hi.p") < F.col("__lo.p")))
    # every key is equally far from an infinite or undefined value
    endless = F.isnan(x) | (F.abs(x) == float("inf"))
    chosen = (
        F.when(endless, F.lit(seen.first_value)).when(upper, F.col("__hi.v")).otherwise(F.col("__lo.v"))
    )
    joined = placed.join(gaps, inside, "left").withColumn(name, chosen)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)


def _cells(keys: DataFrame, seen) -> Callable[[DataFrame, Column], DataFrame]:
    """How to add the cell of a value within the key range, as ``__cell`` and ``__part``.

    Few keys get cells of equal width. Otherwise cells hold about equally many keys
    (their bounds are quantiles, at most CELLS numbers), wherever the keys lie and
    however far out some are; a cell of many keys is cut again into as many parts
    as it has keys.
    """
    if seen.n <= FEW_KEYS:
        per_unit = FEW_CELLS / (seen.hi - seen.lo) if seen.hi > seen.lo else 0.0
        few = lambda v: F.least(F.floor((v - seen.lo) * per_unit).cast("int"), F.lit(FEW_CELLS - 1))
        return lambda df, v: df.withColumns({"__cell": few(v), "__part": F.lit(0)})

    # as text: thousands of column objects would take seconds to make
    shares = ", ".join(f"{i / CELLS}D" for i in range(1, CELLS))
    bounds = sorted(set(keys.agg(F.expr(f"percentile_approx(k, array({shares}))")).first()[0]))
    # a single text folds into one array constant
    knots = F.split(F.lit(",".join(map(repr, bounds))), ",").cast("array<double>")
    halves = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def cell(v: Column) -> Column:
        """How many bounds are not above the value, by halving steps."""
        return F.aggregate(
            F.lit(halves).cast("array<int>"),
            F.lit(0),
            lambda at, step: F.when(F.get(knots, at + step - 1) <= v, at + step).otherwise(at),
        )

    filled = keys.groupBy(cell(F.col("k")).alias("__c")).agg(
        F.count(F.lit(1)).cast("int").alias("__m"), F.min("k").alias("__from"), F.max("k").alias("__to")
    )

    def locate(df: DataFrame, v: Column) -> DataFrame:
        parts = F.floor((v - F.col("__from")) / (F.col("__to") - F.col("__from")) * F.col("__m")).cast("int")
        part = (
            F.when(F.col("__c").isNull() | (v <= F.col("__from")), 0)
            .when(v >= F.col("__to"), F.col("__m") - 1)
            .otherwise(F.least(parts, F.col("__m") - 1))
        )
        # a null has no place, while a sum of steps would start at 0
        celled = df.withColumn("__cell", F.when(v.isNotNull(), cell(v)))
        joined = celled.join(F.broadcast(filled), F.col("__cell") == F.col("__c"), "left")
        return joined.withColumn("__part", part).drop("__c", "__m", "__from", "__to")

    return locate


def _gaps(keys: DataFrame, n: int) -> DataFrame:
    """Each gap (lo, hi) between neighbours with every cell it touches; the last has no hi."""
    knot = F.struct("k", "v", "p", F.col("__cell").alias("c"), F.col("__part").alias("f"))
    if n <= SMALL_KEYS:
        pairs = keys.select(knot.alias("lo"), F.lead(knot).over(Window.orderBy("k")).alias("hi"))
    else:
        numbered = position_within(keys, order=[F.col("k")], name="i")
        lo = numbered.select(F.col("i").alias("lo_i"), knot.alias("lo"))
        hi = numbered.select((F.col("i") - 1).alias("hi_i"), knot.alias("hi"))
        pairs = lo.join(hi, F.col("lo_i") == F.col("hi_i"), "left")
    end = F.coalesce("hi", "lo")
    spread = pairs.select("lo", "hi", F.explode(F.sequence("lo.c", end["c"])).alias("__at_cell"))
    # only the two outer cells hold keys: the gap leaves the first from its last
    # part, crosses cells without parts, and enters the last at its first part
    first = F.when(F.col("__at_cell") == F.col("lo.c"), F.col("lo.f")).otherwise(0)
    last = F.when(F.col("__at_cell") == end["c"], end["f"]).otherwise(first)
    return spread.select(
        F.col("lo").alias("__lo"),
        F.col("hi").alias("__hi"),
        "__at_cell",
        F.explode(F.sequence(first, last)).alias("__at_part"),
    )
