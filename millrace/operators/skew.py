"""Building blocks that stay parallel when one key holds a large share of the rows.

A key is *hot* when it has more rows than both `HOT_ROWS` and a `HOT_SHARE` part
of the input.  By pigeonhole there are at most ``1 / HOT_SHARE`` hot keys, which is
the proven bound behind every broadcast in this module.

Plain joins between stored tables are left to Spark, whose adaptive execution splits
skewed shuffle partitions of inner, left, semi and anti joins by itself.  It cannot do
so where one side comes out of an aggregation or window; those joins use `lookup_join`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOT_ROWS = 2_000_000
HOT_SHARE = 1 / 10_000
FAN_OUT = 64  # bounds looked at per level when a row finds its range
SAMPLES_PER_RANGE = 20


@dataclass(frozen=True)
class Order:
    """One ordering column. Ascending puts nulls first, descending last."""

    name: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)

    def before(self, left: Column, right: Column) -> Column:
        if self.descending:
            return F.coalesce(left > right, left.isNotNull() & right.isNull())
        return F.coalesce(left < right, left.isNull() & right.isNotNull())


def orders(spec: Sequence[str]) -> list[Order]:
    """`["-update_time", "id"]` means update_time descending, then id ascending."""
    return [Order(s.lstrip("-"), s.startswith("-")) for s in spec]


def sort_columns(spec: Sequence[str]) -> list[Column]:
    return [o.sort() for o in orders(spec)]


def precedes(spec: list[Order], left: Column, right: Column) -> Column:
    """Lexicographic comparison of two structs under mixed directions."""
    result = F.lit(False)
    for o in reversed(spec):
        a, b = left[o.name], right[o.name]
        result = o.before(a, b) | (a.eqNullSafe(b) & result)
    return result


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE
) -> list[Row]:
    """Hot keys with their row count `n` and share; the counts are combined map-side
    and only the hot ones (at most 1 / hot_share) reach the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    if not keys:
        return counts.collect()
    big = counts.agg(F.count(F.lit(1)).alias("keys")).first()["keys"]
    if not big:
        return []
    floor = max(hot_rows, int(df.count() * hot_share))
    return counts.filter(F.col("n") > floor).collect()


def _matches(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def _range_bounds(df: DataFrame, keys: list[str], spec: list[Order], hot: list[Row], rows_per_range: int):
    """Sampled split points inside each hot key: (keys..., bounds array)."""
    spark = df.sparkSession
    names = [o.name for o in spec]
    total = sum(r["n"] for r in hot)
    ranges = {tuple(r[k] for k in keys): -(-r["n"] // rows_per_range) for r in hot}
    key_type = df.select(*keys).schema
    plan = spark.createDataFrame(
        [(*key, n) for key, n in ranges.items()], key_type.add("ranges", "long")
    )
    wanted = SAMPLES_PER_RANGE * sum(ranges.values())
    sample = df.select(*dict.fromkeys([*keys, *names])).sample(min(1.0, 1.2 * wanted / total), seed=7)
    sample = (
        sample.alias("s")
        .join(F.broadcast(plan).alias("h"), _matches(keys, "s", "h"))
        .select("s.*", "h.ranges")
    )
    by_key = Window.partitionBy(*keys)
    place = F.row_number().over(by_key.orderBy(*sort_columns([("-" if o.descending else "") + o.name for o in spec])))
    tile = lambda p: F.floor(p * F.col("ranges") / F.col("_n"))
    cuts = (
        sample.withColumn("_p", place)
        .withColumn("_n", F.count(F.lit(1)).over(by_key))
        .filter((F.col("_p") < F.col("_n")) & (tile(F.col("_p") - 1) != tile(F.col("_p"))))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_p", F.struct(*names).alias("o")))).alias("cuts"))
        .select(*keys, F.transform("cuts", lambda c: c["o"]).alias("_bounds"))
    )
    # Collected once (at most ~2 / HOT_SHARE split points), so every later use of
    # the ranges sees the same values even if the sample were drawn again.
    return spark.createDataFrame(cuts.collect(), cuts.schema)


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Exact `row_number()` per key (or over everything for `keys=[]`).

    `hot` are the hot keys where the caller has them already, [] where the data model
    bounds the rows of a key.

    Keys of ordinary size use one window.  Rows of hot keys are spread over ranges
    of the order, numbered inside their range, and shifted by the size of the ranges
    before it, so no task ever sorts a whole hot key.
    """
    hidden = not keys
    if hidden:
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    keys, spec = list(keys), orders(order)
    sort = sort_columns(order)
    if hot is None:
        hot = hot_keys(df, keys, hot_rows, hot_share)
    if not hot:
        out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*sort)).cast("long"))
        return out.drop("_all") if hidden else out

    rows_per_range = max(1, hot_rows, int(sum(r["n"] for r in hot) * hot_share))
    bounds = _range_bounds(df, keys, spec, hot, rows_per_range)
    here = F.struct(*[F.col(f"r.{o.name}").alias(o.name) for o in spec])
    passed = lambda arr: F.size(F.filter(arr, lambda b: precedes(spec, b, here)))
    every = F.transform(
        F.sequence(F.lit(1), F.ceil(F.size("b._bounds") / F.lit(FAN_OUT)).cast("int")),
        lambda i: F.element_at("b._bounds", F.least(i * FAN_OUT, F.size("b._bounds"))),
    )
    coarse = passed(every)
    fine = passed(F.slice("b._bounds", coarse * FAN_OUT + 1, FAN_OUT))
    number = F.when(F.size("b._bounds") > 0, F.least(coarse * FAN_OUT + fine, F.size("b._bounds")))
    spread = (
        df.alias("r")
        .join(F.broadcast(bounds).alias("b"), _matches(keys, "r", "b"), "left")
        .select("r.*", F.coalesce(number, F.lit(0)).alias("_range"), F.col("b._bounds").isNotNull().alias("_hot"))
    )
    sizes = spread.filter("_hot").groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_range", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*sort))
    out = (
        spread.withColumn("_local", local).alias("r")
        .join(F.broadcast(shifts).alias("s"), _matches([*keys, "_range"], "r", "s"), "left")
        .select("r.*", (F.col("_local") + F.coalesce("_shift", F.lit(0))).cast("long").alias(name))
        .drop("_range", "_hot", "_local")
    )
    return out.drop("_all") if hidden else out


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Join rows to a table with at most one row per key.

    Rows of hot keys meet a broadcast of just those keys' lookup rows (bounded, as
    `right` is unique on `on`); all others take the ordinary shuffled join.  A hot null key
    finds nothing: a left join answers its rows without a shuffle.
    """
    on = list(on)
    if hot is None:
        hot = hot_keys(left, on, hot_rows, hot_share)
    nulls = [r for r in hot if any(r[k] is None for k in on)]
    if nulls and how == "left":
        no_key = F.greatest(*[F.col(k).isNull() for k in on]) if len(on) > 1 else F.col(on[0]).isNull()
        missing = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name not in on}
        rest = lookup_join(left.where(~no_key), right, on, how, hot=[r for r in hot if r not in nulls])
        return rest.unionByName(left.where(no_key).withColumns(missing))
    hot = [r for r in hot if r not in nulls]
    if not hot:
        return left.join(right, on, how)
    names = left.sparkSession.createDataFrame(
        [tuple(r[k] for k in on) for r in hot], left.select(*on).schema
    )
    few = right.join(F.broadcast(names), on, "left_semi")
    hot_side = left.join(F.broadcast(names), on, "left_semi").join(F.broadcast(few), on, how)
    cold_side = left.join(F.broadcast(names), on, "left_anti").join(right, on, how)
    return hot_side.unionByName(cold_side)


def fan_out_join(heads: DataFrame, parts: DataFrame, on: Sequence[str], hot: list[Row]) -> DataFrame:
    """Left join of one head per key to its many parts.

    Parts of hot keys stay where they are and meet a broadcast of just those heads
    (bounded by the number of hot keys); all others take the ordinary shuffled join.
    """
    on = list(on)
    if not hot:
        return heads.join(parts, on, "left")
    names = F.broadcast(
        heads.sparkSession.createDataFrame([tuple(r[k] for k in on) for r in hot], heads.select(*on).schema)
    )
    few = heads.join(names, on, "left_semi")
    hot_parts = parts.join(names, on, "left_semi")
    joined = hot_parts.join(F.broadcast(few), on).select(*heads.columns, *[c for c in parts.columns if c not in on])
    bare = few.join(hot_parts.select(*on).distinct(), on, "left_anti")
    cold = heads.join(names, on, "left_anti").join(parts.join(names, on, "left_anti"), on, "left")
    return cold.unionByName(joined).unionByName(bare, allowMissingColumns=True)


def small_enough(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Broadcast hint for `df` when a count proves it small, else `df` unchanged."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
