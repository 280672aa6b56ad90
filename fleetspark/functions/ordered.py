"""Global order statistics without a global sort task.

``Window.orderBy`` without a partition moves every row to one task. Here the rows are cut into ranges
of the whole order tuple, twice as many as the session's shuffle partitions: Spark samples tuples for
the splits, so that rows which tie in the first columns are still spread by the next ones. Range
totals are a bounded frame that is summed once and broadcast, and the exact order is resolved inside
each range in parallel. Ranges are written once with their number; the splits only decide the
balance, never the result. Ties in all columns are collapsed by a grouped pre-aggregation: a tuple
shared by a third of all rows is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage


def _direction(order: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order]


def ranges(df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """``df`` with ``_bucket``, ascending in ``order``, as a written table; NULLs come last."""
    n = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The rows are read twice, for the splits and for the ranges, so they are written first.
    dealt = stage(df, "unordered").repartitionByRange(n, *_direction(order))
    return stage(dealt.withColumn("_bucket", F.spark_partition_id()), "ordered")


def running_totals(
    df: DataFrame, order: list[tuple[str, bool]], sums: list[str], by: list[str] | None = None
) -> DataFrame:
    """Add ``<c>_before`` (sum over strictly earlier rows) for every column of ``sums``.

    ``order`` is a list of (column, descending) that identifies a row within ``by``. NULLs sort last.
    """
    by = by or []
    keyed = ranges(df, order)

    totals = keyed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = Window.partitionBy(*by, F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    keyed = _attach_small(keyed, offsets, [*by, "_bucket"])
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(*_direction(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = {
        f"{c}_before": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums
    }
    return keyed.withColumns(before).drop("_bucket", *[f"_o_{c}" for c in sums])


def _attach_small(df: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """Join a frame of bounded size: one row without ``by``, otherwise at most one row per key."""
    if not by:
        return df.crossJoin(F.broadcast(small))
    right = small.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in small.columns if c not in by])
    condition = None
    for c in by:
        same = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        condition = same if condition is None else condition & same
    joined = df.join(F.broadcast(right) if by == ["_bucket"] else right, condition, "left")
    return joined.drop(*[f"_k_{c}" for c in by])


def global_rank(df: DataFrame, order: list[tuple[str, bool]], name: str, unique: bool = False) -> DataFrame:
    """SQL ``rank()`` over the whole frame. ``unique`` says the order columns identify a row."""
    columns = [c for c, _ in order]
    if unique:
        ranked = running_totals(df.withColumn("_n", F.lit(1).cast("bigint")), order, ["_n"])
        return ranked.withColumn(name, F.col("_n_before") + 1).drop("_n", "_n_before")
    df = stage(df, "ranked")
    ties = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(ties, order, ["_n"]).select(
        *[F.col(c).alias(f"_r_{c}") for c in columns], (F.col("_n_before") + 1).alias(name)
    )
    condition = None
    for c in columns:
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        condition = same if condition is None else condition & same
    return df.join(ranks, condition, "inner").drop(*[f"_r_{c}" for c in columns])


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows of (``by``, probability, quantile).

    Values are first counted per distinct value; only the two order statistics next to each
    requested rank leave the distributed running totals.
    """
    by = by or []
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    counted = stage(counted, "distinct_values")
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("_total"))
    placed = _attach_small(running_totals(counted, [(value, False)], ["_n"], by), totals, by)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    last = F.col("_n_before") + F.col("_n") - 1
    touched = F.filter(
        wanted,
        lambda q: (F.ceil(q * (F.col("_total") - 1)) >= F.col("_n_before"))
        & (F.floor(q * (F.col("_total") - 1)) <= last),
    )
    return (
        placed.withColumn("probability", F.explode(touched))
        .select(
            *by,
            "probability",
            (F.col("probability") * (F.col("_total") - 1)).alias("_pos"),
            F.col("_n_before").alias("_from"),
            last.alias("_to"),
            F.col(value).alias("_v"),
        )
        .groupBy(*by, "probability", "_pos")
        .agg(
            F.max(F.when(F.floor("_pos").between(F.col("_from"), F.col("_to")), F.col("_v"))).alias("_lo"),
            F.max(F.when(F.ceil("_pos").between(F.col("_from"), F.col("_to")), F.col("_v"))).alias("_hi"),
        )
        .select(
            *by,
            "probability",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))).alias(
                "quantile"
            ),
        )
    )


def share_of_total(df: DataFrame, shares: dict[str, str]) -> DataFrame:
    """Add ``name = column / sum(column)``; the totals are one broadcast row."""
    totals = df.agg(*[F.sum(c).alias(f"_s_{n}") for n, c in shares.items()])
    out = df.crossJoin(F.broadcast(totals))
    new: dict[str, Column] = {
        n: F.try_divide(F.col(c).cast("double"), F.col(f"_s_{n}").cast("double")) for n, c in shares.items()
    }
    return out.withColumns(new).drop(*[f"_s_{n}" for n in shares])


#: Rank error of the sketches that bracket a median, as a share 1/``ACCURACY`` of its group's rows.
ACCURACY = 10_000


def medians(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(``by``, ``columns``): the exact medians of many columns and groups at once, NULLs left out.

    A first pass brackets all medians by mergeable sketches of a fixed size, a second one counts the
    values below each bracket, a third one counts the distinct values inside, of which there are a
    few for each ``ACCURACY`` rows of a group. No group's values meet in one task: only those inside
    its bracket do, already counted.
    """
    margin = 2.0 / ACCURACY
    marks = [F.lit(0.5 - margin), F.lit(0.5 + margin)]
    typed = df.select(*by, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    places = range(len(columns))
    brackets = typed.groupBy(*by).agg(
        *[F.count(f"_{i}").alias(f"_n{i}") for i in places],
        *[F.percentile_approx(f"_{i}", F.array(*marks), ACCURACY).alias(f"_b{i}") for i in places],
    )
    brackets = stage(brackets, "brackets")
    known = _attach_small(typed, brackets.select(*by, *[f"_b{i}" for i in places]), by)
    low, high = (lambda i: F.get(f"_b{i}", 0)), (lambda i: F.get(f"_b{i}", 1))
    below = known.groupBy(*by).agg(*[F.count_if(F.col(f"_{i}") < low(i)).alias(f"_m{i}") for i in places])
    entry = lambda i: F.struct(F.lit(i).alias("_i"), F.col(f"_{i}").alias("_v"))
    inside = F.array_compact(F.array(*[F.when(F.col(f"_{i}").between(low(i), high(i)), entry(i)) for i in places]))
    counted = known.select(*by, F.explode(inside).alias("_e")).groupBy(*by, "_e._i", "_e._v").agg(F.count("*").alias("_n"))

    counts = _attach_small(brackets, below, by)
    sizes = counts.select(
        *by, F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_all"), F.col(f"_m{i}").alias("_below")) for i in places]))
    )
    placed = _attach_small(counted, sizes, [*by, "_i"])
    before = Window.partitionBy(*by, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_below") + F.coalesce(F.sum("_n").over(before), F.lit(0))
    placed = placed.withColumn("_first", first).withColumn("_last", F.col("_first") + F.col("_n") - 1)
    middle = placed.withColumns({"_k": F.floor((F.col("_all") - 1) / 2), "_l": F.ceil((F.col("_all") - 1) / 2)})
    at = lambda k: F.max(F.when(F.col(k).between(F.col("_first"), F.col("_last")), F.col("_v")))
    found = middle.groupBy(*by, "_i").agg(at("_k").alias("_a"), at("_l").alias("_b"))
    value = F.coalesce((F.col("_a") + F.col("_b")) / 2, F.raise_error(F.lit("a median lies outside its bracket")).cast("double"))
    wide = found.withColumn("_v", value).groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(c) for i, c in enumerate(columns)])
    return _attach_small(brackets.select(*by), wide, by)
