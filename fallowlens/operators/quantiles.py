"""Exact quantiles of groups of any size.

``percentile`` holds every distinct value of a group in one task. Here only groups of a
bounded number of values meet in one place and are sorted there. Of the others a bounded
sketch first brackets each quantile, then only the values inside the bracket are
ranked: about six parts in ten thousand of a large group. Both passes combine on
the map side, so a group may hold any share of the rows. A bracket is ranked in
parts, each a range of its values with the count of all smaller ones, so that even a
whole table's quantile is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sketch accuracy: ranks are off by at most group size / ACCURACY.
ACCURACY = 10000

# Ranges of values into which a bracket is divided.
PARTS = 64

# Values of a group, of all columns together, that one task may sort.
GATHERED = 1_000_000


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, Mapping[str, float]],
    gathered: int = GATHERED,
) -> DataFrame:
    """Interpolated quantiles per group, one output row per group.

    ``columns`` maps each input column to its outputs, ``{name: probability}``.
    NULLs are skipped; a column without values gives NULL. Groups with up to ``gathered``
    values in all are sorted whole, of the others each quantile is bracketed first; the rows
    are the same for any limit. With 0, for a few groups that are whole columns, none is
    gathered and ``df`` is read twice, else up to four times (twice without large groups): hand
    in stored data when it is costly to compute.
    """
    data = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    if not gathered:
        return _bracketed(data, keys, columns)
    # at most one row for so many values of the input, hence broadcast
    sizes = data.groupBy(*keys).agg(F.count("*").alias("_n"))
    names = [F.col(k).alias(f"_k_{k}") for k in keys]
    large = F.broadcast(sizes.filter(F.col("_n") * len(columns) > gathered).select(*names))
    small = _sorted(data.join(large, _same(keys), "left_anti"), keys, columns)
    return small.unionByName(_bracketed(data.join(large, _same(keys), "left_semi"), keys, columns))


def _sorted(data: DataFrame, keys: Sequence[str], columns: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Quantiles of groups whose values one task can sort."""
    held = data.groupBy(*keys).agg(
        *[F.sort_array(F.collect_list(c)).alias(f"_s{i}") for i, c in enumerate(columns)]
    )

    def value(s: Column, p: float) -> Column:
        position = F.lit(float(p)) * (F.size(s) - 1)
        a, b = F.get(s, F.floor(position).cast("int")), F.get(s, F.ceil(position).cast("int"))
        return a + (b - a) * (position - F.floor(position))

    return held.select(
        *keys,
        *[value(F.col(f"_s{i}"), p).alias(name) for i, c in enumerate(columns) for name, p in columns[c].items()],
    )


def _bracketed(data: DataFrame, keys: Sequence[str], columns: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Quantiles of few groups of any size; reads ``data`` twice."""
    targets = [(c, name, p) for c, outs in columns.items() for name, p in outs.items()]
    margin = 3.0 / ACCURACY
    sketches = []
    for i, c in enumerate(columns):
        probs = [
            min(max(p + d, 0.0), 1.0) for p in columns[c].values() for d in (-margin, margin)
        ]
        sketches += [
            F.count(c).alias(f"_n{i}"),
            F.min(c).alias(f"_min{i}"),
            F.max(c).alias(f"_max{i}"),
            F.percentile_approx(c, probs, ACCURACY).alias(f"_q{i}"),
        ]
    sketched = data.groupBy(*keys).agg(*sketches)

    index = {c: i for i, c in enumerate(columns)}
    seen: dict[str, int] = {}
    bounds = []
    for t, (c, _, p) in enumerate(targets):
        i, j = index[c], seen.get(c, 0)
        seen[c] = j + 1
        # groups below the sketch accuracy are ranked whole
        whole = F.col(f"_n{i}") < ACCURACY
        lo = F.when(whole | F.lit(p <= margin), F.col(f"_min{i}"))
        hi = F.when(whole | F.lit(p >= 1 - margin), F.col(f"_max{i}"))
        bounds += [
            F.col(f"_n{i}").alias(f"_size{t}"),
            lo.otherwise(F.get(f"_q{i}", F.lit(2 * j))).alias(f"_lo{t}"),
            hi.otherwise(F.get(f"_q{i}", F.lit(2 * j + 1))).alias(f"_hi{t}"),
        ]
    bounded = sketched.select(*keys, *bounds)

    def part(c: str, t: int) -> Column:
        lo, hi = F.col(f"_lo{t}"), F.col(f"_hi{t}")
        share = F.when(hi > lo, (F.col(c) - lo) / (hi - lo) * PARTS).otherwise(F.lit(0.0))
        return F.when(F.col(c) >= lo, F.least(F.floor(share), F.lit(PARTS - 1))).otherwise(-1).cast("int")

    # Below the bracket only the number of rows matters: those share a NULL value
    # and collapse in the partial aggregate.
    cells = F.array(
        *[
            F.when(
                F.col(c) <= F.col(f"_hi{t}"),
                F.struct(
                    F.lit(t).alias("target"),
                    F.when(F.col(c) >= F.col(f"_lo{t}"), F.col(c)).alias("value"),
                    F.col(f"_size{t}").alias("size"),
                    part(c, t).alias("part"),
                ),
            )
            for t, (c, _, _) in enumerate(targets)
        ]
    )
    # a row per large group: a join by key would bring all rows of a group to one task
    brackets = F.broadcast(bounded.withColumnsRenamed({k: f"_k_{k}" for k in keys}))
    joined = data.join(brackets, _same(keys))
    counts = (
        joined.select(*keys, F.inline(F.filter(cells, lambda s: s.isNotNull())))
        .groupBy(*keys, "target", "size", "part", "value")
        .agg(F.count("*").alias("n"))
    )

    # as many rows as a group has parts
    smaller = Window.partitionBy(*keys, "target").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        counts.groupBy(*keys, "target", "part").agg(F.sum("n").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("target").alias("_t"), F.col("part").alias("_p"), "before")
    )
    within = Window.partitionBy(*keys, "target", "part").orderBy(F.col("value").asc_nulls_first())
    same_part = _same(keys) & (F.col("target") == F.col("_t")) & (F.col("part") == F.col("_p"))
    ranked = counts.join(before, same_part).withColumn(
        "upto", F.col("before") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    prob = F.element_at(
        F.array(*[F.lit(float(p)) for _, _, p in targets]), F.col("target") + 1
    )
    position = prob * (F.col("size") - 1)
    lower = F.floor(position)
    upper = F.ceil(position)
    holds = lambda rank: (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
    picked = (
        ranked.filter(holds(lower) | holds(upper))
        .withColumns({"position": position, "lower": lower, "upper": upper})
        .groupBy(*keys, "target", "position", "lower")
        .agg(
            F.max(F.when(holds(F.col("lower")), F.col("value"))).alias("a"),
            F.max(F.when(holds(F.col("upper")), F.col("value"))).alias("b"),
        )
    )
    missed = F.col("a").isNull() | F.col("b").isNull()
    value = F.when(
        missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    ).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("position") - F.col("lower")))
    found = (
        picked.select(*keys, "target", value.alias("value"))
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col("target") == t, F.col("value"))).alias(f"_v{t}")
                for t in range(len(targets))
            ]
        )
    )
    # groups without any value still get their row
    out = sketched.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).join(
        found, _same(keys), "left"
    )
    return out.select(
        *[F.col(f"_k_{k}").alias(k) for k in keys],
        *[F.col(f"_v{t}").alias(name) for t, (_, name, _) in enumerate(targets)],
    )


def _same(keys: Sequence[str]):
    """Null-safe equality of each key with its renamed copy."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return condition

