"""Median, mean and deviation of many features from one gathered array.

Small groups of known size are gathered once, as an array with one array of
feature values per row. All features then share one expression, so plans stay
short however many features there are, and a group costs one buffer instead of
one value map per feature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Values whose statistics are taken at once.
VALUES_AT_ONCE = 1_000_000


def gather(columns: Sequence[str], condition: Column | None = None) -> Column:
    """Aggregate: feature values of all rows of a group that meet the condition."""
    values = F.array(*columns)
    return F.collect_list(values if condition is None else F.when(condition, values))


def median_sql(s: str) -> str:
    """Median of the sorted array ``s``; NULL when empty."""
    return f"(get({s}, shiftright(size({s}) - 1, 1)) + get({s}, shiftright(size({s}), 1))) / 2"


def _statistics(n: int, ddof: int):
    """Column function: median, mean and deviation of each of ``n`` gathered features, one after the other.

    Groups of about equal size are sorted together, values added up in ascending order. The
    functions are nested, so that tasks need no import of this library.
    """

    def of_class(values: np.ndarray, known: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(max(int(size.max()), 1))
        taken = np.minimum(start[:, None] + at, max(len(values) - 1, 0))
        held = (at < size[:, None])[:, :, None] & known[taken]
        count = held.sum(axis=1)
        ordered = np.sort(np.where(held, values[taken], np.nan).transpose(0, 2, 1), axis=2)
        present = at < count[:, :, None]

        def added(x: np.ndarray) -> np.ndarray:
            return np.cumsum(np.where(present, x, 0.0), axis=2)[:, :, -1]

        def ranked(rank: np.ndarray) -> np.ndarray:
            return np.take_along_axis(ordered, np.clip(rank, 0, len(at) - 1)[:, :, None], axis=2)[:, :, 0]

        median = (ranked((count - 1) >> 1) + ranked(count >> 1)) / 2
        mean = added(ordered) / np.maximum(count, 1)
        off = ordered - mean[:, :, None]
        std = np.sqrt(added(off * off) / np.maximum(count - ddof, 1))
        found = np.stack([median, mean, std], axis=2)
        none = np.stack([count < 1, count < 1, count <= ddof], axis=2)
        return found.reshape(len(start), -1), none.reshape(len(start), -1)

    def summed_up(groups: pa.Array) -> pa.Array:
        size = groups.value_lengths().to_numpy()
        start = np.cumsum(size) - size
        flat = groups.flatten().flatten().cast("float64")
        known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, n)
        values = flat.fill_null(0.0).to_numpy().reshape(-1, n)
        found, none = np.zeros((len(size), 3 * n)), np.ones((len(size), 3 * n), bool)
        # sizes up to the same power of two
        kind = np.ceil(np.log2(np.maximum(size, 1)))
        for k in np.unique(kind[size > 0]):
            own = np.flatnonzero((kind == k) & (size > 0))
            found[own], none[own] = of_class(values, known, start[own], size[own])
        ends = pa.array(np.arange(len(size) + 1, dtype=np.int32) * (3 * n))
        return pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1), mask=none.reshape(-1)))

    @F.arrow_udf("array<double>")
    def build(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with np.errstate(all="ignore"):
            for part in parts:
                first = 0
                upto = np.cumsum(part.value_lengths().to_numpy())
                while first < len(part):
                    before = upto[first - 1] if first else 0
                    end = max(first + 1, int(np.searchsorted(upto, before + VALUES_AT_ONCE // n, "right")))
                    yield summed_up(part.slice(first, end - first))
                    first = end

    return build


def gathered_stats(
    grouped: DataFrame, rows: str, names: Sequence[tuple[str, str, str]], ddof: int
) -> DataFrame:
    """Replace the gathered ``rows`` by three columns per feature.

    ``names`` gives the median, mean and deviation column of each feature in the
    order they were gathered. Missing values are skipped; a deviation needs more
    than ``ddof`` values.
    """
    kept = [f"`{c}`" for c in grouped.columns if c != rows]
    df = grouped.withColumn("_s", _statistics(len(names), ddof)(rows))
    return df.selectExpr(
        *kept, *[f"_s[{3 * i + k}] as `{name}`" for i, triple in enumerate(names) for k, name in enumerate(triple)]
    )
