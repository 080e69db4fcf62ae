"""Array columns as small vectors, lists and sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(values: Column) -> Column:
    """Sum of a numeric array as double."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def array_mean(values: Column) -> Column:
    """Mean of a numeric array; NULL when empty."""
    return F.when(F.size(values) > 0, array_sum(values) / F.size(values))


def array_argmax(values: Column) -> Column:
    """0-based position of the first largest element."""
    return F.array_position(values, F.array_max(values)) - 1


def elementwise(left: Column, right: Column, combine) -> Column:
    """Combine two arrays of equal length position by position."""
    return F.zip_with(left, right, combine)


def dot(left: Column, right: Column) -> Column:
    """Inner product in double precision."""
    return array_sum(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")))


def outer(left: Column, right: Column) -> Column:
    """Outer product as an array of rows."""
    return F.transform(left, lambda a: F.transform(right, lambda b: a * b))


def clip_array(values: Column, low: float, high: float) -> Column:
    """Every element limited to [low, high]; NULL and NaN stay as they are."""
    kept = lambda x: x.isNull() | F.isnan(x.cast("double"))
    return F.transform(values, lambda x: F.when(kept(x), x).otherwise(F.least(F.greatest(x, F.lit(low)), F.lit(high))))


def _repeated(value: Column, values: Column) -> Column:
    # one copy per element, so that the value is computed once per row and not once per element inside a lambda
    return F.array_repeat(value, F.size(values))


def softmax(values: Column) -> Column:
    """exp(x - max) / sum(exp(x - max)) along the array, in double precision."""
    largest = _repeated(F.array_max(values).cast("double"), values)
    powers = F.zip_with(values, largest, lambda x, m: F.exp(x.cast("double") - m))
    return F.zip_with(powers, _repeated(array_sum(powers), values), lambda e, total: e / total)


def reshape(values: Column, rows: int, columns: int) -> Column:
    """Cut a flat array into ``rows`` arrays of ``columns`` elements."""
    return F.array(*[F.slice(values, i * columns + 1, columns) for i in range(rows)])


def last_n(values: Column, n: int) -> Column:
    """The last ``n`` elements, or all when there are fewer."""
    start = F.greatest(F.size(values) - n, F.lit(0)) + 1
    return F.slice(values, start, F.lit(n))


def zip_shortest(left: Column, right: Column, names: tuple[str, str] = ("first", "second")) -> Column:
    """Pairs of equal positions, cut to the shorter array."""
    n = F.least(F.size(left), F.size(right))
    pair = lambda a, b: F.struct(a.alias(names[0]), b.alias(names[1]))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1), n), pair)


def positions_where(values: Column, predicate) -> Column:
    """0-based positions of the elements that satisfy the predicate."""
    marked = F.transform(values, lambda x, i: F.when(predicate(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def take_positions(values: Column, positions: Column) -> Column:
    """Elements at 0-based positions."""
    return F.transform(positions, lambda i: F.get(values, i))
