"""Mixing sources to target weights by Pfair scheduling.

A source's rows are numbered in a hashed order and cut into blocks. With weight w, a source's block number j (from 1) is released at slot
floor((j - 1) / w) and due at slot ceil(j / w); each slot goes to the released block that is due first. So at every slot each source
is less than one block away from its share. Weights are exact fractions, never rounded. The blocks that each source has placed before any slot
follow from the weights alone (``placed_before``), so tasks work out separate pieces of the schedule. When a source runs out, the next phase
shares its weight among those left, so all rows are placed. Rows are numbered by counts per hash bucket and prefix sums over the
buckets, so a source that holds most of the rows is spread like any other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slots of a piece of the schedule; rows of a block; rows of a hash bucket, about; bound of the number of sources.
SLOTS, BLOCK_ROWS, BUCKET_ROWS, MOST_SOURCES = 1000, 8, 500, 200
#: Exponent of the default weights: 1 keeps the sources' shares, 0 makes them equal.
TEMPERATURE = 0.5


@dataclass(frozen=True)
class Phase:
    """Slots from ``start`` on, until a source runs out; ``done``: blocks of each source before it."""

    number: int
    start: int
    parts: dict[str, int]
    done: dict[str, int]


def exact_parts(weights: Mapping[str, float]) -> dict[str, int]:
    """Weights as whole numbers in exactly the same proportions."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * unit) for s, w in exact.items()}


def placed_before(parts: Mapping[str, int], slot: int) -> dict[str, int]:
    """Blocks of each source in the slots before ``slot``, without working out those slots.

    Every block due by then is placed. The slots that these blocks leave free go to the blocks that are released, but due later: one a source at most.
    A slot is left free when (slots up to it) - (released blocks of the first kind) reaches a new maximum.
    """
    total = sum(parts.values())
    done = {s: slot * c // total for s, c in parts.items()}
    free = slot - sum(done.values())
    late = {s: (done[s] * total // c, -(-(done[s] + 1) * total // c)) for s, c in parts.items() if slot * c % total}
    due = dict(done)
    # No maximum is above this bound, which grows with the slot.
    bound = lambda x: sum(max(0, x * parts[s] - due[s] * total) for s in begun) // total
    begun = list(late)
    x = highest = 0
    while highest < free:
        low, high, step = x + 1, x + 1, 1
        while high < slot and bound(high) <= highest:
            low, high, step = high + 1, min(slot, high + step), 2 * step
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if bound(middle) > highest else (middle + 1, high)
        x = low
        while (value := x - sum(min(-(-x * c // total), due[s]) for s, c in parts.items())) <= highest:
            x += highest - value + 1
        highest = value
        chosen = min((end, s) for s, (release, end) in late.items() if release < x)[1]
        done[chosen] += 1
        del late[chosen]
    return done


def dealt(parts: Mapping[str, int], start: int, stop: int) -> Iterator[tuple[str, int]]:
    """(source, number of its block from 0) for each slot from ``start`` up to ``stop``, earliest deadline first; ties by source."""
    total, done = sum(parts.values()), placed_before(parts, start)
    later = [(done[s] * total // c, s) for s, c in parts.items()]
    heapq.heapify(later)
    waiting: list[tuple[int, str]] = []
    for t in range(start, stop):
        while later and later[0][0] <= t:
            s = heapq.heappop(later)[1]
            heapq.heappush(waiting, (-(-(done[s] + 1) * total // parts[s]), s))
        s = heapq.heappop(waiting)[1]
        yield s, done[s]
        done[s] += 1
        heapq.heappush(later, (done[s] * total // parts[s], s))


def exact_phases(blocks: Mapping[str, int], weights: Mapping[str, float]) -> list[Phase]:
    """Phases of the schedule for the weights as they are; ``parts`` are whole numbers in the weights' proportions. At most one phase per source."""
    left, done, start, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        parts = exact_parts({s: weights[s] for s in left})
        total = sum(parts.values())
        out.append(Phase(len(out), start, parts, dict(done)))
        # Slots until the first source has placed its last block: after a release, and not after a due slot.
        low, high = (min(f(s, n) for s, n in left.items()) for f in (lambda s, n: (n - 1) * total // parts[s] + 1, lambda s, n: -(-n * total // parts[s])))
        while low < high:
            middle = (low + high) // 2
            placed = placed_before(parts, middle)
            low, high = (low, middle) if any(placed[s] >= n for s, n in left.items()) else (middle + 1, high)
        for s, n in placed_before(parts, low).items():
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        start += low
    return out


def block_slots(spark: SparkSession, plan: Sequence[Phase], n_slots: int, piece: int = SLOTS) -> DataFrame:
    """(source, block, slot) of every block; a task works out pieces of the schedule of ``piece`` slots each."""
    ends = [p.start for p in plan[1:]] + [n_slots]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in batch.column(0).to_pylist():
                rows = []
                for phase, end in zip(plan, ends, strict=True):
                    a, b = max(first * piece, phase.start), min((first + 1) * piece, end)
                    if a < b:
                        given = dealt(phase.parts, a - phase.start, b - phase.start)
                        rows += [(s, phase.done[s] + j, slot) for slot, (s, j) in enumerate(given, a)]
                source, block, slot = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(source, pa.string()), pa.array(block, pa.int64()), pa.array(slot, pa.int64())], ["source", "block", "slot"])

    return spark.range(-(-n_slots // piece)).mapInArrow(work, "source string, block bigint, slot bigint")


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, slots: int = SLOTS, temperature: float = TEMPERATURE, bucket_rows: int = BUCKET_ROWS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of ``docs``, each as one value ``row``, with their place in the mixture: source, block (number in its source), slot (number in
    the mixture), position (of the row). All rows, once each; ``columns``: only those of their columns.

    weights: target weight of each source, above 0; without, the number of its rows to the power ``temperature``. A null source is the source ``''``. Sources
    without a weight raise an error. The rows of a source stand in the order of a hash of doc_id and text, then doc_id; rows that
    repeat both stand side by side in any order. ``slots``: slots of the schedule that are worked out in one piece. Null ids and texts are hashed like others; other columns are kept; an empty table gives no
    rows. A block's last rows may be missing, so positions have gaps at the end of a source.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counts = {r["source"]: r["n"] for r in docs.groupBy(source.alias("source")).agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if weights is None:
        weights = {s: float(n) ** temperature for s, n in counts.items()}
    if missing := sorted(s for s in counts if not weights.get(s, 0) > 0):
        raise ValueError(f"no weight above 0 for sources {missing}")
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    plan = exact_phases(blocks, weights)
    spark = docs.sparkSession
    buckets = max(1, -(-max(counts.values(), default=1) // bucket_rows))

    bucket = F.pmod(F.shiftright(hashed, 8), F.lit(buckets))
    row = F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("doc_id"), source.alias("source"), hashed.alias("hash"), bucket.alias("bucket"))
    sizes = docs.select(source.alias("source"), bucket.alias("bucket")).groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and bucket, of four numbers; then the slots of the blocks that its rows lie in.
    starts = sizes.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n")
    block_of = lambda number: F.floor(number / block_rows)
    held = starts.select("source", "bucket", "start", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("start") + F.col("n") - 1))).alias("block"))
    slots_of = held.join(block_slots(spark, plan, sum(blocks.values()), slots), ["source", "block"]).groupBy("source", "bucket", "start")
    slots_of = slots_of.agg(F.array_sort(F.collect_list("slot")).alias("slots"))
    inside = Window.partitionBy("source", "bucket").orderBy("hash", "doc_id")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1).join(slots_of, ["source", "bucket"])
    numbered = numbered.withColumn("number", F.col("start") + F.col("inside")).withColumn("block", block_of(F.col("number")))
    # A source's blocks stand in the order of their slots.
    placed = numbered.withColumn("slot", F.get("slots", (F.col("block") - block_of(F.col("start"))).cast("int")))
    return placed.select("row", "source", "block", "slot", (F.col("slot") * block_rows + F.col("number") % block_rows).alias("position"))


def in_order(mixed: DataFrame) -> DataFrame:
    """The documents in the mixture's order: ranges of positions, sorted, for a writer that keeps rows as they come."""
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def largest_deviation(mixed_slots: list[str], parts: Mapping[str, int]) -> Fraction:
    """Largest distance, in blocks, of any source from its share at any slot of a sequence of sources."""
    slots, seen, worst = sum(parts.values()), dict.fromkeys(parts, 0), Fraction(0)
    for t, s in enumerate(mixed_slots, 1):
        seen[s] += 1
        worst = max(worst, *(abs(Fraction(t * c, slots) - seen[x]) for x, c in parts.items()))
    return worst
