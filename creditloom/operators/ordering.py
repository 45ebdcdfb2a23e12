"""Whole-table order without a whole-table window.

A window with no partition columns moves every row into one task. The operators here cut the
ordered values into ranges instead: a range is chosen by fixed bounds, so any pass (or a retry
after a lost executor) puts a value into the same range. Ranges are cut level by level and their
totals are added up level by level, so neither a task nor the driver holds more with more rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.runtime import materialise, scratch_scope, small_table

# rows one task may order; tables up to this size use a single range
ROWS_PER_RANGE = 1_000_000
# ranges that one range of a level is cut into; more ranges take more levels, so no list grows with the table
FAN = 256
# bounds compared in one step when a value looks for its range
BOUNDS_PER_STEP = 16
# quantile sketches only choose where to look; a wrong bracket costs time, never exactness
SKETCH_K = 1024
SKETCH_SPREAD = 64
GRID_STEPS = 400
BRACKET_STEPS = 3


def range_bounds(df: DataFrame, value: str, ranges: int) -> list[float]:
    """Inner bounds that cut ``value`` into about equal ranges; they are held on the driver, so ``ranges`` must be a small number."""
    if ranges <= 1:
        return []
    found = quantile_grids(df.withColumn("_all", F.lit(0)), "_all", value, ranges)
    return sorted({b for _, grid in found.values() for b in grid[1:-1] if math.isfinite(b)})


def with_range(df: DataFrame, value: str, bounds: list[float], out: str = "range_no") -> DataFrame:
    """Add the range number of each value; nulls go to range -1."""
    if not bounds:
        return df.withColumn(out, F.when(F.col(value).isNull(), -1).otherwise(0).cast("long"))
    cutter = Bucketizer(
        splits=[-math.inf, *bounds, math.inf], inputCol="_as_double", outputCol="_range",
        handleInvalid="keep",
    )
    cut = cutter.transform(df.withColumn("_as_double", F.col(value).cast("double")))
    number = F.when(F.col(value).isNull(), -1).otherwise(F.col("_range")).cast("long")
    return cut.withColumn(out, number).drop("_as_double", "_range")


def with_ranges(df: DataFrame, value: str, ranges: int, fan: int = FAN) -> DataFrame:
    """Add ``range_no``, which rises with ``value``; about ``ranges`` of them, of about equal size, -1 for nulls.

    The first level is cut by at most ``fan`` bounds that the driver holds. Every further level cuts each range into ``fan`` again: one
    aggregation sketches all ranges side by side, and their bounds stay in a stored table that is joined by range. It is stored because
    sketches differ from run to run, and all passes must agree on the range of a value. The rows are stored with the numbers of each level, so
    that no level is worked out again for the next; those of the last level stay.
    """
    out, reached = with_range(df, value, range_bounds(df, value, min(ranges, fan))), fan
    if reached >= ranges:
        return out
    with scratch_scope(df.sparkSession):
        while reached < ranges:
            step = min(fan, math.ceil(ranges / reached))
            number = F.col(value).cast("double")
            solid = out.where(F.col(value).isNotNull() & ~F.isnan(number))
            inner = F.array_sort(F.array_distinct(F.slice("grid", 2, step - 1)))
            cuts = _sketched(solid, "range_no", value, step, max(1, SKETCH_SPREAD // reached)).select(F.col("range_no").alias("_upper"), inner.alias("_cuts"))
            blocks = F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("_cuts") - 1, F.lit(0)), F.lit(BOUNDS_PER_STEP)),
                lambda i: F.slice("_cuts", i + 1, F.lit(BOUNDS_PER_STEP)),
            )
            cuts = materialise(cuts.select("_upper", blocks.alias("_blocks")), "range-cuts")
            block = F.size(F.filter("_blocks", lambda b: F.get(b, F.lit(0)) <= number))
            within = F.size(F.filter(F.get("_blocks", block - 1), lambda c: c <= number))
            local = F.when(block > 0, (block - 1) * BOUNDS_PER_STEP + within).otherwise(0)
            deeper = F.when(F.col("range_no") < 0, F.col("range_no")).otherwise(F.col("range_no") * step + F.coalesce(local, F.lit(0)))
            out = out.join(cuts, F.col("range_no") == F.col("_upper"), "left").withColumn("range_no", deeper).drop("_upper", "_blocks")
            reached *= step
            out = materialise(out, "ranged", keep=reached >= ranges)
    return out


def range_starts(sizes: DataFrame, sums: list[str], by: list[str], fan: int = FAN) -> DataFrame:
    """For every range, the sums over all earlier ranges of its group, as ``_before_<name>``.

    ``sizes`` has a row per (``by``, range_no). Ranges are added up in blocks of ``fan``, blocks of blocks and so on, until few are left,
    so no window holds more than ``fan`` rows of a group, and nothing comes to the driver.
    """
    top = sizes.agg(F.max("range_no")).first()[0]

    def before(table: DataFrame, last: int, shift: int = 0) -> DataFrame:
        block = F.floor((F.col("range_no") + shift) / F.lit(fan)).cast("long")
        up_to = Window.partitionBy(*by, "_block").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
        local = table.withColumn("_block", block).withColumns(
            {f"_before_{s}": F.coalesce(F.sum(s).over(up_to), F.lit(0)).cast(table.schema[s].dataType) for s in sums}
        )
        if last < fan:
            return local.drop("_block")
        blocks = local.groupBy(*by, F.col("_block").alias("range_no")).agg(*[F.sum(s).cast(table.schema[s].dataType).alias(s) for s in sums])
        upper = before(blocks, last // fan).select(
            *[F.col(b).alias(f"_up_{b}") for b in by], F.col("range_no").alias("_up"), *[F.col(f"_before_{s}").alias(f"_add_{s}") for s in sums]
        )
        match = F.col("_block") == F.col("_up")
        for b in by:
            match &= F.col(b).eqNullSafe(F.col(f"_up_{b}"))
        return local.join(upper, match).withColumns({f"_before_{s}": F.col(f"_before_{s}") + F.col(f"_add_{s}") for s in sums}).drop(
            "_block", "_up", *[f"_up_{b}" for b in by], *[f"_add_{s}" for s in sums]
        )

    # the range of nulls is -1
    return before(sizes, 0 if top is None else top + 1, 1).drop("_block", *sums)


class RunningTotals(NamedTuple):
    rows: DataFrame
    totals: dict[object, dict[str, int]]


def running_totals(
    df: DataFrame, value: str, sums: list[str], group: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN,
) -> RunningTotals:
    """Running sums in ascending ``value`` order, per group, over tables of any size.

    ``df`` holds one row per (group, value); null values sort first. Adds ``cum_<name>``,
    this row included, and returns the group totals beside the rows. Groups must be few
    (columns, age bins, features): their totals are held on the driver.
    """
    if group is None:
        df = df.withColumn("_all", F.lit(0))
    by = group or "_all"
    stored = materialise(df.select(by, value, *sums), "running")
    found = stored.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in sums])
    per_group = {r[by]: r.asDict() for r in found.collect()}
    totals = {(g if group else 0): {s: r[s] for s in sums} for g, r in per_group.items()}
    n_rows = sum(r["_n"] for r in per_group.values())
    if n_rows > rows_per_range:
        out = _ranged_sums(stored, by, value, sums, math.ceil(n_rows / rows_per_range), fan)
    else:
        out = _window_sums(stored, by, value, sums)
    keep = ([group] if group else []) + [value, *sums, *[f"cum_{s}" for s in sums]]
    return RunningTotals(out.select(*keep), totals)


def _window_sums(stored: DataFrame, by, value: str, sums: list[str]) -> DataFrame:
    parts = [by] if isinstance(by, str) else by
    window = Window.partitionBy(*parts).orderBy(F.col(value).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return stored.withColumns({f"cum_{s}": F.sum(s).over(window) for s in sums})


def _ranged_sums(stored: DataFrame, by: str, value: str, sums: list[str], ranges: int, fan: int) -> DataFrame:
    ranged = with_ranges(stored, value, ranges, fan)
    sizes = materialise(ranged.groupBy(by, "range_no").agg(*[F.sum(s).alias(s) for s in sums]), "range-sums")
    shift = range_starts(sizes, sums, [by], fan).withColumnsRenamed({by: "_r_by", "range_no": "_r_no"})
    local = _window_sums(ranged, [by, "range_no"], value, sums)
    return local.join(shift, F.col(by).eqNullSafe(F.col("_r_by")) & (F.col("range_no") == F.col("_r_no"))).withColumns(
        {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_before_{s}") for s in sums}
    )


def _numbered(ranged: DataFrame, order: list[Column], out: str, fan: int) -> DataFrame:
    """0-based positions of rows whose ``range_no`` rises with the order."""
    sizes = materialise(ranged.groupBy("range_no").agg(F.count(F.lit(1)).alias("_n")), "range-sizes")
    starts = range_starts(sizes, ["_n"], [], fan)
    local = F.row_number().over(Window.partitionBy("range_no").orderBy(*order)) - 1
    return (
        ranged.withColumn("_local", local)
        .join(starts, "range_no")
        .withColumn(out, F.col("_before__n") + F.col("_local"))
        .drop("range_no", "_local", "_before__n")
    )


def row_index(
    df: DataFrame, key: str, out: str = "row_index", rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN
) -> DataFrame:
    """0-based position of each row in the order of a unique numeric ``key``."""
    # every level passes over the rows again, and they may be dear to compute
    df = materialise(df, "row-index")
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("keyed")).first()
    ranges = math.ceil(size["n"] / rows_per_range)
    if ranges <= 1:
        local = F.row_number().over(Window.partitionBy("range_no").orderBy(key)) - 1
        start = F.when(F.col("range_no") < 0, 0).otherwise(size["n"] - size["keyed"])
        return with_range(df, key, []).withColumn(out, (local + start).cast("long")).drop("range_no")
    return _numbered(with_ranges(df, key, ranges, fan), [F.col(key).asc_nulls_first()], out, fan)


def text_index(
    df: DataFrame, key: str, out: str = "position", rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN
) -> DataFrame:
    """The distinct texts of a column with their 0-based positions in byte order, as a stored table; nulls are left out.

    Texts that begin alike cannot be told apart by a number, so the ranges are Spark's own range partitions of the distinct texts,
    stored with their numbers before anything is counted.
    """
    distinct = materialise(df.select(key).where(F.col(key).isNotNull()).distinct(), "texts")
    ranges = math.ceil(distinct.count() / rows_per_range)
    if ranges <= 1:
        whole = Window.partitionBy(F.lit(0)).orderBy(key)
        return materialise(distinct.withColumn(out, (F.row_number().over(whole) - 1).cast("long")), "text-index")
    ranged = distinct.repartitionByRange(ranges, key).withColumn("range_no", F.spark_partition_id().cast("long"))
    return materialise(_numbered(materialise(ranged, "text-ranges"), [F.col(key)], out, fan), "text-index")


def long_form(df: DataFrame, columns: list[str], *keep: Column) -> DataFrame:
    """Numeric columns as (name, value) rows without nulls, beside what is kept of their row."""
    cells = F.expr(
        "array("
        + ", ".join(
            "named_struct('name', '{}', 'value', CAST(`{}` AS DOUBLE))".format(c.replace("'", "\\'"), c) for c in columns
        )
        + ")"
    )
    return df.select(*keep, F.inline(cells)).where("value IS NOT NULL AND NOT isnan(value)")


def quantile_grids(
    df: DataFrame, group: str, value: str, steps: int = GRID_STEPS
) -> dict[object, tuple[int, list[float]]]:
    """Row count and approximate quantiles at every 1/``steps`` per group, merged in two steps.

    The first step is spread over ``SKETCH_SPREAD`` reducers per group, so no single reducer meets
    the sketches of every map task.
    """
    return {r[group]: (r["n"], list(r["grid"])) for r in _sketched(df, group, value, steps).collect()}


def _sketched(df: DataFrame, group: str, value: str, steps: int, reducers: int = SKETCH_SPREAD) -> DataFrame:
    """What ``quantile_grids`` collects, as a table: group, n, grid. ``reducers`` share a group; many groups need but one each."""
    spread = F.pmod(F.spark_partition_id(), F.lit(reducers)).alias("_spread")
    parts = (
        df.select(group, F.col(value).cast("double").alias("_v"), spread)
        .groupBy(group, "_spread")
        .agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("sketch"))
    )
    grid = F.expr("array(" + ", ".join(f"{i / steps}D" for i in range(steps + 1)) + ")")
    merged = parts.groupBy(group).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch")
    )
    return merged.select(group, "n", F.kll_sketch_get_quantile_double("sketch", grid).alias("grid")).where("n > 0")


def _brackets(sizes: dict, targets: dict) -> list[tuple[object, list[dict[str, float]]]]:
    """Per group, value brackets that should contain the target ranks."""
    brackets = []
    for g, ranks in targets.items():
        n, grid = sizes[g]
        spans = []
        for rank in ranks:
            spot = rank / max(n - 1, 1) * GRID_STEPS
            low, high = math.floor(spot) - BRACKET_STEPS, math.ceil(spot) + BRACKET_STEPS
            spans.append(
                (
                    -math.inf if low <= 0 else grid[low],
                    math.inf if high >= GRID_STEPS else grid[high],
                )
            )
        brackets.append((g, _merge(spans)))
    return brackets


def _ask(df: DataFrame, by: str, rows: list[tuple], *names: str) -> DataFrame:
    fields = [T.StructField(n, T.LongType()) for n in names]
    return F.broadcast(small_table(df.sparkSession, rows, T.StructType([df.schema[by], *fields])))


def _merge(spans: list[tuple[float, float]]) -> list[dict[str, float]]:
    merged: list[list[float]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [{"low": low, "high": high} for low, high in merged]


def order_statistics(
    df: DataFrame, value: str, ranks_of, group: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> dict[object, dict[int, object]]:
    """Exact values at given 0-based ranks, per group.

    ``ranks_of(group, n)`` names the ranks wanted from ``n`` values. One pass sketches each
    group, the next counts every value outside the sketched brackets into its gap and keeps
    distinct values only inside them, so a few percent of the values are shuffled. A rank that the
    brackets turn out to miss is answered from the full set of distinct values.
    """
    if group is None:
        df = df.withColumn("_all", F.lit(0))
    by = group or "_all"
    df = df.select(by, value).where(F.col(value).isNotNull() & F.col(by).isNotNull())
    sizes = quantile_grids(df, by, value)
    targets = {g: sorted(set(ranks_of(g, n))) for g, (n, _) in sizes.items() if n}
    targets = {g: ranks for g, ranks in targets.items() if ranks}
    if not targets:
        return {}
    brackets = _brackets(sizes, targets)
    got = _values_at(df, by, value, targets, brackets, rows_per_range)
    lost = {g: [r for r in ranks if r not in got.get(g, {})] for g, ranks in targets.items()}
    lost = {g: ranks for g, ranks in lost.items() if ranks}
    if lost:
        whole = [(g, [{"low": -math.inf, "high": math.inf}]) for g in lost]
        again = _values_at(df, by, value, lost, whole, rows_per_range)
        for g, found in again.items():
            got.setdefault(g, {}).update(found)
    return got


def _span_table(df: DataFrame, by: str, brackets: list) -> tuple[DataFrame, int]:
    """Brackets as one wide row per group, padded with brackets no value can reach."""
    width = max(len(spans) for _, spans in brackets)
    never = {"low": math.inf, "high": math.inf}
    rows = [
        (g, *[s[side] for s in spans + [never] * (width - len(spans)) for side in ("low", "high")])
        for g, spans in brackets
    ]
    fields = [T.StructField(f"_{side}_{i}", T.DoubleType()) for i in range(width) for side in ("low", "high")]
    table = small_table(df.sparkSession, rows, T.StructType([df.schema[by], *fields]))
    return F.broadcast(table), width


def _values_at(df, by, value, targets, brackets, rows_per_range) -> dict[object, dict[int, object]]:
    table, width = _span_table(df, by, brackets)
    v = f"CAST(`{value}` AS DOUBLE)"
    # brackets wholly below a value: for a value inside a bracket this is the bracket's number
    below = F.expr(" + ".join(f"CAST(_high_{i} < {v} AS INT)" for i in range(width)))
    inside = F.expr(" OR ".join(f"({v} BETWEEN _low_{i} AND _high_{i})" for i in range(width)))
    counted = (
        df.join(table, by)
        .select(by, below.alias("span"), F.when(inside, F.col(value)).alias("v"))
        .groupBy(by, "span", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = materialise(counted, "ranks")
    outside: dict[tuple, int] = {}
    within: dict[tuple, int] = {}
    n_distinct = 0
    sizes = counted.groupBy(by, "span", F.col("v").isNull().alias("out")).agg(
        F.sum("n").alias("n"), F.count("v").alias("n_distinct")
    )
    for r in sizes.collect():
        (outside if r["out"] else within)[(r[by], r["span"])] = r["n"]
        n_distinct += r["n_distinct"]

    wanted = []
    for g, ranks in targets.items():
        for span in sorted(s for group, s in within if group == g):
            before = sum(n for (group, s), n in outside.items() if group == g and s <= span)
            before += sum(n for (group, s), n in within.items() if group == g and s < span)
            size = within[(g, span)]
            wanted += [(g, rank, span, rank - before) for rank in ranks if before <= rank < before + size]
    if not wanted:
        return {}
    ask = _ask(df, by, wanted, "rank", "span", "inner_rank")
    kept = counted.where("v IS NOT NULL")
    if n_distinct <= rows_per_range:
        running = _window_sums(kept, [by, "span"], "v", ["n"])
    else:
        part = F.concat_ws("|", F.col(by).cast("string"), "span")
        keys = kept.select(by, "span").distinct().withColumn("part", part)
        sums = running_totals(kept.select(part.alias("part"), "v", "n"), "v", ["n"], "part", rows_per_range)
        running = sums.rows.join(F.broadcast(keys), "part")
    hits = running.join(ask, [by, "span"]).where("cum_n - n <= inner_rank AND inner_rank < cum_n")
    out: dict[object, dict[int, object]] = defaultdict(dict)
    for r in hits.select(by, "rank", "v").collect():
        out[r[by]][r["rank"]] = r["v"]
    return dict(out)


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], rows_per_range: int = ROWS_PER_RANGE
) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of many numeric columns, nulls and NaN left out."""
    if not columns:
        return {}

    def ranks(_, n):
        spots = [p * (n - 1) for p in probabilities]
        return [math.floor(s) for s in spots] + [math.ceil(s) for s in spots]

    sizes: dict[str, int] = {}

    def remember(name, n):
        sizes[name] = n
        return ranks(name, n)

    found = order_statistics(long_form(df, columns), "value", remember, "name", rows_per_range)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in found:
            out[c] = [None] * len(probabilities)
            continue
        n, at = sizes[c], found[c]
        out[c] = []
        for p in probabilities:
            spot = p * (n - 1)
            low, high = at[math.floor(spot)], at[math.ceil(spot)]
            out[c].append(low + (high - low) * (spot - math.floor(spot)))
    return out


def exact_medians(df: DataFrame, columns: list[str], rows_per_range: int = ROWS_PER_RANGE) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], rows_per_range).items()}


# fixed values: share of the newest applications held out, and the number of time folds
HOLDOUT_SHARE = 0.20
TIME_FOLDS = 5


def first_holdout_key(df: DataFrame, key: str, holdout: float = HOLDOUT_SHARE) -> object | None:
    """Smallest key of the holdout; null when the holdout is empty."""
    found = order_statistics(df, key, lambda _, n: [min(int(n * (1 - holdout)), n - 1)])
    return next(iter(found[0].values())) if found else None


def temporal_split(
    df: DataFrame, key: str, holdout: float = HOLDOUT_SHARE, out: str = "split"
) -> DataFrame:
    """Mark the first share of the keys "train" and the rest "holdout".

    Finding the boundary key reads one column; the rows themselves are not sorted or moved.
    """
    boundary = first_holdout_key(df, key, holdout)
    return df.withColumn(out, F.when(F.col(key) < F.lit(boundary), "train").otherwise("holdout"))


def time_folds(df: DataFrame, key: str, folds: int = TIME_FOLDS, out: str = "fold") -> DataFrame:
    """Number the test slice each row belongs to; 0 is only ever trained on.

    Each of the ``folds`` slices holds ``n div (folds + 1)`` rows at the end of the key order;
    fold ``i`` trains on every row with a smaller number.
    """
    def starts(_, n):
        size = n // (folds + 1)
        if size == 0:
            raise ValueError(f"{n} rows are too few for {folds} folds")
        return [n - (folds - i) * size for i in range(folds)]

    found = order_statistics(df, key, starts)
    edges = sorted(found[0].values()) if found else []
    number: Column = F.lit(0)
    for edge in edges:
        number = number + (F.col(key) >= F.lit(edge)).cast("int")
    return df.withColumn(out, number)


# bytes of a text that one number holds exactly, as a double as well, beside how many there are
CODE_BYTES = 6


def text_at_rank(df: DataFrame, key: str, rank: int) -> str:
    """The text at a 0-based rank in byte order, found by a few bytes at a time behind what all candidates share."""
    while True:
        low, high = df.agg(F.min(key), F.max(key)).first()
        if low == high:
            return low
        first, last = low.encode(), high.encode()
        shared = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
        part = F.substring(F.col(key).cast("binary"), shared + 1, CODE_BYTES)
        number = F.conv(F.rpad(F.hex(part), 2 * CODE_BYTES, "0"), 16, 10).cast("long")
        coded = df.withColumn("_code", number * (CODE_BYTES + 1) + F.octet_length(part))
        code = order_statistics(coded, "_code", lambda _, n: [rank])[0][rank]
        rank -= coded.where(F.col("_code") < code).count()
        df = coded.where(F.col("_code") == code).drop("_code")


#: Rows a task may keep to skip them, and the steps of the grid that narrows down to so few.
ROWS_SKIPPED, SEEK_STEPS = 10_000, 500


def _next_to(value: int | float, side: int) -> int | float:
    """The neighbour of a number, below (-1) or above (1) it."""
    return value + side if isinstance(value, int) else math.nextafter(value, side * math.inf)


def narrowed(df: DataFrame, value: str, rank: int, most: int = ROWS_SKIPPED) -> tuple[object, int] | None:
    """A value at or before the 0-based ``rank`` in ascending order, and how many rows lie below it; None beyond the last row.

    At most ``most`` rows lie from it to the rank, unless that many share the value. Every round is one aggregation: it counts the rows below
    and inside the bracket of the round before, and lays a sketched grid over the inside, of which the next bracket is a few steps. The counts
    are exact and decide; a sketch that misses costs a round.
    """
    v, steps = F.col(value), [i / SEEK_STEPS for i in range(SEEK_STEPS + 1)]
    low = high = None  # the bracket in which the rank is known to lie
    guess = None
    while True:
        if guess is None:
            below, inside = F.lit(False), v.isNotNull()
        else:
            below, inside = v < F.lit(guess[0]), v.between(F.lit(guess[0]), F.lit(guess[1]))
        grid = F.percentile_approx(F.when(inside, v), F.array(*map(F.lit, steps)), 10 * SEEK_STEPS)
        row = df.agg(F.count_if(below).alias("below"), F.count_if(inside).alias("inside"), grid.alias("grid")).first()
        if row["below"] <= rank < row["below"] + row["inside"]:
            before, cuts = row["below"], row["grid"]
            low, high = cuts[0], cuts[-1]
            if rank - before + 1 <= most or low == high:
                return low, before
            at = int((rank - before) / row["inside"] * SEEK_STEPS)
            better = cuts[max(0, at - 1)], cuts[min(SEEK_STEPS, at + 2)]
            # many rows at both ends: a half of the bracket instead
            guess = better if better != (low, high) else (low, low + (high - low) // 2 if isinstance(low, int) else low + (high - low) / 2)
        elif guess is None:
            return None
        elif rank < row["below"]:
            guess = low, _next_to(guess[0], -1)
        else:
            guess = _next_to(guess[1], 1), high


def seek_page(df: DataFrame, time: str, key: str, limit: int, offset: int, skipped: int = ROWS_SKIPPED) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in newest-first order, equal times by rising key.

    Spark's own offset keeps every skipped row of each task in memory. Here the rank is first narrowed down to a time with few rows between, and, if
    very many rows share that time, to a key among them, a number or a text; Spark skips what is left, ``skipped`` rows at most.
    """
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be between 1 and 1000")
    if offset < 0:
        raise ValueError("offset must not be negative")
    order = [F.col(time).desc(), F.col(key).asc()]
    if offset == 0:
        return df.orderBy(*order).limit(limit)
    # time runs backwards; rows without a time come last
    timed = df.withColumn("_back", F.coalesce(-F.unix_micros(F.col(time).cast("timestamp")), F.lit(2**63 - 1)))
    found = narrowed(timed, "_back", offset, skipped)
    if found is None:
        return df.limit(0)
    edge, before = found
    rest, skip = F.col("_back") >= F.lit(edge), offset - before
    if skip >= skipped:
        same = timed.where(F.col("_back") == F.lit(edge))
        n_null = same.where(F.col(key).isNull()).count()
        if skip >= n_null:
            keyed = same.where(F.col(key).isNotNull())
            if isinstance(df.schema[key].dataType, T.StringType):
                start = text_at_rank(keyed.select(key), key, skip - n_null)
                before = keyed.where(F.col(key) < F.lit(start)).count()
            else:
                start, before = narrowed(keyed, key, skip - n_null, skipped)
            rest = (F.col("_back") > F.lit(edge)) | ((F.col("_back") == F.lit(edge)) & (F.col(key) >= F.lit(start)))
            skip -= n_null + before  # of rows that share time and key, or are few
    return timed.where(rest).drop("_back").orderBy(*order).offset(skip).limit(limit)
