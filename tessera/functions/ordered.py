"""Ordered scans that stay parallel when one key holds a large share of rows.

A window `partitionBy(key).orderBy(x)` sends every row of a key to one task.
These helpers instead range-partition on `(key, x)` so a hot key is spread over
many partitions, number rows per partition, and combine the small per-partition
counts into global positions (the way `zipWithIndex` does it).

The range-sorted data is checkpointed to the reliable checkpoint folder, so both
passes see the same partitions even if an executor is lost in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import ensure_checkpoint_dir

PART = "_part"
MID = "_mid"
RANK = "_rank"
COUNT = "_n"

def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


TARGET_PARTITION_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60     # estimates from here on stand for "unknown" (products of joins)


def num_partitions(df: DataFrame, requested: int | None = None) -> int:
    """Range partitions for an ordered scan: the estimated input size over 128 MB,
    at least the default parallelism; `spark.sql.shuffle.partitions` if the size is unknown."""
    if requested:
        return int(requested)
    spark = df.sparkSession
    default = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        # Joins are estimated as products; no scan here grows its input more than eightfold.
        est = min(int(str(plan.stats().sizeInBytes())), 8 * read)
        floor_ = max(spark.sparkContext.defaultParallelism, 1)
        return default if est >= UNKNOWN_BYTES else int(max(floor_, -(-est // TARGET_PARTITION_BYTES)))
    except Exception:  # noqa: BLE001 - statistics unavailable: use the configured count
        return default


def range_sorted(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str | Column],
                 partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Range-partition on keys + order, sort inside partitions, tag `_part`, `_mid`.

    `_mid` increases with the row position inside a partition, so
    `_mid - min(_mid)` is the local row index. The input is persisted while
    the range bounds are sampled and the shuffle runs, so an expensive lineage
    is computed once; the checkpoint then cuts it.
    """
    from pyspark import StorageLevel
    n = num_partitions(df, partitions)
    sort_cols = _cols(list(key_cols)) + _cols(list(order_cols))
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if checkpoint else df
    out = (
        src.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(MID, F.monotonically_increasing_id())
    )
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        # Persisted so the checkpoint write does not recompute the sort.
        sorted_ = out.persist(StorageLevel.MEMORY_AND_DISK)
        out = sorted_.checkpoint(eager=True)
        sorted_.unpersist()
        src.unpersist()
    return out


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a derived side table on equal keys, null equal to null. Whether it is
    broadcast is left to Spark, which knows its size in bytes."""
    side = small.withColumnsRenamed({c: f"_side_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_side_{c}")) for c in on]
    return big.join(side, same, how).drop(*[f"_side_{c}" for c in on])


def rank_within(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str | Column],
                partitions: int | None = None) -> DataFrame:
    """Add `_rank` (0-based position inside the key, by order) and `_n` (key size).

    Null keys form a group of their own. No task ever holds more than one partition.
    """
    keys = list(key_cols)
    x = range_sorted(df, keys, order_cols, partitions)
    per_part = x.groupBy(PART, *keys).agg(
        F.count(F.lit(1)).alias("_n_local"), F.min(MID).alias("_mid0"))
    # One row per (partition, key): the window below is over at most
    # `partitions` rows per key, never over data rows.
    per_part = per_part.withColumn(
        "_offset",
        F.sum("_n_local").over(Window.partitionBy(*keys).orderBy(PART)) - F.col("_n_local"),
    ).withColumn(COUNT, F.sum("_n_local").over(Window.partitionBy(*keys)))
    out = join_small(x, per_part.select(PART, *keys, "_offset", "_mid0", COUNT), [PART, *keys])
    return out.withColumn(RANK, F.col("_offset") + F.col(MID) - F.col("_mid0")).drop(
        "_offset", "_mid0")


BUCKETS = 1024              # buckets an open value range is cut into
GATHERED = 65_536           # values of a range that are gathered and sorted in one cell


def _open_rows(long: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values that lie in one of the open ranges of their key and measure (ranges of one key
    and measure are equal or disjoint, so no value comes twice)."""
    side = ranges.select(*[F.col(c).alias(f"_r_{c}") for c in (*keys, "_m")], "_lo", "_hi").distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    same += [F.col("_m") == F.col("_r__m"), F.col("_v").between(F.col("_lo"), F.col("_hi"))]
    return long.join(side, same).select(*keys, "_m", "_lo", "_hi", "_v")


def _magnitude(c: str) -> Column:
    """Sign and eighth power of two of a number, in its order."""
    v = F.col(c)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * (F.floor(F.log2(F.abs(v)) * 8) + 8800)).cast("long")


def exact_quantiles(df: DataFrame, key_cols: Sequence[str],
                    measures: Mapping[str, tuple[str | Column, Mapping[str, float]]]) -> DataFrame:
    """Exact linearly interpolated percentiles of several columns per key, at (n-1)*p/100.

    Selection by counting, without a sort: rows are counted by magnitude, the bucket that
    holds a wanted rank, bounded by its own least and greatest value, is cut into equal
    widths and counted again, until its few values can be gathered: two or three passes, at
    most seven for any values. All measures and percentiles share the passes; rows never
    move, only counts do. `measures`: name -> (column, {output column: percent}). Null and
    non-finite values are ignored; keys without a value are absent.
    """
    keys = list(key_cols)
    items = list(measures.values())
    for _, percents in items:
        if any(p < 0 or p > 100 for p in percents.values()):
            raise ValueError("percent must be between 0 and 100")
    value = [(F.col(c) if isinstance(c, str) else c).cast("double") for c, _ in items]
    if len(items) == 1:
        long = df.select(*keys, F.lit(0).alias("_m"), value[0].alias("_v"))
    else:
        long = df.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(i).alias("_m"), v.alias("_v")) for i, v in enumerate(value)])).alias("_s")).select(*keys, "_s.*")
    long = long.where(F.col("_v").between(-1.7976931348623157e308, 1.7976931348623157e308))

    def at(percent: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(percent)) / F.lit(100)

    ranks = None
    for i, (_, percents) in enumerate(items):
        lows = [F.floor(at(p)) for p in percents.values()]
        own = F.array(*lows, *[F.least(r + 1, F.col("_total") - 1) for r in lows])
        ranks = F.when(F.col("_m") == i, own) if ranks is None else ranks.when(F.col("_m") == i, own)
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quantiles-{uuid.uuid4().hex}"

    def kept(state: DataFrame, n: int) -> tuple[DataFrame, int | None]:
        """The ranks and their ranges, a few rows a key, written down between passes; and the largest open range."""
        seen = Observation()
        size = F.when(F.col("_lo") < F.col("_hi"), F.col("_size"))
        state.observe(seen, F.max(size).alias("largest")).write.parquet(f"{folder}/{n}")
        return df.sparkSession.read.schema(state.schema).parquet(f"{folder}/{n}"), seen.get["largest"]

    count = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi")]
    state = ["_m", "_total", "_r", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi")]
    by_bucket = Window.partitionBy(*keys, "_m")             # at most some 34,000 rows a key and column
    first = (long.groupBy(*keys, "_m", _magnitude("_v").alias("_b")).agg(*count)
             .withColumn("_total", F.sum("_c").over(by_bucket))
             .withColumn("_below", F.sum("_c").over(by_bucket.orderBy("_b")) - F.col("_c"))
             .withColumn("_r", F.explode(F.array_distinct(ranks)))
             .where((F.col("_r") >= F.col("_below")) & (F.col("_r") < F.col("_below") + F.col("_c"))))
    targets, largest = kept(first.select(*keys, *state, "_below", F.col("_c").alias("_size")), 0)
    n = 0
    while True:
        open_ = targets.where(F.col("_lo") < F.col("_hi"))
        if largest is None:
            found = targets.withColumn("_value", F.col("_lo"))
            break
        rows = _open_rows(long, open_, keys)
        bounds = [*keys, "_m", "_lo", "_hi"]
        if largest <= GATHERED:
            cells = rows.groupBy(*bounds).agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
            picked = join_small(open_, cells, bounds).withColumn("_value", F.get("_vs", F.col("_r") - F.col("_below"))).drop("_vs")
            found = targets.where(F.col("_lo") >= F.col("_hi")).withColumn("_value", F.col("_lo")).unionByName(picked)
            break
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        counts = (rows.withColumn("_b", F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)))
                  .groupBy(*bounds, "_b").agg(*count))
        before = F.sum("_c").over(Window.partitionBy(*bounds).orderBy("_b")) - F.col("_c")    # at most BUCKETS rows a range
        inside = F.col("_r") - F.col("_below") - F.col("_before")
        narrowed = (join_small(open_, counts.withColumn("_before", before), bounds)
                    .where((inside >= 0) & (inside < F.col("_c")))
                    .select(*keys, *state, (F.col("_below") + F.col("_before")).alias("_below"), F.col("_c").alias("_size")))
        n += 1
        targets, largest = kept(targets.where(F.col("_lo") >= F.col("_hi")).unionByName(narrowed), n)
    aggs = []
    for i, (_, percents) in enumerate(items):
        for name, p in percents.items():
            low = F.floor(at(p))
            lo_v = F.max(F.when((F.col("_m") == i) & (F.col("_r") == low), F.col("_value")))
            hi_v = F.max(F.when((F.col("_m") == i) & (F.col("_r") == F.least(low + 1, F.col("_total") - 1)), F.col("_value")))
            part = F.max(F.when(F.col("_m") == i, at(p) - low))
            aggs.append((lo_v + (hi_v - lo_v) * part).alias(name))
    return found.groupBy(*keys).agg(*aggs)


def exact_percentiles(df: DataFrame, key_cols: Sequence[str], value_col: str,
                      percents: Mapping[str, float], partitions: int | None = None) -> DataFrame:
    """Exact percentiles of one column (see `exact_quantiles`). `partitions` is accepted for
    callers that asked for a number of ranges; rows are no longer dealt out, so it has no effect."""
    return exact_quantiles(df, key_cols, {value_col: (value_col, percents)})


def _changes(batch, keys: list[str]):
    """True where a row's key differs from the row before it in the batch (null equals null);
    compared in Arrow, so integers and nulls stay what they are."""
    import numpy as np
    import pyarrow.compute as pc
    new = np.zeros(batch.num_rows, dtype=bool)
    for k in keys:
        a, b = batch.column(k)[1:], batch.column(k)[:-1]
        equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        new[1:] |= ~equal.to_numpy(zero_copy_only=False)
    return new


def _key_at(batch, keys: list[str], i: int) -> tuple:
    return tuple(batch.column(k)[i].as_py() for k in keys)


def _with(batch, schema, *arrays):
    """The batch with further columns, under the output schema."""
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, *arrays], schema)], schema=schema)


def _local_cumsum(keys: list[str], value_col: str, schema, op: str = "sum"):
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        last_key, carry = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = _changes(b, keys)
            going_on = last_key is not None and _key_at(b, keys, 0) == last_key
            seg = np.cumsum(new)
            vals = pd.Series(pc.fill_null(b.column(value_col).cast(pa.int64()), 0).to_numpy(zero_copy_only=False))
            if op == "sum":
                cs = vals.groupby(seg).cumsum().to_numpy()
                if going_on:
                    cs[seg == 0] += carry
            else:
                cs = vals.groupby(seg).cummax().to_numpy()
                if going_on:
                    cs[seg == 0] = np.maximum(cs[seg == 0], carry)
            last_key, carry = _key_at(b, keys, b.num_rows - 1), int(cs[-1])
            yield _with(b, schema, pa.array(cs, pa.int64()))
    return run


def running_sum_within(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str | Column],
                       value_col: str, out_col: str, partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of an integer column in (key, order) order.

    Partition-local sums run in one streaming pass over the range-sorted
    partitions; the per-(partition, key) totals are combined into offsets.
    """
    keys = list(key_cols)
    x = range_sorted(df, keys, order_cols, partitions)
    per_part = x.groupBy(PART, *keys).agg(F.sum(value_col).cast("long").alias("_s_local"))
    per_part = per_part.withColumn(
        "_offset",
        F.sum("_s_local").over(Window.partitionBy(*keys).orderBy(PART)) - F.col("_s_local"),
    ).drop("_s_local")
    schema = T.StructType(x.schema.fields + [T.StructField(out_col, T.LongType())])
    local = x.mapInArrow(_local_cumsum(keys, value_col, to_arrow_schema(schema)), schema)
    out = join_small(local, per_part, [PART, *keys])
    return out.withColumn(out_col, F.col(out_col) + F.col("_offset")).drop("_offset", PART, MID)


def running_max_within(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str | Column],
                       value_col: str, out_col: str, partitions: int | None = None) -> DataFrame:
    """Inclusive running maximum of an integer column in (key, order) order."""
    keys = list(key_cols)
    x = range_sorted(df, keys, order_cols, partitions)
    per_part = x.groupBy(PART, *keys).agg(F.max(value_col).cast("long").alias("_m_local"))
    per_part = per_part.withColumn(
        "_carry",
        F.max("_m_local").over(Window.partitionBy(*keys).orderBy(PART).rowsBetween(
            Window.unboundedPreceding, -1)),
    ).drop("_m_local")
    schema = T.StructType(x.schema.fields + [T.StructField(out_col, T.LongType())])
    local = x.mapInArrow(_local_cumsum(keys, value_col, to_arrow_schema(schema), "max"), schema)
    out = join_small(local, per_part, [PART, *keys])
    return out.withColumn(out_col, F.greatest(F.col(out_col), F.col("_carry"))).drop(
        "_carry", PART, MID)


def _window_sums(keys: list[str], width: int, schema):
    """Per range partition: window sums over its own rows; rows of the first key whose window
    begins before the partition's first row are marked open."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def closed(held, first: bool):
        rows = pa.Table.from_batches(held).combine_chunks()
        t = rows.column("_t").to_numpy()
        total = np.concatenate([[0], np.cumsum(pc.fill_null(rows.column("_w"), 0).to_numpy())])
        sums = total[np.searchsorted(t, t, "right")] - total[np.searchsorted(t, t - width, "right")]
        waits = (t - width < t[0]) if first else np.zeros(len(t), dtype=bool)
        for b in rows.append_column("_sum", pa.array(sums, pa.int64())).append_column("_open", pa.array(waits)).to_batches():
            yield _with(b, schema)

    def run(batches):
        held, key, first = [], None, True
        for b in batches:
            if not b.num_rows:
                continue
            cuts = [0, *np.flatnonzero(_changes(b, keys)).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                own = _key_at(b, keys, lo)
                if held and own != key:
                    yield from closed(held, first)
                    held, first = [], False
                key = own
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from closed(held, first)
    return run


def rolling_counts(df: DataFrame, key_cols: Sequence[str], time_col: str, width: int,
                   id_col: str, weight_col: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """For every row: sum of weights (default: count) of rows of the same key whose
    integer time lies in (t - width, t] (RANGE frame, peers included).

    Rows are dealt out once by ranges of (key, time), equal times together. A partition sums
    its own rows; only rows within `width` of a partition's start, if its first key began
    earlier, meet the tail of that width from the partitions before it, however many it
    spans. Rows without a time take no part.
    """
    keys = list(key_cols)
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    rows = df.where(F.col(time_col).isNotNull()).select(
        *keys, F.col(id_col).alias("_id"), F.col(time_col).cast("long").alias("_t"), w.alias("_w"))
    x = range_sorted(rows, keys, ["_t"], partitions)
    schema = T.StructType([*x.schema.fields, T.StructField("_sum", T.LongType()), T.StructField("_open", T.BooleanType())])
    local = x.mapInArrow(_window_sums(keys, width, to_arrow_schema(schema)), schema)

    # First key and time of every partition: one row each. Those whose key ends the partition before go on.
    edge = lambda f: f(F.struct(MID, *keys, "_t"))
    edges = sorted((r.asDict(True) for r in x.groupBy(PART).agg(edge(F.min).alias("a"), edge(F.max).alias("z")).collect()), key=lambda r: r[PART])
    going_on = {}
    for before, here in zip(edges, edges[1:]):
        key = tuple(here["a"][k] for k in keys)
        if key == tuple(before["z"][k] for k in keys):
            going_on.setdefault(key, []).append((here[PART], here["a"]["_t"]))
    done = local.where(~F.col("_open") | ~F.col(PART).isin([p for v in going_on.values() for p, _ in v]))
    out = [*keys, F.col("_id").alias(id_col), F.col("_sum").alias("window_count")]
    if not going_on:
        return done.select(*out)
    waiting = local.where(F.col("_open") & F.col(PART).isin([p for v in going_on.values() for p, _ in v]))
    tail_schema = T.StructType([T.StructField(c, T.LongType()) for c in (PART, "_t", "_w")])

    def tails(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            if not b.num_rows:
                continue
            cuts = [0, *np.flatnonzero(_changes(b, keys)).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                later = going_on.get(_key_at(b, keys, lo))
                if not later:
                    continue
                parts, starts = np.array([p for p, _ in later]), np.array([t for _, t in later])
                t, own = b.column("_t").to_numpy()[lo:hi], b.column(PART).to_numpy()[lo:hi]
                weights = pc.fill_null(b.column("_w"), 0).to_numpy()[lo:hi]
                a, z = np.searchsorted(parts, own, "right"), np.searchsorted(starts, t + width, "left")
                for i in np.flatnonzero(z > a).tolist():
                    n = z[i] - a[i]
                    yield pa.RecordBatch.from_arrays([pa.array(parts[a[i]:z[i]].astype(np.int64)), pa.array(np.full(n, t[i])),
                                                      pa.array(np.full(n, weights[i]))], names=tail_schema.names)

    def fixed(_, left, right):
        import numpy as np
        import pyarrow as pa
        right = right.sort_by("_t")
        t = right.column("_t").to_numpy()
        total = np.concatenate([[0], np.cumsum(right.column("_w").to_numpy())])
        more = total[-1] - total[np.searchsorted(t, left.column("_t").to_numpy() - width, "right")]
        at = left.schema.get_field_index("_sum")
        return left.set_column(at, "_sum", pa.array(left.column("_sum").to_numpy() + more, pa.int64()))

    tail = x.mapInArrow(tails, tail_schema).groupBy(PART, "_t").agg(F.sum("_w").alias("_w"))
    fixed_rows = waiting.groupBy(PART).cogroup(tail.groupBy(PART)).applyInArrow(fixed, waiting.schema)
    return done.select(*out).unionByName(fixed_rows.select(*out))


def _local_prev(keys: list[str], value_col: str, schema):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        last_key, last_val = None, None
        for b in batches:
            if not b.num_rows:
                continue
            vals = b.column(value_col)
            new = _changes(b, keys)
            new[0] = last_key is None or _key_at(b, keys, 0) != last_key
            before = pa.concat_arrays([pa.array([last_val], vals.type), vals[:-1]])
            prev = before.take(pa.array(np.arange(len(vals)), mask=new))
            last_key, last_val = _key_at(b, keys, b.num_rows - 1), vals[-1].as_py()
            yield _with(b, schema, prev, pa.array(new))
    return run


def previous_within(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str | Column],
                    value_col: str, partitions: int | None = None) -> DataFrame:
    """Add `_prev`: the value of the previous row of the same key in order (like
    `lag`), computed per range partition plus a small boundary table."""
    keys = list(key_cols)
    x = range_sorted(df, keys, order_cols, partitions)
    vtype = x.schema[value_col].dataType
    schema = T.StructType(x.schema.fields + [T.StructField("_prev", vtype),
                                             T.StructField("_first_local", T.BooleanType())])
    local = x.mapInArrow(_local_prev(keys, value_col, to_arrow_schema(schema)), schema)
    # Last value of each (partition, key), shifted to the next partition holding the key.
    lasts = x.groupBy(PART, *keys).agg(
        F.max_by(F.col(value_col), F.col(MID)).alias("_last_v"))
    lasts = lasts.withColumn(
        "_carry", F.lag("_last_v").over(Window.partitionBy(*keys).orderBy(PART))).select(
        PART, *keys, "_carry")
    out = join_small(local, lasts, [PART, *keys], "left")
    fixed = F.when(F.col("_first_local"), F.col("_carry")).otherwise(F.col("_prev"))
    return out.withColumn("_prev", fixed).drop("_carry", "_first_local", PART, MID)
