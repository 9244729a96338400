"""Operators over rows whose order has meaning, built so that no task ever holds one unbounded cast.

A cast may hold a third of all rows. Windows then run inside ``(cast, chunk)`` groups, a chunk being a fixed range of
the order column, and what crosses a chunk border travels through a summary with one row per chunk:

* ``with_halo``    copies the rows near a border to the neighbouring chunk (fixed reach: smoothing, thinning);
* ``next_row``     the following row of the cast, however many empty chunks lie between;
* ``last_known``   the nearest earlier (or later) non-missing value;
* ``running_sum``  prefix sums;
* ``number_rows``  a dense row number, by a range sort instead of a window.

``chunk_size`` measures the largest key first. While that is small, ``size`` is None: one chunk per key, no summaries.
Results are the same either way.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.storage import save_stage

CHUNK = 65536
# Rows of one key that one window task may hold; a sort of this many narrow rows stays in memory.
WHOLE_LIMIT = 1_000_000
# Rows of a bucket of a table that is dealt by key, where every key fits a task.
BUCKET_ROWS = 200_000


def chunk_size(df, keys, limit=WHOLE_LIMIT, size=CHUNK):
    """None when every key is small enough to be one chunk, else ``size``. Runs one count over the key columns."""
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return None if (largest or 0) <= limit else size


def bucket_number(df, rows=BUCKET_ROWS):
    """Buckets that a table is dealt into by its key. Runs one count."""
    return max(1, -(-df.count() // rows))


def deal_keys(casts, order, cast="cast_id", rows=BUCKET_ROWS):
    """A number for each cast, to be the key of rows that are dealt into buckets where casts lie in ``order``: ``(keys, n)``.

    ``casts`` holds one row per cast, with ``_held``, the rows of it. Casts that follow each other in ``order`` make up a bucket
    of about so many rows. A row of key k goes to part ``pmod(hash(k), n)``, so the casts of a bucket get the first numbers that
    fall into it, each its own; ``keys`` is a stage table ``(cast, _deal)``. Only a row per cast is ranked.
    """
    casts = save_stage(casts.select(cast, *order, "_held").where(F.col(cast).isNotNull()), "casts")
    before = Window.orderBy(*order, cast).rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("_held").over(before), F.lit(0)) / rows).cast("bigint")
    # Only places where a cast begins count.
    placed = casts.select(cast, *order, place.alias("_place")).withColumn("_place", F.dense_rank().over(Window.orderBy("_place")) - 1)
    placed = save_stage(placed.withColumn("_rank", F.row_number().over(Window.partitionBy("_place").orderBy(*order, cast))), "places")
    last, most = placed.agg(F.max("_place"), F.max("_rank")).first()
    n, most = (last or 0) + 1, most or 0
    # Some more than are needed on average, so that every bucket has enough; a cast without one gets a number of its own.
    numbers = casts.sparkSession.range(int(n * (most * 1.25 + 100))).select(
        F.col("id").alias("_number"), F.expr(f"pmod(hash(id), {n})").cast("bigint").alias("_place"))
    numbers = numbers.withColumn("_rank", F.row_number().over(Window.partitionBy("_place").orderBy("_number")))
    keys = placed.join(numbers, ["_place", "_rank"], "left")
    return save_stage(keys.select(cast, F.coalesce("_number", -1 - (F.col("_place") * most + F.col("_rank"))).alias("_deal")), "deal"), n


def chunk_of(order, size=CHUNK):
    """Chunk number of an order value: BIGINT for row numbers and readings alike."""
    if size is None:
        return F.lit(0).cast("bigint")
    return F.floor(F.col(order) / F.lit(size)).cast("bigint")


def with_halo(df, order, reach, size=CHUNK):
    """Add ``_chunk`` and ``_core``; rows within ``reach`` of a border also appear, not core, in the next chunk over."""
    home = chunk_of(order, size)
    if size is None:
        return df.withColumns({"_chunk": home, "_core": F.lit(True)})
    place = F.col(order) - home * size
    near = F.array(
        F.when((place < reach) & (home > 0), home - 1),
        home,
        F.when(place >= size - reach, home + 1),
    )
    copies = F.filter(near, lambda c: c.isNotNull())
    return df.withColumn("_home", home).withColumn("_chunk", F.explode(copies)).withColumn(
        "_core", F.col("_chunk") == F.col("_home")).drop("_home")


def next_row(df, keys, order, columns, size=CHUNK, prefix="next_"):
    """Values of the following row of the same key as ``prefix + column``; NULL on the last row."""
    wanted = list(dict.fromkeys([order, *columns]))
    if size is None:
        whole = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({prefix + c: F.lead(c).over(whole) for c in wanted})
    df = df.withColumn("_chunk", chunk_of(order, size))
    here = Window.partitionBy(*keys, "_chunk").orderBy(order)
    heads = df.groupBy(*keys, "_chunk").agg(*[F.min_by(c, order).alias(c) for c in wanted])
    onward = Window.partitionBy(*keys).orderBy("_chunk")
    heads = heads.select(*keys, "_chunk", F.lead(F.struct(*wanted)).over(onward).alias("_onward"))
    local = df.withColumn("_next", F.lead(F.struct(*wanted)).over(here))
    joined = local.join(heads, [*keys, "_chunk"], "left").withColumn("_next", F.coalesce("_next", "_onward"))
    return joined.withColumns({prefix + c: F.col("_next")[c] for c in wanted}).drop("_next", "_onward", "_chunk")


def last_known(df, keys, order, value, name, size=CHUNK, later=False):
    """Nearest non-missing ``value`` at or before each row (at or after it with ``later``)."""
    way = F.desc if later else F.asc
    if size is None:
        whole = Window.partitionBy(*keys).orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(whole))
    df = df.withColumn("_chunk", chunk_of(order, size))
    here = Window.partitionBy(*keys, "_chunk").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.when(F.col(value).isNotNull(), F.col(order))
    pick = F.min_by if later else F.max_by
    edge = df.groupBy(*keys, "_chunk").agg(pick(F.col(value), filled).alias("_edge"))
    before = Window.partitionBy(*keys).orderBy(way("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(*keys, "_chunk", F.last("_edge", ignorenulls=True).over(before).alias("_edge"))
    local = df.withColumn(name, F.last(value, ignorenulls=True).over(here))
    return local.join(edge, [*keys, "_chunk"], "left").withColumn(
        name, F.coalesce(F.col(name), F.col("_edge"))).drop("_edge", "_chunk")


def running_sum(df, keys, order, value, name, size=CHUNK):
    """Sum of ``value`` up to and including each row."""
    if size is None:
        whole = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(whole))
    df = df.withColumn("_chunk", chunk_of(order, size))
    here = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_total"))
    totals = totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    local = df.withColumn(name, F.sum(value).over(here))
    return local.join(totals, [*keys, "_chunk"], "left").withColumn(
        name, F.col(name) + F.col("_base")).drop("_base", "_chunk")


def number_rows(df, keys, order, name, label="numbered", whole_limit=None):
    """Dense 0-based row number of each key in ``order`` (Columns or names; must be a full order).

    With ``whole_limit`` the largest key is counted first; where it holds no more rows than that, a window numbers them, which
    costs one shuffle and no stage table. Otherwise the rows are range-partitioned on key and order, so a hot key spreads over many tasks; a row's number is its place
    in its sorted partition plus what the earlier partitions hold of the key. The sorted rows are a stage table, because
    the two reads must see the same partitions.
    """
    if whole_limit is not None and chunk_size(df, keys, whole_limit) is None:
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(whole).cast("bigint") - 1)
    ordering = [F.col(c) if isinstance(c, str) else c for c in [*keys, *order]]
    placed = (df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
              .withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()))
    staged = save_stage(placed, label)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_held"))
    starts = starts.select(
        *[F.col(k).alias(f"_is_{k}") for k in [*keys, "_part"]],
        (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = [F.col(k).eqNullSafe(F.col(f"_is_{k}")) for k in [*keys, "_part"]]
    joined = staged.join(starts, same, "left").withColumn(name, F.col("_place") + F.col("_shift"))
    return joined.drop("_place", "_shift", "_part", *[f"_is_{k}" for k in [*keys, "_part"]])


def exact_median(df, keys, columns, size=CHUNK, band=0.125):
    """Exact, interpolated median of each column per key, missing values skipped; one row per key.

    Readings are first counted per distinct value (combined map-side), then the two middle ranks are located by a prefix
    sum over those counts, so neither an array nor a whole key's readings ever sits in one buffer. ``band`` is the chunk
    width on the value axis, used when ``size`` asks for chunks.
    """
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_what"), F.col(c).alias("_value")) for c in columns])).alias("_r"))
    long = long.select(*keys, "_r.*").where(F.col("_value").isNotNull())
    counted = long.groupBy(*keys, "_what", "_value").agg(F.count("*").alias("_n"))
    if size is None:
        ranked = running_sum(counted, [*keys, "_what"], "_value", "_n", "_upto", None)
        ranked = ranked.withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys, "_what")))
    else:
        ranked = running_sum(counted, [*keys, "_what"], "_value", "_n", "_upto", band)
        ranked = ranked.join(counted.groupBy(*keys, "_what").agg(F.sum("_n").alias("_all")), [*keys, "_what"])

    def held(rank):
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)

    def middle(c):
        mine = F.col("_what") == c
        low, high = F.expr("(_all - 1) div 2"), F.expr("_all div 2")
        return ((F.max(F.when(mine & held(low), F.col("_value"))) +
                 F.max(F.when(mine & held(high), F.col("_value")))) / 2.0).alias(c)

    return ranked.groupBy(*keys).agg(*[middle(c) for c in columns])
