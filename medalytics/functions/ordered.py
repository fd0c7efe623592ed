"""Global order without a single-task window: range partitions plus one offset per partition."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Stored, store
from .skew import join_lookup


def running_total(df: DataFrame, order: list[str], value, out: str, parts: int | None = None) -> DataFrame:
    """Add the running sum of `value` in the global order of `order`, the row itself included.

    `order` should be unique: rows that tie stay in one range partition. The partitioned rows are
    written before their partition numbers are used, so a lost executor cannot change them.
    """
    return _placed(df, order, value, out, parts).df


def _placed(df, order, value, out, parts=None) -> Stored:
    """The rows with their running sum, and the known size of the table that they come from."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = store(
        df.withColumn("__value", F.lit(value) if isinstance(value, int) else value)
        .repartitionByRange(parts, *order)
        .withColumn("__part", F.spark_partition_id()),
        "ranged",
    )
    ranged = stored.df
    # one row per range partition, so this window sees at most `parts` rows
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__part")
        .agg(F.sum("__value").alias("__sum"))
        .select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__before") + F.sum("__value").over(inside))
        .drop("__part", "__value", "__before")
    )
    return Stored(placed, stored.rows, stored.bytes)


def percent_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """(rank - 1) / (rows - 1) of every row in the whole set; one row alone gets 0."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    placed = _placed(counts, [column], F.col("__n"), "__upto")
    rows = placed.df.agg(F.sum("__n"))
    share = F.try_divide(F.col("__upto") - F.col("__n"), rows.scalar() - 1)
    ranks = placed.df.select(column, F.coalesce(share, F.lit(0.0)).alias(out))
    return join_lookup(df, Stored(ranks, placed.rows, placed.bytes), [column])


def range_sorted(df: DataFrame, by: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Rows ranged by (by, order) and written with the number of their range, `__part`; a key takes as many ranges as it needs.

    Null keys are one key. Rows that tie in `by` and `order` lie in one range, so `order` should tell rows apart.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store(df.repartitionByRange(parts, *by, *order).withColumn("__part", F.spark_partition_id()), "ranged").df


def _scanned(rows, by, order, names, within, of_last_key, across):
    """A segmented scan of the columns `names` of ranged rows: (rows, what the scan of the range gives, what comes from before it).

    Each range is scanned alone by the window function `within`. It offers the aggregate `of_last_key` of its
    last key, and asks at its first key for the offers before it, which the window function `across` puts
    together: two lines per range. So no key and no period is one task.
    """
    inside = Window.partitionBy("__part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"__in_{n}": within(n).over(inside) for n in names})
    key = F.struct(*by)
    ends = rows.groupBy("__part").agg(F.min(key).alias("__first"), F.max(key).alias("__key"))
    mine = rows.join(F.broadcast(ends.select("__part", "__key")), "__part").filter(key.eqNullSafe(F.col("__key")))
    offers = mine.groupBy("__part", "__key").agg(*[of_last_key(n).alias(n) for n in names])
    nothing = [F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names]
    lines = ends.select(F.col("__first").alias("__key"), "__part", F.lit(0).alias("__side"), *nothing)
    lines = lines.unionByName(offers.withColumn("__side", F.lit(1)))
    before = Window.partitionBy("__key").orderBy("__part", "__side").rowsBetween(Window.unboundedPreceding, -1)
    carried = lines.select(
        F.col("__part").alias("__at"), F.col("__key").alias("__first"), "__side", *[across(n).over(before).alias(f"__before_{n}") for n in names]
    )
    # one line per range is broadcast
    carried = F.broadcast(carried.filter("__side = 0").drop("__side"))
    return local.join(carried, (F.col("__part") == F.col("__at")) & key.eqNullSafe(F.col("__first")), "left")


def carry_forward(df: DataFrame, by: list[str], order: list[str], values: dict, parts: int | None = None) -> DataFrame:
    """Add for every value (name: column) the last that was not null in the row's key up to and with the row, in `order`."""
    rows = range_sorted(df.withColumns({f"__v_{n}": v for n, v in values.items()}), by, order, parts)

    def newest(n):
        return F.max_by(n, F.when(F.col(n).isNotNull(), F.struct(*order)))

    def last(n):
        return F.last(n, ignorenulls=True)

    met = _scanned(rows, by, order, [f"__v_{n}" for n in values], last, newest, last)
    return met.select(*df.columns, *[F.coalesce(f"__in___v_{n}", f"__before___v_{n}").alias(n) for n in values])


def running_total_by(df: DataFrame, by: list[str], order: list[str], sums: dict, parts: int | None = None) -> DataFrame:
    """Add running sums (name: column) per key in `order`, the row itself included."""
    rows = range_sorted(df.withColumns({f"__v_{n}": v for n, v in sums.items()}), by, order, parts)
    met = _scanned(rows, by, order, [f"__v_{n}" for n in sums], F.sum, F.sum, F.sum)
    return met.select(*df.columns, *[(F.col(f"__in___v_{n}") + F.coalesce(f"__before___v_{n}", F.lit(0))).alias(n) for n in sums])


def following(df: DataFrame, by: list[str], order: list[str], values: dict, parts: int | None = None) -> DataFrame:
    """Add for every value (name: column) that of the next row of the key in `order`, and `__more`, whether there is one.

    Each range is scanned alone; its last row looks at the first row of the next range, one line per range.
    """
    rows = range_sorted(df.withColumns({f"__v_{n}": v for n, v in values.items()}), by, order, parts)
    held = F.struct(F.struct(*by).alias("key"), F.struct(*[f"__v_{n}" for n in values]).alias("values"))
    heads = rows.groupBy("__part").agg(F.min_by(held, F.struct(*by, *order)).alias("__head"))
    # one line per range, so this window sees at most `parts` of them
    nexts = heads.select(F.col("__part").alias("__at"), F.lead("__head").over(Window.orderBy("__part")).alias("__next"))
    near = F.lead(held).over(Window.partitionBy("__part").orderBy(*by, *order))
    met = rows.withColumn("__near", near).join(F.broadcast(nexts), F.col("__part") == F.col("__at"))
    met = met.withColumn("__row", F.coalesce("__near", "__next"))
    more = F.coalesce(F.col("__row.key").eqNullSafe(F.struct(*by)) & F.col("__row").isNotNull(), F.lit(False))
    met = met.withColumn("__more", more)
    return met.select(*df.columns, *[F.when(F.col("__more"), F.col(f"__row.values.__v_{n}")).alias(n) for n in values], "__more")
