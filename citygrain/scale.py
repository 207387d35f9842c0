"""Building blocks that keep operators safe on large and skewed tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder named by ``spark.checkpoint.dir``.

    Used between the rounds of iterative operators. The copy is written to reliable
    storage, so a lost executor does not lose it. A temporary folder is used only when
    nothing is configured and the session runs on one machine.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="citygrain-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def cut_unsized(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` for tables that are joined with themselves round after round; the size of the copy counts as unknown.

    A checkpoint keeps the size that was estimated for its plan, a product over its joins. Round after round that number alone grows
    to megabytes, and the driver multiplies and copies it for every step of every plan.
    """
    out = cut_lineage(df)
    rows = out._jdf.queryExecution().toRdd()
    return DataFrame(out.sparkSession._jsparkSession.internalCreateDataFrame(rows, out._jdf.schema(), False), out.sparkSession)


def cut_and_measure(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict]:
    """:func:`cut_lineage`, with aggregates over the copy."""
    out = cut_lineage(df)
    return out, out.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict()


class Rounds:
    """Tables written between the rounds of an iterative operator, all in one folder that goes with :meth:`finish`.

    A table that is read back has its real size. A checkpoint keeps the size that was estimated for its plan, which squares
    whenever a table is joined with itself, so after many doublings planning alone would take longer than the work.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.number = spark, work_folder(spark, name), 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.number += 1
        path = f"{self.folder}/{self.number}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def measure(self, df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict]:
        out = self.cut(df)
        return out, out.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict()

    def together(self, numbers: Sequence[int], schema: str | StructType) -> DataFrame:
        """Tables of some rounds as one, whose plan does not grow with them."""
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{i}" for i in numbers])

    def finish(self, df: DataFrame) -> DataFrame:
        """The result, on its own; the rounds behind it are deleted."""
        out = cut_lineage(df)
        remove_folder(self.spark, self.folder)
        return out


class Kept:
    """A table that only grows, dealt out by its key: later joins on the key move the other side alone.

    Every append is dealt by the same hash into as many files as there are buckets, so scans know where a key lies and neither
    shuffle nor rewrite what was appended before. The session's catalog knows the table until :meth:`close`.
    """

    def __init__(self, spark: SparkSession, key: Sequence[str], name: str = "kept"):
        self.spark, self.key = spark, list(key)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = work_folder(spark, name)
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.empty = True

    def append(self, df: DataFrame, dealt: bool = False) -> None:
        """``dealt``: rows of a key are in one partition already, as after an aggregation by the key."""
        rows = df if dealt else df.repartition(self.buckets, *self.key)
        writer = rows.write.format("parquet").mode("append").bucketBy(self.buckets, *self.key)
        writer.option("path", self.folder).saveAsTable(self.name)
        self.empty = False

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def only(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose key is in the table."""
        return df.join(self.table().select(*self.key), self.key, "left_semi")

    def without(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose key is not in the table."""
        return df if self.empty else df.join(self.table().select(*self.key), self.key, "left_anti")

    def close(self) -> DataFrame:
        """The rows as plain files, which stay; the catalog forgets the table."""
        rows = self.spark.read.parquet(self.folder)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return rows

    def drop(self) -> None:
        """The table and its files go."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_folder(self.spark, self.folder)


def with_totals(df: DataFrame, by: Sequence[str] = (), **aggregates: Column) -> DataFrame:
    """Attach per-group (or overall) aggregates to every row.

    An aggregate joined back combines on the map side, so a group that holds most of
    the rows is never gathered in one task as a window over the group would.
    """
    if by:
        totals = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()])
        return join_on(df, totals, by)
    packed = df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("t"))
    out = df.withColumn("_totals", packed.scalar())
    return out.select(*df.columns, *[F.col(f"_totals.{n}").alias(n) for n in aggregates])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join that also matches null keys and keeps one copy of each key column."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


#: Rows of one key that meet in one task.
CROWD = 250_000


def crowded_join(left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column, how: str = "inner",
                 crowd: int | None = None, deal: bool = False) -> DataFrame:
    """Join on equal ``keys`` of both sides and ``condition``, with crowded keys split by counted rows.

    The rows of ``left`` are counted by key first. A key with more than ``crowd`` rows is dealt out over as many parts as
    that takes, and only for such keys the rows of ``right`` are repeated, once per part. Counts are combined before they are
    shuffled, and the table of crowded keys has at most one row per ``crowd`` rows of ``left``, so that it can be broadcast.
    Every row of ``left`` meets all rows of ``right`` with its key once, so ``how`` may be inner, left, left_semi or left_anti.
    The key columns of ``right`` are named ``_r_`` and the key; the result has them unless it has columns of ``left`` only.
    With ``deal`` both sides are dealt out, whatever size is expected of ``right``; it is never sent whole through the driver.
    """
    crowd = crowd or CROWD
    named = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    parts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > crowd)
    parts = parts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.ceil(F.col("_rows") / crowd).cast("int").alias("_parts"))

    def marked(df: DataFrame, prefix: str) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(f"{prefix}{k}") == F.col(f"_c_{k}") for k in keys])
        return df.join(F.broadcast(parts), same, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop(*[f"_c_{k}" for k in keys])

    # equal rows are told apart by where they lie
    number = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.col("_parts").cast("long")).cast("int")
    a = marked(left, "").withColumn("_part", number).drop("_parts")
    b = marked(named, "_r_").withColumn("_r_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_r_{k}") for k in keys])
    b = b.hint("merge") if deal else b
    return a.join(b, same & (F.col("_part") == F.col("_r_part")) & condition, how).drop("_part", "_r_part")


#: Rows of one partition before rows of equal keys meet.
PARTITION_ROWS = 1_000_000


def dealt(df: DataFrame, keys: Sequence[str], rows: int | None = None, most: int | None = None) -> DataFrame:
    """Rows dealt out by key over more partitions than the session has where one would hold over ``most`` rows.

    What follows on the same keys, such as an aggregate or a window, needs no other shuffle, and the memory of one of its
    tasks does not grow with the table. ``rows`` is a bound of the rows where it is known; they are counted otherwise. A
    table that fits the session's partitions is left as it is.
    """
    most = most or PARTITION_ROWS
    parts = -(-(df.count() if rows is None else rows) // most)
    return df if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(parts, *keys)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Sequence[float],
    by: Sequence[str] = (),
    splits: int = 100,
    most: int = 100_000,
) -> DataFrame:
    """Exact interpolated quantiles, one row per group with columns ``q0, q1, ..``.

    Equal values are counted before the shuffle. Each wanted rank is then looked for in a range of values, which is
    cut into ``splits`` parts again and again until no range holds more than ``most`` distinct values; only those are
    ordered. No group, however large, is gathered whole, as the built-in ``percentile`` would do.
    """
    if not by:
        # one group; the few ranges of its ranks are small enough for every task
        whole = exact_quantiles(df.select(F.lit(0).alias("_all"), value), value, quantiles, ["_all"], splits, most)
        return whole.drop("_all")
    few = F.broadcast if list(by) == ["_all"] else (lambda ranges: ranges)
    v = F.col(value).cast("double")
    counts = cut_lineage(
        df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    )
    # one row per group and wanted rank, with the range it is known to lie in and the rows before that
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    totals = totals.where("_total is not null")
    positions = [F.lit(float(q)) * (F.col("_total") - 1) for q in quantiles]
    ranks = [r.cast("long") for p in positions for r in (F.floor(p), F.ceil(p))]
    wanted = totals.select(*by, "_low", "_high", F.lit(0).cast("long").alias("_before"), F.explode(F.array_distinct(F.array(*ranks))).alias("_rank"))
    wanted = cut_lineage(wanted)
    marks = [i / splits for i in range(1, splits)]
    # a range of one group is named by its lower end
    ranged = [*by, "_low"]
    while True:
        ranges = wanted.select(*ranged, "_high", "_before").distinct()
        held = join_on(counts, few(ranges), by)
        held = held.where("_v >= _low and _v <= _high")
        sizes = held.groupBy(*ranged).agg(F.count(F.lit(1)).alias("_distinct"))
        large = sizes.where(F.col("_distinct") > most).select(*ranged)
        if large.isEmpty():
            break
        cut = held.groupBy(*ranged).agg(F.percentile_approx("_v", marks, 10 * splits).alias("_marks"))
        parted = join_on(held, cut, ranged).withColumn("_part", F.size(F.filter("_marks", lambda m: m < F.col("_v"))))
        parts = parted.groupBy(*ranged, "_before", "_part").agg(
            F.sum("_n").alias("_size"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
        )
        # at most `splits` rows per range
        order = Window.partitionBy(*ranged).orderBy("_part")
        parts = parts.withColumn("_start", F.col("_before") + F.sum("_size").over(order) - F.col("_size"))
        found = join_on(wanted.select(*ranged, "_rank"), parts, ranged)
        found = found.where("_rank >= _start and _rank < _start + _size")
        wanted = cut_lineage(
            found.select(*by, F.col("_from").alias("_low"), F.col("_to").alias("_high"), F.col("_start").alias("_before"), "_rank")
        )
    inside = Window.partitionBy(*ranged).orderBy("_v")
    placed = held.withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
    hit = join_on(placed.drop("_high", "_before"), wanted.select(*ranged, "_rank"), ranged)
    hit = hit.where("_rank >= _end - _n and _rank < _end")
    values = hit.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    known = join_on(totals.select(*by, "_total"), values, by)
    out = []
    for i, p in enumerate(positions):
        low, high = F.element_at("_at", F.floor(p).cast("long")), F.element_at("_at", F.ceil(p).cast("long"))
        out.append((low + (p - F.floor(p)) * (high - low)).alias(f"q{i}"))
    return known.select(*by, *out)


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, partitions: int | None = None) -> DataFrame:
    """A running number 0, 1, .. over the whole table in the given order.

    Rows are range-partitioned on the order, counted per partition and numbered from
    the partition's offset, so no task sees more than one range. ``order`` must be unique.
    """
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(width, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition
    starts = sizes.withColumn("_start", F.sum("_size").over(Window.orderBy("_part")) - F.col("_size"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.withColumn("_inner", F.row_number().over(inside))
        .join(starts.drop("_size"), "_part")
        .withColumn(name, F.col("_start") + F.col("_inner") - 1)
        .drop("_part", "_inner", "_start")
    )


def lookup(values: dict, column: Column | str, default=None) -> Column:
    """Value of a small fixed table for a column, as a literal map (no join)."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col(column) if isinstance(column, str) else column)
    return found if default is None else F.coalesce(found, F.lit(default))


def work_folder(spark, name: str) -> str:
    """A new folder for written tables, beside the checkpoints of this session."""
    cut_lineage(spark.range(0))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark, folder: str) -> None:
    """Delete a folder that :func:`work_folder` named, wherever it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def next_along(df: DataFrame, keys: Sequence[str], at: str, name: str, parts: int = 64) -> DataFrame:
    """The next larger ``at`` (a fraction 0..1, distinct per key) under the same key, null at the end.

    Positions are bucketed first: the order is taken inside buckets, and buckets are linked
    by their smallest position, so one key with most of the rows is spread over ``parts`` tasks.
    """
    bucketed = df.withColumn("_bucket", F.least(F.floor(F.col(at) * parts), F.lit(parts - 1)).cast("int"))
    firsts = bucketed.groupBy(*keys, "_bucket").agg(F.min(at).alias("_first"))
    # at most `parts` rows per key
    following = firsts.withColumn(
        "_following", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket"))
    ).drop("_first")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(at)
    return (
        bucketed.withColumn("_within", F.lead(at).over(inside))
        .join(following, [*keys, "_bucket"])
        .withColumn(name, F.coalesce("_within", "_following"))
        .drop("_bucket", "_within", "_following")
    )


def fill_along(df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], direction: str = "down",
               block: int = 10_000) -> DataFrame:
    """Fill nulls from the nearest earlier (``down``) or later (``up``) row of the same group.

    ``order`` is a whole number, unique in the group. Rows are handled in blocks of it: each
    block's last known value is carried over the blocks, so a group of any length is spread
    over many tasks.
    """
    sign = 1 if direction == "down" else -1
    work = df.withColumn("_o", F.col(order) * sign).withColumn("_block", F.floor(F.col("_o") / block))
    ends = work.groupBy(*by, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_o"))).alias(f"_e_{c}") for c in columns]
    )
    # one row per block and group
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *by, "_block", *[F.last(f"_e_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in columns]
    )
    inside = Window.partitionBy(*by, "_block").orderBy("_o")
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(inside), f"_c_{c}") for c in columns}
    out = join_on(work, carried, [*by, "_block"]).withColumns(filled)
    return out.drop("_o", "_block", *[f"_c_{c}" for c in columns])
