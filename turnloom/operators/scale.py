"""Building blocks that keep the other operators safe at any size.

* ``lookup_join`` joins rows to a table with one row per key so that a hot key can be
  split over many tasks;
* ``number_rows`` gives dense row numbers in a given order without a one-task window;
* ``first_rows`` filters by the n-th key of an order, which it finds by counting;
* ``hash_order`` and ``hash_cutoff`` give a reproducible random order and the exact
  value below which the first ``n`` rows of it lie.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions.text import as_column

# Buckets of the hash order, one hex digit each: 16 ** 4.
_BUCKET_DIGITS = 4
_SMALL_BUCKET = 10_000
# Ranges that a pass over the keys of an order cuts what is left into.
_RANGES = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    Only a local session that names none gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="turnloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written out and read back: later readers see the same rows and prune columns.

    The table stays in the shared folder; who owns the folder clears it.
    """
    path = f"{shared_folder(df.sparkSession)}/turnloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Repartition, for costly work on a table whose scan gives too few tasks.

    Without a number of partitions it is that of the session's shuffles.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


def lookup_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key.

    ``how`` is inner, left, left_semi or left_anti. Adaptive execution splits the part of
    ``left`` that a hot key (or null) makes too large, but only where both sides enter the
    join through an exchange of the join's own. ``right`` often comes out of an aggregate
    on the same key and would have none, so a hash of the key is a second join key.
    """
    on = [on] if isinstance(on, str) else list(on)
    tag = F.xxhash64(*on)
    return (
        left.withColumn("_key_hash", tag)
        .join(right.withColumn("_key_hash", tag), [*on, "_key_hash"], how)
        .drop("_key_hash")
    )


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    by: Sequence[str] = (),
    start: int = 0,
) -> DataFrame:
    """Dense numbers from ``start`` in ``order``, within each group of ``by``.

    A range-partitioned sort puts every row in its place; it is written out, so that all
    later reads see the same places. Row counts per partition, one small row each, then
    give each partition its offset. No group and no partition passes through one task.
    """
    by = list(by)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in by], *order)
        .sortWithinPartitions(*[F.col(c) for c in by], *order)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy("_part", *by).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    group = {c: f"_by{i}" for i, c in enumerate(by)}
    offsets = cut_lineage(
        parts.select(
            F.col("_part").alias("_of_part"),
            *[F.col(c).alias(alias) for c, alias in group.items()],
            "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        )
    )
    same = [F.col(c).eqNullSafe(F.col(alias)) for c, alias in group.items()]
    number = F.col("_offset") + (F.col("_place") - F.col("_first")) + F.lit(start)
    return placed.join(offsets, [F.col("_part") == F.col("_of_part"), *same], "inner").select(
        *df.columns, number.alias(name)
    )


def _sortable(df: DataFrame, name: str) -> Column:
    """A column to order by; what has no order of its own goes by its text."""
    kind = df.schema[name].dataType
    return F.to_json(name) if isinstance(kind, (T.MapType, T.VariantType)) else F.col(name)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order``, then by their other columns; nulls come first.

    While more than ``_SMALL_BUCKET`` keys are wanted, a pass cuts the range that holds the n-th
    one at some of its keys, counts the keys in between, and goes on within one part. The few
    keys left are sorted, and the rows are filtered by the first key that is one too many: no row
    is sorted or moved. Of rows that are equal in all columns as many stay as there is room for.
    """
    named = [c for c in order if isinstance(c, str)]
    columns = [*order, *[_sortable(df, c) for c in df.columns if c not in named]]
    key = F.struct(*[as_column(c).alias(f"k{i}") for i, c in enumerate(columns)])
    keys = part = df.select(key.alias("_key"))
    wanted, passes = n, 0
    while wanted > _SMALL_BUCKET:
        passes += 1
        random = F.xxhash64("_key", F.lit(passes))
        some = part.groupBy(F.pmod(random, F.lit(_RANGES))).agg(
            F.min_by("_key", random).alias("_cut"), F.min("_key").alias("_low"), F.max("_key").alias("_top")
        )
        found = cut_lineage(
            some.agg(
                F.sort_array(F.collect_set("_cut")).alias("cuts"),
                F.min("_low").alias("low"),
                F.max("_top").alias("top"),
            )
        )
        if found.filter("low < top").isEmpty():
            break  # one key, or none
        cuts = found.select("cuts").scalar()
        # a subquery cannot stand in a higher-order function; past the last cut it is null
        at_or_after = [F.when(F.get(cuts, F.lit(i)) < F.col("_key"), 1).otherwise(0) for i in range(_RANGES)]
        below = reduce(Column.__add__, at_or_after)
        counts = dict(part.groupBy(below.alias("at")).count().collect())  # a row per range
        at = 0
        while at <= max(counts) and wanted > counts.get(at, 0):
            wanted -= counts.get(at, 0)
            at += 1
        if at > max(counts):
            return df
        bounds = cut_lineage(
            found.select(F.get("cuts", F.lit(at - 1)).alias("low"), F.get("cuts", F.lit(at)).alias("top"))
        )
        low, top = bounds.select("low").scalar(), bounds.select("top").scalar()
        part = part.filter(
            (low.isNull() | (F.col("_key") > low)) & (top.isNull() | (F.col("_key") <= top))
        )
    few = cut_lineage(part.orderBy("_key").limit(min(wanted, _SMALL_BUCKET) + 1))
    edge = cut_lineage(few.agg(F.max("_key").alias("edge"), F.count(F.lit(1)).alias("rows")))
    over = edge.select("edge").scalar()
    rows = edge.first()["rows"]
    if wanted > _SMALL_BUCKET:
        # all that is left is one key
        if part.count() <= wanted:
            return df
        copies = wanted
    elif rows <= wanted:
        return df
    else:
        copies = few.filter(F.col("_key") == over).count() - 1
    out = df.filter(key < over)
    if not copies:
        return out
    one = df.filter(key == over).limit(1)
    again = df.sparkSession.range(copies).select(F.lit(0).alias("_same"))
    return out.unionByName(
        again.join(F.broadcast(one.withColumn("_same", F.lit(0))), "_same").select(*df.columns)
    )


def hash_order(key: Sequence[str | Column], seed: int | str = 0) -> Column:
    """A hex text that orders rows at random, the same in every run."""
    parts = [F.coalesce(as_column(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def number_by_hash(
    df: DataFrame, key: Sequence[str], name: str, by: Sequence[str] = (), seed: int | str = 0
) -> DataFrame:
    """Dense numbers from 0 in hash order, for rows that ``key`` identifies.

    The leading hex digits cut the rows into even buckets: bucket counts give the
    offsets, and each bucket numbers its own rows.
    """
    by = list(by)
    hashed = df.withColumn("_hash", hash_order(key, seed)).withColumn(
        "_bucket", F.left("_hash", F.lit(_BUCKET_DIGITS))
    )
    counts = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy(*by, "_bucket").orderBy("_hash", *key)
    return (
        hashed.withColumn("_rank", F.row_number().over(within))
        .join(offsets, [*by, "_bucket"])
        .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )


def hash_cutoff(df: DataFrame, key: Sequence[str], n: int, seed: int | str = 0) -> str:
    """The hash of the ``n``-th row in hash order.

    Each pass counts rows by the next digits of the hash and narrows down to one bucket;
    only that bucket's name and a count come back. The last pass sorts one small bucket.
    """
    rest = df.select(hash_order(key, seed).alias("_hash"))
    depth = 0
    while True:
        depth += _BUCKET_DIGITS
        counts = rest.groupBy(F.left("_hash", F.lit(depth)).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_rows")
        )
        upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        found = (
            counts.withColumn("_upto", F.sum("_rows").over(upto))
            .filter(F.col("_upto") >= n)
            .orderBy("_bucket")
            .first()
        )
        rest = rest.filter(F.col("_hash").startswith(found["_bucket"]))
        n -= found["_upto"] - found["_rows"]
        if depth >= 32:
            return found["_bucket"]
        if found["_rows"] <= _SMALL_BUCKET:
            break
    return rest.orderBy("_hash").limit(n).agg(F.max("_hash")).first()[0]
