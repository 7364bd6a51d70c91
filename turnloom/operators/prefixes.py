"""Which ids begin with which other ids, by one pass over both in sorted order.

In sorted order the ids that begin with ``x`` follow ``x`` without a gap, so a stack of the ids
that the current one begins with shows all matches, and every id is compared with the top of it
only. Ids are cut into ranges, one task each. What a range leaves on its stack may go on in later
ranges: exactly those entries with which the first id of a later range begins.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from turnloom.operators.scale import cut_lineage, lookup_join

# Executors need not have this package installed: the function travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows handed back at a time.
_ROWS = 8_192


def first_prefix_match(
    asked: DataFrame,
    known: DataFrame,
    order: str,
    key: str = "custom_id",
    partitions: int | None = None,
    equal: bool = True,
) -> DataFrame:
    """``key`` of ``asked`` → ``matched_id``: the first id of ``known`` of which one begins with the other.

    First is by ``order`` (a number, text or time; null comes first), then by the id. Ids that are
    null or empty match nothing; repeated ids count once, with their smallest ``order``; ids without
    a match give no row, nor, without ``equal``, do ids that are known themselves. Each distinct id
    is moved twice as a whole, once to be told apart and once into its range. Beside them a range
    offers its first id once per length of an id left open. ``partitions`` fixes the number of
    ranges, which is Spark's choice otherwise.
    """
    kind = known.schema[order].dataType
    ids = (
        known.select(
            F.col(key).alias("id"), F.col(order).alias("line"), F.lit(True).alias("known"), F.lit(False).alias("asked")
        )
        .unionByName(
            asked.select(
                F.col(key).alias("id"), F.lit(None).cast(kind).alias("line"),
                F.lit(False).alias("known"), F.lit(True).alias("asked"),
            )
        )
        .filter(F.length("id") > 0)
        .groupBy("id")
        .agg(F.min("line").alias("line"), F.max("known").alias("known"), F.max("asked").alias("asked"))
    )
    if not equal:
        ids = ids.withColumn("asked", F.col("asked") & ~F.col("known"))
    ranges = ids.repartitionByRange(partitions, "id") if partitions else ids.repartitionByRange("id")
    found = cut_lineage(ranges.sortWithinPartitions("id").mapInArrow(_scan(kind), _found(kind)))

    best = F.struct("line", "match")
    inside = found.filter("kind = 'match'").select(
        "range", "id", "shared", F.when(F.col("match").isNotNull(), best).alias("best")
    )
    edges = found.filter("kind <> 'match'").agg(
        F.count_if(F.col("kind") == "first").alias("ranges"),
        F.collect_set(F.when(F.col("kind") == "open", F.length("id"))).alias("lengths"),
    ).first()  # one number per length of an open id
    if edges["ranges"] < 2:
        return _named(inside, key)

    lengths = F.array(*[F.lit(n) for n in sorted(edges["lengths"])])
    firsts = found.filter("kind = 'first'").select(
        "range", "steps", "id", F.explode(F.filter(lengths, lambda n: n < F.length("id"))).alias("length")
    ).withColumn("id", F.left("id", F.col("length")))
    opened = found.filter("kind = 'open'").select("id", "asked", "line", "match")
    carried = cut_lineage(lookup_join(firsts, opened, "id", "inner"))

    above = carried.filter(F.col("match").isNotNull()).groupBy("range").agg(
        F.collect_list(F.struct("length", "line", "match")).alias("above")  # prefixes of one id
    )
    reaching = F.transform(
        F.filter("above", lambda a: a["length"] <= F.col("shared")), lambda a: F.struct(a["line"], a["match"])
    )
    none = F.array().cast(_pairs(kind))
    inside = lookup_join(inside, above, "range", "left").select(
        "id", F.array_min(F.concat(F.array("best"), F.coalesce(reaching, none))).alias("best")
    )
    below = F.array_min(
        F.transform(
            F.filter("steps", lambda s: s["shared"] >= F.col("length")), lambda s: F.struct(s["line"], s["match"])
        )
    )
    beyond = carried.filter("asked").select("id", below.alias("best"))
    every = inside.unionByName(beyond).groupBy("id").agg(F.min("best").alias("best"))
    return _named(every, key)


def _named(found: DataFrame, key: str) -> DataFrame:
    return found.filter(F.col("best").isNotNull()).select(
        F.col("id").alias(key), F.col("best.match").alias("matched_id")
    )


def _pairs(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("line", kind), T.StructField("match", T.StringType())]))


def _found(kind: T.DataType) -> T.StructType:
    """Rows of a range: asked ids with the best match inside, ids left open, and the first id.

    ``shared`` is how far an id and the range's first one agree, short of the whole first one.
    ``steps`` has the best known id at each such distance.
    """
    step = T.StructType(
        [T.StructField("shared", T.IntegerType()), T.StructField("line", kind), T.StructField("match", T.StringType())]
    )
    return T.StructType(
        [
            T.StructField("range", T.IntegerType()),
            T.StructField("kind", T.StringType()),
            T.StructField("id", T.StringType()),
            T.StructField("asked", T.BooleanType()),
            T.StructField("shared", T.IntegerType()),
            T.StructField("line", kind),
            T.StructField("match", T.StringType()),
            T.StructField("steps", T.ArrayType(step)),
        ]
    )


class _Open:
    """An id on the stack: ``above`` is the best known id that it begins with, ``below`` the best
    one so far that begins with it; the id itself counts for both."""

    __slots__ = ("id", "line", "known", "asked", "shared", "above", "below")

    def __init__(self, id_, line, known, asked, shared, above):
        own = (line is not None, line, id_) if known else None
        self.id, self.line, self.known, self.asked, self.shared = id_, line, known, asked, shared
        self.above = _least(above, own)
        self.below = own


def _least(a: tuple | None, b: tuple | None) -> tuple | None:
    if a is None or b is None:
        return a or b
    return min(a, b)


def _scan(kind: T.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = to_arrow_schema(_found(kind))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_ = TaskContext.get().partitionId()
        stack: list[_Open] = []
        rows: list[dict] = []
        steps: dict[int, tuple] = {}
        first, shared = None, 0

        def row(kind_: str, id_: str, best: tuple | None = None, **more) -> dict:
            _, line, match = best or (None, None, None)
            return {"range": range_, "kind": kind_, "id": id_, "line": line, "match": match, **more}

        def close() -> None:
            done = stack.pop()
            if stack:
                stack[-1].below = _least(stack[-1].below, done.below)
            if done.asked:
                rows.append(row("match", done.id, _least(done.above, done.below), shared=done.shared))

        for batch in batches:
            for id_, line, known, asked in zip(*(column.to_pylist() for column in batch.columns)):
                if first is None:
                    first, shared = id_, len(id_) - 1
                while shared and not id_.startswith(first[:shared]):
                    shared -= 1
                while stack and not id_.startswith(stack[-1].id):
                    close()
                stack.append(_Open(id_, line, known, asked, shared, stack[-1].above if stack else None))
                if known and shared:
                    steps[shared] = _least(steps.get(shared), stack[-1].below)
                if len(rows) >= _ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows.clear()
        if first is None:
            return
        for left in stack:
            own = (None, left.line, left.id) if left.known else None
            rows.append(row("open", left.id, own, asked=left.asked))
        while stack:
            close()
        at = [{"shared": n, "line": line, "match": match} for n, (_, line, match) in steps.items()]
        rows.append(row("first", first, steps=at))
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return scan
