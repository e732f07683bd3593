"""A stated query set against all rows: query blocks meet index shards.

Equal rows are counted first, so that a row met many times is one row with a count. Rows are
dealt to shards by a hash of id and vector and each shard becomes one index record; queries
are packed into blocks of bounded size. Shards and lanes of blocks make tiles that are about
as wide as high: a shard goes once to each lane, a block once to each shard. A task reads a
tile as a sorted stream, the index before its blocks, and holds one index and one batch. It
returns at most ``k`` rows per query; the best ``k`` over all shards are ranked last.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.windows import top_rows


def components(df: DataFrame, column: str) -> Column:
    """The vectors as they are stored if these are floats, else as doubles."""
    known = df.schema[column].dataType.simpleString()
    return F.col(column) if known in ("array<float>", "array<double>") else F.col(column).cast("array<double>")


def finite(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    bound = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
    return F.coalesce(good, F.lit(False))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """List column with lists of one length as a two-dimensional array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def pack_groups(df: DataFrame, number: str, make: Callable[[np.ndarray, np.ndarray], object], k: int) -> DataFrame:
    """One pickled object per (dim, kind, ``number``), made of ids in ascending order and vectors.

    A row counted ``n`` times is handed over ``min(n, k)`` times: more cannot be among ``k``.
    """

    def run(group: pa.Table) -> pa.Table:
        ids, values = group.column("id").to_numpy(), matrix(group.column("vector"))
        order = np.lexsort((*values.T[::-1], ids))
        order = np.repeat(order, np.minimum(group.column("n").to_numpy()[order], k))
        content = pickle.dumps(make(ids[order], values[order]), protocol=5)
        return pa.table({
            "dim": group.column("dim")[:1],
            "kind": group.column("kind")[:1],
            number: group.column(number)[:1],
            "data": pa.array([content], pa.binary()),
        })

    return df.groupBy("dim", "kind", number).applyInArrow(run, f"dim int, kind int, {number} long, data binary")


def search_blocks(
    vectors: DataFrame,
    queries: Column,
    build: Callable[[np.ndarray, np.ndarray], object],
    search: Callable[[object, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    k: int,
    score_type: str,
    best: Callable[[str], Column],
    shard_rows: int,
    block_rows: int,
    kind: Column | None = None,
) -> DataFrame:
    """Best ``k`` rows of ``vectors(id, vector)`` for each row where ``queries`` holds.

    ``build(ids, vectors)`` makes the index of a shard, with ids in ascending order;
    ``search(index, ids, vectors)`` returns the places of queries in their block with found
    ids and scores. Vectors of different length never meet. All rows of a repeated id are
    candidates of other ids, and the best ``k`` of a repeated query id are those of all its rows
    together, as a join would pair them. Rows of each ``kind`` get shards and blocks
    of their own, and every block meets the shards of all kinds.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = (
        vectors.where(F.col("id").isNotNull())
        .withColumn("dim", F.size("vector"))
        .withColumn("is_query", F.coalesce(queries, F.lit(False)))
        .withColumn("kind", F.lit(0) if kind is None else kind.cast("int"))
        .select("id", "vector", "dim", "kind", "is_query")
    )
    asks = F.sum(F.col("is_query").cast("long"))
    # one row per kind
    sizes = {r.kind: (r.rows, r.asked) for r in vectors.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), asks.alias("asked")).collect()}
    shards = {name: max(1, -(-rows // shard_rows)) for name, (rows, _) in sizes.items()} or {0: 1}
    asked = sum(count for _, count in sizes.values())
    blocks = max(1, -(-asked // block_rows))
    # tiles of about shard_rows queries, and enough of them for all tasks
    lanes = min(blocks, max(-(-asked // shard_rows), -(-parts // sum(shards.values())), 1))

    counted = vectors.groupBy("id", "vector", "dim", "kind").agg(F.count(F.lit(1)).alias("n"), F.bool_or("is_query").alias("is_query"))
    shard_count = F.element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), F.col("kind"))
    indexes = pack_groups(counted.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), shard_count.cast("long"))), "shard", build, k)
    dealt = counted.where("is_query").withColumn("block", F.pmod(F.xxhash64("id", "vector", F.lit(1)), F.lit(blocks).cast("long")))
    packed = pack_groups(dealt, "block", lambda ids, values: (ids, values), k)

    def upto(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    tiles = indexes.select("dim", "kind", "shard", upto(lanes).alias("lane"), F.lit(-1).alias("asker"), F.lit(-1).cast("long").alias("block"), "data")
    for name, count in shards.items():
        lane = F.pmod(F.col("block"), F.lit(lanes).cast("long")).alias("lane")
        tiles = tiles.union(packed.select("dim", F.lit(name).alias("kind"), upto(count).alias("shard"), lane, F.col("kind").alias("asker"), "block", "data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, tile = None, None
        for batch in batches:
            here = zip(*[batch.column(c).to_pylist() for c in ("dim", "kind", "shard", "lane")])
            for name, block, data in zip(here, batch.column("block").to_pylist(), batch.column("data")):
                if block < 0:
                    index, tile = pickle.loads(data.as_buffer()), name
                elif name == tile:
                    ids, values = pickle.loads(data.as_buffer())
                    owner, found, scores = search(index, ids, values)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

    place = ("dim", "kind", "shard", "lane")
    ordered = tiles.repartition(max(sum(shards.values()) * lanes, parts), *place).sortWithinPartitions(*place, "block", "asker")
    found = ordered.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
    ranked = top_rows(found, ["query_id"], [best("score"), F.col("vec_id")], k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
