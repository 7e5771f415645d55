"""Operator 3: resharding at minimum cost. A small flow network decides how many rows of which old shard go where."""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging

N_SHARDS, OLD_SHARDS = 40, 32


def min_cost_flow(
    supply: list[int], capacity: list[int], cost: Mapping[tuple[int, int], int], extra: int = 0
) -> dict[tuple[int, int], int]:
    """Send every unit of ``supply`` to nodes of limited ``capacity`` at the least total cost.

    ``extra`` of the nodes may take one unit more; which ones is part of the problem.

    Successive shortest paths with potentials over the bipartite network; ``cost`` names the arcs that exist. The
    network has as many nodes as there are blocks and shards, whatever the number of rows. Returns the flow per arc.
    """
    blocks, shards = len(supply), len(capacity)
    source, spare, sink = blocks + shards, blocks + shards + 1, blocks + shards + 2
    graph: list[list[list]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, room: int, price: int) -> None:
        graph[a].append([b, room, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i, units in enumerate(supply):
        arc(source, i, units, 0)
    for j, room in enumerate(capacity):
        arc(blocks + j, sink, room, 0)
        if extra:
            arc(blocks + j, spare, 1, 0)
    if extra:
        arc(spare, sink, extra, 0)
    for (i, j), price in sorted(cost.items()):
        arc(i, blocks + j, supply[i], price)

    potential = [0] * (sink + 1)
    left = sum(supply)
    while left:
        distance: list[float] = [float("inf")] * (sink + 1)
        via: list[tuple[int, int] | None] = [None] * (sink + 1)
        distance[source] = 0
        heap: list[tuple[float, int]] = [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > distance[a]:
                continue
            for k, (b, room, price, _) in enumerate(graph[a]):
                if room and (e := d + price + potential[a] - potential[b]) < distance[b]:
                    distance[b], via[b] = e, (a, k)
                    heapq.heappush(heap, (e, b))
        if via[sink] is None:
            raise ValueError("the capacities cannot take all rows")
        for a, d in enumerate(distance):
            if d < float("inf"):
                potential[a] += int(d)
        push, b = left, sink
        while b != source:
            a, k = via[b]
            push, b = min(push, graph[a][k][1]), a
        b = sink
        while b != source:
            a, k = via[b]
            graph[a][k][1] -= push
            graph[b][graph[a][k][3]][1] += push
            b = a
        left -= push
    return {(i, b - blocks): supply[i] - room
            for i in range(blocks) for b, room, _, _ in graph[i] if blocks <= b < source and supply[i] > room}


def plan_moves(sizes: list[tuple[int, int, int, int]], n_shards: int) -> list[tuple]:
    """Ranges of rank that go to a shard, from blocks ``(old shard, first rank, rows, bytes)``.

    A row that stays costs nothing, one that moves costs the mean size of its block; that is what it weighs, as long as
    a block is moved as a whole or its rows are alike (see :func:`blocks_of`). Shards take equally many rows, up to one
    more, and the places for these are arcs of the network like all others. Returns
    ``(old, rank_from, rank_to, shard, slot_from)``.
    """
    blocks = sorted(sizes)
    low, more = divmod(sum(rows for _, _, rows, _ in blocks), n_shards)
    # Costs are whole numbers, so that no shortest path is a matter of rounding.
    cost = {(i, j): 0 if old == j else max(1, round(1_000 * size / rows))
            for i, (old, _, rows, size) in enumerate(blocks) for j in range(n_shards)}
    flow = min_cost_flow([rows for _, _, rows, _ in blocks], [low] * n_shards, cost, more)
    ranges, used, slots = [], [first for _, first, _, _ in blocks], [0] * n_shards
    # What stays comes first, so rows that do not move keep the front slots.
    for (i, j), rows in sorted(flow.items(), key=lambda x: (blocks[x[0][0]][0] != x[0][1], x[0])):
        ranges.append((blocks[i][0], used[i], used[i] + rows, j, slots[j]))
        used[i] += rows
        slots[j] += rows
    return ranges


def rank_in_shard(df: DataFrame, staging: Staging) -> DataFrame:
    """Number the rows of each old shard from 0, the largest first.

    A hot shard is not sorted in one task: rows are range-partitioned by shard and size, numbered in their slice and
    shifted by what lies before it. The shifts are one row per slice and shard in it.
    """
    slices = staging.keep(
        df.repartitionByRange(F.col("old_shard"), F.col("size").desc(), F.col("doc_id"), F.col("text_crc32"))
        .sortWithinPartitions("old_shard", F.col("size").desc(), "doc_id", "text_crc32")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id()), "slices")
    starts = slices.groupBy("old_shard", "part").agg(F.min("place").alias("start"), F.count("*").alias("n"))
    before = Window.partitionBy("old_shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staging.keep(
        starts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "starts")
    return slices.join(starts, ["old_shard", "part"]).withColumn(
        "rank", F.col("place") - F.col("start") + F.col("shift")).drop("part", "place", "start", "shift")


def blocks_of(ranked: DataFrame, n_shards: int) -> DataFrame:
    """``old_shard, first, n, bytes``: the rows of each old shard, the largest first, in three blocks.

    Every shard will hold ``low`` or ``low + 1`` rows. So of an old shard that goes on, the ``low`` largest rows can stay,
    all beyond ``low + 1`` must go, and only the one between is decided by the flow; it is a block of its own and has its
    real size.
    """
    total = ranked.count()
    low = total // n_shards
    block = F.when(F.col("rank") < low, 0).when(F.col("rank") == low, 1).otherwise(2)
    return ranked.groupBy("old_shard", block.alias("block")).agg(
        F.min("rank").alias("first"), F.count("*").alias("n"), F.sum("size").alias("bytes"))


def reshard(df: DataFrame, n_shards: int = N_SHARDS, staging: Staging | None = None) -> DataFrame:
    """Assign every row of ``(doc_id, size, text_crc32, old_shard)`` to a shard so that the fewest bytes move.

    Law ``rows``: shards differ by one row at most. Of those that lose rows the smallest go, and the places for one row
    more are where they save most. Null ids and repeated rows are rows like others; an empty input gives no rows. Old
    shards beyond ``n_shards`` are emptied. Adds ``shard``, ``slot`` and ``moved``. To the driver come three sums for
    each old shard, back go at most as many ranges as the flow has arcs in use (fewer than blocks plus shards).
    """
    spark = df.sparkSession
    staging = staging or Staging(spark, "reshard")
    rows = staging.keep(df, "sizes")
    ranked = staging.keep(rank_in_shard(rows, staging), "ranked")
    staging.drop("sizes", "slices", "starts")
    blocks = blocks_of(ranked, n_shards).collect()
    moves = plan_moves([(b.old_shard, b["first"], b.n, b.bytes) for b in blocks], n_shards) if blocks else []
    ranges = spark.createDataFrame(
        moves, "_old int, _from long, _to long, shard int, _slot long").groupBy("_old").agg(
        F.collect_list(F.struct("_from", "_to", "shard", "_slot")).alias("ranges"))
    hit = F.filter("ranges", lambda r: (F.col("rank") >= r["_from"]) & (F.col("rank") < r["_to"]))[0]
    return ranked.join(F.broadcast(ranges), F.col("old_shard") == F.col("_old")).withColumn("hit", hit).select(
        *df.columns, F.col("hit.shard").alias("shard"), (F.col("hit._slot") + F.col("rank") - F.col("hit._from")).alias("slot"),
        (F.col("hit.shard") != F.col("old_shard")).alias("moved"))


# The column that tells the rows of :func:`keyed` apart.
ROW = "__row"


def keyed(documents: DataFrame, staging: Staging) -> DataFrame:
    """The rows with a number of their own in the column ``ROW``, stored so that it stays. Ids may be null or repeated."""
    if ROW in documents.columns:
        raise ValueError(f"a column {ROW} is there already")
    return staging.keep(documents.withColumn(ROW, F.monotonically_increasing_id()), "keyed")


def with_sizes(documents: DataFrame, old_shard: Column | None = None) -> DataFrame:
    """The columns :func:`reshard` needs: size is the UTF-8 bytes of the text (null: none) plus 16; the old shard is
    that of the row's source unless another is given. ``ROW`` comes along, where it is there."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(OLD_SHARDS)) if old_shard is None else old_shard
    text = F.coalesce("text", F.lit(""))
    key = [ROW] if ROW in documents.columns else []
    return documents.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), old.cast("int").alias("old_shard"), *key)


def rewrite_shards(documents: DataFrame, assigned: DataFrame, path: str) -> DataFrame:
    """Write the files of shards that lose or gain rows; the others stay as they are. Returns the affected shards.

    ``path`` holds a folder ``shard=K`` per shard. Only those of affected shards are replaced, after all rows are
    written, and those of shards left without rows are deleted last. Rows are told by ``ROW`` (:func:`keyed`), or
    by ``doc_id`` where it is missing; ids that are null or repeated are refused then, as they name no single row. All
    columns are kept as they are but ``shard`` and ``slot``, which are those of the layout.
    """
    moved = assigned.where("moved")
    affected = moved.select(F.col("shard")).union(moved.select(F.col("old_shard").alias("shard"))).distinct()
    key = ROW if {ROW} <= set(documents.columns) & set(assigned.columns) else "doc_id"
    if key == "doc_id":
        seen = assigned.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
        if seen.n != seen.ids:
            raise ValueError("null or repeated ids name no row: reshard the rows of keyed()")
    rows = assigned.select(F.col(key).alias("__key"), "shard", "slot").join(F.broadcast(affected), "shard")
    # A shard or slot that the rows bring along is that of the old layout.
    old = documents.drop("shard", "slot")
    (old.join(rows, old[key] == rows["__key"]).drop("__key", ROW)
     .repartition("shard", F.pmod("slot", F.lit(8))).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    emptied = affected.join(assigned.select("shard").distinct(), "shard", "left_anti")
    spark = documents.sparkSession
    for r in emptied.collect():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={r.shard}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return affected


def reshard_folder(spark: SparkSession, path: str, n_shards: int, staging: Staging | None = None) -> DataFrame:
    """Bring a folder of documents in ``shard=K`` to ``n_shards`` shards of equally many rows, up to one.

    The rows' old shard is the folder they lie in. Only files of shards that lose or gain rows are written; returns
    these shards. Rows without id, repeated ones and all other columns stay as they are.
    """
    staging = staging or Staging(spark, "reshard-folder")
    rows = keyed(spark.read.parquet(path), staging)
    assigned = staging.keep(reshard(with_sizes(rows, F.col("shard")), n_shards, staging), "assigned")
    return rewrite_shards(rows, assigned, path)
