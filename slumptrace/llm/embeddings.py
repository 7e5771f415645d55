"""Operator 10: near-duplicate vectors by iterative quantisation, multi-index Hamming tables and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from slumptrace.llm.common import Staging, components, log2_rows, sample_ids

LEAST_COSINE = 0.9
SAMPLE_VECTORS = 20_000
TABLES = 16
# The expected share of pairs at exactly the least cosine that meet in some table, whatever the width of the keys.
RECALL = 0.95
# Vectors of one bucket that meet in one step; a larger bucket is compared chunk by chunk.
CHUNK = 256


def learn_rotation(vectors: np.ndarray, bits: int, rounds: int = 50) -> np.ndarray:
    """Projection and rotation for balanced binary codes (Gong and Lazebnik, 2011).

    Unit vectors are projected on their principal directions; then the rotation that brings them closest to the
    corners of the cube is found by turns: codes from the rotation, rotation from the codes (orthogonal Procrustes).
    The mean is not taken off: cosines are about the origin, and around the mean of one large group of near copies
    its members would look unlike each other.
    """
    _, axes = np.linalg.eigh(vectors.T @ vectors)
    projection = axes[:, ::-1][:, :bits]
    projected = vectors @ projection
    rotation, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((bits, bits)))
    for _ in range(rounds):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(codes.T @ projected)
        rotation = (u @ vt).T
    return projection @ rotation


def bit_order(bits: int, width: int, tables: int) -> list[int]:
    """The bits that make up the keys of all tables, ``width`` for each, others in every table."""
    rng = np.random.default_rng(5)
    order: list[int] = []
    while len(order) < width * tables:
        order += rng.permutation(bits).tolist()
    return order[:width * tables]


def key_width(rows: int) -> int:
    return max(8, log2_rows(rows) - 4)


def further_tables(least: float, dimension: int, bits: int, width: int, tables: int) -> int:
    """How many tables of random hyperplanes must join ``tables`` of learnt bits to reach ``RECALL`` at cosine ``least``.

    A hyperplane parts two vectors by their angle over pi, so a table of ``width`` of them keeps a pair together with
    ``p ** width``, whatever the data. Learnt bits are taken to do as well, but all tables draw on the same ``bits`` of
    them, so a pair with many different ones is lost in all; and where the codes have fewer bits than the vectors have
    components, the projection may hide an angle, and learnt tables are not counted.
    """
    p = 1 - math.acos(least) / math.pi
    missed = 1.0
    if dimension <= bits:
        missed = sum(math.comb(bits, h) * (1 - p)**h * p**(bits - h) * (1 - math.comb(bits - h, width) / math.comb(bits, width))**tables
                     for h in range(bits + 1))
    return 0 if missed <= 1 - RECALL or p == 1 else math.ceil(math.log((1 - RECALL) / missed) / math.log(1 - p**width))


def all_planes(rotation: np.ndarray, width: int, tables: int, further: int) -> np.ndarray:
    """The directions whose signs are the bits of all keys, ``width`` for each table: learnt ones, then random ones."""
    random = np.random.default_rng(7).standard_normal((len(rotation), width * further))
    return np.hstack([rotation[:, bit_order(rotation.shape[1], width, tables)], random])


def _node() -> Column:
    """The hash that names a vector; null unless all components are finite and one is not zero. -0.0 counts as 0.0."""
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite & F.exists("embedding", lambda x: x != 0), F.xxhash64(_doubles()))


def _doubles() -> Column:
    return F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def hamming_tables(nodes: DataFrame, dimension: int, planes: np.ndarray, width: int, first: int, last: int, kind: str) -> DataFrame:
    """One row per vector and table from ``first`` to before ``last``: ``bucket, at, node, copies, keys, vector``.

    ``at`` is the table, ``keys`` are those of the tables before it, ``vector`` are the components as numbers of ``kind``.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(planes[:, :width * last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, weights = shared.value, 1 << np.arange(width, dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                matrix = _matrix(part.column("vector"), dimension)
                n = len(matrix)
                bits = (_unit(matrix) @ planes >= 0).reshape(n, last, width)
                keys = (bits @ weights).astype("<u4")
                vectors = pa.array([v.tobytes() for v in matrix.astype(kind)], pa.binary())
                for t in range(first, last):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, t, np.int32)), pa.array(keys[:, t].astype(np.int64)), part.column("node"), part.column("copies"),
                         pa.array([k.tobytes() for k in keys[:, :t]], pa.binary()), vectors], ["at", "bucket", "node", "copies", "keys", "vector"])

    return nodes.mapInArrow(run, "at int, bucket long, node long, copies long, keys binary, vector binary")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links given by two columns of nodes those that join something new."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[ry] = rx
            kept.append((x, y))
    return kept


def _compare(groups: Iterator[pa.RecordBatch], dimension: int, least: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Links inside each group of rows with equal ``at, bucket, block``, which arrive one after the other.

    A pair counts in the first table that brings it together. Emits per node the copies linked to it, and the links
    that keep the group connected.
    """
    def settle(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, copies, side = (rows.column(c).to_numpy() for c in ("node", "copies", "side"))
        unit = _unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(-1, dimension).astype(np.float64))
        table = rows.column("at")[0].as_py()
        near = unit @ unit.T >= least
        if rows.column("alone")[0].as_py():
            i, j = np.nonzero(np.triu(near, 1))
        else:
            i, j = np.nonzero(near & (side[:, None] < side[None, :]))
        if table and len(i):
            keys = np.frombuffer(b"".join(rows.column("keys").to_pylist()), "<u4").reshape(-1, table)
            fresh = np.concatenate([~(keys[i[k:k + 65_536]] == keys[j[k:k + 65_536]]).any(1) for k in range(0, len(i), 65_536)])
            i, j = i[fresh], j[fresh]
        linked = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        kept = np.flatnonzero(linked)
        joined = _forest(node[i], node[j])
        return (np.r_[node[kept], [x for x, _ in joined]].astype(np.int64), np.r_[linked[kept], np.zeros(len(joined))].astype(np.int64),
                np.r_[np.full(len(kept), -1), [y for _, y in joined]].astype(np.int64))

    rest: pa.Table | None = None
    for batch in groups:
        whole = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        whole = whole.combine_chunks()
        names = np.stack([whole.column(c).to_numpy() for c in ("at", "bucket", "block")], 1)
        cuts = np.r_[0, np.flatnonzero((np.diff(names, axis=0) != 0).any(1)) + 1, len(names)]
        out = [settle(whole.slice(a, b - a).combine_chunks().to_batches()[0]) for a, b in zip(cuts[:-2], cuts[1:-1], strict=True) if b - a > 1]
        rest = whole.slice(cuts[-2])
        if out:
            yield _links(out)
    if rest is not None and rest.num_rows > 1:
        yield _links([settle(rest.combine_chunks().to_batches()[0])])


def _links(parts: list[tuple]) -> pa.RecordBatch:
    node, linked, other = (np.concatenate(p) for p in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(linked), pa.array(other), pa.array(other != -1)], ["node", "linked", "other", "is_link"])


def links(tables: DataFrame, dimension: int, least: float, staging: Staging, kind: str) -> DataFrame:
    """Links of all buckets: rows ``node, linked, other, is_link``.

    A bucket of more than ``CHUNK`` vectors is dealt into chunks, and every pair of chunks is a block of its own, so no
    task holds more than two chunks at a time, and a hot bucket is spread over all tasks.
    """
    sizes = staging.keep(tables.groupBy("at", "bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    placed = tables.join(sizes, ["at", "bucket"])
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(3)), chunks).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.least(j, "mine").cast("long") * F.col("chunks") + F.greatest(j, "mine"))
    placed = placed.withColumn("chunks", chunks).withColumn("mine", mine).select(
        "at", "bucket", "chunks", F.col("mine").alias("side"), F.explode(blocks).alias("block"), "node", "copies", "keys", "vector")
    alone = F.col("block") % F.col("chunks") == F.floor(F.col("block") / F.col("chunks"))
    placed = placed.withColumn("alone", alone).drop("chunks")
    ordered = placed.repartition("at", "bucket", "block").sortWithinPartitions("at", "bucket", "block", "side", "node")
    return ordered.mapInArrow(
        lambda batches: _compare(batches, dimension, least, kind), "node long, linked long, other long, is_link boolean")


def _links_of_length(
    ready: DataFrame, dimension: int, rows: int, least: float, tables: int, kind: str, staging: Staging
) -> list[DataFrame]:
    """The links among ``rows`` distinct vectors of one length, as stored parts."""
    # Equal vectors are one node here already, so copies cannot crowd the sample.
    sample = ready.join(F.broadcast(sample_ids(ready, "node", SAMPLE_VECTORS)), F.col("node") == F.col("_id"), "left_semi").select("vector").toArrow()
    rotation = learn_rotation(_unit(_matrix(sample.column("vector").combine_chunks(), dimension)), min(64, dimension))
    width = min(rotation.shape[1], 32, key_width(rows))
    further = further_tables(least, dimension, rotation.shape[1], width, tables)
    planes = all_planes(rotation, width, tables, further)
    parts = []
    for first in range(0, tables + further, tables):
        hashed = staging.keep(hamming_tables(
            ready.select("node", "copies", "vector"), dimension, planes, width, first, min(first + tables, tables + further), kind), "tables")
        parts.append(staging.keep(links(hashed, dimension, least, staging, kind), f"found-{dimension}-{first}"))
        staging.drop("tables", "buckets")
    return parts


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, tables: int = TABLES, staging: Staging | None = None) -> DataFrame:
    """Links of cosine ``least`` or more among all vectors: ``vec_id, n_links, component_id, kept``.

    One row per input row. Null, empty and zero vectors and those with null or non-finite components link with nothing;
    vectors link with others of their length only, and every length is searched. Equal vectors are one node: they count
    as each other's links and are compared with the rest once. The rotation of a length is learnt on at most
    ``SAMPLE_VECTORS`` vectors, by hash of id; all vectors are indexed. A table's key has about ``log2(rows) - 4`` bits, so buckets stay
    small as the input grows, and :func:`further_tables` keeps the expected recall at ``least`` from falling with them.
    ``tables`` tables are laid out and searched at a time, so the disk in use does not grow with their number. Every
    pair in a bucket is compared with its original vectors in double precision, so no link is wrong; a link is missed
    only if the two codes differ in every table (for recall see the README).
    Rows without an id keep a null component unless one with an id is in it.
    """
    spark = vectors.sparkSession
    staging = staging or Staging(spark, "vectors")
    rows = vectors.select("vec_id", "embedding", _node().alias("node"))
    usable = staging.keep(rows.where("node is not null").select("vec_id", "node", _doubles().alias("vector")), "usable")
    nodes = staging.keep(
        usable.groupBy("node").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")), "nodes")
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == FloatType() else "<f8"
    summed = groups = None
    parts = []
    # Vectors of different lengths have no cosine; each length is searched by itself, the commonest first.
    for d in nodes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "d").toLocalIterator():
        parts += _links_of_length(nodes.where(F.size("vector") == d.d), d.d, d.n, least, tables, kind, staging)
    if parts:
        found = reduce(DataFrame.union, parts)
        summed = staging.keep(found.where("not is_link").groupBy("node").agg(F.sum("linked").alias("linked")), "summed")
        groups = staging.keep(components(found.where("is_link"), staging, "node", "other"), "groups")
        staging.drop(*[label for label in staging.paths if label.startswith("found-")])
    roots = nodes.select("node", "copies", "first_id")
    if summed is not None:
        roots = roots.join(summed, "node", "left").join(groups, "node", "left")
    else:
        roots = roots.select("*", F.lit(None).cast("long").alias("linked"), F.lit(None).cast("long").alias("component"))
    roots = staging.keep(roots.select(
        "node", F.coalesce("component", "node").alias("root"), "first_id",
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "roots")
    smallest = staging.keep(roots.groupBy("root").agg(F.min("first_id").alias("smallest")), "smallest")
    placed = staging.keep(roots.join(smallest, "root").select("node", "n_links", "smallest"), "placed")
    return rows.select("vec_id", "node").join(placed, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("smallest", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("smallest", "vec_id"), F.lit(False)).alias("kept"))
