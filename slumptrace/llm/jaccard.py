"""Operator 6: an exact Jaccard join on word n-grams as a metric-space join, and its connected components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, components, in_slices, lean, tidy

WORDS, PERCENT = 4, 85
# Shingles found in this many of the sampled documents come last in the order of pivots. The sample is this large, or one
# document in so many of a large table: there, a shingle of a sample that did not grow could be in any number of documents.
SAMPLE_DOCUMENTS, SAMPLE_EVERY, SAMPLE_COMMON = 8_192, 64, 4
# Binary digits between two magnitudes of their counts.
MAGNITUDE = 4
# A shingle whose region is larger than this, or than a 2^-20 share of all entries, is moved back as well.
COMMON = 1_024
MAX_PIVOTS = 16
# Regions of up to this many members are not divided further: one task looks at all their pairs by sketch. So many times as
# many in each round: in the first, all members of all regions are compared with one pivot only, which connects most of what
# is close, so that a group of near copies isn't compared pair by pair; what it leaves is mostly far from each other. Before
# the last of these rounds regions stay whole.
BASE, WIDER = 32, (0, 32, 32)
# A region in which most members are connected may be so many times larger, as long as its pairs are no more.
MOSTLY_CONNECTED = 16
# A larger one of unconnected members is dealt out to parts of as many, and each two parts are looked at together; one member
# goes to so many times fewer parts than a part has members at most. Pivots don't help there, as members that have little more
# than a common shingle are far from all others.
PARTED = 64
# Up to this many pairs are sent to all tasks, which then read the texts without a shuffle.
BROADCAST_PAIRS = 200_000
# Nodes that are measured against one copy of their pivot's text.
BLOCK = 64
# Least and most bins of the sketches that tell far pairs before their texts are compared, and shingles in a bin. With many in
# each, two large sets look alike whatever they hold: counts of 16 differ by a seventh, as do sets that are 75 % similar.
BINS, MOST_BINS, IN_A_BIN = 256, 8_192, 16
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words seen before; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_sets(texts: list[str | None], n: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word n-grams.

    Words are what white space separates, A-Z lower-cased. A text of fewer words is one shingle; one without words
    has none.
    """
    for low, high in in_slices(texts):
        rows = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts[low:high]]
        sizes = [len(r) for r in rows]
        flat = np.fromiter((h for r in rows for h in map(hashes.__getitem__, r)), np.uint64, sum(sizes))
        mixed = np.zeros(max(0, len(flat) - n + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                mixed ^= flat[k:k + len(mixed)]
                mixed *= _PRIME
                mixed ^= mixed >> np.uint64(29)
        at = 0
        for row, size in zip(rows, sizes, strict=True):
            if size >= n:
                yield np.unique(mixed[at:at + size - n + 1])
            elif size:
                yield np.array([xxhash.xxh64_intdigest(b" ".join(row), seed=size)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
            at += size


def prefix_of(shingles: np.ndarray, common: np.ndarray, percent: int, places: np.ndarray | None = None) -> np.ndarray:
    """The shingles whose regions a set must enter: two sets that are close enough share one of these.

    All sets order their shingles alike, by hash with the common ones last, these by ``places`` where given; from a set of
    ``n`` the first ``n - ceil(n * percent / 100) + 1`` are taken. ``common`` is sorted.
    """
    n = len(shingles)
    if not n:
        return shingles
    size = n - (percent * n + 99) // 100 + 1
    if not len(common):
        return shingles[:size]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    late = common[at] == shingles
    last = shingles[late]
    return np.concatenate([shingles[~late], last if places is None else last[np.argsort(places[at[late]])]])[:size]


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each bin, up to 255; larger sets have more bins, always a power of two. The sum of
    differences of two sketches, see :func:`folded`, is at most the number of shingles that only one of the sets has."""
    bins = min(MOST_BINS, max(BINS, 1 << (len(shingles) // IN_A_BIN).bit_length()))
    return np.minimum(np.bincount((shingles % np.uint64(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes], bins: int) -> np.ndarray:
    """The sketches as rows, as if taken with ``bins`` bins, which is no more than any of them has."""
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
    if (sizes == bins).all():
        return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, bins).astype(np.int16)
    out = np.empty((len(sketches), bins), np.int16)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join(sketches[k] for k in at), np.uint8).reshape(-1, size // bins, bins)
        # A sum of numbers cut at 255 is, cut there again, that of the whole numbers.
        out[at] = rows[:, 0] if size == bins else np.minimum(rows.sum(1, dtype=np.int64), 255)
    return out


def apart(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """The sum of differences of each pair of sketches, at the bins of the smaller one."""
    out = np.empty(len(a), np.int64)
    bins = np.fromiter((min(len(x), len(y)) for x, y in zip(a, b, strict=True)), np.int64, len(a))
    for size in np.unique(bins).tolist():
        at = np.flatnonzero(bins == size)
        out[at] = np.abs(folded([a[k] for k in at], size) - folded([b[k] for k in at], size)).sum(1)
    return out


def _scan(documents: DataFrame, n: int, percent: int, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    # Of the common shingles the rarer ones come first: a text of nothing else doesn't meet all others that hold the commonest.
    # Counts of one magnitude are alike, so that the shingles of a group of near copies are taken by hash.
    by_hash = np.argsort(common)
    places = np.argsort(np.lexsort((common, np.log2(np.maximum(counts, 1)) // MAGNITUDE)))
    shared = documents.sparkSession.sparkContext.broadcast((common[by_hash], places[by_hash]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (last, places) = WordHashes(), shared.value
        for batch in lean(batches):
            sizes, prints, prefixes, sketches = [], [], [], []
            for found in shingle_sets(batch.column("text").to_pylist(), n, hashes):
                sizes.append(len(found))
                prints.append(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).astype(np.int64) if len(found) else None)
                prefixes.append(prefix_of(found, last, percent, places).view(np.int64))
                sketches.append(sketch(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "node", "prefix", "sketch"])

    return documents.mapInArrow(run, "doc_id long, text_key long, n_shingles long, node long, prefix array<long>, sketch binary")


def _common_in_sample(documents: DataFrame, n: int) -> np.ndarray:
    """Shingles that several documents of a sample share, and below them about how many documents have each. Any order is
    right; this one keeps regions small."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in lean(batches):
            sets = list(shingle_sets(batch.column("text").to_pylist(), n, hashes))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64())], ["shingle"])

    total = documents.count()
    every = max(1, total // max(SAMPLE_DOCUMENTS, total // SAMPLE_EVERY))
    rows = documents.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text").mapInArrow(run, "shingle long")
    found = rows.groupBy("shingle").count().where(F.col("count") >= SAMPLE_COMMON).toArrow()
    return np.stack([found.column("shingle").to_numpy().view(np.uint64), found.column("count").to_numpy().view(np.uint64) * np.uint64(every)])


def _within_reach(entries: DataFrame, percent: int) -> DataFrame:
    """Drop from each region the members that are close to no other because of what stands before the region's shingle.

    ``at`` is the place of that shingle in the order of the set. Two close sets meet in the region of the first shingle that
    they share; of the smaller one's ``size`` shingles no more than ``size - at`` are common then. ``100 * common >=
    percent * union`` allows the other set at most ``widest`` shingles. Of a large group of near copies those with many
    shingles of their own leave here.
    """
    reach = entries.withColumn("widest", F.floor((100 + percent) * (F.col("size") - F.col("at")) / percent) - F.col("size"))
    bounds = reach.groupBy("region").agg(F.min("size").alias("low"), F.max("widest").alias("high"))
    return reach.join(bounds, "region").where("widest >= low AND size <= high").drop("widest", "low", "high")


def _distinct_regions(members: DataFrame, staging: Staging, label: str) -> DataFrame:
    """Drop regions whose members are all connected, and all but one of those with the same members."""
    held = members.groupBy("region").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.bit_xor("node").alias("x"),
        F.bit_xor(F.xxhash64("node")).alias("y"), F.min("group").alias("low"), F.max("group").alias("high"))
    kept = held.where("low < high").groupBy("n", "a", "b", "x", "y").agg(F.min("region").alias("region")).select("region")
    kept = staging.keep(kept, f"{label}-regions")
    return staging.keep(members.join(kept, "region"), label)


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow them to be close, or, where they are ``far``, at twice that distance; all others
    are surely farther apart."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            between = apart(*(batch.column(c).to_pylist() for c in ("a", "b")))
            both = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            # Similarity is at most (both - between) / (both + between), and at most smaller over larger.
            smaller = np.minimum(batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy())
            least = np.where(batch.column("far").to_numpy(zero_copy_only=False), 2 * percent - 100, percent)
            near = (100 * (both - between) >= least * (both + between)) & (100 * smaller >= least * (both - smaller))
            yield batch.select(["node", "pivot"]).filter(pa.array(near))

    a = sketches.select("node", F.col("sketch").alias("a"), F.col("n_shingles").alias("size_a"))
    b = sketches.select(F.col("node").alias("pivot"), F.col("sketch").alias("b"), F.col("n_shingles").alias("size_b"))
    return pairs.join(a, "node").join(b, "pivot").select("node", "pivot", "far", "a", "b", "size_a", "size_b").mapInArrow(
        run, "node long, pivot long")


def _near_in_regions(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs of each region, not connected yet, whose sketches allow them to be close. A region, or each two of its
    ``parts``, is a bounded number of rows and pairs and is compared in one task, sorted by size: a set can only be close to
    those at most ``100 / percent`` times as large. Members of its largest group are compared with those outside it only."""

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        rows.sort(key=lambda r: r[3])
        nodes, groups, sizes, parts = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 3, 4))
        # Pairs within a part are found where it is looked at by itself.
        two = len(rows) > 0 and parts.min() < parts.max()
        # Larger sets stand behind and have as many bins at least; for each number of bins, all rows that have as many.
        bins = np.fromiter((len(r[2]) for r in rows), np.int64, len(rows))
        levels, starts = np.unique(bins, return_index=True)
        prints = [folded([r[2] for r in rows[start:]], level) for level, start in zip(levels.tolist(), starts.tolist(), strict=True)]
        ends = [*starts[1:], len(rows)]

        def differences(i: int, others: np.ndarray) -> np.ndarray:
            out = []
            for level, start, end, own in zip(levels, starts, ends, prints, strict=True):
                last = level == bins[i]
                low, high = np.searchsorted(others, [start, len(rows) if last else end])
                if low < high:
                    # Behind the last of its own level, row i is compared at its bins; before it, at theirs.
                    out.append(np.abs(own[others[low:high] - start] - own[i - start]).sum(1))
                if last:
                    break
            return np.concatenate(out)

        names, members_of = np.unique(groups, return_counts=True)
        inside = groups == names[members_of.argmax()] if len(rows) else groups == 0
        within, outside = np.flatnonzero(inside), np.flatnonzero(~inside)
        out = []
        for k, i in enumerate(outside):
            low = np.searchsorted(sizes[within] * 100, percent * sizes[i], "left")
            high = np.searchsorted(sizes[within] * percent, 100 * sizes[i], "right")
            end = np.searchsorted(sizes[outside] * percent, 100 * sizes[i], "right")
            for others in (within[low:high], outside[k + 1:end]):
                if len(others):
                    between = differences(i, others)
                    both = sizes[others] + sizes[i]
                    near = (100 * (both - between) >= percent * (both + between)) & (groups[others] != groups[i])
                    if two:
                        near &= parts[others] != parts[i]
                    out += [(max(int(nodes[i]), x), min(int(nodes[i]), x)) for x in nodes[others][near].tolist()]
        return out

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        names = ("region", "node", "group", "sketch", "n_shingles", "part")
        for batch in itertools.chain(lean(batches), [None]):
            out: list[tuple[int, int]] = []
            if batch is None:
                out += compare(rows)
            else:
                for region, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                    if region != current:
                        out += compare(rows)
                        current, rows = region, []
                    rows.append(tuple(row))
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(a), pa.int64()), pa.array(list(b), pa.int64())], ["node", "pivot"])

    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = members.select("region", "node", "group", "parts", part.alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with"))
    # A region in one part keeps its name.
    pair = F.xxhash64("region", F.least("part", "with"), F.greatest("part", "with"))
    dealt = dealt.withColumn("region", F.when(F.col("parts") > 1, pair).otherwise(F.col("region")))
    rows = dealt.join(sketches.select("node", "sketch", "n_shingles"), "node").select("region", "node", "group", "sketch", "n_shingles", "part")
    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, "node long, pivot long")


def _measure(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Intersection and union sizes of the sets of ``(node, pivot)`` pairs, from their whole texts.

    The pairs of one pivot are split into blocks of about ``BLOCK`` nodes. A block gets its pivot's text once, before
    those of its nodes; a task holds one set and one text at a time. ``pairs`` is a stored table; few of them go to the
    texts, of many both sides are shuffled.
    """
    few = F.broadcast if pairs.count() <= BROADCAST_PAIRS else lambda df: df
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = pairs.join(sizes, "pivot").select("pivot", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "node")
    heads = texts.withColumnRenamed("node", "pivot").join(few(dealt.select("pivot", "block").distinct()), "pivot").select(
        "pivot", "block", F.lit(None).cast("long").alias("node"), "text")
    rows = heads.union(texts.join(few(dealt), "node").select("pivot", "block", "node", "text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, head = WordHashes(), np.zeros(0, np.uint64)
        for batch in lean(batches):
            pivots, nodes = (batch.column(c).to_pylist() for c in ("pivot", "node"))
            out: list[tuple[int, int, int, int]] = []
            for pivot, node, found in zip(pivots, nodes, shingle_sets(batch.column("text").to_pylist(), n, hashes), strict=True):
                if node is None:
                    head = found
                    continue
                both = len(np.intersect1d(head, found, assume_unique=True))
                out.append((node, pivot, both, len(head) + len(found) - both))
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["node", "pivot", "common", "total"])

    return rows.repartition("pivot", "block").sortWithinPartitions("pivot", "block", F.asc_nulls_first("node")).mapInArrow(
        run, "node long, pivot long, common long, total long")


def _pivots(members: DataFrame, round_: int) -> DataFrame:
    """Of each region its pivots, the number of its members and that of its largest group. There are more pivots the longer
    it takes; which hash picks one differs from round to round. The first is the one in which the region's shingle stands
    first: of near copies that is the one with the fewest shingles of its own, which is close to most of the others."""
    first = [F.col("at")] if not round_ else []
    many = min(4**round_, MAX_PIVOTS << min(2, round_ // 8))
    names = [f"p{k}" for k in range(many)]
    firsts = [F.min(F.struct(*first, F.xxhash64("node", F.lit(round_), F.lit(k)).alias("h"), F.struct("node", "group", "size").alias("p"))).alias(name)
              for k, name in enumerate(names)]
    each = members.groupBy("region", "group").agg(F.count("*").alias("held"), *firsts)
    found = each.groupBy("region").agg(F.sum("held").alias("n"), F.max("held").alias("largest"), *[F.min(name).alias(name) for name in names])
    return found.select("region", "n", "largest", F.array_distinct(F.array(*[F.col(name)["p"] for name in names])).alias("pivots"))


def _children(placed: DataFrame, measured: DataFrame, percent: int, round_: int, staging: Staging) -> DataFrame:
    """``(region, node)`` of the two parts of each region around its first pivot, see :func:`metric_groups`."""
    reach = (100 - percent) / 100 + 1e-9
    first = placed.select(
        "region", F.col("node").alias("member"), F.greatest("node", F.col("pivots")[0]["node"]).alias("node"),
        F.least("node", F.col("pivots")[0]["node"]).alias("pivot"))
    d = 1 - F.col("common") / F.col("total")
    away = staging.keep(
        first.join(measured, ["node", "pivot"], "left").select("region", F.col("member").alias("node"), d.alias("d"))
        .withColumn("ring", F.when(F.col("d") <= reach, 0).when(F.col("d") <= 2 * reach, 1).otherwise(2)), f"away-{round_}")
    nearest = staging.keep(away.where("ring = 1").groupBy("region").agg(F.min("d").alias("nearest")), f"nearest-{round_}")
    sides = away.join(nearest, "region", "left").select(
        "region", "node", "ring",
        F.when(F.col("ring") == 0, F.when(F.col("d") >= F.col("nearest") - reach, F.array(F.lit("ball"))))
        .when(F.col("ring") == 1, F.array(F.lit("ball"), F.lit("rest"))).otherwise(F.array(F.lit("rest"))).alias("sides"))
    children = sides.select("region", "node", "ring", F.explode("sides").alias("side"))
    # The ring alone is in the other child already.
    filled = children.groupBy("region", "side").agg(F.min("ring").alias("low")).where("side = 'rest' OR low = 0").select("region", "side")
    filled = staging.keep(filled, f"filled-{round_}")
    return children.join(filled, ["region", "side"]).select(F.xxhash64("region", "side", F.lit(round_)).alias("region"), "node")


def metric_groups(members: DataFrame, sketches: DataFrame, texts: DataFrame, n: int, percent: int, staging: Staging) -> DataFrame | None:
    """Components of the close sets, ``(node, component)``, by recursion on pivots in each region.

    Each round a region takes pivots among its members and measures how far everyone is from them; close ones are
    linked. Members that links have connected, directly or not, are not compared any more, and a region of connected
    members is done. In the first round that is all, with one pivot for each region: a large group of near copies, which meets
    in many regions, is connected there by few distinct pairs. Regions whose pairs between groups are no more than ``BASE``
    times ``WIDER`` members have end the recursion: these pairs are compared directly; so are, in parts, those
    of more members, see ``PARTED``.

    What is still larger in the last width falls into a ball around its first pivot (within the threshold ``r``), a ring
    (within ``2 r``) and the rest. By the triangle inequality nothing in the ball is close to the rest, so it splits into
    two: ball and ring, and ring and rest. Members of the ball are connected already; they only enter the first child, and
    of them only those that can reach the nearest member of the ring. Who is beyond ``2 r`` is mostly told by sketches
    alone. A pivot leaves its region, and there are more of them the deeper the recursion is.
    """
    groups = None
    members = members.withColumn("group", F.col("node"))
    # Every round takes a pivot at least out of every region that is left, so it ends.
    for round_ in itertools.count():
        if members.isEmpty():
            return groups
        base, divided = BASE * WIDER[min(round_, len(WIDER) - 1)], round_ >= len(WIDER) - 1
        pivots = staging.keep(_pivots(members, round_), f"pivots-{round_}")
        is_one = (F.col("n") <= MOSTLY_CONNECTED * base) & ((F.col("n") - F.col("largest")) * F.col("n") <= base * base)
        is_small = is_one | (F.col("n") * PARTED <= base * base)
        near = None
        if base:
            parts = F.when(is_one, F.lit(1)).otherwise(F.ceil(F.col("n") / base)).cast("long")
            small = members.join(pivots.where(is_small).select("region", parts.alias("parts")), "region")
            # One after the other, so that the shuffles of only one of them lie on disk.
            near = staging.keep(_near_in_regions(small, sketches, percent).distinct(), f"near-small-{round_}")
            staging.drop()
        large = pivots.where(~is_small).select("region", "pivots")
        is_last = large.isEmpty()
        if not is_last:
            placed = members.join(large, "region")
            # Where a region is divided, the distance to the first pivot is needed up to twice the threshold; else only links are.
            pairs = placed.select("node", "size", "group", F.posexplode("pivots").alias("k", "p")).withColumn(
                "far", (F.col("k") == 0) & F.lit(divided)).where((F.col("node") != F.col("p.node")) & (F.col("far") | (F.col("group") != F.col("p.group"))))
            least = F.when(F.col("far"), 2 * percent - 100).otherwise(percent)
            pairs = pairs.where(100 * F.least("size", "p.size") >= least * F.greatest("size", "p.size")).select(
                F.greatest("node", "p.node").alias("node"), F.least("node", "p.node").alias("pivot"), "far")
            pairs = pairs.groupBy("node", "pivot").agg(F.max("far").alias("far"))
            to_pivots = staging.keep(_near(pairs, sketches, percent), f"near-pivots-{round_}")
            near = to_pivots if near is None else near.union(to_pivots).distinct()
            staging.drop()
        near = staging.keep(near, f"near-{round_}")
        measured = staging.keep(_measure(near, texts, n), f"measured-{round_}")
        staging.drop()
        links = measured.where(100 * F.col("common") >= percent * F.col("total")).select(
            F.col("node").alias("src"), F.col("pivot").alias("dst"))
        if groups is not None:
            links = links.union(groups.select(F.col("node").alias("src"), F.col("component").alias("dst")))
        groups = staging.keep(components(links, staging), f"groups-{round_}")
        if is_last:
            return groups
        placed = placed.where(~F.exists("pivots", lambda p: p["node"] == F.col("node")))
        if divided:
            children = _children(placed, measured, percent, round_, staging).join(sketches.select("node", F.col("n_shingles").alias("size")), "node")
        else:
            children = placed.select("region", "node", "size")
        children = children.join(groups, "node", "left").select("region", "node", "size", F.coalesce("component", "node").alias("group"))
        members = _distinct_regions(children, staging, f"members-{round_}")
        done = [f"{label}-{round_}" for label in ("pivots", "near-small", "near-pivots", "near", "measured", "away", "nearest", "filled")]
        done += [f"members-{round_}-regions", f"members-{round_ - 1}" if round_ else "members", f"groups-{round_ - 1}"]
        staging.drop(*[label for label in done if label in staging.paths])


def near_copies(documents: DataFrame, n: int = WORDS, percent: int = PERCENT, staging: Staging | None = None) -> DataFrame:
    """:func:`with_roots` without the name of the component among the texts."""
    return with_roots(documents, n, percent, staging).drop("root")


def with_roots(documents: DataFrame, n: int = WORDS, percent: int = PERCENT, staging: Staging | None = None) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` or more: ``doc_id,
    n_shingles, component_id, text_key, root``.

    One row per input row. ``root`` names the component by its texts (null: no shingles), as an id may stand for several. Texts with equal sets are one node, so copies are never paired. A text without words (or
    null) has no shingles and stays alone. ``component_id`` is the smallest id reachable; rows without an id have
    none of their own. Rows with the same id keep their own text's component. Sets and nodes are named by 64-bit
    hashes.

    Far pivots tell nothing here: the distance of two random texts is 1. So the outermost pivots are single shingles,
    the regions the sets near them, and the replication window is the prefix that two close sets cannot both miss.
    Inside, pivots are documents (:func:`metric_groups`).
    """
    spark = documents.sparkSession
    staging = staging or Staging(spark, "jaccard")
    source = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    common, counts = _common_in_sample(documents, n).reshape(2, -1)
    for attempt in range(5):
        scanned = staging.keep(_scan(source, n, percent, common, counts), f"scanned-{attempt}")
        entries = scanned.select(F.posexplode("prefix").alias("at", "region"), "node", F.col("n_shingles").alias("size"))
        # Most shingles are in one text only. They are counted first, with as little as can be, and go no further.
        shared = staging.keep(entries.groupBy("region").agg(F.count("*").alias("n")).where("n > 1"), f"shared-{attempt}")
        entry_count = scanned.agg(F.sum(F.size("prefix")).alias("n")).first().n or 0
        found = shared.where(F.col("n") > max(COMMON, entry_count >> 20)).toArrow()
        late, held = found.column("region").to_numpy().view(np.uint64), found.column("n").to_numpy().view(np.uint64)
        new = ~np.isin(late, common)
        if not new.any() or attempt == 4:
            break
        common, counts = np.concatenate([common, late[new]]), np.concatenate([counts, held[new]])
        staging.drop(f"scanned-{attempt}", f"shared-{attempt}")
    rows = staging.keep(scanned.select("doc_id", "text_key", "n_shingles", "node"), "rows")
    # Copies have put their shingles in more than once.
    members = staging.keep(entries.join(shared.select("region"), "region").distinct(), "entries")
    members = _distinct_regions(_within_reach(members, percent).withColumn("group", F.col("node")), staging, "members")
    one_each = scanned.select("node", "n_shingles", "sketch", "doc_id", "text_key").join(members.select("node").distinct(), "node").groupBy(
        "node").agg(F.min(F.struct("doc_id", "text_key")).alias("from"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    sketches = staging.keep(one_each, "sketches")
    staging.drop(f"scanned-{attempt}", f"shared-{attempt}", "entries")
    wanted = sketches.select("node", F.col("from.doc_id").alias("_doc"), F.col("from.text_key").alias("_key"))
    texts = source.join(wanted, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    texts = staging.keep(texts.select("node", "text"), "texts")
    if texts.count() > sketches.count():
        # The same row more than once, or one text several times without an id.
        texts = staging.keep(texts.dropDuplicates(["node"]), "texts-once")
    groups = metric_groups(members, sketches, texts, n, percent, staging)
    staging.drop("sketches", "texts")
    if groups is not None:
        rows = rows.join(groups, "node", "left").withColumn("root", F.coalesce("component", "node"))
    else:
        rows = rows.withColumn("root", F.col("node"))
    smallest = staging.keep(rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest")), "smallest")
    return rows.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"), "text_key", "root")


def keep_one(documents: DataFrame, staging: Staging | None = None, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the row with the smallest id, then the smallest text hash; all columns stay.
    ``n`` and ``percent`` are those of :func:`near_copies`.

    Of rows repeated with id and text one stays. A row without an id stays where no row of its group has one, one for each
    group. Rows without words are copies of nothing but their own repetitions. Rows of one id with unlike texts are in groups
    of their own, so the texts of both stay.
    """
    staging = staging or Staging(documents.sparkSession, "keep-one")
    found = staging.keep(with_roots(documents, n, percent, staging).select("doc_id", "text_key", "root"), "found")
    # Without shingles a row is its own group.
    alone = F.col("root").isNull()
    group = F.struct("root", F.when(alone, F.col("doc_id")).alias("doc_id"), F.when(alone, F.col("text_key")).alias("text_key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"))
    best = found.groupBy(group.alias("group")).agg(first.alias("b")).select("b.doc_id", "b.text_key")
    best = staging.keep(best, "best")
    key = F.xxhash64(documents["text"])
    kept = documents.join(best, documents["doc_id"].eqNullSafe(best["doc_id"]) & (key == best["text_key"]), "left_semi")
    twice = staging.keep(found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "twice")
    if twice.isEmpty():
        return kept
    repeated = documents["doc_id"].eqNullSafe(twice["doc_id"]) & (key == twice["text_key"])
    return kept.join(twice, repeated, "left_anti").union(
        kept.join(twice, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
