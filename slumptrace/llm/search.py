"""Operator 13: ranked lexical search the other way round: documents stream through an index of the items."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, in_slices

TOP = 10
# Postings (term and item) of one block of items, whose index goes to every task: about 50 MB at most.
BLOCK_POSTINGS = 500_000
# Scores of documents against items that are held at once, and contributions to them.
SCORES, CONTRIBUTIONS = 1 << 21, 1 << 22
# All that is no part of a term becomes a blank, and A-Z lower case; bytes beyond ASCII are parts of terms.
_TERMS = bytes(c if c > 0x7F or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split() if text else []


@dataclass(frozen=True)
class Index:
    """Terms of some items, and which items hold each: ``ids[items[starts[t]:starts[t + 1]]]`` for term ``t``."""

    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    ids: pa.Array


def item_terms(items: DataFrame, key: str = "item_id") -> DataFrame:
    """``item, term``: the distinct terms of each item. Rows with one id, or with none, are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, t) for k, text in enumerate(batch.column(1).to_pylist()) for t in set(terms_of(text))]
            at = pa.array([k for k, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([t for _, t in rows], pa.binary())], ["item", "term"])

    return items.select(key, "text").mapInArrow(run, f"item {dict(items.dtypes)[key]}, term binary").distinct()


def read_index(postings: DataFrame) -> Index:
    """The index of one block of items, which it numbers in some order."""
    found = postings.toArrow()
    names = found.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    of = names.indices.to_numpy()
    words = found.column("term").combine_chunks().dictionary_encode()
    term = words.indices.to_numpy()
    order = np.lexsort((of, term))
    terms = {t: k for k, t in enumerate(words.dictionary.to_pylist())}
    starts = np.append(0, np.cumsum(np.bincount(term, minlength=len(terms))))
    return Index(terms, starts, of[order].astype(np.int64), names.dictionary)


def count_terms(documents: DataFrame, index: Index) -> DataFrame:
    """``doc_id, n, term, tf``: per document how many terms it has, and which of the index's terms how often."""
    shared = documents.sparkSession.sparkContext.broadcast(index.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in in_slices(texts, 4_000_000):
                sizes, terms, counts, ends = [], [], [], [0]
                for text in texts[low:high]:
                    words = terms_of(text)
                    found = Counter(map(known, words))
                    found.pop(None, None)
                    sizes.append(len(words))
                    terms.extend(found.keys())
                    counts.extend(found.values())
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], ["doc_id", "n", "term", "tf"])

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(documents.dtypes)['doc_id']}, n long, term array<int>, tf array<bigint>")


def weights(counted: DataFrame, index: Index, documents: int) -> np.ndarray:
    """``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` of every term of the index."""
    df = np.zeros(len(index.terms), np.int64)
    for row in counted.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
        df[row["term"]] = row["count"]
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def best_documents(
    counted: DataFrame, index: Index, weight: np.ndarray, documents: int, total: int, top: int, item_type: str
) -> DataFrame:
    """``item, doc_id, score``: the best ``top`` documents of each item among those that one task has seen.

    A task holds a heap of at most ``top`` entries per item. A document's terms are looked up in the index and their
    contributions added up by item; only scores that reach an item's heap are compared one by one.
    """
    shared = counted.sparkSession.sparkContext.broadcast((index.starts, index.items, index.ids, weight))
    kind = dict(counted.dtypes)["doc_id"]

    def score(sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Scores of documents ``low`` to ``high`` against all items, in pieces that fit in memory."""
        starts, items, ids, weight = shared.value
        count = len(ids)
        m = 100 - 90 + (90 * sizes * documents) // total
        owner = np.repeat(np.arange(len(sizes)), np.diff(ends))
        parts = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
        wide = starts[terms + 1] - starts[terms]
        work = np.append(0, np.cumsum(wide))
        low = 0
        while low < len(sizes):
            high = max(low + 1, min(low + max(1, SCORES // count), int(np.searchsorted(work[ends], work[ends[low]] + CONTRIBUTIONS, "right")) - 1, len(sizes)))
            scores = np.zeros((high - low) * count, np.int64)
            # One document may have more contributions than are held at once.
            first = ends[low]
            while first < ends[high]:
                last = max(first + 1, min(int(np.searchsorted(work, work[first] + CONTRIBUTIONS, "right")) - 1, ends[high]))
                each = wide[first:last]
                entry = np.repeat(np.arange(first, last), each)
                place = starts[terms[entry]] + np.arange(len(entry)) - np.repeat(np.cumsum(each) - each, each)
                np.add.at(scores, (owner[entry] - low) * count + items[place], parts[entry])
                first = last
            yield low, high, scores.reshape(-1, count)
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value[2]
        count = len(ids)
        heaps: list[list[tuple]] = [[] for _ in range(count)]
        least = np.ones(count, np.int64)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            term, tf = batch.column("term"), batch.column("tf")
            ends = term.offsets.to_numpy().astype(np.int64)
            flat = [c.values.to_numpy()[ends[0]:ends[-1]] for c in (term, tf)]
            for low, high, scores in score(batch.column("n").to_numpy(), ends - ends[0], *flat):
                # What is not among the best of these documents is not among the best of all.
                bar = np.partition(scores, -top, axis=0)[-top] if len(scores) > top else 1
                for row, item in np.argwhere(scores >= np.maximum(least, bar)).tolist():
                    name, heap = names[low + row], heaps[item]
                    # Larger is better: a higher score, then a lower id, ids before none.
                    entry = (int(scores[row, item]), name is not None, 0 if name is None else -name)
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == top:
                        least[item] = max(1, heap[0][0])
        rows = [(item, -e[2] if e[1] else None, e[0]) for item, heap in enumerate(heaps) for e in heap]
        at, names, found = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(at, pa.int64())), pa.array(names, pa.int64()), pa.array(found, pa.int64())], ["item", "doc_id", "score"])

    return counted.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, f"item {item_type}, doc_id long, score long").withColumn("doc_id", F.col("doc_id").cast(kind))


def search(
    documents: DataFrame, items: DataFrame, staging: Staging | None = None, top: int = TOP, key: str = "item_id",
    block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """The best documents for each item: ``item_id, rank, doc_id, score``, ranks from 1.

    ``documents`` have whole numbers as ids. Scores are 64-bit integers; equal ones rank by ascending id, rows without
    an id last. A null or empty text has no terms and is found by nothing; an item without terms, or whose terms no
    document holds, has no rows. Repeated rows of documents are documents of their own; rows of items with the same id
    are one item with the terms of all. Empty tables give no rows; other columns are not looked at.

    Every document is read once per block of items. A block holds about ``block_postings`` pairs of term and item,
    counted before its index is broadcast; an item is never cut.
    """
    spark = documents.sparkSession
    staging = staging or Staging(spark, "search")
    postings = staging.keep(item_terms(items, key), "postings")
    blocks = max(1, -(-postings.count() // block_postings))
    kind, totals = dict(items.dtypes)[key], None
    best = spark.createDataFrame([], f"item {kind}, doc_id {dict(documents.dtypes)['doc_id']}, score long")
    for block in range(blocks):
        index = read_index(postings.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block))
        if not len(index.ids):
            continue
        counted = staging.keep(count_terms(documents, index), f"counted-{block}")
        if totals is None:
            row = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
            totals = row.n, row.l or 0
        if totals[1]:
            weight = weights(counted, index, totals[0])
            best = best.union(staging.keep(best_documents(counted, index, weight, *totals, top, kind), f"best-{block}"))
        staging.drop(f"counted-{block}")
    # A few rows per task and item are left; each task keeps no more than the best of them before they are shuffled.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(key), "rank", "doc_id", "score")
