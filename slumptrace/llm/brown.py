"""Operator 2: Brown class-based n-grams. Exchange clustering gives classes; transitions and emissions score texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, lean

# Words with a code of their own, those of them that are clustered first, and the classes all of them move between.
HEAD, CORE, CLASSES = 20_000, 2_000, 64
# Rounds over all texts in which every word with a code may move; fewer if the likelihood no longer rises.
ROUNDS = 4
# All other words fall into open classes by shape.
OPEN = 16
BACKOFF = 20.0


def is_held_out(column: str = "doc_id"):
    """Texts that nothing is learnt from; a row without an id is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def tokens_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at white space; the end that follows every text is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def open_class(word: bytes) -> int:
    """Shape of a word: letters beyond ASCII, a sign at its end, its length."""
    n = len(word)
    return (not word.isascii()) * 8 + (not word[-1:].isalnum() and word[-1] < 128) * 4 + (n > 4) + (n > 8) + (n > 13)


class WordCodes(dict):
    """Codes of words: below ``HEAD`` its own, else the 60-bit hash and the open class; emptied when grown large."""

    def __init__(self, head: dict[bytes, int]):
        super().__init__(head)
        self.head = head

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 600_000:
            self.clear()
            self.update(self.head)
        self[word] = code = (xxhash.xxh64_intdigest(word) >> 1 | 1 << 62) & ~15 | open_class(word)
        return code


def choose_head(documents: DataFrame, size: int = HEAD, staging: Staging | None = None) -> list[bytes]:
    """The words of all training texts that occur often enough, the most frequent first: at most ``size``.

    All words are counted. The least count that leaves no more than ``size`` words is read off how many words there
    are of each count, so it grows with the texts; no sort takes place, and the driver gets the words that stay.
    """
    staging = staging or Staging(documents.sparkSession, "head")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in lean(batches):
            for text in batch.column("text").to_pylist():
                seen.update(tokens_of(text))
                if len(seen) >= 300_000:
                    yield flush()
        yield flush()

    counted = documents.where(~is_held_out()).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = staging.keep(counted, "words")
    # Of each count above 1,000 the words are told apart by its first three digits only, so there are few groups.
    step = F.pow(10.0, F.greatest(F.lit(0), F.length(F.col("n").cast("string")) - 3)).cast("long")
    least = F.col("n") - F.col("n") % step
    held, threshold = 0, None
    for r in sorted(counted.groupBy(least.alias("least")).count().collect(), key=lambda r: -r.least):
        held += r["count"]
        if held > size:
            break
        threshold = r.least
    kept = counted.where(F.col("n") >= threshold).collect() if threshold is not None else []
    staging.drop("words")
    return [bytes(r.word) for r in sorted(kept, key=lambda r: (-r.n, bytes(r.word)))]


def encode(documents: DataFrame, head: list[bytes]) -> DataFrame:
    """Each text once as codes: ``row, doc_id, held_out, n_tokens, codes, tails, times``.

    ``codes`` are 16-bit: a head word's number, or ``HEAD`` plus its open class. ``tails`` are the other words by hash.
    """
    shared = documents.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(head)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, at = WordCodes(shared.value), TaskContext.get().partitionId(), 0
        for batch in lean(batches):
            sizes, codes, tails, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = np.array(list(map(known.__getitem__, tokens_of(text))), np.int64)
                tail = words >= HEAD
                found, n = np.unique(words[tail], return_counts=True)
                sizes.append(len(words) + 1)
                codes.append(np.where(tail, HEAD + (words & 15), words).astype("<u2").tobytes())
                tails.append(found)
                times.append(n.astype(np.int32))
            rows = (part << 33) + at + np.arange(len(sizes))
            at += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column("doc_id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                 pa.array(codes, pa.binary()), pa.array(tails, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                ["row", "doc_id", "held_out", "n_tokens", "codes", "tails", "times"])

    return documents.select("doc_id", is_held_out().alias("held_out"), "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, codes binary, tails array<long>, times array<int>")




def head_counts(encoded: DataFrame) -> np.ndarray:
    """How often each code occurs in training texts: at most ``HEAD + OPEN`` sums come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(HEAD + OPEN, np.int64)
        for batch in lean(batches):
            total += np.bincount(np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<u2"), minlength=HEAD + OPEN)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["code", "n"])

    rows = encoded.where("not held_out").select("codes").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(HEAD + OPEN, np.int64)
    for r in rows.collect():
        out[r.code] = r.n
    return out


def pair_counts(encoded: DataFrame, core_of: np.ndarray, size: int) -> np.ndarray:
    """Counts of neighbouring symbols over all training texts, as a matrix of fixed size.

    Symbols are the core words, the classes of all others and the end, which also stands before a text. Each task
    sends its nonzero sums; the driver gets ``size * size`` numbers at most.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(core_of)
    end = size - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, symbols = np.zeros(size * size, np.int64), shared.value
        for batch in lean(batches):
            rows = batch.column("codes").to_pylist()
            flat = symbols[np.frombuffer(b"".join(rows), "<u2")]
            chain = np.insert(flat, np.cumsum([len(r) // 2 for r in rows]), end)
            chain = np.r_[end, chain]
            total += np.bincount(chain[:-1] * size + chain[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["pair", "n"])

    rows = encoded.where("not held_out").select("codes").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    out = np.zeros(size * size, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(size, size)


def _loglog(a):
    return a * np.log(np.maximum(a, 1))


def _move(between: np.ndarray, right: np.ndarray, left: np.ndarray, own: float, old: int, classes: int) -> int:
    """Take a word out of class ``old`` and put it where the likelihood is highest; the new class. Changes ``between``.

    ``right`` and ``left`` count its neighbours by class, without the word itself (``own``).
    """
    between[old] -= right
    between[:, old] -= left
    between[old, old] -= own
    after, before = np.flatnonzero(right), np.flatnonzero(left)
    rows, columns = between[:classes, after], between[before, :classes].T
    gain = (_loglog(rows + right[after]) - _loglog(rows)).sum(1) + (_loglog(columns + left[before]) - _loglog(columns)).sum(1)
    diagonal = between[np.arange(classes), np.arange(classes)]
    r, l = right[:classes], left[:classes]
    gain += _loglog(diagonal + r + l + own) - _loglog(diagonal + r) - _loglog(diagonal + l) + _loglog(diagonal)
    rows_total, columns_total = between[:classes].sum(1), between[:, :classes].sum(0)
    a, b = right.sum() + own, left.sum() + own
    # The sums also take in the word's links with itself and its own class.
    gain -= _loglog(rows_total + a + l) - _loglog(rows_total) + _loglog(columns_total + b + r) - _loglog(columns_total)
    new = int(gain.argmax())
    if old < classes and gain[new] <= gain[old] + 1e-9:
        new = old
    between[new] += right
    between[:, new] += left
    between[new, new] += own
    return new


def exchange(pairs: np.ndarray, core: int, classes: int, rounds: int = 12) -> np.ndarray:
    """Exchange clustering: the class of each symbol, the first ``core`` of which may move between ``classes``.

    Words start in turn in the classes by frequency. In each round every word is taken out of its class and put where
    the likelihood of the class bigrams is highest, until no word moves. Other symbols keep a class of their own.
    """
    size = len(pairs)
    class_of = np.r_[np.arange(core) % classes, classes + np.arange(size - core)]
    n_classes = classes + size - core
    pairs = pairs.astype(np.float64)
    out_of, into = np.zeros((size, n_classes)), np.zeros((n_classes, size))  # word to class, class to word
    for c in range(n_classes):
        out_of[:, c] = pairs[:, class_of == c].sum(1)
        into[c] = pairs[class_of == c].sum(0)
    between = np.zeros((n_classes, n_classes))
    for c in range(n_classes):
        between[c] = out_of[class_of == c].sum(0)
    for _ in range(rounds):
        moved = 0
        for w in range(core):
            old, right, left, own = class_of[w], out_of[w].copy(), into[:, w].copy(), pairs[w, w]
            if not right.any() and not left.any():
                continue
            right[old] -= own
            left[old] -= own  # neighbours other than the word itself
            new = _move(between, right, left, own, old, classes)
            if new != old:
                moved += 1
                class_of[w] = new
                out_of[:, old] -= pairs[:, w]
                out_of[:, new] += pairs[:, w]
                into[old] -= pairs[w]
                into[new] += pairs[w]
        if not moved:
            break
    return class_of


def neighbour_counts(encoded: DataFrame, class_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code, and the end, how often each of ``n`` classes follows it and comes before it in training texts,
    and how often the code follows itself. The size is fixed: codes times classes."""
    shared = encoded.sparkSession.sparkContext.broadcast(np.r_[class_of, n - 1])
    codes = len(class_of) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, width = shared.value, 2 * n + 1
        total = np.zeros(codes * width, np.int64)
        for batch in lean(batches):
            rows = batch.column("codes").to_pylist()
            flat = np.frombuffer(b"".join(rows), "<u2").astype(np.int64)
            chain = np.r_[codes - 1, np.insert(flat, np.cumsum([len(r) // 2 for r in rows]), codes - 1)]
            a, b = chain[:-1], chain[1:]
            for key in (a * width + classes[b], b * width + n + classes[a], a[a == b] * width + 2 * n):
                np.add.at(total, key, 1)
        at = np.flatnonzero(total)
        for low in range(0, len(at), 100_000):
            part = at[low:low + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], ["place", "n"])

    rows = encoded.where("not held_out").select("codes").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    out = np.zeros(codes * (2 * n + 1))
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    out = out.reshape(codes, 2 * n + 1)
    return out[:, :n], out[:, n:2 * n], out[:, 2 * n]


def likelihood(between: np.ndarray) -> float:
    return float(_loglog(between).sum() - _loglog(between.sum(0)).sum() - _loglog(between.sum(1)).sum())


def exchange_all(encoded: DataFrame, class_of: np.ndarray, n_head: int, classes: int, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """Give each of the first ``n_head`` codes a class by exchange, starting from ``class_of``.

    In each round neighbours are counted by class over all training texts, and the words move against the small
    matrix of class bigrams. Words not yet in one of the ``classes`` all move in the first round, then every second
    word in turn, as neighbours moved in the same round are not seen. Of rounds after the first, one that does not
    raise the likelihood is taken back and ends it.
    """
    best, kept = None, class_of
    for round_ in range(rounds + 1):
        after, before, own = neighbour_counts(encoded, class_of, n)
        between = np.zeros((n, n))
        np.add.at(between, np.r_[class_of, n - 1], after)
        reached = likelihood(between)
        if round_ > 1 and reached <= best:
            return kept
        best, kept = reached, class_of
        if round_ == rounds:
            return kept
        class_of = class_of.copy()
        for w in range(n_head):
            if (round_ == 0) != (class_of[w] >= classes) or round_ and w % 2 != round_ % 2:
                continue
            old, right, left = class_of[w], after[w].copy(), before[w].copy()
            right[old] -= own[w]
            left[old] -= own[w]
            class_of[w] = _move(between, right, left, own[w], old, classes)
    return kept


@dataclass
class Classes:
    """Class of every code, log10 transition between classes, and log10 emission of head words."""

    class_of: np.ndarray
    transition: np.ndarray
    emission: np.ndarray


def build(
    encoded: DataFrame, kinds: np.ndarray, n_head: int, core: int = CORE, classes: int = CLASSES
) -> tuple[Classes, np.ndarray, np.ndarray]:
    """Cluster and count. ``kinds`` is the number of distinct other words per open class in training texts.

    Returns the model, the counts per code and the denominators of the open classes.
    """
    counts = head_counts(encoded)
    top = np.argsort(-counts[:HEAD], kind="stable")[:core]
    # Head words beyond the core share a class while the core is clustered, then get one of its classes each.
    size = core + 1 + OPEN + 1
    symbol = np.full(HEAD + OPEN, core, np.int64)
    symbol[top] = np.arange(core)
    symbol[HEAD:] = core + 1 + np.arange(OPEN)
    pairs = pair_counts(encoded, symbol, size)
    n = classes + 1 + OPEN + 1
    class_of = exchange_all(encoded, exchange(pairs, core, classes)[symbol], n_head, classes, n)
    between = np.zeros((n, n))
    np.add.at(between, np.r_[class_of, n - 1], neighbour_counts(encoded, class_of, n)[0])
    prior = (between.sum(0) + 1) / (between.sum() + n)
    transition = np.log10((between + BACKOFF * prior) / (between.sum(1, keepdims=True) + BACKOFF))
    head_class = class_of[:HEAD]
    held, types = np.bincount(head_class, counts[:HEAD], n), np.bincount(head_class[:n_head], minlength=n)
    emission = np.log10((counts[:HEAD] + 1) / np.maximum(held + types, 1)[head_class])
    open_total = np.log10(counts[HEAD:] + kinds + 1)
    return Classes(class_of, transition, emission), counts, open_total


def score_texts(documents: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    One row per input row; null and empty texts are the end alone. Texts are cut into words once and stored as codes.
    Words outside the head are summed per text, counted by a partial aggregation over all training texts and joined
    back by hash; rows of hot words were summed before, and adaptive execution splits what is left. A word of an open
    class has the chance ``(c + 1) / (tokens of the class + words of the class + 1)``, so unseen words keep their share.
    Hashes have 58 bits beside the class.
    """
    spark = documents.sparkSession
    staging = staging or Staging(spark, "brown")
    head = choose_head(documents, staging=staging)
    encoded = staging.keep(encode(documents, head), "encoded")
    pairs = encoded.select("row", "held_out", F.explode(F.arrays_zip("tails", "times")).alias("t")).select(
        "row", "held_out", F.col("t.tails").alias("word"), F.col("t.times").alias("n"))
    counted = staging.keep(
        pairs.where("not held_out").groupBy("word").agg(F.sum("n").alias("c")), "counted")
    kinds = np.zeros(OPEN, np.int64)
    for r in counted.groupBy(F.col("word").bitwiseAND(15).alias("kind")).count().collect():
        kinds[r.kind] = r["count"]
    model, counts, open_total = build(encoded, kinds, len(head))
    totals = encoded.where("not held_out").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("texts")).first()
    n_all = int(totals.n or 0)
    vocabulary = int((counts[:HEAD] > 0).sum() + kinds.sum() + (totals.texts > 0))
    base_head = np.log10(np.r_[counts[:HEAD] + 1, np.ones(OPEN)])
    known = np.r_[counts[:HEAD] > 0, np.zeros(OPEN, bool)].astype(np.int64)
    emission = np.r_[model.emission, -open_total]
    end, end_count = len(model.transition) - 1, int(totals.texts)
    shared = spark.sparkContext.broadcast((model.class_of, model.transition, emission, base_head, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, transition, emitted, base, is_known = shared.value
        for batch in lean(batches):
            rows = batch.column("codes").to_pylist()
            sizes = np.array([len(r) // 2 for r in rows])
            flat = np.frombuffer(b"".join(rows), "<u2").astype(np.int64)
            bounds = np.cumsum(sizes)
            chain = np.insert(class_of[flat], bounds, end)
            steps = transition[np.r_[end, chain[:-1]], chain]
            starts = np.r_[0, bounds + np.arange(1, len(sizes) + 1)][:-1]
            sums = lambda values: np.add.reduceat(np.insert(values, bounds, 0), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"),
                 pa.array(sums(is_known[flat]), pa.int64()), pa.array(sums(base[flat])), pa.array(np.add.reduceat(steps, starts) + sums(emitted[flat]))],
                ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_score"])

    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "codes").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, head_score double")
    scored = staging.keep(scored, "scored")
    tails = pairs.select("row", "word", "n").join(counted, "word").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("tail"), F.sum(F.col("n").cast("long")).alias("tail_known"))
    tails = staging.keep(tails, "tails")
    share = float(np.log10(n_all + vocabulary + 1))
    result = scored.join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(end_count > 0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail", F.lit(0.0)) + F.lit(float(np.log10(end_count + 1))) - F.col("n_tokens") * share).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail", F.lit(0.0))).alias("score"))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
