"""Operator 7: toxicity by multiple-instance learning. Sentence scores are trained through noisy-or from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import in_slices, lean, sample_ids, tidy

BUCKETS = 1 << 18
# The most labelled documents that the weights are fitted on.
TRAINING_DOCUMENTS = 12_000
EVIDENCE = 18.0
# Letters at the beginning of a word that are a feature of their own.
STEM = 4
THRESHOLD = 0.3
_SENTENCE = re.compile(r"[.!?\n]+")
_STRIP = ".,;:!?\"'()[]{}|#%&$*-"


class Buckets(dict):
    """Feature buckets of words seen before: the word without case and outer punctuation, and how it begins.

    Emptied when it has grown large.
    """

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 75_000:
            self.clear()
        plain = word.lower().strip(_STRIP)
        names = [plain] if plain else []
        if len(plain) > STEM:
            names.append(plain[:STEM] + "*")
        self[word] = found = tuple(1 + xxhash.xxh64_intdigest(x) % (BUCKETS - 1) for x in names) or (0,)
        return found


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from; a row without an id belongs to the others."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def bags(texts: list[str | None], buckets: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, where each sentence begins among them, and where each text begins among the sentences.

    A sentence ends at ``.``, ``!``, ``?`` or a line's end; a text without words is one empty sentence.
    """
    words: list[int] = []
    sentences, documents = [], []
    for text in texts:
        documents.append(len(sentences))
        for sentence in _SENTENCE.split(text or ""):
            found = sentence.split()
            if found:
                sentences.append(len(words))
                words += chain.from_iterable(map(buckets.__getitem__, found))
        if documents[-1] == len(sentences):
            sentences.append(len(words))
            words.append(0)
    return np.array(words, np.int32), np.array(sentences, np.int64), np.array(documents, np.int64)


@dataclass
class Instances:
    """The trained scorer: a weight per bucket and a bias per sentence."""

    weights: np.ndarray
    bias: float

    def sentences(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[words], starts) + self.bias

    def documents(self, logits: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Noisy-or: a text is toxic unless none of its sentences is."""
        return -np.expm1(np.add.reduceat(-np.logaddexp(0, logits), starts))


def association(seen: np.ndarray, toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """G statistic of the table (word or not) by (toxic or not) for every word."""
    cells = (toxic, seen - toxic, n_toxic - toxic, n - n_toxic - seen + toxic)
    totals = ((seen, n_toxic), (seen, n - n_toxic), (n - seen, n_toxic), (n - seen, n - n_toxic))
    return 2 * sum(c * np.log(np.maximum(c, 1e-9) * n / np.maximum(a * b, 1e-9)) for c, (a, b) in zip(cells, totals, strict=True))


def fit(words: list[np.ndarray], labels: np.ndarray, rounds: int = 200, rate: float = 0.05, ridge: float = 3e-4) -> Instances:
    """Maximise the likelihood of document labels under noisy-or, by Adam over all given documents.

    ``words`` holds per document the buckets of its sentences, separated by -1. Only buckets whose occurrence goes
    with the label beyond chance (likelihood-ratio statistic of ``EVIDENCE`` or more) get a weight. Without labels, or with one kind only, the score is the share of toxic labels.
    """
    model = Instances(np.zeros(BUCKETS, np.float32), 0.0)
    rate_toxic = float(labels.mean()) if len(labels) else 0.0
    if not 0 < rate_toxic < 1:
        model.bias = 20.0 if rate_toxic else -20.0
        return model
    seen, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for row, label in zip(words, labels, strict=True):
        found = np.unique(row[row > 0])
        seen[found] += 1
        toxic[found] += label
    used = np.flatnonzero(association(seen, toxic, len(labels), int(labels.sum())) >= EVIDENCE)
    column = np.zeros(BUCKETS, np.int64)
    column[used] = np.arange(1, len(used) + 1)
    flat = np.concatenate(words)
    # Instance number of each word, and document number of each instance.
    ends = np.flatnonzero(flat < 0)
    sizes = np.array([(row < 0).sum() for row in words])
    document = np.repeat(np.arange(len(words)), sizes)
    # Bucket 0 and the ends have no weight; only places of words that have one are kept.
    weighed = column > 0
    weighed[0] = False
    places = np.flatnonzero(weighed[np.maximum(flat, 0)])
    which, of = column[flat[places]] - 1, np.searchsorted(ends, places)
    del flat, places
    n = len(words)
    w, bias = np.zeros(len(used)), np.log(rate_toxic / np.bincount(document, minlength=n).mean())
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    scale = 1 / np.sqrt(seen[used])  # rare words move less
    for step in range(1, rounds + 1):
        logits = np.bincount(of, w[which], len(document)) + bias
        clean = np.minimum(np.bincount(document, -np.logaddexp(0, logits), n), -1e-9)  # log of all sentences being clean
        share = 1 / (1 + np.exp(-logits))
        # d/dz of -log p(label): share for clean labels, -share * q / (1 - q) for toxic ones, q the chance of clean.
        factor = np.where(labels, -np.exp(clean) / -np.expm1(clean), 1.0)
        slope = share * factor[document] / n
        g = np.bincount(which, slope[of], len(used)) + ridge * scale * w
        gb = slope.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    model.weights[used], model.bias = w, float(bias)
    return model


def train(documents: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS) -> Instances:
    """Fit on at most ``most`` labelled documents, chosen by hash of their id, never on held-out ones.

    Labels other than 0 and 1 are ignored; of several labels of one document the highest counts. Only bucket numbers
    come to the driver.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~is_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sample_ids(known, "doc_id", most)
    known = known.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "toxic")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in lean(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                words, starts, _ = bags([text], buckets)
                rows.append(np.insert(np.append(words, -1), starts[1:], -1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.binary())], ["toxic", "words"])

    rows = documents.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select(
        "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "toxic int, words binary")
    # One copy of the sample at a time: the driver has other things to hold.
    found = sorted((r.toxic, bytes(r.words)) for r in rows.toLocalIterator())
    return fit([np.frombuffer(w, np.int32) for _, w in found], np.array([t for t, _ in found], bool))


def score(documents: DataFrame, model: Instances) -> DataFrame:
    """Score every whole text: ``doc_id, score, n_sentences, worst_sentence, worst_score, worst_text``.

    One row per input row. A null or empty text is one sentence without words, scored by the bias. The offending
    sentence is the one of the highest score, the first on a tie; it is located by its number from 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, scorer = Buckets(), Instances(*shared.value)
        for batch in lean(batches):
            texts = batch.column("text").to_pylist()
            scores, counts, worst, worst_scores, worst_texts = [], [], [], [], []
            for low, high in in_slices(texts):
                words, starts, firsts = bags(texts[low:high], buckets)
                logits = scorer.sentences(words, starts)
                scores.append(scorer.documents(logits, firsts))
                bounds = np.append(firsts, len(starts))
                counts += np.diff(bounds).tolist()
                for k in range(high - low):
                    part = logits[bounds[k]:bounds[k + 1]]
                    at = int(part.argmax())
                    worst.append(at)
                    worst_scores.append(float(1 / (1 + np.exp(-part[at]))))
                    found = [s for s in _SENTENCE.split(texts[low + k] or "") if s.split()] if worst_scores[-1] >= THRESHOLD else []
                    worst_texts.append(found[at].strip() if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(counts, pa.int64()),
                 pa.array(worst, pa.int64()), pa.array(worst_scores, pa.float64()), pa.array(worst_texts, pa.string())],
                ["doc_id", "score", "n_sentences", "worst_sentence", "worst_score", "worst_text"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, n_sentences long, worst_sentence long, worst_score double, worst_text string")


def drop_toxic(documents: DataFrame, model: Instances, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, with all their columns.

    A null or empty text is one sentence without words. Rows are judged by their text alone, so repeated rows and ids go or
    stay together with their copies; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, scorer = Buckets(), Instances(*shared.value)
        for batch in lean(batches):
            texts = batch.column("text").to_pylist()
            keep: list[bool] = []
            for low, high in in_slices(texts):
                words, starts, firsts = bags(texts[low:high], buckets)
                keep += (scorer.documents(scorer.sentences(words, starts), firsts) < threshold).tolist()
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
