import math
import zlib
from collections import Counter

import numpy as np
import pytest

from slumptrace.llm import brown as B

TEXTS = [None, "", "The cat sat.", "the CAT sat. the cat\tran", "É é É", "x\x0by\x0cz\x1cw", "the the the " * 3_000, "new words only here", "The cat sat."]


def brute(rows):
    tokens = [[w for w in (t or "").encode().lower().split()] + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for (i, _), h, ws in zip(rows, held, tokens, strict=True)]


def test_base_scores(documents, staging):
    rows = [*enumerate(TEXTS), (3, TEXTS[2]), (None, "the cat"), (11, "the cat sat"), (16, "one more"), (25, "cat the")]
    found = B.score_texts(documents(*rows), staging).collect()
    key = lambda r: repr((r[0], r[2], r[3], round(r[5], 6)))
    for ours, theirs in zip(sorted([tuple(r) for r in found], key=key), sorted(brute(rows), key=key), strict=True):
        assert ours[:5] == theirs[:5]
        assert ours[5] == pytest.approx(theirs[5], abs=1e-6)
        assert math.isfinite(ours[6]) and ours[6] < 0


def test_empty_table(documents, staging):
    assert B.score_texts(documents((1, "x")).limit(0), staging).count() == 0


def test_chances_sum_to_one(documents, staging):
    """Over all words that follow a given one, and one unseen word per open class, the model's chances add up to 1."""
    rng = np.random.default_rng(2)
    words = ["aa", "bb", "cc", "dd", "ee"]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(30)]
    df = documents(*rows)
    head = B.choose_head(df, size=3)
    encoded = staging.keep(B.encode(df, head), "e")
    tails = [w for w in words if w.encode() not in head]
    kinds = np.bincount([B.open_class(w.encode()) for w in tails], minlength=B.OPEN)
    # The module's head is wider than this test's; codes beyond it stand for open classes.
    model, counts, open_total = B.build(encoded, kinds, len(head), core=2, classes=2)
    n = len(model.transition)
    assert np.allclose((10.0**model.transition).sum(1), 1)
    emitted = np.zeros(n)
    np.add.at(emitted, model.class_of[:len(head)], 10.0 ** model.emission[:len(head)])
    used = np.unique(model.class_of[:len(head)])
    assert np.allclose(emitted[used], 1)
    kind = B.open_class(b"dd")
    tail_counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split() if w in tails)
    assert sum(c + 1 for c in tail_counts.values()) + 1 == pytest.approx(10.0 ** open_total[kind])


def test_exchange_raises_the_likelihood_and_finds_the_classes():
    """Words 0-3 are only followed by words 4-7 and the other way round."""
    rng = np.random.default_rng(0)
    pairs = np.zeros((9, 9))
    pairs[:4, 4:8] = rng.integers(5, 20, (4, 4))
    pairs[4:8, :4] = rng.integers(5, 20, (4, 4))

    def likelihood(class_of):
        between = np.zeros((4, 4))
        np.add.at(between, (class_of[:, None].repeat(9, 1), class_of[None].repeat(9, 0)), pairs)
        f = lambda a: (a * np.log(np.maximum(a, 1))).sum()
        return f(between) - f(between.sum(0)) - f(between.sum(1))

    order = np.array([0, 1, 4, 2, 5, 6, 3, 7, 8])
    found = B.exchange(pairs[np.ix_(order, order)], 8, 2)
    restored = np.empty(9, int)
    restored[order] = found
    assert len(set(restored[:4])) == len(set(restored[4:8])) == 1 and restored[0] != restored[4]
    start = np.r_[np.arange(8) % 2, 2]
    shuffled = np.empty(9, int)
    shuffled[order] = start
    assert likelihood(restored) > likelihood(shuffled)


def test_better_than_single_words_on_held_out_texts(spark, staging):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in B.score_texts(df, staging).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_every_kept_word_gets_a_class_by_exchange(documents, staging):
    """Verbs follow nouns and the other way round; words beyond the core of two fall in the classes of their kind."""
    rng = np.random.default_rng(3)
    nouns, verbs = ([f"{c}{k}" for k in range(8)] for c in "nv")
    rows = [(i, " ".join(w for _ in range(60) for w in (rng.choice(nouns), rng.choice(verbs)))) for i in range(40)]
    df = documents(*rows)
    head = B.choose_head(df, staging=staging)
    assert sorted(head) == sorted(w.encode() for w in nouns + verbs)
    encoded = staging.keep(B.encode(df, head), "e")
    model, _, _ = B.build(encoded, np.zeros(B.OPEN, np.int64), len(head), core=2, classes=2)
    by = dict(zip((w.decode() for w in head), model.class_of.tolist(), strict=False))
    assert set(by.values()) == {0, 1}
    assert len({by[w] for w in nouns}) == len({by[w] for w in verbs}) == 1


def test_words_of_all_texts_are_counted(documents, staging):
    """A word of many texts is kept wherever it is, and the count that keeps a word grows with the texts."""
    rows = [(i, f"common word{i} word{i}" + " late" * (i >= 6_500)) for i in range(7_000)]
    assert {b"common", b"late"} <= set(B.choose_head(documents(*rows), size=100, staging=staging))
