"""Ranked search against plain loops."""

import math
import random
import re

import pytest

from slumptrace.llm.search import search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, top=10):
    counts = [(d, plain_terms(t)) for d, t in documents]
    n_all, l_all = sum(1 for _, w in counts if w), sum(len(w) for _, w in counts)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, words in counts:
            if not words:
                continue
            m, score = 100 - 90 + (90 * len(words) * n_all) // l_all, 0
            for term in terms:
                if tf := words.count(term):
                    df = sum(1 for _, w in counts if term in w)
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, k, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return out


@pytest.fixture
def items(spark):
    def build(*rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, term string, item int")

    return build


def rows_of(df):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=key)


def test_terms():
    for text in ["", None, "Ab-c_d 12é'ÉŁ", "[x]^`{y}~\x7f\x80z", "日本 語", "A@Z:9/0"]:
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("block", [500_000, 5])
def test_against_loops(documents, items, block):
    rnd = random.Random(1)
    words = [f"w{k}" for k in range(40)] + ["É", "Zz"]
    rows = [(k, " ".join(rnd.choices(words, [1 / (j + 1) for j in range(42)], k=rnd.randint(0, 60)))) for k in range(120)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, None), (900, ""), (901, "..."), (902, "w1 " * 3_000)]
    asked = [(k, " ".join(rnd.choices(words, k=rnd.randint(1, 12)))) for k in range(12)]
    asked += [(50, None), (51, ""), (52, "unheard of"), (3, "w39 w38"), (None, "w5 w6"), (60, asked[0][1]), (0, asked[0][1])]
    df = documents(*rows)
    for parts in (1, 17):
        found = search(df.repartition(parts), items(*asked), block_postings=block)
        assert rows_of(found) == sorted(brute(rows, asked), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_ties_go_to_smaller_ids(documents, items):
    rows = [(k, "same words here") for k in range(500, 0, -1)] + [(k, "other") for k in range(1_000, 1_100)]
    found = search(documents(*rows).repartition(9), items((1, "words")), top=10)
    assert [(r["rank"], r["doc_id"]) for r in found.orderBy("rank").collect()] == [(k, k) for k in range(1, 11)]


def test_small_pieces_are_the_same(documents, items, monkeypatch):
    rnd = random.Random(2)
    rows = [(k, " ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 30)))) for k in range(60)]
    asked = [(k, " ".join(rnd.choices("abcdefgh", k=4))) for k in range(6)]
    monkeypatch.setattr("slumptrace.llm.search.SCORES", 12)
    monkeypatch.setattr("slumptrace.llm.search.CONTRIBUTIONS", 3)
    assert rows_of(search(documents(*rows), items(*asked))) == sorted(brute(rows, asked))


def test_empty(documents, items):
    assert search(documents((1, "a")).limit(0), items((1, "a"))).collect() == []
    assert search(documents((1, "a")), items((1, "a")).limit(0)).collect() == []
    assert search(documents((1, None)), items((1, "a"))).collect() == []
