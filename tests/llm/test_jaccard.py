import random

import numpy as np
import pytest

from slumptrace.llm import jaccard as J

rng = random.Random(8)
WORDS = [f"w{i}" for i in range(3_000)]
say = lambda n: [rng.choice(WORDS) for _ in range(n)]


def edited(words, times):
    words = list(words)
    for _ in range(times):
        k = rng.randrange(len(words))
        words[k:k + 1] = rng.choice(([], [rng.choice(WORDS)], [words[k], rng.choice(WORDS)]))
    return words


def sets_of(texts, n=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def brute(rows, percent=85):
    """Components by comparing all pairs; rows with the same text are one node, an id may stand for several texts."""
    sets = sets_of([t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(k) and rows[m][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None) if sets[k] else i))
    return sorted(out, key=repr)


def found(df, staging, **more):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_copies(df, staging=staging, **more).collect()), key=repr)


def corpus():
    passage = say(60)
    rows = [None, "", " \t ", "one", "ONE", "two words", "Two  Words", "three words here", "four words are here", "Four\x0bwords are here"]
    for size in (8, 30, 120, 400):
        for _ in range(4):
            base = say(size)
            rows += [" ".join(edited(base, k)) for k in (0, 0, 1, 1, 2, size // 40, size // 25, size // 15)]
    # A chain: each text is close to the next, the ends are not.
    link = say(200)
    for _ in range(12):
        rows.append(" ".join(link))
        link = edited(link, 5)
    # Many unlike texts around one passage, and a large group of near copies.
    rows += [" ".join(say(40) + passage + say(40)) for _ in range(60)]
    group = say(150)
    rows += [" ".join(edited(group, rng.randrange(4))) for _ in range(80)]
    rows += [" ".join(say(25_000))]
    rng.shuffle(rows)
    return [*enumerate(rows), (None, rows[3]), (None, "alone without id"), (4, rows[5]), (2, rows[2])]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_against_all_pairs(documents, staging, rows):
    assert found(documents(*rows), staging) == brute(rows)


def test_without_sample_and_with_common_shingles_moved_back(documents, staging, rows, monkeypatch):
    monkeypatch.setattr(J, "_common_in_sample", lambda *_: np.zeros(0, np.uint64))
    monkeypatch.setattr(J, "COMMON", 8)
    monkeypatch.setattr(J, "BASE", 3)
    assert found(documents(*rows), staging) == brute(rows)


def test_other_thresholds(documents, staging, rows):
    part = [r for r in rows if len(r[1] or "") < 3_000]
    assert found(documents(*part), staging, percent=60) == brute(part, 60)


def test_prefixes_meet():
    gen = np.random.default_rng(1)
    for _ in range(300):
        n = int(gen.integers(1, 60))
        a = np.unique(gen.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[gen.random(len(a)) < 0.93], gen.integers(0, 2**63, int(gen.integers(0, 4))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        common = np.sort(gen.choice(a, len(a) // 2, replace=False)) if len(a) > 1 else np.zeros(0, np.uint64)
        assert len(np.intersect1d(J.prefix_of(a, common, 85), J.prefix_of(b, common, 85)))


def test_one_of_each_group_stays(documents, staging, rows):
    df = documents(*rows)
    kept = J.keep_one(df, staging)
    assert kept.columns == df.columns
    groups = brute(rows)
    expected = {c for i, n, c in groups if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 1


def test_empty(documents, staging):
    df = documents((1, "a")).limit(0)
    assert J.near_copies(df, staging=staging).count() == 0
    assert J.keep_one(df, staging).count() == 0
    only = documents((1, None), (2, ""))
    assert found(only, staging) == [(1, 0, 1), (2, 0, 2)]


def test_the_pipeline_stage_takes_five_words_and_four_fifths(spark, documents):
    """A text with a fifth of its words appended is a near copy to the stage, and not to the operator's defaults."""
    import corpus_pipeline

    rows = []
    for _ in range(12):
        base = say(100)
        rows += [" ".join(base), " ".join(base + say(20)), " ".join(edited(base, 2)), " ".join(base + say(40))]
    rows = [*enumerate(rows), (100, None), (101, "one"), (102, "ONE")]
    sets = sets_of([t for _, t in rows], 5)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    expected = {min(rows[m][0] for m in range(len(rows)) if find(m) == find(k)) for k in range(len(rows))}
    df = documents(*rows)
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()} == expected
    assert len(expected) < len({r.doc_id for r in J.keep_one(df).collect()})


def test_base_pairs_are_told_at_the_threshold(spark):
    """Of pairs that only have to be linked, those surely below the threshold go; distances to pivots are kept up to twice."""
    pool = np.random.default_rng(3).integers(0, 2**63, 1_180).astype(np.uint64)
    sets = [pool[:1_000], pool[180:1_180], pool[60:1_060]]
    sketches = spark.createDataFrame(
        [(k, bytearray(J.sketch(s)), len(s)) for k, s in enumerate(sets)], "node long, sketch binary, n_shingles long")
    pairs = spark.createDataFrame(
        [(a, b, far) for a in range(3) for b in range(a) for far in (False, True)], "node long, pivot long, far boolean")
    kept = lambda far: {tuple(r) for r in J._near(pairs.where(pairs.far == far), sketches, 85).collect()}
    # 820 of 1,180 shingles in common, 940 of 1,060, and 880 of 1,120.
    assert (2, 0) in kept(False) and (1, 0) not in kept(False)
    assert {(1, 0), (2, 0), (2, 1)} == kept(True)


def test_measuring_in_blocks(spark, monkeypatch):
    """A pivot of many nodes is split; each block has its pivot's text, and every pair is measured once."""
    monkeypatch.setattr(J, "BLOCK", 3)
    texts = {k: " ".join(say(6 + k % 9)) for k in range(40)} | {50: "w1 w2 w3 w4 w5 w6"}
    rows = spark.createDataFrame([(k, t) for k, t in texts.items()], "node long, text string")
    pairs = [(k, 50) for k in range(40)] + [(3, 1), (3, 2), (2, 1)]
    found = J._measure(spark.createDataFrame(pairs, "node long, pivot long"), rows, 4).collect()
    sets = {k: sets_of([t])[0] for k, t in texts.items()}
    assert sorted(tuple(r) for r in found) == sorted((a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in pairs)


def test_repeated_rows_without_ids_are_one_text(documents, staging):
    base = say(60)
    rows = [(None, " ".join(base))] * 7 + [(None, " ".join(edited(base, 1)))] * 5 + [(4, " ".join(edited(base, 1))), (4, " ".join(base))]
    assert found(documents(*rows), staging) == brute(rows)


children = J._children


def test_a_group_of_near_copies_is_not_divided(documents, staging, monkeypatch):
    """Near copies that meet in many regions are connected by pivots; none of their regions is laid out in parts."""
    divided = []
    monkeypatch.setattr(J, "_children", lambda *a: divided.append(a) or children(*a))
    text = say(100)
    rows = [(i, " ".join(edited(text, i % 3))) for i in range(90)]
    assert found(documents(*rows), staging) == brute(rows)
    assert not divided


def around(text, copies, most):
    """Near copies of one text, each with up to ``most`` edits of its own."""
    return [(i, " ".join(edited(text, i % (most + 1)))) for i in range(copies)]


def test_a_large_group_of_near_copies_is_compared_with_few_pairs(documents, staging, monkeypatch):
    """What is laid out and measured grows with the members of the group, not with its pairs."""
    laid_out, measured, near, measure = [], [], J._near, J._measure
    monkeypatch.setattr(J, "_near", lambda pairs, *a: laid_out.append(pairs.count()) or near(pairs, *a))
    monkeypatch.setattr(J, "_measure", lambda pairs, *a: measured.append(pairs.count()) or measure(pairs, *a))
    rows = around(say(150), 240, 7)
    assert found(documents(*rows), staging) == brute(rows)
    assert sum(laid_out) < 8 * len(rows) and sum(measured) < 3 * len(rows), (laid_out, measured)


def test_members_with_too_much_before_a_shingle_leave_its_region(spark):
    """At 85 of 100, a set of 100 whose shingle stands at place k allows another of (100 - k) * 185 / 85 - 100 at most."""
    entries = [(1, 10, 100, 0), (1, 11, 100, 8), (1, 12, 100, 9), (2, 20, 100, 14), (2, 21, 85, 0), (3, 30, 100, 12), (3, 31, 90, 3),
               (4, 40, 100, 0), (4, 41, 118, 0)]
    df = spark.createDataFrame(entries, "region long, node long, size long, at int")
    kept = sorted(r.node for r in J._within_reach(df, 85).collect())
    # A member that fits no other may stay for its own size; it is alone then, and its region goes.
    assert kept == [10, 11, 20, 21, 31, 40, 41]


def test_sets_that_are_close_stay_together(spark, documents, staging):
    """No pair at or above the threshold is lost, also at the very bound of sizes and places."""
    text = say(203)
    rows = [(0, " ".join(text)), (1, " ".join(text[:173])), (2, " ".join(text[30:])), (3, " ".join(text[:172])), (4, " ".join(say(15) + text[15:]))]
    rows += [(5 + k, " ".join(say(1 + k % 16) + text[k:])) for k in range(30)]
    assert found(documents(*rows), staging) == brute(rows)


def test_divided_regions(documents, staging, rows, monkeypatch):
    divided = []
    monkeypatch.setattr(J, "_children", lambda *a: divided.append(a) or children(*a))
    monkeypatch.setattr(J, "BASE", 2)
    monkeypatch.setattr(J, "WIDER", (0, 1))
    part = [r for r in rows if len(r[1] or "") < 3_000]
    assert found(documents(*part), staging, percent=70) == brute(part, 70)
    assert divided


def test_unlike_members_of_a_large_region_are_compared_in_parts(documents, staging, monkeypatch):
    """Texts that have little more than one passage meet in its regions, far from each other; that takes no round for each few."""
    divided, rounds, pivots = [], [], J._pivots
    monkeypatch.setattr(J, "_children", lambda *a: divided.append(a) or children(*a))
    monkeypatch.setattr(J, "_pivots", lambda members, round_: rounds.append(round_) or pivots(members, round_))
    monkeypatch.setattr(J, "BASE", 8)
    monkeypatch.setattr(J, "WIDER", (0, 16))
    passage = say(60)
    rows = [(i, " ".join(passage + [f"own{i}x{k}" for k in range(3)])) for i in range(200)]
    rows += [(200 + i, f"{rows[i][1]} more") for i in range(0, 200, 40)]
    assert found(documents(*rows), staging) == brute(rows)
    assert not divided and len(rounds) <= 2


def test_parts_of_a_region_give_its_pairs_once(spark):
    pool = np.random.default_rng(4).integers(0, 2**63, 900).astype(np.uint64)
    sets = {k: np.unique(pool[5 * k:5 * k + 300]) for k in range(40)}
    sketches = spark.createDataFrame([(k, bytearray(J.sketch(s)), len(s)) for k, s in sets.items()], "node long, sketch binary, n_shingles long")
    pairs = {}
    for parts in (1, 4):
        members = spark.createDataFrame([(7, k, k, parts) for k in sets], "region long, node long, group long, parts long")
        pairs[parts] = sorted(tuple(r) for r in J._near_in_regions(members, sketches, 85).collect())
    assert pairs[1] == pairs[4] and {(k + 1, k) for k in range(39)} <= set(pairs[1])


def test_rarer_common_shingles_come_first():
    shingles = np.arange(1, 21, dtype=np.uint64)
    common, places = np.arange(3, 21, dtype=np.uint64), np.arange(18)[::-1].copy()
    assert J.prefix_of(shingles, common, 80, places).tolist() == [1, 2, 20, 19, 18]
    assert J.prefix_of(shingles, common, 80).tolist() == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("size", [3_000, 8_000, 20_000])
def test_sketches_tell_large_sets_apart(spark, size):
    """Two unlike sets of any size are told by their sketches; close ones of unlike numbers of bins are kept."""
    gen = np.random.default_rng(size)
    sets = [np.unique(gen.integers(0, 2**63, size).astype(np.uint64)) for _ in range(3)]
    sets.append(np.unique(np.concatenate([sets[0], gen.integers(0, 2**63, size // 9).astype(np.uint64)])))
    sketches = spark.createDataFrame([(k, bytearray(J.sketch(s)), len(s)) for k, s in enumerate(sets)], "node long, sketch binary, n_shingles long")
    pairs = spark.createDataFrame([(a, b, False) for a in range(4) for b in range(a)], "node long, pivot long, far boolean")
    assert [tuple(r) for r in J._near(pairs, sketches, 80).collect()] == [(3, 0)]
    members = spark.createDataFrame([(7, k, k, 1) for k in range(4)], "region long, node long, group long, parts long")
    assert [tuple(r) for r in J._near_in_regions(members, sketches, 80).collect()] == [(3, 0)]


def test_folded_sketches_are_those_of_fewer_bins(monkeypatch):
    gen = np.random.default_rng(5)
    sets = [np.unique(gen.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 4_000, 4_300, 9_000, 70_000, 200_000)]
    taken = [J.sketch(s) for s in sets]
    monkeypatch.setattr(J, "MOST_BINS", J.BINS)
    assert J.folded(taken, J.BINS).tolist() == [list(J.sketch(s)) for s in sets]
    between = J.apart([taken[a] for a in range(6) for b in range(6)], [taken[b] for a in range(6) for b in range(6)])
    assert all(x <= len(np.setxor1d(sets[a], sets[b])) for x, (a, b) in zip(between, ((a, b) for a in range(6) for b in range(6)), strict=True))
