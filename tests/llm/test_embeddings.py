import numpy as np
import pytest

from slumptrace.llm import embeddings as E


def brute(rows, least=0.9):
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sound[a] and sound[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    linked[a] += 1
                    linked[b] += 1
                    root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(k) and rows[m][0] is not None]
        low = min(ids, default=None)
        out.append((i, linked[k], low, i is not None and i == low))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, node string, copies int")


def found(df, staging, **more):
    return sorted((tuple(r) for r in E.near_duplicates(df, staging=staging, **more).collect()), key=repr)


def vectors(n, dimension=32, spread=0.08, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = rng.normal(size=dimension)
        centre /= np.linalg.norm(centre)
        rows += [(centre + rng.normal(size=dimension) * spread * rng.random() / np.sqrt(dimension) * 3).astype(np.float32).tolist()
                 for _ in range(rng.integers(1, 6))]
    return rows[:n]


def test_against_all_pairs(spark, staging):
    base = vectors(300)
    odd = [None, [], [0.0] * 32, [float("nan")] + base[0][1:], [float("inf")] + base[0][1:], [None] + base[0][1:], base[1], base[1], [2 * x for x in base[2]],
           [1e-30 * x for x in base[3]], [1e30 * x for x in base[4]]]
    rows = [*enumerate(base + odd), (5, base[5]), (None, base[6]), (7, base[90])]
    assert found(frame(spark, rows), staging) == brute(rows)


def test_a_hot_group_in_chunks(spark, staging, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    rows = list(enumerate((centre + rng.normal(size=16) * 0.15).astype(np.float32).tolist() for _ in range(120)))
    whole = found(frame(spark, rows), staging)
    monkeypatch.setattr(E, "CHUNK", 7)
    assert found(frame(spark, rows), staging) == whole == brute(rows)


def test_recall_of_borderline_pairs(spark, staging):
    """Pairs at a cosine of 0.9 to 0.93 only, the hardest there are: at least nine in ten are found."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = 0.9005 + 0.03 * rng.random()
        rows += [(2 * k, a.tolist()), (2 * k + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist())]
    links = sum(r[1] for r in found(frame(spark, rows), staging))
    assert links <= 800 and links >= 0.9 * 800


def test_rotation_is_one_and_balances_bits():
    rng = np.random.default_rng(4)
    data = rng.normal(size=(2_000, 24)) * np.linspace(0.2, 3, 24)
    rotation = E.learn_rotation(data, 24)
    assert rotation.T @ rotation == pytest.approx(np.eye(24), abs=1e-8)
    share = (data @ rotation >= 0).mean(0)
    assert (abs(share - 0.5) < 0.1).all()


def test_small_inputs(spark, staging):
    assert found(frame(spark, [(1, [1.0, 0.0])]).limit(0), staging) == []
    rows = [(1, None), (2, [0.0, 0.0])]
    assert found(frame(spark, rows), staging) == [(1, 0, 1, True), (2, 0, 2, True)]
    rows = [(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    assert found(frame(spark, rows), staging) == brute(rows)


@pytest.mark.parametrize("width", [16, 20])
def test_recall_with_the_keys_of_large_tables(spark, staging, monkeypatch, width):
    """Keys as wide as for 1 to 16 million rows: pairs at a cosine of just 0.9 are still found."""
    monkeypatch.setattr(E, "key_width", lambda _: width)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(400):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.9005 * a + np.sqrt(1 - 0.9005**2) * b).tolist())]
    links = sum(r[1] for r in found(frame(spark, rows), staging))
    assert links <= 800 and links >= 0.9 * 800


def test_expected_recall_does_not_fall_with_the_width():
    p = 1 - np.arccos(0.9) / np.pi
    for bits, dimension in ((64, 64), (64, 384), (16, 16)):
        for width in range(8, min(bits, 32) + 1):
            further = E.further_tables(0.9, dimension, bits, width, E.TABLES)
            missed = (1 - p**width)**further
            if dimension <= bits:
                apart = np.random.default_rng(1).random((4_000, bits)) > p
                keys = [apart[:, E.bit_order(bits, width, E.TABLES)[t * width:(t + 1) * width]].any(1) for t in range(E.TABLES)]
                missed *= np.all(keys, 0).mean()
            assert 1 - missed >= E.RECALL - 0.01


def test_every_length_is_compared(spark, staging):
    base = vectors(60, dimension=8)
    rng = np.random.default_rng(9)
    rare = rng.normal(size=6)
    rows = [*enumerate(base), (100, rare.tolist()), (101, (rare + 0.01 * rng.normal(size=6)).tolist()), (102, [1.0]), (103, [2.5]), (104, [-1.0])]
    got = found(frame(spark, rows), staging)
    assert got == brute(rows)
    assert {r[0]: r[1] for r in got if r[0] is not None and r[0] >= 100} == {100: 1, 101: 1, 102: 1, 103: 1, 104: 0}
