import random

import pyarrow as pa

from slumptrace.llm.common import components, lean


def brute(edges):
    groups = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        joined = groups.get(a, {a}) | groups.get(b, {b})
        for x in joined:
            groups[x] = joined
    return {x: min(g) for x, g in groups.items()}


def test_random_graphs_chains_and_stars(spark, staging):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(1_000 + k, 1_001 + k) for k in range(200)] + [(2_000, 2_001 + k) for k in range(200)] + [(2_500 - k, 3_000) for k in range(200)]
    edges += [(-5, 7), (7, -5), (9, 9), (None, 3), (4, None)]
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r.node: r.component for r in components(df, staging).collect()} == brute(edges)
    assert components(df.limit(0), staging).count() == 0


def test_lean_batches_are_the_same_rows_in_smaller_ones():
    whole = [pa.RecordBatch.from_pydict({"a": list(range(n))}) for n in (5_000, 0, 3)]
    parts = list(lean(iter(whole)))
    assert max(p.num_rows for p in parts) <= 2_048
    assert [x for p in parts for x in p.column("a").to_pylist()] == [*range(5_000), *range(3)]
