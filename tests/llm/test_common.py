import weakref

import pyarrow as pa

from slumptrace.llm import common


class Known(dict):
    pass


def batches():
    yield pa.RecordBatch.from_pydict({"x": list(range(10))})
    yield pa.RecordBatch.from_pydict({"x": [10]})


def test_memory_goes_back_after_all_that_a_task_held(monkeypatch):
    alive, known = [], []

    @common.tidy
    def run(batches):
        mine = Known()
        known.append(weakref.ref(mine))
        for batch in common.lean(batches, 4):
            mine[len(mine)] = batch
            yield batch

    monkeypatch.setattr(common, "give_back", lambda: alive.append(known[0]() is not None))
    assert [x for batch in run(batches()) for x in batch.column("x").to_pylist()] == list(range(11))
    assert alive[0] and not alive[-1]
    # A task that is ended early gives it back as well.
    known.clear()
    task = run(batches())
    assert next(task).num_rows == 4
    task.close()
    assert not alive[-1]


def test_slices_hold_few_characters():
    texts = ["a" * 100_000, None, "b" * 100_000, "c" * 100_000, "", "d" * 900_000, "e"]
    cut = list(common.in_slices(texts))
    assert cut == [(0, 4), (4, 6), (6, 7)]
