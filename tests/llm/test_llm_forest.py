"""Pairs joined within a task."""

import random

import pyarrow as pa
import pytest

from footfall.llm import components


def classes(pairs):
    head = {i: i for p in pairs for i in p}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in pairs:
        head[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in head}


def batches(pairs, size):
    for k in range(0, len(pairs), size):
        a, b = zip(*pairs[k : k + size])
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
@pytest.mark.parametrize("kind", ["chain", "random", "star", "repeated"])
def test_stars_join_what_the_pairs_join(monkeypatch, held, kind):
    monkeypatch.setattr(components, "HELD", held)
    rng = random.Random(4)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(120)]
    pairs = {
        "chain": list(zip(ids, ids[1:])),
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(70)],
        "star": [(ids[0], i) for i in ids],
        "repeated": [(ids[3], ids[5]), (ids[5], ids[3])] * 6 + [(ids[9], ids[9])],
    }[kind]
    made = [(r["a"], r["b"]) for b in components.forest(batches(pairs, 5)) for r in b.to_pylist()]
    assert classes(made) == classes(pairs)
    if held > len(pairs):
        assert {b: a for a, b in made} == classes(pairs)


def test_no_pairs_give_no_rows():
    assert list(components.forest(iter(()))) == []
