"""A group's words come as sorted rows in batches that may end anywhere, not as one list."""

import itertools
import random

import pyarrow as pa
import pytest

from strata.llm import spelling

KINDS = {"key": pa.string(), "word": pa.string(), "n": pa.int64()}


def grouped(rows, size):
    batches = [pa.RecordBatch.from_pylist([dict(zip(KINDS, r)) for r in rows[i:i + size]],
                                          pa.schema(KINDS.items()))
               for i in range(0, len(rows), size)]
    batches[1:1] = [b.slice(0, 0) for b in batches[:1]]
    return sorted(tuple(r.values()) for b in spelling._run_groups(iter(batches)) for r in b.to_pylist())


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_groups_that_span_batches_are_whole(size):
    rng, rows = random.Random(5), []
    for i in range(60):
        some = {"".join(rng.choice("ab") for _ in range(3)) for _ in range(rng.choice([1, 1, 2, 5, 9]))}
        rows += [(f"5 0 3 {i:02d}", f"{w}{i:02d}", rng.choice([1, 5])) for w in some]
    want = []
    for _, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = list(group)
        want += spelling._run_group(5, 0, 3, [r[1] for r in group], [r[2] for r in group])
    assert want and grouped(rows, size) == sorted(want)


def test_no_rows_give_no_pairs():
    assert grouped([], 1) == []
