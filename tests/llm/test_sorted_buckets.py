"""The comparison of sorted neighbours, on entries cut to tasks and batches at every place."""

import collections
import random

import pyarrow as pa

from trolley.llm import suffix_dedup as sd

NAMES = [f.split()[0] for f in sd.ENTRY.split(", ")]
TYPES = [pa.int64()] * 4 + [pa.int32()] * 3


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


def pieces(rows, cuts):
    ends = [0, *sorted(cuts), len(rows)]
    return [rows[a:b] for a, b in zip(ends, ends[1:], strict=False) if a < b]


def test_runs_are_settled_wherever_tasks_and_batches_end():
    chosen = random.Random(4)
    for trial in range(300):
        n = chosen.randint(1, 25)
        keys, contexts = chosen.randint(1, 6), chosen.randint(1, 4)
        rows = sorted((chosen.randrange(keys), chosen.randrange(contexts), k, k, k, 0, 0) for k in range(n))
        given = []
        for task in pieces(rows, [chosen.randrange(n) for _ in range(chosen.randint(0, 3))]):
            parts = pieces(task, [chosen.randrange(len(task)) for _ in range(chosen.randint(0, 4))])
            given += [tuple(r.values()) for b in sd._sort_out(batch(p) for p in parts) for r in b.to_pylist()]
        settled = [r[:7] for r in given if r[7] == sd.SETTLED]
        wanted = [r[:7] for r in given if r[7] == sd.OPEN]
        ends = collections.defaultdict(list)
        for r in given:
            if r[7] == sd.END:
                ends[r[:2]].append(r)
        for parts in ends.values():
            wanted.append(min(p[:7] for p in parts))
            if sum(p[8] for p in parts) > 1:
                settled += [p[:7] for p in parts if p[8] == 1]
        runs = collections.defaultdict(list)
        for r in rows:
            runs[r[:2]].append(r)
        assert sorted(settled) == sorted(r for run in runs.values() if len(run) > 1 for r in run), trial
        assert len(set(wanted)) == len(wanted)
        several = collections.Counter(k for k, _ in runs)
        needed = {run[0] for (k, _), run in runs.items() if several[k] > 1}
        assert needed <= set(wanted) <= {run[0] for run in runs.values()}
        if len(rows) == n and not len(ends) > 2:  # one task: only its edges are refined for nothing
            inner = {k for k in several if several[k] == 1 and k not in (rows[0][0], rows[-1][0])}
            assert not [r for r in wanted if r[0] in inner]
