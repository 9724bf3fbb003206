"""Words of any length beside a hit, and ties on the returned scores."""

import numpy as np

from trolley.llm import hilbert, toxicity


class Hits:
    def automaton(self):
        return None

    def hits(self, machine, folded):
        return [k for k in range(len(folded)) if folded.startswith(" bad ", k)]


def test_phrases_take_whole_words():
    found = toxicity._phrases(Hits())
    long = "x" * 250
    assert found(f" {long} bad {long} ") == {f" {long} bad ", f" bad {long} ", toxicity.ANY_HIT}
    assert found(" bad ") == set()
    assert found(" one bad  two bad ") == {" one bad ", " bad two ", " two bad ", toxicity.ANY_HIT}
    assert found(" fine ") == set()


def test_ties_at_the_last_place_are_those_of_the_scores(spark):
    """Many vectors whose products with the query are equal, or apart in the last bits."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(0, base.tolist())]
    for k in range(1, 120):
        # The same numbers in another order of signs on two equal components: equal or nearly equal sums.
        x = base.copy()
        x[k % 16], x[(k + 5) % 16] = x[k % 16] + base[(k + 5) % 16], x[(k + 5) % 16] - base[k % 16]
        rows.append((k, x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hilbert.every_twentieth(df).collect()
    vectors = np.array([r[1] for r in rows])
    for query in range(0, 120, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        scores = np.einsum("ij,j->i", vectors, vectors[query])
        order = sorted((k for k in range(120) if k != query), key=lambda k: (-scores[k], k))[:20]
        assert [v for _, v, _ in own] == order
        assert all(abs(scores[v] - s) <= 1e-15 * 64 for _, v, s in own)
