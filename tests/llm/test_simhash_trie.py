import random
import re

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from trolley.llm import simhash_trie

# Workers get the functions with the sizes that a test sets.
cloudpickle.register_pickle_by_value(simhash_trie)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(rows, prints):
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
        out.append((doc, f"{prints[k]:016x}", min(ids, default=None)))
    return out


def found_of(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found_of(simhash_trie.near_duplicates(df)) == sorted(grouped(rows, [fingerprint(t) for _, t in rows]), key=str)


def test_odd_texts_copies_and_clashing_names(spark, monkeypatch):
    random.seed(2)
    monkeypatch.setattr(simhash_trie, "PIECE", 300)
    words = [f"w{k}É" for k in range(400)]
    long = " ".join(random.choices(words, k=4000))
    texts = [None, "", " \n\t", "A", "a", "One TWO", "one  two", "one two", "x" * 5000, long, long.upper().replace("É", "É"), long + " end", "\x0b\x0cone two three four"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, "Same text in many rows here") for k in range(50)]
    rows += [(None, "Same text in many rows here"), (None, "alone"), (None, "alone"), (3, "A")]
    for k in range(60):
        changed = long.split()
        changed[random.randrange(4000)] = "new"
        rows.append((200 + k, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("?") for c in ("print", "first", "component", "node", "leaf", "prefix", "fingerprint")})
    want = grouped(rows, [fingerprint(t) for _, t in rows])
    assert len({w[2] for w in want}) < len(want) - 60
    assert found_of(simhash_trie.near_duplicates(df.repartition(7))) == sorted(want, key=str)
    assert simhash_trie.near_duplicates(df.limit(0)).count() == 0


def test_pairs_of_the_trie(monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    flips = np.array([[(1 << int(x)) ^ (1 << int(y)) for x, y in rng.integers(0, 64, (30, 2))] for _ in base], np.uint64)
    points = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel()]))
    monkeypatch.setattr(simhash_trie, "FRONTIER", 1000)
    near = {(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2).tolist()}
    i, j = simhash_trie.near_pairs(points, points, True)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted((a, b) for a, b in near if a < b)
    half = len(points) // 2
    i, j = simhash_trie.near_pairs(points[:half], points[half:], False)
    assert sorted(zip(i.tolist(), (j + half).tolist(), strict=True)) == sorted((a, b) for a, b in near if a < half <= b)


def test_links_of_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(simhash_trie, "LEAF", 8)
    monkeypatch.setattr(simhash_trie, "RUN", 64)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 150, np.uint64) * np.uint64(2)
    # A crowded corner: numbers that share their first 52 bits.
    crowd = base[0] ^ rng.integers(0, 1 << 12, 300, np.uint64)
    points = np.unique(np.concatenate([base, base ^ np.uint64(1 << 63), base ^ np.uint64(1 << 30), base ^ np.uint64(7), crowd]))
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "print long")
    found = simhash_trie.links(df.repartition(6)).collect()
    place = {int(x): k for k, x in enumerate(points.view(np.int64))}

    def joined(pairs):
        label = np.arange(len(points))
        pairs = np.array(pairs)
        return simhash_trie._smallest(len(label), pairs[:, 0], pairs[:, 1]).tolist()

    near = [(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2).tolist()]
    assert joined([(place[r["a"]], place[r["b"]]) for r in found]) == joined(near)
