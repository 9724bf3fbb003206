import random

from pyspark.sql import functions as F

from tests.llm import brute
from trolley.llm import lsh_forest, suffix_dedup, syncmers
from trolley.llm.graph import components


def repeated_rows():
    random.seed(3)
    text = lambda n: "".join(random.choices("abcdefgh ij\né", k=n))
    shared = [text(random.randrange(150, 420)) for _ in range(6)]
    pick = lambda: random.choice(shared) if random.random() < 0.5 else text(random.randrange(300))
    rows = [(i, "".join(pick() for _ in range(random.randrange(8)))) for i in range(120)]
    rows += [(200, "a" * 1000), (201, "ab" * 400), (202, None), (203, ""), (204, "a" * 199), (204, "x" + "a" * 200)]
    return rows + [(None, rows[3][1]), (205, rows[4][1]), (205, rows[4][1])]


def clashing(spark, rows, *names):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("?") for c in names})


def test_repeats_equal_brute_force(spark):
    rows = repeated_rows()
    out = suffix_dedup.removal_digest(clashing(spark, rows, "key", "at", "a", "b", "body", "kept0", "row_id"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute.removed(rows), key=str)
    assert suffix_dedup.removal_digest(clashing(spark, [])).count() == 0


def test_repeats_in_a_long_text(spark):
    random.seed(9)
    half = "".join(random.choices("abcdefgh", k=1_100_000))
    once = "".join(random.choices("ijkl", k=500_000))
    out = suffix_dedup.removal_digest(clashing(spark, [(1, half + once + half), (2, half[500:800])])).orderBy("doc_id").collect()
    assert [(r["n_removed"], r["n_spans"]) for r in out] == [(2_200_000, 2), (300, 1)]


def test_stage_keeps_columns_and_whole_code_points(spark):
    rows = [(i, "ü" * 150 + f"{i} only here") for i in range(3)]
    df = clashing(spark, rows, "a", "lang").withColumn("n_chars", F.lit(0).cast("bigint"))
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    assert all(r["text"] == f"{r['doc_id']} only here" and r["n_chars"] == len(r["text"]) for r in out.collect())


def test_repeats_of_texts_with_one_32_bit_hash(spark):
    """Texts that share an id, or have none, are not taken for each other where 32-bit hashes meet."""
    import hashlib

    body = lambda name: "".join(hashlib.sha256(f"{name}{k}".encode()).hexdigest() for k in range(6))
    long, short = body("p"), body("q")[:300]
    rows = [(None, long + "10210"), (None, short + "564011"), (None, long + "2307"), (-1, short + "111279")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    met = [r[0] for r in df.select(F.hash("doc_id", "text")).collect()]
    assert met[0] == met[1] and met[2] == met[3]
    for pair in (rows[:2], rows[2:]):
        given = [*pair, (7, long)]
        out = suffix_dedup.removal_digest(spark.createDataFrame(given, "doc_id long, text string")).collect()
        assert sorted(map(tuple, out), key=str) == sorted(brute.removed(given), key=str)


def near_rows():
    random.seed(5)
    base = [" ".join(random.choice("abcdefghijklmnop") * random.randrange(1, 4) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(500):
        words = random.choice(base).split(" ")
        for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
            words[random.randrange(len(words))] = str(random.randrange(1000))
        rows.append((i, "  ".join(words).title() if i % 7 == 0 else " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE\ttwo"), (2004, " \n"), (2005, "x"), (5, rows[5][1])]
    return [*rows, (3000, "w " * 300_000), (3001, "w " * 300_000 + "v")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    out = lsh_forest.near_duplicates(clashing(spark, rows, "class", "component", "copies", "block", "row_id", "i", "j"))
    assert sorted(map(tuple, out.collect())) == sorted(brute.near_groups(rows))
    assert lsh_forest.near_duplicates(clashing(spark, [])).count() == 0


def test_blocks_of_a_large_group(spark, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(lsh_forest, "BLOCK", 32)
    out = lsh_forest.near_duplicates(clashing(spark, rows))
    assert sorted(map(tuple, out.collect())) == sorted(brute.near_groups(rows))


def test_null_ids_are_rows(spark):
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (None, None)]
    out = sorted(map(tuple, lsh_forest.near_duplicates(clashing(spark, rows)).collect()), key=str)
    assert out == sorted([(None, None, None, 2, 1), (4, None, None, 2, 1), (None, None, None, 1, 0)], key=str)


def pair_of(seed):
    """Two texts of 18 shingles with a similarity of exactly 0.8."""
    words = [f"{seed}w{i}" for i in range(22)]
    return " ".join(words), " ".join([*words[:-2], "x", words[-1]])


def test_pairs_far_below_their_estimate_are_linked(spark):
    """The signatures of these pairs are equal in 81 to 86 of 128 places."""
    rows = [(2 * i + k, text) for i, seed in enumerate((1075, 4422, 4539, 4795)) for k, text in enumerate(pair_of(seed))]
    out = lsh_forest.near_duplicates(clashing(spark, rows)).collect()
    assert sorted(map(tuple, out)) == sorted(brute.near_groups(rows)) and all(r["n_links"] == 1 for r in out)


def test_a_class_meets_one_text_of_a_shared_id(spark, monkeypatch, tmp_path):
    rows = [(None, text) for seed in range(20) for text in pair_of(seed)]
    whole, seen = lsh_forest._shingle_sets, str(tmp_path / "seen")

    def counted(batches):
        for batch in batches:
            with open(seen, "a") as f:
                f.write(f"{batch.num_rows}\n")
            yield from whole([batch])

    monkeypatch.setattr(lsh_forest, "_shingle_sets", counted)
    out = lsh_forest.near_duplicates(clashing(spark, rows)).collect()
    assert len(out) == 40 and all(r["n_links"] == 1 for r in out)
    with open(seen) as f:
        assert sum(map(int, f)) == 40


def test_one_of_each_group_stays(spark):
    rows = near_rows()
    df = clashing(spark, rows, "class", "_copy")
    kept = lsh_forest.keep_one(df)
    assert kept.columns == df.columns
    want = sorted({g for _, g, *_ in brute.near_groups(rows)})
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert lsh_forest.keep_one(df.limit(0)).count() == 0


def test_prefixes_are_shortened_to_the_recall():
    k = lsh_forest.prefix_length()
    reach = lambda n: 1 - (1 - lsh_forest.THRESHOLD**n) ** lsh_forest.TREES
    assert reach(k) >= lsh_forest.RECALL > reach(k + 1)
    assert lsh_forest.prefix_length(recall=0.0) == lsh_forest.DEPTH


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 500)]
    out = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {out[i] for i in range(41)} == {0} and {out[100 + i] for i in range(60)} == {100} and out[500] == 500
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


SYNC = [
    (1, "The quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "abc"), (5, "  \n "), (6, "漢字仮名交じり文 のテスト です"),
    (7, "repeat " * 50_000), (8, "The quick brown fox jumps over the lazy cat"), (8, "The quick brown fox jumps over the lazy cat"),
    (None, "null first"), (-5, "negative"), (1 << 40, "far away 😀😀😀😀"), (600, "another range of ids"),
]


def test_edited_texts_and_neighbours(spark):
    import hashlib

    out = syncmers.edited_likeness(clashing(spark, SYNC, "range", "place", "whole", "first", "number")).collect()
    order = sorted(SYNC, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([tuple(r)[:3] for r in out], key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == "" and by_id[2]["near_next"] == 1
    assert by_id[3]["near_next"] == 0 and by_id[8]["near_next"] in (0, 1)
    for r in out:  # likeness is that of the fingerprints
        a, b = (set(r[c].split()) for c in ("fingerprint", "edited_fingerprint"))
        assert r["near_edited"] == (len(a & b) / len(a | b) if a | b else 1)
    prints = {r["doc_id"]: r["fingerprint"] for r in syncmers.fingerprints(clashing(spark, SYNC, "_text")).collect()}
    assert all(prints[r["doc_id"]] == r["fingerprint"] for r in out)
    assert syncmers.edited_likeness(clashing(spark, [])).count() == 0


def test_likeness_counts_all_anchors(spark):
    random.seed(11)
    words = lambda n: " ".join("".join(random.choices("abcdefghij", k=3)) for _ in range(n))
    shared = words(60)
    rows = [(1, words(3000) + " " + shared), (2, shared + " " + words(2500)), (3, words(2000))]
    found = syncmers.anchors(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    own = {d: {r["hash"] for r in found if r["doc_id"] == d} for d in (1, 2, 3)}
    out = {r["doc_id"]: r for r in syncmers.edited_likeness(clashing(spark, rows)).collect()}
    for d, after in ((1, 2), (2, 3), (3, 1)):
        want = len(own[d] & own[after]) / len(own[d] | own[after])
        assert abs(out[d]["near_next"] - want) < 1e-12
        assert out[d]["fingerprint"] == " ".join(map(str, sorted(own[d])))
        assert out[d]["sketch"] == "".join(f"{h & 0xFFFFFFFF:08x}" for h in sorted(own[d])[:64])
    assert 0 < out[1]["near_next"] < 1 / 64


def test_anchors_are_closed_syncmers(spark):
    """An anchor depends on its own pieces alone, and its smallest inner hash is at an edge."""
    import re

    text = "Erinst resh. The oredat the anntly reat inea thouou of whst by thethreea and for nterti " * 3
    pieces = re.findall(r"\S{1,3}", text)
    df = spark.createDataFrame([(p, q) for p, q in zip(pieces, pieces[1:], strict=False)], "p string, q string")
    inner = [r[0] for r in df.select(F.xxhash64("p", "q")).collect()]
    want = [i + 1 for i in range(len(pieces) - syncmers.K + 1) if min(w := inner[i : i + syncmers.SPAN]) in (w[0], w[-1])]
    found = syncmers.anchors(spark.createDataFrame([(1, text), (2, "x y z " + text)], "doc_id int, text string")).collect()
    assert sorted(r["pos"] for r in found if r["doc_id"] == 1) == want
    shifted = {(r["pos"] - 3, r["hash"]) for r in found if r["doc_id"] == 2}
    assert {(r["pos"], r["hash"]) for r in found if r["doc_id"] == 1} <= shifted
