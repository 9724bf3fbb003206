import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from trolley.llm import bpe, mixing, ordinal_quality

DATA = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on what the stage before it kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = docs.orderBy("doc_id").collect()
        out = stage(spark, docs, DATA)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = docs.orderBy("doc_id").collect()
        ids, kept = [r["doc_id"] for r in rows], [r["doc_id"] for r in after]
        if number == 0:
            labels = spark.read.parquet(f"{DATA}/labels.parquet")
            rated = ordinal_quality.rate(spark.createDataFrame(rows, out.schema), labels).where("keep")
            assert kept == sorted(r["doc_id"] for r in rated.collect())
        elif number == 1:
            groups = brute.near_groups([(r["doc_id"], r["text"]) for r in rows])
            assert kept == sorted({g[1] for g in groups})
        elif number == 2:
            want = brute.removed([(r["doc_id"], r["text"]) for r in rows])
            assert kept == ids and all(r["n_chars"] == len(r["text"]) for r in after)
            assert [len(r["text"].encode()) for r in after] == [w[1] - w[2] for w in want]
        elif number == 3:
            mix = mixing.mixed_report(spark.createDataFrame(rows, out.schema)).collect()
            assert kept == sorted(r["doc_id"] for r in mix) and set(kept) == set(ids)
        else:
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
            for old, new in zip(rows, after, strict=True):
                ids4 = np.array(library.encode_ordinary(old["text"]), "<u4").tobytes()
                assert new["n_tokens"] == len(ids4) // 4 and new["ids_sha256"] == hashlib.sha256(ids4).hexdigest()
                assert new["decoded_sha256"] == hashlib.sha256(old["text"].encode()).hexdigest()
        before = rows
    assert before


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
