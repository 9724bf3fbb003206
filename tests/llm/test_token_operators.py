import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trolley.llm import bpe, token_planes

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = list("aZé中0９½ \n\t  '!.-’stmdrevĺ😀\x1c​\u0085")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


def odd_texts():
    random.seed(1)
    texts = ["".join(random.choices(SIGNS, k=random.randrange(60))) for _ in range(1500)]
    return texts + ["'" * 70 + "s", "=" * 3000, "a" * 500, " " * 200 + "x", "it's we'll I'd 're''s  's\n's", "", "héllo wörld " * 4000]


def test_encoder_equals_the_library(library):
    texts = odd_texts()
    encode, decode = bpe.Encoder(MULTI), bpe.Decoder(MULTI)
    for text, (ids, offsets) in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert decode(ids, offsets) == text.encode()


def test_wrong_offsets_are_refused():
    ids, offsets = next(iter(bpe.Encoder(MULTI)(["one two three " * 100])))
    with pytest.raises(ValueError):
        bpe.Decoder(MULTI)(ids[4:], offsets)


def test_transition_functions_compose():
    scanner = bpe.Scanner()
    random.seed(2)
    for n in (1, 63, 64, 65, 5000):
        symbols = [random.randrange(8) for _ in range(n)]
        state, states = bpe.START, []
        for s in symbols:
            state, _ = bpe._step(state, s)
            states.append(state)
        assert scanner.states(scanner.symbol_function[symbols]).tolist() == states


ROWS = [(3, None), (1, ""), (2, "It's a test.\n"), (2, "It's a test.\n"), (None, "x" * 70000 + " y"), (7, " a  b " * 70000)]


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("?") for c in ("key", "ids", "offsets", "decoded", "shard", "start", "score")})


def test_round_trip_of_odd_rows(spark, library):
    out = bpe.round_trip_digest(clashing(spark, ROWS), MULTI).collect()
    want = []
    for doc, text in ROWS:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert bpe.round_trip_digest(clashing(spark, []), MULTI).count() == 0
    apart = bpe.decode(bpe.encode(clashing(spark, ROWS), MULTI), MULTI).select("doc_id", "ids", "decoded")
    together = bpe.round_trip(clashing(spark, ROWS), MULTI).select("doc_id", "ids", "decoded")
    assert sorted(map(str, apart.collect())) == sorted(map(str, together.collect()))


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1001, np.uint32)
    payload, ends = token_planes.shuffle_planes(ids, bits, 3)
    assert len(ends) == (32 if bits else 4)
    assert np.array_equal(token_planes.unshuffle_planes(payload, ends, len(ids)), ids)


def test_stored_ids_of_odd_rows(spark):
    library = Tokenizer.from_file(JSON)
    out = token_planes.stored_digest(clashing(spark, ROWS).repartition(3), JSON).orderBy("start").collect()
    start = 0
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for (doc, text), row in zip(order, out, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_planes.stored_digest(clashing(spark, []), JSON).count() == 0


def test_bit_planes_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(i, f"word {i} " * i) for i in range(50)], "doc_id long, text string")
    for bits in (False, True):
        token_planes.write_ids(df, f"{tmp_path}/{bits}", JSON, bits=bits)
    a, b = (sorted(map(tuple, token_planes.read_ids(spark, f"{tmp_path}/{x}").collect())) for x in (False, True))
    assert a == b and len(a) == 50


def test_word_encoder_equals_whole_texts():
    library = Tokenizer.from_file(JSON)
    texts = [*odd_texts(), "a <|endoftext|> b", "trailing ", " lead", "two  spaces  here"]
    for text, ids in zip(texts, token_planes.WordEncoder(JSON)(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_new_words_are_encoded_many_at_once():
    library, encoder = Tokenizer.from_file(JSON), token_planes.WordEncoder(JSON)
    random.seed(3)
    letters = "aeinrst,.é’中9\n"
    words = ["".join(random.choices(letters, k=random.randrange(1, 9))) for _ in range(2 * token_planes.JOINED)]
    for _ in range(3):
        texts = [" ".join(random.choices(words, k=400)) for _ in range(4)]
        for text, ids in zip(texts, encoder(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder._word_ids([]) == {}


def test_documents_over_several_blocks_and_ends_on_a_block(spark, tmp_path):
    # " a" is one id, so with the end id the first document fills a block exactly.
    rows = [(1, " a" * (token_planes.BLOCK - 1)), (2, " a" * (3 * token_planes.BLOCK)), (3, "")]
    path = f"{tmp_path}/blocks"
    token_planes.write_ids(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, JSON)
    found = token_planes.read_ids(spark, path).orderBy("start").collect()
    lengths = [len(r.ids) // 4 for r in found]
    assert [r.doc_id for r in found] == [1, 2, 3]
    assert lengths == [token_planes.BLOCK, 3 * token_planes.BLOCK + 1, 1]
    assert [r.start for r in found] == [0, lengths[0], lengths[0] + lengths[1]]
    assert all(np.frombuffer(r.ids, "<u4")[-1] == token_planes.END_ID for r in found)
