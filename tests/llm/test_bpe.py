import base64
import random

import pytest

tiktoken = pytest.importorskip("tiktoken")

from lodestone.llm.bpe import PATTERN, VOCABULARY, encode_corpus, encoder  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_by_the_merges(reference):
    r, enc = random.Random(3), encoder(VOCABULARY)
    for alphabet in ("aeioustrn ing", "<|endoftext|> x", "0123456789.,- \n\t", "éüñ漢字🙂​ß"):
        for _ in range(2000):
            s = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
            assert enc.encode(s) == reference.encode_ordinary(s), s


def test_long_pieces_are_linear(reference):
    enc = encoder(VOCABULARY)
    for s in ("ab" * 3000, "the" * 2000, "x" * 5000, " " * 4000 + "y"):
        assert enc.encode(s) == reference.encode_ordinary(s)
    assert b"".join(reference.decode_single_token_bytes(i) for i in enc.encode("a" * 1_000_000)) == b"a" * 1_000_000


def test_frame(spark, reference):
    data = [(1, "Hello <|endoftext|>"), (1, "Hello <|endoftext|>"), (2, None), (3, ""), (None, " ")]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "1 AS ids")
    got = [tuple(r) for r in encode_corpus(df).collect()]
    assert sorted(got, key=repr) == sorted([(k, reference.encode_ordinary(t) if t else []) for k, t in data], key=repr)
    assert encode_corpus(df.limit(0)).count() == 0
