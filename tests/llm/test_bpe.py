import random

import public_tokenizers as public
import pytest
import tiktoken
from helpers import no_docs, odd_docs, odd_rows

from orderlens.llm import bpe

PATH = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe._ranks(PATH),
                             special_tokens={})


def numbers(ids):
    return list(memoryview(ids).cast("I")) if ids else []


def test_random_texts_as_the_library(library):
    rnd = random.Random(5)
    signs = list("ab  \n\t'’sdtrevl0१ÀßŁ日本語\x1c\x85　éÉ🙂‍!?.,<|>%-_\0")
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(10_000)]
    texts += ["aaaa" * 500, " " * 1000, "\n" * 77 + "x", "'S's it'll", "ab" * 3000, ""]
    mine = bpe.Encoder(bpe._ranks(PATH), public.PATTERN).encode(texts)
    assert [numbers(i) for i in mine] == [library.encode_ordinary(t) for t in texts]


def test_forgotten_chunks_are_encoded_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "SLICE", 10)
    texts = [f"word{i % 5} other{i % 3} thing" for i in range(50)]
    mine = bpe.Encoder(bpe._ranks(PATH), public.PATTERN).encode(texts)
    assert [numbers(i) for i in mine] == [library.encode_ordinary(t) for t in texts]


def test_a_new_pair_may_come_before_the_rest_of_a_rank():
    # "bc" ranks after "abc": as soon as one "bc" stands after an "a", that pair goes first.
    singles = {bytes([i]): i for i in range(256)}
    ranks = {**singles, b"abc": 256, b"bc": 257, b"abcbc": 258, b"cb": 259}
    encoder = bpe.Encoder(ranks, r"[\s\S]+")
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcbc", "bcabcbcabc", "aabcbcbc", "cbcbcb"):
        assert encoder.replay([text.encode()])[0] == own.encode_ordinary(text)


def test_odd_documents_and_back(spark, library):
    found = bpe.decode(bpe.encode(odd_docs(spark), PATH, public.PATTERN), PATH).collect()
    want = sorted((r[1] or "").encode() for r in odd_rows())
    assert sorted(bytes(r["decoded"]) for r in found) == want
    for r in found:
        text = bytes(r["decoded"]).decode()
        assert r["n_tokens"] == len(numbers(r["ids"]))
        if len(text) < 100_000:
            assert numbers(r["ids"]) == library.encode_ordinary(text)
    assert bpe.encode(no_docs(spark), PATH, public.PATTERN).collect() == []
