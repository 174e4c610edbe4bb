import random
import struct

import pytest
from llm_fixtures import clashing, make  # noqa: F401

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")

from cohortlab.llm import byte_bpe as B  # noqa: E402

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return B.Codec(B.read_ranks(f.read()), public.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    plain = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})

    def packed(text):
        ids = plain.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    return packed


LONG = ["a" * 5000, "ab" * 4000, "é" * 3000, " " * 5000 + "x", "\n" * 3000, "'ll" * 2000, "中文字" * 2000, "x1" * 9000, "a" * 1023 + "'" + "ll " * 400]


@pytest.mark.parametrize("text", ["", " ", "'", "'ll", "<|endoftext|>", " \x85  x", "\U0001f469‍\U0001f469", *LONG])
def test_encode_and_decode_special_texts(codec, reference, text):
    ids = codec.encode(text)
    assert ids == reference(text) and codec.decode(ids) == text.encode()


def test_every_code_point_between_letters_digits_and_blanks(codec, reference):
    for cp in range(0x110000):
        if not 0xD800 <= cp < 0xE000:
            c = chr(cp)
            text = f"a{c}a1{c}1 {c}  {c}{c}a"
            assert codec.encode(text) == reference(text), hex(cp)


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_joins_at_every_place(codec, reference, monkeypatch, leaf):
    """With leaves of a few characters every border falls somewhere: inside
    words, contractions, runs of blanks and characters of several bytes."""
    monkeypatch.setattr(B, "LEAF_CHARS", leaf)
    monkeypatch.setattr(B, "LEAF_TOKENS", leaf)
    rnd = random.Random(leaf)
    for _ in range(1500):
        text = "".join(rnd.choice("aéb'ltsverdm\n  \t1中.!") for _ in range(rnd.randrange(70)))
        ids = codec.encode(text)
        assert ids == reference(text) and codec.decode(ids) == text.encode(), repr(text)


def test_join_is_the_encoding_of_both(codec):
    """The window rule against merging all bytes at once."""
    rnd = random.Random(7)
    for _ in range(2000):
        a, b = (bytes(rnd.choice(b"aaabtheing ") for _ in range(rnd.randrange(1, 40))) for _ in "ab")
        assert codec.joined(codec._merged_long(a), codec._merged_long(b)) == codec._merged_long(a + b) == codec._merged_short(a + b)


def test_a_full_memo_starts_anew(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "MEMO", 10)
    text = " ".join(f"word{i} wörd{i}" for i in range(300))
    assert codec.encode(text) == reference(text)


def test_documents(make, reference):
    rows = [(1, "Hello world's ½ Straße"), (2, None), (3, ""), (4, "x " * 40000), (None, "x " * 40000), (5, "<|endoftext|>")]
    docs = clashing(make(rows), "ids", "n_tokens", "decoded", "_in0")
    coded = B.encode_documents(docs, PATH, public.PATTERN)
    back = B.decode_documents(coded, PATH, public.PATTERN)
    assert [c for c in back.columns if c not in ("ids", "n_tokens", "decoded")] == [c for c in docs.columns if c not in ("ids", "n_tokens", "decoded")]
    got = {(r.doc_id, r.text): (r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in back.collect()}
    for key, text in rows:
        ids = reference(text or "")
        assert got[key, text] == (len(ids) // 4, ids, (text or "").encode())
    assert B.encode_documents(make([]), PATH, public.PATTERN).count() == 0


def test_query_against_brute_force(spark, reference):
    import hashlib

    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in E.queries()["op13_byte_bpe"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        ids = reference(r.text or "")
        want[r.doc_id] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert got == want
