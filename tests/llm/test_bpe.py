import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from sparkmart.llm import bpe

PATHS = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def library(name):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path(name)), special_tokens={})


@pytest.mark.parametrize("name", PATHS)
def test_ids_are_the_librarys(name):
    codec, lib, r = bpe.BacktrackingBPE(bpe.load_ranks(P.path(name)), P.PATTERN, memo=500), library(name), random.Random(5)
    tokens = list(codec.ranks)
    texts = ["", " ", "a", "\n\n  \t x", "é" * 300, "ab" * 4_000, "<|endoftext|>", "日本語 😀 naïve"]
    for _ in range(3_000):
        texts.append(b"".join(r.choices(tokens, k=r.randint(1, 8))).decode("utf-8", "ignore"))
        texts.append("".join(r.choices("abcdet ,.'s1\n", k=r.randint(0, 30))))
        texts.append("".join(chr(r.choice([r.randint(0, 0x2fff), r.randint(0x1f300, 0x1f600)])) for _ in range(9)))
    for t in texts:
        ids = codec.encode(t)
        assert ids == lib.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_long_piece_takes_linear_time():
    codec = bpe.BacktrackingBPE(bpe.load_ranks(P.path(PATHS[0])), P.PATTERN)
    t = "abcdefgh" * 40_000
    assert codec.encode(t) == library(PATHS[0]).encode_ordinary(t)


def test_unreachable_tokens_serve_whole_pieces_only():
    # "abc" has a rank, but no merge of two tokens makes it
    ranks = {b: i for i, b in enumerate([b"a", b"b", b"c", b"abc"])}
    codec = bpe.BacktrackingBPE(ranks, r"\w+")
    lib = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for t in ("abc", "abcabc", "cab", "aabc"):
        assert codec.encode(t) == lib.encode_ordinary(t)


def test_documents(docs):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "x " * 30_000), (4, "x " * 30_000), (None, "é")]
    lib, path = library(PATHS[0]), P.path(PATHS[0])
    for with_ids in (False, True):
        got = bpe.digests(docs(rows), path, P.PATTERN, with_ids=with_ids).collect()
        assert len(got) == len(rows)
        for r, (i, t) in zip(sorted(got, key=lambda r: str((r.doc_id, r.n_tokens))),
                             sorted(rows, key=lambda x: str((x[0], len(lib.encode_ordinary(x[1] or "")))))):
            ids = lib.encode_ordinary(t or "")
            assert (r.doc_id, r.n_tokens) == (i, len(ids))
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
            assert not with_ids or r.ids == ids
    back = bpe.decode_documents(bpe.encode_documents(docs(rows), path, P.PATTERN), path, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.digests(docs([]), path, P.PATTERN).collect() == []
