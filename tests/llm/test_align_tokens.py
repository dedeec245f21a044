"""Token alignment against a version that compares all offsets of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import align_tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    """doc rows -> the expected rows, by offsets in dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    a_tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    byte_of = align_tokens._byte_of()
    assert decoders.ByteLevel().decode(["".join(c for c, b in byte_of.items() if b < 128)]).encode() == \
        bytes(b for c, b in byte_of.items() if b < 128)

    def a_bytes(i):
        return bytes(byte_of[c] for c in a_tok.id_to_token(i))

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def ends(ids, size):
        at, out = 0, {}
        for k, i in enumerate(ids):
            at += len(size(i))
            out[at] = k
        return out

    def run(rows):
        found, total = [], Counter()
        for doc_id, text in rows:
            raw = b" " + (text or "").encode()
            a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids
            b = sp.encode(text or "")
            if not text or b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
                found.append((doc_id, [], [], [], []))
                continue
            ea, eb = ends(a, a_bytes), ends(b, b_bytes)
            both = sorted(ea.keys() & eb.keys())
            links = [(a[ea[e]], b[eb[e]]) for e in both]
            total.update(links)
            groups, i, j = [], 0, 0
            for e in both:
                groups.append((a[i:ea[e] + 1], b[j:eb[e] + 1]))
                i, j = ea[e] + 1, eb[e] + 1
            found.append((doc_id, a, b, groups, links))
        best = Counter()
        for (_, b), n in total.items():
            best[b] = max(best[b], n)
        out = []
        for doc_id, a, b, groups, links in found:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((doc_id, len(a), len(b), len(groups), len(links),
                        sum(total[x] == best[x[1]] for x in links), sum(total[x] for x in links),
                        hashlib.sha256(text.encode()).hexdigest() if links else ""))
        return out
    return run


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def _check(docs, plain, rows, parts=2):
    got = align_tokens.cross_align(docs(rows).repartition(parts), A, B, PATTERN)
    assert got.columns == COLUMNS
    assert _rows(got) == sorted(plain(rows), key=repr)


def test_table_against_offsets(docs, plain):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    _check(docs, plain, list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist())))


def test_odd_texts(docs, plain):
    odd = [None, "", " ", "  two  blanks ", "\n\nline\r\n", "<|endoftext|> x <s></s><unk>", "<0x41> <0x0A>",
           "a▁b", "▁", "café café", "日本語 のテキスト",
           "\U0001f468‍\U0001f469‍\U0001f467 ok", "﻿bom", "x\x00y", "　wide", "tab\tx\x0b",
           "don't we'll I'd", "1234567 3.14", " nbsp", "z" * 5000, "word " * 3000, "ไทย"]
    rng = random.Random(3)
    letters = [" ", " ", "a", "the", "ü", "中", "\n", "'s", ".", "\U0001f600", "9", "▁"]
    odd += ["".join(rng.choices(letters[:-1], k=rng.randint(1, 40))) for _ in range(80)]
    _check(docs, plain, list(enumerate(odd)), parts=3)


def test_repeated_rows_null_ids_and_ties(docs, plain):
    rows = [(1, "the cat"), (1, "the cat"), (None, "the cat"), (2, "a dog"), (None, None), (3, "unseenword")]
    _check(docs, plain, rows, parts=4)


def test_sizes_cover_the_tokens(docs):
    packed = align_tokens.align(docs([(1, "An unforgettable  café\n"), (2, None)]), A, B, PATTERN)
    r, empty = align_tokens.unpacked(packed).orderBy("doc_id").collect()
    assert empty.a_ids == empty.b_sizes == [] and empty.groups_sha256 == ""
    assert sum(r.a_sizes) == len(r.a_ids) == r.n_a and sum(r.b_sizes) == len(r.b_ids) == r.n_b
    assert len(r.a_sizes) == len(r.b_sizes) == r.n_groups


def test_small_memo_and_windows(docs, plain):
    """The groups don't depend on what is remembered or where anchors lie."""
    aligner = align_tokens.Aligner(align_tokens.Vocabulary(A, B, PATTERN), memo=2)
    texts = ["one two three one two three", "antidisestablishmentarianism", "x" * 200]
    got = [(len(a) // 2, len(b) // 2, len(s) // 4, d) for a, b, s, _, d in aligner.documents(texts)]
    assert got == [(r[1], r[2], r[3], r[7]) for r in plain(list(enumerate(texts)))]
    assert len(aligner.memo) <= 2
    assert [x[4] for x in aligner.documents(texts)] == [x[3] for x in got]


def test_windows_that_share_a_hash_stay_apart(monkeypatch, plain):
    monkeypatch.setattr(align_tokens, "_ODD", np.zeros(1, np.uint64))
    aligner = align_tokens.Aligner(align_tokens.Vocabulary(A, B, PATTERN))
    texts = ["some quite unforgettable words", "some other words"]
    assert [x[4] for x in aligner.documents(texts)] == [r[7] for r in plain(list(enumerate(texts)))]


def test_empty_table_and_clashing_columns(spark, docs, plain):
    assert align_tokens.cross_align(docs([]), A, B, PATTERN).collect() == []
    clash = spark.createDataFrame([(5, "a b c", 1, "f", 2)],
                                  "doc_id long, text string, n_a int, groups_sha256 string, pair int")
    assert _rows(align_tokens.cross_align(clash, A, B, PATTERN)) == plain([(5, "a b c")])


def test_too_many_pairs_are_refused(spark, docs):
    aligned = align_tokens.align(docs([(1, "two words")]), A, B, PATTERN)
    with pytest.raises(ValueError):
        align_tokens.scored(aligned, spark.range(5).select(F.col("id").alias("pair"), F.lit(1).alias("n")), 3)


def test_every_character_has_the_ids_of_the_tokenizers_library():
    """The vocabulary read as ranks splits and merges as the library does."""
    from tokenizers import Tokenizer
    library, v = Tokenizer.from_file(A), align_tokens.Vocabulary(A, B, PATTERN)
    library.encode_special_tokens = True
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        texts = [f" a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} {chr(c)} .{chr(c)}," for c in points[at:at + 20_000]]
        for t, x in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
            assert v.a.encode_to_numpy(t).tolist() == x.ids, t
