import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmart.llm import rans as R

PATH = public_tokenizers.path("word_bpe_49k.json")


def coder(x):
    ids, n = np.unique(x, return_counts=True)
    return R.Coder(ids.astype(np.int64), R.frequencies(ids.astype(np.int64), n.astype(float)))


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, (1 << 18) - 1, (1 << 18) + 1, 600_001])
def test_round_trip_and_parallel_parts(n):
    x = (np.random.default_rng(n).zipf(1.3, n) % 40_000).astype("<u4")
    c = coder(x)
    words, kept = c.encode(x)
    assert (c.decode(n, words, kept) == x).all()
    parts = [c.decode_part(n, words, kept, k) for k in range(-(-n // R.CHECKPOINT))]
    assert (np.concatenate([np.zeros(0, "<u4"), *parts]) == x).all()


def test_size_is_near_the_entropy():
    x = (np.random.default_rng(1).zipf(1.3, 1 << 20) % 40_000).astype("<u4")
    words, kept = coder(x).encode(x)
    p = np.unique(x, return_counts=True)[1] / len(x)
    bits = 8 * (len(words) + len(kept)) / len(x)
    assert bits < -(p * np.log2(p)).sum() + 0.4


def test_frequencies_fill_the_scale():
    for counts in ([1], [1, 10**12], list(range(1, 50_000)), [1] * 49_000 + [10**9]):
        f = R.frequencies(np.arange(len(counts)), np.array(counts, float))
        assert f.sum() == 1 << R.SCALE_LOG2 and f.min() >= 1
    assert len(R.frequencies(np.zeros(0), np.zeros(0))) == 0


def test_ids_are_the_librarys():
    lib, own, r = Tokenizer.from_file(PATH), R._Ids(PATH), random.Random(2)
    some = ["a", "B", " ", "\n", "\t", "é", "é", "́", "İ", "Σ", "'s", "'", "1", "２", "!", "—", " ",
            "\x1c", "日本", "😀", "\r\n", "<|endoftext|>", "  ", "ﬁ", "Ö", "'LL", "word"]
    texts = ["".join(r.choices(some, k=r.randint(0, 12))) for _ in range(5_000)]
    for batch in (texts[:4_000], texts[4_000:]):
        for t, ids in zip(batch, own.encode(batch)):
            assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def expected(rows):
    lib, at, out = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        at += len(ids)
    return out


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_dataset(spark, docs, tmp_path, monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rows = [(i * 7 % 50, f"text number {i} is here") for i in range(50)]
    rows += [(60, None), (61, ""), (62, "long word " * 20_000), (63, "same"), (63, "same"), (None, "null")]
    path = str(tmp_path / "ids")
    R.write(R.encode_documents(docs(rows), PATH, 2), path)
    got = sorted((tuple(r) for r in R.read(spark, path).collect()), key=lambda r: r[1])
    want = expected(rows)
    assert got == [(i, at, n, ids) for i, at, n, _, ids in want]
    got = sorted((tuple(r) for r in R.read_digests(spark, path).collect()), key=lambda r: r[1])
    assert got == [w[:4] for w in want]


def test_damage_is_noticed(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    R.write(R.encode_documents(docs([(1, "some text here")]), PATH, 2), path)
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("ids_crc32", F.lit(1).cast("long"))
    bad = str(tmp_path / "bad")
    blocks.write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{bad}/frequencies")
    with pytest.raises(Exception, match="not those written"):
        R.read(spark, bad).collect()


def test_empty_table(docs):
    assert R.round_trip(docs([]), PATH, 2).collect() == []


def test_counts_come_with_the_encoded_rows(docs):
    rows = [(i, f"some text number {i % 7} here") for i in range(60)] + [(90, None), (91, "")]
    encoded = R.encode_documents(docs(rows), PATH, 2).withColumn("ids", F.lit(None).cast("binary"))
    ids, n = np.unique(np.concatenate([r[4] for r in expected(rows)]), return_counts=True)
    assert {r.id: r.n for r in R._counts(encoded).collect()} == dict(zip(ids.tolist(), n.tolist()))


def test_ids_are_packed_in_16_bits_where_they_fit():
    import zstandard
    press = zstandard.ZstdCompressor(level=1).compress
    for ids, size in (([2], 3), ([0, 49_151, 65_535], 7), ([65_536, 2], 9)):
        raw = np.array(ids, "<u4").tobytes()
        packed = R._packed(raw)
        assert len(packed) == size and R._ids(press(packed)).tolist() == ids


@pytest.mark.parametrize("chunk", ["Word", "Word,", "end.", "it's", "don't.", "a.b", ",", "x2!", "\u00c9t\u00e9.", "a\x00", "caf\u00e9", "wow!?"])
def test_short_ways_to_words_are_those_of_the_expression(chunk):
    plain = R._PLAIN(chunk)
    assert list(R._words(chunk) or []) == (R._WORDS(chunk.lower()) if plain else [])


def test_chunks_that_differ_in_case_or_stop_only_are_worked_off_once(monkeypatch):
    own, asked, words = R._Ids(PATH), [], R._words
    monkeypatch.setattr(R, "_words", lambda chunk: asked.append(chunk) or words(chunk))
    text = "Word word, WORD. word\nword. Word, wORD:"
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() \
        == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert sorted(asked) == [",", ".", ":", "word"]


@pytest.mark.parametrize("text", [
    "A, b. C! D?", "a,, b., c.\n,", "a,b, c", "H̱ello H̱, ẖ.", "İ, Å. å", "café, CAFÉ. É, ",
    "ΟΣ, Σ.", "it's, IT'S.", "a <|endoftext|>, B.", "A\t, B\x00, c", ", . ;", "x9, 9x.", "a, b, A.\r\n"])
def test_parted_texts_have_the_librarys_ids(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    for texts in ([text], ["some", text, "", text]):
        got = R._Ids(PATH).encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for t, g in zip(texts, got) if t == text] == [want] * texts.count(text)


def test_small_batches_are_joined_and_none_is_lost(monkeypatch):
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"x": pa.array(range(k), pa.int64())}) for k in (3, 0, 40, 1, 200, 2)]
    monkeypatch.setattr(R, "RUN", 300)
    got = list(R._joined(iter(batches)))
    assert len(got) < len(batches)
    assert [x for b in got for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]
    assert list(R._joined(iter(batches[1:2]))) == list(R._joined(iter([]))) == []
