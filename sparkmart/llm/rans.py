"""Token ids in files, by a static range asymmetric numeral system.

A dataset is a folder with two tables. ``frequencies`` has one row for each id
that occurs: its share of 2^20, from counts over all documents; every block is
coded with it. ``blocks`` has independent blocks of whole documents, in ascending
order of doc_id over (shard, block): the documents' ids and lengths, the coded
words and their checkpoints, and two checksums.

Within a block symbol i belongs to lane i mod ``LANES``. All lanes take one symbol
at a time, as arrays; a lane whose state falls below 2^31 takes up a 32-bit word.
Every ``CHECKPOINT`` symbols the states and the place in the words are kept, so
the parts between checkpoints can be decoded at the same time (``decode`` does
them as one array) or alone (``decode_part``).

Files are written by Spark's writer, so a task that runs again leaves no trace.

Cases: null and empty texts have the end id only; rows are ordered by doc_id (null
first), equal ones by their text; an empty table gives an empty dataset; an id
whose block fails its checksum is an error, never a wrong result.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import uncollected, written
from sparkmart.session import scratch_path

SCALE_LOG2 = 20
LANES = 1024
#: Symbols of a block, about (documents stay whole), and between two checkpoints.
BLOCK = 1 << 20
CHECKPOINT = 1 << 18
#: Ids of one output file, about.
SHARD = 1 << 24
#: Chunks and words whose ids a worker remembers; bounds its memory.
MEMO = 600_000
#: Characters that are encoded together, about; more of them hold fewer new chunks.
RUN = 1 << 22

_LOW, _WORD = np.uint64(1 << 31), np.uint64(32)
_SCALE, _MASK = np.uint64(SCALE_LOG2), np.uint64((1 << SCALE_LOG2) - 1)


def frequencies(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of 2^SCALE_LOG2 for ``ids`` with ``counts``: each at least one,
    together all of it, as near to the counts as that allows."""
    total = 1 << SCALE_LOG2
    if len(ids) > total:
        raise ValueError("more ids than shares")
    if not len(ids):
        return np.zeros(0, np.int64)
    f = np.maximum(1, np.floor(counts * (total / counts.sum())).astype(np.int64))
    while (off := total - int(f.sum())) != 0:
        order = np.argsort(-f, kind="stable")
        if off > 0:
            f[order[0]] += off
        else:  # take from the largest, which feel it least
            spare = f[order] - 1
            take = np.minimum(spare, np.maximum(1, (-off * f[order]) // total + 1))
            take = np.minimum(take, np.maximum(0, -off - (np.cumsum(take) - take)))
            f[order] -= take
    return f


class Coder:
    """Encoder and decoder of one frequency table."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        size = int(ids.max()) + 1 if len(ids) else 1
        self.share = np.zeros(size, np.uint64)
        self.share[ids] = shares.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.share)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(size, dtype=np.uint32), self.share.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The words, and the checkpoints: place in the words and states."""
        n = len(ids)
        rows = -(-n // LANES)
        x = np.full(LANES, _LOW, np.uint64)
        share, first = self.share[ids], self.first[ids]
        if n and not share.all():
            raise ValueError("an id has no share")
        limit = share << np.uint64(63 - SCALE_LOG2)
        every, parts, marks, count = CHECKPOINT // LANES, [], [], 0
        for row in range(rows - 1, -1, -1):
            at, end = row * LANES, min(n, (row + 1) * LANES)
            y, f = x[:end - at], share[at:end]
            full = y >= limit[at:end]
            if full.any():
                words = (y[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
                parts.append(words)
                count += len(words)
                y[full] >>= _WORD
            q = y // f
            y[:] = (q << _SCALE) + (y - q * f) + first[at:end]
            if row % every == 0:
                marks.append((count, x.copy()))
        words = np.concatenate([np.zeros(0, "<u4"), *reversed(parts)])
        kept = b"".join(np.uint64(count - c).tobytes() + s.tobytes() for c, s in reversed(marks))
        return words.tobytes(), kept

    def _run(self, words: np.ndarray, places: np.ndarray, states: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Decode the parts that begin at ``places`` with ``states``, side by side;
        the result has a row for each part."""
        parts, most = len(sizes), int(sizes.max()) if len(sizes) else 0
        steps = -(-most // LANES)
        out = np.zeros((parts, steps, LANES), np.uint32)
        x, at = states.copy(), places.astype(np.int64).copy()
        lane = np.arange(LANES)
        for step in range(steps):
            live = lane < (sizes - step * LANES)[:, None]
            slot = x & _MASK
            s = self.symbol[slot]
            y = self.share[s] * (x >> _SCALE) + slot - self.first[s]
            low = live & (y < _LOW)
            if low.any():
                nth = np.cumsum(low, axis=1)
                take = np.where(low, at[:, None] + nth - 1, 0)
                y = np.where(low, (y << _WORD) | words[take].astype(np.uint64), y)
                at += nth[:, -1]
            x = np.where(live, y, x)
            out[:, step] = s
        return out.reshape(parts, steps * LANES)

    @staticmethod
    def _marks(kept: bytes) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(kept, np.uint64).reshape(-1, LANES + 1)
        return a[:, 0], a[:, 1:]

    def decode(self, n: int, words: bytes, kept: bytes) -> np.ndarray:
        places, states = self._marks(kept)
        sizes = np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(places)))
        w = np.append(np.frombuffer(words, "<u4"), np.uint32(0))
        out = self._run(w, places, states, sizes)
        return np.concatenate([np.zeros(0, np.uint32), *(out[k, :m] for k, m in enumerate(sizes))])

    def decode_part(self, n: int, words: bytes, kept: bytes, part: int) -> np.ndarray:
        """Only the symbols from checkpoint ``part`` to the next."""
        places, states = self._marks(kept)
        size = np.array([min(CHECKPOINT, n - CHECKPOINT * part)])
        w = np.append(np.frombuffer(words, "<u4"), np.uint32(0))
        return self._run(w, places[part:part + 1], states[part:part + 1], size)[0, :size[0]]


#: Text whose words may be encoded one by one: it is its own normal form, and
#: each capital has one small letter, so the words are those the tokenizer sees.
_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: Fixed by the tokenizer: what it takes for a word.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


#: One of these after letters is a word of its own.
_STOPS = frozenset(",.;:!?")


def _words(chunk: str) -> Sequence[str] | None:
    """The words of a chunk without blanks; None if the tokenizer has to see all of
    it. Most chunks are letters, or letters and a stop, and need no expression."""
    if chunk.isascii():
        if chunk.isalpha():
            return (chunk.lower(),)
        if chunk[-1:] in _STOPS and chunk[:-1].isalpha():
            return chunk[:-1].lower(), chunk[-1]
    if not _PLAIN(chunk):
        return None
    low = chunk.lower()
    return (low,) if low.isalpha() else _WORDS(low)


def _parted(column):
    """Texts of an Arrow column with the same ids, of which fewer chunks differ: a stop
    that ends a chunk of letters stands alone, and A-Z are small unless there
    are marks, with which a small letter may form a sign where its capital does not."""
    import pyarrow.compute as pc
    column = pc.replace_substring_regex(column, r"([A-Za-z])([,.;:!?])( |$)", r"\1 \2\3")
    return pc.if_else(pc.match_substring_regex(column, r"\p{M}"), column, pc.ascii_lower(column))


class _Ids:
    """Ids of whole texts from the tokenizers library, which is asked for new
    words only: a text's ids are those of its words, one after the other."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, text: str) -> np.ndarray:
        # the ids alone, without places in the text
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Many words at a time; the last id of a word says that it is the last."""
        # letters a to z are their own normal form and bytes, so the library's model takes them as they are
        model, others = self.tokenizer.model.tokenize, []
        for w in words:
            if w.isascii() and w.isalpha():
                self.words[w] = array("I", [t.id for t in model(w)]).tobytes()
            else:
                others.append(w)
        ids = self._library(" ".join(others))
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(others):
            raise ValueError("a word has no end among its ids")
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        self.words.update(zip(others, [raw[at:end] for at, end in zip([0, *ends], ends)]))

    def _parts(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without blanks, each given once."""
        parts = list(map(self.chunks.get, chunks))
        missing = [k for k, part in enumerate(parts) if part is None]
        found, known = [_words(chunks[k]) for k in missing], self.words
        if new := dict.fromkeys(w for words in found if words for w in words if w not in known):
            self._learn(list(new))
        for k, words in zip(missing, found):
            chunk = chunks[k]
            if not words:
                part = self._library(chunk).tobytes()
            else:
                part = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])
            parts[k] = part
            if len(chunk) <= 64 and len(self.chunks) < MEMO:
                self.chunks[chunk] = part
        if len(known) > MEMO:
            known.clear()
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Arrow cuts the texts and numbers their chunks, so that Python sees each
        chunk once, and arrays put the ids together."""
        import pyarrow as pa
        import pyarrow.compute as pc
        whole = {k: self._library(t).tobytes() for k, t in enumerate(texts) if any(s in t for s in self.special)}
        column = pa.array(["" if k in whole else t for k, t in enumerate(texts)] if whole else texts, pa.large_string())
        # a blank or a line end always ends a word and is part of none
        lists = pc.split_pattern(_parted(pc.replace_substring(column, "\n", " ")), " ")
        numbered = lists.flatten().dictionary_encode()
        parts = self._parts(numbered.dictionary.to_pylist())
        ids, sizes = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        at = numbered.indices.to_numpy()
        n, first = sizes[at], (np.cumsum(sizes) - sizes)[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = ids[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]
        ends = ends[lists.offsets.to_numpy()].tolist()
        return [whole[k] if k in whole else ids[i:j].tobytes() for k, (i, j) in enumerate(zip(ends, ends[1:]))]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> _Ids:
    return _Ids(path)


def _some(texts: list[str], most: int):
    """Runs of texts with about ``most`` characters together."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _joined(batches):
    """The batches, small ones put together up to about ``RUN`` bytes."""
    import pyarrow as pa
    run: list = []
    for batch in batches:
        run.append(batch)
        if sum(b.nbytes for b in run) >= RUN:
            yield pa.Table.from_batches(run).combine_chunks().to_batches()[0]
            run = []
    if run and any(b.num_rows for b in run):
        yield pa.Table.from_batches(run).combine_chunks().to_batches()[0]


def encode_documents(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, h (hash of the text), n, ids (compressed) of each row; the first row of
    each batch has the counts of the batch's ids as well (compressed)."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        tokenizer, end = _tokenizer(path), np.array([end_id], "<u4").tobytes()
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in _joined(batches):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            with uncollected():
                raw = [ids + end for some in _some(texts, RUN) for ids in tokenizer.encode(some)]
            counts = np.bincount(np.frombuffer(b"".join(raw), "<u4")).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(r) // 4 for r in raw], pa.int64()),
                 pa.array([press(_packed(r)) for r in raw], pa.binary()),
                 pa.array([press(counts.tobytes()) if k == 0 else None for k in range(len(raw))], pa.binary())],
                names=["doc_id", "h", "n", "ids", "counts"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
                       text.alias("text")).mapInArrow(run, "doc_id long, h long, n long, ids binary, counts binary")


def _packed(raw: bytes) -> bytes:
    """The ids in 16 bits each if all fit, and whether they do."""
    ids = np.frombuffer(raw, "<u4")
    return b"\2" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\4" + raw


@functools.lru_cache(maxsize=1)
def _opener():
    import zstandard
    return zstandard.ZstdDecompressor()


def _ids(pressed: bytes) -> np.ndarray:
    packed = _opener().decompress(pressed)
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype("<u4")


def _counts(encoded: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        import zstandard
        total, open_up = np.zeros(0, np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for x in batch.column(0):
                c = np.frombuffer(open_up(x.as_py()), "<i8")
                if len(c) > len(total):
                    total = np.append(total, np.zeros(len(c) - len(total), np.int64))
                total[:len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return encoded.where("counts is not null").select("counts").mapInArrow(run, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n"))


def write(encoded: DataFrame, path: str) -> None:
    """Write the rows of ``encode_documents`` as a dataset."""
    spark = encoded.sparkSession
    # one row for each id of the vocabulary, so bounded by it
    rows = sorted((r.id, r.n) for r in _counts(encoded).collect())
    ids = np.array([r[0] for r in rows], np.int64)
    shares = frequencies(ids, np.array([r[1] for r in rows], np.float64))
    spark.createDataFrame([(int(a), int(b)) for a, b in zip(ids, shares)], "id long, share long") \
        .coalesce(1).write.parquet(f"{path}/frequencies")
    total = encoded.agg(F.sum("n")).first()[0] or 0
    shared = spark.sparkContext.broadcast((ids, shares))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        coder, shard, block = Coder(*shared.value), TaskContext.get().partitionId(), 0
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                            ("words", pa.binary()), ("checkpoints", pa.binary()),
                            ("words_crc32", pa.int64()), ("ids_crc32", pa.int64())])

        def coded(names, parts):
            all_ids = np.concatenate(parts)
            words, kept = coder.encode(all_ids)
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "block": [block], "n": [len(all_ids)], "doc_ids": [names],
                 "sizes": [[len(p) for p in parts]], "words": [words], "checkpoints": [kept],
                 "words_crc32": [zlib.crc32(kept, zlib.crc32(words))],
                 "ids_crc32": [zlib.crc32(all_ids.tobytes())]}, schema=schema)

        names, parts, size = [], [], 0
        for batch in batches:
            for name, pressed in zip(batch.column(0), batch.column(1)):
                part = _ids(pressed.as_py())
                if names and size + len(part) > BLOCK:
                    yield coded(names, parts)
                    names, parts, size, block = [], [], 0, block + 1
                names.append(name.as_py())
                parts.append(part)
                size += len(part)
        if names:
            yield coded(names, parts)

    shards = max(1, -(-total // SHARD), min(encoded.rdd.getNumPartitions(), -(-total // BLOCK)))
    encoded.select("doc_id", "h", "ids").repartitionByRange(shards, "doc_id") \
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "h").select("doc_id", "ids") \
        .mapInArrow(run, "shard int, block int, n long, doc_ids array<long>, sizes array<long>, words binary, "
                         "checkpoints binary, words_crc32 long, ids_crc32 long") \
        .write.parquet(f"{path}/blocks")


def _decoded(spark: SparkSession, path: str, each, columns: str) -> DataFrame:
    """A row for each document: doc_id, shard, block, before (ids of earlier
    documents in its block), n_tokens and what ``each`` makes of its ids."""
    table = spark.read.parquet(f"{path}/frequencies").orderBy("id").collect()  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast((np.array([r.id for r in table], np.int64),
                                           np.array([r.share for r in table], np.int64)))

    def run(batches):
        import pyarrow as pa
        coder = Coder(*shared.value)
        for batch in batches:
            for r in batch.to_pylist():
                if zlib.crc32(r["checkpoints"], zlib.crc32(r["words"])) != r["words_crc32"]:
                    raise ValueError(f"shard {r['shard']}, block {r['block']}: the coded words are damaged")
                ids = coder.decode(r["n"], r["words"], r["checkpoints"])
                if zlib.crc32(ids.tobytes()) != r["ids_crc32"]:
                    raise ValueError(f"shard {r['shard']}, block {r['block']}: the ids are not those written")
                ends = np.cumsum(np.array(r["sizes"], np.int64))
                made = each([ids[e - s:e] for s, e in zip(r["sizes"], ends)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array([r["shard"]] * len(ends), pa.int32()),
                     pa.array([r["block"]] * len(ends), pa.int32()), pa.array(ends - r["sizes"], pa.int64()),
                     pa.array(r["sizes"], pa.int64()), made], names=["doc_id", "shard", "block", "before",
                                                                     "n_tokens", "made"])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        run, f"doc_id long, shard int, block int, before long, n_tokens long, made {columns}")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, block, first: the ids before each block. Shards are summed first,
    so the one running sum over all has a row for each shard only."""
    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "block", "n")
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("b", F.coalesce(F.sum("n").over(within), F.lit(0))).join(shards, "shard") \
        .select("shard", "block", (F.col("base") + F.col("b")).alias("first"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of each document of a dataset."""
    def lists(parts):
        import pyarrow as pa
        return pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))

    return _decoded(spark, path, lists, "array<long>").join(starts(spark, path), ["shard", "block"]) \
        .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", F.col("made").alias("ids"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document of a dataset."""
    def crcs(parts):
        import pyarrow as pa
        return pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())

    return _decoded(spark, path, crcs, "long").join(starts(spark, path), ["shard", "block"]) \
        .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens",
                F.col("made").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Encode, write to ``path`` (a scratch folder by default) and read back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    write(written(encode_documents(docs, tokenizer, end_id), "token-ids-unordered"), path)
    return read_digests(spark, path)
