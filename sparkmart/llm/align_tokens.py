"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces with
a space mark, sentencepiece) the text, before which it puts the space itself.
Each document is tokenised whole by both. Where a token of A and one of B both
begin with a space at one byte offset, the tokens before them end together: these
anchors cut the document into windows of token ids, mostly a word each. Within a
window the byte offsets where tokens of both end cut it into groups; the groups of
a window depend on its ids only, so they are remembered by the two id tuples.

A's file is one of the tokenizers library. Its merges come in the order of the ids
they make (checked when it is read), so the tiktoken library reads the same
vocabulary as ranks and gives the same ids at a third of the time.

The last tokens of a group are linked (their byte ranges end together; no token
is empty, so there is one such pair for each group). Links are counted over the
corpus by id pair. Linked tokens end the same bytes, so the bytes of one are a
suffix of the other's: there are no more pairs than the vocabularies' tokens have
suffixes (``Vocabulary.most_pairs``, some 10^6), however large the corpus, and the
counts may go to every task.

Cases: a null or empty text, and one that either tokenizer does not give back
byte by byte (say, with U+2581 in it), has no tokens: zeros and the digest '';
special tokens inside texts are plain text; rows that repeat count as often as
they occur; texts of any length are tokenised whole, a batch of short ones at a
time; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import uncollected, written

#: Windows a worker remembers before it starts anew, and the tokens of the longest.
MEMO, LONGEST = 60_000, 32
#: Code points of text that are tokenised at once (one longer text alone).
BATCH = 1 << 17

#: Ids and sizes are packed: little-endian unsigned integers of 16 or 32 bits.
PACKED = ("doc_id long, n_a long, n_b long, n_groups long, a_ids binary, b_ids binary, "
          "a_sizes binary, b_sizes binary, groups_sha256 string")
SIZE = np.dtype("<u4")
#: Odd factors that tell places within a window apart in its hash.
_ODD = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_of() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable
    characters for themselves, the other bytes for U+0100 onwards."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Both tokenizers, and the bytes of their tokens by id."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of, ids = _byte_of(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        self.a_bytes = [b""] * len(ids)
        for token, i in ids.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(map(byte_of.__getitem__, token))
        for k, pair in enumerate(spec["model"]["merges"]):
            if ids["".join(pair if isinstance(pair, list) else pair.split(" "))] != 256 + k:
                raise ValueError(f"{a_path}: the merges don't come in the order of ids")
        ranks = {self.a_bytes[i]: i for token, i in ids.items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]

    @property
    def most_pairs(self) -> int:
        """Bound on linked pairs: one for each suffix of a token of B, as no two
        tokens of A share their bytes, and two for each suffix of one of A, as a
        byte may be a piece of B as well."""
        return sum(map(len, self.b_bytes)) + 2 * sum(map(len, self.a_bytes))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]]]:
        return [(self.a.encode_to_numpy(" " + t), b) for t, b in zip(texts, self.b.encode(texts, num_threads=1))]


class _Side:
    """What is known of one tokenizer's tokens by id, as arrays."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int32)  # texts have less than 2^31 bytes
        self.space = np.array([t[:1] == b" " for t in tokens])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.cumsum(self.size, dtype=np.int32) - self.size
        self.packing = np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token begins, and where the last one ends."""
        out = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(self.size[ids], out=out[1:])
        return out

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        size, at = self.size[ids], self.offsets(ids)
        place = np.repeat(self.at[ids] - at[:-1], size)
        place += np.arange(at[-1], dtype=np.int32)
        return self.bytes[place]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[k]`` up to ``first[k] + size[k]`` for each k, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Aligner:
    def __init__(self, vocabulary: Vocabulary, memo: int = MEMO):
        self.vocabulary, self.most = vocabulary, memo
        self.a, self.b = _Side(vocabulary.a_bytes), _Side(vocabulary.b_bytes)
        self.names = [str(i) for i in range(max(len(vocabulary.a_bytes), len(vocabulary.b_bytes)))]
        self.name_len = np.array([len(x) for x in self.names])
        #: Packed id tuples of a window -> sizes of its groups in tokens of A and
        #: of B (packed), and their text.
        self.memo: dict[tuple[bytes, bytes], tuple[bytes, bytes, str]] = {}

    def _faithful(self, side: _Side, ids: list[np.ndarray], raw: list[bytes]) -> np.ndarray:
        """Which texts the tokens give back byte by byte."""
        right = np.array([side.size[x].sum() == len(r) for x, r in zip(ids, raw)])
        kept = np.flatnonzero(right)
        if len(kept):
            wrong = side.spelt(np.concatenate([ids[k] for k in kept])) != \
                np.frombuffer(b"".join([raw[k] for k in kept]), np.uint8)
            first = np.cumsum([0, *(len(raw[k]) for k in kept)])[:-1]
            right[kept] = ~np.logical_or.reduceat(wrong, first)
        return right

    def _anchors(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each window of the documents that begin at ``starts``: its byte
        offset, the place of its first token of A and of B; last come the ends.
        Every anchor is an end of both tokenisations: its offset is where a
        token of each begins."""
        a_at, b_at = self.a.offsets(a), self.b.offsets(b)
        both = np.intersect1d(a_at[:-1][self.a.space[a]], b_at[:-1][self.b.space[b]], assume_unique=True)
        cuts = np.union1d(both, np.append(starts, a_at[-1]))
        return cuts, np.searchsorted(a_at, cuts), np.searchsorted(b_at, cuts)

    @staticmethod
    def _distinct(sides: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Windows (given by ids and first places on both sides) that occur: the
        first place of each, and which of them every window is."""
        total = len(sides[0][1]) - 1
        mix = np.zeros(total, np.uint64)
        within = []
        for ids, cut in sides:
            place = np.arange(len(ids)) - np.repeat(cut[:-1], np.diff(cut))
            within.append(place)
            mix = mix * np.uint64(0x9E3779B97F4A7C15) + \
                np.add.reduceat((ids.astype(np.uint64) + np.uint64(1)) * _ODD[place % len(_ODD)], cut[:-1])
        _, first, which = np.unique(mix, return_index=True, return_inverse=True)
        for (ids, cut), place in zip(sides, within):
            size, model = np.diff(cut), first[which]
            if (size != size[model]).any() or (ids != ids[np.repeat(cut[:-1][model], size) + place]).any():
                return np.arange(total), np.arange(total)  # two windows share a hash: each for itself
        return first, which

    def _groups(self, a: np.ndarray, b: np.ndarray, sizes: list[np.ndarray]) -> list[tuple[bytes, bytes, str]]:
        """Groups of windows, given their tokens one window after the other and
        how many of them each window has."""
        windows = np.arange(len(sizes[0]))
        a_win, b_win = (np.repeat(windows, n) for n in sizes)
        a_end, b_end = self.a.offsets(a)[1:], self.b.offsets(b)[1:]
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        packed = [np.bincount(g, minlength=len(shared)).astype(SIZE).tobytes() for g in (a_group, b_group)]
        at = np.cumsum([0, *np.bincount(a_win[np.searchsorted(a_end, shared)], minlength=len(windows))]) * SIZE.itemsize
        # the text: names of the tokens by group, A's before B's, each with what comes after it
        part = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(part, kind="stable")
        ids, part = np.concatenate([a, b])[order], part[order]
        step = np.append(part[1:], -1) - part
        pieces = [""] * (2 * len(ids))
        pieces[::2] = map(self.names.__getitem__, ids.tolist())
        pieces[1::2] = np.where(step == 0, ",", np.where((step == 1) & (part % 2 == 0), "|", ";")).tolist()
        text = "".join(pieces)
        ends = np.cumsum(self.name_len[ids] + 1)[np.cumsum(sizes[0] + sizes[1]) - 1].tolist()
        return [(packed[0][i:j], packed[1][i:j], text[x:y - 1])
                for i, j, x, y in zip(at.tolist(), at[1:].tolist(), [0, *ends], ends)]

    def _aligned(self, a: np.ndarray, b: np.ndarray, cuts: list[np.ndarray], keys: list[tuple[bytes, bytes]],
                 first: np.ndarray) -> list[tuple[bytes, bytes, str]]:
        """The groups of the windows at the places ``first``, remembered or new."""
        found = list(map(self.memo.get, keys))
        new = [k for k, f in enumerate(found) if f is None]
        if new:
            chosen = first[new]
            sizes = [np.diff(cut)[chosen] for cut in cuts]
            ids = [x[_ranges(cut[chosen], n)] for x, cut, n in zip((a, b), cuts, sizes)]
            for k, n, groups in zip(new, (sizes[0] + sizes[1]).tolist(), self._groups(*ids, sizes)):
                found[k] = groups
                if n <= LONGEST:
                    if len(self.memo) >= self.most:
                        self.memo.clear()
                    self.memo[keys[k]] = groups
        return found

    def documents(self, texts: list[str | None]) -> list[tuple[bytes, bytes, bytes, bytes, str]]:
        """The packed ids of A and of B, tokens of each in the groups (packed),
        and the digest of the groups, of each text."""
        out = [(b"", b"", b"", b"", "")] * len(texts)
        places = [k for k, t in enumerate(texts) if t]
        pairs = [(x, np.array(y)) for x, y in self.vocabulary.encode([texts[k] for k in places])]
        raw = [b" " + texts[k].encode() for k in places]
        if pairs:
            right = self._faithful(self.a, [p[0] for p in pairs], raw) & self._faithful(self.b, [p[1] for p in pairs], raw)
            places, pairs, raw = ([x for x, ok in zip(xs, right) if ok] for xs in (places, pairs, raw))
        if not pairs:
            return out
        a, b = (np.concatenate(x) for x in zip(*pairs))
        starts = np.cumsum([0, *map(len, raw)])
        cuts, *sides = self._anchors(a, b, starts[:-1])
        a_raw, b_raw = a.astype(self.a.packing).tobytes(), b.astype(self.b.packing).tobytes()
        x, y = ((cut * s.packing.itemsize) for cut, s in zip(sides, (self.a, self.b)))
        first, which = self._distinct(list(zip((a, b), sides)))
        keys = [(a_raw[i:i1], b_raw[j:j1]) for i, i1, j, j1 in
                zip(x[first].tolist(), x[first + 1].tolist(), y[first].tolist(), y[first + 1].tolist())]
        a_sizes, b_sizes, groups = zip(*self._aligned(a, b, sides, keys, first))
        window = np.searchsorted(cuts, starts)
        x, y, which = x[window].tolist(), y[window].tolist(), which.tolist()
        for k, (place, w, w1) in enumerate(zip(places, window.tolist(), window[1:].tolist())):
            own = which[w:w1]
            out[place] = (a_raw[x[k]:x[k + 1]], b_raw[y[k]:y[k + 1]], b"".join([a_sizes[i] for i in own]),
                          b"".join([b_sizes[i] for i in own]),
                          hashlib.sha256(";".join([groups[i] for i in own]).encode()).hexdigest())
        return out


@functools.lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    return Aligner(Vocabulary(a_path, b_path, pattern))


def _runs(texts, most: int):
    """(first, last) of runs of about ``most`` code points."""
    import pyarrow.compute as pc
    first = size = 0
    for k, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), 1):
        size += n
        if size >= most:
            yield first, k
            first, size = k, 0
    if first < len(texts):
        yield first, len(texts)


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """For each row the ids of both tokenizers, how many of each a group has, in
    order (all packed; ``unpacked`` makes arrays), and the digest of the groups
    (``a1,a2|b1;a3|b2,b3``)."""
    def run(batches):
        import pyarrow as pa
        aligner = _aligner(a_path, b_path, pattern)
        widths = (aligner.a.packing.itemsize, aligner.b.packing.itemsize, SIZE.itemsize)
        for batch in batches:
            for first, last in _runs(batch.column(1), BATCH):
                part = batch.slice(first, last - first)
                with uncollected():
                    columns = list(zip(*aligner.documents(part.column(1).to_pylist())))
                counts = [pa.array([len(x) // w for x in columns[k]], pa.int64()) for k, w in enumerate(widths)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts, *(pa.array(c, pa.binary()) for c in columns[:4]),
                     pa.array(columns[4], pa.string())], names=[c.split()[0] for c in PACKED.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, PACKED)


def _flat(column, n: int) -> np.ndarray:
    """The integers of a packed column, ``n`` in all, one row after the other."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else SIZE)


def unpacked(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` with arrays in place of packed columns."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for name, kind in zip(batch.schema.names, batch.schema.types):
                if kind in (pa.binary(), pa.large_binary()):
                    n = batch.column({"a_ids": "n_a", "b_ids": "n_b"}.get(name, "n_groups")).to_numpy()
                    flat = _flat(batch.column(name), int(n.sum())).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), pa.array(flat)))
                else:
                    out.append(batch.column(name))
            yield pa.RecordBatch.from_arrays(out, names=batch.schema.names)

    return aligned.mapInArrow(run, PACKED.replace("binary", "array<int>"))


def _links(batch) -> tuple[np.ndarray, np.ndarray]:
    """The id pair (A high, B low) of each link, and where each row's links begin."""
    n = {c: batch.column(c).to_numpy() for c in ("n_a", "n_b", "n_groups")}
    groups = int(n["n_groups"].sum())
    ends = []
    for ids, sizes, count in (("a_ids", "a_sizes", "n_a"), ("b_ids", "b_sizes", "n_b")):
        last = np.cumsum(_flat(batch.column(sizes), groups), dtype=np.int64) - 1
        ends.append(_flat(batch.column(ids), int(n[count].sum()))[last].astype(np.int64))
    return ends[0] << 32 | ends[1], np.concatenate([[0], np.cumsum(n["n_groups"])]).astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair (A's id in the high 32 bits, B's in the low), n: links of each id pair over all rows."""
    def run(batches):
        import pyarrow as pa
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            p, c = np.unique(_links(batch)[0], return_counts=True)
            merged, at = np.unique(np.concatenate([pairs, p]), return_inverse=True)
            total = np.zeros(len(merged), np.int64)
            np.add.at(total, at, np.concatenate([counts, c]))
            pairs, counts = merged, total
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    return aligned.select("n_a", "n_b", "n_groups", "a_ids", "b_ids", "a_sizes", "b_sizes") \
        .mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored(aligned: DataFrame, counts: DataFrame, most_pairs: int) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    the rows of ``align``, given the corpus-wide ``counts``, of which there are
    at most ``most_pairs``."""
    spark = aligned.sparkSession
    table = counts.limit(most_pairs + 1).toArrow()
    if len(table) > most_pairs:
        raise ValueError(f"more than {most_pairs} linked id pairs: the tokens can't be those of the texts")
    pairs, n = (table.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    shared = spark.sparkContext.broadcast((pairs[order].astype(np.int64), n[order].astype(np.int64)))

    def run(batches):
        import pyarrow as pa
        pairs, n = shared.value
        b = (pairs & 0xFFFFFFFF).astype(np.int64)
        best = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
        np.maximum.at(best, b, n)
        for batch in batches:
            links, first = _links(batch)
            distinct, which = np.unique(links, return_inverse=True)
            count = n[np.searchsorted(pairs, distinct)] if len(links) else distinct
            is_best = (count == best[distinct & 0xFFFFFFFF])[which]
            count, sums = count[which], []
            for x in (np.ones_like(links), is_best, count):
                run_sum = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
                sums.append(pa.array(run_sum[first[1:]] - run_sum[first[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), *sums, batch.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                   "count_sum long, groups_sha256 string")


def cross_align(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Each document's alignment with the counts of its links over all documents."""
    aligned = written(align(docs, a_path, b_path, pattern, id_col, text_col), "aligned-tokens")
    return scored(aligned, pair_counts(aligned), Vocabulary(a_path, b_path, pattern).most_pairs)
