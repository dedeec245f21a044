"""Byte-level BPE by longest matches and backtracking.

Instead of merging pairs, the encoder walks a piece from left to right. At each
place it takes the longest token that starts there (an Aho-Corasick automaton
over the bytes, read as Latin-1, finds it), as long as the token and the one
before it are compatible, that is, the merges would have left exactly that
boundary. If not, it tries the next shorter prefix token and, when none is left,
takes the last token back and marks the place as a dead end. A place is marked
at most once, so the work is linear in the piece.

Two adjacent tokens are compatible if undoing their merges, the later one first,
never meets a pair across the boundary that would have been merged earlier. The
answer is remembered for each pair of tokens.

As the vocabulary format asks, a piece that is itself a token is taken
whole, and tokens that merges can't reach are used for whole pieces only.

Cases: null counts as the empty text (no ids); unpaired surrogates can't occur
in Spark strings; special tokens are never produced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from itertools import chain

import ahocorasick
import regex

from sparkmart.llm.common import uncollected

#: Pieces whose ids a worker remembers before it starts anew; bounds its memory.
MEMO = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class _Memo(dict):
    """Ids of pieces of text, worked out when first asked for. It starts anew
    when it is full; long pieces aren't kept."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encode(piece)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class BacktrackingBPE:
    """Encoder and decoder over a table of ranks (token bytes to id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks, self.memo_size = ranks, memo
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self._memo = _Memo(self._encode_piece, memo)
        self._fits: dict[int, bool] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        for b, i in ranks.items():
            self._split[i] = self._last_merge(b, i)
        self.shorter = {i: self._prefix_token(b) for b, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            if self._reachable(i):
                # reversed, so that matches that end at a place begin there in the piece
                self.automaton.add_word(b.decode("latin-1")[::-1], (i, len(b)))
        self.automaton.make_automaton()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that the token's own merge joins; None for one byte or
        if the merges never arrive at the token."""
        parts = [token[i:i + 1] for i in range(len(token))]
        if len(parts) == 1 or any(p not in self.ranks for p in parts):
            return None
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _reachable(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self._split[token] is not None

    def _prefix_token(self, token: bytes) -> int | None:
        for n in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:n])
            if i is not None and self._reachable(i):
                return i
        return None

    def _compatible(self, left: int, right: int) -> bool:
        """Would the merges leave the boundary between the two tokens?"""
        ceiling = len(self.ranks) + (1 << 20)
        ranks, bytes_of, split = self.ranks, self.bytes_of, self._split
        while True:
            joint = ranks.get(bytes_of[left] + bytes_of[right])
            if joint is not None and joint < ceiling:
                return False
            # undo the later merge; of equal ones the right token's came later
            a, b = split[left], split[right]
            if a is not None and (b is None or left > right):
                ceiling, left = left, a[1]
            elif b is not None:
                ceiling, right = right + 1, b[0]
            else:
                return True

    def _encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        longest: list[int] = [-1] * n
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")[::-1]):
            start = n - 1 - end
            if longest[start] < 0 or size > len(self.bytes_of[longest[start]]):
                longest[start] = token
        fits, sizes, out, pos, open_ = self._fits, self.bytes_of, [], 0, bytearray(b"\x01") * (n + 1)
        token = longest[0]
        while pos < n:
            last = out[-1] if out else None
            while token is not None:
                end = pos + len(sizes[token])
                if open_[end]:
                    if last is None:
                        break
                    key = last << 32 | token
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) > 4 * self.memo_size:
                            fits.clear()
                        ok = fits[key] = self._compatible(last, token)
                    if ok:
                        break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                pos = end
                token = longest[pos] if pos < n else None
            else:
                open_[pos] = 0
                token = out.pop()
                pos -= len(sizes[token])
                token = self.shorter[token]
                if token is None and not out:
                    raise ValueError("a byte of the piece is not in the vocabulary")
                # the loop above goes on with the next shorter token at this place
        return tuple(out)

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        return (whole,) if whole is not None else self._encode_bytes(raw)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._memo.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> BacktrackingBPE:
    return BacktrackingBPE(load_ranks(path), pattern)


def encode_documents(docs, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"):
    """``doc_id``, ``ids`` (array of int) of each row's whole text."""
    from pyspark.sql import functions as F

    @F.pandas_udf("array<int>")
    def encode(texts):
        import pandas as pd
        codec = _codec(path, pattern)
        return pd.Series([codec.encode(t or "") for t in texts])

    return docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col)).alias("ids"))


def decode_documents(encoded, path: str, pattern: str):
    """``encoded`` with ``decoded``, the bytes of its ``ids``."""
    from pyspark.sql import functions as F

    @F.pandas_udf("binary")
    def decode(ids):
        import pandas as pd
        codec = _codec(path, pattern)
        return pd.Series([codec.decode(x) for x in ids])

    return encoded.withColumn("decoded", decode("ids"))


def digests(docs, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = False):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, if asked for) of
    each row: the ids are encoded, digested and decoded again in one pass."""
    from pyspark.sql import functions as F

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        codec = _codec(path, pattern)
        name = {i: str(i) for i in codec.bytes_of}.__getitem__
        for batch in batches:
            counts, a, b, all_ids = [], [], [], []
            with uncollected():
                for text in batch.column(1):
                    tokens = codec.encode(text.as_py() or "")
                    counts.append(len(tokens))
                    a.append(hashlib.sha256(",".join(map(name, tokens)).encode()).hexdigest())
                    b.append(hashlib.sha256(codec.decode(tokens)).hexdigest())
                    if with_ids:
                        all_ids.append(array("i", tokens))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(a, pa.string()),
                       pa.array(b, pa.string())]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x) for x in all_ids)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                    + ", ids array<int>" * with_ids)
