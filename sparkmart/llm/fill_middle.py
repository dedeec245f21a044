"""Fill-in-the-middle examples, assembled by a secondary sort.

A text is cut into units (a run of white space with the word after it). Two
places among the units, drawn from the document's id, cut it into prefix,
middle and suffix, and the parts are put in another order behind sentinels:

    psm  <P>prefix<S>suffix<M>middle      spm  <S>suffix<P>prefix<M>middle

A document leaves the mappers as pieces of at most ``UNITS`` units and ``SPAN``
code points, keyed by document and output position.
``repartitionAndSortWithinPartitions`` brings the pieces of a document together
in output order; they stream, one at a time, into the digest of the output.
From the output alone (its sentinels tell where each part begins) each piece
gets its place in the original text, and a second sort streams the pieces into
the digest of the restored text. A plain output stands in the original order
already and is digested as it streams. So no task holds a document it assembles, and
sorting spills to disk. Pieces travel compressed.

The document part of a key is a digest of id and text, so that a task which is
run again sends the same pieces to the same place. Rows that repeat an id with
the same text are told apart by how often the mapper has met them, which deals
them out over many keys; those that still share a key (met by several mappers)
are counted, not assembled twice.

Cases: a null text is the empty text, which stays plain; a text that holds a
sentinel stays plain; white space at the end of a text, or all of it, is one
unit; a null id draws its places from the text ``None``; an empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most units and code points of a piece.
UNITS, SPAN = 2048, 1 << 15
#: Code points of text for each partition of the sorts.
PARTITION = 1 << 24
SEED = 42

# Fixed by the task.
UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

#: Place of each part in the original text; the record of a document comes last.
_PLACE = {"<P>": 0, "<M>": 1, "<S>": 2}
_RECORD = 3


#: Shorter pieces travel as they are.
_SHORT = 64


def _packed(piece: str) -> str | bytes:
    return piece if len(piece) < _SHORT else zstandard.compress(piece.encode(), 1)


def _unpacked(piece: str | bytes) -> str:
    return piece if isinstance(piece, str) else zstandard.decompress(piece).decode()


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits for a document."""
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def layout(doc_id: int | None, text: str, seed: int = SEED) -> tuple[str, array, int, int]:
    """Form, ends of the units, and how many units end before the middle and
    before the suffix."""
    ends = array("q", (m.end() for m in UNIT.finditer(text)))
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in SENTINELS.values()) or h3 % 100 >= 50:
        form = "plain"
    else:
        form = "spm" if h4 % 100 < 80 else "psm"
    return form, ends, a, b


def _chunks(text: str, ends: array, first: int, last: int) -> Iterator[str]:
    """The text of the units from ``first`` up to ``last`` in pieces."""
    for i in range(first, last, UNITS):
        at, end = (ends[i - 1] if i else 0), ends[min(i + UNITS, last) - 1]
        for j in range(at, end, SPAN):
            yield text[j:min(j + SPAN, end)]


def pieces(doc_id: int | None, text: str, seed: int = SEED) -> tuple[tuple, Iterator[str]]:
    """(n, form, prefix_chars, middle_chars) and the pieces in output order; a
    piece that begins a part starts with its sentinel."""
    form, ends, a, b = layout(doc_id, text, seed)
    n = len(ends)
    if form == "plain":
        return (n, form, None, None), _chunks(text, ends, 0, n)
    units = {"prefix": (0, a), "middle": (a, b), "suffix": (b, n)}
    until = [ends[i - 1] if i else 0 for i in (a, b)]

    def parts():
        for part in ORDERS[form]:
            lead = SENTINELS[part]
            for chunk in _chunks(text, ends, *units[part]):
                yield lead + chunk
                lead = ""
            if lead:
                yield lead

    return (n, form, until[0], until[1] - until[0]), parts()


def _emit(seed: int) -> Callable:
    """((document, repeat, position), piece); at position 0 the document's record."""
    def run(rows):
        met: dict[bytes, int] = {}
        for doc_id, text in rows:
            text = text or ""
            key = hashlib.blake2b(f"{doc_id}:{text}".encode(), digest_size=12).digest()
            repeat = met[key] = met.get(key, -1) + 1
            record, parts = pieces(doc_id, text, seed)
            yield (key, repeat, 0), (doc_id, *record)
            for position, piece in enumerate(parts, 1):
                yield (key, repeat, position), _packed(piece)
    return run


def _owner(key: tuple) -> int:
    """All pieces of one document go to one partition."""
    return int.from_bytes(key[0][:7], "big") + key[1]


def _documents(rows) -> Iterator[tuple[tuple, tuple, int, Iterator[str]]]:
    """From sorted pieces, for each document: its key, its record, how many rows
    it stands for, and its pieces, which must be used up before the next."""
    rows = iter(rows)
    at = next(rows, None)

    def stream(key):
        nonlocal at
        last = 0
        while at is not None and at[0][:2] == key:
            (_, _, position), piece = at
            if position != last:  # the same piece of an equal row comes next to it
                yield _unpacked(piece)
                last = position
            at = next(rows, None)

    while at is not None:
        key, record, copies = at[0][:2], at[1], 0
        while at is not None and at[0] == (*key, 0):
            copies, at = copies + 1, next(rows, None)
        yield key, record, copies, stream(key)


def assembled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              partitions: int | None = None) -> RDD:
    """Pieces ((document, repeat, position), piece), each document's in one
    partition and in output order."""
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    if partitions is None:
        size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
        partitions = max(1, -(-size // PARTITION))
    return rows.rdd.map(tuple).mapPartitions(_emit(seed)) \
        .repartitionAndSortWithinPartitions(partitions, _owner)


def examples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
             partitions: int | None = None) -> DataFrame:
    """doc_id, form, position, piece: the outputs, a row for each piece. Joined
    by position, the pieces of a document are its output."""
    def run(rows):
        for _, record, copies, parts in _documents(rows):
            for position, piece in enumerate(parts, 1):
                for _ in range(copies):
                    yield record[0], record[2], position, piece

    return docs.sparkSession.createDataFrame(
        assembled(docs, id_col, text_col, seed, partitions).mapPartitions(run),
        "doc_id long, form string, position long, piece string")


def _place(rows) -> Iterator[tuple[tuple, object]]:
    """Pieces keyed by their place in the original text, read off the output;
    last the document's record with the digests of the output and, if that is
    plain and so stands in the original order, of the text."""
    for (key, repeat), record, copies, parts in _documents(rows):
        digest, plain, part, n = hashlib.sha256(), record[2] == "plain", _PLACE["<P>"], 0
        for piece in parts:
            digest.update(piece.encode())
            if plain:
                continue
            if piece[:3] in _PLACE:
                part, n, piece = _PLACE[piece[:3]], 0, piece[3:]
            yield (key, repeat, part, n), _packed(piece)
            n += 1
        yield (key, repeat, _RECORD, 0), (copies, *record, digest.hexdigest(), digest.hexdigest() if plain else None)


def _restore(rows) -> Iterator[tuple]:
    digest = hashlib.sha256()
    for (_, _, part, _), piece in rows:
        if part != _RECORD:
            digest.update(_unpacked(piece).encode())
            continue
        copies, *row, plain = piece
        for _ in range(copies):
            yield (*row, plain or digest.hexdigest())
        digest = hashlib.sha256()


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   partitions: int | None = None) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256 of each row."""
    outputs = assembled(docs, id_col, text_col, seed, partitions)
    again = outputs.mapPartitions(_place) \
        .repartitionAndSortWithinPartitions(outputs.getNumPartitions(), _owner)
    return docs.sparkSession.createDataFrame(
        again.mapPartitions(_restore),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
        "output_sha256 string, restored_sha256 string")
