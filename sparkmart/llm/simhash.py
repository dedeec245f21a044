"""Near-duplicates by SimHash fingerprints and pigeonhole blocks.

A document's words (runs without ASCII white space, A-Z lower-cased) give
shingles of ``words`` words, repeats included; a bit of the fingerprint is set
if more than half of the shingles' XXH64 values have it. Fewer words than a
shingle give one value, of all of them; no words give the fingerprint zero,
which links like any other.

Two fingerprints at ``distance`` bits or less, cut into ``blocks`` blocks, agree
in at least ``blocks - distance`` of them. So every fingerprint is joined on
each choice of that many blocks, and each pair that meets is verified. Equal
fingerprints are one node from the start, so copies never meet as pairs. A block
value with more than ``tile`` fingerprints is dealt out over pairs of tiles;
each tile pair is compared in one task and yields a spanning forest of its links
(the same components, without all pairs).

Six blocks give 20 joins on 32 bits: chance meetings stay few up to some 10^8
distinct fingerprints; beyond that take seven or eight blocks (35 or 56 joins on
36 or 40 bits). The result is the same for any number of blocks.

Cases: a null text counts as the empty text; repeated rows share a fingerprint;
a null doc_id takes part but is never a component's smallest unless all are
null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written
from sparkmart.llm.components import components

WORDS, DISTANCE, BLOCKS, SEED = 3, 3, 6, 42
#: Most fingerprints of one block value that are joined as they are.
TILE = 512
#: Shingles whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as an unsigned integer."""
    import numpy as np
    import xxhash
    tokens = (text or "").encode("utf-8").lower().split()  # bytes: ASCII only
    if not tokens:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        h = np.fromiter((digest(join(tokens[i:i + words]), SEED) for i in range(at, min(n, at + STEP))), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) of each row."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def _masks(blocks: int, distance: int) -> list[int]:
    """A signed 64-bit mask for each choice of blocks that a close pair may share."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for chosen in combinations(range(blocks), blocks - distance):
        m = sum(((1 << edge[i + 1]) - (1 << edge[i])) for i in chosen)
        out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def _forest(fps, distance: int):
    """Links that join the same fingerprints as all close pairs of ``fps`` do."""
    import numpy as np
    fps = np.unique(fps)
    bits = fps.view(np.uint64)
    left, above = list(range(len(fps))), []

    def root(i: int) -> int:
        while left[i] != i:
            left[i] = left[left[i]]
            i = left[i]
        return i

    for i in range(len(fps) - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= distance) + i + 1
        for j in near.tolist():
            x, y = root(i), root(j)
            if x != y:
                left[y] = x
                above.append((fps[i], fps[j]))
    return above


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints of ``fps`` (column
    ``fp``): every close pair, or within a crowded block value a spanning forest."""
    masks = _masks(blocks, distance)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for c, m in enumerate(masks)])).alias("x")).select("x.c", "x.k", "fp")
    crowded = written(keyed.groupBy("c", "k").agg(F.count("*").alias("n")).where(F.col("n") > tile), "crowded")
    few = keyed
    found = None
    if not crowded.isEmpty():
        few = keyed.join(crowded.select("c", "k"), ["c", "k"], "left_anti")
        dealt = keyed.join(crowded, ["c", "k"]) \
            .withColumn("tiles", F.ceil(F.col("n") / tile)) \
            .withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles"))) \
            .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))) \
            .select("c", "k", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "fp")

        def compare(pdf):
            import pandas as pd
            pairs = _forest(pdf["fp"].to_numpy(), distance)
            return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

        found = dealt.groupBy("c", "k", "i", "j").applyInPandas(compare, "a long, b long")
    other = few.select("c", "k", F.col("fp").alias("other"))
    close = (F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
    pairs = few.join(other, ["c", "k"]).where(close) \
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    return (pairs if found is None else pairs.unionByName(found)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of ``docs``."""
    each = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-nodes")
    labels = components(links(nodes.select("fp"), distance, blocks, tile))
    member = written(nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", "least", F.coalesce("label", "fp").alias("label")), "fp-members")
    smallest = member.groupBy("label").agg(F.min("least").alias("component_id"))
    of = written(member.join(smallest, "label").select("fp", "component_id"), "fp-components")
    return each.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The row with the smallest doc_id of each component, with its columns. A
    doc_id names one document; of rows that repeat it with one text, one stays."""
    found = written(near_duplicates(docs, words=words, distance=distance), "near-duplicates")
    ids = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("doc_id").agg(F.count("*").alias("_rows"))
    kept = docs.join(ids.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    if not ids.where("_rows > 1").isEmpty():  # an id that several rows bear: one of them stays
        kept = kept.where("_rows = 1").unionByName(kept.where("_rows > 1").dropDuplicates(["_id", "text"]))
    return kept.select(*docs.columns)
