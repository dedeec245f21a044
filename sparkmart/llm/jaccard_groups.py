"""N-gram Jaccard join over a token-group matrix.

A document's set holds the 64-bit hashes of its distinct shingles. Two documents
link when their sets' Jaccard similarity reaches ``PERCENT``; the result is each
document's component under these links. Equal sets are one node from the start.

1. *Who can link at all.* Sets that link share at least 80 % of each one's
   shingles, so of the first shingles of a set in any common order (here: by hash)
   a known number must occur in another set's first ones as well. One window
   over these few shingles leaves the sets for which that holds.
2. *Groups of similar documents.* Sets with an equal min-hash meet the most
   typical of them (the one with the most common shingles: of near copies, the
   text they were made from) and link to it if the similarity, worked out in full,
   allows. What hangs together is cut by size into groups of at most ``TILE``
   members; documents of small components are grouped by a min-hash. However
   many near copies there are, most are one component from here on, and no
   document is held against others of its own.
3. *Token-group matrix.* Each group's union of shingles is stored. A document asks
   only groups that hold one of its rarest shingles (those that a partner cannot
   do without) among their own rarest, fit in length, and have a member of a larger
   component; a shingle all of whose holders are linked is asked by nobody. If the
   document's overlap with a group's union is too small for its own length or
   for that of the shortest member, no member can link, and the group stays shut.
4. *Opened groups.* Each member is compared in full; components are joined up.

The order of rarity comes from a sketch of fixed size (``SLOTS`` counters); it
decides how many groups are asked, never what is found. The joins on min-hash,
shingle and group are Spark's; skewed ones are split by its skew join.

Cases: a null text and one without words have the empty set and link with
nothing, each its own component; a text of fewer words than a shingle has one
shingle, of all of them; texts of any length are taken whole; rows that repeat a
text are linked; rows that repeat a doc_id are one document to the links; a null
doc_id links nothing, and its row's component is that of the equal sets with an
id, else null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import written
from sparkmart.llm.components import components

WORDS, PERCENT = 5, 80
#: One of so many shingles, beyond those a partner may lack, is looked at first.
FIRST = 10
#: Min-hashes of a set.
KEYS = 4
#: Most members of a group and, but for one large member, most shingles.
TILE, TILE_TOKENS = 32, 1 << 17
#: Counters of the sketch that orders shingles by rarity.
SLOTS = 1 << 20
#: Most rows of ids that go to every task; more are joined by a shuffle.
BROADCAST = 100_000
#: Words whose hashes a worker remembers before it starts anew.
MEMO = 200_000

_MIX = 0x9E3779B97F4A7C15


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@functools.lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def _mixed(h):
    import numpy as np
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS):
    """The set of a text, as sorted signed 64-bit hashes."""
    import numpy as np
    found = (text or "").encode("utf-8").lower().split()  # bytes: ASCII only
    if not found:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_words().__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    each = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        each = each * np.uint64(_MIX) + h[i:i + len(each)]
    return np.unique(_mixed(each).view(np.int64))


def shared_at_least(n: Column | int, percent: int = PERCENT):
    """Shingles of a set of ``n`` that any partner has."""
    return F.ceil(n * percent / 100) if isinstance(n, Column) else -(-n * percent // 100)


def _first(n: int, percent: int) -> tuple[int, int]:
    """How many first shingles of a set of ``n`` are looked at, and how many of
    them occur among another set's if the two link (of the smaller set's count
    this is at most as much, so both sides look at enough)."""
    return n - shared_at_least(n, percent) + max(1, n // FIRST), max(1, n * percent // (100 * FIRST))


def _min_hashes(tokens) -> list[int]:
    import numpy as np
    u = tokens.view(np.uint64)
    return [int(_mixed(u + np.uint64(i * 0x632BE59BD9B4E019 % (1 << 64))).min().view(np.int64))
            for i in range(1, KEYS + 1)]


def _each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, hi, lo (a hash of the set in 128 bits), first (its first
    shingles, once for equal sets of a task) and needed (how many must occur
    elsewhere)."""
    def run(batches):
        import pyarrow as pa
        import xxhash
        met = set()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                s = shingles(text.as_py(), words)
                d = xxhash.xxh128_intdigest(s.tobytes())
                first, needed = _first(len(s), percent) if len(s) else (0, 0)
                rows.append((len(s), (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63),
                             s[:0 if d in met else first], needed))
                met.add(d)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                names=["doc_id", "n", "hi", "lo", "first", "needed"])

    return docs.mapInArrow(run, "doc_id long, n long, hi long, lo long, first array<long>, needed long")


def _may_link(each: DataFrame) -> DataFrame:
    """``hi`` of the sets of which enough first shingles occur in another set.
    The shingles, most of what the query shuffles, are dealt by token once."""
    rows = each.select("hi", F.explode("first").alias("token"))
    of = Window.partitionBy("token")
    shared = rows.select("hi", F.min("hi").over(of).alias("a"), F.max("hi").over(of).alias("b")).where("a <> b")
    count = shared.groupBy("hi").agg(F.count("*").alias("c"))
    need = each.groupBy("hi").agg(F.min("needed").alias("needed"))
    return count.join(need, "hi").where("c >= needed").select("hi")


def _sent(rows: DataFrame) -> DataFrame:
    """``rows``, a written table of few bytes a row, for a join: sent to every task
    if they are few, else joined by a shuffle."""
    return F.broadcast(rows) if rows.limit(BROADCAST + 1).count() <= BROADCAST else rows


def _kept(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among ``ids``, a written table without repeats."""
    return rows.join(_sent(ids), key, "left_semi")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, keys (min-hashes), tokens of each document."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            sets = [shingles(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_min_hashes(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                 pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "n", "keys", "tokens"])

    return docs.mapInArrow(run, "doc_id long, n long, keys array<long>, tokens array<long>")


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b`` of the pairs whose sets ``x`` and ``y`` are similar enough."""
    both = pairs.withColumn("both", F.size(F.array_intersect("x", "y")))
    return both.where(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of documents whose sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    return _similar(pairs.join(left, "a").join(right, "b"), percent)


def _sketch(sets: DataFrame):
    """How often shingles fall into each slot, over all sets."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            tokens = batch.column(0).flatten().to_numpy()
            total += np.bincount(tokens & (SLOTS - 1), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    found = sets.select("tokens").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table, out = found.toArrow(), np.zeros(SLOTS, np.int64)  # at most SLOTS rows
    out[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return np.minimum(out, (1 << 31) - 1).astype(np.int32)


def _typical(sets: DataFrame, sketch) -> DataFrame:
    """doc_id, n, keys, typical: the mean logarithm of how common a set's shingles
    are by the sketch (a broadcast)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        common = np.log2(1.0 + sketch.value)
        for batch in batches:
            out = [float(common[s.values.to_numpy() & (SLOTS - 1)].mean()) for s in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.float64())],
                                             names=["doc_id", "n", "keys", "typical"])

    return sets.select("doc_id", "n", "keys", "tokens") \
        .mapInArrow(run, "doc_id long, n long, keys array<long>, typical double")


def _stars(sets: DataFrame, sketch, percent: int) -> DataFrame:
    """Links ``a``, ``b`` of documents with the most typical that shares a min-hash."""
    keyed = _typical(sets, sketch).select("doc_id", "n", "typical", F.posexplode("keys").alias("i", "key"))
    leader = keyed.groupBy("i", "key").agg(F.max(F.struct("typical", "doc_id", "n")).alias("m"), F.count("*").alias("c")) \
        .where("c > 1").select("i", "key", F.col("m.doc_id").alias("b"), F.col("m.n").alias("bn"))
    pairs = keyed.join(leader, ["i", "key"]) \
        .where((F.col("doc_id") != F.col("b"))
               & (100 * F.least("n", "bn") >= percent * F.greatest("n", "bn"))) \
        .select(F.col("doc_id").alias("a"), "b").distinct()
    return _verified(pairs, sets, percent)


def _grouped(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """``sets`` with label (component so far), size (of it) and gid, the group: the
    smallest doc_id among members of about one length that are of one large
    component or share a min-hash."""
    small = sets.select("doc_id", "n", F.element_at("keys", 1).alias("key")) \
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .select("doc_id", "n", "key", F.coalesce("label", "doc_id").alias("label"),
                F.floor(F.log("n") / F.log(F.lit(1.1))).alias("band"))
    sizes = small.groupBy("label").agg(F.count("*").alias("size"))
    small = small.join(sizes, "label")
    large = F.col("size") >= TILE
    small = written(small.select("doc_id", "n", "label", "size", "band", large.alias("large"),
                                 F.when(large, F.col("label")).otherwise(F.col("key")).alias("home")), "jaccard-labels")
    of_home = ["large", "home", "band"]
    tiles = small.groupBy(*of_home).agg(
        F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_TOKENS)).alias("tiles"))
    dealt = small.join(tiles, of_home).withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")))
    groups = dealt.groupBy(*of_home, "tile").agg(F.min("doc_id").alias("gid"))
    of = dealt.join(groups, [*of_home, "tile"]).select("doc_id", "label", "size", "gid")
    return sets.drop("keys").join(_sent(written(of, "jaccard-groups")), "doc_id")


def _rarest(members: DataFrame, sketch, percent: int) -> DataFrame:
    """doc_id, n, label, size, gid and each of the rarest shingles of which any
    partner shares one."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        order = sketch.value
        for batch in batches:
            out = []
            for s in batch.column(5):
                s = s.values.to_numpy()
                by = np.lexsort((s, order[s & (SLOTS - 1)]))
                out.append(s[by[:len(s) - shared_at_least(len(s), percent) + 1]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.list_(pa.int64()))],
                                             names=["doc_id", "n", "label", "size", "gid", "tokens"])

    rare = members.select("doc_id", "n", "label", "size", "gid", "tokens") \
        .mapInArrow(run, "doc_id long, n long, label long, size long, gid long, tokens array<long>")
    return rare.select("doc_id", "n", "label", "size", "gid", F.explode("tokens").alias("token"))


def _held(members: DataFrame, sketch, percent: int) -> DataFrame:
    """The rows of ``_rarest`` of shingles with holders in more than one component,
    with own and top: the document's and the largest component among the holders.
    The shingles are dealt by token once, and few of them are left."""
    of, by = Window.partitionBy("token"), F.struct("size", "label")
    rare = _rarest(members, sketch, percent)
    return rare.select("token", "doc_id", "n", "gid", by.alias("own"), F.max(by).over(of).alias("top"),
                       F.min(by).over(of).alias("low")).where("top <> low").drop("low")


def _asked(members: DataFrame, sketch, percent: int) -> DataFrame:
    """Pairs ``doc_id``, ``gid``: the groups a document has to be held against.
    Of two components the smaller one asks (of equal ones that with the smaller
    label), so a document asks groups with a member of a larger component."""
    held = written(_held(members, sketch, percent), "jaccard-held")
    groups = members.groupBy("gid").agg(F.min("n").alias("short"), F.max("n").alias("long"),
                                        F.max(F.struct("size", "label")).alias("of"))
    matrix = held.select("token", "gid").distinct().join(groups, "gid")
    asking = held.where("own <> top").select("token", "doc_id", "n", "own")
    fits = (F.col("own") < F.col("of")) & (100 * F.col("long") >= percent * F.col("n")) \
        & (percent * F.col("short") <= 100 * F.col("n"))
    return asking.join(matrix, "token").where(fits).select("doc_id", "gid").distinct()


def _opened(members: DataFrame, asked: DataFrame, percent: int) -> DataFrame:
    """``asked`` without the groups that stay shut, with the document's n, label
    and tokens."""
    unions = members.join(asked.select("gid").distinct(), "gid", "left_semi") \
        .groupBy("gid").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"),
                            F.min("n").alias("short"))
    own = members.select("doc_id", "n", "label", "tokens")
    # a member shares at most the overlap with the union and has at least the shortest's length
    enough = (100 + percent) * F.size(F.array_intersect("tokens", "union")) >= percent * (F.col("n") + F.col("short"))
    return _sent(asked).join(own, "doc_id").join(unions, "gid") \
        .where(enough & (F.size(F.array_intersect("tokens", "union")) >= shared_at_least(F.col("n"), percent))) \
        .select("doc_id", "gid", "n", "label", "tokens")


def _found(members: DataFrame, sketch, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between documents of different components so far. A
    document's set goes to each group it opens once, not to each of its members."""
    asked = written(_asked(members, sketch, percent), "jaccard-asked")
    opened = written(_opened(members, asked, percent), "jaccard-opened")
    left = opened.select("gid", F.col("doc_id").alias("a"), F.col("n").alias("an"), F.col("label").alias("al"),
                         F.col("tokens").alias("x"))
    right = _kept(members, written(opened.select("gid").distinct(), "jaccard-opened-groups"), "gid") \
        .select("gid", F.col("doc_id").alias("b"), F.col("n").alias("bn"), F.col("label").alias("bl"),
                F.col("tokens").alias("y"))
    pairs = left.join(right, "gid") \
        .where((F.col("al") != F.col("bl")) & (100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")))
    return _similar(pairs, percent)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
           percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    each = written(_each(texts, words, percent), "jaccard-each")
    nodes = each.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes, "jaccard-nodes")
    may = nodes.where("node IS NOT NULL").join(_may_link(each), "hi", "left_semi").select(F.col("node").alias("doc_id"))
    may = written(may.distinct(), "jaccard-may-link")
    sets = written(_sets(_kept(texts, may, "doc_id"), words).where("n > 0"), "jaccard-sets")
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(sets))  # of fixed size
    stars = written(_stars(sets, sketch, percent), "jaccard-stars")
    members = written(_grouped(sets, components(stars)), "jaccard-members")
    # rounds read their links more than once
    labels = components(written(stars.unionByName(_found(members, sketch, percent)), "jaccard-links"))
    of = nodes.join(labels, "node", "left").select("hi", "lo", F.coalesce("label", "node").alias("label"))
    return each.join(of, ["hi", "lo"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("doc_id")).alias("component_id"))
