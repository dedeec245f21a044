"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of an item, or the whole item if it is
shorter. A window is a set of shingles with their places; a document holds the
window if it holds all of them at consecutive places. So:

1. One pass over the documents marks every place of a benchmark shingle.
2. The marks give each shingle's corpus frequency. A full containment must hold
   every shingle, so the necessary prefix of a window is its rarest shingle.
3. Only marks of prefix shingles meet windows, in an equi-join on the shingle.
4. A meeting fixes where the window would begin. Positional bound: enough marks
   before and after; length bound: as many as the window has, at consecutive
   places; then the shingles themselves are compared, one by one.

Shingles have ``shingle`` words (windows of fewer: as many as they have). The
windows are worked off in blocks of at most about ``block`` shingles, whose set
is part of the plan, so what goes to each task is bounded whatever the benchmark
is. Everything is DataFrame code; a document's text never leaves its scan task,
only marks do.

Cases: null and empty texts have no words, no hit, and are not contaminated; an
item without words has no window; equal windows of several items count for each;
a repeated item_id counts once; a null item_id hits words but is not counted; rows
of one doc_id are told apart by their text; empty tables give empty or hit-free
results; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import ascii_lower, written

WINDOW, SHINGLE, BLOCK = 13, 3, 50_000
#: Fixed by the task: what a word is, once A-Z are lower-cased.
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(1))


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
            id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, at (place), n (words), q (words of a shingle), text, shingles."""
    w = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    each = w.select("item_id", F.posexplode(F.expr(
        f"transform(sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window}))")).alias("at", "w"))
    n, q = F.size("w"), F.least(F.size("w"), F.lit(shingle))
    return each.select("item_id", "at", n.alias("n"), q.alias("q"), "w").select(
        "item_id", "at", "n", "q", F.array_join("w", " ").alias("text"),
        F.expr("transform(sequence(0, n - q), i -> array_join(slice(w, i + 1, q), ' '))").alias("shingles"))


#: Between words, for splitting.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _among(column: str, values: list[str]) -> str:
    # words have no quote or backslash, so they stand in quotes as they are
    return f"{column} in ({', '.join(f"'{x}'" for x in values)})" if values else "false"


def _marks(docs: DataFrame, by_size: dict[int, list[str]]) -> DataFrame:
    """doc_id, h, n_words and, for each shingle size q, m<q>: the places (pos)
    of benchmark shingles (s) in the order of the text."""
    w = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                    F.split(ascii_lower(F.coalesce("text", F.lit(""))), GAP).alias("w"))
    # a text that begins or ends with a gap has an empty first or last part
    w = w.select("*", F.expr("if(get(w, 0) = '', 1, 0)").alias("lead"),
                 F.expr("if(size(w) > 1 and get(w, size(w) - 1) = '', 1, 0)").alias("rest"))
    found = []
    for q, values in by_size.items():
        at = ", ".join(["x", *[f"get(w, i + {k})" for k in range(1, q)]])
        found.append(F.expr(
            f"filter(transform(w, (x, i) -> named_struct('pos', i - lead, 's', concat_ws(' ', {at}))), "
            f"m -> {_among('m.s', values)})").alias(f"m{q}"))
    return w.select("doc_id", "h", F.expr("size(w) - lead - rest").alias("n_words"), *found)


def _hits(marks: DataFrame, part: DataFrame, q: int) -> DataFrame:
    """doc_id, h, begin, end, text: the occurrences of windows with shingle size q."""
    part = part.where(F.col("q") == q)
    seen = marks.select(F.explode(f"m{q}.s").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    each = part.select("text", "n", "shingles", F.posexplode("shingles").alias("o", "s")).join(seen, "s", "left")
    prefix = each.groupBy("text").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "s", "o")).alias("p"),
        F.first("n").alias("n"), F.first("shingles").alias("shingles")) \
        .where("p.df > 0").select(F.col("p.s").alias("s"), F.col("p.o").alias("o"), "text", "n", "shingles")
    prefix = written(prefix, "window-prefixes")
    rare = [r.s for r in prefix.select("s").distinct().collect()]  # of one block, so bounded
    reach = part.agg(F.max(F.size("shingles"))).first()[0] or 1
    near = marks.select("doc_id", "h", F.explode(F.expr(
        f"transform(filter(transform(m{q}, (x, k) -> named_struct('s', x.s, 'pos', x.pos, 'k', k)), "
        f"x -> {_among('x.s', rare)}), "
        f"x -> named_struct('s', x.s, 'pos', x.pos, 'back', least(x.k, {reach - 1}), "
        f"'around', slice(m{q}, x.k - least(x.k, {reach - 1}) + 1, {2 * reach - 1})))")).alias("c")) \
        .select("doc_id", "h", "c.*")
    met = near.join(prefix, "s")
    m = "size(shingles)"
    run = f"slice(around, greatest(back - o, 0) + 1, {m})"
    ok = met.where("back >= o").where(f"size(around) - (back - o) >= {m}") \
        .where(f"get({run}, 0).pos = pos - o and get({run}, {m} - 1).pos = pos - o + {m} - 1") \
        .where(f"{run}.s = shingles")
    return ok.select("doc_id", "h", (F.col("pos") - F.col("o")).alias("begin"),
                     (F.col("pos") - F.col("o") + F.col("n")).alias("end"), "text")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  block: int = BLOCK, share: int = 20) -> DataFrame:
    """One row for each row of ``docs``: doc_id, h (hash of the text), n_words,
    n_hit, n_items, items (their ids as sorted strings), contaminated (a hit,
    and at least one word in ``share`` is hit)."""
    win = written(windows(items, window, shingle), "windows")
    # neighbouring windows share their shingles, so they go to one block
    run = F.struct("item_id", F.floor(F.col("at") / max(1, block // 8)).alias("k"))
    unique = win.groupBy("text").agg(F.first("n").alias("n"), F.first("q").alias("q"),
                                     F.first("shingles").alias("shingles"), F.min(run).alias("run"))
    unique = written(unique, "unique-windows")
    total = unique.select(F.explode("shingles")).distinct().count()
    blocks = -(-total // block)
    counts, hits = None if blocks else _marks(docs, {}), []
    for b in range(blocks):
        part = unique.where(F.pmod(F.xxhash64("run"), F.lit(blocks)) == b)
        by_size: dict[int, list[str]] = {}
        for r in part.select("q", F.explode("shingles").alias("s")).distinct().collect():
            by_size.setdefault(r.q, []).append(r.s)
        marks = written(_marks(docs, by_size), "marks")
        counts = marks.select("doc_id", "h", "n_words")
        hits += [_hits(marks, part, q) for q in by_size]
    if not hits:
        none = F.array().cast("array<string>")
        found = counts.withColumns({"n_hit": F.lit(0).cast("long"), "items": none})
    else:
        hit = written(reduce(DataFrame.unionByName, hits), "window-hits")
        spans = hit.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))
        n_hit = F.expr("aggregate(spans, named_struct('n', 0L, 'upto', 0), (a, x) -> named_struct("
                       "'n', a.n + greatest(x.end - greatest(x.begin, a.upto), 0), "
                       "'upto', greatest(a.upto, x.end)), a -> a.n)")
        whose = hit.select("doc_id", "h", "text").distinct() \
            .join(win.select("text", "item_id").distinct(), "text") \
            .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
        both = spans.select("doc_id", "h", n_hit.alias("n_hit")).alias("a").join(
            whose.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.h = b.h")).select("a.*", "b.items")
        found = counts.alias("c").join(
            both.alias("f"), F.expr("c.doc_id <=> f.doc_id and c.h = f.h"), "left") \
            .select("c.*", F.coalesce("f.n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("f.items", F.array().cast("array<string>")).alias("items"))
    return found.select(
        "doc_id", "h", F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = written(contamination(docs, items).where("contaminated").select("doc_id", "h").distinct(), "contaminated")
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & \
        (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("x.h"))
    return docs.alias("d").join(bad.alias("x"), same, "left_anti")
