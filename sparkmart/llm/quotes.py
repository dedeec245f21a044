"""Conversations without quotes, linked and ordered by what they reply to.

A line that begins with marks (``>``, blanks allowed between them) is quoted, as
deep as it has marks; consecutive lines of one depth are a passage. What is left
of a message is its own text. Quoted passages are normalised (lower case, white
space collapsed), hashed and joined to the hashes of messages. A message holds a
passage if that is its own text, one of its paragraphs or one of its lines (line
breaks may differ), or if the passage's lines, blank ones aside, stand one after
the other among its own. A passage links to the earliest message of its own
conversation that holds it, if that comes before; else to the first other
conversation that does.

A message replies to the source of its outermost linked passage in its own
conversation, else to the message before it. Replies form threads: a thread
begins with a message that replies to none, and ``depth`` counts the replies
from there. In reply order a conversation's messages go by thread, then by turn,
so each comes after the one it replies to.

Every message is numbered once, over all conversations, in ranges of (conv_id,
turn): no task holds a whole conversation, and all walks over replies join on
that number, which is unique. Walks double their reach each round. Messages are
grouped by hash before quotes meet them, so a line that a third of them share is
one row. Runs of lines are hashed only where a quoted passage's first line stands,
and only in the lengths that passages with that first line have.

Cases: a null text is an empty one; an empty quoted passage links to nothing;
rows that repeat a turn are messages of their own, by role and the text's digest; a
null conv_id is a conversation like any other; a very long text is a row like any
other, its lines apart in rows; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written
from sparkmart.operators.ordering import with_position

#: The marks before a quoted line.
MARKS = "^((?:[ \\\\t]*>)+)"


def _normal(text: str) -> str:
    return f"lower(trim(regexp_replace({text}, '\\\\s+', ' ')))"


def _hash(text: str) -> str:
    return f"sha2({_normal(text)}, 256)"


def _line_hashes(lines: str) -> str:
    return f"transform(filter({lines}, x -> {_normal('x')} <> ''), x -> {_hash('x')})"


def _run(lines: str) -> Column:
    """The hash of lines one after the other."""
    return F.expr(f"sha2(concat('run:', array_join({lines}, ',')), 256)")


def parse(messages: DataFrame) -> DataFrame:
    """``messages`` with own_text (without quotes), own_lines (their hashes, without
    blank ones) and passages: level, hash, lines (hashes, without blank ones)."""
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")
    # runs of one level: where the level changes, and the end
    edges = F.expr("filter(sequence(0, size(lines)), i -> i = 0 or i = size(lines) "
                   "or get(lines, i).level <> get(lines, i - 1).level)")
    bodies = "slice(lines, edges[k] + 1, edges[k + 1] - edges[k]).body"
    passage = "struct(get(lines, edges[k]).level as level, {h} as hash, {l} as lines)".format(
        h=_hash(f"array_join({bodies}, ' ')"), l=_line_hashes(bodies))
    return messages.withColumn("l", lines) \
        .withColumn("lines", F.expr(
            f"transform(l, x -> struct(length(regexp_replace(regexp_extract(x, '{MARKS}', 1), '[^>]', '')) as level, "
            f"regexp_replace(x, '{MARKS}[ \\\\t]?', '') as body))")) \
        .withColumn("edges", edges) \
        .withColumn("own_text", F.expr("trim(BOTH '\n' FROM array_join(filter(lines, x -> x.level = 0).body, '\n'))")) \
        .withColumn("own_lines", F.expr(_line_hashes("split(own_text, '\n')"))) \
        .withColumn("passages", F.expr(
            f"filter(transform(sequence(0, size(edges) - 2), k -> {passage}), p -> p.level > 0)")) \
        .drop("l", "lines", "edges")


def _units(own_text: str) -> Column:
    """Hashes under which a message can be quoted."""
    return F.expr(
        f"array_distinct(transform(filter(concat(array({own_text}), split({own_text}, '\n[ \\\\t]*\n'), "
        f"split({own_text}, '\n')), x -> {_normal('x')} <> ''), x -> {_hash('x')}))")


def _runs(messages: DataFrame, asked: DataFrame) -> DataFrame:
    """node, conv_id, hash: runs of a message's lines that may be asked for."""
    firsts = asked.where("size(lines) > 1") \
        .groupBy(F.expr("lines[0]").alias("first")).agg(F.collect_set(F.size("lines")).alias("lengths"))
    starts = messages.select("node", F.size("own_lines").alias("n"), F.posexplode("own_lines").alias("pos", "first")) \
        .join(firsts, "first").select("node", "pos", "n", F.explode("lengths").alias("length")) \
        .where("pos + length <= n")
    return starts.join(messages.select("node", "conv_id", "own_lines"), "node") \
        .select("node", "conv_id", _run("slice(own_lines, pos + 1, length)").alias("hash"))


def _sources(messages: DataFrame, asked: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The holders of the hashes that are asked for: the earliest in each
    conversation, and the first messages of the first two conversations."""
    held = messages.select("node", "conv_id", F.explode(_units("own_text")).alias("hash")) \
        .unionByName(_runs(messages, asked)) \
        .join(keys.select("hash").distinct(), "hash", "left_semi")
    near = written(held.groupBy("hash", "conv_id").agg(F.min("node").alias("source")), "quote-sources")
    one = F.min(F.struct("source", "conv_id"))
    first = near.groupBy("hash").agg(one.alias("a"))
    second = near.join(first, "hash").where("source <> a.source").groupBy("hash").agg(one.alias("b"))
    return near, first.join(second, "hash", "left")


def link(messages: DataFrame) -> DataFrame:
    """node, at, level, source (a node or null), same (of the node's conversation):
    one row for each quoted passage of ``messages`` (node, conv_id, own_text,
    own_lines, passages)."""
    empty = F.expr(_hash("''"))
    asked = messages.select("node", "conv_id", F.posexplode("passages").alias("at", "p")) \
        .select("node", "conv_id", "at", "p.level", "p.hash", "p.lines")
    asked = written(asked, "quoted-passages")
    keys = asked.select("node", "conv_id", "at", "level", F.explode(F.array_compact(F.array(
        F.when(F.col("hash") != empty, F.col("hash")),
        F.when(F.size("lines") > 1, _run("lines"))))).alias("hash"))
    near, far = _sources(messages, asked, keys)
    q, n = keys.alias("q"), near.alias("n")
    own = q.join(n, (F.col("q.hash") == F.col("n.hash")) & F.col("q.conv_id").eqNullSafe(F.col("n.conv_id"))
                 & (F.col("n.source") < F.col("q.node")), "left") \
        .select("q.*", F.col("n.source").alias("near")).alias("o")
    other = F.when(~F.col("f.a.conv_id").eqNullSafe(F.col("o.conv_id")), F.col("f.a.source")) \
        .otherwise(F.col("f.b.source"))
    found = own.join(far.alias("f"), F.col("o.hash") == F.col("f.hash")) \
        .groupBy("o.node", "o.at").agg(F.min("o.near").alias("near"), F.min(other).alias("other"))
    return asked.select("node", "at", "level").join(found, ["node", "at"], "left") \
        .select("node", "at", "level", F.coalesce("near", "other").alias("source"),
                F.col("near").isNotNull().alias("same"))


def threads(replies: DataFrame) -> DataFrame:
    """node, root, depth from node, parent (null: begins a thread). Each round
    doubles the reach of those messages only that have not come to a root."""
    walk = written(replies.select("node", F.coalesce("parent", "node").alias("root"),
                                  F.col("parent").isNotNull().cast("long").alias("depth"),
                                  F.col("parent").isNotNull().alias("open")), "replies")
    while not walk.where("open").isEmpty():
        up = walk.select(F.col("node").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"),
                         F.col("open").alias("_open"))
        moved = walk.where("open").join(up, "root").select(
            "node", F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"),
            F.col("_open").alias("open"))
        walk = written(walk.where("not open").unionByName(moved), "replies")
    return walk.drop("open")


def conversations(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, turn, role, position (in reply order,
    from 1), own_text, reply_conv, reply_turn (what it replies to), depth,
    quoted (passages), linked (passages with a source), deepest (quote level)."""
    rows = messages.select("conv_id", "turn", "role", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_text"),
                           F.monotonically_increasing_id().alias("_row"))
    each = with_position(rows, [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"),
                                F.col("_text"), F.col("_row")], "node")
    m = written(parse(each).drop("text", "_text", "_row"), "messages")
    quoted = written(link(m), "quote-links")
    about = quoted.groupBy("node").agg(
        F.count("*").alias("quoted"), F.count("source").alias("linked"), F.max("level").cast("long").alias("deepest"),
        F.min(F.when(F.col("same"), F.struct("level", "at", "source")))["source"].alias("to_own"),
        F.min(F.when(F.col("source").isNotNull(), F.struct("level", "at", "source")))["source"].alias("to_any"))
    earlier = m.select((F.col("node") + 1).alias("node"), F.col("conv_id").alias("_conv"), F.col("node").alias("_before"))
    r = m.join(earlier, "node", "left").join(about, "node", "left") \
        .withColumn("_before", F.when(F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("_before"))) \
        .withColumn("parent", F.coalesce("to_own", "_before")).withColumn("shown", F.coalesce("to_own", "to_any", "_before"))
    r = written(r.drop("_conv", "passages", "own_lines", "to_own", "to_any"), "linked-messages")
    walk = threads(r)
    ordered = with_position(r.select("node", "conv_id").join(walk, "node"),
                            [F.asc_nulls_first("conv_id"), "root", "node"], "place")
    ordered = written(ordered.select("node", "conv_id", "depth", "place"), "reply-order")
    first = ordered.groupBy("conv_id").agg(F.min("place").alias("first"))
    spot = ordered.alias("o").join(first.alias("f"), F.expr("o.conv_id <=> f.conv_id")) \
        .select("o.node", "o.depth", (F.col("o.place") - F.col("f.first") + 1).alias("position"))
    to = m.select(F.col("node").alias("shown"), F.col("conv_id").alias("reply_conv"), F.col("turn").alias("reply_turn"))
    zero = F.lit(0).cast("long")
    return r.join(spot, "node").join(to, "shown", "left").select(
        "conv_id", "turn", "role", "position", "own_text", "reply_conv", "reply_turn", "depth",
        F.coalesce("quoted", zero).alias("quoted"), F.coalesce("linked", zero).alias("linked"),
        F.coalesce("deepest", zero).alias("deepest"))
