"""Quotation linking: nested quotes, other conversations, long threads, nulls."""

import random
import re

from sparkmart.llm.quotes import conversations, threads

SCHEMA = "conv_id long, turn int, role string, text string, node string"


def test_nested_quotes_and_order(spark):
    rows = spark.createDataFrame([
        (1, 0, "u", "hello there\nfriend", "clash"), (1, 1, "v", "> hello there\nhi", None),
        (1, 2, "u", ">> hello there\n> hi\nok", None), (2, 0, "u", "> HI\nwhat", None), (2, 1, "v", None, None)],
        SCHEMA)
    got = {(r.conv_id, r.turn): r for r in conversations(rows).collect()}
    assert got[1, 1].own_text == "hi" and got[1, 1].reply_turn == 0
    assert (got[1, 2].own_text, got[1, 2].reply_turn, got[1, 2].depth, got[1, 2].deepest) == ("ok", 1, 2, 2)
    assert [got[1, t].position for t in range(3)] == [1, 2, 3]
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn, got[2, 0].depth) == (1, 1, 0)
    assert got[2, 1].own_text == "" and got[2, 1].reply_turn == 0


def test_threads_against_a_walk(spark):
    parent = {0: None, 60: None, 61: 60, 62: 60} | {k: k - 1 for k in range(1, 60)}
    got = {r.node: (r.root, r.depth) for r in threads(
        spark.createDataFrame(list(parent.items()), "node long, parent long")).collect()}

    def walk(k, n=0):
        return (k, n) if parent[k] is None else walk(parent[k], n + 1)

    assert got == {k: walk(k) for k in parent}


def test_empty(spark):
    assert conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def norm(t):
    return re.sub(r"\s+", " ", t).strip().lower()


def brute(rows):
    """reply (conversation, turn) and linked passages of each message, by the docstring."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
    parsed = []
    for conv, turn, _, text in rows:
        own, passages = [], []
        for line in re.split("\r?\n", text or ""):
            marks = re.match(r"(?:[ \t]*>)+", line)
            level = marks.group().count(">") if marks else 0
            body = re.sub(r"^(?:[ \t]*>)+[ \t]?", "", line)
            if not level:
                own.append(line)
            if passages and passages[-1][0] == level:
                passages[-1][1].append(body)
            else:
                passages.append((level, [body]))
        own = "\n".join(own).strip("\n")
        units = {norm(u) for u in [own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]} - {""}
        parsed.append((conv, turn, [norm(x) for x in own.split("\n") if norm(x)], units,
                       [(lv, b) for lv, b in passages if lv]))

    def holds(k, body):
        lines = [norm(x) for x in body if norm(x)]
        has = parsed[k][2]
        return norm(" ".join(body)) in parsed[k][3] or len(lines) > 1 and any(
            has[i:i + len(lines)] == lines for i in range(len(has)))

    out = []
    for k, (conv, turn, _, _, passages) in enumerate(parsed):
        near, any_, linked = [], [], 0
        for at, (level, body) in enumerate(passages):
            mine = [j for j in range(len(parsed)) if parsed[j][0] == conv and holds(j, body)]
            others = [j for j in range(len(parsed)) if parsed[j][0] != conv and holds(j, body)]
            source = mine[0] if mine and mine[0] < k else others[0] if others else None
            linked += source is not None
            if source is not None:
                any_.append((level, at, source))
                if mine and mine[0] < k:
                    near.append((level, at, source))
        before = k - 1 if k and parsed[k - 1][0] == conv else None
        to = min(near)[2] if near else min(any_)[2] if any_ else before
        out.append((conv, turn, None if to is None else parsed[to][0], None if to is None else parsed[to][1],
                    len(passages), linked))
    return sorted(out, key=str)


def test_linking_against_brute_force(spark):
    r = random.Random(4)
    rows, said = [], []
    for conv in range(12):
        for turn in range(6):
            own = [r.choice(["", "Yes  ok", *[f"line {r.randrange(12)}"] * 6]) for _ in range(r.randrange(1, 6))]
            quote = []
            for _ in range(r.randrange(3) if said else 0):
                lines = r.choice(said)
                i = r.randrange(len(lines))
                lines = lines[i:i + r.randrange(1, 4)]
                quote += [">" * r.randrange(1, 3) + " " + (x.upper() if r.random() < .3 else x) for x in lines] + [""]
            said.append(own)
            rows.append((conv, turn, "u", "\n".join(quote + own), None))
    got = sorted(((x.conv_id, x.turn, x.reply_conv, x.reply_turn, x.quoted, x.linked)
                  for x in conversations(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = brute([x[:4] for x in rows])
    assert got == want and sum(x[5] for x in want) > 20


def test_some_lines_of_a_paragraph_and_the_first_other_holder(spark):
    rows = spark.createDataFrame([
        (0, 0, "u", "alpha one\nbeta two\ngamma three", None), (0, 1, "v", "between", None),
        (0, 2, "u", "> alpha one\n> beta two\nyes", None), (0, 3, "u", "> alpha one\n> gamma three\nno", None),
        (1, 0, "u", "> shared\nfirst", None), (1, 1, "u", "shared", None), (2, 0, "u", "shared", None),
        (3, 0, "u", "shared", None)], SCHEMA)
    got = {(x.conv_id, x.turn): x for x in conversations(rows).collect()}
    assert (got[0, 2].reply_turn, got[0, 2].linked) == (0, 1)
    assert (got[0, 3].reply_turn, got[0, 3].linked) == (2, 0)
    assert (got[1, 0].reply_conv, got[1, 0].reply_turn) == (2, 0)


def test_repeated_turns_do_not_depend_on_the_layout(spark):
    rows = [(None, 0, "u", "q", None), (1, 0, "b", "one", None), (1, 0, "a", "two", None), (1, 0, "a", "one", None),
            (1, 0, "a", "one", None), (1, 1, "c", "> two\nx", None), (1, None, None, None, None),
            (2, 0, "u", "y\n" * 60_000, None)]
    out = []
    for parts, order in ((1, rows), (5, rows[::-1])):
        d = spark.createDataFrame(order, SCHEMA).repartition(parts)
        out.append(sorted((tuple(x) for x in conversations(d).collect()), key=str))
    assert out[0] == out[1] and len(out[0]) == len(rows)
