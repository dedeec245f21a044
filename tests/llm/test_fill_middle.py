"""Fill-in-the-middle against a version that holds each text whole."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import fill_middle


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain(doc_id, text):
    """The row and the output, by strings alone."""
    text = text or ""
    units = re.findall("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, _sha(text), _sha(text)), text
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(units), form, len(p), len(m), _sha(out), _sha(text)), out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def _texts():
    rng = random.Random(5)
    words = ["a", "straße", "日本", "x y", "<P", ">", "<S><M", "\U0001f600", "P>", "<"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t\x0b", ""])
                        for _ in range(rng.randint(0, 60)))) for i in range(120)]
    return rows + [(1000, None), (1001, ""), (1002, " \n "), (1003, "x <P> y"), (1004, " lead"), (1005, "<M>")]


def test_against_whole_texts(docs):
    rows = _texts()
    got = fill_middle.fill_in_middle(docs(rows), partitions=3)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    found = _sorted(got.collect())
    assert found == _sorted(_plain(i, t)[0] for i, t in rows)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_outputs_join_to_the_text(docs):
    rows = _texts()
    joined: dict[int, str] = {}
    for r in fill_middle.examples(docs(rows), partitions=2).orderBy("doc_id", "position").collect():
        joined[r.doc_id] = joined.get(r.doc_id, "") + r.piece
    assert joined == {i: out for i, t in rows if (out := _plain(i, t)[1])}


def test_long_texts_come_in_bounded_pieces(docs):
    rows = [(1, "word " * 60_000), (2, "x" * 300_000), (3, " " * 200_000), (6, "ab\n" * 9_000 + "y" * 70_000)]
    assert _sorted(fill_middle.fill_in_middle(docs(rows)).collect()) == _sorted(_plain(i, t)[0] for i, t in rows)
    longest = fill_middle.examples(docs(rows)).agg(F.max(F.length("piece"))).first()[0]
    assert longest <= fill_middle.SPAN + 3


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_rows_and_null_ids(docs, parts):
    rows = [(7, "one two three")] * 9 + [(7, "other text here")] * 2 + [(None, "no id at all")] * 3 + [(8, None)] * 2
    got = fill_middle.fill_in_middle(docs(rows).repartition(parts), partitions=3).collect()
    assert _sorted(got) == _sorted(_plain(i, t)[0] for i, t in rows)


def test_empty_table_and_clashing_columns(spark, docs):
    assert fill_middle.fill_in_middle(docs([])).collect() == []
    clash = spark.createDataFrame([(5, "a b c", 1, "f", 2, "s")],
                                  "doc_id long, text string, n int, form string, position int, piece string")
    assert [tuple(r) for r in fill_middle.fill_in_middle(clash).collect()] == [_plain(5, "a b c")[0]]


def test_a_repeated_map_task_sends_the_same_keys():
    rows = [(1, "a b"), (2, "c d"), (1, "a b")]
    emit = fill_middle._emit(42)
    assert sorted(emit(rows), key=repr) == sorted(emit(rows[::-1]), key=repr)
