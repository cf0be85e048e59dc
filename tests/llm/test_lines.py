"""Line dedup against brute force."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def by_hand(rows, rule):
    """Kept text and number of dropped lines of each (doc_id, text), over all of them."""
    held = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None:
                held[lower(line.strip(SPACE))].add(doc)
    found = []
    for doc, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            key = lower(line.strip(SPACE))
            shared = len(key) >= rule.least_chars and len(held[key]) >= rule.least_documents
            if doc is None or not shared or doc == max(held[key]):
                kept.append(line)
        found.append(("\n".join(kept), (text or "").count("\n") + 1 - len(kept)))
    return found


def result(df, rule):
    marked = lines.keep_bitmaps(df, rule, kept_sha256="sha")
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.sha) for r in marked.collect())


@pytest.fixture
def many_partitions(spark):
    """Partitions are neither joined nor few, so that hashes lie across their ends."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_shared_lines_stay_in_the_last_document_only(spark, many_partitions):
    random.seed(11)
    some = ["ab" * 4, "AB" * 4 + " ", "\t" + "ab" * 4 + "\r", "é" * 8, "É" * 8, "é" * 7 + "x", "short", "", "  ", "x\x1cx" * 3]
    some += ["a third of all lines"] * 6 + [f"rare line {i}" for i in range(60)]
    rows = [(random.choice([None, *range(40)]), "\n".join(random.choices(some, k=random.randrange(1, 12)))) for _ in range(150)]
    rows += [(7, None), (8, ""), (9, "\n\n"), (50, "ab" * 4)] + [(51, "a third of all lines\n" * 30)] * 5
    for least in (1, 5):
        rule = lines.Rule(least_chars=8, least_documents=least)
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
        want = []
        for (doc, text), (kept, n) in zip(rows, by_hand(rows, rule)):
            want.append((doc is None, doc or 0, (text or "").count("\n") + 1, n, hashlib.sha256(kept.encode()).hexdigest()))
        assert result(df, rule) == sorted(want)
        assert sum(n for *_, n, _ in want) > 100


def test_one_line_in_every_document_is_spread(spark, many_partitions):
    """A hash that fills many partitions, documents that straddle their ends included."""
    line = "the same line in each of these documents, all of them"
    rows = [(i, "\n".join([line] * (1 + i % 7 * 5))) for i in range(3_000)]
    places = lines.repeated(spark.createDataFrame(rows, "doc_id bigint, text string"))
    order = [F.col("doc").desc(), F.col("line")]
    assert {r.doc for r in places.select("doc").distinct().collect()} == set(range(2_999))
    assert places.count() == sum(1 + i % 7 * 5 for i in range(2_999)) and places.orderBy(*order).first().doc == 2_998


def test_bitmaps_give_back_the_lines(spark):
    random.seed(12)
    for n in [1, 2, 127, 128, 129, 20_000]:
        for share in (0, 0.1, 0.9, 1):
            dropped = [i for i in range(n) if random.random() < share]
            assert lines.unpack(lines.pack(n, dropped)) == [i not in set(dropped) for i in range(n)]
    assert len(lines.pack(10**6, [])) == 3
    long = "a line of more than forty characters, which is shared by all"
    rows = [(i, f"own {i}\n{long}\nend") for i in range(6)] + [(9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = lines.keep_bitmaps(df)
    assert marked.columns == ["doc_id", "n_lines", "n_dropped", "keep"]
    texts = lines.apply(df.join(marked, "doc_id")).select("doc_id", "text").collect()
    assert {r.doc_id: r.text for r in texts} == {**{i: f"own {i}\nend" for i in range(5)}, 5: rows[5][1], 9: None}


def test_awkward_rows_and_clashing_columns(spark):
    long = "word, " * 40_000
    rows = [(i, long, "x", 1, 2, "row") for i in range(5)] + [(2, long, "x", 1, 2, "row"), (None, long, None, None, None, None), (3, None, "", 0, 0, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, keep string, doc int, version int, row string")
    got = lines.keep_bitmaps(df).collect()
    assert set(got[0].asDict()) == {"doc_id", "doc", "version", "row", "n_lines", "n_dropped", "keep"}
    assert sorted((r.doc_id or -1, r.n_dropped) for r in got) == [(-1, 0), (-1, 1), (1, 1), (2, 1), (2, 1), (3, 0), (3, 1), (4, 0)]
    assert lines.keep_bitmaps(df.limit(0)).count() == 0
