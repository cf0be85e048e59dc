"""The text operators against brute force, and on awkward rows."""

import base64
import collections
import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import bpe, compression, decontam, extract, pii, setsketch, shards, spans, toxicity, warc
from barloom.llm import queries as q

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = "word, " * 40_000

#: Null, empty, very long, repeated and tied rows, with columns whose names clash.
AWKWARD = [
    (1, "one two three four", "a"), (1, "one two three four", "a"), (2, None, None), (3, "", "b"),
    (None, "one two three four", "c"), (None, None, None), (4, " \n\t ", "d"), (5, LONG, "e"), (6, LONG, "f"),
]
COLUMNS = "doc_id bigint, text string, kept string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in q.table(spark, MEDIUM, "documents").collect()}


@pytest.mark.parametrize("name", q.ORACLES)
def test_matches_sql(spark, name):
    assert oracle.differences(q.QUERIES[name](spark, MEDIUM), oracle.connect(MEDIUM), q.ORACLES[name]) == []


# near-duplicates


def test_register_estimate_is_close_to_the_similarity():
    drawn = setsketch.coefficients(1024)
    generator = np.random.default_rng(1)
    for shared in (0, 300, 900):
        own = generator.integers(0, 2**63, 2000 - shared, dtype=np.uint64)
        a, b = own[:1000], np.concatenate([own[1000 - shared : 1000], own[1000:]])
        left, right = setsketch.registers(a, drawn), setsketch.registers(b, drawn)
        got = setsketch.estimate(left[None], right[None], np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(got - shared / (2000 - shared)) < 0.06
        assert (setsketch.merge(left, right) == setsketch.registers(np.union1d(a, b), drawn)).all()


def test_near_duplicates_of_awkward_rows(awkward, empty):
    rows = setsketch.near_duplicates(awkward, setsketch.Near(3, 85)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in rows) == [
        (0, 0, 0, True), (0, 2, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True),
        (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False),
    ]
    assert setsketch.near_duplicates(empty).count() == 0


def test_members_far_from_the_first_of_their_bucket_are_linked(spark, monkeypatch):
    """A chain of copies: neighbours are similar, ends are not, and blocks are small."""
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    random.seed(5)
    words = [f"w{random.random()}" for _ in range(200)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words = list(words)
        for at in random.sample(range(200), 3):
            words[at] = f"x{i}.{at}"
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), setsketch.Near(3, 85))
    assert {r.component_id for r in got.collect()} == {0}


# spans


def test_repeated_passages_stay_once_only(spark):
    passage = "The first sentence is here today. A second one follows it closely. The third, however, goes on. And the fourth one ends it."
    rows = [(3, f"Own words of three. {passage} Own end of three."), (1, f"Own start. {passage}"), (2, "Or. Er. Or."), (4, "Or. Er. Or.")]
    got = {r.doc_id: r for r in spans.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].n_removed == 0 and passage in got[1].text and got[1].n_sentences == 5
    assert got[3].n_removed == 4 and got[3].text == "Own words of three. Own end of three."
    assert got[2].n_removed == got[4].n_removed == 0


def runs_by_hand(text, rule):
    """(words, first, end) of each run, and each word's (start, end, sentence), with plain loops over whole words."""
    found = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), text[a:b]) for a, b in found]
    reader = spans.Reader(rule)
    # Only the hash of single words is taken from the library, as it chooses the ends of parts.
    code = {w: int(spans._of_ranges(np.frombuffer(w.encode(), np.uint8).astype(np.uint64) + np.uint64(1), np.array([0]), np.array([len(w.encode())]), reader.letters[0])[0]) for w in words}
    sentence, number = [], 0
    for i, (a, b) in enumerate(found):
        sentence.append(number)
        after = text[b : found[i + 1][0]] if i + 1 < len(found) else text[b:]
        bare = text[a:b]
        for _ in range(3):
            bare = bare[:-1] if len(bare) > 1 and bare[-1] in "\"')]" else bare
        number += "\n" in after or bare[-1] in ".!?"
    size = collections.Counter(sentence)
    begins = [i for i in range(len(words)) if i == 0 or sentence[i] != sentence[i - 1]]
    parts = []
    for i in range(len(words)):
        if i in set(begins):
            parts.append(i)
            continue
        around = range(max(0, i - 1 - rule.reach), min(len(words), i + rule.reach))
        if size[sentence[i - 1]] > rule.whole and all(code[words[i - 1]] <= code[words[j]] for j in around):
            parts.append(i)
    runs = set()
    for cut, always in ((begins, True), (parts, False)):
        for i in cut:
            end = next((j for j in [*cut, len(words)] if j >= i + rule.run_words), None)
            if end is not None and (always or len(set(words[i : i + rule.run_words])) >= rule.distinct):
                runs.add((tuple(words[i:end]), i, end))
    return runs, [(a, b, k) for (a, b), k in zip(found, sentence)]


def test_spans_equal_brute_force(spark, documents):
    rule = spans.Rule()
    held = dict(sorted(documents.items())[:350])
    places, words = collections.defaultdict(set), {}
    for i, text in held.items():
        runs, words[i] = runs_by_hand(text, rule)
        for run, first, end in runs:
            places[run].add((i, first, end))
    cut = collections.defaultdict(set)
    for found in places.values():
        for i, first, end in sorted(found)[1:]:
            cut[i].update(range(first, end))
    rows = spans.dedup(spark.createDataFrame(list(held.items()), "doc_id bigint, text string")).collect()
    assert sum(map(len, cut.values())) > 1_000
    for row in rows:
        own, gone = words[row.doc_id], cut[row.doc_id]
        text, kept, at = held[row.doc_id], [], 0
        for k in sorted(gone):
            kept.append(text[at : own[k][0]])
            at = own[k + 1][0] if k + 1 < len(own) else len(text)
        assert row.text == "".join(kept) + text[at:]
        assert row.n_removed == len({own[k][2] for k in gone}) and row.n_sentences == (own[-1][2] + 1 if own else 0)


def test_repeated_runs_across_partitions(spark, monkeypatch):
    """Very many copies of one passage, over partitions that are neither joined nor few."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "30"}
    before = {name: spark.conf.get(name) for name in names}
    passage = "It was a long and winding tale, of many words and turns. Nobody knew how it would end, or when it began at all."
    other = "Another passage of many words stands here, for only a few. It too is long enough to be found, and to be cut again."
    rows = [(i, f"Own words {i}. {passage}" + (f" {other}" if i % 50 == 7 else "")) for i in range(2_000)] + [(5, f"Own words 5. {passage}")] * 300
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        got = spans.dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(got) == len(rows)
    for r in got:
        assert (passage in r.text) == (r.doc_id == 0) and (other in r.text) == (r.doc_id == 7), r


def test_rows_of_one_id_are_cut_each_by_its_own_places(spark):
    passage = "It was a long and winding tale, of many words and turns. Nobody knew how it would end, or when it began at all."
    rows = [(1, passage), (2, passage + " A tail of its own."), (2, "Three. Whole unique sentences stand here alone. Not one of them is anywhere else. Tail.")]
    rows += [(3, "Own words."), (3, "Own words.")]
    got = spans.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = sorted((r.doc_id, r.text) for r in got)
    assert texts == sorted([(1, passage), (2, "A tail of its own."), (2, rows[2][1]), (3, "Own words."), (3, "Own words.")])
    one_id = [(7, passage), (7, passage + " More."), (7, passage)]
    got = [r.text for r in spans.dedup(spark.createDataFrame(one_id, "doc_id bigint, text string")).collect()]
    assert sorted(got) in ([passage, passage, "More."], sorted([passage + " More.", "", ""]))


def test_passages_found_by_plain_word_windows_are_cut(spark):
    """Planted passages of 51 words that begin and end in mid-sentence, or have very short lines."""
    random.seed(9)

    def some(n):
        return ["".join(random.choices("abcdefghij", k=7)) for _ in range(n)]

    def passage(kind):
        words = some(51)
        if kind == "list":
            return "".join(" ".join(words[i : i + 3]) + "\n" for i in range(0, 51, 3))
        if kind == "dialogue":
            return " ".join(" ".join(words[i : i + 2]) + "." for i in range(0, 51, 2))
        if kind == "commas":
            return " ".join(w + "," * (i % 7 == 6) for i, w in enumerate(words))
        if kind == "one whole sentence":
            return " ".join(w + "." * (i in (15, 35)) for i, w in enumerate(words))
        return " ".join(words)

    kinds = ["list", "dialogue", "commas", "one whole sentence", "no end at all"] * 20
    planted = [passage(kind) for kind in kinds]
    rows = []
    for i, one in enumerate(planted * 2):
        before, after = (" ".join(some(random.randrange(3, 40))) for _ in range(2))
        rows.append((i, f"{before}. Own {before[::-1]} {one} {after[::-1]} end. {after}."))
    seen, hit = {}, collections.defaultdict(set)
    for i, text in rows:
        words = text.lower().split()
        for at in range(len(words) - 49):
            if seen.setdefault(tuple(words[at : at + 50]), i) != i:  # 50, as the last may have a mark
                hit[i].update(words[at : at + 50])
    assert set(hit) == set(range(100, 200))
    got = {r.doc_id: r.text for r in spans.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        words, left = text.lower().split(), got[i].lower().split()
        gone = set(words) - set(left)
        assert gone <= hit[i] and 2 * len(gone) >= len(hit[i]), kinds[i % 100]


# BPE


def test_bpe_equals_tiktoken(spark, documents):
    path = q.vocabulary().path
    ranks = {token: i for i, token in enumerate(bpe.read_ranks(path))}
    assert ranks[base64.b64decode(open(path, "rb").readline().split()[0])] == 0
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(2)
    odd = ["", " ", "\x1c a\x85b", "<|endoftext|>", "a" * 5_000, " " * 3_000 + "x", "Ġ▁ café 日本語 😀👩‍👩‍👧", LONG[:9_000]]
    odd += ["".join(chr(random.choice([random.randrange(1, 0xD800), random.randrange(32, 127)])) for _ in range(60)) for _ in range(200)]
    codec = bpe.Codec(bpe.model_proto(bpe.read_ranks(path)), public_tokenizers.PATTERN)
    for text, ids in zip(odd, codec.encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == exact.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()
    for row in q.op3_byte_level_bpe(spark, SMALL).collect():
        ids = exact.encode_ordinary(documents_of(spark)[row.doc_id])
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and row.n_tokens == len(ids)


def documents_of(spark, cache={}):
    if not cache:
        cache.update({r.doc_id: r.text for r in q.table(spark, SMALL, "documents").collect()})
    return cache


def test_every_token_is_reached_by_merges():
    """So that a pre-token in the vocabulary needs no rule of its own."""
    vocabulary = bpe.read_ranks(q.vocabulary().path)
    codec = bpe.Codec(bpe.model_proto(vocabulary), public_tokenizers.PATTERN)
    mapped = [token.decode("latin-1").translate(codec.to_characters) for token in vocabulary]
    assert codec.processor.encode(mapped) == [[i] for i in range(len(vocabulary))]


def test_bpe_of_awkward_rows(awkward, empty):
    back = bpe.decode(bpe.encode(awkward, q.vocabulary()), q.vocabulary()).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back) and len(back) == len(AWKWARD)
    assert bpe.digests(empty, q.vocabulary()).count() == 0


# compression


def test_base_counts_by_brute_force(documents):
    for text in [*list(documents.values())[:200], "", "a b c d e a b c d e x", "x\nx\n\n \n \nx", LONG[:600]]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = collections.Counter(windows)
        hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))
        assert compression.base_counts(text) == want


def test_repetitive_and_random_texts_are_rejected_and_prose_is_kept(spark):
    rows = q.op4_quality_rules(spark, "/root/testdata/sf0.1")
    labels = q.table(spark, "/root/testdata/sf0.1", "labels")
    counts = rows.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in counts}
    assert kept[1] > 0.97 and kept[0] < 0.25
    limits = compression.bands(rows)
    random.seed(3)
    noise = " ".join("".join(random.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=12)) for _ in range(300))
    odd = spark.createDataFrame([(1, noise)], "doc_id bigint, text string")
    assert [r.kept for r in compression.judge(compression.measure(odd), limits).collect()] == [False]


def test_texts_of_every_length_are_judged(spark):
    """Random words of any length are rejected, and chunks that are odd to either side."""
    limits = compression.bands(compression.measure(q.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")))
    random.seed(13)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    texts = [" ".join("".join(random.choices(letters, k=8)) for _ in range(n)) for n in (30, 35, 40, 60, 500)]
    prose = max((r.text for r in q.table(spark, SMALL, "documents").where("lang = 'en'").collect()), key=len)[:8_192]
    same = [prose[i : i + 400] * 3 for i in range(0, 1_200, 400)]
    texts.append(prose[:2_400] + "".join(s[:1_024] for s in same) + texts[4][:3_072])
    rows = spark.createDataFrame(list(enumerate(texts)) + [(99, prose)], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in compression.judge(compression.measure(rows), limits).collect()}
    assert kept == dict.fromkeys(range(len(texts)), False) | {99: True}
    parts = compression.ratios(texts[4].encode(), 1_024, compression.zstandard.ZstdCompressor(level=3))[2]
    assert len(parts) == -(-len(texts[4]) // 1_024)


def test_small_tables_judge_like_large_ones(spark):
    """Bands of 200 and of no documents against those of 10,000, on the same texts."""
    large = q.op4_quality_rules(spark, "/root/testdata/sf0.1").cache()
    wide = compression.bands(large)
    small = q.op4_quality_rules(spark, SMALL)
    narrow, none = compression.bands(small), compression.bands(small.limit(0))
    assert small.where("not base_failed and not kept").count() >= 5
    judged = small.where("not base_failed")
    want = {r.doc_id: r.kept for r in compression.judge(judged, wide).collect()}
    got = {r.doc_id: r.kept for r in compression.judge(judged, narrow).collect()}
    assert sum(got[i] != want[i] for i in want) <= 2
    passing = large.where("not base_failed").drop("kept")
    low = large.where("not base_failed").join(q.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("quality = 0").drop("kept")
    for limits in (narrow, none):
        other = {r.doc_id: r.kept for r in compression.judge(passing, limits).collect()}
        mine = {r.doc_id: r.kept for r in compression.judge(passing, wide).collect()}
        assert sum(other[i] != mine[i] for i in mine) <= 0.03 * len(mine)
        rejected = [compression.judge(low, b).where("not kept").count() for b in (limits, wide)]
        assert rejected[0] >= 0.8 * rejected[1] > 0
    large.unpersist()


def test_compression_of_awkward_rows(awkward, empty):
    rows = compression.quality(awkward).collect()
    assert len(rows) == len(AWKWARD) and not any(r.kept for r in rows)
    assert compression.quality(empty).count() == 0


# decontamination


def test_windows_equal_brute_force(spark):
    random.seed(4)
    items = [(i, " ".join(random.choices("abc", k=random.choice([0, 2, 5, 8, 20])))) for i in range(30)] + [(None, "a d d"), (None, "d c"), (99, None)]
    texts = [(i, " ".join(random.choices("abcd", k=random.choice([0, 3, 40])))) for i in range(60)]
    rule = decontam.Rule(window=6)
    windows = collections.defaultdict(set)
    for i, text in items:
        words = decontam.words(text)
        n = min(6, len(words))
        for at in range(len(words) - n + 1) if n else ():
            windows[tuple(words[at : at + n])].add(i)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (decontam.BLOCK_BYTES, 100):  # in one block, and in several
        for row in decontam.scan(docs, bench, rule, block_bytes=size).collect():
            words, hit, found = decontam.words(row.text), set(), set()
            for window, ids in windows.items():
                for at in range(len(words) - len(window) + 1):
                    if tuple(words[at : at + len(window)]) == window:
                        hit.update(range(at, at + len(window)))
                        found |= ids
            assert (row.n_hit, row["items"]) == (len(hit), sorted(str(i) for i in found if i is not None))
            flat = row.spans
            assert {p for a, b in zip(flat[::2], flat[1::2]) for p in range(a, b)} == hit


def test_spans_are_cut(spark, awkward, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! After.")], "doc_id bigint, text string")
    assert decontam.scan(docs, bench, cut=True).first().text == "Before, ! After."
    assert decontam.remove_spans(decontam.scan(docs, bench)).first().text == "Before, ! After."
    assert decontam.scan(awkward, bench).where("contaminated").count() == 0
    assert decontam.scan(empty, bench).count() == 0 and decontam.scan(docs, bench.limit(0)).first().n_hit == 0


# personal data


def base_spans(text):
    """The contract's base spans with plain patterns."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", m))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m))
    return ",".join(f"{kind}:{m.start()}:{m.end()}" for kind, m in found)


def test_base_spans_equal_plain_patterns(spark, documents):
    odd = {
        -1: "a@b.c_d@e.f x@y@z.com a..b@c.d-e.f. @a.b 1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.1 00000000256.1.1.1 1.2.3",
        -2: "4111 1111 1111 1111 4111-1111-1111-1112 5  5 +1 (202) 555-0100x +12 +1-2-3-4-5-6-7-8 é+49 30 901820.",
        -3: "😀 mail é@b.c Z@b.co, 4111111111111111", -4: "1" * 20_000, -5: "a" * 20_000, -6: "x@y" + ".z" * 20_000, -7: "",
        -8: "1 " * 10_000 + "+1" * 5_000,
    }
    rows = list({**documents, **odd}.items())
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    got = {r.doc_id: r.base for r in found.select("doc_id", pii.listed(F.col("base_spans")).alias("base")).collect()}
    assert got == {i: base_spans(text) for i, text in rows}


def test_many_matches_in_one_text(spark):
    """Positions and cuts at a cost per match that hardly grows."""
    n = 20_000
    text = " ".join(f"é{i} 10.{i % 250}.1.{i % 7} and" for i in range(n))
    started = time.perf_counter()
    found = pii.detect(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), pii.Model(0.5, {}, -9.0))
    row = pii.redact(found.withColumn("whole", F.col("text"))).first()
    assert time.perf_counter() - started < 60
    assert [(s.s, s.e) for s in row.base_spans] == [(m.start(), m.end()) for m in re.finditer(r"10\.\d+\.1\.\d", text)]
    assert row.text == re.sub(r"10\.\d+\.1\.\d", "<IP>", text)


@pytest.mark.parametrize("length", [12, 128, 129, 300, 5_000])
def test_secrets_are_redacted_to_their_end(spark, length):
    random.seed(length)
    secret = "".join(random.choices("abcdefghij_", k=length - 4)) + "0a1b"
    rows = [(1, f'Here token = "{secret}" stands.'), (2, f"Write to {'x' * length} (at) example (dot) com, or phone.")]
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string"))
    more = {r.doc_id: [(c.kind, c.m) for c in r._more] for r in pii.candidates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert more[1] == [("secret", f'token = "{secret}"')] and more[2] == [("email", f"{'x' * length} (at) example (dot) com")]
    texts = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert texts[1] == "Here <SECRET> stands."


def test_overlapping_spans_are_cut_once(spark):
    rows = [("aé😀bcdefghij", [("x", 2, 5), ("y", 3, 4), ("z", 4, 8), ("w", 8, 9)]), ("abc", []), (None, None)]
    df = spark.createDataFrame(rows, "text string, all_spans array<struct<kind:string,s:bigint,e:bigint>>")
    assert [r.text for r in pii.redact(df).collect()] == ["aé<X><W>hij", "abc", None]


def test_doubtful_candidates_are_judged_and_all_are_redacted(spark):
    noise = [(i, f"The version 300.{i % 250}.1.2 came out, order {10**13 + i} was filed.") for i in range(60)]
    rows = noise + [(100 + i, f'Here token = "{"0a1b2c3d4e5f" * 3}{i:02d}" stands. Call 555-123-{4000 + i} now.') for i in range(60)]
    rows += [(900, "Write to joe@example.com or +1 (202) 555-0100!"), (901, None)]
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string"))
    out = {r.doc_id: r for r in pii.redact(found).collect()}
    assert out[900].text == "Write to <EMAIL> or <PHONE>!" and out[901].text is None
    assert {s.kind for s in out[100].all_spans} == {"secret", "phone"} and not out[0].all_spans


@pytest.mark.parametrize("copies", [1, 40])
def test_look_alikes_do_not_tip_the_model(spark, copies):
    """Numbers that fail their check stay, however many there are beside few or many secrets."""
    rows = [(i, f"It is 29942562563317{i % 10}{(i + 1 + (i % 10 == 8)) % 10} there") for i in range(100)]
    rows = [(i, t) for i, t in rows if not base_spans(t)]
    rows += [(200 + i, f'Here token = "{"0a1b2c3d4e5f" * 3}{i:02d}" stands.') for i in range(copies)]
    rows += [(300, "Card 3782822463100 5 and +123 and +1234567890123456 and 10.10.10.999 here")]
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(rows) > 90 + copies
    assert {r.doc_id for r in found if r.all_spans} == set(range(200, 200 + copies))


def test_reliabilities_are_recovered():
    random.seed(6)
    counted = collections.Counter()
    for _ in range(20_000):
        truth = random.random() < 0.4
        votes = tuple((1 if truth else -1) * (1 if random.random() < right else -1) for right in (0.95, 0.9, 0.8, 0.7, 0.55))
        counted[votes, (f"kind={'a' if truth else 'b'}",)] += 1
    model = pii.fit([(v, f, n) for (v, f), n in counted.items()])
    got = [yes[2] for _, yes in model.reliability.values()]
    assert np.allclose(got, (0.95, 0.9, 0.8, 0.7, 0.55), atol=0.05) and abs(model.prior - 0.4) < 0.05
    assert model.weights["kind=a"] > 0 > model.weights["kind=b"] + model.bias


def test_personal_data_in_awkward_rows(awkward, empty):
    assert pii.detect(awkward).where("size(all_spans) > 0").count() == 0
    assert pii.redact(pii.detect(awkward)).count() == len(AWKWARD) and pii.detect(empty).count() == 0


# extraction


def test_main_text_without_the_rest():
    p = "<p>" + "This is a sentence, with commas, and enough words to count for some. " * 3 + "</p>"
    page = f"""<html><body><header><h1>Site</h1></header><nav><ul><li><a href=x>One</a></li></ul></nav>
      <div class="cookie-notice"><p>We use cookies, many of them, on this site, for you, all day long.</p></div>
      <div class="content"><h1>Title &amp; more</h1>{p}<div class="advert"><p>Buy this now, cheap, good, fast, at once, all of you.</p></div>
      {p}<form><p>Sign up, please, for this and that, and for more of the same, too.</p></form>{p}</div>
      <div class="sidebar"><p>Side text, quite long, with commas, and more, and more, and more of it.</p></div>
      <div id="comments">{p}{p}{p}{p}{p}</div><script>var t = "<p>x</p>";</script><footer>All rights</footer></body></html>"""
    sentence = "This is a sentence, with commas, and enough words to count for some."
    assert extract.main_text(page) == " ".join(["Title & more", *[sentence] * 9])
    assert extract.main_text("<article><h1>A</h1><p>b<b>c</b>\n d<br>e<p>f</article><p>g") == "A bc d e f"
    for page, want in (("", ""), (None, ""), ("<div>", ""), ("plain text", "plain text"), ("<!-- a", ""), ("<" * 5_000, "<" * 5_000)):
        assert extract.main_text(page) == want
    assert extract.main_text("<div>" * 20_000 + "<p>deep text</p>") == "deep text"


def test_text_beside_the_article_is_kept():
    p = "<p>" + "This is a sentence, with commas, and enough words to count for some. " * 3 + "</p>"
    text = " ".join(["This is a sentence, with commas, and enough words to count for some."] * 3)
    lead = "What the story is all about."
    nav, side = "<nav><a href=x>One</a></nav>", f'<aside>{p}</aside><div class="related">{p}{p}</div><footer>{p}</footer>'
    part = f"<article><h2>A</h2>{p}{p}</article>"
    whole = f"A {text} {text}"
    for page, want in (
        (f"<body>{nav}{part}{part}{side}</body>", f"{whole} {whole}"),
        (f"<body>{part}<h2>Two</h2><article>{p}</article><h2>Related</h2>{side}</body>", f"{whole} Two {text}"),
        (f"<main><h1>Title</h1><p>{lead}</p>{part}</main>{side}", f"Title {lead} {whole}"),
        (f"<main><h1>Title</h1>{p}<div class=row>{part}</div></main>{side}", f"Title {text} {whole}"),
        (f"<main><header><h1>Title</h1></header><div>{part}</div><div>{part}</div></main>{side}", f"Title {whole} {whole}"),
        (f"<header><h1>Site</h1></header>{nav}<h1>Title</h1><main>{p}{p}</main>{side}", f"Title {text} {text}"),
        ("<article>one</article><article>two and more</article>", "one two and more"),
        (f"<main>{nav}{part}<p><a href=x>{lead}</a></p><div id=comments>{p}{p}</div></main>", whole),
    ):
        assert extract.main_text(page) == want, page


def test_pages_give_their_articles(spark):
    html = {r.page_id: r.html for r in q.table(spark, MEDIUM, "pages").collect()}
    import html as entities

    for row in q.op7_html_extraction(spark, MEDIUM).collect():
        article = re.search(r"<article>(.*?)</article>", html[row.page_id], re.S).group(1)
        plain = re.sub(r"</?(?:p|h1|br)>", " ", article).replace("<b>", "").replace("</b>", "")
        assert row.text == " ".join(entities.unescape(plain).split()) and row.n_chars == len(row.text)


# shards


def test_shards_are_near_equal_whatever_the_copies(spark, documents):
    rows = list(documents.items()) + [(10_000 + i, "the same copy " * 20) for i in range(700)] + [(20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    got = shards.assign(docs, size, 8).collect()
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
        assert r.text_crc32 == zlib.crc32((dict(rows)[r.doc_id] or "").encode())
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert sorted(by_shard) == list(range(8)) and len(got) == len(rows)
    for own in by_shard.values():
        assert abs(sum(r["size"] for r in own) - total / 8) <= most
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_equal_rows_are_spread_over_shards_and_ranges(spark):
    """A third of all rows are one row; its copies part like any others of their size."""
    rows = [(7, "the same row " * 3)] * 3_000 + [(i, f"text {i} " * 4) for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = shards.assign(docs, F.octet_length("text") + 1, 8, ranges=64).collect()
    total, sizes = sum(r["size"] for r in got), collections.Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert all(abs(size - total / 8) <= 64 for size in sizes.values()) and len({r.shard for r in got if r.doc_id == 7}) >= 2
    keys = docs.select(F.xxhash64("text").alias("a"), F.col("doc_id").alias("b"), F.monotonically_increasing_id().alias("c"), (F.octet_length("text") + 1).alias("size"))
    bounds = shards.splitters(keys.cache(), 64, total)
    held = keys.withColumn("range", shards._search(bounds)).groupBy("range").agg(F.sum("size").alias("size")).collect()
    assert max(r["size"] for r in held) <= 2 * total / 64


def test_shards_of_awkward_rows(awkward, empty):
    got = shards.assign(awkward, F.coalesce(F.octet_length("text"), F.lit(0)) + 1, 3).collect()
    assert len(got) == len(AWKWARD)
    assert shards.assign(empty, F.octet_length("text"), 3).count() == 0


# WARC


def test_archives_give_back_what_was_written(spark, tmp_path):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "http://a/", trap), (2, "http://b/\r\nX: y", trap), (3, None, None), (4, "http://d/", ""), (5, "http://e/é", "é" * 10), (None, "http://f/", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = f"{tmp_path}/warc"
    warc.write(pages, path)
    got = {r.page_id: r for r in warc.captures(spark, path).collect()}
    assert len(got) == 6 and [got[i].refers_to for i in (1, 2, 3, 4, 5, None)] == [2, None, 4, None, None, None]
    for i, _, html in rows:
        data = (html or "").encode()
        assert got[i].payload_bytes == len(data)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    whole = {r.response.url: r for r in warc.assemble(warc.read(spark, path)).collect()}
    assert whole["http://e/é"].request.head.startswith("GET http://e/é HTTP/1.1") and bytes(whole["http://e/é"].response.payload) == ("é" * 10).encode()
    warc.write(pages.limit(0), f"{tmp_path}/none")
    assert warc.captures(spark, f"{tmp_path}/none").count() == 0


def test_repeated_pages_and_null_ids_keep_their_rows(spark, tmp_path):
    rows = [(1, "http://a/", "x")] * 3 + [(1, "http://b/", "x"), (1, None, "x"), (1, "", "x")]
    rows += [(2, "http://a/", "x")] * 2 + [(None, "http://n/", "x")] * 40 + [(None, f"http://n/{i}", None) for i in range(5)]
    rows += [(3, None, None), (4, "http://d/", ""), (5, "http://e/", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert oracle.differences(q.op9_warc(spark, str(tmp_path)), con, q.OP9_SQL) == []
    for size in (10**9, 20_000):  # one file, and several
        path = f"{tmp_path}/warc{size}"
        warc.write(pages, path, file_bytes=size)
        whole = warc.assemble(warc.read(spark, path)).collect()
        page = [re.search(r"pageId: (.*)\r", bytes(r.metadata.payload).decode()).group(1) for r in whole]
        got = [(int(i) if i else None, r.request.url) for i, r in zip(page, whole)]
        assert collections.Counter(got) == collections.Counter((i, u) for i, u, _ in rows)
        assert all(r.request and r.response and r.metadata for r in whole)
        held = {r.response.id for r in whole if r.response.type == "response"}
        assert {r.response.refers_to for r in whole if r.response.type == "revisit"} <= held


# toxicity


def test_held_out_accuracy(spark):
    rows = q.op10_toxicity(spark, "/root/testdata/sf0.1").join(q.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    held = rows.where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held) and len(held) > 500
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.01 * len(held)


def test_the_sample_is_bounded_though_ids_repeat(spark):
    docs = spark.createDataFrame([(i % 3 + 1, f"text {i}") for i in range(300)], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 3, 4)], "doc_id bigint, toxic int")
    kept = [i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5]
    sample = toxicity.labelled_sample(docs, labels, toxicity.Rule(), "doc_id", "text").collect()
    assert len(sample) == len(kept) and sorted(r.toxic for r in sample) == sorted(i % 2 for i in kept)


def test_correlated_voters_share_their_weight():
    random.seed(8)
    truth = np.array([random.random() < 0.3 for _ in range(4_000)])

    def voter(right):
        return np.where(np.array([random.random() < right for _ in truth]), 2 * truth - 1, 1 - 2 * truth)

    one = voter(0.75)
    held = np.column_stack([one, one, one, voter(0.9), voter(0.85)]).astype(np.int8)
    posterior, chance, weight = toxicity.label_model(held, np.zeros(len(truth)) + np.where(np.arange(len(truth)) < 400, 2 * truth - 1, 0))
    assert weight[0] < 0.5 < 0.8 < weight[3]
    assert ((posterior > 0.5) == truth).mean() > 0.88


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    model = toxicity.Model(("=idiot", "vequ"), (2.0, 2.0, 1.0, 1.0, 0.0, 0.0, -3.0))
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and not any(r.predicted for r in rows)
    docs = spark.createDataFrame([(1, "You idiot, vequar vequal"), (2, "idiotic lovequ")], "doc_id bigint, text string")
    assert [r.predicted for r in toxicity.score(docs, model).orderBy("doc_id").collect()] == [1, 0]
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(empty, none).count() == 0 and toxicity.score(docs, none).where("predicted = 1").count() == 0


# pipeline


def test_pipeline_by_brute_force(spark):
    docs = q.table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    bad = {r.doc_id for r in q.op10_toxicity(spark, SMALL).where("predicted = 1").collect()}
    left = {i: t for i, t in texts.items() if i not in bad}
    sets = {i: setsketch.shingles(t, 5) for i, t in left.items()}
    above = {i: i for i in left}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in sorted(left):
        for j in sorted(left):
            shared = len(sets[i] & sets[j]) if i < j else 0
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                above[b] = a
    left = {i: t for i, t in left.items() if root(i) == i}
    windows = set()
    for row in q.table(spark, SMALL, "benchmark").collect():
        words = decontam.words(row.text)
        windows |= {tuple(words[k : k + 13]) for k in range(max(1, len(words) - 12))}
    hits = {}
    for i, text in left.items():
        words = decontam.words(text)
        hits[i] = {p for k in range(len(words)) if tuple(words[k : k + 13]) in windows for p in range(k, k + 13)}
    left = {i: t for i, t in left.items() if not hits[i] or 20 * len(hits[i]) < len(decontam.words(t))}
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(result) == set(left)
    for i, row in result.items():
        assert base_spans(row.text) == ""
        if not hits[i] and not re.search(r"[0-9@]", left[i]):
            assert row.text == left[i]
        assert row.n_chars == len(row.text) and row.n_tokens * 4 == len(row.ids)


def test_stages_keep_the_columns_and_take_awkward_rows(spark, tmp_path):
    for name in os.listdir(SMALL):
        os.symlink(f"{SMALL}/{name}", f"{tmp_path}/{name}")
    for rows in (AWKWARD, []):
        docs = spark.createDataFrame(
            [(i, t, None, s, 0, "extra", 0.5) for i, t, s in rows],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score double",
        )
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() == len(rows) - (name == "near_duplicates" and bool(rows)), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)
