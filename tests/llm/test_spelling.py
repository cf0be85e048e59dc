"""Spelling variants against brute force."""

import collections
import itertools
import random
import re
import zlib

import pytest

from barloom.llm import spelling

WORDS = "word string, n bigint"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts, ratio):
    found = {}
    for word, n in counts.items():
        near = [(-counts[o], o) for o in counts if one_edit(word, o)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= ratio * n else None
        found[word] = (form, n, len(near), counts[form] if form else None)
    rows = []
    for word, (form, n, n_near, form_n) in found.items():
        root = word
        while found[root][0] is not None:
            root = found[root][0]
        rows.append((word, form, root, n, n_near, form_n))
    return sorted(rows)


def vocabulary(alphabet, size, lengths, near=0.5):
    """Random words, many of them one edit from another; counts over several powers of ten."""
    words = []
    while len(words) < size:
        if words and random.random() < near:
            word = list(random.choice(words))
            at = random.randrange(len(word))
            word[at : at + random.randrange(2)] = random.choice(["", random.choice(alphabet)])
        else:
            word = random.choices(alphabet, k=random.choice(lengths))
        words.append("".join(word))
    return {w: int(10 ** random.uniform(0, 4)) for w in words if len(w) >= spelling.SHORTEST}


@pytest.mark.parametrize(
    "alphabet, lengths", [("ab", range(4, 9)), ("abcdefghé", range(4, 12)), ("àéîõü", range(4, 7)), ("aa中\U0001F600", range(4, 7))]
)
def test_variants_equal_brute_force(spark, alphabet, lengths):
    random.seed(len(alphabet))
    counts = vocabulary(alphabet, 400, lengths)
    got = spelling.variants(spark.createDataFrame(list(counts.items()), WORDS), spelling.Rule(least_chars=4))
    assert sorted(tuple(r) for r in got.collect()) == by_hand(counts, 2)


def test_every_near_pair_meets_by_a_pivot():
    """The lookup loses no pair, whatever the weights; without Spark, on very many pairs."""
    random.seed(21)
    for trial in range(20):
        counts = vocabulary(random.choice(["ab", "abc", "abcdefghij"]), 150, range(4, 10), near=0.8)
        weights = {spelling.bucket(a + b): random.choice([1, 1, 2, 50]) for a in "abcdefghij" for b in "abcdefghij"}
        signs = {w: spelling.signature(w, weights) for w in counts}
        for a, b in itertools.permutations(counts, 2):
            if not one_edit(a, b) or signs[a][0] > signs[b][0]:
                continue
            size = len(a)
            asked = set(spelling.places(a, signs[a][2], (size - 1, size, size + 1)))
            assert asked & set(spelling.places(b, signs[b][1], (len(b),))), (a, b)
            assert (spelling.parity(a) ^ spelling.parity(b)).bit_count() <= 2 or min(spelling.parity(a), spelling.parity(b)) < 0


def test_pivots_are_the_rarest_disjoint_bigrams():
    random.seed(22)
    for _ in range(500):
        weighed = [(str(at), at, random.randrange(6)) for at in sorted(random.sample(range(12), random.randrange(3, 9)))]
        pairs = [(a, b) for a, b in itertools.combinations(weighed, 2) if b[1] - a[1] >= 2]
        chosen = spelling.disjoint(weighed)
        weight = {at: w for _, at, w in weighed}
        assert chosen[1][1] - chosen[0][1] >= 2
        assert sum(weight[at] for _, at in chosen) == min(a[2] + b[2] for a, b in pairs)


def test_words_are_counted_from_whole_texts(spark):
    random.seed(23)
    some = ["Apple", "apples", "ÀPPLE", "àpple", "x", "longer", "don't", "a1b", "Σίσυφος", "fiancée", "×÷×÷×"]
    rows = [(i % 30 if i % 31 else None, " ".join(random.choices(some, k=40))) for i in range(200)] + [(5, None), (6, ""), (7, "apples " * 30_000)]
    counted = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            code = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if code % 7 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counted[run] += 1
    want = {w: n for w, n in counted.items() if len(w) >= 4 and n >= 3}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = spelling.count_words(df, spelling.Rule(least_chars=4), spell=spelling.misspell(7)).collect()
    assert {r.word: r.n for r in got} == want and len(got) == len(want)


def test_forms_lead_to_the_last(spark):
    """A chain of words, each twice as frequent as the one before; very many words near one."""
    chain = ["aaaaa" + "b" * i for i in range(20)]
    counts = {w: 2**i * 3 for i, w in enumerate(chain)}
    hub = "frequency"
    counts[hub] = 10**9
    for i in range(9):
        for c in "vwxz":
            for k in (0, 1):
                counts[hub[:i] + c + hub[i + k :]] = 5
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(counts.items()), WORDS)).collect()}
    assert {got[w].root for w in chain} == {chain[-1]} and got[chain[3]].form == chain[4]
    assert got[hub].n_near == 72 and got[hub].form is None and got[hub].root == hub
    assert {r.form for w, r in got.items() if w not in chain and w != hub} == {hub}


def test_awkward_words(spark):
    rows = [(None, None), (None, "clashing names"), (1, None), (1, ""), (1, "word " * 3), (1, "words " * 3)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int")
    rule = spelling.Rule(least_chars=4)
    got = spelling.variants(spelling.count_words(df, rule), rule).collect()
    assert sorted(tuple(r) for r in got) == [("word", None, "word", 3, 1, None), ("words", None, "words", 3, 1, None)]
    assert spelling.variants(spelling.count_words(df.limit(0))).count() == 0
    assert spelling.variants(spark.createDataFrame([(None, 5), ("abc", 5), ("abcde", 5)], WORDS)).count() == 1
    for wrong in ({"least_chars": 3}, {"ratio": 1}):
        with pytest.raises(ValueError):
            spelling.Rule(**wrong)
