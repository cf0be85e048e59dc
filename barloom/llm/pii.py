"""Personal data by weak supervision, in DataFrame expressions.

Regular expressions give certain spans (the base) and doubtful candidates. Labelers
(format, check digits or ranges, a gazetteer of words near by, what the span touches,
its shape) vote on every candidate; expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is; a logistic classifier over span
features, fitted to the posteriors, decides which candidates become spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames

#: Kinds in the order in which spans are listed; base spans have the first four.
KINDS = ("email", "ip", "card", "phone", "secret")

# Possessive repeats and look-behinds give the same leftmost matches as the plain
# patterns, without stepping back over long runs.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What must stand in a text before its pattern is tried.
NEEDS = {"email": "@", "phone": "+"}
#: Doubtful candidates beside base matches that failed a check.
MORE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]*+(?<=[a-z0-9._%+-])\x20?(?:\(at\)|\[at\])\x20?[a-z0-9-]++\x20?(?:\(dot\)|\[dot\]|\.)\x20?[a-z]{2,}+",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "secret": r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key)\b\x20?[=:]\x20?[\"']?[a-z0-9_+/-]{12,}+[\"']?",
}
MORE_NEEDS = {"email": r"(?i)(?:\(at\)|\[at\])", "phone": r"[0-9]{3}[\x20.-][0-9]{4}", "secret": r"(?i)(?:token|secret|passw|key)\b\x20?[=:]"}

# Words near by that speak for a kind, and words that speak against all.
CUES = {
    "email": r"e-?mail|mail|correo|courriel|contact|kontakt|write to|schreib",
    "ip": r"\bip\b|host|server|address|adresse|dirección|login",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta|pay",
    "phone": r"phone|tel|call|fax|mobile|cell|handy|appel|llam|ruf",
    "secret": r"token|secret|passw|key",
}
AGAINST = r"version|isbn|order|invoice|serial|ticket|release|figure|chapter|§|nr\.|no\."


#: Elements folded one by one, each step copying what there is so far.
FOLD = 512


def _with(value: Column, use) -> Column:
    """``use`` of an expression that is evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(values: Column, join, zero: int = 0) -> Column:
    """For each element of an array of bigints, the join of those before it; at its end, nothing is added.

    Folded in blocks, and the blocks' joins folded likewise, so that the work grows little faster than the array.
    """
    empty = F.struct(F.lit(zero).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def fold(array):
        return F.aggregate(
            array, empty, lambda state, x: F.struct(join(state["at"], x).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))
        )

    def folded(array):
        last = F.floor(F.greatest(F.size(array) - 1, F.lit(0)) / FOLD).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: fold(F.slice(array, k * FOLD + 1, F.lit(FOLD))))

    def joined(blocks):
        bases = fold(F.transform(blocks, lambda block: block["at"]))["out"]
        return F.flatten(F.zip_with(blocks, bases, lambda block, base: F.transform(block["out"], lambda x: join(base, x))))

    return _with(values, lambda array: _with(folded(array), joined))


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, s, e, m, near) of the leftmost matches, positions in code points.

    Matches and what lies between them come from the same pattern; running lengths
    give the positions.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)

    def length(part: Column) -> Column:
        return F.length(F.coalesce(part, F.lit(""))).cast("bigint")

    def placed(pair, before):
        s = before + length(pair["gap"])
        return F.struct(
            F.lit(kind).alias("kind"), s.alias("s"), (s + length(pair["m"])).alias("e"), pair["m"].alias("m"),
            F.lower(F.substring(pair["gap"], -32, 32)).alias("before"), F.lit("").alias("after"),
        )

    def found(pairs):
        sizes = F.transform(pairs, lambda pair: length(pair["gap"]) + length(pair["m"]))
        every = F.zip_with(pairs, _before(sizes, lambda a, b: a + b), placed)
        return F.filter(every, lambda c: c["m"].isNotNull())

    return _with(F.arrays_zip(gaps.alias("gap"), matches.alias("m")), found)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            F.when(d.try_cast("int") > 4, d.try_cast("int") * 2 - 9).otherwise(d.try_cast("int") * 2)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def octets(m: Column) -> Column:
    """Whether all parts of a dotted number are at most 255, leading zeros aside."""
    def part(p):
        short = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)

    return F.forall(F.split(m, r"\."), part)


def valid(kind: str, m: Column) -> Column:
    """The base rule of a kind, for a match of its pattern."""
    if kind == "ip":
        return octets(m)
    if kind == "card":
        digits = _digits(m)
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _passing(kind: str, wanted: bool):
    return lambda c: valid(kind, c["m"]) == F.lit(wanted)


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``_base``: certain spans by kind, and ``_more``: doubtful candidates.

    Doubtful are base matches that fail their check (of 13 to 19 digits for cards), and
    matches of the wider patterns that touch no base span. All within the row.
    """
    body = F.coalesce(frames.col(text), F.lit(""))
    none = F.array().cast("array<struct<kind:string,s:bigint,e:bigint,m:string,before:string,after:string>>")
    out = df.withColumn("_body", body).withColumn("_digit", F.col("_body").rlike("[0-9]"))
    body = F.col("_body")
    for kind, pattern in BASE.items():
        needed = body.contains(NEEDS[kind]) if kind in NEEDS else F.col("_digit")
        out = out.withColumn(f"_all_{kind}", F.when(needed, _spans(body, kind, pattern)).otherwise(none))
    for kind, pattern in MORE.items():
        needed = body.rlike(MORE_NEEDS[kind])
        if kind == "phone":
            needed = F.col("_digit") & needed
        out = out.withColumn(f"_wide_{kind}", F.when(needed, _spans(body, kind, pattern)).otherwise(none))
    sure, doubtful = [], []
    for kind in BASE:
        every = F.col(f"_all_{kind}")
        sure.append(F.filter(every, _passing(kind, True)))
        if kind == "card":
            near = F.filter(every, lambda c: F.length(_digits(c["m"])).between(13, 19))
            doubtful.append(F.filter(near, _passing(kind, False)))
        elif kind in ("ip", "phone"):
            doubtful.append(F.filter(every, _passing(kind, False)))
    out = out.withColumn("_base", F.concat(*sure))
    doubtful += [F.col(f"_wide_{kind}") for kind in MORE]

    def apart(c):
        return ~F.exists(F.col("_base"), lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))

    out = out.withColumn("_more", F.filter(F.concat(*doubtful), apart))
    out = out.withColumn(
        "_more",
        F.transform(
            "_more",
            lambda c: F.struct(
                c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), c["m"].alias("m"),
                c["before"].alias("before"),
                F.lower(F.substring(body, (c["e"] + 1).cast("int"), F.lit(24))).alias("after"),
            ),
        ),
    )
    return out.drop("_digit", *[f"_all_{k}" for k in BASE], *[f"_wide_{k}" for k in MORE])


LABELERS = ("format", "check", "gazetteer", "touch", "shape")

# What is held of each labeler before any text is seen: the chances of the votes -1, 0, 1
# on what is not personal data, and on what is. That few real numbers fail their check is
# known from how they are made, so that labeler's chances are kept, not estimated.
HELD = {
    "format": ((0.3, 0.4, 0.3), (0.1, 0.4, 0.5)),
    "check": ((0.6, 0.35, 0.05), (0.002, 0.598, 0.4)),
    "gazetteer": ((0.3, 0.6, 0.1), (0.05, 0.65, 0.3)),
    "touch": ((0.3, 0.4, 0.3), (0.1, 0.3, 0.6)),
    "shape": ((0.3, 0.4, 0.3), (0.1, 0.4, 0.5)),
}
KNOWN = frozenset({"check"})


def votes(c: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 for personal data, -1 against, 0 none."""
    kind, m, before, after = c["kind"], c["m"], c["before"], c["after"]
    digits = _digits(m)
    n = F.length(digits)

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    cue = F.lit(False)
    for one, words in CUES.items():
        cue = cue | ((kind == one) & (before.rlike(words) | after.rlike(words)))
    return {
        "format": vote(
            ((kind == "phone") & m.rlike(r"^\(?[0-9]{3}\)?[ .-]")) | ((kind == "card") & m.rlike(r"^[0-9]{4}([ -]?)(?:[0-9]{4}\1){2}[0-9]{4}$"))
            | (kind == "email") | ((kind == "secret") & m.rlike("[\"']$")),
            (kind == "ip") | ((kind == "phone") & (n < 8)) | ((kind == "card") & (n < 16) & ~digits.rlike("^3[47]")),
        ),
        "check": vote(
            ((kind == "secret") & m.rlike("[0-9].*[a-z]|[a-z].*[0-9]")) | ((kind == "phone") & n.between(8, 15)),
            ((kind == "card") & ~luhn(digits)) | ((kind == "ip") & ~octets(m)) | ((kind == "phone") & ~n.between(8, 15)),
        ),
        "gazetteer": vote(cue, (before.rlike(AGAINST)) & ~cue),
        "touch": vote(
            before.rlike(r"(?:^|[\s\"'(=:])$") & after.rlike(r"^(?:$|[\s\"'),.;:!?])"),
            before.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]"),
        ),
        "shape": vote(
            ((kind == "card") & n.between(16, 19)) | ((kind == "phone") & n.between(10, 13))
            | ((kind == "secret") & (F.length(m) >= 24)),
            ((kind == "card") & (n < 15)) | m.rlike(r"^(?:0+|1+)$"),
        ),
    }


def features(c: Column) -> dict[str, Column]:
    """What the span classifier sees, each one of a few values: its kind, form and neighbourhood."""
    kind, m = c["kind"], c["m"]
    digits = _digits(m)
    return {
        "kind": kind,
        "digits": F.concat(kind, F.lit(":"), F.least(F.length(digits), F.lit(20)).cast("string")),
        "marks": F.concat(kind, F.lit(":"), F.least(F.length(F.regexp_replace(m, r"[\p{L}0-9]", "")), F.lit(6)).cast("string")),
        "luhn": F.concat(kind, F.lit(":"), F.coalesce(luhn(digits), F.lit(False)).cast("string")),
        "before": F.regexp_extract(c["before"], r"(=|:|\(|#|\p{L}|[0-9]|\s)\s?$", 1),
    }


@dataclass(frozen=True)
class Model:
    """Labelers' reliabilities (chance of the votes -1, 0, 1 if not, if so), and the classifier's weights."""

    prior: float
    reliability: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]
    bias: float
    weights: dict[str, float] = field(default_factory=dict)


def aggregate_votes(found: DataFrame) -> list[tuple[tuple[int, ...], tuple[str, ...], int]]:
    """(votes, features, count) over all candidates: one row per combination that occurs.

    Votes have three values and features a few each, so the combinations are bounded
    whatever the number of documents; they are counted on the map side first.
    """
    each = found.select(F.explode("_more").alias("c"))
    c = F.col("c")
    counted = each.select(
        *[v.alias(f"v_{k}") for k, v in votes(c).items()], *[f.alias(f"f_{k}") for k, f in features(c).items()]
    )
    rows = counted.groupBy(*counted.columns).count().collect()
    n = len(LABELERS)
    return sorted((tuple(r[:n]), tuple(f"{k[2:]}={x}" for k, x in zip(counted.columns[n:], r[n:-1])), r[-1]) for r in rows)


def fit(
    counted: list[tuple[tuple[int, ...], tuple[str, ...], int]],
    rounds: int = 60,
    prior: float = 0.3,
    held: dict[str, tuple[tuple[float, ...], tuple[float, ...]]] | None = None,
    known: frozenset[str] = frozenset(),
) -> Model:
    """Label model by expectation-maximisation, then the classifier by gradient steps on its posteriors.

    Free (no ``held``), it starts from labelers that are right four times in five; counts are
    smoothed by one, so a labeler without votes stays neutral. With ``held``, what is held of
    the labelers weighs as much as all candidates together, at any number of these, and
    those in ``known`` are not estimated: the estimate moves with the data, but can't put
    all candidates into one class when most look alike. Works on counted combinations only.
    """
    patterns: dict[tuple[int, ...], int] = {}
    for pattern, _, n in counted:
        patterns[pattern] = patterns.get(pattern, 0) + n
    chance = [held[k] if held else ([0.4, 0.5, 0.1], [0.1, 0.5, 0.4]) for k in LABELERS]

    def posterior(pattern):
        odds = math.log(prior / (1 - prior))
        for (no, yes), vote in zip(chance, pattern):
            odds += math.log(yes[vote + 1] / no[vote + 1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    for _ in range(rounds if patterns else 0):
        odds = {pattern: posterior(pattern) for pattern in patterns}
        total = sum(patterns.values())
        yes_total = sum(n * odds[p] for p, n in patterns.items())
        weight = total if held else 2
        prior = (yes_total + weight / 2) / (total + weight)
        for k, name in enumerate(LABELERS):
            if name in known:
                continue
            no, yes = ([weight * x for x in side] for side in held[name]) if held else ([4.0, 2.0, 1.0], [1.0, 2.0, 4.0])
            for p, n in patterns.items():
                yes[p[k] + 1] += n * odds[p]
                no[p[k] + 1] += n * (1 - odds[p])
            chance[k] = ([x / sum(no) for x in no], [x / sum(yes) for x in yes])
    names = sorted({f for _, own, _ in counted for f in own})
    weights, bias = dict.fromkeys(names, 0.0), 0.0
    total = sum(n for *_, n in counted) or 1
    for _ in range(400 if counted else 0):
        steps, step = dict.fromkeys(names, 0.0), 0.0
        for pattern, own, n in counted:
            z = bias + sum(weights[f] for f in own)
            error = n / total * (posterior(pattern) - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            step += error
            for f in own:
                steps[f] += error
        bias += 2.0 * step
        for f in names:
            weights[f] += 2.0 * (steps[f] - 1e-4 * weights[f])
    reliability = {k: (tuple(no), tuple(yes)) for k, (no, yes) in zip(LABELERS, chance)}
    return Model(prior, reliability, bias, weights)


def probability(c: Column, model: Model) -> Column:
    """The classifier's probability for a candidate; values not seen in fitting weigh nothing."""
    z = F.lit(model.bias)
    if model.weights:
        held = F.create_map(*[F.lit(x) for k, w in model.weights.items() for x in (k, w)])
        for name, value in features(c).items():
            z = z + F.coalesce(held[F.concat(F.lit(f"{name}="), value)], F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def detect(df: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``df`` with ``base_spans`` and ``all_spans``: arrays of (kind, s, e), by kind, then start.

    Positions are code points, the end exclusive. Base spans always stay; the method
    adds candidates of probability 0.5 and more. Without a ``model``, one is fitted to
    all candidates of ``df`` first (a pass over the texts whose result is a bounded
    table of counts). A null text counts as empty and has no spans. Columns of the new
    names are replaced, others kept; repeated rows are treated alike; an empty table
    stays empty. No shuffle but that of the counts.
    """
    found = candidates(df, text)
    if model is None:
        counted = aggregate_votes(candidates(df.select(frames.col(text).alias("text")), "text"))
        model = fit(counted, prior=0.5, held=HELD, known=KNOWN)

    def bare(c):
        return F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"))

    def in_order(spans):
        def rank(c):
            place = F.array_position(F.array(*map(F.lit, KINDS)), c["kind"])
            return F.struct(place.alias("k"), c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))

        def once(sorted_spans):
            return F.filter(sorted_spans, lambda c, i: (i == 0) | (c != F.get(sorted_spans, i - 1)))

        return F.transform(_with(F.sort_array(F.transform(spans, rank)), once), bare)

    added = F.filter("_more", lambda c: probability(c, model) >= 0.5)
    return (
        found.withColumn("base_spans", in_order(F.col("_base")))
        .withColumn("all_spans", F.when(F.size("_more") == 0, F.col("base_spans")).otherwise(in_order(F.concat("_base", added))))
        .drop("_body", "_base", "_more")
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "all_spans") -> DataFrame:
    """``df`` with every span of the text replaced by its kind in angle brackets; spans that overlap count as the first.

    Pieces are cut from the text as four bytes a code point, so each is found at once however far it is from the start.
    """
    body = frames.col(text)
    by_start = F.sort_array(
        F.transform(frames.col(spans), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind")))
    )

    def piece(wide, start, end):
        return F.decode(F.substring(wide, (4 * start + 1).cast("int"), (4 * F.greatest(end - start, F.lit(0))).cast("int")), "UTF-32")

    def cut(both):
        wide, ordered = both["wide"], both["ordered"]
        reached = _before(F.transform(ordered, lambda c: c["e"]), F.greatest)
        told = F.zip_with(
            ordered, reached,
            lambda c, upto: F.when(c["s"] >= upto, F.concat(piece(wide, upto, c["s"]), F.lit("<"), F.upper(c["kind"]), F.lit(">"))).otherwise(""),
        )
        end = F.array_max(F.transform(ordered, lambda c: c["e"]))
        rest = piece(wide, end, F.length(wide).cast("bigint") / 4)
        return F.concat(F.array_join(told, ""), rest)

    both = F.struct(F.encode(body, "UTF-32").alias("wide"), by_start.alias("ordered"))
    held = F.coalesce(F.size(frames.col(spans)), F.lit(0)) > 0
    return df.withColumn(text, F.when(held, _with(both, cut)).otherwise(body))
