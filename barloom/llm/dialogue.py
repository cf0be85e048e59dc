"""Conversation repair: the cheapest edits that make roles alternate, by a lightest-derivation agenda.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Edits of runs of
turns are deductions: a run leads from one state of that pattern to another at a cost and
with an audit, the initials of its edits. Two adjoining runs make a longer one. Items are
popped from an agenda by weight until the whole conversation's is final.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import frames

#: After nothing, a system turn, a user turn, an assistant turn; a conversation may end in the first or last.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "x": {},
}
GOALS = ((START, START), (START, ASSISTANT))

#: A turn's code tells its role's initial (x: any other) and its fault: none, truncated, blank, duplicate.
SOUND, TRUNCATED, BLANK, DUPLICATE = "suax", "SUAX", "0123", "4567"
INITIAL = {code: "suax"[i] for codes in (SOUND, TRUNCATED, BLANK, DUPLICATE) for i, code in enumerate(codes)}
LEGAL = {"su", "ua", "au"}

#: Conversations of over this many turns are solved in blocks first.
BLOCK = 32

_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    """Keep is free; undeleted truncated turns cost ``truncated`` more; inserted turns are empty."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


#: (cost, length of the audit, audit). Joining two runs adds the first two and strings the audits
#: together, which never gives less than either and keeps the order of its parts: a superior function.
#: With cost and audit alone it would not be one ("K" before "RK" is less than "RK").
Weight = tuple[int, int, str]
Table = dict[tuple[int, int], Weight]


def edits(code: str, costs: Costs) -> Table:
    """The edits of one turn."""
    found: Table = {}

    def add(p: int, q: int, cost: int, edit: str) -> None:
        found[p, q] = min(found.get((p, q), (cost, 1, edit)), (cost, 1, edit))

    for p in range(4):
        add(p, p, costs.delete, "D")
    if code in SOUND + TRUNCATED:
        more = costs.truncated if code in TRUNCATED else 0
        for p, q in STEPS[INITIAL[code]].items():
            add(p, q, more, "K")
        for role in "ua":
            for p, q in STEPS[role].items():
                add(p, q, more + costs.rerole, "R")
    return found


def agenda(leaves: list[Table], insert: int | None = None, goals=GOALS) -> Table:
    """Lightest weights of going through all ``leaves`` from one state to another.

    Items are (run of leaves, from, to), runs those of a balanced tree. ``insert`` is the cost of a
    turn inserted after a leaf, if any may be. Stops at the first of ``goals``, or goes on to the end if None.
    """
    parents: list[tuple[int, int, bool] | None] = [None] * len(leaves)  # (parent, sibling, is the left one)
    level = list(range(len(leaves)))
    while len(level) > 1:
        above = []
        for i in range(0, len(level) - 1, 2):
            node = len(parents)
            parents.append(None)
            parents[level[i]] = (node, level[i + 1], True)
            parents[level[i + 1]] = (node, level[i], False)
            above.append(node)
        level = above + level[len(level) // 2 * 2 :]
    root = level[0]
    final: list[Table] = [{} for _ in parents]
    heap = [(*weight, leaf, p, q) for leaf, table in enumerate(leaves) for (p, q), weight in table.items()]
    heapq.heapify(heap)
    while heap:
        cost, length, audit, node, p, q = heapq.heappop(heap)
        if (p, q) in final[node]:
            continue
        final[node][p, q] = (cost, length, audit)
        if node == root and goals is not None and (p, q) in goals:
            break
        if insert is not None and node < len(leaves):
            for role in "ua":
                if q in STEPS[role]:
                    heapq.heappush(heap, (cost + insert, length + 1, audit + "I", node, p, STEPS[role][q]))
        if parents[node] is None:
            continue
        parent, sibling, left = parents[node]
        for (a, b), (more, longer, other) in final[sibling].items():
            if left and a == q and (p, b) not in final[parent]:
                heapq.heappush(heap, (cost + more, length + longer, audit + other, parent, p, b))
            elif not left and b == p and (a, q) not in final[parent]:
                heapq.heappush(heap, (cost + more, length + longer, other + audit, parent, a, q))
    return final[root]


class Repairs:
    """Cheapest edits of codes; conversations of the same codes are solved once."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.turns = {code: edits(code, costs) for code in INITIAL}
        self.block = functools.lru_cache(1 << 14)(self._block)
        self.short = functools.lru_cache(1 << 14)(self._short)

    def _leaves(self, codes: str, opens: bool) -> list[Table]:
        """The turns' edits; before the first of all, nothing, after which turns may be inserted."""
        nothing: list[Table] = [{(p, p): (0, 0, "") for p in range(4)}]
        return nothing * opens + [self.turns[code] for code in codes]

    def _block(self, codes: str, opens: bool) -> Table:
        return agenda(self._leaves(codes, opens), self.costs.insert, goals=None)

    def _short(self, codes: str) -> Table:
        return agenda(self._leaves(codes, True), self.costs.insert)

    def cheapest(self, codes: str) -> tuple[int, str]:
        """Cost and audit; of equally cheap audits the shortest, then the least in ASCII.

        With the costs given, an inserted turn is never cheapest: taking it out along with
        its neighbour costs less. All cheapest audits are then of one length.
        """
        if len(codes) <= BLOCK:
            found = self.short(codes)
        else:
            found = agenda([self.block(codes[i : i + BLOCK], i == 0) for i in range(0, len(codes), BLOCK)])
        cost, _, audit = min(found[goal] for goal in GOALS if goal in found)
        return cost, audit


def damage(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): turns with faults put in by CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops the turn (``dropped`` is set, so that its conversation stays known), 1 empties it, 2 takes
    out . ! ?, 3 repeats it, 4 makes it the user's. Nulls read as one space; ids and turns stay null.
    """
    ids = [F.coalesce(frames.col(name).cast("string"), F.lit(" ")) for name in (conv_id, turn)]
    chosen = df.select(
        frames.col(conv_id).alias("conv_id"),
        frames.col(turn).alias("turn"),
        F.coalesce(frames.col(role), F.lit(" ")).alias("role"),
        F.coalesce(frames.col(text), F.lit(" ")).alias("text"),
        (F.crc32(F.concat_ws(":", *ids)) % 20).alias("fault"),
    )
    fault, said = F.col("fault"), F.col("text")
    return chosen.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _turns(df: DataFrame, dropped: str | None, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns needed, without nulls in role and text; ``print`` is the text's MD5."""
    said = F.coalesce(frames.col(text), F.lit(" "))
    return df.select(
        frames.col(conv_id).cast("bigint").alias("conv"),
        frames.col(turn).cast("bigint").alias("turn"),
        F.coalesce(frames.col(role), F.lit(" ")).alias("role"),
        F.unhex(F.md5(said)).alias("print"),
        said.alias("text"),
        (F.lit(False) if dropped is None else F.coalesce(frames.col(dropped), F.lit(False))).alias("dropped"),
    )


def _code(repeats: Column) -> Column:
    """The code of a turn; none if it was dropped."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    end = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    return (
        F.when(F.col("dropped"), "")
        .when(end == "", F.translate(kind, SOUND, BLANK))
        .when(repeats, F.translate(kind, SOUND, DUPLICATE))
        .when(~end.isin(".", "!", "?"), F.translate(kind, SOUND, TRUNCATED))
        .otherwise(kind)
    )


_AUDITS = {
    "conv": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint",
    "illegal": "bigint", "cost": "bigint", "audit": "string",
}
_AUDITS_DDL = ", ".join(f"{name} {kind}" for name, kind in _AUDITS.items())


def _batch(rows: list[tuple], fields: dict[str, str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    types = [frames._ARROW[kind] for kind in fields.values()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=list(fields))


def _audit_stream(costs: Costs) -> Callable:
    """Over turns sorted by conversation: a row per conversation. Holds a byte per turn of one conversation."""

    def closed(repairs: Repairs, conv, codes: bytearray, first, last, different: int) -> tuple:
        whole = codes.decode()
        initials = "".join(map(INITIAL.__getitem__, whole))
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        counts = [sum(map(whole.count, kind)) for kind in (BLANK, DUPLICATE, TRUNCATED)]
        gaps = 0 if first is None else last - first + 1 - different
        return (conv, gaps, *counts, illegal, *repairs.cheapest(whole))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, repairs = None, Repairs(costs)
        for batch in batches:
            done = []
            for conv, turn, code in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != state[0]:
                    if state is not None:
                        done.append(closed(repairs, *state))
                    state = [conv, bytearray(), None, None, 0]
                if not code:
                    continue
                state[1] += code.encode()
                if turn is not None and turn != state[3]:
                    state[2] = turn if state[2] is None else state[2]
                    state[3] = turn
                    state[4] += 1
            yield _batch(done, _AUDITS)
        if state is not None:
            yield _batch([closed(repairs, *state)], _AUDITS)

    return work


def audits(
    df: DataFrame, costs: Costs = Costs(), dropped: str | None = None,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation.

    Turns are taken in the order of ``turn``, nulls first; of equal ones by role and the MD5 of the
    text. A turn is blank without a character other than ASCII white space; else a duplicate if an
    earlier one has its role and text; else truncated if its last such character is none of . ! ?.
    ``gaps`` counts the turn numbers missing between the least and the greatest. Nulls in
    role and text read as one space; turns without a conversation id make up one of their own.
    Rows flagged in the column ``dropped`` only make their conversation known; one with no
    other has zeros and an empty audit. An empty table stays empty.

    One shuffle, without texts, by conversation. Within its task a conversation is sorted on
    disk and streamed; a byte of each turn is held, as in the audit that comes out.
    """
    turns = _turns(df, dropped, conv_id, turn, role, text)
    end = turns.withColumn("text", F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1))  # all that the codes need
    same = Window.partitionBy("conv", "dropped", "role", "print").orderBy(F.asc_nulls_first("turn"))
    placed = end.repartition("conv").withColumn("copy", F.row_number().over(same))
    ordered = placed.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "print", "copy")
    return ordered.select("conv", "turn", _code(F.col("copy") > 1).alias("code")).mapInArrow(_audit_stream(costs), _AUDITS_DDL)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Per batch of sorted rows, (conversation's own row, None) where one begins and (role, text) for each turn that stays."""
    names = list(_AUDITS)
    audit, at, place, offset = "", 0, 0, 0

    def role_here() -> str:
        return "assistant" if (place - offset) % 2 else "user"

    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                while at < len(audit):  # turns inserted at the end
                    found.append((role_here(), ""))
                    at, place = at + 1, place + 1
                audit, at, place = row["audit"], 0, 0
                offset = (len(audit) - audit.count("D")) % 2
                found.append((tuple(row[name] for name in names), None))
                continue
            while audit[at] == "I":
                found.append((role_here(), ""))
                at, place = at + 1, place + 1
            if audit[at] != "D":
                found.append((row["role"] if audit[at] == "K" else role_here(), row["text"]))
                place += 1
            at += 1
        yield found
    yield [(("assistant" if (place + i - offset) % 2 else "user"), "") for i in range(len(audit) - at)]


def _with_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's own row, then its turns in order, streamed by conversation."""
    own = found.select(*_AUDITS, *[F.lit(None).cast(kind).alias(name) for name, kind in (("turn", "bigint"), ("role", "string"), ("print", "binary"), ("text", "string"))])
    said = turns.where("not dropped").drop("dropped")
    both = own.unionByName(said, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "print"
    ).drop("turn", "print")


def repaired(
    df: DataFrame, costs: Costs = Costs(), dropped: str | None = None,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv, place, role, text): the turns of each conversation as repaired, ``place`` from 0."""
    turns = _turns(df, dropped, conv_id, turn, role, text)
    rows = _with_audits(turns, audits(df, costs, dropped, conv_id, turn, role, text))
    fields = {"conv": "bigint", "place": "bigint", "role": "string", "text": "string"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place = None, 0
        for found in _walk(batches):
            out = []
            for first, said in found:
                if said is None:
                    conv, place = first[0], 0
                else:
                    out.append((conv, place, first, said))
                    place += 1
            yield _batch(out, fields)

    return rows.mapInArrow(work, "conv bigint, place bigint, role string, text string")


def digests(
    df: DataFrame, costs: Costs = Costs(), dropped: str | None = None,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``audits`` with ``repaired_sha256``, the lowercase SHA-256 of the repaired ``role:text``, joined by line feeds.

    A second shuffle brings texts, sorted, to their conversation's audit; they are hashed as they stream
    by, so a task holds one batch of them. The hash of one text is made in order, so
    of a conversation with a third of all turns this step alone can't be shared between tasks.
    """
    turns = _turns(df, dropped, conv_id, turn, role, text)
    rows = _with_audits(turns, audits(df, costs, dropped, conv_id, turn, role, text))
    fields = {**_AUDITS, "repaired_sha256": "string"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashed, empty = None, hashlib.sha256(), True
        for found in _walk(batches):
            out = []
            for first, said in found:
                if said is None:
                    if own is not None:
                        out.append((*own, hashed.hexdigest()))
                    own, hashed, empty = first, hashlib.sha256(), True
                else:
                    hashed.update(f"{'' if empty else chr(10)}{first}:{said}".encode())
                    empty = False
            yield _batch(out, fields)
        if own is not None:
            yield _batch([(*own, hashed.hexdigest())], fields)

    return rows.mapInArrow(work, f"{_AUDITS_DDL}, repaired_sha256 string")
