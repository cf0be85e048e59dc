"""Quality rules by compression bands.

zstandard ratios (bytes over compressed bytes) of the whole text and of fixed chunks
lie in a band for prose; above it a text repeats itself, below it is incompressible.
Longer texts compress better, so the band of the whole depends on the length. The
bands come from the ratios of all documents: median and quartiles by length, as
distances from a fixed curve, so that few documents give bands like those of many.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """How bands are drawn.

    Length classes are quarter octaves of bytes. A class is judged by the ``enough`` or more
    different (length, ratio) values nearest to it: its own and those of as many classes on
    either side as that takes, each as its distance (in logarithms) from ``CURVE``, which
    takes out the effect of length. If the whole table has fewer, the missing ones are
    drawn from the curve itself, with deviation ``spread``. A band is the median, more or
    less ``width`` deviations, at every class and table size; a deviation is the quartile
    distance over 1.349, or ``least`` if that is more. No band goes below ``floor`` or above
    ``ceiling`` times the curve. A text fails too if over half of its chunks lie outside the band of all documents'
    middle chunk ratios, drawn in the same way, whether above it or below. Chunks are of ``chunk`` bytes; the last
    one reaches back so far that it is full. Texts shorter than that have none and are judged by their whole; under
    some 250 bytes random words compress hardly worse than short prose does, and pass.
    """

    chunk: int = 1_024
    width: float = 4.5
    least: float = 0.02
    enough: int = 40
    spread: float = 0.02
    floor: float = 0.65
    ceiling: float = 1.8
    level: int = 3


#: The usual ratio of prose (level 3) by log2 of its bytes, straight between and level beyond.
CURVE = ((5, 0.80), (6, 1.00), (7, 1.28), (8, 1.50), (9, 1.66), (10, 1.88), (11, 2.04), (12, 2.17), (13, 2.26), (14, 2.37), (16, 2.50), (17, 2.57))
#: Cells of log ratios in which values are counted: a quarter of a percent.
CELLS = 400


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(map(b" ".join, zip(words, words[1:], words[2:], words[3:], words[4:])))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        end = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 5 - max(i, end)
                end = i + 5
    return (
        n,
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


def ratios(data: bytes, chunk: int, compressor: zstandard.ZstdCompressor) -> tuple[float, float | None, list[float]]:
    """Ratio of the whole, the middle (lower median) ratio of the chunks, if any, and each chunk's."""
    starts = list(range(0, len(data) - chunk + 1, chunk))
    if starts and len(data) % chunk:
        starts.append(len(data) - chunk)
    parts = [chunk / len(compressor.compress(data[i : i + chunk])) for i in starts]
    middle = sorted(parts)[(len(parts) - 1) // 2] if parts else None
    return len(data) / len(compressor.compress(data)), middle, parts


def measure(df: DataFrame, rule: Rule = Rule(), text: str = "text") -> DataFrame:
    """``df`` with the base counts, ``base_failed``, ``n_bytes``, ``ratio``, ``chunk_ratio`` and ``chunk_ratios``.

    ``base_failed``: under 10 words, or over 20 % of the words in repeated windows of
    five. A null text counts as empty. Columns of these names are replaced, others
    kept. Every text is read whole, in its row, without a shuffle.
    """
    level, chunk = rule.level, rule.chunk

    def start():
        compressor = zstandard.ZstdCompressor(level=level)

        def work(texts):
            for text in texts:
                text = text or ""
                data = text.encode()
                n, chars, symbols, lines, repeated = base_counts(text)
                failed = n < 10 or 100 * repeated > 20 * n
                yield n, chars, symbols, lines, repeated, failed, len(data), *ratios(data, chunk, compressor)

        return work

    fields = {
        "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "n_bytes": "bigint", "ratio": "double",
        "chunk_ratio": "double", "chunk_ratios": "array<double>",
    }
    return frames.extend(df, [frames.col(text)], start, fields)


def length_class() -> Column:
    return F.floor(4 * F.log2(F.greatest(F.col("n_bytes"), F.lit(1)))).cast("int")


@dataclass(frozen=True)
class Bands:
    """(least, greatest) ratio by length class, and of the middle chunk."""

    whole: dict[int, tuple[float, float]]
    chunk: tuple[float, float]


def usual(n_bytes: float) -> float:
    """The ratio of ``CURVE`` at a length."""
    return float(np.interp(np.log2(n_bytes), *zip(*CURVE)))


def _quartiles(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    upto = np.cumsum(counts[order])
    return values[order][np.searchsorted(upto, np.array([0.25, 0.5, 0.75]) * upto[-1])]


def _band(centre: float, away: np.ndarray, counts: np.ndarray, rule: Rule) -> tuple[float, float]:
    """The band at a class, from the log distances of its values from their curve; what lacks of ``enough`` is drawn."""
    lacking = int(rule.enough - counts.sum())
    if lacking > 0:
        drawn = [rule.spread * NormalDist().inv_cdf((i + 0.5) / lacking) for i in range(lacking)]
        away, counts = np.append(away, drawn), np.append(counts, np.ones(lacking))
    low, middle, high = _quartiles(away, counts)
    deviation = max((high - low) / 1.349, rule.least)
    middle = np.exp(middle)
    return (
        float(centre * max(middle * (1 - rule.width * deviation), rule.floor)),
        float(centre * min(middle * (1 + rule.width * deviation), rule.ceiling)),
    )


def bands(measured: DataFrame, rule: Rule = Rule()) -> Bands:
    """Bands from all measured rows that pass the base rules; equal (length, ratio) values count once.

    One aggregate by length class and cell of ratios, so some thousands of rows reach the driver, however many documents.
    """
    values = measured.where("not base_failed").select("n_bytes", "ratio", "chunk_ratio").distinct()

    def cell(ratio: str) -> Column:
        return F.floor(CELLS * F.log(ratio)).cast("int").alias("cell")

    def counted(held: DataFrame) -> np.ndarray:
        return np.array([tuple(row) for row in held.collect()], dtype=float).reshape(-1, 3)

    classes = range(0, 4 * 48)
    centres = [usual(2 ** ((one + 0.5) / 4)) for one in classes]
    rows = counted(values.groupBy(length_class().alias("class"), cell("ratio")).agg(F.count("*").alias("n")))
    own = rows[:, 0].astype(int)
    away = (rows[:, 1] + 0.5) / CELLS - np.log(np.array(centres))[own]
    whole = {}
    for one in classes:
        far = np.abs(own - one)
        least = next((d for d in np.unique(far) if rows[far <= d, 2].sum() >= rule.enough), len(classes))
        near = far <= least
        whole[one] = _band(centres[one], away[near], rows[near, 2], rule)
    held = values.where("chunk_ratio is not null")
    chunks = counted(held.groupBy(F.lit(0).alias("class"), cell("chunk_ratio")).agg(F.count("*").alias("n")))
    centre = usual(rule.chunk)
    return Bands(whole, _band(centre, (chunks[:, 1] + 0.5) / CELLS - np.log(centre), chunks[:, 2], rule))


def judge(measured: DataFrame, limits: Bands, rule: Rule = Rule()) -> DataFrame:
    """``measured`` with ``kept``: not base_failed, and all ratios in their bands. Native expressions only."""
    by_class = [limits.whole[k] for k in sorted(limits.whole)]  # classes count from 0
    low, high = (F.get(F.array(*[F.lit(band[side]) for band in by_class]), length_class()) for side in (0, 1))
    whole = F.col("ratio").between(low, high)
    outside = F.size(F.filter("chunk_ratios", lambda ratio: ~ratio.between(*limits.chunk)))
    chunk = 2 * outside <= F.size("chunk_ratios")
    return measured.withColumn("kept", ~F.col("base_failed") & F.coalesce(whole & chunk, F.lit(True)))


def quality(df: DataFrame, rule: Rule = Rule(), text: str = "text") -> DataFrame:
    """``judge`` of ``measure``, with bands of the same rows.

    Rows repeated are judged alike; an empty table stays empty; a null or empty text
    has no words and fails. Write ``measure``'s result first where it is used again:
    here the texts are measured once for the bands and once for the result.
    """
    measured = measure(df, rule, text)
    return judge(measured, bands(measured, rule), rule)
