"""Price patterns: a letter per bar, and a regular expression as the state machine that reads them."""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.windows import by_day

#: A fall of three days or more, then a rise of two or more.
REVERSAL = "D{3,}U{2,}"


def direction() -> Column:
    """U, D or F for a close above, below or at the one before; - for a symbol's first bar."""
    before = F.lag("close_c").over(by_day())
    return (
        F.when(before.isNull(), "-")
        .when(F.col("close_c") > before, "U")
        .when(F.col("close_c") < before, "D")
        .otherwise("F")
    )


def find(bars: DataFrame, pattern: str = REVERSAL, letter: Column | None = None) -> DataFrame:
    """Where a symbol's letters, in the order of days, match ``pattern``: leftmost, as long as it reads, not overlapping.

    ``(symbol, start_date, end_date, n_days, letters, first_c, low_c, high_c, last_c)``. ``letter`` gives one
    character per bar; ``direction`` unless given. Any window over a symbol's bars may make it.

    A symbol's letters, one character a bar and a bar a day, are read as one string by the expression's
    automaton, in one pass. Matches find their bars again by symbol and number.
    """
    if re.fullmatch(pattern, ""):
        raise ValueError("the pattern matches nothing at all")
    numbered = bars.withColumn("letter", direction() if letter is None else letter).withColumn(
        "i", F.row_number().over(by_day()) - 1
    )
    word = numbered.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("i", "letter"))).alias("all"))
    word = word.select("symbol", F.array_join(F.transform("all", lambda one: one["letter"]), "").alias("word"))
    between = F.transform(F.split("word", pattern, -1), lambda gap: F.length(gap))
    matches = F.regexp_extract_all("word", F.lit(pattern), F.lit(0))
    cut = word.select("symbol", F.posexplode(F.arrays_zip(between.alias("gap"), matches.alias("letters"))).alias("k", "part"))
    sizes = cut.select("symbol", "k", F.col("part.gap").alias("gap"), F.col("part.letters").alias("letters"))
    before = Window.partitionBy("symbol").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(F.col("gap") + F.coalesce(F.length("letters"), F.lit(0))).over(before), F.lit(0))
    found = sizes.withColumn("start", ended + F.col("gap")).where("letters is not null")
    each = found.select("symbol", "start", "letters", F.explode(F.sequence("start", F.col("start") + F.length("letters") - 1)).alias("i"))
    met = each.withColumn("i", F.col("i").cast("int")).join(numbered, ["symbol", "i"])
    return met.groupBy("symbol", "start", "letters").agg(
        F.min("trade_date").alias("start_date"),
        F.max("trade_date").alias("end_date"),
        F.count(F.lit(1)).alias("n_days"),
        F.min_by("close_c", "i").alias("first_c"),
        F.min("close_c").alias("low_c"),
        F.max("close_c").alias("high_c"),
        F.max_by("close_c", "i").alias("last_c"),
    ).drop("start")
