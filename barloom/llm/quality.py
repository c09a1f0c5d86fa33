"""Quality rules compiled into one projection (operator 5), in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.expressions import let

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is it that be as at by for on are this with or was from "
    "le la les de des du et en un une est que qui dans par pour sur pas au "
    "der die das und ist von mit den ein eine zu nicht auf sich "
    "el los las y del se al lo con para una por es no"
).split()

SYMBOLS = "#*$%&|<>"
_WHITE = "[ \\t-\\r]+"
_WHITE_CHARS = " \t\n\x0b\f\r"


class Rule(NamedTuple):
    """A row of the threshold table: the text fails where ``low <= measure <= high`` is false."""

    name: str
    measure: str
    low: float
    high: float


#: The threshold table. Measures are ratios (symbols: per word), or a mean per word; bounds are inclusive.
RULES = (
    Rule("length", "n_words", 10, 1_000_000),
    Rule("word_length", "mean_word_chars", 2, 16),
    Rule("symbols", "symbol_ratio", 0, 0.1),
    Rule("stop_words", "stop_ratio", 0.02, 1),
    Rule("duplicate_lines", "dup_line_ratio", 0, 0.5),
    Rule("repeated_words", "repeat_word_ratio", 0, 0.2),
)


def repeated_words(words: Column, n_words: Column, size: int = 5) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the array, first included.

    Windows are compared by 64-bit hashes within one text. Texts without a repeated window, the
    usual case, stop at the distinct count; else the windows are sorted once.
    """

    def window(hashes: Column) -> Column:
        last = F.greatest(n_words - size, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def found(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
            places = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
            return F.sort_array(F.filter(places, lambda p: p.isNotNull()))

        def total(at: Column) -> Column:
            step = lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(size)), F.lit(size))
            return F.aggregate(F.transform(at, step), F.lit(0).cast("long"), lambda a, b: a + b)

        return let(let(ordered, found), total)

    count = lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0).cast("long")).otherwise(covered(ws))
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n_words < size + 1, F.lit(0).cast("long")).otherwise(let(let(hashed, window), count))


def quality_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns and the counts and ratios of ``text`` the rules speak of.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage
    return. Null and empty texts have no words and 0 in every count; their ratios are 0. Whole
    texts are read; a text's arrays live only while its row is evaluated. Columns of ``df`` named
    like a measure are replaced, names that begin with ``_quality`` are refused. Repeated rows each
    have theirs; an empty table stays empty.
    """
    clash = [c for c in df.columns if c.lower().startswith("_quality")]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    own = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars",
        "symbol_ratio", "stop_ratio", "dup_line_ratio", "repeat_word_ratio",
    ]
    kept = [c for c in df.columns if c not in own or c == text]
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(F.col("_quality_body"), _WHITE), lambda w: w != "")
    lines = F.filter(F.split(F.col("_quality_body"), "\n"), lambda x: F.length(F.translate(x, _WHITE_CHARS, "")) > 0)
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return (
        df.select(*kept, body.alias("_quality_body"))
        .select(*kept, "_quality_body", words.alias("_quality_words"), lines.alias("_quality_lines"))
        .select(
            *kept,
            "_quality_words",
            F.size("_quality_words").cast("long").alias("n_words"),
            F.length(F.translate("_quality_body", _WHITE_CHARS, "")).cast("long").alias("word_chars"),
            (F.length("_quality_body") - F.length(F.translate("_quality_body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("_quality_lines").cast("long").alias("_quality_n_lines"),
            (F.size("_quality_lines") - F.size(F.array_distinct("_quality_lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.filter("_quality_words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("_quality_n_stops"),
        )
        .withColumn("n_repeat_words", repeated_words(F.col("_quality_words"), F.col("n_words")))
        .withColumns(
            {
                "mean_word_chars": ratio("word_chars", "n_words"),
                "symbol_ratio": ratio("n_symbols", "n_words"),
                "stop_ratio": ratio("_quality_n_stops", "n_words"),
                "dup_line_ratio": ratio("n_dup_lines", "_quality_n_lines"),
                "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
            }
        )
        .drop("_quality_words", "_quality_n_lines", "_quality_n_stops")
    )


def apply_rules(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``failed_rules`` (names in table order) and ``passes``: the table as one projection."""
    broken = [
        F.when(~F.col(r.measure).between(F.lit(r.low), F.lit(r.high)), F.lit(r.name)) for r in rules
    ]
    failed = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return measured.withColumn("failed_rules", failed).withColumn("passes", F.size("failed_rules") == 0)
