"""Line-first quality rules, built of DataFrame functions only.

Every line of a text is judged by itself (punctuation, navigation, boilerplate), failing lines are taken out, and a
document goes if too much of it was taken out. A few whole-text base rules come before that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are maximal runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5

#: Phrases of boilerplate (lower case, of ASCII letters and spaces), matched between word bounds.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds. Base: min_words, max_repeat_percent. Lines: the others; max_lost is a share of the words."""

    min_words: int = 10
    max_repeat_percent: int = 20
    #: A line fails as unpunctuated if it has this many words at least and no mark of MARKS at all.
    long_line_words: int = 30
    #: A line fails as punctuation noise if more than this percentage of its characters match SYMBOL.
    max_symbol_percent: int = 10
    #: A line fails as navigation if it has this many free-standing separators at least, and as many for every
    #: `separator_every` words.
    min_separators: int = 2
    separator_every: int = 6
    #: A line fails as boilerplate if it holds a phrase and has this many words at most, or if the phrases make up this
    #: percentage of its words at least.
    boilerplate_words: int = 12
    min_boilerplate_percent: int = 30
    boilerplate: tuple[str, ...] = field(default=BOILERPLATE)
    max_lost_percent: int = 50


MARKS = r"[.,;:!?\x{2026}\x{3002}\x{061F}\x{0964}]"
SEPARATOR = r"(?:^|(?<=[\x20\x09-\x0D]))[|\x{00BB}\x{203A}\x{2022}\x{00B7}>](?=\z|[\x20\x09-\x0D])"


def _symbols(col: Column) -> Column:
    return F.regexp_count(col, F.lit(SYMBOL))


def _words(col: Column) -> Column:
    return F.filter(F.split(col, WORD_GAP), lambda w: w != "")


def _line_passes(line: Column, has_symbols: Column, has_boilerplate: Column, rules: QualityRules) -> Column:
    """True if the line passes every rule; a line without a word passes, since it has nothing to lose.

    Cheap tests stand first, and what the whole text lacks isn't looked for in its lines.
    """
    n_words = F.size(_words(line))
    unpunctuated = ~line.rlike(MARKS) & (n_words >= rules.long_line_words)
    noisy = has_symbols & (_symbols(line) * 100 > F.length(line) * rules.max_symbol_percent)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (
        line.rlike(SEPARATOR)
        & (separators >= rules.min_separators)
        & (separators * rules.separator_every >= n_words)
    )
    phrases = _phrases(rules.boilerplate)
    found = F.regexp_extract_all(F.lower(line), F.lit(phrases), F.lit(0))
    boilerplate = (
        has_boilerplate
        & F.lower(line).rlike(phrases)
        & (
            (n_words <= rules.boilerplate_words)
            | (F.size(_words(F.array_join(found, " "))) * 100 >= n_words * rules.min_boilerplate_percent)
        )
    )
    return ~(unpunctuated | noisy | navigation | boilerplate) | ~line.rlike(HAS_WORD)


def _phrases(phrases: tuple[str, ...]) -> str:
    return rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(phrases)})(?![\p{{L}}\p{{N}}_])" if phrases else r"(?!)"


def _contains_any(text: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


def _with_window_hashes(parts: DataFrame) -> DataFrame:
    """Adds _hashes, one for each window of WINDOW words, made of the hashes of ever longer runs of words.

    Each length is a projection of its own, so that no array is computed twice.
    """

    def joined(left: str, right: str, shift: int) -> Column:
        count = F.greatest(F.size(right) - shift, F.lit(0))
        return F.zip_with(
            F.slice(left, F.lit(1), count), F.slice(right, F.lit(shift + 1), count), lambda a, b: F.xxhash64(a, b)
        )

    held, size = parts.withColumn("_run1", F.transform("_words", lambda w: F.xxhash64(w))), 1
    while size < WINDOW:
        step = size if 2 * size <= WINDOW else 1
        held = held.select("*", joined(f"_run{size}", f"_run{step}", size).alias(f"_run{size + step}"))
        size += step
    return held.withColumnRenamed(f"_run{size}", "_hashes")


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside a window of WINDOW words that the array holds twice or more, the first occurrence included.

    Distinct hashes prove distinct windows, so most texts stop there; in the others the windows whose hash another has
    as well, and no more, are compared word for word.
    """
    def hashed_twice(held: Column) -> Column:
        """Places of hashes equal to a neighbour in sorted order."""
        same = lambda x, y: F.coalesce(y["h"] == x["h"], F.lit(False))
        alike = F.filter(held, lambda x, j: same(x, F.get(held, j - 1)) | same(x, F.get(held, j + 1)))
        return F.transform(alike, lambda x: x["i"])

    # the arrays around them bind sorted arrays once instead of sorting for every element
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.flatten(F.transform(F.array(by_hash), hashed_twice))
    spelled = F.sort_array(
        F.transform(places, lambda i: F.struct(F.slice(words, i + 1, WINDOW).alias("w"), i.alias("i")))
    )

    def twice(held: Column) -> Column:
        """Positions of windows equal to a neighbour in sorted order."""
        return F.transform(
            F.filter(
                held,
                lambda x, j: F.coalesce(F.get(held, j - 1)["w"] == x["w"], F.lit(False))
                | F.coalesce(F.get(held, j + 1)["w"] == x["w"], F.lit(False)),
            ),
            lambda x: x["i"],
        )

    starts = F.sort_array(F.flatten(F.transform(F.array(spelled), twice)))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    all_distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(all_distinct, F.lit(0)).otherwise(covered)


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: QualityRules = QualityRules()
) -> DataFrame:
    """Counts, base verdict, cleaned text and verdict for every row of `docs`, in one pass without a shuffle.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines_removed,
    lost_words, clean_text, kept. Other columns of `docs`, whatever their names, are not looked at.

    Defined cases: a null text counts as empty; an empty text has no words, so it fails the base rules; a null id is
    passed on; repeated rows each get their row; an empty table gives an empty table.
    """
    text = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text")
    )
    parts = text.select(
        "doc_id",
        _words(F.col("_text")).alias("_words"),
        F.split("_text", "\n").alias("_lines"),
        _symbols(F.col("_text")).cast("long").alias("_n_symbols"),
        F.lower("_text").alias("_lower"),
    )
    worded = F.filter(F.col("_lines"), lambda line: line.rlike(HAS_WORD))
    symbols, boilerplate = F.col("_n_symbols") > 0, F.col("_boilerplate")
    clean = F.filter(F.col("_lines"), lambda line: _line_passes(line, symbols, boilerplate, rules))
    parts = parts.withColumn("_boilerplate", _contains_any(F.col("_lower"), rules.boilerplate)).drop("_lower")
    counted = _with_window_hashes(parts).select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"),
        repeated_words(F.col("_words"), F.col("_hashes")).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
        worded.alias("_worded"),
        clean.alias("_clean"),
    )
    judged = counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (
            (F.col("n_words") < rules.min_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
        ).alias("base_failed"),
        (F.col("_n_lines") - F.size("_clean")).cast("long").alias("n_lines_removed"),
        F.array_join("_clean", "\n").alias("clean_text"),
    )
    lost = F.col("n_words") - F.size(_words(F.col("clean_text")))
    lossy = judged.withColumn("lost_words", F.when(F.col("n_lines_removed") == 0, F.lit(0)).otherwise(lost).cast("long"))
    # A condition on the result must not be pushed below these projections, or the arrays that they compute once would
    # be computed anew wherever they are used. The optimizer leaves conditions above what is not deterministic.
    stop = F.monotonically_increasing_id() >= 0
    return lossy.withColumn(
        "kept",
        ~F.col("base_failed") & (F.col("lost_words") * 100 <= F.col("n_words") * rules.max_lost_percent) & stop,
    )
