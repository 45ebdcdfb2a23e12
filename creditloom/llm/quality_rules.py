"""Line-first quality rules, in DataFrame functions only.

Every line with a word is judged by itself: does it end like prose, is it a navigation strip, is it boilerplate? Lines that
fail are removed. A document goes if its base figures fail or if the removed lines held too much of its text.

Null texts count as empty: no words, so the base test rejects them. Lines without a word stay and count for nothing.
Rows are judged one by one, so ties, repeated rows and null ids give a row each; other columns pass through, except that an
output column replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.texts import BLANK_RUN, BLANKS, blank_words, packed, replacing, text_of

SYMBOLS = r"[#*$%&|<>]"
BARS = r"[|\x{BB}\x{203A}\x{B7}]"
SHOUT = r"[!?]{2}"
#: The bits of a window's key that hold its position.
PLACE = (1 << 31) - 1
#: Phrases of page furniture, tried on lines in lower case.
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|uses cookies|accept cookies|enable javascript"
    "|lorem ipsum|click here|read more|sign up|log in|subscribe to|skip to content|back to top"
)
TERMINAL = r"[.!?:;,\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{061F}\x{0964}\x{203A}\x{00BB}\x{201D}\x{2019}\"')\]]$"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    #: percent of words inside repeated three-word windows
    max_repeat_percent: int = 50
    #: a line with fewer words must end in a mark of punctuation
    unmarked_words: int = 5
    #: percent of a line's characters, blanks left out, that may be symbols
    max_symbol_percent: int = 10
    #: percent of words that may end in a doubled exclamation or question mark
    max_shout_percent: int = 30
    #: only lines with fewer words are tried for boilerplate phrases
    boilerplate_words: int = 30
    #: a line is navigation from so many bars, if there is one for every ``words_per_bar`` words
    min_bars: int = 2
    words_per_bar: int = 6
    #: percent of the characters in words that removed lines may hold
    max_lost_percent: int = 50


RULES = Rules()


def _solid(text: Column) -> Column:
    """Characters of a text outside ASCII white space."""
    return F.length(F.regexp_replace(text, BLANK_RUN, ""))


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, chars, ""))


def line_fails(line: Column, rules: Rules = RULES) -> Column:
    """Whether a line fails the punctuation, navigation or boilerplate rule. A line without a word passes.

    Counts are only taken of lines that hold a mark to count.
    """
    words = F.size(blank_words(line))
    few, brief = (~line.rlike(rf"^[ \x09-\x0D]*([^ \x09-\x0D]+[ \x09-\x0D]+){{{n - 1}}}[^ \x09-\x0D]") for n in (rules.unmarked_words, rules.boilerplate_words))
    marked = line.rlike(rf"{SYMBOLS}|{BARS}|{SHOUT}")
    bars = _count(line, BARS)
    counted = (
        (_count(line, SYMBOLS) * 100 > _solid(line) * rules.max_symbol_percent)
        | ((F.size(F.split(line, SHOUT)) - 1) * 100 > words * rules.max_shout_percent)
        | ((bars >= rules.min_bars) & (bars * rules.words_per_bar >= words))
    )
    unmarked = few & ~F.rtrim(line, F.lit(BLANKS)).rlike(TERMINAL) & (F.btrim(line, F.lit(BLANKS)) != "")
    return (marked & counted) | unmarked | (brief & F.lower(line).rlike(BOILERPLATE))


def _keyed(words: Column) -> Column:
    """A sorted long for every three-word window: 33 bits of its hash, then its position in 31 bits."""
    return F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.shiftleft(F.shiftright(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), 31), 31).bitwiseOR(i.cast("long")),
        )
    )


def _neighbours(keyed: Column) -> Column:
    """Positions of neighbours in ``keyed`` whose hashes agree, as pairs."""
    return F.filter(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(keyed) - 1, F.lit(1))),
            lambda k: F.when(
                F.shiftright(F.get(keyed, k - 1), 31) == F.shiftright(F.get(keyed, k), 31),
                F.array(F.get(keyed, k - 1).bitwiseAND(PLACE), F.get(keyed, k).bitwiseAND(PLACE)),
            ),
        ),
        lambda pair: pair.isNotNull(),
    )


def _same(words: Column, pair: Column) -> Column:
    a, b = (F.get(pair, n).cast("int") for n in (0, 1))
    return (F.get(words, a) == F.get(words, b)) & (F.get(words, a + 1) == F.get(words, b + 1)) & (F.get(words, a + 2) == F.get(words, b + 2))


def _pairs_by_text(words: Column) -> Column:
    """What ``_neighbours`` gives, from whole windows with their positions behind them; for texts in which hashes collide."""
    entries = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2), F.lpad(i.cast("string"), 10, "0")),
        )
    )
    return F.filter(
        F.zip_with(
            entries, F.slice(entries, F.lit(2), F.greatest(F.size(entries) - 1, F.lit(0))),
            lambda a, b: F.when(
                F.substring_index(a, " ", 3) == F.substring_index(b, " ", 3),
                F.array(F.substring_index(a, " ", -1).cast("long"), F.substring_index(b, " ", -1).cast("long")),
            ),
        ),
        lambda pair: pair.isNotNull(),
    )


def _covered(pairs: Column) -> Column:
    """Words that lie in a three-word window at any of the positions."""
    def sweep(state: Column, at: Column) -> Column:
        return F.struct((state["n"] + F.least(at - state["last"], F.lit(3))).alias("n"), at.alias("last"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    return F.aggregate(F.sort_array(F.array_distinct(F.flatten(pairs))), start, sweep)["n"]


def with_repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words that lie in a three-word window found twice or more in the text.

    Windows are sorted as longs made of hash and position; equal windows are then neighbours, and their words are compared.
    A text in which two different windows share a hash is done again with whole windows, so the count is exact.
    """
    out = replacing(df, _keyed=F.when(F.size(words) >= 3, _keyed(F.col(words))).otherwise(F.array().cast("array<bigint>")))
    out = replacing(out, _pairs=F.when(F.size("_keyed") > 1, _neighbours(F.col("_keyed"))).otherwise(F.array().cast("array<array<bigint>>")))
    sound = F.forall("_pairs", lambda pair: _same(F.col(words), pair))
    return replacing(out, **{name: F.when(sound, _covered(F.col("_pairs"))).otherwise(_covered(_pairs_by_text(F.col(words))))}).drop("_keyed", "_pairs")


def judge(df: DataFrame, text: str = "text", rules: Rules = RULES) -> DataFrame:
    """``df`` with the base figures, ``kept`` and ``clean_text``, the text without the lines that fail."""
    body = text_of(text)
    staged = replacing(df, _body=body, _words=blank_words(body), _lines=F.split(body, "\n", -1))
    lines = F.col("_lines")
    staged = replacing(
        staged, _good=F.filter(lines, lambda x: ~line_fails(x, rules)), _worded=F.filter(lines, lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    )
    words = F.col("_words")
    staged = replacing(
        staged,
        n_words=F.size(words).cast("long"),
        word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_symbols=_count(F.col("_body"), SYMBOLS).cast("long"),
        n_dup_lines=(F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        clean_text=F.array_join("_good", "\n"),
    )
    staged = with_repeated_words(staged, "_words", "n_repeat_words")
    base = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    lost = (F.col("word_chars") - _solid(F.col("clean_text"))) * 100 > F.col("word_chars") * rules.max_lost_percent
    judged = replacing(staged, base_failed=base, n_lost_chars=(F.col("word_chars") - _solid(F.col("clean_text"))).cast("long"), kept=~base & ~lost)
    return judged.drop("_body", "_words", "_lines", "_good", "_worded")


def clean(df: DataFrame, text: str = "text", rules: Rules = RULES) -> DataFrame:
    """The documents that pass, without their failing lines; all other columns stay as they are, whatever their names.

    The row number keeps the filter above the judged columns; pushed below them, it would spell out every figure again wherever it is used.
    """
    judged = replacing(judge(packed(df, text, _text=F.col(f"`{text}`")), "_text", rules), _row=F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("_row") >= 0)).select(
        *(F.col("clean_text").alias(c) if c == text else F.col(f"_whole.`{c}`").alias(c) for c in df.columns)
    )
