"""Text predicates and measures as Column expressions; all stay in the JVM.

Word characters are letters, numbers and the underscore, in Unicode; combining marks are not. White space is Unicode white space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kolam.functions.names import as_col

WORD_CHARACTER = r"[\p{L}\p{N}_]"
TELUGU_RANGE = (0x0C00, 0x0C7F)


def strip(c) -> Column:
    """The text without white space at its ends."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def word_pattern(word) -> Column:
    """A regular expression that finds a word as written, in any case, not inside a longer word.

    A side is only bounded where the word begins or ends with a word character, so that C++ is found in "C++!" too.
    """
    word = as_col(word)
    escaped = F.regexp_replace(word, r"([^\p{L}\p{N}_\s])", r"\\$1")
    before = F.when(word.rlike("^" + WORD_CHARACTER), F.lit(f"(?<!{WORD_CHARACTER})")).otherwise(F.lit(""))
    after = F.when(word.rlike(WORD_CHARACTER + "$"), F.lit(f"(?!{WORD_CHARACTER})")).otherwise(F.lit(""))
    return F.concat(F.lit("(?iu)"), before, escaped, after)


def contains_word(sentence, word) -> Column:
    """Whether a sentence contains a word by word_pattern; false where either is null or the word empty."""
    ok = F.regexp_like(as_col(sentence), word_pattern(word)) & (F.length(as_col(word)) > 0)
    return F.coalesce(ok, F.lit(False))


def word_count(c) -> Column:
    """The number of words parted by white space; 0 for a blank text, null for null."""
    return F.size(F.filter(F.split(as_col(c), r"(?U)\s+"), lambda x: x != ""))


def script_letter_ratio(c, low: int = TELUGU_RANGE[0], high: int = TELUGU_RANGE[1]) -> Column:
    """The part of a text's letters that lie in a range of code points; 0 without letters. Marks don't count on either side."""
    letters = F.regexp_replace(as_col(c), r"\P{L}", "")
    own = F.regexp_replace(letters, f"[^\\x{{{low:04X}}}-\\x{{{high:04X}}}]", "")
    return F.when(letters.isNotNull(), F.coalesce(F.try_divide(F.length(own), F.length(letters)), F.lit(0.0)))


def longest_latin_run(c) -> Column:
    """Letters of the longest run of basic Latin letters; white space doesn't end a run and doesn't count, anything else ends it."""
    runs = F.transform(F.split(as_col(c), r"(?U)[^A-Za-z\s]+"), lambda x: F.length(F.regexp_replace(x, r"(?U)\s+", "")))
    return F.array_max(runs)


def numbers_lost(source, target) -> Column:
    """The runs of digits of the source that are nowhere in the target, in order; a run inside a longer one counts as kept."""
    runs = F.regexp_extract_all(as_col(source), F.lit(r"(\p{Nd}+)"), 1)
    return F.filter(runs, lambda d: ~F.contains(as_col(target), d))


def length_ratio(source, target) -> Column:
    """Characters of the stripped target for each of the stripped source; null where the source is blank."""
    n = F.length(strip(source))
    return F.try_divide(F.length(strip(target)).cast("double"), F.when(n > 0, n))


def mentions_any(c, markers: list[str]) -> Column:
    """Whether a text contains one of the markers, in any case."""
    low = F.lower(as_col(c))
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(low, F.lit(m.lower()))
    return F.coalesce(found, F.lit(False))


#: SQL functions for temporary use in spark.sql; Catalyst expands them into plain expressions.
SQL_FUNCTIONS = {
    "kolam_strip": ("s STRING", "STRING", r"regexp_replace(s, '(?U)^\\s+|\\s+$', '')"),
    "kolam_word_count": ("s STRING", "INT", r"size(filter(split(s, '(?U)\\s+'), x -> x <> ''))"),
    "kolam_telugu_ratio": ("s STRING", "DOUBLE", r"coalesce(try_divide(length(regexp_replace(regexp_replace(s, '\\P{L}', ''), '[^\\x{0C00}-\\x{0C7F}]', '')), length(regexp_replace(s, '\\P{L}', ''))), 0D)"),
    "kolam_latin_run": ("s STRING", "INT", r"array_max(transform(split(s, '(?U)[^A-Za-z\\s]+'), x -> length(regexp_replace(x, '(?U)\\s+', ''))))"),
    "kolam_numbers_lost": ("a STRING, b STRING", "ARRAY<STRING>", r"filter(regexp_extract_all(a, '(\\p{Nd}+)', 1), d -> not contains(b, d))"),
    "kolam_cosine": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", "coalesce(try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v), sqrt(aggregate(a, 0D, (s, v) -> s + v * v)) * sqrt(aggregate(b, 0D, (s, v) -> s + v * v))), 0D)"),
}


def register_sql_functions(spark) -> list[str]:
    """Makes SQL_FUNCTIONS usable in spark.sql of this session; returns their names."""
    for name, (args, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)
