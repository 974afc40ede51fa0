"""Line-first cleaning: rules judge every line, failing lines go, and a document that loses too
much text goes altogether.

Built-in expressions only: one projection over the documents, no shuffle and no Python. What
a document needs is inside its own row (arrays of its lines, words and 3-word windows, the
latter sorted by hash to find the repeated ones in n log n), so a document of any length costs its
own task time only. Windows are compared by 64-bit hash within one document.

A line that has a word fails by

- *navigation*: three or more separators, and at least one for four words;
- *boilerplate*: one of the phrases of ``BOILERPLATE``, as words of their own, in a line of at most
  ``BOILERPLATE_WORDS`` words: a phrase in a longer line is prose about it;
- *punctuation*: over a tenth of its characters are symbols ``#*$%&|<>``, or it has a ``!!`` for
  fewer than three words, or five words or more of which most letters are capitals.

A document is rejected by the base rule (fewer than ``MIN_WORDS`` words, or over half of its
words in repeated 3-word windows) or if failing lines hold more than half of its characters.

Defined results: a null text is empty, so it has no words and is rejected; white space is
``\\x20\\x09-\\x0D`` only; repeated rows are judged row by row; columns other than the text pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

MIN_WORDS = 50
#: percent of words in repeated windows above which a document fails
MAX_REPEATED = 50
#: a document goes when more than one character in so many is lost
LOST_ONE_IN = 2

# Fixed values of the line rules.
SEPARATORS = "[|»›>•]"
SYMBOLS = "[#*$%&|<>]"
BOILERPLATE = (
    "licensed under", "licenced under", "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "cookie", "cookies", "javascript", "copyright", "lorem ipsum", "sign up", "sign in", "log in", "subscribe", "click here", "read more",
)
BOILERPLATE_WORDS = 12


def _sql(pattern: str) -> str:
    """A regular expression as a raw SQL string literal."""
    return f"r'{pattern}'"


def _others(pattern: str) -> str:
    """The class of all characters that the class ``pattern`` does not have."""
    return "[" + pattern[2:] if pattern.startswith("[^") else "[^" + pattern[1:]


def _count(text: str, cls: str) -> str:
    """SQL for how many characters of ``text`` are in the class."""
    return f"length(regexp_replace({text}, {_sql(_others(cls) + '+')}, ''))"


def _words(text: str) -> str:
    return f"array_remove(split({text}, {_sql(BLANKS + '+')}), '')"


def _fails() -> str:
    """SQL: whether the line l of w words, c characters that are not blank, fails a rule."""
    separators = _count("x.l", SEPARATORS)
    some = " OR ".join(f"contains(x.low, '{phrase}')" for phrase in BOILERPLATE)  # cheap, and rarely true
    whole = _sql(rf"(^|[^\p{{L}}\p{{N}}])({'|'.join(BOILERPLATE)})($|[^\p{{L}}\p{{N}}])")
    return (
        f"({separators} >= 3 AND 4 * {separators} >= x.w)"
        f" OR (x.w <= {BOILERPLATE_WORDS} AND ({some}) AND x.low rlike {whole})"
        f" OR 10 * {_count('x.l', SYMBOLS)} > x.c"
        f" OR 3 * (length(x.l) - length(replace(x.l, '!!', ''))) > 2 * x.w"
        f" OR (x.w >= 5 AND 2 * {_count('x.l', '[' + chr(92) + 'p{Lu}]')} > {_count('x.l', '[' + chr(92) + 'p{L}]')})"
    )


#: SQL: positions of the 3-word windows that occur twice or more, each array bound once
_REPEATED = """
transform(
  array(sort_array(transform(
    array(_words),
    w -> if(size(w) < 3, array(), transform(sequence(0, size(w) - 3),
                                            i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))
  )[0])),
  s -> transform(
    filter(s, (x, k) -> coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)),
    x -> x.i)
)[0]
"""


def clean_lines(docs: DataFrame, *, text_col: str = "text", out_col: str = "_quality") -> DataFrame:
    """``docs`` with a struct column ``out_col``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (bigint), base_failed, lost_chars, kept (boolean) and text, the lines left."""
    text = F.coalesce(F.col("_row").getField(text_col).cast("string"), F.lit(""))
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")).withColumn("_text", text)
    split = base.selectExpr(
        "*",
        f"{_words('_text')} AS _words",
        f"filter(split(_text, '\\n'), l -> l rlike {_sql(_others(BLANKS))}) AS _lines",
    )
    judged = split.selectExpr(
        "_row",
        "CAST(size(_words) AS BIGINT) AS _n_words",
        f"CAST({_count('_text', _others(BLANKS))} AS BIGINT) AS _word_chars",
        f"CAST({_count('_text', SYMBOLS)} AS BIGINT) AS _n_symbols",
        "CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT) AS _n_dup_lines",
        f"CAST(size(array_distinct(flatten(transform({_REPEATED}, i -> array(i, i + 1, i + 2))))) AS BIGINT) AS _n_repeat",
        f"transform(transform(_lines, l -> struct(l AS l, lower(l) AS low, size({_words('l')}) AS w,"
        f" {_count('l', _others(BLANKS))} AS c)), x -> struct(x.l AS l, x.c AS c, {_fails()} AS bad)) AS _judged",
    )
    summed = judged.selectExpr(
        "*",
        "aggregate(_judged, 0L, (n, x) -> n + if(x.bad, x.c, 0)) AS _lost",
        "array_join(transform(filter(_judged, x -> NOT x.bad), x -> x.l), '\\n') AS _left",
        f"(_n_words < {MIN_WORDS} OR 100 * _n_repeat > {MAX_REPEATED} * _n_words) AS _base_failed",
        # a filter on the verdict stops here: pushed further down, it would judge every line twice
        "monotonically_increasing_id() AS _row_number",
    )
    return summed.select(
        *(F.col("_row").getField(c).alias(c) for c in docs.columns if c != out_col),
        F.expr(
            "struct(_n_words AS n_words, _word_chars AS word_chars, _n_symbols AS n_symbols, _n_dup_lines AS n_dup_lines,"
            " _n_repeat AS n_repeat_words, _base_failed AS base_failed, _lost AS lost_chars,"
            f" (NOT _base_failed AND {LOST_ONE_IN} * _lost <= _word_chars AND _row_number >= 0) AS kept, _left AS text)"
        ).alias(out_col),
    )
