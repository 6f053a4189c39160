"""Column -> Column text functions (all JVM-side, inside whole-stage codegen).

Every pattern below is a Java regular expression that RE2 (the DuckDB oracle) reads the
same way. Java's ``\\w``/``\\d``/``\\s`` are ASCII-only, so letters and digits are written as
Unicode classes and "white space" is spelled out to follow Python's ``str.split()``.
Accepted differences against trained tokenizers: abbreviations may end a sentence, "..."
and "--" are several tokens, English contractions are not split, 3.14 is three tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: regular expressions shared with the SQL oracle -------------------------
# Characters Python's str.split() treats as white space: ASCII space/controls, Unicode
# separators (Z), vertical tab, file/group/record/unit separators and NEL.
SPACE_CLASS = r"\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}"
# Python's \w: letters, digits of any kind, underscore.
WORD_CLASS = r"\p{L}\p{N}_"
NON_WORD_NON_SPACE = "[^" + WORD_CLASS + SPACE_CLASS + "]"
DECIMAL_DIGITS = r"\p{Nd}+"
WHITESPACE_WORD = "[^" + SPACE_CLASS + "]+"
TOKEN = ("[" + WORD_CLASS + "]+(?:[-'][" + WORD_CLASS + "]+)*"
         + "|[^" + SPACE_CLASS + WORD_CLASS + "]")
ALNUM_TOKEN = r"^[\p{L}\p{N}]+$"
SENTENCE_BREAK = "([.!?]+)[" + SPACE_CLASS + "]+"
EDGE_SPACE = "^[" + SPACE_CLASS + "]+|[" + SPACE_CLASS + "]+$"
# the characters of SPACE_CLASS
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD_RUN = "[" + WORD_CLASS + "]+"
# the white space of such a break; no character of the text serves as a mark
AFTER_END = "(?<=[.!?])[" + SPACE_CLASS + "]+"
# ---------------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lowercase(col: Column | str) -> Column:
    """Unicode lower case."""
    return F.lower(_c(col))


def strip_punctuation(col: Column | str) -> Column:
    """Every character that is neither a word character nor white space becomes a space."""
    return F.regexp_replace(_c(col), NON_WORD_NON_SPACE, " ")


def strip_digits(col: Column | str) -> Column:
    """Delete runs of decimal digits, no space put in ("a1b" -> "ab")."""
    return F.regexp_replace(_c(col), DECIMAL_DIGITS, "")


def whitespace_words(col: Column | str) -> Column:
    """``str.split()``: the non-blank runs of a text, as an array."""
    return F.regexp_extract_all(_c(col), F.lit(WHITESPACE_WORD), 0)


def whitespace_word_count(col: Column | str) -> Column:
    """``len(text.split())``; empty text gives 0, NULL stays NULL."""
    return F.regexp_count(_c(col), F.lit(WHITESPACE_WORD)).cast("int")


def normalised_words(col: Column | str) -> Column:
    """The words of ``normalise_text`` as an array: what T2 makes of punctuation is white space, so they are the runs
    of word characters, digits gone."""
    return F.regexp_extract_all(strip_digits(lowercase(col)), F.lit(WORD_RUN), 0)


def normalise_text(col: Column | str) -> Column:
    """T4: lower -> strip punctuation -> strip digits -> words joined by single spaces."""
    return F.array_join(normalised_words(col), " ")


def trim_space(col: Column | str) -> Column:
    """Trim Unicode white space at both ends, as ``EDGE_SPACE`` says (``F.trim`` alone only removes ' ')."""
    return F.trim(_c(col), F.lit(SPACES))


def split_sentences(col: Column | str) -> Column:
    """T5: rule sentence splitter: a sentence ends after a run of . ! ? followed by space.

    Pieces are trimmed and blank pieces dropped. Row-local.
    """
    # the break pattern consumes the white space after each end mark, so only the text's
    # own edges can carry white space: trim once, not once per sentence
    return F.filter(F.split(trim_space(col), AFTER_END), lambda s: F.length(s) > 0)


def tokenise_words(col: Column | str) -> Column:
    """Word tokens (letters/digits/underscore, inner hyphen or apostrophe) and single
    punctuation characters as tokens."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN), 0)


def alnum_filter(tokens: Column | str) -> Column:
    """Keep tokens made only of letters and digits (Python ``str.isalnum``)."""
    return F.filter(_c(tokens), lambda w: w.rlike(ALNUM_TOKEN))


def word_token_alnum_filter(tokens: Column | str) -> Column:
    """T7 for arrays produced by ``tokenise_words``: a token longer than one character is a
    word run, so it is letters/digits exactly when it holds no '_', '-' or "'"; only
    one-character tokens need the pattern. Same result as ``alnum_filter`` on such arrays,
    without a regular expression per token."""
    def keep(w):
        plain = ~(w.contains("_") | w.contains("-") | w.contains("'"))
        return F.when(F.length(w) > 1, plain).otherwise(w.rlike(ALNUM_TOKEN))
    return F.filter(_c(tokens), keep)


def remove_stopwords(tokens: Column | str, stopwords: Column) -> Column:
    """Tokens not in the stop list; duplicates are kept (unlike ``array_except``)."""
    return F.filter(_c(tokens), lambda w: ~F.array_contains(stopwords, w))


def char_length(col: Column | str) -> Column:
    """Characters of the raw text."""
    return F.length(_c(col))


def token_lengths(tokens: Column | str) -> Column:
    """Length of each token."""
    return F.transform(_c(tokens), lambda w: F.length(w))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0.0 when the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def slice_join(words: Column | str, start: Column | int, length: Column | int) -> Column:
    """words[start : start+length] (1-based start) joined by one space."""
    s = start if isinstance(start, Column) else F.lit(start)
    n = length if isinstance(length, Column) else F.lit(length)
    return F.array_join(F.slice(_c(words), s, n), " ")


def argmax(values: Column | str) -> Column:
    """0-based index of the largest element, first one on ties."""
    v = _c(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def last_n(values: Column | str, n: int = 2) -> Column:
    """The last ``n`` elements (all of them when there are fewer)."""
    v = _c(values)
    return F.slice(v, F.greatest(F.size(v) - (n - 1), F.lit(1)), n)


def _neighbours(sorted_arr: Column) -> Column:
    """array<struct<cur, prev, next>>: each element with its neighbours (NULL at the ends).

    Built from shifted copies so no lambda has to index back into the array (an outer
    array referenced inside a lambda is re-evaluated on every call)."""
    n = F.size(sorted_arr)
    null = F.array(F.lit(None).cast("string"))
    prev = F.concat(null, F.slice(sorted_arr, 1, F.greatest(n - 1, F.lit(0))))
    nxt = F.concat(F.slice(sorted_arr, 2, F.greatest(n - 1, F.lit(0))), null)
    return F.arrays_zip(sorted_arr.alias("cur"), prev.alias("prev"), nxt.alias("next"))


def sorted_run_counts(tokens: Column | str, presorted: bool = False) -> Column:
    """Frequency of each distinct value, as ``array<struct<token, n>>`` sorted by token.

    Row-local: sort once, mark where the value changes, and difference the start positions.
    O(n log n) per document, no shuffle of tokens.
    """
    s = _c(tokens) if presorted else F.sort_array(_c(tokens))
    nb = _neighbours(s)
    starts = F.filter(F.transform(nb, lambda x, i: F.struct(i.alias("pos"), x["cur"].alias("token"),
                                                              x["prev"].alias("prev"))),
                      lambda x: x["token"].isNotNull() & (x["prev"].isNull() | (x["token"] != x["prev"])))
    ends = F.concat(F.slice(F.transform(starts, lambda x: x["pos"]), 2, F.size(s)), F.array(F.size(s)))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a["token"].alias("token"), (b - a["pos"]).alias("n")))
    # zip_with pads to the longer input: an empty array would give one NULL pair
    return F.when(F.size(s) > 0, runs).otherwise(F.array().cast("array<struct<token:string,n:int>>"))


def hapax_count(tokens: Column | str, presorted: bool = False) -> Column:
    """Number of values that occur exactly once (row-local, sort based)."""
    nb = _neighbours(_c(tokens) if presorted else F.sort_array(_c(tokens)))
    # arrays_zip pads to the longest input: an empty array zips to one all-NULL element
    return F.size(F.filter(nb, lambda x: x["cur"].isNotNull()
                           & F.coalesce(x["cur"] != x["prev"], F.lit(True))
                           & F.coalesce(x["cur"] != x["next"], F.lit(True))))


def explode_rows(df, keep: list, arr: Column | str, names: tuple[str, ...], with_pos: bool = False):
    """``select(keep, [pos]explode(arr))`` without the inferred ``size(arr) > 0`` filter.

    For a plain explode Spark infers that filter and pushes it below the projections, which
    evaluates the whole (expensive) array expression a second time. The outer generator
    gets no inferred filter; the NULL row it emits for an empty array is dropped above it.
    """
    a = _c(arr)
    gen = F.posexplode_outer(a) if with_pos else F.explode_outer(a)
    out = df.select(*keep, gen.alias(*names))
    return out.where(F.col(names[0]).isNotNull())
