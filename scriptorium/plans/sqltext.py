"""SQL (DuckDB dialect) spellings of the text expressions, built from the same pattern
constants as the Spark expressions. Used only by the correctness oracle."""

from __future__ import annotations

from scriptorium.functions import text as T
from scriptorium.functions.stopwords import LANGUAGE_LISTS, load_stopwords


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(T.WHITESPACE_WORD)})"


def word_count(x: str) -> str:
    return f"len({words(x)})"


def cleaned(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({x}), {lit(T.NON_WORD_NON_SPACE)}, ' ', 'g'), "
            f"{lit(T.DECIMAL_DIGITS)}, '', 'g')")


def normalise(x: str) -> str:
    return f"array_to_string({words(cleaned(x))}, ' ')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(T.TOKEN)})"


def alnum(t: str) -> str:
    return f"list_filter({t}, lambda w: regexp_matches(w, {lit(T.ALNUM_TOKEN)}))"


def sentences(x: str) -> str:
    marked = f"regexp_replace({x}, {lit(T.SENTENCE_BREAK)}, '\\1' || chr(1), 'g')"
    trimmed = (f"list_transform(string_split({marked}, chr(1)), "
               f"lambda s: regexp_replace(s, {lit(T.EDGE_SPACE)}, '', 'g'))")
    return f"list_filter({trimmed}, lambda s: length(s) > 0)"


def stoplist(lang: str) -> str:
    return "[" + ", ".join(lit(w) for w in load_stopwords(lang)) + "]"


def stoplist_by_lang(lang_col: str) -> str:
    parts = " ".join(f"WHEN {lang_col} = {lit(code)} THEN {stoplist(name)}"
                     for code, name in LANGUAGE_LISTS.items())
    return f"(CASE {parts} ELSE []::VARCHAR[] END)"


def uniform(*parts: str) -> str:
    """Same value as ``functions.hashing.uniform``: first 32 bits of md5 / 2^32."""
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0)"


def md5_key(*parts: str) -> str:
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5({key})"
