from scriptorium.functions.text import (  # noqa: F401
    alnum_filter, argmax, char_length, hapax_count, last_n, lowercase, normalise_text, normalised_words,
    remove_stopwords, safe_ratio, slice_join, sorted_run_counts, split_sentences,
    strip_digits, strip_punctuation, token_lengths, tokenise_words, trim_space,
    whitespace_word_count, whitespace_words,
)
from scriptorium.functions.hashing import hash_order, uniform, uniform_int  # noqa: F401
from scriptorium.functions.stopwords import load_stopwords, stopword_array, stopwords_for  # noqa: F401
