"""Token counts of whole texts by overlap resynchronisation (operator 1).

A text is encoded in chunks that overlap. The encodings of two neighbouring chunks are
joined at a *stable* boundary inside the overlap: a place where white space follows a
character that is not white space. The pre-tokeniser's pattern only takes a space as the
first character of a token, and its other alternatives hold either white space or none, so
every encoding, wherever it began, has a token boundary there and the tokens after it depend
only on the text after it. The join is accepted when both encodings have a token boundary
at the place (token offsets) and agree on the tokens between it and the next stable place.
If the overlap has no such pair of places it is doubled; when it reaches back to the
start of the left chunk, that chunk is doubled instead. Memory is bounded by the chunk,
or by the longest stretch without white space.

Tokens are those of the tokenizer file. Its ranks drive the quicker encoder of ``tiktoken``,
whose pattern gives the same classes for every Unicode code point (``differing_characters``
compares the two libraries; the tests run it); a stretch of ``LONG_RUN`` characters without
a pattern break is encoded by ``tokenizers`` itself, which merges long stretches faster.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; special strings inside a text
are encoded as the library does by default (one special token); repeated rows give repeated
results; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import ready, table

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 256
# a pretoken this long is merged by the library's priority queue instead of a linear scan
LONG_RUN = 1500

STABLE = re.compile(r"(?<=\S)(?=\s)")
RUN = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))

_ENCODERS: dict[str, "ByteEncoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteEncoder:
    """ids and byte lengths of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                 if piece not in self.special}
        self.quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.length = np.zeros(size, dtype=np.int64)
        for piece, i in ranks.items():
            self.length[i] = len(piece)
        for piece, i in self.special.items():
            self.length[i] = len(piece.encode())
        self.margin = max([3, *map(len, self.special)]) + 1

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and RUN.search(text):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return self.quick.encode_to_numpy(text, allowed_special="all").astype(np.int64)


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


# fixed value: the pre-tokeniser pattern of the byte-level vocabulary
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def differing_characters(encoder: ByteEncoder, points) -> list[str]:
    """Those of the code points ``points`` after, before and between which the two libraries
    give different tokens."""
    def same(chars: list[str]) -> bool:
        text = "\n".join("a{0}b 1{0}2 .{0}, {0} {0}  ".format(c) for c in chars)
        return encoder.library.encode(text, add_special_tokens=False).ids == encoder.quick.encode(
            text, allowed_special="all")

    chars = [chr(c) for c in points if not 0xD800 <= c < 0xE000]
    return [c for i in range(0, len(chars), 1024) if not same(chars[i: i + 1024])
            for c in chars[i: i + 1024] if not same([c])]


def encoder(path: str) -> ByteEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def stable_place(text: str, lo: int, hi: int, left: np.ndarray, left_at: int, right: np.ndarray, right_at: int):
    """The first place in (lo, hi) where both encodings have a token boundary and agree up to
    the next stable place: (place, tokens of left before it, tokens of right before it), or None.
    left / right: cumulative byte ends and ids, from characters left_at / right_at on."""
    places = [m.start() for m in STABLE.finditer(text, lo + 1, hi)]
    if len(places) < 2:
        return None
    (l_ends, l_ids), (r_ends, r_ids) = left, right
    l_base = len(text[left_at:places[0]].encode())
    r_base = len(text[right_at:places[0]].encode())
    for p, q in zip(places, places[1:]):
        gap = len(text[p:q].encode())
        i, j = np.searchsorted(l_ends, (l_base, l_base + gap))
        k, m = np.searchsorted(r_ends, (r_base, r_base + gap))
        if (i < len(l_ends) and k < len(r_ends) and l_ends[i] == l_base and r_ends[k] == r_base
                and j - i == m - k and (l_ids[i:j] == r_ids[k:m]).all()):
            return p, i + 0, k + 0
        l_base += gap
        r_base += gap
    return None


def encode_document(enc: ByteEncoder, text: str, chunk: int = CHUNK_CHARS,
                    overlap: int = OVERLAP_CHARS) -> Iterator[np.ndarray]:
    """Yield the ids of ``text`` in order, one array per spliced chunk."""
    n = len(text)

    def encoded(a: int, b: int):
        ids = enc.ids(text[a:b])
        # ends[i]: bytes of the first i tokens (ends[0] = 0)
        return np.concatenate(([0], np.cumsum(enc.length[ids]))), np.append(ids, -1)

    a, e = 0, min(n, chunk)
    left, at = encoded(a, e), a
    while e < n:
        width = overlap
        while True:
            s = e - width
            if s <= a:
                # the overlap reaches back to the chunk's start: a longer chunk instead
                e = min(n, a + 2 * (e - a))
                left, at = encoded(a, e), a
                break
            end = min(n, s + max(chunk, 2 * width))
            right = encoded(s, end)
            found = stable_place(text, s, e - enc.margin, left, at, right, s)
            if found is None:
                width *= 2
                continue
            p, i, k = found
            yield left[1][:i]
            base = right[0][k]
            left, at, a, e = (right[0][k:] - base, right[1][k:]), p, p, end
            break
    yield left[1][:-1]


def count_document(enc: ByteEncoder, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    if len(text) <= chunk:
        return len(enc.ids(text)), 1
    parts = [len(x) for x in encode_document(enc, text, chunk, overlap)]
    return sum(parts), len(parts)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per input row: (id, n_bytes, n_tokens, n_chunks). ``chunk_chars`` and
    ``overlap_chars`` only bound memory and work: the count is that of the whole text."""
    if chunk_chars < 4 * overlap_chars:
        raise ValueError("chunk_chars must be at least four times overlap_chars")
    spark = df.sparkSession
    ready(spark)
    path = tokenizer or tokenizer_path()
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa

        from scriptorium.llm import token_counts as t

        enc = t.encoder(path)
        for b in batches:
            texts = b.column(1)
            counts = [t.count_document(enc, texts[i].as_py() or "", chunk_chars, overlap_chars)
                      for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([c[0] for c in counts], pa.int64()),
                 pa.array([c[1] for c in counts], pa.int64())],
                names=[id_col, "n_bytes", "n_tokens", "n_chunks"])

    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"),
                     F.octet_length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).cast("long").alias("b"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, n_chunks long")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document, with whether they pass 1,024."""
    counts = count_tokens(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "n_chunks")
