"""SentencePiece encoding and decoding with a suffix array (operator 3).

A text is normalised as the model asks (a mark for every space, one in front) and cut into
segments that no piece crosses: a run of marks with the characters after it, and characters outside the
model's alphabet, which become byte pieces. The distinct segments of a batch that have not been met
before are concatenated and indexed with a suffix array (prefix doubling over the longest piece
length); every piece of the vocabulary is found by binary search as a range of suffixes. The ranges
give edges (start, end, piece), which are sorted by end and relaxed in that order.

Relaxing. A position's label is the last piece of the encoding of the segment up to there. A sequence of pieces is
what byte-pair merging gives exactly when each neighbouring pair, merged on its own, comes
out as that pair; so an edge labels its end when it starts the segment or when its start's label and its
piece are such a pair (tested by merging the two, remembered). Edges that end equally far from
their segment's start are relaxed at once, for all segments of a block. One edge fits at every
position, and following the labels back gives the ids of the library's greedy merging.

Decoding joins the byte strings of the pieces, turns marks into spaces and drops the first.

Defined results: NULL and empty texts have no pieces and decode to the empty text; a mark already in a text
decodes to a space (as in the library); bytes that are not UTF-8 decode to U+FFFD; repeated
rows get equal results; an empty table gives an empty result; other columns are ignored. The
cache of segments is bounded in bytes, but for one batch, and only saves work.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import mix64, ready, table

MARK = "▁"
# bytes that the segments met before and their ids may take in a worker
CACHE_BYTES = 128 << 20
# of an entry of a dictionary
ENTRY = 100
# slots of the table of piece pairs; a fuller one starts anew
PAIR_SLOTS = 1 << 22
# longer segments are relaxed edge by edge
LONG = 64
NORMAL, UNKNOWN, BYTE = 1, 2, 6

_CODECS: dict[str, "Codec"] = {}


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def codec(path: str) -> "Codec":
    """One codec per worker process and model."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


class SuffixIndex:
    """Sorted suffixes of a sequence of character codes (16 bits each), as far as ``depth`` characters."""

    def __init__(self, codes: np.ndarray, depth: int):
        n = len(codes)
        self.words = -(-depth // 4)
        pad = np.zeros(n + 4 * self.words + 4, dtype=np.uint64)
        pad[:n] = codes
        # four characters in one word, for every position
        key = (pad[:-3] << np.uint64(48)) | (pad[1:-2] << np.uint64(32)) | (pad[2:-1] << np.uint64(16)) | pad[3:]
        self.key = key
        rank, width = key[:n], 4
        while width < depth:
            rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
            after = np.zeros(n, dtype=np.uint64)
            after[: max(n - width, 0)] = rank[width:]
            rank, width = (rank << np.uint64(32)) | after, width * 2
        self.order = np.argsort(rank, kind="stable")

    def ranges(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every row of ``low`` / ``high`` (words of the smallest and largest suffix of interest):
        the first suffix not below low and the first above high, by binary search."""
        first = self.key[self.order]
        lo, hi = np.searchsorted(first, low[:, 0], "left"), np.searchsorted(first, high[:, 0], "right")
        deep = np.flatnonzero((hi > lo) & (high[:, 1:] != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1))
        if len(deep):
            a = self._bisect(low[deep], lo[deep], hi[deep], False)
            b = self._bisect(high[deep], lo[deep], hi[deep], True)
            lo[deep], hi[deep] = a, b
        return lo, hi

    def _bisect(self, target, lo, hi, above: bool):
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            at = self.order[mid]
            less = np.zeros(len(open_), dtype=bool)
            equal = np.ones(len(open_), dtype=bool)
            for w in range(self.words):
                k, t = self.key[at + 4 * w], target[open_, w]
                less |= equal & (k < t)
                equal &= k == t
            right = less | equal if above else less
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]


class Codec:
    """Encoder and decoder of a byte-pair SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2:
            raise ValueError("only byte-pair models are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        self.id_of = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        self.score = [p.score for p in proto.pieces]
        self.unknown = kinds.index(UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == BYTE}
        raw = [bytes([int(p[3:5], 16)]) if k == BYTE else p.encode() if k == NORMAL else b""
               for p, k in zip(pieces, kinds)]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_len = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        if any(MARK in p[1:] and p.strip(MARK) for p in self.id_of):
            raise ValueError("pieces with an inner mark are not supported")
        alphabet = sorted({c for p in self.id_of for c in p})
        self.code = np.zeros(0x110000, dtype=np.uint16)
        self.code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        inside = "".join(re.escape(c) for c in alphabet if c != MARK)
        self.cut = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|[^{MARK}{inside}]")
        self.depth = max(map(len, self.id_of))
        words = -(-self.depth // 4)
        names = list(self.id_of)
        self.vocab_ids = np.array([self.id_of[p] for p in names])
        self.vocab_len = np.array([len(p) for p in names])
        codes = np.zeros((len(names), words * 4), dtype=np.uint64)
        for i, p in enumerate(names):
            codes[i, : len(p)] = self.code[[ord(c) for c in p]]
        free = np.arange(words * 4) >= self.vocab_len[:, None]

        def packed(c):
            c = c.reshape(len(names), words, 4)
            return (c[:, :, 0] << np.uint64(48)) | (c[:, :, 1] << np.uint64(32)) | (c[:, :, 2] << np.uint64(16)) | c[:, :, 3]
        self.low, self.high = packed(codes), packed(np.where(free, np.uint64(0xFFFF), codes))
        self.names = {i: p for p, i in self.id_of.items()}
        # pairs of pieces met before, as 2 * key + fits; 0: free
        self.pair_table, self.pairs_held = np.zeros(1 << 16, dtype=np.int64), 0
        self.cache: dict[str, bytes] = {}
        self.cache_bytes = 0

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short string: the best-scored neighbouring pair first, the left one of equals."""
        s = list(text)
        while len(s) > 1:
            best = max(((self.score[i], -k) for k in range(len(s) - 1)
                        if (i := self.id_of.get(s[k] + s[k + 1])) is not None), default=None)
            if best is None:
                return s
            k = -best[1]
            s[k: k + 2] = [s[k] + s[k + 1]]
        return s

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text gives just these two (left < 0: the right piece alone)."""
        a, b = self.names.get(left, ""), self.names[right]
        return self.merged(a + b) == ([a, b] if left >= 0 else [b])

    def edges(self, codes: np.ndarray):
        """(start, end, piece) of every occurrence of every piece, sorted by end."""
        index = SuffixIndex(codes, self.depth)
        lo, hi = index.ranges(self.low, self.high)
        n = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(n)), n)
        start = index.order[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        end = start + self.vocab_len[which]
        by = np.argsort(end, kind="stable")
        return start[by], end[by], self.vocab_ids[which][by]

    def _pairs_ok(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` of every pair, looked up in a table of the pairs met before (open addressing)."""
        key = (left + 2) * len(self.score) + right + 1
        ok, todo, missed, step = np.zeros(len(key), dtype=bool), np.arange(len(key)), [], 0
        at = self._slots(key)
        while len(todo):
            got = self.pair_table[(at[todo] + step) & (len(self.pair_table) - 1)]
            hit, none = got >> 1 == key[todo], got == 0
            ok[todo[hit]] = got[hit] & 1
            missed.append(todo[none])
            todo, step = todo[~hit & ~none], step + 1
        missed = np.concatenate(missed) if missed else todo
        if len(missed):
            new, first, where = np.unique(key[missed], return_index=True, return_inverse=True)
            sides = zip(left[missed][first].tolist(), right[missed][first].tolist())
            value = np.array([self.fits(a, b) for a, b in sides], dtype=np.int64)
            ok[missed] = value[where] == 1
            self._remember(new << 1 | value)
        return ok

    def _slots(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(key.astype(np.uint64)) & np.uint64(len(self.pair_table) - 1)).astype(np.int64)

    def _remember(self, entries: np.ndarray) -> None:
        if self.pairs_held + len(entries) > len(self.pair_table) // 2:
            kept = self.pair_table[self.pair_table != 0]
            size = 1 << int(2 * (len(kept) + len(entries))).bit_length()
            if size > PAIR_SLOTS:
                kept = kept[:0]
                size = max(1 << 16, 1 << int(2 * len(entries)).bit_length())
            self.pair_table, self.pairs_held = np.zeros(size, dtype=np.int64), 0
            entries = np.concatenate((kept, entries))
        self.pairs_held += len(entries)
        at, mask = self._slots(entries >> 1), len(self.pair_table) - 1
        while len(entries):
            free = self.pair_table[at] == 0
            # of several entries for one free slot the last stays; the others go on
            self.pair_table[at[free]] = entries[free]
            left = self.pair_table[at] != entries
            entries, at = entries[left], (at[left] + 1) & mask

    def encode_segments(self, segments: list[str]) -> dict[str, bytes]:
        """ids (little-endian int32) of distinct segments of alphabet characters."""
        text = "\0".join(segments) + "\0"
        codes = self.code[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        start, end, piece = self.edges(codes)
        # -2: a segment starts here; -1: not labelled
        label, back = np.full(len(codes) + 1, -1, dtype=np.int64), np.zeros(len(codes) + 1, dtype=np.int64)
        sizes = np.array([len(s) for s in segments])
        begin = np.cumsum(sizes + 1) - sizes - 1
        label[begin] = -2
        # the edges of one length from their segment's start are relaxed at once, for all segments
        of = np.repeat(np.arange(len(segments)), sizes + 1)[start]
        away = end - begin[of]
        short = sizes[of] <= LONG
        near = np.flatnonzero(short)
        near = near[np.argsort(away[near].astype(np.uint16), kind="stable")]
        cut = np.searchsorted(away[near], np.arange(1, LONG + 2))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            e = near[i:j]
            e = e[label[start[e]] != -1]
            e = e[self._pairs_ok(label[start[e]], piece[e])]
            label[end[e]], back[end[e]] = piece[e], start[e]
        if not short.all():
            self._relax_in_order(start[~short], end[~short], piece[~short], label, back)
        # the labels backwards from every segment's end
        p, seg, ids, owner = begin + sizes, np.arange(len(segments)), [], []
        while len(p):
            ids.append(label[p])
            owner.append(seg)
            p = back[p]
            on = p > begin[seg]
            p, seg = p[on], seg[on]
        ids, owner = np.concatenate(ids)[::-1], np.concatenate(owner)[::-1]
        flat = ids[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        last = (4 * np.cumsum(np.bincount(owner, minlength=len(segments)))).tolist()
        return {s: flat[i:j] for s, i, j in zip(segments, [0, *last], last)}

    def _relax_in_order(self, start, end, piece, label, back) -> None:
        """Edges of long segments, sorted by end, one after the other."""
        met: dict[tuple[int, int], bool] = {}
        labels = {int(p): int(label[p]) for p in np.unique(np.concatenate((start, end)))}
        for a, b, t in zip(start.tolist(), end.tolist(), piece.tolist()):
            s = labels[a]
            if s == -1 or labels[b] != -1:
                continue
            ok = met.get((s, t))
            if ok is None:
                ok = met[s, t] = self.fits(s, t)
            if ok:
                labels[b] = label[b] = t
                back[b] = a

    def _outside(self, ch: str) -> bytes:
        ids = [self.byte_id[b] for b in ch.encode("utf-8", "surrogatepass")] if self.byte_id else [self.unknown]
        return np.array(ids, dtype="<i4").tobytes()

    def _keep(self, encoded: dict[str, bytes]) -> None:
        self.cache.update(encoded)
        self.cache_bytes += sum(map(sys.getsizeof, encoded)) + sum(map(sys.getsizeof, encoded.values())) + ENTRY * len(encoded)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """ids of every text as little-endian int32 bytes."""
        cuts = [self.cut.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        cache = self.cache
        if self.cache_bytes > CACHE_BYTES:
            cache.clear()
            self.cache_bytes = 0
        new = {s for c in cuts for s in c if s not in cache}
        outside = {s for s in new if len(s) == 1 and not self.code[ord(s)]}
        self._keep({s: self._outside(s) for s in outside})
        block, size = [], 0
        for s in sorted(new - outside):
            block.append(s)
            size += len(s) + 1
            if size > 400_000:
                self._keep(self.encode_segments(block))
                block, size = [], 0
        if block:
            self._keep(self.encode_segments(block))
        return [b"".join([cache[s] for s in c]) for c in cuts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        n = self.raw_len[ids]
        total = int(n.sum())
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.raw_at[ids], n)
        text = self.raw[at].tobytes().decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row's whole text."""
    ready(df.sparkSession)
    path = model or model_path()
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa

        from scriptorium.llm import sentencepiece_encoding as sp

        c = sp.codec(path)
        for b in batches:
            ids = c.encode_batch([t or "" for t in b.column(1).to_pylist()])
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids])))
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=[id_col, "ids"])

    return _rows(df, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """(id, text) of every row's ids."""
    ready(df.sparkSession)
    path = model or model_path()
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa

        from scriptorium.llm import sentencepiece_encoding as sp

        c = sp.codec(path)
        for b in batches:
            out = [c.decode(np.asarray(x or [], dtype=np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[id_col, "text"])

    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{ids_col}`").cast("array<int>").alias("x"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, text string")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id, n_pieces, ids_md5, round_trip): md5 of the ids as little-endian int32, and whether
    decoding them gives the text back."""
    ready(df.sparkSession)
    path = model or model_path()
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa

        from scriptorium.llm import sentencepiece_encoding as sp

        c = sp.codec(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = c.encode_batch(texts)
            same = [c.decode(np.frombuffer(x, dtype="<i4").astype(np.int64)) == t.replace(sp.MARK, " ") for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.md5(x).hexdigest() for x in ids], pa.string()), pa.array(same, pa.bool_())],
                names=[id_col, "n_pieces", "ids_md5", "round_trip"])

    return _rows(df, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_pieces long, ids_md5 string, round_trip boolean")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Pieces of every document: count, digest of the ids, exact round trip."""
    return digests(table(spark, sf_dir, "documents"))
