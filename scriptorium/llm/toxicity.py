"""Toxicity scores of deobfuscated text (operator 9).

Noisy channel. Writers hide words by swapping letters for look-alikes (``1d10t``), stretching them
(``idiooot``), putting signs between letters (``i.d-i*o_t``) or spacing them out (``i d i o t``). A token
that shows any of this becomes a lattice: every character is a letter (itself or a
look-alike, at a cost), a repetition of the letter before, or noise; a gap inside a run of three or more
single letters or look-alikes is a word end or noise. Tokens and runs are read letter by letter as well (an honest
``ss`` is not stretched); a token with inner signs is read as one word, with its signs as word ends, and part by part; a token of look-alikes alone is read as far as plain words have its trigrams. A character language model (trigrams with back-off, learned from
plain words) weighs the paths, and the Viterbi path is the restored token. Tokens and runs are decoded to their end,
whatever their length, and no path is pruned. A plain token has a single path and stays as it is.

Score. Features are the restored words and their prefixes of 4 to 7 letters, as present or not in a
whole text; those that separate the labels best carry evidence (a log ratio of rates). A logistic
regression on a text's strongest evidence plus a quarter of the next four gives the score.
Fitting uses every distinct labelled text: trigrams, features and evidence are counts over all of them, and the
regression's sums are taken by Spark. Of near copies (``MINIMA`` equal minimum hashes of
five-word shingles) one is used.

Defined results: NULL and empty texts get the score of a text without features; a row without a label
is never trained on; repeated rows get equal results; without training rows every score is 0;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import LOWER, MIX, held_out, keep_rows, mix64, ready, span_hashes, table, utf8_batch, word_spans
from scriptorium.session import materialize

FEATURES = 2000
MIN_TOXIC = 3
# minimum hashes that near copies share
MINIMA = 8
# least G-squared (half of the usual statistic) of a feature: p < 0.0001
SEPARATES = 7.6
CACHE = 300_000
# counters that a task holds before it hands them on
HELD = 300_000

# fixed values: what a sign may stand for
LOOK_ALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "ß": "ß"}
SWAP, REPEAT, NOISE, LOST, GAP, END = -0.7, -0.7, -0.6, -3.5, -1.6, -0.6
# characters after which the common start of all paths is put aside
SETTLE = 1024

EDGE = ".,;:!?\"'()[]{}<>|#%&*$~`-_=+/\\«»…"
PLAIN = re.compile(r"[^\W\d_]+\Z")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
# single letters, digits or look-alike signs, three or more
ONE = "(?:[^\\W_]|[" + re.escape("".join(c for c in LOOK_ALIKES if not c.isalnum())) + "])"
SPACED = re.compile(rf"(?<!\S){ONE}(?:\s+{ONE}){{2,}}(?!\S)")
SIGNS = re.compile(r"[\W_]+")


class CharModel:
    """Trigram log-probabilities of letters inside words, backing off to bigrams and letters.
    A word is padded with two marks in front and ends with one."""

    def __init__(self, tri: dict[str, int]):
        self.tri = tri
        self.bi, self.ctx, self.uni, self.mid = Counter(), Counter(), Counter(), Counter()
        for g, n in tri.items():
            self.ctx[g[:2]] += n
            self.bi[g[1:]] += n
            self.mid[g[1]] += n
            self.uni[g[2]] += n
        self.total = max(sum(self.uni.values()), 1)
        self.memo: dict[str, float] = {}

    def logp(self, a: str, b: str, c: str) -> float:
        g = a + b + c
        v = self.memo.get(g)
        if v is None:
            p1 = (self.uni[c] + 0.5) / (self.total + 50)
            p2 = (self.bi[b + c] + 5 * p1) / (self.mid[b] + 5)
            v = math.log((self.tri.get(g, 0) + 5 * p2) / (self.ctx[a + b] + 5))
            if len(self.memo) < 200_000:
                self.memo[g] = v
        return v


def trigrams(word: str) -> list[str]:
    s = "^^" + word + "$"
    return [s[i:i + 3] for i in range(len(s) - 2)]


def settle(beam: dict, done: list[str]) -> int:
    """Move the letters that all paths of ``beam`` share to ``done``; the longest rest's length."""
    chains = []
    for _, node in beam.values():
        chain = []
        while node is not None:
            chain.append(node)
            node = node[0]
        chains.append(chain[::-1])
    same = 0
    for nodes in zip(*chains):
        if any(x is not nodes[0] for x in nodes):
            break
        same += 1
    done += [node[1] for node in chains[0][:same]]
    for (state, (lp, _)), chain in zip(list(beam.items()), chains):
        node = None
        for _, c in chain[same:]:
            node = (node, c)
        beam[state] = (lp, node)
    return max(map(len, chains)) - same


def restore(token: str, lm: CharModel, ends: bool = False, swaps: bool = False) -> str:
    """The most likely plain reading of a whole token, of any length; blanks in the token are gaps that may be word
    ends, and with ``ends`` so may its signs. With ``swaps`` every letter and look-alike is one letter. Only look-alikes can be left out, so a state's two letters are among the twelve that look-alikes
    stand for, the last two plain letters and the word mark: at most 225 states, none of them pruned."""
    # state: the last two letters -> (log-probability, (the node before, letter))
    beam: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    done: list[str] = []
    due = SETTLE
    for place, ch in enumerate(token):
        nxt: dict[str, tuple[float, tuple | None]] = {}

        def put(state, lp, node, c=""):
            old = nxt.get(state)
            if old is None or lp > old[0]:
                nxt[state] = (lp, (node, c) if c else node)

        for (a, b), (lp, node) in beam.items():
            if ch == " ":
                put(a + b, lp + GAP, node)
                if b != "^":
                    put("^^", lp + lm.logp(a, b, "$"), node, " ")
                continue
            letters = LOOK_ALIKES.get(ch)
            if letters:
                for c in letters:
                    put(b + c, lp + SWAP + lm.logp(a, b, c), node, c)
            if ch.isalpha() and not letters:
                put(b + ch, lp + lm.logp(a, b, ch), node, ch)
                if b == ch and not swaps:
                    put(a + b, lp + REPEAT, node)
            elif not (letters and swaps):
                if letters and b in letters:
                    put(a + b, lp + SWAP + REPEAT, node)
                put(a + b, lp + (LOST if letters else NOISE), node)
                if ends and b != "^" and not ch.isalnum():
                    put("^^", lp + END + lm.logp(a, b, "$"), node, " ")
        beam = nxt
        if place >= due:
            # what the paths no longer share is read again at most as often as it grows
            due = place + max(SETTLE, 2 * settle(beam, done))
    node = max(beam.items(), key=lambda kv: kv[1][0] + (lm.logp(kv[0][0], kv[0][1], "$") if kv[0][1] != "^" else 0.0))[1][1]
    rest = []
    while node is not None:
        rest.append(node[1])
        node = node[0]
    return "".join(done) + "".join(reversed(rest))


def familiar(word: str, lm: CharModel) -> bool:
    """Whether plain words have every trigram of ``word``."""
    return all(g in lm.tri for g in trigrams(word))


def words_of(token: str, lm: CharModel) -> list[str]:
    """Restored words of a lower-cased token without blanks: read as one word, read letter by letter (neither
    stretched nor padded), read with its signs as word ends, and the parts between its signs. Of a token without a letter only readings
    whose trigrams plain words have count (``455``, but not every number)."""
    core = token.strip(EDGE)
    if PLAIN.match(core) and not STRETCHED.search(core):
        # an outer look-alike ("$cum") is read as a letter only where it stands alone
        outer = token[: len(token) - len(token.lstrip(EDGE))]
        if len(outer) == 1 and outer in LOOK_ALIKES:
            return [core, restore(outer + core, lm)]
        return [core]
    if not any(c.isalpha() or c in LOOK_ALIKES for c in core):
        return []
    keep = token.strip("".join(c for c in EDGE if c not in LOOK_ALIKES))
    words = restore(keep, lm).split() + restore(keep, lm, swaps=True).split() + ([restore(core, lm)] if keep != core else [])
    if SIGNS.search(keep):
        words += restore(keep, lm, ends=True).split()
        for part in SIGNS.split(core):
            words += [part] if PLAIN.match(part) and not STRETCHED.search(part) else restore(part, lm).split()
    words = list(dict.fromkeys(w for w in words if w))
    return words if any(c.isalpha() for c in core) else [w for w in words if familiar(w, lm)]


def features_of(word: str) -> list[str]:
    return ["=" + word] + [word[:n] for n in (4, 5, 6, 7) if len(word) >= n]


def tokens_of(text: str, lm: CharModel) -> set[str]:
    """Distinct lower-cased tokens of a text plus the readings of its runs of single letters and look-alikes."""
    low = text.lower()
    tokens = low.split()
    out = set(tokens)
    single = [i for i, x in enumerate(tokens) if len(x) == 1]
    # a run has three tokens of one character in a row
    spaced = any(c - a == 2 for a, c in zip(single, single[2:]))
    for run in SPACED.findall(low) if spaced else ():
        run = " ".join(run.split())
        words = restore(run, lm).split() + restore(run, lm, swaps=True).split()
        out.update(words if any(c.isalpha() for c in run) else (w for w in words if familiar(w, lm)))
    return out


class Scorer:
    """Evidence of texts under a model; token readings are cached up to a bound."""

    def __init__(self, lm: CharModel, evidence: dict[str, float]):
        self.lm, self.evidence, self.cache = lm, evidence, {}

    def token(self, t: str) -> float:
        """The strongest evidence among the features of a token's readings."""
        got = self.cache.get(t)
        if got is None:
            got = max((self.evidence.get(f, 0.0) for w in words_of(t, self.lm) for f in features_of(w)), default=0.0)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            if len(t) <= 64:
                self.cache[t] = got
        return got

    def text(self, text: str) -> float:
        """The strongest evidence of a distinct token plus a quarter of the next four."""
        best = sorted((v for v in map(self.token, tokens_of(text, self.lm)) if v > 0), reverse=True)[:5]
        return best[0] + 0.25 * sum(best[1:]) if best else 0.0


def logistic_fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50):
    """Weights and intercept by Newton's method, both labels with equal total weight."""
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (p - y)) + ridge * w
        h = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], w[-1]


def logistic_fit_rows(data: DataFrame, l2: float = 1e-3, rounds: int = 50) -> tuple[float, float]:
    """``logistic_fit`` of one feature on rows (x, y, n: how many), whose sums Spark takes in every round."""
    size = data.agg(F.sum(F.col("y") * F.col("n")).alias("one"), F.sum("n").alias("all")).first()
    x, y = F.col("x"), F.col("y").cast("double")
    share = F.when(F.col("y") == 1, F.lit(0.5 / max(size["one"], 1))).otherwise(F.lit(0.5 / max(size["all"] - size["one"], 1))) * F.col("n")
    w = np.zeros(2)
    for _ in range(rounds):
        z = F.greatest(F.least(x * F.lit(float(w[0])) + F.lit(float(w[1])), F.lit(30.0)), F.lit(-30.0))
        terms = data.select(x.alias("x"), y.alias("y"), share.alias("s"), (1 / (1 + F.exp(-z))).alias("p"))
        terms = terms.select("x", (F.col("s") * (F.col("p") - F.col("y"))).alias("g"), (F.col("s") * F.col("p") * (1 - F.col("p"))).alias("h"))
        r = terms.agg(F.sum(F.col("g") * F.col("x")).alias("g0"), F.sum("g").alias("g1"), F.sum(F.col("h") * F.col("x") * F.col("x")).alias("h00"),
                      F.sum(F.col("h") * F.col("x")).alias("h01"), F.sum("h").alias("h11")).first()
        g = np.array([r.g0 + l2 * w[0], r.g1])
        step = np.linalg.solve(np.array([[r.h00 + l2 + 1e-9, r.h01], [r.h01, r.h11 + 1e-9]]), g)
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def near_key(words: np.ndarray) -> bytes:
    """``MINIMA`` independent minimum hashes of the five-word shingles of a text, given its word hashes (texts of
    fewer words are one shingle). Two texts agree in all with their shingles' Jaccard similarity to that power."""
    n = max(len(words) - 4, 1)
    with np.errstate(over="ignore"):
        h = np.full(n, len(words[:5]), dtype=np.uint64)
        for i in range(min(len(words), 5)):
            h = mix64(h * MIX + words[i: i + n])
        return b"".join(mix64(h ^ mix64(np.array([k], dtype=np.uint64) * MIX)).min().tobytes() for k in range(1, MINIMA + 1))


def near_keys(batches):
    """(h, y, near key) of rows (t, h, y): the keys of ``near_key``, the texts of a batch at once."""
    import pyarrow as pa

    salts = [mix64(np.array([k], dtype=np.uint64) * MIX) for k in range(1, MINIMA + 1)]
    for b in batches:
        raw, offsets = utf8_batch(b.column(0))
        raw = LOWER[raw]
        starts, ends, doc = word_spans(raw, offsets)
        words = span_hashes(raw, starts, ends)
        at = np.searchsorted(doc, np.arange(b.num_rows + 1))
        long = np.flatnonzero(np.diff(at) >= 5)
        keys = [near_key(words[i:j]) if j - i < 5 else b"" for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
        if len(long):
            n = len(words) - 4
            with np.errstate(over="ignore"):
                h = np.full(n, 5, dtype=np.uint64)
                for i in range(5):
                    h = mix64(h * MIX + words[i: i + n])
                # shingles of a text; those that reach into the next one are between two cuts
                cuts = np.column_stack((at[long], at[long + 1] - 4)).reshape(-1)
                cuts = cuts[:-1] if cuts[-1] >= n else cuts
                lows = np.stack([np.minimum.reduceat(mix64(h ^ salt), cuts)[::2] for salt in salts], axis=1)
            for i, low in zip(long.tolist(), lows):
                keys[i] = low.tobytes()
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(keys, pa.binary())], names=["h", "y", "near"])


def fit(pairs: DataFrame, texts: DataFrame, text_col: str = "text", features: int = FEATURES) -> dict | None:
    """Model from ``pairs`` (h: xxhash64 of a text, y: its label 0 or 1) and the table that holds the texts:
    character trigrams of plain words, the features that separate the labels best
    (G-squared) and their evidence, all counted over every distinct labelled text but near copies."""
    spark = texts.sparkSession
    ready(spark)
    pairs = materialize(pairs.where("h IS NOT NULL AND y IN (0, 1)").select("h", "y").distinct(), "labels")
    sizes = {r.y: r.n for r in pairs.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None
    rows = texts.select(F.col(f"`{text_col}`").cast("string").alias("t")).where("t IS NOT NULL").withColumn("h", F.xxhash64("t"))
    # near copies count once: of each group the text with the smallest hash; texts stay where they are for that
    near = rows.select("t", "h", F.lit(0).alias("y")).mapInArrow(near_keys, "h long, y int, near binary").select("h", "near").distinct()
    kept = materialize(near.join(pairs, "h").groupBy("near", "y").agg(F.min("h").alias("h")).select("h", "y"), "toxic-keys")
    # the learned texts move once; equal ones meet before they move
    sample = materialize(rows.groupBy("h").agg(F.first("t").alias("t")).join(kept, "h").select("t", "h", "y"), "toxic-texts")

    def plain_trigrams(batches):
        import pyarrow as pa

        def table_of(words):
            total: Counter = Counter()
            for w, n in words.items():
                w = w.strip(EDGE)
                if PLAIN.match(w) and not STRETCHED.search(w):
                    for g in trigrams(w):
                        total[g] += n
            return pa.RecordBatch.from_pydict({"g": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        words: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                words.update(set((t.as_py() or "").lower().split()))
            if len(words) > HELD:
                yield table_of(words)
                words = Counter()
        yield table_of(words)

    # at most (letters + 2) ^ 3 rows; rare ones are left to the back-off
    tri = {r.g: r.n for r in sample.select("t").mapInArrow(plain_trigrams, "g string, n long")
           .groupBy("g").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "g").limit(50_000).collect()}
    lm = CharModel(tri)

    def feature_rows(batches):
        import pyarrow as pa

        def table_of(one, all_):
            return pa.RecordBatch.from_pydict({"f": pa.array(list(all_), pa.string()), "c1": pa.array([one[f] for f in all_], pa.int64()),
                                               "c": pa.array(list(all_.values()), pa.int64())})

        known: dict[str, tuple] = {}

        def features_read(tok):
            got = known.get(tok)
            if got is None:
                got = tuple(x for w in words_of(tok, lm) for x in features_of(w))
                if len(known) >= HELD:
                    known.clear()
                if len(tok) <= 64:
                    known[tok] = got
            return got

        one, all_ = Counter(), Counter()
        for b in batches:
            for t, label in zip(b.column(0), b.column(1).to_pylist()):
                own = set().union(*map(features_read, tokens_of(t.as_py() or "", lm)))
                all_.update(own)
                if label:
                    one.update(own)
            if len(all_) > HELD:
                yield table_of(one, all_)
                one, all_ = Counter(), Counter()
        yield table_of(one, all_)

    size = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    counts = sample.select("t", "y").mapInArrow(feature_rows, "f string, c1 long, c long").groupBy("f").agg(
        F.sum("c1").alias("c1"), F.sum("c").alias("c"))
    c1, c0 = F.col("c1").cast("double"), (F.col("c") - F.col("c1")).cast("double")

    def part(x, n):
        return x * F.log((x + 1e-9) / (F.col("c") * F.lit(n / (n1 + n0)) + 1e-9))
    g2 = part(c1, n1) + part(c0, n0)
    # log of the rates' ratio, less one standard error: rare features prove little
    ratio = (F.log((c1 + 0.5) / F.lit(n1 + 1.0)) - F.log((c0 + 0.5) / F.lit(n0 + 1.0))
             - F.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5)))
    chosen = (counts.where(F.col("c1") >= MIN_TOXIC).select("f", g2.alias("g"), ratio.alias("e"))
              .where((F.col("e") > 0) & (F.col("g") > SEPARATES)).orderBy(F.desc("g"), "f").limit(features))
    evidence = {r.f: r.e for r in chosen.collect()}

    def present(batches):
        import pyarrow as pa

        scorer = Scorer(lm, evidence)
        for b in batches:
            own = [scorer.text(t.as_py() or "") for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(own, pa.float64())], names=["y", "x"])

    data = sample.select("t", "y").mapInArrow(present, "y int, x double").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    w, b = logistic_fit_rows(materialize(data, "toxic-evidence"))
    # equal label totals in the fit: shift to the labels' odds in the corpus
    b += math.log(sizes[1] / sizes[0])
    return {"tri": tri, "evidence": evidence, "w": np.maximum(np.array([w]), 0.0), "b": b}


def score_texts(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    spark = df.sparkSession
    ready(spark)
    id_type = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    if model is None:
        return rows.select(F.col("i").alias(id_col), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # 50,000 trigrams and FEATURES numbers at most

    def run(batches):
        import pyarrow as pa

        m = shared.value
        scorer = Scorer(CharModel(m["tri"]), m["evidence"])
        for b in batches:
            z = np.array([m["b"] + m["w"][0] * scorer.text(t.as_py()) for t in b.column(1)], dtype=float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=[id_col, "score"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, score double")


def without_toxic(df: DataFrame, model: dict | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores below ``threshold`` (all columns kept)."""
    if model is None:
        return df
    ready(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make_keep():
        m = shared.value
        scorer = Scorer(CharModel(m["tri"]), m["evidence"])
        limit = math.log(threshold / (1 - threshold))

        def keep(column):
            return [m["b"] + m["w"][0] * scorer.text(t.as_py() or "") < limit for t in column]
        return keep

    return keep_rows(df, text_col, make_keep)


def label_pairs(df: DataFrame, text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(h, y) of the rows of ``df`` with a text."""
    t = F.col(f"`{text_col}`").cast("string")
    return df.select(F.when(t.isNotNull(), F.xxhash64(t)).alias("h"), F.col(f"`{label_col}`").cast("int").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, y) of the documents outside the held-out fifth that have a label; texts stay where they are."""
    own = docs.where(~held_out("doc_id")).where("text IS NOT NULL").select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("h"))
    lab = labels.where("toxic IS NOT NULL").select(F.col("doc_id").alias("_d"), F.col("toxic").cast("int").alias("y"))
    return own.join(lab, "_d").select("h", "y")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = fit(labelled(docs, table(spark, sf_dir, "labels")), docs)
    return score_texts(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                           (F.col("score") >= 0.5).cast("int").alias("predicted"))
