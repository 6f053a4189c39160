"""URL filter: allow and block rules, else logistic regression on character n-grams (operator 4).

Host and path are cut from the url with column expressions, and rules are matched there: a rule
fits its host and all subdomains when the path starts with the rule's path; the longest rule
wins (of equal lengths the first in the list). Urls without a rule are judged by a logistic regression over hashed
character 3- to 5-grams of host and path (both with end marks, so a gram knows its part), fitted on a
small labelled url table.

Fitting uses at most about ``train_rows`` distinct urls of the labelled table, drawn by a hash of the
url (documented bound of the classifier); urls of more than ``TRAIN_CHARS`` characters are not used for fitting.
Judging reads whole urls.

Defined results: host and path are empty for a NULL url and one without ``://``; such a url is judged by the
model like any other; a labelled table with one label gives that verdict to
all other urls, an empty one gives ``allow``; repeated rows get equal results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import mix64, ready, table, utf8_batch

# (rule, verdict) of the query
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
TRAIN_ROWS = 20_000
TRAIN_CHARS = 2_000
SLOTS = 1 << 16
GRAMS = (3, 4, 5)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (NULL without one)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first: later conditions stand in front of earlier ones
    for text, judged in sorted(reversed(rules), key=lambda r: len(r[0])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(judged)).otherwise(verdict)
    return rule, verdict


def gram_slots(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every distinct n-gram slot of every text, sorted."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    rows, slots = [], []
    x = raw.astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(x) < n:
                continue
            h = np.full(len(x) - n + 1, np.uint64(n))
            for j in range(n):
                h = h * np.uint64(257) + x[j: len(x) - n + 1 + j]
            ok = doc[n - 1:] == doc[: len(x) - n + 1]
            rows.append(doc[: len(x) - n + 1][ok])
            slots.append((mix64(h[ok]) >> np.uint64(48)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique(np.concatenate(rows) * SLOTS + np.concatenate(slots))
    return key // SLOTS, key % SLOTS


def marked(host: Column, path: Column) -> Column:
    return F.concat(F.lit("\x02"), host, F.lit("\x03"), path, F.lit("\x04"))


def logits(model: dict, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    at, slot = gram_slots(raw, offsets)
    size = np.maximum(np.bincount(at, minlength=n), 1)
    return model["b"] + np.bincount(at, weights=model["w"][slot], minlength=n) / np.sqrt(size)


def fit_arrays(raw: np.ndarray, offsets: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 80) -> dict:
    """Weights by Adam on all rows; y is 1 for blocked urls."""
    n = len(y)
    if not n or y.min() == y.max():
        return {"w": np.zeros(SLOTS), "b": 20.0 if n and y[0] else -20.0}
    at, slot = gram_slots(raw, offsets)
    value = (1 / np.sqrt(np.maximum(np.bincount(at, minlength=n), 1)))[at]
    used, col = np.unique(slot, return_inverse=True)
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(at, weights=w[col] * value, minlength=n)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.append(np.bincount(col, weights=e[at] * value, minlength=len(used)) + l2 * w / n, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    full = np.zeros(SLOTS)
    full[used] = w
    return {"w": full, "b": float(b)}


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "verdict", train_rows: int = TRAIN_ROWS) -> dict:
    """Model from a table of urls labelled ``allow`` or ``block``."""
    rows = labelled.select(F.col(f"`{url_col}`").cast("string").alias("u"), F.col(f"`{label_col}`").alias("v"))
    rows = rows.where("u IS NOT NULL AND v IN ('allow', 'block')").where(F.length("u") <= TRAIN_CHARS).withColumn("h", F.xxhash64("u"))
    n = rows.agg(F.approx_count_distinct("h")).first()[0]
    unit = F.pmod(F.xxhash64("h", F.lit(41)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    host, path = host_and_path(F.col("u"))
    sample = rows.where(unit < F.lit(min(1.0, train_rows / max(n, 1)))).select(marked(host, path).alias("m"), "v", "h")
    data = sample.dropDuplicates(["h", "v"]).orderBy("h", "v").toArrow()
    y = np.array([v == "block" for v in data.column("v").to_pylist()], dtype=float)
    if not len(y):
        return {"w": np.zeros(SLOTS), "b": -20.0}
    return fit_arrays(*utf8_batch(data.column("m")), y)


def judge(df: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, p_block) of every row; p_block is the model's."""
    spark = df.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)  # SLOTS weights
    id_type = dict(df.dtypes)[id_col]
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = df.select(F.col(f"`{id_col}`").alias("i"), host.alias("h"), path.alias("p"), marked(host, path).alias("m"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            p = 1 / (1 + np.exp(-logits(shared.value, *utf8_batch(b.column(3)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(p)], names=[id_col, "host", "path", "p_block"])

    out = rows.mapInArrow(run, f"`{id_col}` {id_type}, host string, path string, p_block double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("p_block") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, other).alias("verdict"), "p_block")


def labelled_by_rules(df: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """(url, verdict) of the rows that a rule fits."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    _, verdict = rule_of(host, path, rules)
    return df.select(F.col(f"`{url_col}`").alias("url"), verdict.alias("verdict")).where("verdict IS NOT NULL")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page; the labelled table is the urls that the rules judge."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, fit(labelled_by_rules(pages)))
