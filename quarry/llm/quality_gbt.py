"""Quality rules: fixed base rules and gradient-boosted trees over document statistics.

The trees are fitted on a bounded, hash-chosen sample of the labelled documents (logistic loss, splits on quantile
bins) and flattened into numpy node arrays that score whole Arrow batches.  For chosen features the score may only
fall: a split whose sides go the wrong way is refused and each side is bounded by the middle of the split's values.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, with_text_columns

SYMBOLS = "#*$%&|<>"                     # fixed values of the base rules
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5
SAMPLE = 20_000                          # labelled documents the trees are fitted on at most
MOST_GOOD_LOST = 0.001                   # share of good documents of the sample that the threshold may reject

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_alpha", "n_exclaim", "n_distinct", "most_frequent")
#: name -> direction of the score (-1: may only fall, 0: free)
FEATURES = {"log_words": 0, "word_length": 0, "symbols_per_word": -1, "dup_lines": -1, "repeat_words": -1,
            "upper": -1, "alpha": 0, "exclaim": -1, "distinct": 0, "most_frequent": -1, "line_words": 0}


def repeat_cover(codes: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For texts laid end to end as word codes: which words lie in a window that its text holds twice or more.

    Windows are named exactly, by naming pairs of names again: two words, three, and so on up to the window.
    """
    covered = np.zeros(len(codes), bool)
    n = len(codes) - window + 1
    if n <= 0:
        return covered
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    name = codes.astype(np.int64)
    size = int(name.max()) + 1
    words, width = name, 1
    while width < window:
        name = name[:len(words) - width] * size + words[width:]      # names stay below the number of words, so this fits
        name = pd.factorize(name)[0].astype(np.int64)
        width += 1
    inside = doc[:n] == doc[window - 1:]
    at = np.flatnonzero(inside)
    key = pd.Series(name[at] * len(ends) + doc[at])
    at = at[key.duplicated(keep=False).to_numpy()]
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[at] += 1
    edge[at + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def count_statistics(texts: list[str | None]) -> list[np.ndarray]:
    """The columns ``COUNTS`` of some texts; words are runs of other than ASCII white space."""
    raw = [(t or "").encode() for t in texts]
    words = [b.split() for b in raw]
    n = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(n)
    out = {c: np.zeros(len(raw), np.int64) for c in COUNTS}
    out["n_words"] = n
    for i, (t, b, w) in enumerate(zip(texts, raw, words)):
        if not w:
            continue
        out["word_chars"][i] = len(t) - sum(map(t.count, " \t\n\x0b\x0c\r"))
        out["n_symbols"][i] = sum(map(t.count, SYMBOLS))
        lines = [x for x in b.split(b"\n") if x and not x.isspace()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        out["n_exclaim"][i] = t.count("!")
        letters = np.frombuffer(b, np.uint8)
        upper = np.count_nonzero((letters >= 65) & (letters <= 90))
        lower = np.count_nonzero((letters >= 97) & (letters <= 122))
        out["n_upper"][i], out["n_alpha"][i] = upper, upper + lower + np.count_nonzero(letters >= 192)
    if ends.size and ends[-1]:
        flat = pa.array([x for w in words for x in w], pa.binary())
        codes = flat.dictionary_encode().indices.to_numpy()
        cover = np.concatenate([[0], np.cumsum(repeat_cover(codes, ends))])
        out["n_repeat_words"] = cover[ends] - cover[ends - n]
        doc = np.repeat(np.arange(len(n)), n)
        pair, times = np.unique(doc * (int(codes.max()) + 1) + codes, return_counts=True)
        pair //= int(codes.max()) + 1
        out["n_distinct"] = np.bincount(pair, minlength=len(n)).astype(np.int64)
        np.maximum.at(out["most_frequent"], pair, times)
    return [out[c] for c in COUNTS]


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES`` from the counts."""
    c = {k: np.asarray(v, float) for k, v in c.items()}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    letters = np.maximum(c["n_alpha"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_upper"] / letters, c["n_alpha"] / np.maximum(c["word_chars"], 1),
        c["n_exclaim"] / words, c["n_distinct"] / words, c["most_frequent"] / words, words / lines])


@dataclass
class Trees:
    """Nodes of all trees end to end: leaves point to themselves."""
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float
    threshold: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.split[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: Iterable[int], trees: int = 60, depth: int = 3,
              rate: float = 0.2, least: int = 20, bins: int = 64, ridge: float = 1.0) -> Trees:
    """Boosted trees for labels 0/1 by Newton steps on the logistic loss."""
    signs = list(monotone)
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    binned = np.column_stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    total = np.full(len(y), start)
    nodes: list[list] = []
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        nodes.append([0, 0.0, me, me, rate * float(np.clip(gs / (hs + ridge), low, high))])
        if level == depth or len(rows) < 2 * least:
            total[rows] += nodes[me][4]
            return me
        best = (1e-6, -1, 0, 0.0)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], None))
            vl, vr = np.clip(gl / (hl + ridge), low, high), np.clip((gs - gl) / (hs - hl + ridge), low, high)
            # gain of the clipped values
            gain = sum(2 * v * a - v * v * (b_ + ridge) for v, a, b_ in ((vl, gl, hl), (vr, gs - gl, hs - hl)))
            v0 = np.clip(gs / (hs + ridge), low, high)
            gain -= 2 * v0 * gs - v0 * v0 * (hs + ridge)
            gain[(nl < least) | (len(rows) - nl < least) | (signs[f] * (vr - vl) < 0)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k, (vl[k] + vr[k]) / 2)
        _, f, k, middle = best
        if f < 0:
            total[rows] += nodes[me][4]
            return me
        goes = binned[rows, f] <= k
        bounds = {-1: ((middle, high), (low, middle)), 0: ((low, high),) * 2, 1: ((low, middle), (middle, high))}[signs[f]]
        nodes[me][:2] = [f, float(cuts[f][k])]
        nodes[me][2] = grow(rows[goes], g, h, level + 1, *bounds[0])
        nodes[me][3] = grow(rows[~goes], g, h, level + 1, *bounds[1])
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), y - p, np.maximum(p * (1 - p), 1e-6), 0, -8.0, 8.0))
    feature, split, left, right, value = (np.array(c) for c in zip(*nodes))
    return Trees(feature, split.astype(float), left, right, value.astype(float), np.array(roots), depth, start)


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts of each whole text as longs (null: zeros)."""
    def make() -> Callable[[pa.Array], list]:
        return lambda texts: [pa.array(x) for x in count_statistics(texts.to_pylist())]
    return with_text_columns(docs, text, [T.StructField(c, T.LongType()) for c in COUNTS], keep, make)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Trees | None:
    """Trees for the labels quality 0/1; None without both kinds of label.

    The sample are the documents of the ``sample`` labelled ids with the smallest hashes, ``sample`` rows at most.
    The threshold is one half, or lower where more than ``MOST_GOOD_LOST`` of the sample's good documents would fall
    below it.
    """
    chosen = (labels.where("doc_id is not null and quality in (0, 1)")
              .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(sample))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))                  # at most ``sample`` small rows
    rows = (with_statistics(rows, "t", ["doc_id", "quality"])
            .orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS, "quality").limit(sample).toPandas())
    y = rows["quality"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return None
    model = fit_trees(features({c: rows[c].to_numpy() for c in COUNTS}), y, FEATURES.values())
    score = model.score(features({c: rows[c].to_numpy() for c in COUNTS}))
    model.threshold = min(0.5, float(np.quantile(score[y == 1], MOST_GOOD_LOST)))
    return model


def verdicts(counts: list[np.ndarray], model: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, score and kept of some texts by their counts."""
    c = dict(zip(COUNTS, counts))
    failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED_PERCENT * c["n_words"])
    score = model.score(features(c)) if model else np.ones(len(failed))
    return failed, score, ~failed & (score >= (model.threshold if model else 0.0))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, score and kept.

    Null and texts without a word: zero counts, base_failed.  Without labels of both kinds, or for an empty table, the
    base rules alone decide (score 1.0).  Repeated rows repeat their result; ids may be null.
    """
    model = fit(docs, labels, doc_id, text, sample)

    def make() -> Callable[[pa.Array], list]:
        def run(texts: pa.Array) -> list:
            counts = count_statistics(texts.to_pylist())
            return [pa.array(x) for x in (*counts, *verdicts(counts, model))]
        return run
    fields = ([T.StructField(c, T.LongType()) for c in COUNTS]
              + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                 T.StructField("kept", T.BooleanType())])
    return with_text_columns(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t")), "t",
                             fields, ["doc_id"], make)


def kept_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   sample: int = SAMPLE) -> DataFrame:
    """The documents that :func:`judge` keeps, all columns."""
    model = fit(docs, labels, doc_id, text, sample)

    def make() -> Callable[[pa.Array], list]:
        return lambda texts: [pa.array(verdicts(count_statistics(texts.to_pylist()), model)[2])]
    kept = free_name(docs, "kept")
    return (with_text_columns(docs, text, [T.StructField(kept, T.BooleanType())], docs.columns, make)
            .where(F.col(kept)).drop(kept))
