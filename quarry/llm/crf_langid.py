"""Language labels for words by a linear-chain conditional random field.

A word is a run of letters; a run of more than 24 characters, as in text without spaces, is cut into consecutive words
of that length, so every letter is seen.  Each word's emission comes from hashed features: affixes, character n-grams and the word itself (a learned lexicon).
Learned transitions tie neighbours together, and forward-backward gives every word its probability for each language,
so code-switched text gets runs of labels.  A text's language is the one with the largest sum over its words.

The field is fitted on segments of a bounded, hash-chosen sample of labelled documents, laid end to end across
languages so that switches occur.  All words of a piece of texts form one chain whose links are cut at the texts'
starts; the chain is folded into rows, each row's transfer matrix is computed first and joined to the next, so long
and short texts cost the same a word.
"""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import with_text_columns

SAMPLE_DOCS = 4_000        # labelled documents the field is fitted on at most
SAMPLE_CHARS = 20_000      # longer documents are not drawn into the sample
SAMPLE_WORDS = 60_000      # words of their segments at most
SEGMENT = 20               # mean words of a segment
HASH_BITS = 17             # hashed feature weights a language
WIDTH = 24                 # characters of a place of the chain; a longer run of letters takes several places
UNKNOWN = "und"
RUN = re.compile(r"[^\W\d_]+")     # letters, and numerals such as one half, superscript two or Roman eight


def split_rule(doc_id: Column) -> Column:
    """True for held-out documents; a null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def words_in(text: str | None) -> list[str]:
    """The words of a text in lower case: runs of letters, cut where they are longer than ``WIDTH``."""
    found = RUN.findall(text.lower()) if text else []
    if not all(map(str.isalpha, found)):
        found = [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]
    if found and max(map(len, found)) > WIDTH:
        found = [w[i:i + WIDTH] for w in found for i in range(0, len(w), WIDTH)]
    return found


def word_features(words: list[str]) -> np.ndarray:
    """Feature numbers of each word (one row; unused places have number 0)."""
    c = np.array(words, dtype=f"<U{WIDTH}").view(np.uint32).reshape(len(words), WIDTH)
    n = (c != 0).sum(axis=1)
    rows = np.arange(len(words))
    c = np.concatenate([np.full((len(words), 1), 2, np.uint32), c, np.zeros((len(words), 1), np.uint32)], axis=1)
    c[rows, n + 1] = 3                                               # marks of the word's start and end

    def mixed(h: np.ndarray, kind: int) -> np.ndarray:
        h = (h ^ np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - HASH_BITS)

    def rolled(size: int) -> np.ndarray:
        h = c[:, :c.shape[1] - size + 1].copy()
        for k in range(1, size):
            h = h * np.uint32(0x01000193) + c[:, k:c.shape[1] - size + 1 + k]
        return h
    out = [mixed(rolled(1), 1), mixed(rolled(2), 2), mixed(rolled(3), 3)]
    live = [np.arange(x.shape[1])[None, :] + size <= n[:, None] + 2 for x, size in zip(out, (1, 2, 3))]
    whole = np.zeros(len(words), np.uint32)
    for col in c.T:                                                  # lexicon feature: all characters in order
        whole = np.where(col != 0, whole * np.uint32(0x01000193) + col, whole)
    affixes = [whole]
    for k in (2, 3, 4):
        pre, suf = np.zeros_like(whole), np.zeros_like(whole)
        for i in range(k):
            pre = pre * np.uint32(0x01000193) + c[:, 1 + i]
            suf = suf * np.uint32(0x01000193) + c[rows, np.maximum(n - i, 0)]
        affixes += [pre, suf]
    out.append(np.column_stack([mixed(a, 10 + i) for i, a in enumerate(affixes)]))
    live.append(np.ones((len(words), len(affixes)), bool))
    found, keep = np.concatenate(out, axis=1).astype(np.int64), np.concatenate(live, axis=1)
    return np.where(keep, np.maximum(found, 1), 0)


def folded(x: np.ndarray, rows: int, fill: float) -> np.ndarray:
    steps = -(-len(x) // rows)
    out = np.full((rows * steps, *x.shape[1:]), fill, x.dtype)
    out[:len(x)] = x
    return out.reshape(rows, steps, *x.shape[1:])


def marginals(emission: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray,
              moves: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward over one chain that begins anew wherever ``first``: each place's probabilities.

    emission (places x labels), start and move are positive; every row may have its own scale.  ``moves`` (labels x
    labels), if given, gets the expected number of moves from label to label.
    """
    n, k = emission.shape
    rows = max(1, min(2048, int(np.sqrt(n))))
    e, cut = folded(emission, rows, 1.0), folded(first, rows, False)
    steps = e.shape[1]
    live = folded(np.ones(n, bool), rows, False)
    if n < live.size:
        cut.ravel()[n] = True                                        # what fills the last row is a chain of its own
    cuts = [np.flatnonzero(cut[:, s]) for s in range(steps)]
    carry = np.tile(np.eye(k), (rows, 1, 1))                         # each row's transfer matrix
    for s in range(steps):
        new = (carry.reshape(-1, k) @ move).reshape(rows, k, k) * e[:, s, None, :]
        if cuts[s].size:
            new[cuts[s]] = carry[cuts[s]].sum(axis=2, keepdims=True) * start * e[cuts[s], s, None, :]
        carry = new / new.sum(axis=(1, 2), keepdims=True) if s % 4 == 3 or s == steps - 1 else new
    into, back = np.ones((rows, k)), np.ones((rows, k))              # what rows in front and behind hand over
    for r in range(1, rows):
        v = into[r - 1] @ carry[r - 1]
        into[r] = v / v.sum()
        v = carry[rows - r] @ back[rows - r]
        back[rows - r - 1] = v / v.sum()
    ahead, a = np.empty((rows, steps, k)), into
    for s in range(steps):
        a = a @ move
        if cuts[s].size:
            a[cuts[s]] = start
        a = a * e[:, s]
        a /= a.sum(axis=1, keepdims=True)
        ahead[:, s] = a
    b = back
    for s in range(steps - 1, -1, -1):
        seen = e[:, s] * b
        if moves is not None:
            pair = (ahead[:, s - 1] if s else into)[:, :, None] * move * seen[:, None, :]
            inner = live[:, s] & ~cut[:, s]
            moves += (pair / pair.sum(axis=(1, 2), keepdims=True))[inner].sum(axis=0)
        ahead[:, s] *= b
        b = seen @ move.T
        if cuts[s].size:
            b[cuts[s]] = 1.0
        b /= b.sum(axis=1, keepdims=True)
    out = ahead.reshape(-1, k)[:n]
    return out / out.sum(axis=1, keepdims=True)


@dataclass
class Field:
    """A fitted field: labels in order, feature weights (row 0 is zero), log start and log move scores."""
    labels: list[str]
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        f = word_features(words)
        score = sum(self.weights[f[:, i]] for i in range(f.shape[1]))
        return np.exp(score - score.max(axis=1, keepdims=True)) + 1e-12

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: the number of words, each word's probabilities, and the place of each text's first word."""
        found = [words_in(t) for t in texts]
        sizes = np.array([len(w) for w in found], np.int64)
        total = int(sizes.sum())
        if total == 0:
            return sizes, np.zeros((0, len(self.labels))), np.zeros(0, np.int64)
        flat = pa.array([x for w in found for x in w], pa.string()).dictionary_encode()
        e = self.emissions(flat.dictionary.to_pylist())[flat.indices.to_numpy()]
        at = (np.cumsum(sizes) - sizes)
        first = np.zeros(total, bool)
        first[at[sizes > 0]] = True
        return sizes, marginals(e, first, np.exp(self.start), np.exp(self.move)), at


def train(docs: list[tuple[str, str]], seed: int = 1, rounds: int = 40, rate: float = 0.1, decay: float = 1e-4) -> Field | None:
    """Fit a field on (text, language) pairs by gradient steps (Adam) on the conditional likelihood of the labels."""
    labels = sorted({lang for _, lang in docs})
    if not labels:
        return None
    k, rng = len(labels), np.random.Generator(np.random.PCG64(seed))
    split = [(words_in(t), labels.index(lang)) for t, lang in docs]
    split = [(w, y) for w, y in split if w]
    if not split:
        return None
    share = SAMPLE_WORDS // len(split) + 1
    segments = []
    for words, y in split:                                           # segments from all over the document
        left = share
        while left > 0:
            n = min(left, int(rng.geometric(1 / SEGMENT)))
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            segments.append((words[at:at + n], y))
            left -= n
    rng.shuffle(segments)
    words = [x for w, _ in segments for x in w][:SAMPLE_WORDS]
    y = np.array([v for w, v in segments for _ in w])[:SAMPLE_WORDS]
    first = np.zeros(len(words), bool)
    first[::200] = True                                              # many short chains
    flat = pa.array(words, pa.string()).dictionary_encode()
    code, feats = flat.indices.to_numpy(), word_features(flat.dictionary.to_pylist())
    weights, start, move = np.zeros((1 << HASH_BITS, k)), np.zeros(k), np.zeros((k, k))
    params = [weights, start, move]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    gold = np.zeros((len(y), k))
    gold[np.arange(len(y)), y] = 1
    inner = np.flatnonzero(~first[1:]) + 1
    taken = gold[inner - 1].T @ gold[inner]
    flat_feats = feats.ravel()
    for step in range(1, rounds + 1):
        score = sum(weights[feats[:, i]] for i in range(feats.shape[1]))[code]
        e = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-12
        joint = np.zeros((k, k))
        p = marginals(e, first, np.exp(start), np.exp(move), joint)
        miss = gold - p
        by_word = np.column_stack([np.bincount(code, miss[:, j], len(feats)) for j in range(k)])
        g = np.column_stack([np.bincount(flat_feats, np.repeat(by_word[:, j], feats.shape[1]), 1 << HASH_BITS) for j in range(k)])
        grads = [g / len(y) - decay * weights, miss[first].mean(axis=0), (taken - joint) / len(y)]
        for q, d, (m, v) in zip(params, grads, moments):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            q += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        weights[0] = 0
    return Field(labels, weights.astype(np.float32), start, move)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Field | None:
    """Fit on documents that are not held out and have a language; None if there are none with a letter.

    The sample: the ``SAMPLE_DOCS`` ids with the smallest hashes among documents of at most ``SAMPLE_CHARS`` characters.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"),
                       F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(~split_rule(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("t").isNotNull()
                      & (F.length("t") <= SAMPLE_CHARS))
    chosen = rows.select(F.col("doc_id").alias("chosen"), F.xxhash64("doc_id").alias("h")).orderBy("h", "chosen").limit(SAMPLE_DOCS)
    sample = (rows.join(F.broadcast(chosen.select("chosen").distinct()), F.col("doc_id") == F.col("chosen"))   # bounded by the limit
              .select("doc_id", "t", "lang").limit(SAMPLE_DOCS).toPandas().sort_values(["doc_id", "t", "lang"]))
    return train(list(zip(sample["t"], sample["lang"])))


def predict(docs: DataFrame, field: Field | None, text: str = "text", keep: list[str] | None = None, lang_pred: str = "lang_pred",
            score: str = "score", runs: str | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), the language of each whole text and its mean probability over the words.

    With ``runs``, also the runs of words with one label: array of (start, end, lang), words counted from 0, end
    exclusive.  Null texts, texts without a letter, and all texts if nothing was learned: ``und``, score 0, no runs.
    Rows are independent, so repeated rows repeat their result; an empty table gives no rows.
    """
    fields = [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]
    if runs:
        fields.append(T.StructField(runs, T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))))
    shared = docs.sparkSession.sparkContext.broadcast(field)          # fixed size: hashed weights

    def make() -> Callable[[pa.Array], list]:
        model = shared.value

        def run(texts: pa.Array) -> list:
            texts = texts.to_pylist()
            lang, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            found: list[list] = [[] for _ in texts]
            if model is not None:
                sizes, p, at = model.words(texts)
                has = np.flatnonzero(sizes)
                if has.size:
                    sums = np.add.reduceat(p, at[has], axis=0)
                    best = sums.argmax(axis=1)
                    sure[has] = np.clip(sums[np.arange(len(has)), best] / sizes[has], 0, 1)
                    for i, b in zip(has.tolist(), best.tolist()):
                        lang[i] = model.labels[b]
                    if runs:
                        label = p.argmax(axis=1)
                        for i in has.tolist():
                            own = label[at[i]:at[i] + sizes[i]]
                            ends = [*(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
                            found[i] = [{"start": s, "end": e, "lang": model.labels[own[s]]} for s, e in zip([0, *ends[:-1]], ends)]
            return [pa.array(lang, pa.string()), pa.array(sure)] + ([found] if runs else [])
        return run
    return with_text_columns(docs, text, fields, docs.columns if keep is None else keep, make)
