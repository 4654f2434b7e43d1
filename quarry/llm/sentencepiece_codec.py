"""SentencePiece BPE encoding by a table of the last token of every prefix.

In BPE a token sequence is the encoding of its text if and only if each pair of neighbours is: merging the text of
the pair alone gives the pair back (merges inside a pair do not depend on what stands outside it as long as nothing
crosses its ends).  So every prefix of a text has exactly one last token.  An automaton over all pieces gives, for
each position, the pieces that end there; the one that is compatible with the last token of the prefix in front of
it is entered in the table, and the ids are read off backwards.  Runs of ``U+2581`` open a chunk: no piece has that
character behind another one, so chunks are encoded on their own and kept in a bounded memo.
"""
from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.common import with_text_columns

SPACE = "▁"
MEMO = 250_000           # chunks in each of the two generations of a Python worker's memo
PAIRS = 1_000_000        # pairs of tokens held before their memo starts anew


class PrefixTable:
    """Encoder for a byte-fallback BPE model without text normalisation (the model's own ``encode`` is not used)."""

    def __init__(self, model_path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        probe = "a  ﬁ\tB "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models with identity normalisation and a space put in front are supported")
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            raise ValueError("only models with byte pieces are supported")
        self.id = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                   if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("only models whose pieces have spaces in front are supported")
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.piece = {i: p for p, i in self.id.items()}
        self.chars = {p for p in self.id if len(p) == 1}
        line = "" if any("\n" in p for p in self.id) else "\n"
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + (f"|{line}" if line else "")).findall
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.end_id = sp.eos_id()
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.built: dict[int, tuple[list[float], list[str], list[str]] | None] = {}

    def steps(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """How BPE builds a token from its characters, the best merge first and the leftmost of equals: the score of each
        merge, and the outermost left and right parts before each merge and at the end.  None if it does not build it."""
        if token not in self.built:
            parts = list(self.piece[token])
            scores, lefts, rights = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                gains = [(self.score.get(a + b, None), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                gains = [g for g in gains if g[0] is not None]
                if not gains:
                    break
                best, at = max(gains)
                parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
                scores.append(best)
                lefts.append(parts[0])
                rights.append(parts[-1])
            self.built[token] = (scores, lefts, rights) if len(parts) == 1 else None
        return self.built[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens may stand side by side; ``left`` is -1 at the start of a chunk.

        Their merges run in the order in which BPE of the joint text takes them; the tokens are compatible unless a
        merge of the parts on both sides of the border comes to be the best one.
        """
        b = self.steps(right)
        if left < 0 or b is None:
            return b is not None
        a = self.steps(left)
        if a is None:
            return False
        (sa, _, inner_a), (sb, inner_b, _) = a, b
        i = j = 0
        while True:
            across = self.score.get(inner_a[i] + inner_b[j])
            if i < len(sa) and (j == len(sb) or sa[i] >= sb[j]):
                if across is not None and across > sa[i]:
                    return False
                i += 1
            elif j < len(sb):
                if across is not None and across >= sb[j]:
                    return False
                j += 1
            else:
                return across is None

    def segment(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n, pairs = len(text), self.pairs
        last, at = [-1] * (n + 1), [0] * (n + 1)       # of the prefix of each length: last token, and where it starts
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                left = last[end - size]
                key = (left << 32) + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(left, token)
                if fits:
                    last[end], at[end] = token, end - size
        ids = []
        while n:
            ids.append(last[n])
            n = at[n]
        ids.reverse()
        return ids

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a chunk; a character that is no piece stands for its UTF-8 bytes and splits the text around it."""
        ids = self.chunks.get(text)
        if ids is None:
            ids = self.older.get(text)
            if ids is None:
                if self.chars.issuperset(text):
                    ids = tuple(self.segment(text))
                else:
                    found, run = [], []
                    for c in [*text, ""]:
                        if c and c in self.chars:
                            run.append(c)
                            continue
                        if run:
                            found += self.segment("".join(run))
                            run = []
                        found += [self.bytes[b] for b in c.encode()]
                    ids = tuple(found)
            if len(text) <= 64:
                if len(self.chunks) >= MEMO:       # what was used since the last turn stays
                    self.older, self.chunks = self.chunks, {}
                self.chunks[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """All ids of ``text`` and the end id."""
        ids: list[int] = []
        if text:
            chunks = self.cut(SPACE + text.replace(" ", SPACE))
            memo = self.chunks.get
            found = [memo(c) for c in chunks]
            if None in found:
                found = [x if x is not None else self.chunk(c) for x, c in zip(found, chunks)]
            ids.extend(chain.from_iterable(found))
        ids.append(self.end_id)
        return ids

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


_TABLES: dict[str, PrefixTable] = {}


def prefix_table(model_path: str) -> PrefixTable:
    """The worker's table of a model; workers are used again, so it is built once."""
    if model_path not in _TABLES:
        _TABLES[model_path] = PrefixTable(model_path)
    return _TABLES[model_path]


def encode_and_decode(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None,
                      ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The columns ``keep`` (all by default) of ``df``, the token ids of its whole texts (array of int, end id last)
    and the text that the ids decode to.  The model file lies at the same path on every executor.

    Null and empty texts: the end id only, decoded to the empty string.  Rows are independent, so repeated rows repeat
    their result, an empty table gives no rows, and a column named like a result is replaced by it.  Long texts are
    encoded whole, in linear time; a Python worker holds a few MB of text at a time.
    """
    def make() -> Callable[[pa.Array], list]:
        table = prefix_table(model_path)

        def run(texts: pa.Array) -> list:
            rows = [table.encode(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(table.decode(rows), pa.string())]
        return run
    return with_text_columns(df, text, [T.StructField(ids, T.ArrayType(T.IntegerType())),
                                        T.StructField(decoded, T.StringType())],
                             df.columns if keep is None else keep, make)
