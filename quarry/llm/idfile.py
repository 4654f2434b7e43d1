"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

An id is coded in at most two steps.  The first says whether it is the id that the order-2 context (the two ids
before it) predicts, the one that the order-1 context predicts, or neither; its probabilities mix the adaptive counts
kept for the confidence of both predictions.  The second codes an id that neither predicts with the adaptive order-0
frequencies of its high part.  Every block starts with empty models, so blocks are coded side by side: all steps run
on numpy arrays with a lane for each block.  All arithmetic is on integers, so files read the same everywhere.

The container is a Parquet table (part, block_no, tokens, block); a block is

    magic "QTB2" | tokens u32 | shift u8 | entries u32 | digits u32 | first token of the block in its part u64
    | first document of the block in its part u64 | per entry: doc_id i64, has_id u8, begins u8, tokens u32
    | digits u16 ... | crc32 u32 of all that stands before it

with little-endian numbers; an entry is the share that a document has in the block.
"""
from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices, written

MAGIC = b"QTB2"
BLOCK, LANES = 4096, 1536            # tokens in a block; blocks coded side by side
SLOTS = 10                           # bits of a context's place in a block's tables
REFRESH, FADE = 512, 64              # steps between new order-0 frequencies; between looks at large counts
U, FIELD = np.uint64, 20              # bits of a count
NONE, ONE, MASK = U(0), U(1), U((1 << FIELD) - 1)
MORE = np.array([24 << k * FIELD for k in range(3)], np.uint64)
LOW, TOP = np.uint64(1 << 32), np.uint64((1 << 48) - 1)
HEAD, ENTRY = struct.Struct("<4sIBIIQQ"), np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("begins", "u1"), ("tokens", "<u4")])
BLOCKS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block_no", T.LongType()),
                       T.StructField("tokens", T.LongType()), T.StructField("block", T.BinaryType())])


def fields(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three counts of the first step that stand side by side in a number; sums of two still fit."""
    return seen & MASK, (seen >> U(FIELD)) & MASK, seen >> U(2 * FIELD)


class Models:
    """The models of ``n`` blocks before their first id."""

    def __init__(self, n: int, shift: int):
        self.n, self.shift = n, shift
        self.order = [np.zeros(n << SLOTS, np.uint32) for _ in range(2)]     # order-1, order-2: id * 4 + confidence
        self.seen = [np.full(n * 8, 8 | 8 << FIELD | 16 << 2 * FIELD, np.uint64) for _ in range(2)]
        self.counts = np.ones(n * 256, np.int32)
        self.lane256 = np.arange(n) * 256
        self.lane8, self.lane_slots = np.arange(n) * 8, np.arange(n) << SLOTS
        self.refresh()

    def refresh(self) -> None:
        """Order-0 frequencies of the high parts, 4096 in all, from the counts."""
        counts = self.counts.reshape(self.n, 256).astype(np.int64)
        share = 1 + counts * 3840 // counts.sum(axis=1, keepdims=True)
        share[np.arange(self.n), share.argmax(axis=1)] += 4096 - share.sum(axis=1)
        self.share = share.ravel()
        start = np.cumsum(share, axis=1).ravel() - self.share
        self.place = ((start << 16) | self.share).astype(np.uint32)
        self.counts = (self.counts + 1) >> 1

    def inverse(self) -> np.ndarray:
        """For each block and frequency place the high part there."""
        return np.repeat(np.tile(np.arange(256, dtype=np.uint8), self.n), self.share)

    def places(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the frequencies of high parts start, and how wide they are."""
        both = self.place[cells]
        return (both >> np.uint32(16)).astype(np.uint64), (both & np.uint32(0xFFFF)).astype(np.uint64)

    def fade(self) -> None:
        for s in self.seen:
            big = np.flatnonzero(sum(fields(s)) > 1024)
            s[big] = sum((x + ONE >> ONE) << U(k * FIELD) for k, x in enumerate(fields(s[big])))

    def predict(self, m: int, p1: np.ndarray, p2: np.ndarray) -> None:
        """Predictions, and cumulative counts of the first step, for the first ``m`` blocks."""
        h1 = p1 * np.uint32(0x9E3779B1)
        h2 = (h1 ^ (p2 * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
        self.at = [(h >> np.uint32(32 - SLOTS)).astype(np.int64) + self.lane_slots[:m] for h in (h1, h2)]
        e1, e2 = (o[a] for o, a in zip(self.order, self.at))
        self.entry, self.c1, self.c2 = (e1, e2), e1 >> 2, e2 >> 2
        same = self.c1 == self.c2
        self.ctx = [self.lane8[:m] + (e & 3) * 2 + same for e in (e1, e2)]
        self.f0, self.f1, self.f2 = fields(self.seen[0][self.ctx[0]] + self.seen[1][self.ctx[1]])
        self.f1[same] = 0
        self.f01 = self.f0 + self.f1
        self.total = self.f01 + self.f2

    def learn(self, ids: np.ndarray, event: np.ndarray) -> None:
        more = MORE[event]
        for s, c in zip(self.seen, self.ctx):
            s[c] += more
        first = ids << 2
        for o, a, e, c in zip(self.order, self.at, self.entry, (self.c1, self.c2)):
            sure = e & 3
            o[a] = np.where(c == ids, e + (sure < 3), np.where(sure > 0, e - 1, first))

    def count(self, cells: np.ndarray) -> None:
        self.counts[cells] += 32


def encode_blocks(ids: list[np.ndarray], shift: int) -> list[np.ndarray]:
    """Digits (u16) of blocks given in order of falling length."""
    n, steps = len(ids), len(ids[0])
    lens = np.array([len(x) for x in ids])
    grid = np.zeros((steps, n), np.uint32)
    for i, x in enumerate(ids):
        grid[:len(x), i] = x
    mo, mask = Models(n, shift), np.uint32((1 << shift) - 1)
    low, rng = np.zeros(n, np.uint64), np.full(n, TOP)
    out, pos = np.zeros((n, 2 * steps + 8), np.uint32), np.zeros(n, np.int64)
    sh, wide = np.uint64(shift), np.uint64(12 + shift)

    def shift_out(small: np.ndarray) -> None:
        while small.size:
            out[small, pos[small]] = low[small] >> np.uint64(32)
            pos[small] += 1
            low[small] = (low[small] & np.uint64(0xFFFFFFFF)) << np.uint64(16)
            rng[small] <<= np.uint64(16)
            small = small[rng[small] < LOW]
    every = np.arange(n)
    p1 = p2 = np.zeros(n, np.uint32)
    for t in range(steps):
        m = int(np.searchsorted(-lens, -t, "left")) if lens[-1] <= t else n
        if t and t % FADE == 0:
            mo.fade()
            if t % REFRESH == 0:
                mo.refresh()
        x = grid[t, :m]
        mo.predict(m, p1[:m], p2[:m])
        by2, by1 = x == mo.c2, x == mo.c1
        event = np.where(by2, 0, np.where(by1, 1, 2))
        r = rng[:m] // mo.total
        low[:m] += r * np.where(by2, NONE, np.where(by1, mo.f0, mo.f01))
        rng[:m] = r * np.where(by2, mo.f0, np.where(by1, mo.f1, mo.f2))
        shift_out(np.flatnonzero(rng[:m] < LOW))
        new = np.flatnonzero(event == 2)
        if new.size:
            fresh = x[new]
            cells = mo.lane256[new] + (fresh >> np.uint32(shift))
            start, share = mo.places(cells)
            r = rng[new] >> wide
            low[new] += r * ((start << sh) + (fresh & mask) * share)
            r *= share
            rng[new] = r
            shift_out(new[r < LOW])
            mo.count(cells)
        mo.learn(x, event)
        p1, p2 = x, p1
    for _ in range(3):
        out[every, pos] = low >> np.uint64(32)
        pos += 1
        low = (low & np.uint64(0xFFFFFFFF)) << np.uint64(16)
    for i in range(int(pos.max()) - 1, 0, -1):            # carries run towards the front
        out[:, i - 1] += out[:, i] >> 16
        out[:, i] &= 0xFFFF
    return [out[i, :pos[i]].astype("<u2") for i in range(n)]


def decode_blocks(digits: list[np.ndarray], lens: np.ndarray, shift: int) -> list[np.ndarray]:
    """The ids of blocks given in order of falling length."""
    n, steps = len(digits), int(lens[0])
    width = max(map(len, digits)) + 4
    src = np.zeros((n, width), np.uint64)
    for i, d in enumerate(digits):
        src[i, :len(d)] = d
    mo, grid = Models(n, shift), np.zeros((steps, n), np.uint32)
    code, rng, pos = np.zeros(n, np.uint64), np.full(n, TOP), np.full(n, 3)
    for k in range(3):
        code = (code << np.uint64(16)) | src[:, k]
    sh, wide = np.uint64(shift), np.uint64(12 + shift)

    def shift_in(small: np.ndarray) -> None:
        while small.size:
            code[small] = (code[small] << np.uint64(16)) | src[small, np.minimum(pos[small], width - 1)]
            pos[small] += 1
            rng[small] <<= np.uint64(16)
            small = small[rng[small] < LOW]
    inverse = mo.inverse()
    p1 = p2 = np.zeros(n, np.uint32)
    for t in range(steps):
        m = int(np.searchsorted(-lens, -t, "left")) if lens[-1] <= t else n
        if t and t % FADE == 0:
            mo.fade()
            if t % REFRESH == 0:
                mo.refresh()
                inverse = mo.inverse()
        mo.predict(m, p1[:m], p2[:m])
        r = rng[:m] // mo.total
        v = code[:m] // r
        by2, fresh = v < mo.f0, v >= mo.f01
        event = np.where(by2, 0, np.where(fresh, 2, 1))
        code[:m] -= r * np.where(by2, NONE, np.where(fresh, mo.f01, mo.f0))
        rng[:m] = r * np.where(by2, mo.f0, np.where(fresh, mo.f2, mo.f1))
        shift_in(np.flatnonzero(rng[:m] < LOW))
        x = np.where(by2, mo.c2, mo.c1)
        new = np.flatnonzero(fresh)
        if new.size:
            r = rng[new] >> wide
            v = np.minimum(code[new] // r, np.uint64((4096 << shift) - 1))
            high = inverse[new * 4096 + (v >> sh).astype(np.int64)].astype(np.int64)
            cells = mo.lane256[new] + high
            start, share = mo.places(cells)
            start <<= sh
            rest = (v - start) // share
            code[new] -= r * (start + rest * share)
            r *= share
            rng[new] = r
            shift_in(new[r < LOW])
            x[new] = (high << shift).astype(np.uint32) | rest.astype(np.uint32)
            mo.count(cells)
        mo.learn(x, event)
        grid[t, :m] = x
        p1, p2 = x, p1
    return [grid[:n_, i] for i, n_ in enumerate(lens)]


def pack(ids: np.ndarray, digits: np.ndarray, entries: np.ndarray, shift: int, first_token: int, first_doc: int) -> bytes:
    body = HEAD.pack(MAGIC, len(ids), shift, len(entries), len(digits), first_token, first_doc) + entries.tobytes() + digits.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(block: bytes) -> tuple[int, int, int, int, np.ndarray, np.ndarray]:
    """tokens, shift, first token, first document, entries and digits of a block; raises on a wrong checksum."""
    if block[:4] != MAGIC or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]):
        raise ValueError("damaged block")
    _, tokens, shift, n, m, token, doc = HEAD.unpack_from(block)
    at = HEAD.size + n * ENTRY.itemsize
    return tokens, shift, token, doc, np.frombuffer(block, ENTRY, n, HEAD.size), np.frombuffer(block, "<u2", m, at)


class Encoder:
    """``tokenizers`` ids of whole texts, word by word through a bounded memo.

    The byte-level pattern always cuts between a character that is no white space and a space, so a text without white
    space in front of a space is the chain of its words; any other text goes to the library as it is, and so does a
    text that holds the string of an added token.
    """
    MEMO = 400_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        n = self.library.get_vocab_size()
        self.shift = max(0, (n - 1).bit_length() - 8)
        self.sizes = np.array([len(self.library.id_to_token(i) or "") for i in range(n)])
        probe = self.library.encode(" a b", add_special_tokens=False).ids
        self.by_word = probe == [i for w in (" a", " b") for i in self.library.encode(w, add_special_tokens=False).ids] \
            and self.sizes[probe].sum() == 4
        added = [x.content for x in self.library.get_added_tokens_decoder().values() if x.content]
        if self.library.normalizer is not None or any(" " in x for x in added):
            self.by_word = False                             # an added token may arise from words that do not hold it
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd = re.compile("|".join([r"\s[ ]|\s\Z", *map(re.escape, added)])).search

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def fill(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that all open with a space: a few hundred are one text for the library, cut by their bytes."""
        found = {}
        for i in range(0, len(words), 512):
            some = words[i:i + 512]
            ids = np.array(self.library.encode("".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) for w in some])) + 1
            at = 0
            for w, e in zip(some, ends.tolist()):
                found[w] = ids[at:e].tobytes()
                at = e
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian u32."""
        split = [None if not t or not self.by_word or self.odd(t) else t.split(" ") for t in texts]
        words = [w for ws in split if ws for w in ws[1:]]
        found = list(map(self.memo.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        need = {words[i] for i in gaps}
        self.memo.update((w, self.older[w]) for w in need if w in self.older)
        for w, ids in self.fill([" " + w for w in need if w not in self.memo]).items():
            self.memo[w[1:]] = ids
        for i in gaps:
            found[i] = self.memo[words[i]]
        out, at = [], 0
        for t, ws in zip(texts, split):
            if ws:
                end = at + len(ws) - 1
                out.append(self.whole(ws[0]) + b"".join(found[at:end]))
                at = end
            else:
                out.append(self.whole(t) if t else b"")
        if len(self.memo) > self.MEMO:
            self.older, self.memo = self.memo, {}
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Writer:
    """Cuts the ids of a part's documents into blocks and codes ``LANES`` of them at a time."""

    def __init__(self, part: int, shift: int):
        self.part, self.shift, self.token, self.doc, self.block_no = part, shift, 0, 0, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id or 0, doc_id is not None, True, len(ids)))
        self.held += len(ids)

    def rows(self, end: bool) -> Iterator[pa.RecordBatch]:
        while self.held >= BLOCK * LANES or (end and self.held):
            flat = np.concatenate(self.ids)
            docs = np.array(self.docs, ENTRY)
            take = min(len(flat), BLOCK * LANES)
            cuts = np.arange(0, take, BLOCK)
            pieces = [flat[c:min(c + BLOCK, take)] for c in cuts]
            digits = encode_blocks(pieces, self.shift)
            stops = np.cumsum(docs["tokens"].astype(np.int64))
            starts = stops - docs["tokens"]
            blocks = []
            for c, ids, d in zip(cuts.tolist(), pieces, digits):
                a, b = int(np.searchsorted(stops, c, "right")), int(np.searchsorted(starts, c + len(ids), "left"))
                entries = docs[a:b].copy()
                entries["begins"] &= starts[a:b] >= c
                entries["tokens"] = np.minimum(stops[a:b], c + len(ids)) - np.maximum(starts[a:b], c)
                blocks.append(pack(ids, d, entries, self.shift, self.token + c, self.doc + a))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(blocks), self.part, np.int32)), pa.array(np.arange(len(blocks)) + self.block_no),
                 pa.array([len(x) for x in pieces], pa.int64()), pa.array(blocks, pa.binary())], names=BLOCKS.names)
            left = int(np.searchsorted(stops, take, "right"))
            self.token, self.doc, self.block_no = self.token + take, self.doc + left, self.block_no + len(blocks)
            rest = docs[left:].copy()
            if len(rest):
                rest["begins"][0] &= starts[left] >= take
                rest["tokens"][0] = stops[left] - max(starts[left], take)
            self.ids, self.docs = ([flat[take:]] if take < len(flat) else []), rest.tolist()
            self.held = len(flat) - take


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all whole texts, ``end_id`` behind each, below ``path`` in ascending order of the id.

    Null and empty texts are the end id alone.  Null ids stand first; equal ids keep the order of the input.  Parts
    follow one another in that order; a part has the rows of one range of ids, and equal ids may be split over parts.
    """
    tie = "quarry tie"
    rows = (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))
            .withColumn(tie, F.monotonically_increasing_id())
            .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).select("doc_id", "t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        out, last = Writer(TaskContext.get().partitionId(), enc.shift), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for piece in slices(batch, 1):
                for i, ids in zip(piece.column(0).to_pylist(), enc.encode(piece.column(1).to_pylist())):
                    out.add(i, np.frombuffer(ids + last, "<u4"))
                yield from out.rows(end=False)
        yield from out.rows(end=True)
    rows.mapInArrow(run, BLOCKS).write.option("compression", "uncompressed").parquet(path)


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Decode all blocks: a row for each share of a document in a block, with the ids of the share."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_no", T.LongType()),
                           T.StructField("block_no", T.LongType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("begin", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("whole", T.BooleanType()), T.StructField("crc", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, LANES):
                b = whole.slice(at, LANES)
                parts, numbers = b.column(0).to_pylist(), b.column(1).to_pylist()
                read = [unpack(x) for x in b.column(2).to_pylist()]
                rows = []
                for shift in {x[1] for x in read}:
                    order = sorted((i for i, x in enumerate(read) if x[1] == shift), key=lambda i: -read[i][0])
                    decoded = decode_blocks([read[i][5] for i in order], np.array([read[i][0] for i in order]), shift)
                    for i, ids in zip(order, decoded):
                        raw, pos = ids.astype("<u4").tobytes(), 0
                        tokens, _, token, doc, entries, _ = read[i]
                        for k, (doc_id, has_id, begins, n) in enumerate(entries.tolist()):
                            # the last share of a full block may go on in the next one
                            closed = begins and (k < len(entries) - 1 or tokens < BLOCK)
                            rows.append((parts[i], doc + k, numbers[i], doc_id if has_id else None, token + pos, n, bool(closed),
                                         zlib.crc32(raw[4 * pos:4 * (pos + n)])))
                            pos += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()))], names=schema.names)
    return spark.read.schema(BLOCKS).parquet(path).select("part", "block_no", "block").mapInArrow(run, schema)


def chained_crc(shares: pa.Array) -> list[int]:
    """crc32 of documents from lists of their shares (block, tokens, crc32), in order of the blocks."""
    out = []
    for row in shares.to_pylist():
        crc = 0
        for s in sorted(row, key=lambda s: s["block_no"]):
            zeros = bytes(4 * s["n"])
            crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ s["crc"]      # crc32 is affine in its input
        out.append(crc)
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shares = written(read_fragments(spark, path), "shares")       # blocks are decoded once, though read for both kinds
    single = shares.where("whole").select("part", "doc_id", "begin", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    cut = (shares.where("not whole").groupBy("part", "doc_no")
           .agg(F.min("doc_id").alias("doc_id"), F.min("begin").alias("begin"), F.sum("n").alias("n_tokens"),
                F.collect_list(F.struct("block_no", "n", "crc")).alias("shares")))      # a document's own blocks

    schema = T.StructType([*cut.drop("shares", "doc_no").schema, T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(chained_crc(b.columns[-1]), pa.int64())], names=schema.names)
    rows = single.union(cut.select("part", "doc_id", "begin", "n_tokens", "shares").mapInArrow(run, schema))
    # one row a part, as many as write tasks
    sums = spark.read.schema(BLOCKS).parquet(path).groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("part").alias("of"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(sums), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
