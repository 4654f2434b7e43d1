"""Fill-in-middle transformation by displacement scatter.

A batch of texts is one run of bytes.  Newlines are scanned once; two drawn cuts split each text into prefix, middle
and suffix.  A segment moves as a whole, so a difference array holds, at the first byte of each segment, by how much
its displacement differs from that of the segment before; its cumulative sum is every byte's output shift.  One numpy
scatter then builds all outputs of the batch.  To restore, the control strings are found in the outputs, the same
difference array is built from them, and the scatter is read backwards as a gather.  Displacements are expanded in
windows of ``WINDOW`` bytes, so beside texts and outputs the memory is fixed, however long a text is.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3                      # bytes of a control string
WINDOW = 1 << 20
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
LETTERS = np.frombuffer(b"PSM", np.uint8)


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first 8-digit groups of SHA-256 of ``seed:id`` (null id: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) in a row, and the n + 1 places where they begin and end."""
    texts = pa.concat_arrays([texts.fill_null("")])                  # compact, without an offset
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]


def strings(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """The inverse of :func:`text_bytes`."""
    return pa.Array.from_buffers(pa.large_utf8(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)]) \
        .cast(pa.string())


def marks(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control strings inside the texts: (text, first byte, letter)."""
    lt = np.flatnonzero(flat == ord("<"))
    lt = lt[lt + MARK <= len(flat)]
    if len(lt):
        lt = lt[(flat[lt + 2] == ord(">")) & np.isin(flat[lt + 1], LETTERS)]
    doc = np.searchsorted(at, lt, "right") - 1
    inside = lt + MARK <= at[doc + 1] if len(lt) else np.empty(0, bool)
    return doc[inside], lt[inside], flat[lt[inside] + 1] if len(lt) else lt[inside].astype(np.uint8)


def displaced(n: int, first: np.ndarray, shift: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """For windows of the places 0 to n - 1, each place plus its shift.  Segment i begins at ``first[i]`` (ascending,
    empty segments may share a place) and is moved by ``shift[i]``."""
    delta = np.diff(shift, prepend=0)
    moved = 0
    for a in range(0, n, WINDOW):
        b = min(n, a + WINDOW)
        i, j = np.searchsorted(first, (a, b))
        steps = np.zeros(b - a, np.int64)
        np.add.at(steps, first[i:j] - a, delta[i:j])                 # the difference array
        steps[0] += moved
        np.cumsum(steps, out=steps)
        moved = int(steps[-1])
        yield slice(a, b), steps + np.arange(a, b)


def segment_moves(cut: np.ndarray, out: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the three segments of every text begin in the input and by how much they move, and where its control
    strings stand in the output.  ``cut``: rows (start, prefix end, middle end, end); ``out``: output starts."""
    p, m, s = (cut[:, i + 1] - cut[:, i] for i in range(3))
    spm, plain = form == SPM, form == PLAIN
    mark_p = np.where(spm, out + MARK + s, out)
    mark_s = np.where(spm, out, out + MARK + p)
    mark_m = out + 2 * MARK + p + s
    at = np.stack([mark_p + MARK, mark_m + MARK, mark_s + MARK], 1)  # of prefix, middle, suffix
    shift = at - cut[:, :3]
    shift[plain] = (out - cut[:, 0])[plain, None]
    return cut[:, :3].ravel(), shift.ravel(), np.stack([mark_p, mark_s, mark_m], 1)[~plain]


def code_points(inner: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points in each stretch of bytes; ``inner`` holds the places of all continuation bytes."""
    return end - start - (np.searchsorted(inner, end) - np.searchsorted(inner, start))


def transform_batch(texts: pa.Array, h: np.ndarray, rate: int, spm: int) -> list:
    """n, form, prefix_chars, middle_chars and output of a batch; ``h`` holds four draws a text."""
    flat, at = text_bytes(texts)
    start, end = at[:-1], at[1:]
    after = np.flatnonzero(flat == ord("\n")) + 1                    # line ends
    lo, hi = np.searchsorted(after, start, "right"), np.searchsorted(after, end, "right")
    whole = hi - lo
    after = np.append(after, -1)
    n = whole + ((end > start) & (after[hi - 1] != end))             # the last line may lack its newline

    def place(k: np.ndarray) -> np.ndarray:
        """Byte at which the first k lines end."""
        return np.where(k == 0, start, np.where(k > whole, end, after[np.minimum(lo + k - 1, len(after) - 1)]))
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    cut = np.stack([start, place(np.minimum(a, b)), place(np.maximum(a, b)), end], 1)
    form = np.where(h[:, 3] % 100 < spm, SPM, PSM)
    form[(start == end) | (h[:, 2] % 100 >= rate)] = PLAIN
    form[marks(flat, at)[0]] = PLAIN
    size = end - start + np.where(form == PLAIN, 0, 3 * MARK)
    out_at = np.concatenate([[0], np.cumsum(size)])
    first, shift, mark = segment_moves(cut, out_at[:-1], form)
    out = np.empty(out_at[-1], np.uint8)
    for window, to in displaced(len(flat), first, shift):
        out[to] = flat[window]
    for i, control in enumerate((PREFIX, SUFFIX, MIDDLE)):
        for j in range(MARK):
            out[mark[:, i] + j] = control[j]
    plain = form == PLAIN
    inner = np.flatnonzero((flat & 0xC0) == 0x80)
    chars = [pa.array(code_points(inner, cut[:, i], cut[:, i + 1]), mask=plain) for i in (0, 1)]
    return [pa.array(n.astype(np.int64)), pa.array(np.array(FORMS, object)[form], pa.string()), *chars, strings(out, out_at)]


def restore_batch(outputs: pa.Array, forms: list[str | None]) -> pa.Array:
    """The texts of a batch from outputs and forms; what is no output of its form raises ``ValueError``."""
    flat, at = text_bytes(outputs)
    start, end = at[:-1], at[1:]
    form = np.array([FORMS.index(f or "plain") for f in forms], np.int64)
    doc, place, letter = marks(flat, at)
    mixed = form[doc] != PLAIN
    doc, place, letter = doc[mixed], place[mixed], letter[mixed]
    moved = np.flatnonzero(form != PLAIN)
    spm = form[moved] == SPM
    order = np.where(spm[:, None], np.frombuffer(b"SPM", np.uint8), np.frombuffer(b"PSM", np.uint8))
    if len(doc) != 3 * len(moved) or (doc.reshape(-1, 3) != moved[:, None]).any() or (letter.reshape(-1, 3) != order).any() \
            or (place[::3] != start[moved]).any():
        raise ValueError("not an output of the form given: three control strings in order are wanted")
    place = place.reshape(-1, 3)
    one, two, three = place[:, 1] - place[:, 0] - MARK, place[:, 2] - place[:, 1] - MARK, end[moved] - place[:, 2] - MARK
    p, s = np.where(spm, two, one), np.where(spm, one, two)
    size = end - start
    size[moved] -= 3 * MARK
    text_at = np.concatenate([[0], np.cumsum(size)])
    cut = np.repeat(text_at[:-1, None], 4, 1)
    cut[:, 3] = text_at[1:]
    cut[moved, 1] += p
    cut[moved, 2] += p + three
    first, shift, _ = segment_moves(cut, start, form)
    text = np.empty(text_at[-1], np.uint8)
    for window, source in displaced(len(text), first, shift):
        text[window] = flat[source]
    return strings(text, text_at)


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, output: str = "output",
                   seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """The columns ``keep`` (all by default), then n (lines of the text), form, prefix_chars, middle_chars, ``output``.

    Lines end behind their newline.  Of two drawn numbers of lines the smaller ends the prefix and the larger the
    middle.  ``rate`` per cent of the texts are transformed, of them ``spm`` per cent suffix first; the rest, empty and
    null texts and those that hold a control string stay as they are (form plain, a null text as an empty one).  Draws
    depend on seed and id alone, so repeated rows and equal ids cut alike, a null id draws as an empty one, and reruns
    agree.  An empty table gives no rows.  A kept column named like a result is replaced.
    """
    fields = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField(output, T.StringType())]
    new = [f.name.lower() for f in fields]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([*[df.schema[c] for c in keep], *fields])
    cols = [F.col(f"`{c}`") for c in keep]
    extra = [F.col(f"`{text}`").cast("string").alias("quarry text"),
             *[c.alias(f"quarry draw {i}") for i, c in enumerate(draws(F.col(f"`{doc_id}`"), seed))]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, len(keep)):
                h = np.stack([piece.column(len(keep) + 1 + i).to_numpy(zero_copy_only=False) for i in range(4)], 1)
                made = transform_batch(piece.column(len(keep)), h, rate, spm)
                yield pa.RecordBatch.from_arrays([*piece.columns[:len(keep)], *made], names=schema.names)
    return df.select(*cols, *extra).mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """All columns of ``df`` and the texts rebuilt from ``output`` and ``form`` alone; null output: empty, null form: plain.

    An output that is not of its form raises an error instead of a wrong text."""
    mark = free_name(df, "form_of")
    joined = df.withColumn(mark, F.col(f"`{form}`").cast("string"))
    keep = [c for c in df.columns if c.lower() != text.lower()]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(text, T.StringType())])
    cols = [F.col(f"`{c}`") for c in keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, len(keep)):
                made = restore_batch(piece.column(len(keep)), piece.column(len(keep) + 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*piece.columns[:len(keep)], made], names=schema.names)
    return joined.select(*cols, F.col(f"`{output}`").cast("string").alias("quarry text"), F.col(mark)).mapInArrow(run, schema)
