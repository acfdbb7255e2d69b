"""Fill-in-middle transformation by displacement scatter.

A text is cut at two line ends into prefix, middle and suffix, and written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm). The bytes of all texts of a block lie in one buffer. One scan finds the line ends,
and with them the cuts; each segment then has one shift, the distance its bytes move. The shifts go into a difference
array at the segments' beginnings, whose cumulative sum is the shift of every byte, and one scatter writes the output
buffer; the marks are written into the gaps. ``restored`` works on output and form alone: it finds the marks in one
scan, and a second difference array tells for each byte of the text where to gather it.

Lines are ``[^\\n]*\\n|[^\\n]+``. The cuts come from sha256 of ``seed:doc_id`` and are computed by Spark. Texts that are
empty or hold a mark stay as they are (plain), so each output has one reading. The shifts are expanded for ``WINDOW``
bytes at a time and rows are worked on in blocks of about ``BLOCK`` bytes: memory is a few times a block, or a few
times the longest text.

Cases: a null text counts as empty (plain, the output is empty); a null doc_id as the empty number (``seed:``); repeated
rows give the same output each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import table

SEED = 7
#: Percent of texts that are transformed, and percent of those that are written as spm.
FIM_RATE = 100
SPM_RATE = 50
#: Marks of prefix, suffix and middle (fixed values); all are three bytes long.
MARKS = (b"<P>", b"<S>", b"<M>")
MARK = 3

BLOCK = 8 << 20
WINDOW = 1 << 20

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array; nulls are empty."""
    values = values.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], flat[at[0]:at[-1]]


def _blocks(batch: pa.RecordBatch, name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes (one text at least)."""
    at, _ = _buffers(batch.column(name))
    start = 0
    while start < len(batch):
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _strings(at: np.ndarray, flat: np.ndarray) -> pa.Array:
    """A string array of consecutive byte ranges."""
    whole = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat))
    return whole.cast(pa.string())


def _shifts(begin: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shift of every byte, window by window: cumulative sums of the difference array of segments that begin at the
    ascending ``begin`` (where several begin at one byte, the last counts)."""
    change = np.diff(shift, prepend=0)
    carry = 0
    for start in range(0, size, WINDOW):
        stop = min(start + WINDOW, size)
        low, high = np.searchsorted(begin, [start, stop])
        step = np.zeros(stop - start, np.int64)
        np.add.at(step, begin[low:high] - start, change[low:high])
        moved = np.cumsum(step) + carry
        carry = int(moved[-1])
        yield start, moved


def _marks_in(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, kind (index in ``MARKS``) and row of each mark that lies within one row."""
    if len(flat) < MARK:
        none = np.zeros(0, np.int64)
        return none, none, none
    pos = np.flatnonzero(flat[:-2] == MARKS[0][0])
    pos = pos[flat[pos + 2] == MARKS[0][2]]
    kind = np.full(len(pos), -1)
    for k, mark in enumerate(MARKS):
        kind[flat[pos + 1] == mark[1]] = k
    row = np.searchsorted(at, pos, "right") - 1
    good = (kind >= 0) & (pos + MARK <= at[row + 1])
    return pos[good], kind[good], row[good]


def _chars(flat: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Code points in the byte ranges between ascending cuts, window by window."""
    before = np.zeros(len(cuts), np.int64)
    seen = 0
    for start in range(0, len(flat), WINDOW):
        part = flat[start:start + WINDOW]
        count = np.cumsum((part & 0xC0) != 0x80)
        low, high = np.searchsorted(cuts, [start, start + len(part)])
        inside = cuts[low:high] - start
        before[low:high] = seen + np.where(inside > 0, count[inside - 1], 0)
        seen += int(count[-1])
    before[np.searchsorted(cuts, len(flat)):] = seen
    return np.diff(before)


def scatter(texts: pa.Array, h: list[np.ndarray], fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> dict:
    """Columns ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of a block of texts."""
    at, flat = _buffers(texts)
    rows, size = len(texts), len(flat)
    ends = np.flatnonzero(flat == 10) + 1  # a line ends behind its newline, and the last one at the text's end
    first = np.searchsorted(ends, at[:-1], "right")
    closed = np.searchsorted(ends, at[1:], "right") - first
    last = np.where(at[1:] > at[:-1], flat[np.maximum(at[1:], 1) - 1] if size else 0, 10)
    n = closed + (last != 10)

    def line_end(count):
        """Byte at which the first ``count`` lines of each row end."""
        inner = ends[np.minimum(first + count - 1, max(len(ends) - 1, 0))] if len(ends) else at[1:]
        return np.where(count <= 0, at[:-1], np.where(count <= closed, inner, at[1:]))

    one, two = h[0] % (n + 1), h[1] % (n + 1)
    cut1, cut2 = line_end(np.minimum(one, two)), line_end(np.maximum(one, two))
    plain = (at[1:] == at[:-1]) | (h[2] % 100 >= fim_rate)
    plain[np.unique(_marks_in(flat, at)[2])] = True
    spm = ~plain & (h[3] % 100 < spm_rate)

    prefix, middle, suffix = cut1 - at[:-1], cut2 - cut1, at[1:] - cut2
    out_at = np.concatenate([[0], np.cumsum(np.diff(at) + np.where(plain, 0, 3 * MARK))])
    home = out_at[:-1]
    to_prefix = home + np.where(plain, 0, np.where(spm, 2 * MARK + suffix, MARK))
    to_middle = np.where(plain, to_prefix + prefix, home + 3 * MARK + prefix + suffix)
    to_suffix = np.where(plain, to_middle + middle, home + np.where(spm, MARK, 2 * MARK + prefix))

    begin = np.column_stack([at[:-1], cut1, cut2]).ravel()
    shift = np.column_stack([to_prefix, to_middle, to_suffix]).ravel() - begin
    out = np.empty(int(out_at[-1]), np.uint8)
    for start, moved in _shifts(begin, shift, size):
        out[np.arange(start, start + len(moved)) + moved] = flat[start:start + len(moved)]
    for mark, behind in zip(MARKS, (to_prefix, to_suffix, to_middle), strict=True):
        out[(behind[~plain, None] + np.arange(-MARK, 0))] = np.frombuffer(mark, np.uint8)

    chars = _chars(flat, np.append(begin, size)).reshape(rows, 3) if rows else np.zeros((0, 3), np.int64)
    return {"n": pa.array(n, pa.int64()),
            "form": pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
            "prefix_chars": pa.array(chars[:, 0], pa.int64(), mask=plain),
            "middle_chars": pa.array(chars[:, 1], pa.int64(), mask=plain),
            "output": _strings(out_at, out)}


def gather(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts behind a block of outputs, from output and form alone. An output without its three marks is an error."""
    at, flat = _buffers(outputs)
    form = np.array([f or "plain" for f in forms.to_pylist()], dtype=object)
    moved_rows = np.flatnonzero(form != "plain")
    pos, kind, row = _marks_in(flat, at)
    own = form[row] != "plain"
    pos, kind, row = pos[own], kind[own], row[own]
    marks = moved_rows[:, None] * len(MARKS) + np.arange(len(MARKS))
    if not np.array_equal(np.sort(row * len(MARKS) + kind), marks.ravel()):
        raise ValueError("an output of form psm or spm does not hold each mark once")
    where = np.zeros((len(form), len(MARKS)), np.int64)
    where[row, kind] = pos
    mark_p, mark_s, mark_m = where.T
    plain, spm = form == "plain", form == "spm"
    prefix_at = np.where(plain, at[:-1], mark_p + MARK)
    prefix = np.where(plain, np.diff(at), np.where(spm, mark_m, mark_s) - mark_p - MARK)
    middle = np.where(plain, 0, at[1:] - mark_m - MARK)
    suffix = np.where(plain, 0, np.where(spm, mark_p, mark_m) - mark_s - MARK)

    text_at = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    begin = np.column_stack([text_at[:-1], text_at[:-1] + prefix, text_at[:-1] + prefix + middle]).ravel()
    source = np.column_stack([prefix_at, np.where(plain, at[1:], mark_m + MARK),
                              np.where(plain, at[1:], mark_s + MARK)]).ravel()
    text = np.empty(int(text_at[-1]), np.uint8)
    for start, moved in _shifts(begin, source - begin, len(text)):
        text[start:start + len(moved)] = flat[np.arange(start, start + len(moved)) + moved]
    return _strings(text_at, text)


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output of every document."""
    doc_id = F.col("doc_id").cast("long")
    cut = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), *_draws(doc_id, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, "text", BLOCK):
                h = [block.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)]
                found = scatter(block.column("text"), h, fim_rate, spm_rate)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *found.values()], names=["doc_id", *found])

    return cut.mapInArrow(run, OUTPUT)


def restored(outputs: DataFrame) -> DataFrame:
    """All columns of ``outputs``, and ``restored``: the text rebuilt from ``output`` and ``form``."""
    names = outputs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, "output", BLOCK):
                text = gather(block.column("output"), block.column("form"))
                yield pa.RecordBatch.from_arrays([*block.columns, text], names=[*names, "restored"])

    return outputs.mapInArrow(run, T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed and restored, as digests."""
    whole = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return whole.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1,
             CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(lines[1:c1], '') AS p, array_to_string(lines[c1 + 1:c2], '') AS m,
             array_to_string(lines[c2 + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
