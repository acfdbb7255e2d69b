"""Toxicity by compression distance: zstandard with an ordinary dictionary against one that also knows toxic text.

The ordinary dictionary is a body of ordinary labelled text. The toxic dictionary is trained on toxic labelled text:
the words whose beginnings stand out there against the ordinary documents (by a chi score of document counts, so
that stems with changing endings count as well as whole words), behind the same ordinary body. A window of words
that the toxic dictionary compresses shorter holds something that toxic text says and ordinary text doesn't;
everything else costs the same under both. The differences of a document's windows become a few figures
(how many windows pass each threshold, and by how much), and a logistic fit turns them into a score. To calibrate the
fit, each half of the training rows is measured with dictionaries trained on the other half.

The model is fitted on a bounded sample (``SAMPLE`` rows of each class, chosen by hash among all lengths, and of those as
many as fit into ``SAMPLE_BYTES``) of the labelled rows outside the held-out fold; the share of toxic rows is that of all
of them, and every document is scored, whole.

Cases: null and empty texts are scored as texts without windows; a doc_id that is labelled twice counts as toxic if one
label says so; without labelled rows of both classes every score is the share of toxic rows; repeated rows are
scored each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import table

SAMPLE = 3000
#: Bytes of the sample of one class; a picked text that would go beyond is left out.
SAMPLE_BYTES = 24 << 20
WINDOW = 8
LEVEL = 13
MIN_MATCH = 6
ORDINARY_BYTES = 400_000
TOXIC_WORDS = 1500
MIN_CHI = 6.0
#: Toxic documents that a beginning has to occur in.
MIN_DOCS = 3
MIN_LOG_ODDS = 1.2
EDGE = ".,!?;:|\"'()&%*-"
THRESHOLDS = (1, 2, 3, 4)


def cut(text: str, k: int = WINDOW) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The lower-cased words of a text joined by blanks, and where its windows of ``k`` words begin and end."""
    found = text.lower().encode().split()
    joined = b" " + b" ".join(found) + b" "
    after = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)  # the blank behind each word
    starts = np.concatenate([[0], after])[:len(found):k]
    return joined, starts, np.append(starts[1:], after[-1:]) + 1


def windows(text: str, k: int = WINDOW) -> list[bytes]:
    joined, starts, ends = cut(text, k)
    return [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _grams(data: bytes) -> np.ndarray:
    """A 22-bit hash of the ``MIN_MATCH`` bytes at each place; fewer bytes than that have none."""
    x = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(len(x) - MIN_MATCH + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(MIN_MATCH):
        out = (out << np.uint64(8)) | x[j:n + j]
    return (out * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)


def _codec(body: bytes) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_content_size=False,
                                                            write_checksum=False, write_dict_id=False)
    primed.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=primed)


@dataclass
class Dictionaries:
    """Bodies of the ordinary dictionary and of what the toxic one has more."""

    ordinary: bytes
    toxic: bytes

    def open(self) -> Dictionaries:
        self.plain = _codec(self.ordinary)
        self.both = _codec(self.ordinary + self.toxic)
        self.known = np.zeros(1 << 22, bool)
        self.known[_grams(self.toxic)] = True
        return self

    def figures(self, text: str | None) -> list[float]:
        """What the differences of the windows' compressed lengths say about a document. A window that shares no
        ``MIN_MATCH`` bytes with the toxic body can't be matched there: its difference is 0 without compressing."""
        joined, starts, ends = cut(text or "")
        if not len(starts) or not self.toxic:
            return [0.0] * (len(THRESHOLDS) + 3)
        at = np.flatnonzero(self.known[_grams(joined)])
        window = np.searchsorted(starts, at, "right") - 1
        d = np.zeros(len(starts))
        for w in np.unique(window[at + MIN_MATCH <= ends[window]]).tolist():
            part = joined[starts[w]:ends[w]]
            d[w] = len(self.plain.compress(part)) - len(self.both.compress(part))
        scale = math.sqrt(len(d) + 8)
        return [d.mean(), d.max(), np.maximum(d - 1, 0).sum() / scale,
                *((d >= t).sum() / scale for t in THRESHOLDS)]


def _vocabulary(text: str) -> set[str]:
    return {w.strip(EDGE) for w in text.lower().split()}


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(3, min(len(word), 12) + 1) if len(word[:n].encode()) >= 4]


def train_dictionaries(rows: list[tuple[str, int]]) -> Dictionaries:
    """From (text, toxic) rows."""
    docs = Counter(toxic for _, toxic in rows)
    bad: Counter = Counter()
    for text, toxic in rows:
        if toxic:
            bad.update({b for w in _vocabulary(text) for b in _beginnings(w)})
    bad = Counter({unit: n for unit, n in bad.items() if n >= MIN_DOCS})
    good: Counter = Counter()
    ordinary, kept = [], 0
    for text, toxic in reversed(rows):
        if not toxic:  # only what toxic text says too is counted: memory follows the toxic rows
            good.update({b for w in _vocabulary(text) for b in _beginnings(w) if b in bad})
            if kept < ORDINARY_BYTES:
                ordinary.append(b"".join(windows(text)))
                kept += len(ordinary[-1])
    chi = {}
    for unit, a in bad.items():
        b = good[unit]
        rate = (a + b) / (docs[0] + docs[1])
        score = (a - rate * docs[1]) / math.sqrt(rate * docs[1] * (1 - rate) + 0.1)
        odds = math.log((a + 0.5) / (docs[1] + 1)) - math.log((b + 0.5) / (docs[0] + 1))
        if score >= MIN_CHI and odds >= MIN_LOG_ODDS:
            chi[unit] = score
    weight: Counter = Counter()
    for text, toxic in rows:
        if toxic:
            for w in _vocabulary(text):
                best = max((chi.get(b, 0.0) for b in _beginnings(w)), default=0.0)
                if best:
                    weight[w] += best
    chosen = sorted(weight, key=lambda w: (weight[w], w))[-TOXIC_WORDS:]  # the strongest come last: near offsets
    return Dictionaries(b"".join(reversed(ordinary))[-ORDINARY_BYTES:], (" " + " ".join(chosen) + " ").encode() if chosen else b"")


@dataclass
class Model:
    """Dictionaries and a logistic fit on their figures; ``weights`` is None without two classes."""

    dictionaries: Dictionaries
    mean: np.ndarray | None
    spread: np.ndarray | None
    weights: np.ndarray | None
    share: float

    def score(self, figures: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(figures), self.share)
        x = np.c_[(figures - self.mean) / self.spread, np.ones(len(figures))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(rows: list[tuple[str, int]], share: float | None = None) -> Model:
    """Fit on (text, toxic) rows. ``share`` is that of toxic rows among all labelled ones, where the rows hold
    another share of them."""
    y = np.array([t for _, t in rows], float)
    if share is None:
        share = float(y.mean()) if len(y) else 0.0
    if not 4 <= y.sum() <= len(y) - 4:
        return Model(Dictionaries(b"", b""), None, None, None, share)
    half = np.arange(len(rows)) % 2
    figures = np.zeros((len(rows), len(THRESHOLDS) + 3))
    for k in (0, 1):
        other = train_dictionaries([r for r, h in zip(rows, half, strict=True) if h != k]).open()
        figures[half == k] = [other.figures(r[0]) for r, h in zip(rows, half, strict=True) if h == k]
    mean, spread = figures.mean(0), figures.std(0) + 1e-9
    x = np.c_[(figures - mean) / spread, np.ones(len(y))]
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + 0.5 * w)
    if 0 < share < 1:
        w[-1] += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    return Model(train_dictionaries(rows), mean, spread, w, share)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, n: int = SAMPLE) -> tuple[list[tuple[str, int]], float]:
    """At most ``n`` rows of each class outside the held-out fold, chosen by hash of the id; and the share of
    toxic rows among all that could have been chosen."""
    truth = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    key = F.xxhash64("doc_id")
    ids = d.select("doc_id", F.octet_length("text").alias("bytes")).join(truth, d.doc_id == truth.id)
    ids = ids.groupBy("doc_id", "toxic").agg(F.max("bytes").alias("bytes"))
    n_all, n_toxic = ids.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    picked = []
    for toxic in (0, 1):  # ids first: texts of the picked rows only are moved
        room = SAMPLE_BYTES
        for r in ids.filter(F.col("toxic") == toxic).orderBy(key, "doc_id").limit(n).collect():
            if r["bytes"] <= room:
                room -= r["bytes"]
                picked.append((r["doc_id"], toxic))
    picked = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int")
    chosen = d.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])  # 2 * n ids at most
    rows = chosen.select(key.alias("k"), "doc_id", "text", "toxic").collect()
    rows = [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: (r["k"], r["doc_id"]))]
    return rows, n_toxic / n_all if n_all else 0.0


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and the score of the text."""
    dictionaries = model.dictionaries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.weights is not None:
            dictionaries.open()
        for batch in batches:
            figures = np.zeros((batch.num_rows, 1))
            if model.weights is not None and batch.num_rows:
                texts = batch.column(batch.schema.get_field_index("text"))
                figures = np.array([dictionaries.figures(t.as_py()) for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(figures), pa.float64())],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_score(d, fit(*labelled_sample(docs, labels))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their columns."""
    model = fit(*labelled_sample(docs, labels))
    return with_score(docs, model, "_toxicity").filter("_toxicity < 0.5").drop("_toxicity")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document for toxicity."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
