"""Ranked lexical search, term at a time with limited accumulators.

Terms are the runs of letters, digits and all beyond ASCII, with only A-Z lower-cased. N documents hold a term, L is the
number of all their terms, n that of one document, df the number of documents with a term, tf its occurrences in one.
A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's m is 10 + 90 n N div L, its score the sum of
w * (10**9 tf div (1000 tf + 8 m)) over the item's terms, once each, in integers.

Documents stay where they are; the items' terms go to them. A first pass counts N, L and the df of the items' terms. In
the second each task inverts its documents, block by block, and answers every item term at a time, rarest first: a
term's postings open accumulators as long as the bounds of this and the remaining terms (the largest part that any
document of the block gets from each) can still reach the kth best partial score; from then on new documents can't
enter, and the remaining terms only update the documents that have an accumulator, exactly. The kth best score counts the
best documents of the task's earlier blocks as well. Each task emits its best k for an item; the best k of these are
the answer, so the shuffle holds k rows for each item and task, whatever the corpus holds.

Items go to the tasks in blocks of at most ``BLOCK_TERMS`` pairs of item and term (a stated query set, in blocks, each
of a proven size); each further block reads the documents again. Whole texts are read; blocks of documents hold about
``BLOCK`` bytes of text, or one longer text.

Cases: null and empty texts hold no term and don't count in N; an item without terms, or whose terms are in no document,
has no rows; texts of one item_id (null included) are one item with the terms of all; each row is a document of its
own, and ranks stay unique among rows with one doc_id; a null doc_id comes last among equal scores; empty tables
give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus.llm.common import binary_column, table, written

TOP = 10
#: Scale of weights, of a term's part, and the share and weight of length (fixed values of the score).
WEIGHT_SCALE, PART_SCALE, TF_SCALE, M_SCALE, LENGTH_SHARE = 1000, 10**9, 1000, 8, 90

#: Pairs of item and term that go to the tasks at once (about 100 bytes each), and bytes of text in a block.
BLOCK_TERMS = 200_000
BLOCK = 16 << 20

#: Bytes to term bytes: all ASCII but letters and digits parts terms, A-Z is lower-cased.
FOLD = bytes(b if b > 0x7F or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() and b <= 0x7F
             else 0x20 for b in range(256))

LAST = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and each of its terms, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(i, t) for i, text in zip(ids, binary_column(batch, "text"), strict=True) for t in set(terms_of(text))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "term"])

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "item_id long, term binary").distinct()


def corpus_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """term, docs (that hold it), occurrences (of all terms); the null term stands for all documents with a term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = terms_of(text.as_buffer().to_pybytes() if text.is_valid else None)
                n_docs += bool(found)
                n_terms += len(found)
                df.update(known.value.intersection(found))
        yield pa.RecordBatch.from_arrays([pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()),
                                          pa.array([n_terms] + [0] * len(df), pa.int64())],
                                         names=["term", "docs", "occurrences"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, "term binary, docs long, occurrences long")
    return parts.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences"))


class Postings:
    """Inverted index of a block of documents, for the terms of a vocabulary: ascending documents of each term, and what
    the term adds to their scores."""

    def __init__(self, ids: list[int | None], texts: list[bytes | None], number: dict[bytes, int], weights: np.ndarray,
                 n_docs: int, n_terms: int):
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        doc, term, tf, m = [], [], [], []
        for k, text in enumerate(texts):
            found = terms_of(text)
            m.append(100 - LENGTH_SHARE + LENGTH_SHARE * len(found) * n_docs // max(n_terms, 1))
            held = Counter(filter(None, map(number.get, found)))
            doc += [k] * len(held)
            term += held.keys()
            tf += held.values()
        doc, term, tf = np.array(doc, np.int64), np.array(term, np.int64), np.array(tf, np.int64)
        order = np.argsort(term, kind="stable")
        self.doc, term, tf = doc[order], term[order], tf[order]
        m = np.array(m, np.int64)
        self.part = weights[term] * (PART_SCALE * tf // (TF_SCALE * tf + M_SCALE * m[self.doc]))
        self.at = np.searchsorted(term, np.arange(len(weights) + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.at[term], self.at[term + 1]
        return self.doc[low:high], self.part[low:high]


def best(found: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best of (score, doc_id): high scores first, then small ids."""
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def search(index: Postings, terms: list[int], earlier: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best (score, doc_id) of the index and of ``earlier`` (at most k, best first) for terms given rarest first."""
    postings = [p for p in map(index.of, terms) if len(p[0])]
    bounds = np.array([p[1].max() for p in postings], np.int64)
    remaining = bounds[::-1].cumsum()[::-1]
    before = np.array([s for s, _ in earlier], np.int64)
    acc = np.zeros(len(index.ids), np.int64)
    opened = np.zeros(0, np.int64)  # documents with an accumulator, ascending
    for t, (doc, part) in enumerate(postings):
        partial = np.concatenate([before, acc[opened]])
        kth = np.partition(partial, -k)[-k] if len(partial) >= k else 0
        if remaining[t] < kth:  # no new document can enter the best k: update those with an accumulator
            for doc, part in postings[t:]:
                slot = np.minimum(np.searchsorted(doc, opened), len(doc) - 1)
                acc[opened] += np.where(doc[slot] == opened, part[slot], 0)
            break
        acc[doc] += part
        opened = np.union1d(opened, doc)
    score = acc[opened]
    keep = opened[(score > 0) & (score >= (np.partition(score, -k)[-k] if len(score) > k else 0))]
    return best([*earlier, *zip(acc[keep].tolist(), index.ids[keep].tolist(), strict=True)], k)


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    """(doc ids, texts as bytes) of consecutive rows, about ``limit`` bytes of text a block."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc_id)
            texts.append(text.as_buffer().to_pybytes() if text.is_valid else None)
            size += len(texts[-1] or b"") + 100
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def block_search(docs: DataFrame, queries: dict[int, list[bytes]], k: int) -> DataFrame:
    """query, doc_id, score: the k best documents of each task for each query (number -> its terms)."""
    number = {t: j + 1 for j, t in enumerate(sorted({t for terms in queries.values() for t in terms}))}
    schema = "query long, doc_id long, score long"
    counts = {r["term"] if r["term"] is None else bytes(r["term"]): (r["docs"], r["occurrences"])
              for r in corpus_counts(docs, frozenset(number)).collect()}
    n_docs, n_terms = counts.get(None, (0, 0))
    weights = np.zeros(len(number) + 1, np.int64)
    df = np.zeros(len(number) + 1, np.int64)
    for term, j in number.items():
        df[j] = counts.get(term, (0, 0))[0]
        weights[j] = weight(n_docs, int(df[j]))
    rarest = {q: sorted((number[t] for t in terms), key=lambda j: (df[j], j)) for q, terms in queries.items()}
    shared = docs.sparkSession.sparkContext.broadcast((number, weights, rarest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, weights, rarest = shared.value
        found: dict[int, list] = {q: [] for q in rarest}
        for ids, texts in text_blocks(batches, BLOCK):
            index = Postings(ids, texts, number, weights, n_docs, n_terms)
            for q, terms in rarest.items():
                found[q] = search(index, terms, found[q], k)
        rows = [(q, None if i == LAST else i, s) for q, top in found.items() for s, i in top]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)],
                                         names=["query", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, with a score above 0."""
    spark = docs.sparkSession
    terms = item_terms(items).groupBy("item_id").agg(F.count(F.lit(1)).alias("size"), F.collect_set("term").alias("terms"))
    terms = written(terms, "ranked-items")
    found, queries, names, size = [], {}, {}, 0

    def flush():
        top = block_search(docs, queries, k)
        numbered = spark.createDataFrame(sorted(names.items()), "query long, item_id long")
        found.append(written(top.join(F.broadcast(numbered), "query").drop("query"), "ranked-top"))

    for row in terms.toLocalIterator():  # one block of items in the driver at a time
        if queries and size + row["size"] > block_terms:
            flush()
            queries, names, size = {}, {}, 0
        names[len(names)] = row["item_id"]
        queries[len(queries)] = [bytes(t) for t in row["terms"]]
        size += row["size"]
    if not queries:
        return spark.range(0).select(F.col("id").alias("item_id"), F.col("id").cast("int").alias("rank"),
                                     F.col("id").alias("doc_id"), F.col("id").alias("score"))
    flush()
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return whole.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN f USING (term), c GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""
