"""Operators 2, 5 and 9 against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from domus.llm import common, op2_substrings, op5_minhash, op9_decontamination


def tokens(text):
    return (text or "").encode().split()


def brute_repeats(rows, length=13):
    first = {}
    for d, t in rows:
        w = tokens(t)
        for k in range(len(w) - length + 1 if d is not None else 0):
            key = tuple(w[k:k + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = tokens(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1 if d is not None else 0):
            if first[tuple(w[k:k + length])] < d:
                gone[k:k + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substrings_match_brute_force(documents, document_list):
    got = op2_substrings.remove_repeats(documents).collect()
    assert Counter(map(tuple, got)) == brute_repeats([(d, t) for d, t, _ in document_list])


def test_substrings_by_shuffle(documents, document_list, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    got = op2_substrings.remove_repeats(documents).collect()
    assert Counter(map(tuple, got)) == brute_repeats([(d, t) for d, t, _ in document_list])


def test_every_run_holds_an_anchor():
    h = common.word_hashes(" ".join(f"w{k % 37}" for k in range(500)).encode())
    kept = set(op2_substrings.anchors(h).tolist())
    shingles = common.runs_of(h, op2_substrings.SEED)
    for k in range(len(h) - 12):
        assert kept & set(shingles[k:k + 14 - op2_substrings.SEED].tolist())


def shingles(text, width=5):
    w = tokens((text or "").encode().lower().decode())
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if None not in (d, e) and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(d), root(e)
                parent[max(x, y)] = min(x, y)
    return Counter((d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets)


def test_near_duplicates_match_brute_force(documents, document_list):
    got = op5_minhash.near_duplicates(documents).collect()
    assert Counter(map(tuple, got)) == brute_components([(d, t) for d, t, _ in document_list])


def test_crowded_regions_go_deeper(documents, document_list, monkeypatch):
    monkeypatch.setattr(op5_minhash, "CROWD", 16)
    monkeypatch.setattr(op5_minhash, "NEIGHBOURS", (2, 12))
    got = op5_minhash.near_duplicates(documents).collect()
    assert Counter(map(tuple, got)) == brute_components([(d, t) for d, t, _ in document_list])


def crowd_rows(n=420, pairs=60):
    """Filled-in templates, 0.80 to 0.84 alike, and some that are 0.85 or more like an earlier one."""
    r, rows = np.random.default_rng(5), []
    base = [f"w{k}" for k in range(404)]
    for d in range(n):
        own = base[:]
        own[-(36 + d % 4):] = [f"d{d}x{k}" for k in range(36 + d % 4)]
        rows.append((d, own))
    for d in range(pairs):
        own = rows[7 * d][1][:]
        own[:26] = [f"p{d}x{k}" for k in range(26)]
        rows.append((n + d, own))
    return [(int(k), " ".join(rows[k][1])) for k in r.permutation(len(rows))]


def test_pairs_in_a_crowd_below_the_threshold(spark, monkeypatch):
    rows = crowd_rows()
    want = brute_components(rows)
    assert sum(not kept for _, _, _, kept in want) == 60
    monkeypatch.setattr(op5_minhash, "CROWD", 32)
    got = op5_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == want


def test_pairs_that_no_tree_brings_together(spark, monkeypatch):
    """The exact pass alone: sets that stayed doubtful meet whatever their hashes and sketches say."""
    rows = crowd_rows(60, 8)
    monkeypatch.setattr(op5_minhash, "_neighbours", lambda *_: lambda batches: (b.select([]) for b in batches if False))
    got = op5_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == brute_components(rows)


def test_one_document_of_a_group_stays(documents, document_list):
    kept = op5_minhash.without_duplicates(documents)
    assert kept.columns == documents.columns
    ids = Counter(r[0] for r in kept.select("doc_id").collect())
    want = {d for d, _, _, k in brute_components([(d, t) for d, t, _ in document_list]) if k}
    assert set(ids) == want and all(n == 1 for d, n in ids.items() if d is not None) and ids[None] == 2


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 180)] + [(7, k) for k in range(8, 60)] + [(9, 300), (5, 5)]
    df = spark.createDataFrame(links, "x long, y long").repartition(7)
    got = dict(map(tuple, common.components(df).collect()))
    assert got == {k: 100 for k in range(101, 181)} | {k: 7 for k in (*range(8, 60), 300)} | {
        k: v for k, v in got.items() if k == v}
    assert common.components(df.limit(0)).collect() == []


def test_components_meet_across_flushes():
    """Links that come after the map of a task was emptied still lead to the same root."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(600_000)), pa.array(np.arange(600_000) + 1)], names=["a", "b"])
    out = list(common._local_stars([batch, batch.slice(0, 10)]))
    assert len(out) >= 1 and sum(b.num_rows for b in out) >= 600_000


def brute_leaks(rows, items, containment=0.8):
    out = {}
    for item, text in items:
        w = (text or "").lower().encode().split()
        width = min(5, len(w))
        own = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if w else set()
        for d, t in rows:
            v = (t or "").lower().encode().split()
            n = len(own & {tuple(v[k:k + width]) for k in range(len(v) - width + 1)}) if own else 0
            if own and n >= math.ceil(len(own) * containment):
                out[d, item] = max(out.get((d, item), ()), (n / len(own), len(own), n))
    return out


def test_leaks_match_brute_force(spark, documents, document_list):
    texts = defaultdict(str, {d: t for d, t, _ in document_list if d})
    items = [(1, texts[31]), (2, " ".join(texts[20].split()[777:790])), (3, "ONE two"), (4, None), (5, ""), (6, "one"),
             (7, texts[31] + " gone astray"), (8, " ".join(texts[31].split()[:10]) + " other words that are not there at all"),
             (9, "never seen words of any text"), (1, texts[31]), (10, "x y x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.containment, r.n_shingles, r.n_shared)
           for r in op9_decontamination.contaminated(documents, bench).collect()}
    assert got == brute_leaks([(d, t) for d, t, _ in document_list], items)
    kept = op9_decontamination.without_leaks(documents, bench)
    assert kept.columns == documents.columns
    leaked = {d for d, _ in got if d is not None}
    want = Counter(d for d, _, _ in document_list if d not in leaked)
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == want


@pytest.mark.parametrize("run", [op2_substrings.remove_repeats, op5_minhash.near_duplicates])
def test_empty_table(no_documents, run):
    assert run(no_documents).collect() == []


def test_leaks_of_empty_tables(spark, documents, no_documents):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert op9_decontamination.contaminated(no_documents, bench).collect() == []
    assert op9_decontamination.contaminated(documents, bench.limit(0)).collect() == []
