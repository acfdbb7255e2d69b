"""Operators 11 (URL filters), 12 (ranked search) and 13 (fill-in-middle) against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from domus.llm import op11_urls, op12_ranked, op13_fim
from pyspark.sql import functions as F


# 11: URL filters
def brute_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_verdict(url, rules, default="allow"):
    host, path = brute_parts(url)
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    top = max(fit, default=(0, 0, None, default))
    return host, path, top[2], top[3]


def url_list():
    r = random.Random(5)
    hosts = ["net", "a.net", "www.example.net", "example.net", "EXAMPLE.Net", "b.example.com", "example.com", "x.org", "org",
             "anet", "xample.net", "example.net.", ".net", "a..net", "example.net:80", "é.net", "", "me@example.com"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/en/1/2", "/de/", "/de/x", "/fr/", "/fr/a", "/EN/", "//en/", "/en/é", "en/"]
    urls = [f"{s}://{h}{p}{q}" for s in ("http", "HTTPS") for h in hosts for p in paths
            for q in r.sample(["", "?a=/en/", "#x", "?a#b", "\n"], 2)]
    urls += [None, "", "no scheme", "://", "http:///en/", "a://b://c.net/", "http://net/\U0010ffffz", "http://net\n/x",
             "http://" + "a." * 3000 + "net/x", "http://" + "y" * 200_000 + ".net/en/", "http://net/" + "p" * 500_000]
    return urls


RULE_SETS = {
    "query": op11_urls.RULES,
    "none": (),
    "nested": (("block", "net", ""), ("allow", "net", "/en/"), ("block", "net", "/en/1"), ("allow", "example.net", ""),
               ("block", "example.net", "/en/1/"), ("allow", "com", "/d"), ("block", "example.com", "/"),
               ("allow", "com", "/de/"), ("block", "", ""), ("block", "ORG", "/fr/"), ("allow", "org", "/fr/a"),
               ("allow", "www.example.net", "/e"), ("block", "net", "/\U0010ffff")),
}


@pytest.mark.parametrize("name", RULE_SETS)
def test_verdicts(spark, name, monkeypatch):
    rules = RULE_SETS[name]
    rows = [(None if k % 9 == 0 else k // 2, u) for k, u in enumerate(url_list())]
    rows += [(7, "http://a.net/en/1")] * 500 + [(k, "http://www.example.net/en/1/2") for k in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    for extra in ("key", "host", "path", "bucket", "event", "top", "rule", "verdict", "times", "k"):
        df = df.withColumn(extra, F.lit("clash"))
    monkeypatch.setattr(op11_urls, "REPEAT", 60)
    got = op11_urls.judged(df, op11_urls.rule_table(spark, rules), sample=600, rows_per_bucket=40)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    lower = [(v, h.lower(), p) for v, h, p in rules]
    want = Counter((i, *brute_verdict(u, lower)) for i, u in rows)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_same_rules_twice_and_no_urls(spark):
    rules = op11_urls.rule_table(spark, (("allow", "a.b", "/"), ("block", "A.b", "/"), ("allow", "a.b", "/x")))
    urls = spark.createDataFrame([(1, "h://a.b/"), (2, "h://c.a.b/x"), (3, "h://b/")], "page_id long, url string")
    assert sorted(map(tuple, op11_urls.judged(urls, rules, default="block").select("page_id", "rule", "verdict").collect())) == [
        (1, "a.b/", "block"), (2, "a.b/x", "allow"), (3, None, "block")]
    assert op11_urls.judged(urls.limit(0), rules).collect() == []


def test_sweep_is_native(spark):
    df = op11_urls.op11_urls(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoopJoin"))


# 12: ranked search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranked(docs, items, k=10):
    held = [(d, brute_terms(t)) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    queries = {}
    for i, text in items:
        queries.setdefault(i, set()).update(brute_terms(text))
    out = []
    for i, terms in queries.items():
        scores = []
        for d, w in held:
            tf, m = Counter(w), 10 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms if t in tf)
            if s > 0:
                scores.append((-s, math.inf if d is None else d))
        out += [(i, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def test_ranked_equals_brute_force(spark, documents, document_list, monkeypatch):
    docs = [(d, t) for d, t, _ in document_list]
    some = [t for _, t in docs if t][::7]
    items = [(k, " ".join(t.split()[:40])) for k, t in enumerate(some)]
    items += [(900, None), (901, ""), (902, "... \x00 --"), (903, "noSuchTerm4711"), (None, "bara cese"), (None, "dinu x y"),
              (3, "foxo GUpu"), (3, "foxo GUpu"), (904, docs[10][1]), (905, "é ß ü Ü"), (906, "x" * 300_000 + " one")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("clash")).repartition(3)
    want = brute_ranked(docs, items)
    monkeypatch.setattr(op12_ranked, "BLOCK", 20_000)
    got = op12_ranked.ranked(documents, frame)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert Counter(tuple(r) for r in op12_ranked.ranked(documents.repartition(1), frame, block_terms=60).collect()) == want


def test_ranked_ties_and_repeats(spark):
    docs = [(k % 30, "Red  green-blue") for k in range(60)] + [(None, "red green blue")] * 3 + [(99, "yellow")] * 70
    items = [(1, "RED"), (2, "yellow red"), (3, "the")]
    got = op12_ranked.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                             spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_ranked(docs, items)


def test_ranked_of_nothing(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert op12_ranked.ranked(no_documents, items).collect() == []
    assert op12_ranked.ranked(documents, items.limit(0)).collect() == []


def test_accumulators_are_limited(monkeypatch):
    """Once the remaining bounds are below the kth partial score no document is let in, and the answer is still exact."""
    r = random.Random(3)
    texts = [" ".join(["common"] * r.randint(1, 3) + [f"rare{r.randint(0, 40)}" for _ in range(4)]).encode() for _ in range(3000)]
    number = {t: j + 1 for j, t in enumerate(sorted({t for x in texts for t in x.split()}))}
    df = Counter(t for x in texts for t in set(x.split()))
    weights = np.zeros(len(number) + 1, np.int64)
    for t, j in number.items():
        weights[j] = op12_ranked.weight(len(texts), df[t])
    index = op12_ranked.Postings(list(range(3000)), texts, number, weights, 3000, sum(len(x.split()) for x in texts))
    terms = sorted((number[t] for t in (b"rare1", b"rare2", b"rare3", b"common")), key=lambda j: df[sorted(number)[j - 1]])
    opened = []
    merge = np.union1d
    monkeypatch.setattr(np, "union1d", lambda a, b: opened.append(len(b)) or merge(a, b))
    got = op12_ranked.search(index, terms, [], 10)
    assert len(opened) < len(terms) and sum(opened) < 2000
    total = Counter()
    for t in terms:
        for d, p in zip(*index.of(t), strict=True):
            total[int(d)] += int(p)
    assert got == sorted(((s, d) for d, s in total.items()), key=lambda x: (-x[0], x[1]))[:10]


# 13: fill-in-middle
def brute_fim(doc_id, text, fim_rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_TEXTS = [None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "\na\n\nb\n", "é\nüü\n漢字\n\U0001f600", "<P>", "x<S>\ny", "a<M", "<M>\n" * 3,
             "ends with <\n>P>\n<P", "<\nS\n>", "<P\n>\n<S", "P>\n<", "a\r\nb\r\n", "\x00\n\x00", "line\n" * 70_000,
             "one long line " * 30_000, "<", ">\n" * 9, "S>a\nP>b\nM>c\n"]


def fim_rows():
    return [(None if k % 11 == 5 else k, t) for k, t in enumerate(FIM_TEXTS * 12)] + [(3, "a\nb\nc")] * 3


@pytest.mark.parametrize("block, window, rate", [(8 << 20, 1 << 20, (100, 50)), (40, 7, (100, 50)), (5000, 3, (60, 100)),
                                                 (1, 1, (0, 50))])
def test_fim_and_back(spark, monkeypatch, block, window, rate):
    rows = fim_rows() if window > 100 else [x for x in fim_rows() if len(x[1] or "") < 1000]
    monkeypatch.setattr(op13_fim, "BLOCK", block)
    monkeypatch.setattr(op13_fim, "WINDOW", window)
    h = [[], [], [], []]
    for d, _ in rows:
        digest = hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()
        for k in range(4):
            h[k].append(int(digest[8 * k:8 * k + 8], 16))
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows], pa.string()), *[pa.array(x, pa.int64()) for x in h]],
                                       names=["text", "h1", "h2", "h3", "h4"])
    got, back = [], []
    for part in op13_fim._blocks(batch, "text", block):
        out = op13_fim.scatter(part.column("text"), [part.column(f"h{k}").to_numpy() for k in range(1, 5)], *rate)
        got += list(zip(*[c.to_pylist() for c in out.values()], strict=True))
        back += op13_fim.gather(out["output"], out["form"]).to_pylist()
    assert got == [brute_fim(d, t, *rate) for d, t in rows]
    assert back == [t or "" for _, t in rows]


def test_fim_frame(spark):
    rows = fim_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for extra in ("n", "form", "output", "restored", "h1", "prefix_chars"):
        df = df.withColumn(extra, F.lit("clash"))
    whole = op13_fim.restored(op13_fim.fill_in_middle(df))
    assert Counter(tuple(r) for r in whole.collect()) == Counter((d, *brute_fim(d, t), t or "") for d, t in rows)
    assert op13_fim.restored(op13_fim.fill_in_middle(df.limit(0))).collect() == []


def test_fim_output_without_marks_is_an_error():
    with pytest.raises(ValueError):
        op13_fim.gather(pa.array(["<P>a<S>b"]), pa.array(["psm"]))
    with pytest.raises(ValueError):
        op13_fim.gather(pa.array(["<P>a<P>b<M>c"]), pa.array(["psm"]))
