"""The pipeline's rows against a plain version of every stage, on the given tables."""

import re

import corpus_pipeline
from eventide.llm import nbest, pieces, simhash
from tests.conftest import SF0001


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def windows(ws, n=10):
    return {tuple(ws[i : i + n]) for i in range(max(len(ws) - n, 0) + 1)} if ws else set()


def test_pipeline_against_plain_stages(spark):
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    docs = {r["doc_id"]: r["text"] for r in rows if any(c.isalpha() for c in r["text"] or "")}

    largest = {}
    for i, t in docs.items():
        largest[t] = max(i, largest.get(t, -1))
    docs = {i: t for t, i in largest.items()}

    prints = {i: simhash.fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    docs = {i: t for i, t in docs.items() if find(i) == i}

    items = [words(r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    leaked = set().union(*(windows(ws) for ws in items))
    sizes = {len(w) for w in leaked}
    docs = {i: t for i, t in docs.items() if not any(windows(words(t), n) & leaked for n in sizes)}

    lat = pieces.lattice(pieces.load())
    want = {i: [x for c in pieces.chunks(t) for x in nbest.best_and_gap(c, lat)[0]] for i, t in docs.items()}
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, SF0001).collect()}
    assert got == want
