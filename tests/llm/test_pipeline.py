"""The pipeline against its stages' brute-force rules, and the registry."""

import __spark_entry__ as E
import corpus_pipeline as cp
from layerkit.llm import packing
from layerkit.llm.common import stage
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import normal
from tests.llm.test_packing import check
from tests.llm.test_quality import brute as measured
from tests.llm.test_simhash_dedup import plain_fingerprint


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "private_values", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, step in cp.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns
        docs = stage(out, name)
        kept.append({r.doc_id: r for r in docs.collect()})
    quality, once, clean, private = kept
    # quality: nothing that fails the base rule stays
    for d in quality:
        n, _, _, _, again = measured(before[d].text)
        assert n >= 10 and 100 * again <= 20 * n
    # near duplicates: what stays is apart, what goes is near something
    fps = {d: plain_fingerprint(r.text) for d, r in quality.items()}
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3
    assert not any(near(a, b) for a in once for b in once if a < b)
    assert all(any(near(a, b) for b in quality if a != b) for a in quality.keys() - once.keys())
    # decontamination: no whole item of the benchmark is left, and only rows that hold one go
    items = [" ".join(normal(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda r: any(i in " ".join(normal(r.text)) for i in items)
    assert not any(map(holds, clean.values()))
    assert all(holds(once[d]) for d in once.keys() - clean.keys())
    # private values: every document stays
    assert private.keys() == clean.keys() and any(private[d].text != clean[d].text for d in clean)
    assert all(r.n_chars == len(r.text) for r in private.values())
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    check(last, {d: len(r.text.encode().split()) + 1 for d, r in private.items()}, max(packing.SIZES))
    ran = cp.run(spark, SF)
    assert sorted(map(tuple, ran.select("doc_id", "piece", "length").collect())) == sorted((r.doc_id, r.piece, r.length) for r in last)


def test_stages_take_odd_rows(spark, make, odd):
    docs = make(odd, clashing=True)
    for name, step in cp.STAGES:
        out = step(spark, docs, SF)
        assert name == "best_fit_packing" or out.columns == docs.columns
        docs = stage(out, name)
    empty = make([])
    for name, step in cp.STAGES:
        empty = step(spark, empty, SF)
        assert empty.count() == 0


def test_registry():
    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
