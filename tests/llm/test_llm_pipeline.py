"""The corpus pipeline, stage by stage, and the registration of its queries."""

from __future__ import annotations

import re

import corpus_pipeline
from ledgerwatch.llm import decontamination, exact_dedup, quality, simhash
from ledgerwatch.llm.common import read_table, staged

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        results.append(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "decontamination", "pieces"]
    assert all(r.columns == columns for r in results[:-1])
    kept = [{r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()} for df in results[:-1]]
    model = quality.fit(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    good = {r["doc_id"] for r in quality.scores(read_table(spark, SF, "documents"), model).filter("score >= 0.3").collect()}
    assert set(kept[0]) == good and 0 < len(good) < len(before)
    body = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len(kept[1]) == len({body(t) for t in kept[0].values()}) == len({body(t) for t in kept[1].values()})
    fps = {d: simhash.fingerprint((t or "").encode()) for d, t in kept[1].items()}
    parent = {d: d for d in fps}
    for a in sorted(fps):
        for b in sorted(fps):
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = a, b
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)
    assert set(kept[2]) == {d for d in parent if parent[d] == d}
    leaked = {r["doc_id"] for r in decontamination.leaks(results[2], read_table(spark, SF, "benchmark")).collect()}
    assert set(kept[3]) == set(kept[2]) - leaked
    last = results[-1].collect()
    assert {r["doc_id"] for r in last} == set(kept[3]) and all(r["round_trip"] for r in last)
    again = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"]: r["ids"] for r in again.collect()} == {r["doc_id"]: r["ids"] for r in last}


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert exact_dedup.WHITE == b" \t\n\x0b\x0c\r"
