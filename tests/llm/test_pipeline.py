"""The pipeline against its stages in plain Python, and on edge documents."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
from conftest import TESTDATA
from edge_cases import edge_docs, edge_rows, no_docs  # noqa: F401
from test_native import plain_line_dedup
from test_simhash import plain_fingerprint, plain_groups

import __spark_entry__ as driver
from paygrain.llm import packing
from paygrain.llm.queries import QUERIES, TOKENIZER

SMALL = str(TESTDATA / "sf0.001")


def test_registered():
    assert set(QUERIES) <= set(driver.queries()) and "pipeline" in driver.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id for r in QUERIES["op2_quality_rules"](spark, SMALL).collect() if r.kept}
    deduplicated = {i: t for i, _, t in plain_line_dedup([(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept])}
    ids = sorted(deduplicated)
    groups = plain_groups([plain_fingerprint(deduplicated[i]) for i in ids])
    first = [i for i, g in zip(ids, groups, strict=True) if ids[g] == i]
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = [(i, deduplicated[i], None, source[i], None) for i in first]
    mixed = corpus_pipeline.source_mixing(spark, spark.createDataFrame(rows, docs.schema), SMALL)
    copies = Counter(r.doc_id for r in mixed.collect())
    encode = packing.encoder(TOKENIZER).encode_ordinary
    found = corpus_pipeline.run(spark, SMALL).collect()
    got = Counter((r.doc_id, i) for r in found for i in range(r.start, r.start + r.length))
    expected = Counter({(d, i): n for d, n in copies.items() for i in range(len(encode(deduplicated[d])) + 1)})
    assert got == expected
    ids_of = {d: np.array([*encode(deduplicated[d]), 0], dtype="<u4") for d in copies}
    assert all(r.ids == ids_of[r.doc_id][r.start : r.start + r.length].tobytes() for r in found)


def test_edge_documents_go_through(spark, edge_docs, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    edge_docs.select(*columns).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "empty"
    edge_docs.select(*columns).limit(0).write.parquet(str(empty / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
