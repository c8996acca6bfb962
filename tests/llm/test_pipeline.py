"""The pipeline against brute-force versions of its stages, and the entry without the subpackage."""

import importlib
import importlib.abc
import sys

import corpus_pipeline
from tests_llm_brute import bench_pairs, classes, deleted_lines, tokens
from vaultkit.llm import quality_rules as Q


def test_stages_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
                                                      "BPE encoding and decoding"]


def test_run_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in Q.judge(docs).where("q_kept").collect()}
    gone = deleted_lines(rows.items())
    left = {}
    for d, t in rows.items():
        kept = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ()))
        if d not in gone or kept.strip():
            left[d] = kept
    of = classes(left.items())
    left = {d: t for d, t in left.items() if of[d][0] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = bench_pairs(left.items(), items)
    left = {d: t for d, t in left.items() if d not in bad}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {d: tokens(t) for d, t in left.items()} and len(got) > 50


def test_stages_keep_the_columns_of_documents(spark, edge, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_entry_works_without_the_subpackage():
    class Gone(importlib.abc.MetaPathFinder):
        def find_spec(self, name, path=None, target=None):
            if name in ("corpus_pipeline", "vaultkit.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    hidden = {n: sys.modules.pop(n) for n in list(sys.modules) if n == "corpus_pipeline" or n.startswith("vaultkit.llm")}
    import vaultkit
    attribute = vaultkit.__dict__.pop("llm", None)
    sys.meta_path.insert(0, Gone())
    try:
        entry = importlib.import_module("__spark_entry__")
        assert "delta_classified" in entry.queries() and "pipeline" not in entry.queries()
        assert set(entry.oracle_sql()) <= set(entry.queries())
    finally:
        sys.meta_path.pop(0)
        sys.modules.update(hidden)
        if attribute is not None:
            vaultkit.llm = attribute
    assert "pipeline" in entry.queries() and "op3_jaccard_join" in entry.queries()


def test_nothing_else_imports_the_subpackage():
    import pathlib
    import re
    root = pathlib.Path(__file__).parents[2]
    for p in [*root.glob("*.py"), *root.glob("vaultkit/**/*.py"), *root.glob("tests/*.py"), *root.glob("tools/*.py")]:
        if "llm" not in p.parts and p.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"(import|from) .*\bllm\b|corpus_pipeline", p.read_text()), p
