import os
import subprocess
import sys

import cases
from pyspark.sql import functions as F

ROOT = __file__.rsplit("/", 3)[0]
sys.path.insert(0, ROOT)
import corpus_pipeline  # noqa: E402

from bayline.llm import near_dups, quality, secrets  # noqa: E402
from bayline.llm.common import stage, table  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    at = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        at[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = at["quality_classifier"]
    judged = labels.join(good, "doc_id", "left_semi").groupBy("quality").count().collect()
    judged = {r.quality: r["count"] for r in judged}
    every = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert judged[1] > 0.99 * every[1] and judged.get(0, 0) < 0.1 * every[0]
    unique = at["near_dedup"]
    assert near_dups.components(unique).where("not kept").isEmpty() and unique.count() < good.count()
    assert unique.count() == near_dups.components(good).where("kept").count()
    masked = at["secret_scan"]
    assert masked.count() == unique.count()
    assert secrets.scan(masked, [0.0] * 128 * 128).where("n_assign + n_access + n_hex > 0").isEmpty()
    assert masked.where("text LIKE '%[SECRET]%' AND length(text) <> n_chars").isEmpty()
    mix = at["source_mixing"]
    copies = mix.groupBy("doc_id").count().agg(F.count("*"), F.max("count")).first()
    assert copies[0] == masked.count() and copies[1] <= 2
    packed = at["best_fit_packing"]
    assert packed.select("doc_id").distinct().count() == masked.count()


def test_run_is_the_chain_of_stages(spark):
    sf = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, sf)
    assert packed.columns[:4] == ["doc_id", "piece", "start", "length"] and packed.count() > 0
    assert quality.fit(table(spark, sf, "documents"), table(spark, sf, "labels")).weights.any()


def test_stages_take_odd_rows_and_empty_tables(spark):
    for docs in (cases.frame(spark), cases.empty(spark)):
        for name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, SF), name)
        assert "sequence_id" in docs.columns


def test_the_rest_imports_without_the_package(tmp_path):
    """The entry module in a copy of the repository that lacks the llm folder and the pipeline."""
    for name in ("__spark_entry__.py", "bayline"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name) if name.endswith(".py") else os.mkdir(tmp_path / name)
    for name in os.listdir(f"{ROOT}/bayline"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/bayline/{name}", tmp_path / "bayline" / name)
    entry = tmp_path / "entry.py"
    entry.write_text((tmp_path / "__spark_entry__.py").read_text())
    said = subprocess.run([sys.executable, "-c", (
        "import entry as e; q = e.queries(); assert 'etl_audit' in q and 'pipeline' not in q;"
        "assert not any(k.startswith('op') and '_' in k and k[2].isdigit() for k in q); assert e.oracle_sql()")],
        cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
