import os
import subprocess
import sys

import corpus_pipeline
from shapeloom.llm import lines, ngram_join, pieces, quality
from shapeloom.llm.common import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, FOLDER), "step")
        seen.append((name, before, after))
        before = after
    for _, _, after in seen[:-1]:
        assert after.columns == columns
    (_, raw, good), (_, _, thinned), (_, _, unique), (_, _, mixed), (_, _, encoded) = seen
    assert good.count() == quality.keep_good(raw).count() < raw.count()
    assert sorted(map(tuple, thinned.collect()), key=str) == sorted(map(tuple, lines.without_repeated_lines(good).collect()), key=str)
    classes = ngram_join.ngram_classes(thinned).collect()
    assert sorted(r.doc_id for r in unique.collect()) == sorted({r.class_id for r in classes})
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in unique.collect()}
    model, texts = pieces.load_model(), {r.doc_id: r.text for r in mixed.collect()}
    back = encoded.withColumn("back", pieces.decode("pieces", model)).collect()
    assert len(back) == mixed.count() and all(r.back == texts[r.doc_id] for r in back)


def test_the_rest_works_without_this_subpackage(tmp_path):
    """A copy without the text operators still imports and lists its other queries."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, check=True)
