import re

import corpus_pipeline as pipeline
from pyspark.sql import functions as F


def test_stages_and_queries(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "language id", "line dedup", "n-gram jaccard join", "best-fit packing"]


def test_pipeline_keeps_one_clean_copy(spark, tmp_path):
    text = lambda seed, n=80: "\n".join(" ".join(f"the {seed}word{i}x{j} and" for j in range(4)) for i in range(n // 12))
    clean = [(i, text(f"s{i}"), "en") for i in range(12)]
    near = text("near")
    rows = clean + [(20, near, "en"), (21, near, "en"), (22, near.replace("nearword0x0", "other"), "en"), (30, None, "en"), (31, "short text", "en"), (32, "again and again " * 40, "en"), (33, "1 2 3 4 " * 40, None)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, lang, "src", 0) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = sorted(r.doc_id for r in docs.collect())
    assert kept["quality rules"] == [*range(12), 20, 21, 22] == kept["language id"]
    assert kept["line dedup"] == [*range(12), 20]
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    out = pipeline.run(spark, folder)
    assert sorted({r.doc_id for r in out.collect()}) == kept["n-gram jaccard join"]
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
