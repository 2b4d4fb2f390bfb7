import hashlib

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from docloom.llm import byte_bpe, quality  # noqa: E402

from .conftest import sentence  # noqa: E402
from .test_duplicates import brute_components, brute_hits, brute_lines  # noqa: E402


def test_stages_against_brute_force(spark, tmp_path):
    import tiktoken

    rows, labels = [], []
    for i in range(120):
        text = "\n".join(sentence(5000 + 10 * i + k, 15) for k in range(4))
        if i % 6 == 0:
            text = " ".join(f"{w}&&&" if k % 2 else f"{w}%%%" for k, w in enumerate(text.split()))
        rows.append((i, text))
        labels.append((i, int(i % 6 > 0)))
    rows += [(200, rows[1][1]), (201, rows[2][1] + "\n" + sentence(77, 40)), (202, None), (203, sentence(78, 60)), (204, sentence(78, 59)), (205, sentence(79, 30))]
    items = [(1, " ".join(sentence(79, 30).split()[5:17])), (2, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int").withColumn("toxic", F.lit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    marks = spark.read.parquet(str(tmp_path / "labels.parquet"))
    chosen = {r.doc_id for r in quality.resample(docs, quality.learn(docs, marks), keep=("doc_id",)).where("selected").collect()}
    assert sum(i % 6 > 0 for i in chosen if i < 120) >= 98 and sum(i % 6 == 0 for i in chosen if i < 120) <= 2
    left = [(i, t) for i, t in rows if i in chosen]
    kept = {int(i): t for i, _, n, t in brute_lines(left) if not n or t.strip()}
    component = {int(i): int(c) for i, _, c in brute_components(sorted(kept.items()))}
    kept = {i: t for i, t in kept.items() if component[i] == i}
    kept = {i: t for i, t in kept.items() if not brute_hits(t, items)[1]}
    assert set(out) == set(kept)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for i, t in kept.items():
        assert out[i].ids == encoding.encode_ordinary(t or "")
        assert out[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert out[i].n_chars == (None if t is None else len(t))


def test_stages_pass_columns_on(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "jaccard_join", "decontaminate", "byte_bpe"]
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path))
        assert made.columns == docs.columns and made.count() == 0


def test_stages_with_clashing_columns(spark, tmp_path):
    names = ["n_lines", "n_removed", "n_tokens", "ids", "ids_sha256", "id", "th", "text_", "key", "row", "component_id", "log_weight", "gone"]
    rows = [(i, sentence(i, 40) + "\nsame line of every text here") for i in range(20)] + [(20, None), (21, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in names})
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "tiny")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path)).collect()
        assert made and (name == "byte_bpe" or made[0].asDict().keys() == set(docs.columns))
        assert all(r["text_"] == "clash" for r in made)
