"""Size of the Arrow batches that the near-duplicate stage of the pipeline passes to Python."""

import corpus_pipeline
from tradelens.llm import near_dedup


def test_near_duplicate_stage_passes_small_batches(spark, monkeypatch, tmp_path):
    rows, cut = [], near_dedup.slices
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, log = spark.conf.get(name), str(tmp_path / "rows")

    def logged(batches, n=2000):
        for batch in batches:
            with open(log, "a") as f:
                f.write(f"{batch.nbytes}\n")
            yield from cut([batch], n)

    monkeypatch.setattr(near_dedup, "slices", logged)
    docs = spark.range(2000).selectExpr("id as doc_id", "concat(repeat(concat('w', id, ' '), 20), repeat('x', 6000)) as text").coalesce(1)
    assert corpus_pipeline.near_dedup(spark, docs, "").count() == 2000
    rows = [int(x) for x in open(log)]
    assert spark.conf.get(name) == before and sum(rows) > 12_000_000 and max(rows) < 6_000_000
