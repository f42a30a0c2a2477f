"""The pipeline, stage by stage, against plain versions."""

import brute
import corpus_pipeline
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tallyhouse.llm import pii, quality_rules
from tallyhouse.session import write_through


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "personal_data", "mix", "tokenize"]
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        made = write_through(stage(spark, docs, "/root/testdata/sf0.001"))
        seen[name] = (docs.collect(), made.collect())
        assert made.columns == (columns if name != "tokenize" else [*columns, "piece_ids"])
        docs = made
    before, after = seen["quality"]
    judge = quality_rules.Judge(quality_rules.Bands())
    assert sorted(after) == sorted(r for r in before if judge(r["text"])[6])
    before, after = seen["near_dedup"]
    groups = brute.near_duplicates([(r["doc_id"], r["text"]) for r in before], 5)
    assert sorted(after) == sorted(r for r in before if groups[r["doc_id"]][1] == r["doc_id"])
    before, after = seen["personal_data"]
    assert len(after) == len(before) and not any(brute.personal_base(r["text"]) for r in after)
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(r["text"] == texts[r["doc_id"]] or pii.base_spans(texts[r["doc_id"]]) for r in after)
    before, after = seen["mix"]
    assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 2
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = seen["tokenize"]
    assert len(after) == len(before) and all(r["piece_ids"] == library.encode(r["text"]) for r in after)


def test_run(spark):
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert made.where(F.size("piece_ids") == 0).count() == 0 and made.count() > 100
