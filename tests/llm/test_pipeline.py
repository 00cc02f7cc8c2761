"""The corpus pipeline against plain versions of its decisions."""

from collections import Counter

from pyspark.sql import functions as F

import brute  # beside this file
import corpus_pipeline
from catalograph.llm import mixing, quality, secrets, support
from catalograph.llm.queries import vocabulary
from catalograph.llm.pieces import tokenizer_of


def test_stages_act_on_what_the_one_before_kept(spark):
    support.ship(spark)
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mixture", "token_ids"]
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(support.written(stage(spark, steps[-1], folder), f"test-{name}"))
    assert all(s.columns == columns for s in steps[:5])
    texts = [{r["doc_id"]: r["text"] for r in s.select("doc_id", "text").collect()} for s in steps[:5]]

    kept = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    assert set(texts[1]) == kept and all(not brute.base_counts(t)[5] for t in texts[1].values())

    groups = brute.near_duplicates(list(texts[1].items()))
    assert set(texts[2]) == {i for i, (_, root) in groups.items() if i == root}

    found = secrets.scan(steps[2], secrets.labelled_findings(spark)).where("is_secret").collect()
    assert set(texts[3]) == set(texts[2])
    for r in found:
        assert r["candidate"] not in texts[3][r["doc_id"]]
    hit = {r["doc_id"] for r in found}
    assert all((texts[3][i] == t) == (i not in hit) for i, t in texts[2].items())

    copies = {r["doc_id"]: r["copies"] for r in mixing.document_rates(steps[3], labels).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in steps[4].select("doc_id").collect()) == Counter(copies)

    tokenizer = tokenizer_of(vocabulary("byte_bpe_multi_50k.tiktoken"))
    last = steps[5].select("doc_id", "text", "token_ids", "n_tokens", "round_trip").collect()
    assert len(last) == steps[4].count() and all(r["round_trip"] for r in last)
    for r in last[:50]:
        assert r["token_ids"] == tokenizer.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.where(F.col("n_tokens") > 0).count() > 0 and {"doc_id", "text", "token_ids"} <= set(out.columns)
