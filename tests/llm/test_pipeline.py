import glob
import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from revrank.llm.language_id import held_out, identify, train_filters
from revrank.llm.pii import base_spans
from revrank.session import checkpoint_folder
from tests.llm.test_mixing import targets
from tests.llm.test_near_dedup import brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_run_and_what_every_stage_did(spark, docs, corpus, tmp_path):
    secret = (400, "the of and to in is that it was with mail ann@x.org and call +49 30 1234567 for the rest of it", "en", "s1")
    rows = docs.unionByName(spark.createDataFrame([secret], docs.schema)).withColumn("n_chars", F.length("text"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()

    folder = max(glob.glob(f"{checkpoint_folder(spark).removeprefix('file:')}/pipeline-*"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "pii", "mix", "sentencepiece"]
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    assert all(after[n].columns == before.columns for n in names[:-1])
    got = {n: after[n].collect() for n in names}

    found = identify(before, train_filters(before.filter(~held_out()))).filter("lang_pred <> 'und' AND evidence >= 0.15")
    assert sorted(r["doc_id"] for r in got["language_id"]) == sorted(r["doc_id"] for r in found.collect())

    classes = brute([(r["doc_id"], r["text"]) for r in got["language_id"]], 5)
    assert sorted(r["doc_id"] for r in got["near_dedup"]) == sorted(i for i, (_, c) in classes.items() if i == c)

    assert sorted(r["doc_id"] for r in got["pii"]) == sorted(r["doc_id"] for r in got["near_dedup"])
    assert not any(base_spans(r["text"]) for r in got["pii"])
    old = {r["doc_id"]: r for r in got["near_dedup"]}
    assert {r["doc_id"] for r in got["pii"] if r["text"] != old[r["doc_id"]]["text"]} == {400}
    assert all(r["n_chars"] == len(r["text"]) for r in got["pii"])

    sizes, taken = Counter(), Counter()
    for r in got["pii"]:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in got["mix"]:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets(dict(sizes)).items())

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter((r["doc_id"], (*lib.encode(r["text"]), lib.eos_id())) for r in got["mix"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in result) == want
