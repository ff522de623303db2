"""The pipeline's stages: each one's rows against SQL or the library, on what the stage before it kept."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from clearledger.llm import toxicity
from clearledger.llm.common import fold, materialise
from clearledger.llm.queries import ORACLES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def answers(docs, name):
    """The rows of an operator's SQL over docs."""
    con = duckdb.connect()
    con.register("given", docs.toArrow())
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    return con.execute(ORACLES[name]).fetchdf()


def test_each_stage_keeps_what_its_rule_says(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(pipeline.STAGES)
    step = lambda name, given: materialise(stages[name](spark, given, sf_dir), "step")

    clean = step("toxicity", docs)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, labels, fold(F.col("doc_id"), 5) != 0, into="score").select("doc_id", "score").collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5} and clean.columns == docs.columns
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    gone = set(scores) - {r.doc_id for r in clean.select("doc_id").collect()}
    assert all(marked.get(i, 1) == 1 for i in gone)  # the smallest tables may teach too little for any to go; held-out tests of op4 cover that

    trimmed = step("line dedup", clean)
    lines = answers(clean, "op5_line_dedup")
    had = {r.doc_id: r.text for r in clean.collect()}
    want = {i: (t if d else had[i]) for i, d, t in zip(lines["doc_id"], lines["n_dropped"], lines["text"], strict=True) if not d or t.split()}
    want |= {i: t for i, t in had.items() if t is None}
    got = {r.doc_id: r.text for r in trimmed.collect()}
    assert got == want and got != had and all(r.n_chars == len(r.text) for r in trimmed.collect() if r.text is not None)

    single = step("MinHash near-dedup", trimmed)
    near = answers(trimmed, "op7_minhash")
    assert sorted(r.doc_id for r in single.collect()) == sorted(near[near["kept"]]["doc_id"]) and single.count() < trimmed.count()

    mixed = step("mixing sources to target weights", single)
    plan = answers(single, "op9_mixing")
    copies = {i: round(t / s) for i, t, s in zip(plan["doc_id"], plan["taken"], plan["size"], strict=True) if s and t}
    assert Counter(r.doc_id for r in mixed.where("text rlike '[^ \\t-\\r]'").collect()) == copies

    tokens = step("SentencePiece encoding and decoding", mixed)
    texts = {r.doc_id: r.text or "" for r in mixed.collect()}
    rows = tokens.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in mixed.collect())
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())


def test_stages_on_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "empty")
        assert docs.count() == 0


def test_stages_hold_few_texts_at_a_time(spark, sf_dir):
    """What a worker gets at once, and what a column of a reader holds, whatever the session had before: executors keep what one stage once took."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    arrow, column = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"

    def sizes(batches):
        for x in batches:
            yield pd.DataFrame({"n": [len(x)]})

    for name, stage in pipeline.STAGES:
        spark.conf.set(arrow, "10000")
        spark.conf.set(column, "4096")
        stage(spark, docs, sf_dir)
        most = spark.range(0, 3000, 1, 1).mapInPandas(sizes, "n long").agg(F.max("n")).first()[0]
        assert most <= (500 if "near-dedup" in name else 250) and int(spark.conf.get(column)) <= 512
    spark.conf.unset(arrow)
    spark.conf.unset(column)
