"""Every stage against brute force on its own input, and the registered queries."""

from __future__ import annotations

import brute
import public_tokenizers
import sentencepiece

import corpus_pipeline
from staymart.llm.scratch import keep

SF_DIR = "/root/testdata/sf0.001"
NUMBERED = [(n, name) for n in range(1, 14) for name in corpus_pipeline.QUERIES if name.startswith(f"op{n}_")]


def test_registered():
    assert [n for n, _ in NUMBERED] == list(range(1, 14))
    assert set(corpus_pipeline.QUERIES) == {name for _, name in NUMBERED} | {"pipeline"}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = keep(stage(spark, docs, SF_DIR))
        rows = docs.collect()
        if name == "encoding":
            assert {r.doc_id for r in rows} == set(before)
            assert all(r.ids == [*library.encode(before[r.doc_id]), 2] for r in rows)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in rows}
        texts = list(before.items())
        if name == "quality":
            assert all(i in after for i, q in labels.items() if q == 1 and i in before)
            assert not any(i in after for i, q in labels.items() if q == 0)
        elif name == "line_dedup":
            gone = brute.repeated(texts)
            want = {}
            for i, text in texts:
                left = [x for k, x in enumerate(text.split("\n")) if k not in gone.get(i, [])]
                if i not in gone or any(brute.byte_words(x) for x in left):
                    want[i] = "\n".join(left)
            assert after == want and all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_dedup":
            assert set(after) == {i for i, (_, c) in brute.near_components(texts, 5).items() if i == c}
        elif name == "decontamination":
            assert set(after) == set(before) - {d for d, _ in brute.held_items(texts, items)}
