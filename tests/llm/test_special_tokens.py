"""Packing takes the tokenizer as its file has it: the strings of special tokens in a text are those tokens."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from loomgrain.llm import packing
from loomgrain.llm.queries import QUERIES, tokenizer_path

TEXTS = [
    "x <|endoftext|> y", "x<|endoftext|>y <|startoftext|>", "<|endoftext|><|endoftext|>", "don't<|endoftext|>'s stop.<|startoftext|>,", "plain words only", "<|ENDOFTEXT|> <|endoftext |>", "a\n<|endoftext|>\tÜber",
    "word<|endoftext|>" * 3000,
]


def as_loaded(texts):
    """Ids of each text with the end token, by the tokenizer as it is loaded."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], np.uint32) for text in texts]


def check(pieces, texts):
    wanted = as_loaded(texts)
    covered = {i: 0 for i in range(len(texts))}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        ids = wanted[r["doc_id"]]
        assert r["start"] == covered[r["doc_id"]] and r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        covered[r["doc_id"]] += r["length"]
    assert covered == {i: len(ids) for i, ids in enumerate(wanted)}


def test_ids_are_those_of_the_tokenizer():
    assert packing.Encoder(tokenizer_path()).encode(TEXTS[:1])[0].tolist() == [343, 49407, 344, 2]
    for found, wanted in zip(packing.Encoder(tokenizer_path()).encode(TEXTS), as_loaded(TEXTS)):
        assert found.tolist() == wanted.tolist()
    assert packing.Encoder(tokenizer_path(), plain_specials=True).encode(TEXTS[:1])[0].tolist() == [343, 27, 347, 40786, 4160, 91, 285, 344, 2]


def test_query_and_stage(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op10_packing"](spark, str(tmp_path)).collect(), TEXTS)
    check(dict(corpus_pipeline.STAGES)["packing"](spark, docs, str(tmp_path)).collect(), TEXTS)
