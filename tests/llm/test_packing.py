import zlib

import numpy as np
import pytest

from arbora.llm import packing, tokens

TEXTS = ["one two  three", None, "", " \n x", "end <|endoftext|> here", "tabs\t and\n lines \n\n done ", "a" * 5000, "été " * 3000, "word", "word", "x　 y"]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")


def test_chunk_ids_equal_the_library():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(path("byte_bpe_50k.json")), tokens.byte_bpe_50k()
    for t in [t for t in TEXTS if t is not None] + ["a   b", "x\n y", "x \ny", "it's we'll  I'd", " lead", "trail ", "trail\n", "1234 56,7.8 $$ ##"]:
        assert own.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_restore_every_document(spark):
    own = tokens.byte_bpe_50k()
    texts = TEXTS + [f"filler text number {i} " * (i % 400) for i in range(300)]
    got = [r.asDict() for r in packing.pack_documents(rows(spark, texts).coalesce(1), window=64).collect()]
    for doc, t in enumerate(texts):
        ids, at = np.append(own.ids(t or ""), np.uint32(1)), 0
        for p in sorted((p for p in got if p["doc_id"] == doc), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : at].astype("<u4").tobytes())
        assert at == len(ids)
    sequences = {}
    for p in got:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
    assert sum(sum(n for _, n in x) < 2048 for x in sequences.values()) <= 2


def test_no_documents(spark):
    assert packing.pack_documents(rows(spark, []) if False else spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_examples_keep_all_three_limits(spark):
    rng = np.random.default_rng(3)
    data = [(i, int(n), int(n * s)) for i, (n, s) in enumerate(zip(rng.integers(1, 300, 500), rng.random(500), strict=True))] + [(900, None, None)]
    limits = packing.Limits(1000, 8, 400)
    got = packing.pack_examples(spark.createDataFrame(data, "example_id long, tokens long, loss_tokens long").coalesce(1), limits).collect()
    assert sorted(r.example_id for r in got) == sorted(d[0] for d in data)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for g in by.values():
        assert sum(r.tokens for r in g) <= 1000 and len(g) <= 8 and sum(r.loss_tokens for r in g) <= 400
    assert len(by) <= 1.15 * max(sum(d[1] or 0 for d in data) / 1000, len(data) / 8, sum(d[2] or 0 for d in data) / 400) + 1


def test_an_example_over_the_limit_raises(spark):
    with pytest.raises(Exception, match="over the limits"):
        packing.pack_examples(spark.createDataFrame([(1, 50, 1)], "example_id long, tokens long, loss_tokens long"), packing.Limits(10, 5, 10)).collect()
