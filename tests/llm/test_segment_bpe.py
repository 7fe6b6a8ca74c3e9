"""Segment-tree BPE against the tokenizers library."""

import hashlib
import json
import os

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from staylens.llm import segment_bpe as sb  # noqa: E402

TEXTS = [
    "", " \n\t", "One two, three!  don't I'LL 's'S it's'", "İstanbul ΣΑΣ ςσ ﬁ é é ́a",
    "no break b　c \x1cx \x85 ​﻿", "<|endoftext|>a<|startoftext|> <|endoftext|", "a<|endoftext|>́b <|EndOfText|>",
    "한국어 한 क्षि \U0001f600 ë́", "1²³½Ⅷ٣ 2024-12-01",
    "x" * 3000, "ab" * 1500, "Å Å ǅ ß ẞ", "Россия Ελλάδα naïve", "long " * 4000 + "end"]


@pytest.fixture(params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def spec(request):
    with open(public_tokenizers.path(request.param), encoding="utf-8") as f:
        return f.read()


def test_equals_library(spec):
    library = Tokenizer.from_str(spec)
    encoder, decoder = sb.Encoder(spec, cached=5), sb.Decoder(spec)    # caches turn at every call
    for batch in (TEXTS[:7], TEXTS[7:], TEXTS[:3], TEXTS):
        for t, ids in zip(batch, encoder([x.encode() for x in batch])):
            want = library.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == want, t[:40]
            assert decoder(ids) == library.decode(want, skip_special_tokens=False)


def test_merge_order():
    """Leftmost of the lowest rank first, also in rows of equal pairs."""
    model = {"type": "BPE", "vocab": {"a": 0, "b": 1, "aa": 2, "aab": 3, "ab": 4}, "merges": [["a", "a"], ["aa", "b"], ["a", "b"]]}
    merges = sb.Merges(model)
    library = Tokenizer.from_str(json.dumps({"version": "1.0", "model": {**model, "merges": ["a a", "aa b", "a b"]}}))
    pieces = ["a", "b", "aaa", "aaab", "ab", "abab", "aabaaab", "b" * 5, "a" * 33, "ca", "c"]
    for p, ids in zip(pieces, merges.encode(pieces)):
        assert [int.from_bytes(ids[k:k + 4], "little") for k in range(0, len(ids), 4)] == library.encode(p).ids, p


def test_refuses_other_rules(spec):
    rules = json.loads(spec)
    for change in ({"dropout": 0.1}, {"unk_token": "<unk>"}, {"byte_fallback": True}, {"type": "WordPiece"}):
        with pytest.raises(ValueError):
            sb.check(json.dumps({**rules, "model": {**rules["model"], **change}}))


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sb, "OUT_IDS", 50)
    monkeypatch.setattr(sb, "TEXT_BYTES", 100)
    rows = [(i, t, "x", 1) for i, t in enumerate([None, *TEXTS])]
    rows += [rows[3], (None, "text without an id", "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_str(spec)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    out = sb.op13_segment_bpe(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    both = sb.decode(sb.encode(df, spec), spec)
    assert sorted(both.columns) == ["decoded", "doc_id", "ids"] and both.count() == len(rows)
    assert sb.decode(sb.encode(df.where("false"), spec), spec).count() == 0
