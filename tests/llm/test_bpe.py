import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.llm import bpe
from centrix.llm.catalog import tokenizer_path
from tests.llm.helpers import EDGE, documents, edge, empty

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.ByteBPE(f.read())


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    raw = np.array(ids, dtype="<u4").tobytes()
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_random_texts(library, own):
    rng = random.Random(3)
    texts = ["", "a" * 3000, "<|endoftext|>x<|endoftext|>", " \t\n  x\x1c\x85 y  ", "=-" * 2000, "'s 'S ''ll"]
    texts += ["".join(rng.choice("abetsi no'\n  1!-ßéñ日.<|👩") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(60)) for _ in range(60)]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(own.encode(t), dtype="<u4")
        assert ids.tolist() == e.ids
        assert own.decode(ids) == t


def test_memos_stay_bounded_and_exact(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_MEMO", 3)
    monkeypatch.setattr(bpe, "PAIR_MEMO", 5)
    own.pieces.clear()
    text = "some words and some more words and some other words again"
    for _ in range(3):
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.pieces) <= 3 and len(own.pieces.old) <= 3


def test_documents_and_edges(spark, library):
    for df, texts in ((edge(spark), [r[1] for r in EDGE]), (documents(spark), None)):
        texts = texts if texts is not None else [r.text for r in df.select("text").collect()]
        got = sorted(tuple(r[1:4]) for r in bpe.encode_decode(df, PATH, with_ids=False).collect())
        assert got == sorted(_expected(library, t) for t in texts)
    ids = bpe.encode_decode(edge(spark), PATH).where(F.col("doc_id") == 3).first()
    assert ids.decoded == EDGE[2][1] and ids.ids == library.encode(EDGE[2][1], add_special_tokens=False).ids
    assert bpe.encode_decode(empty(spark), PATH).count() == 0
