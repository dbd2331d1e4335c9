import hashlib

import public_tokenizers as P
import pytest

from tessera.llm import bpe
from tests.llm import awkward

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.mark.parametrize("text", [
    "", "a", " ", "word " * 40_000, ("x" * 50 + "\n") * 3_000, "a" * 200_000, "    don't I'll \x1c\x1d x" * 9_000,
    "日本語 " * 30_000, "!" * 90_000, ("ab" + " " * 5_000) * 5, ("ab" + "\n" * 5_000 + " c") * 5, "x" + "\t" * 5_000, "é" * 70_000 + "  1",
])
def test_cut_texts_give_the_ids_of_the_whole(text):
    enc = bpe.coder(PATH, PATTERN)
    assert bpe.encode_text(text, enc) == enc.encode_ordinary(text)
    assert enc.decode_bytes(bpe.encode_text(text, enc)) == text.encode()


def test_white_space_beyond_the_library():
    enc = bpe.coder(PATH, PATTERN)
    ids = bpe.encode_text("a" + " " * 1_000_000 + "b", enc)
    assert enc.decode_bytes(ids) == b"a" + b" " * 1_000_000 + b"b"
    assert ids[-1:] == enc.encode_ordinary(" b")


def test_awkward_rows_round_trip(spark):
    docs = awkward.frame(spark)
    out = bpe.decode(bpe.encode(docs.drop("bucket"), PATH, PATTERN), PATH, PATTERN)
    once = bpe.encode(docs.drop("bucket"), PATH, PATTERN, decoded="decoded")
    assert sorted(map(repr, once.collect())) == sorted(map(repr, out.select(once.columns).collect()))
    enc = bpe.coder(PATH, PATTERN)
    got = out.select("doc_id", "text", "ids", "decoded", bpe.ids_digest("ids").alias("d"), "size").collect()
    assert len(got) == docs.count()
    for r in got:
        ids = enc.encode_ordinary(r["text"] or "")
        assert r["ids"] == ids and bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["d"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.decode(bpe.encode(awkward.empty(spark), PATH, PATTERN), PATH, PATTERN).count() == 0
