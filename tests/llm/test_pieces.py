import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from rawline.llm import pieces
from rawline.llm.pieces import PieceModel, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return PieceModel(MODEL)


def library(own, text):
    return np.array(own.library.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()


PARTS = [" ", "  ", "a", "e", "th", "ing", "\n", "\t", "▁", "é", "日", "벨", "́", "12", "..", "==", "http", "\x00", "x" * 9, " " * 17, "<s>", "</s>", "<unk>", "<0x0A>", "ß", "😀", "ab" * 3, "　", "�"]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_encode_as_the_library_does(own, seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50)))
        assert own.encode(text) == library(own, text)


def test_glued_pieces_and_runs(own):
    rng = random.Random(9)
    names = list(own.score)
    texts = ["".join(rng.choice(names) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    texts += [" " * k + w for k in range(70) for w in ("", "lead", "\n")] + ["a" * 5000, "ab" * 4000, "=" * 999, " " * 5000]
    for text in texts:
        assert own.encode(text) == library(own, text)


def test_full_memos_start_anew(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 20)
    small = PieceModel(MODEL)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(30))
        assert small.encode(text) == library(small, text)
    assert len(small.memo) <= 20 and len(small.fits) <= 20


def test_pieces_by_backtracking_are_those_of_merging(own):
    """Without cuts and memos: a whole text by backtracking against plain merging."""
    rng = random.Random(2)
    for _ in range(400):
        text = "▁" + "".join(rng.choice("▁aehinorst.") for _ in range(rng.randint(1, 40)))
        assert own.pieces(text) == own.merge(text)


def test_rows(spark, own):
    data = [(1, "A cat"), (1, "A cat"), (None, "x é " * 3000), (2, None), (3, ""), (4, " lead\n")]
    df = spark.createDataFrame([(*r, "z") for r in data], "doc_id long, text string, ids string")
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in encode_decode(df, MODEL).collect()]
    ids = [library(own, t or "") for _, t in data]
    want = [(i, len(b) // 4, b, own.library.decode(np.frombuffer(b, "<u4").tolist())) for (i, _), b in zip(data, ids)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert encode_decode(df.limit(0), MODEL).count() == 0


def test_query_digests(spark, tmp_path):
    from rawline.llm.queries import op13_piece_round_trip

    spark.createDataFrame([(7, "héllo  wörld")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    row = op13_piece_round_trip(spark, str(tmp_path)).first()
    own = PieceModel(MODEL)
    ids = library(own, "héllo  wörld")
    assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256("héllo  wörld".encode()).hexdigest()


def test_other_kinds_of_files_are_refused(tmp_path):
    with pytest.raises(Exception):
        PieceModel(public_tokenizers.path("word_bpe_49k.json"))
