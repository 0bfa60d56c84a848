"""Encoding and decoding against the library."""

import hashlib
from struct import unpack

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import ODD_ROWS, documents, rng

from tierwork.llm import pieces
from tierwork.llm.queries import digests_of_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as file:
        return pieces.Pieces(file.read())


def agrees(ours, library, text):
    ids, decoded = ours.encode_and_decode(text)
    wanted = library.encode(text, add_bos=True, add_eos=True)
    assert list(unpack(f"<{len(ids) // 4}I", ids)) == wanted
    assert decoded == library.decode(wanted) == ours.decode(ids)


PARTS = ["", " ", "  ", "a", "e", "th", "The", "é", "\n", "\t", "▁", "日", "本", "🙂", "ﬁ", "0", "1", ".", "!!", "ing",
         "​", "\x00", "́", "ا", "Ж", "<s>", "##", "==", "--", "\r", "<0x41>", "　", "﻿"]


def test_random_texts(ours, library):
    r = rng(6)
    for _ in range(3_000):
        agrees(ours, library, "".join(r.choice(PARTS) for _ in range(r.randint(0, 30))))
    ranges = [(32, 126), (0x80, 0x24F), (0x400, 0x4FF), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (97, 122), (97, 122)]
    for _ in range(2_000):
        agrees(ours, library, "".join(chr(r.randint(*r.choice(ranges))) for _ in range(r.randint(1, 50))))


@pytest.mark.parametrize("unit", [" ", "a", "ab", "=", "the", "\n", "🙂", "x y "])
def test_long_runs(ours, library, unit):
    for n in (1, 2, 15, 16, 17, 31, 33, 64, 65, 100, 257, 3_001):
        agrees(ours, library, unit * n)
        agrees(ours, library, "x" + unit * n + "ا")


def test_every_piece(ours, library):
    for number in range(0, library.get_piece_size(), 7):
        piece = library.id_to_piece(number).replace("▁", " ")
        agrees(ours, library, piece)
        agrees(ours, library, f"a{piece}b {piece}")


def test_the_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, library)


def check(docs, library):
    wanted = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row["text"] or "", add_bos=True, add_eos=True)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        decoded = library.decode(ids).encode()
        wanted.append((row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    got = [tuple(r) for r in digests_of_pieces(docs, PATH).collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))


def test_odd_rows(spark, library):
    check(documents(spark, ODD_ROWS), library)
    check(documents(spark, []), library)


def test_memory_of_parts_is_bounded(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 20)
    with open(PATH, "rb") as file:
        ours = pieces.Pieces(file.read())
    r = rng(8)
    for _ in range(200):
        agrees(ours, library, " ".join(f"w{r.randrange(500)}" for _ in range(30)))
        assert len(ours.remembered.newer) <= 20 and len(ours.remembered.older) <= 20 and sum(map(len, ours._fits.values())) <= 20


def test_each_prefix_has_one_last_token(ours):
    """The claim the table rests on: of the pieces that end a prefix one fits the token before it."""
    r = rng(9)
    for _ in range(300):
        text = "▁" + "".join(r.choice("aeinorstthelingd") for _ in range(r.randint(1, 14)))
        found = ours.tokens(text)
        assert found == ours.merged(text)
        fitting = [
            t for t in ours.id_of if text.endswith(t) and len(t) < len(text)
            and ours.compatible(ours.tokens(text[: -len(t)])[-1], t)
        ]
        whole = [text] if ours.merged(text) == [text] else []
        assert len(fitting + whole) == 1
