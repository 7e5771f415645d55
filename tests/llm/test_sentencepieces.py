"""SentencePiece encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from slumptrace.llm.sentencepieces import (
    REMEMBERED, Encoder, MergeTable, decode, decode_ids, encode_documents, load_table, model_path,
)

TEXTS = ["", " ", "a", "  two  spaces ", "\x00a\tb\n", "a▁b", "▁", "</s><s><unk>", "💩é日本語", "\xa0　x", "0123456789", "ſK",
         " " * 9, " " * 33 + "x", "=" * 70, "-" * 7 + "abc", "A" * 100, "the the the", "x" * 65 + " " + "y" * 200, "é́"]


@pytest.fixture(scope="module")
def table():
    return load_table()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def ids_of(blob):
    return np.frombuffer(blob, "<u4").tolist()


def random_texts(library, seed, n):
    rnd = random.Random(seed)
    pieces = [library.id_to_piece(rnd.randint(259, 31_999)) for _ in range(2_000)]
    for _ in range(n):
        kind = rnd.randint(0, 4)
        if kind == 0:
            yield "".join(rnd.choice(" ab▁\n\t") for _ in range(rnd.randint(0, 80)))
        elif kind == 1:
            yield "".join(chr(rnd.choice([rnd.randint(0, 0x2FF), rnd.randint(0, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(30))
        elif kind == 2:
            yield " " * rnd.randint(0, 70) + "x" * rnd.randint(0, 40) + rnd.choice(["", " " * 30])
        elif kind == 3:
            yield "".join(rnd.choice("aeinorst=-*#") for _ in range(rnd.randint(0, 300)))
        else:
            yield "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60)))


def test_ids_are_those_of_the_library(table, library):
    texts = TEXTS + list(random_texts(library, 1, 3_000))
    theirs = library.encode(texts, add_bos=True, add_eos=True)
    assert [ids_of(b) for b in Encoder(table).encode(texts)] == theirs
    assert [decode(table, ids) for ids in theirs] == library.decode(theirs)


def test_any_ids_decode_as_in_the_library(table, library):
    rnd = random.Random(2)
    rows = [[rnd.choice([rnd.randint(0, 258), rnd.randint(0, 31_999)]) for _ in range(rnd.randint(0, 12))] for _ in range(4_000)]
    assert [decode(table, r) for r in rows] == [library.decode(r) for r in rows]


def test_long_words(table, library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("etaoinshrdlu") for _ in range(20_000)), " " * 5_000, "ab" * 50_000, "the quick" * 3_000]
    assert [ids_of(b) for b in Encoder(table).encode(texts)] == library.encode(texts, add_bos=True, add_eos=True)


def test_rounds_equal_single_merges():
    """Vocabularies in which a merge makes a better pair than the one merged, and ones with ties."""
    rnd = random.Random(4)
    for _ in range(150):
        words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(rnd.randint(1, 14))}
        pieces = [(c, 0.0, 1) for c in "abc"] + [(w, -float(rnd.randint(1, 6)), 1) for w in sorted(words)]
        table = MergeTable(pieces, -1, -1)
        texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 40))) for _ in range(20)]
        found = [ids_of(b) for b in table.encode_words(texts)]
        plain = [[s for _, s in table.one_by_one([table.letters[ord(c)].item() for c in t])] for t in texts]
        assert found == plain


def test_single_merges_against_plain_search():
    rnd = random.Random(5)
    for _ in range(100):
        words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(2, 4))) for _ in range(6)})
        score = {w: -float(rnd.randint(1, 4)) for w in words}
        table = MergeTable([("a", 0.0, 1), ("b", 0.0, 1), *[(w, score[w], 1) for w in words]], -1, -1)
        text = [rnd.choice("ab") for _ in range(rnd.randint(1, 25))]
        symbols = [0 if c == "a" else 1 for c in text]
        while True:
            pairs = [(-score[x + y], i) for i, (x, y) in enumerate(zip(text, text[1:], strict=False)) if x + y in score]
            if not pairs:
                break
            _, i = min(pairs)
            text[i:i + 2] = [text[i] + text[i + 1]]
        names = ["a", "b", *words]
        assert [names[s] for _, s in table.one_by_one(symbols)] == text


def test_memory_of_words_is_bounded(table, monkeypatch):
    monkeypatch.setattr("slumptrace.llm.sentencepieces.REMEMBERED", 50)
    encoder = Encoder(table)
    for k in range(20):
        list(encoder.encode([" ".join(f"w{k}x{j}" for j in range(30))]))
        assert len(encoder.known) <= 50 + 30
    assert REMEMBERED >= 50


def test_documents(documents, table, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (1, "Hello  world"), (None, "x\ny"), (4, "é▁💩 " * 3_000)]
    found = encode_documents(documents(*rows), table, with_ids=True, with_text=True)
    by_text = {}
    for r in found.collect():
        by_text.setdefault(r.decoded, []).append(r)
    assert found.count() == len(rows)
    for _, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        back = library.decode(ids)
        r = by_text[back][0]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert len(by_text["Hello  world"]) == 2 and len(by_text[""]) == 2
    assert sorted(r.text for r in decode_ids(found.select("doc_id", "ids"), table).collect()) == sorted(t for t, rs in by_text.items() for _ in rs)


def test_no_documents(documents):
    assert encode_documents(documents((1, "x")).limit(0)).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        load_table(str(tmp_path / "m"))
