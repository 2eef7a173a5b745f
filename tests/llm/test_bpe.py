import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimloom.llm.bpe import Codec, decode_documents, encode_documents, round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_documents_like_the_library(spark, small, edge, library):
    for docs in (small, edge):
        rows = decode_documents(encode_documents(docs, PATH), PATH).collect()
        want = []
        for r in docs.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text))
        got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        at_once = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in round_trip(docs, PATH).collect()]
        assert sorted(at_once, key=str) == sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in rows], key=str)


def test_hard_texts_like_the_library(library):
    codec = Codec(open(PATH, "rb").read())
    parts = [
        "a", "b", "the", "ing", "'s", "'T", "Σ", "ΑΣ", "é", "İ", "1", "23", "٣", "Ⅷ", "½", "!!", "...",
        "\t", "\n", " ", "\x1c", "\x85", " ", "​", " ", "<|endoftext|>", "<|startoftext|>", "<|END", "\U0001f600",
        "한국", "日本", "ß", "ﬁ", "\0", "_", "aaaaaaa", "zzz", "'LL", "'re", "ǅ", "ª", "ll", "re", "ous",
    ]
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = codec.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode_bytes(text), "<u4").tolist() == ids
        assert codec.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_words_of_few_letters_need_backtracking(library):
    codec = Codec(open(PATH, "rb").read())
    rng = random.Random(6)
    for _ in range(20_000):
        word = "".join(rng.choice("etaoinsrhl") for _ in range(rng.randint(1, 18)))
        assert codec.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Codec(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())


def test_pieces_between_spaces_are_independent(library):
    """Combining letters, special tokens and odd white space beside spaces and line ends."""
    codec = Codec(open(PATH, "rb").read())
    parts = [" ", "\n", "  ", "\r\n", "\t", "\u0301", "e\u0301", "\u0345", "\x1c", "\x85", "\u2028", "\xa0", "<|endoftext|>", "a", "\uac00", "\u11a8", "'s", "it's", "1,2"]
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(codec.encode_bytes(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_table(nothing):
    assert round_trip(nothing, PATH).count() == 0
    assert decode_documents(encode_documents(nothing, PATH), PATH).count() == 0
