import base64
import hashlib
import random

import pytest

pt = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

from kinfold.llm import byte_bpe, token_count  # noqa: E402
from kinfold.llm.words import Memory, spaced_words  # noqa: E402

RANKS, JSON = pt.path("byte_bpe_50k.tiktoken"), pt.path("byte_bpe_50k.json")
ALPHABET = "  \n\t\r\x85  \x1c\0abcXYZéßñ'stllve0123456789.,!?--__éèê日本語🙂́<|endoftext|>abcdeéüß    ,."


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n):
    rng = random.Random(1)
    for i in range(n):
        text = "".join(rng.choice(ALPHABET if i % 4 else "abc -=*. \n") for _ in range(rng.randint(0, 40)))
        yield text.replace("X", "<|endoftext|>") if i % 7 == 0 else text


def test_encoding_equals_tiktoken_and_decodes_back(library):
    codec = byte_bpe.codec(RANKS)
    for text in texts(4_000):
        ids = codec.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        assert "".join(codec.decode_pieces(ids)) == text


def test_offsets_cover_the_text():
    codec = byte_bpe.codec(RANKS)
    for text in texts(300):
        ids, starts, ends = codec.encode_with_offsets(text)
        assert ids == codec.encode(text).tolist()
        for i, start, end in zip(ids, starts, ends):
            piece = codec.decode([i])
            assert piece in text[start:end].encode()


def test_split_character_comes_with_its_last_id():
    codec = byte_bpe.codec(RANKS)
    ids = codec.encode("🙂").tolist()
    assert len(ids) > 1 and codec.decode_pieces(ids) == [""] * (len(ids) - 1) + ["🙂"]
    assert codec.decode_pieces(ids[:-1])[-1] == "�"


def test_counts_equal_the_library():
    counter, whole = token_count.counter(JSON), tokenizers.Tokenizer.from_file(JSON)
    for text in texts(4_000):
        assert counter.count(text) == len(whole.encode(text, add_special_tokens=False).ids)


def test_lowest_rank_merges_first():
    merges = token_count.Merges([("b", "c"), ("a", "b"), ("ab", "c"), ("a", "a")])
    assert merges.symbols_left("abc") == 2  # a + bc
    assert merges.symbols_left("ab") == 1
    assert merges.symbols_left("aaaa") == 2
    assert merges.symbols_left("") == 0


def test_words_join_to_the_text_and_memory_is_bounded():
    for text in texts(500):
        assert "".join(spaced_words(text)) == text
    memory = Memory(len, most=10)
    for word in map(str, range(100)):
        assert memory[word] == len(word) and len(memory) <= 10


def test_documents(messy, no_docs, library):
    got = sorted(map(tuple, byte_bpe.digest_documents(messy, RANKS).collect()), key=str)
    want = []
    for row in messy.collect():
        ids = library.encode_ordinary(row.text or "")
        digests = (hashlib.sha256(" ".join(map(str, ids)).encode()), hashlib.sha256((row.text or "").encode()))
        want.append((row.doc_id, len(ids), *(digest.hexdigest() for digest in digests)))
    assert got == sorted(want, key=str)
    encoded = byte_bpe.encode_documents(messy, RANKS)
    back = {bytes(row.decoded) for row in byte_bpe.decode_documents(encoded, RANKS).collect()}
    assert back == {(row.text or "").encode() for row in messy.collect()}
    assert byte_bpe.digest_documents(no_docs, RANKS).collect() == []

    whole = tokenizers.Tokenizer.from_file(JSON)
    counted = sorted(map(tuple, token_count.count_tokens(messy, JSON).collect()), key=str)
    sizes = [(row.doc_id, row.text or "") for row in messy.collect()]
    lengths = [(i, len(text.encode()), len(whole.encode(text, add_special_tokens=False).ids)) for i, text in sizes]
    assert counted == sorted([(*row, row[2] > 1024) for row in lengths], key=str)
    assert token_count.count_tokens(no_docs, JSON).collect() == []


def test_other_kinds_of_tokenizer_are_refused():
    with pytest.raises(ValueError):
        token_count.TokenCounter(pt.path("word_bpe_49k.json"))
