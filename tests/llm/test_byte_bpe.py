import base64
import hashlib
import random

from cases import FOLDER, HARD, documents, duck, hard, nothing, rows_of, same  # noqa: F401
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe, workload

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COLUMNS = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
SIGNS = (
    ["'", "s", "t", "re", "ve", "ll", "d", "m", "v", "l", " ", "  ", "\n", "\t", " ", "　", "\x85", "\x1c", "1", "½", "²"]
    + ["a", "Z", "é", "漢", "😀", "!", "-", "_", "́", "ह", "ि", "<|endoftext|>", "\x00", "Ᲊ", "’s", "\U00010d4a"]
)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(PATH, byte_bpe.class_ranges())


def encoded(vocabulary, texts):
    out = []
    for _, data, offsets in byte_bpe.slices(pa.array(texts, pa.string())):
        ids, place, cuts = vocabulary.encoded(data, offsets)
        out += [(ids[a:b].tolist(), place[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def check(vocabulary, library, texts):
    for text, (ids, place) in zip(texts, encoded(vocabulary, texts), strict=True):
        assert ids == library.encode_ordinary(text), text[:80]
        sizes = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert place == np.cumsum([0, *sizes])[:-1].tolist()
        assert vocabulary.decoded(np.array(ids, np.int64)) == text.encode()


def plain(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        out.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def test_the_whole_table(spark, documents, library):
    same(rows_of(workload.op13_byte_bpe(spark, FOLDER), *COLUMNS), plain(library, documents))


def test_hard_rows(hard, nothing, library):
    tokens = byte_bpe.encoded(hard, PATH)
    same(rows_of(byte_bpe.digests(tokens, PATH), *COLUMNS), plain(library, HARD))
    same(rows_of(byte_bpe.decoded(tokens, PATH), "doc_id", "text"), [(d, t or "") for d, t in HARD])
    assert byte_bpe.digests(byte_bpe.encoded(nothing, PATH), PATH).collect() == []


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "one two", 5, "x", 7)], "doc_id long, text string, ids int, offsets string, n_tokens int")
    tokens = byte_bpe.encoded(docs, PATH)
    assert tokens.columns == ["doc_id", "n_tokens", "ids", "offsets"]
    row = tokens.first()
    assert row["n_tokens"] == 7 and row["offsets"] == [0, 3]


@pytest.mark.parametrize(("block", "stretch"), [(1 << 20, 512), (1000, 7), (3, 1)])
def test_random_texts(vocabulary, library, monkeypatch, block, stretch):
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    monkeypatch.setattr(byte_bpe, "STRETCH", stretch)
    rng = random.Random(block)
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(0, 40))) for _ in range(400 if block < 2000 else 8000)]
    check(vocabulary, library, [*texts, "", "'", "''", "'l", "'ll", " 'll", "x'", "x'r", " ", "\n ", "a \n b"])


def test_long_texts(vocabulary, library):
    rng = random.Random(1)
    texts = ["a" * 5000, " " * 3000, "\n" * 2000 + "x", "'s" * 3000, "漢字" * 3000, "".join(rng.choices(SIGNS, k=400_000))]
    check(vocabulary, library, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text(vocabulary, library, texts):
    check(vocabulary, library, texts)


def test_every_code_point_is_classed_as_the_library_does(vocabulary, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(vocabulary, library, ["".join(f"a{p}1{p}" for p in points[i : i + 5000]) for i in range(0, len(points), 5000)])


def test_short_and_long_words_merge_alike(vocabulary):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeélrst ", k=rng.randrange(1, 40))).encode() for _ in range(2000)]
    for word, ids in zip(words, vocabulary._merged(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == vocabulary._merged_long(word)


def test_words_come_back_from_the_older_half(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    small = byte_bpe.Vocabulary(PATH, byte_bpe.class_ranges())
    texts = [" ".join(f"word{i % k}" for i in range(30)) for k in (2, 3, 5, 11)] * 3
    check(small, library, texts)
    assert len(small.remembered) <= 3 + 11


def test_a_decoder_leaves_no_vocabulary_without_classes(library, monkeypatch):
    monkeypatch.setattr(byte_bpe.Vocabulary, "known", {})
    byte_bpe.Vocabulary.of(PATH, [])  # the same worker process decodes first
    check(byte_bpe.Vocabulary.of(PATH, byte_bpe.class_ranges()), library, ["two words, 12 signs"])


def test_merging_looks_up_two_pairs_per_merge(vocabulary, monkeypatch):
    asked, joined = [], byte_bpe.Vocabulary._joined
    monkeypatch.setattr(byte_bpe.Vocabulary, "_joined", lambda self, a, b: asked.append(np.size(a)) or joined(self, a, b))
    words = [b" queasmit", b"abcdefghijklmnop", b"x", "漢字漢字".encode()] * 50
    ids = vocabulary._merged(words)
    merges = sum(len(word) - len(found) // 4 for word, found in zip(words, ids, strict=True))
    assert 0 < sum(asked) <= 2 * merges


def test_entry_states_that_a_tail_leaves_open(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 64)
    for tail in (1, 2, 64):
        monkeypatch.setattr(byte_bpe, "TAIL", tail)
        check(vocabulary, library, ["'s" * 500, "a'll" * 300, " " * 400 + "x", "\n'" * 200, "x'" + "'t" * 333])


def test_bytes_of_many_ids(vocabulary, monkeypatch):
    ids = np.random.default_rng(3).integers(0, len(vocabulary.tokens), 5000)
    want = b"".join(vocabulary.tokens[i] for i in ids.tolist())
    for at_once in (7, 1 << 20):
        monkeypatch.setattr(byte_bpe, "AT_ONCE", at_once)
        assert vocabulary.decoded(ids) == want and vocabulary.decoded(ids[:0]) == b""
