import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aggrex.llm import bpe, token_files
from plain import crc_of_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _pairs(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_codec_equals_the_library_on_random_texts(library):
    random.seed(7)
    letters = list("aaabcdeéèüßñ 'stm\t\n<|>endoftext\x1c\x85\xa0漢字İΣσς0123½Ⅷ!!??̣́e\U0001F600नि\x00\x7f")
    letters += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "ΑΣ", "ﬁ", "Å"]
    codec = bpe.Codec(PATH)
    tokens = [t for t in codec.merges.vocab if t.isascii()]
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(random.choices(tokens, k=3)).replace("</w>", "") for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "." * 3000, ""]
    for i in range(0, len(texts), 500):
        part = texts[i:i + 500]
        for text, got in zip(part, codec.encode(part)):
            ids, decoded = _pairs(library, text)
            assert got == (ids, decoded.encode()), text


def test_unlike_pieces_with_equal_hashes(library):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2**64, whatever the odd base."""
    texts = []
    for k in (10, 11, 12):
        word = "".join("ab"[i.bit_count() & 1] for i in range(1 << k))
        texts += [word, word.translate({97: "b", 98: "a"}), f"x {word} y", f"{word.swapcase()} {word}"]
    texts += ["the cat, the cat", ""]
    texts += ["a a\0 a\0\0 \0 \0\0", "abcdefg abcdefg\0 abcdefgh abcdefgi abcdefghabcdefgh"]
    cutter = token_files.PieceEncoder(PATH)
    for text, got, ids in zip(texts, bpe.Codec(PATH).encode(texts), cutter.encode(texts)):
        want, decoded = _pairs(library, text)
        assert got == (want, decoded.encode()) and ids.astype("<u4").tobytes() == want


def test_encode_words_shares_prefixes_and_keeps_no_state(library):
    codec = bpe.Codec(PATH)
    words = {"thin", "think", "thinking", "thinks", "t", "thi"}
    got = bpe.encode_words(words, codec.merges)
    assert {w: library.encode(w, add_special_tokens=False).ids for w in words} == got
    assert bpe.encode_words({"think"}, codec.merges)["think"] == got["think"]
    assert bpe.encode_words(set(), codec.merges) == {}


@pytest.mark.parametrize("name", ["docs", "odd_docs", "no_docs"])
def test_bpe_rows(name, request, library):
    table = request.getfixturevalue(name)
    got = sorted(map(tuple, bpe.bpe_encode_decode(table, PATH).collect()), key=repr)
    want = []
    for r in table.select("doc_id", "text").collect():
        ids, text = _pairs(library, r.text)
        want.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_bpe_round_trip_of_kept_ids(docs, library):
    for r in bpe.bpe_encode_decode(docs.limit(20), PATH, keep_ids=True).collect():
        assert library.decode(list(r.ids), skip_special_tokens=False) == r.decoded


def test_segments_give_random_access():
    random.seed(1)
    for ids in ([random.choice([3, 255, 256, 65535, 65536, 1 << 24, 2 ** 32 - 1]) for _ in range(3000)],
                [2], [7] * 1024, [70_000] * 513, list(range(5000))):
        s = token_files.Segment(token_files.pack(ids))
        assert s.n == len(ids)
        assert all(s.token(i) == ids[i] for i in range(0, len(ids), 7))
        for a, b in ((0, len(ids)), (5, 5), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids))):
            assert s.tokens(a, b).tolist() == ids[a:b]
    with pytest.raises(ValueError):
        token_files.Segment(b"something else")


@pytest.mark.parametrize("name", ["docs", "odd_docs", "no_docs"])
def test_token_files(name, request, library, monkeypatch):
    monkeypatch.setattr(token_files, "PART_ROWS", 40 if name == "docs" else 3)  # several files
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 1000)  # several segments in one
    table = request.getfixturevalue(name)
    got = sorted(map(tuple, token_files.write_and_read_back(table, PATH).collect()),
                 key=lambda r: (r[1], r[2]))
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [2])
            for r in table.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes())
    want, start = [], 0
    for d, ids in sorted(rows, key=key):
        want.append((d, start, len(ids), crc_of_ids(ids)))
        start += len(ids)
    assert got == want


def test_one_id_in_most_rows_spreads_over_files(spark, library, monkeypatch, tmp_path):
    """Half the rows under one id, copies of one text among them, a third under NULL, and the least number as an id."""
    monkeypatch.setattr(token_files, "PART_ROWS", 30)
    least = -(1 << 63)
    rows = [(5, f"word {i} of a text") for i in range(200)] + [(5, "the same text")] * 200
    rows += [(None, f"no id {i}") for i in range(250)] + [(least, "least")] * 3 + [(i, f"text {i}") for i in range(147)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(table, path, PATH)
    files = token_files.read_token_files(spark, path).select("part", "start", "n_tokens", "doc_ids", "lengths").collect()
    assert max(sum(len(f.doc_ids) for f in files if f.part == p) for p in {f.part for f in files}) <= 4 * 30
    assert len({f.part for f in files if 5 in f.doc_ids}) >= 8 and len({f.part for f in files if None in f.doc_ids}) >= 4
    files.sort(key=lambda f: f.start)
    order = [d for f in files for d in f.doc_ids]
    assert order == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [f.start for f in files] == [sum(f.n_tokens for f in files[:i]) for i in range(len(files))]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32)
                 for r in token_files.document_digests(token_files.read_token_files(spark, path)).collect())
    coded = [(d, library.encode(t, add_special_tokens=False).ids + [2]) for d, t in rows]
    assert got == sorted((d is not None, d or 0, len(ids), crc_of_ids(ids)) for d, ids in coded)


def test_ranges_deal_copies_alike_when_a_task_is_repeated():
    bounds = [(1, token_files.FIRST), (5, 3), (5, 9), (5, 9), (5, 9), (7, token_files.FIRST)]
    ids, hashes = np.array([0, 1, 5, 5, 5, 5, 5, 5, 5, 6, 7]), np.array([4, 4, 2, 3, 8, 9, 9, 9, 10, 0, 0])
    first = token_files.Ranges(bounds, task=4).of(ids, hashes).tolist()
    assert first[:5] == [0, 1, 1, 2, 2] and sorted(first[5:8]) == [3, 4, 5] and first[8:] == [5, 5, 6]
    assert token_files.Ranges(bounds, task=4).of(ids, hashes).tolist() == first
