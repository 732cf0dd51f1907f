"""Operator 10: BPE encoding and decoding by a prefix-sharing trie.

A BPE encoding is known from the last token of every prefix: token ``t`` ends
the encoding of a prefix when the prefix before ``t`` ends in a token that BPE
leaves beside ``t``. The distinct words of a batch go into a trie; a depth-first
walk carries the last token of every prefix along the path, so the encoding of a
prefix that many words share is found once. Word encodings are read back along
the path and put together per document.

Texts are cut into pieces that neither normalisation nor the word pattern ever
joins, so a piece's ids depend on the piece alone and are remembered for the
next documents (bounded memory).
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from contextlib import contextmanager

from pyspark.sql import DataFrame

from aggrex.llm.common import pick

# The word pattern of the tokenizer, for pieces in lower case whose letters are known.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z{0}]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9{0}]+"
# Letters beyond ASCII that are split here if the library treats them as plainly as expected; the
# library itself splits pieces with any other character.
LETTERS = range(0xC0, 0x250)
REMEMBER = 150_000  # pieces and words a task remembers, twice: those in use and those before
REMEMBER_LENGTH = 48  # longer ones are encoded anew

class Merges:
    """Merge rules of a tokenizer file, and which token pairs BPE leaves as they are."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        self.vocab = vocab
        self.suffix = model.get("end_of_word_suffix") or ""
        # Tokens inside and at the end of words, and the longest by their last three characters.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.reach: dict[str, int] = {}
        self.reach_final: dict[str, int] = {}
        for text, t in vocab.items():
            tokens, reach = self.inner, self.reach
            if not self.suffix:
                self.final, self.reach_final = tokens, reach
            elif text.endswith(self.suffix):
                text, tokens, reach = text[:-len(self.suffix)], self.final, self.reach_final
            tokens[text] = t
            reach[text[-3:]] = max(len(text), reach.get(text[-3:], 0))
        n = max(vocab.values()) + 1
        self.rank = [-1] * n
        self.left = list(range(n))
        self.right = list(range(n))
        self.by_pair: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            t = vocab[a + b]
            self.by_pair[vocab[a], vocab[b]] = k
            self.made[k] = t
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = k, vocab[a], vocab[b]
        self.known: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}

    def beside(self, a: int, b: int) -> bool:
        """BPE leaves ``a`` followed by ``b``: walking both tokens' merges back in
        time, no rule across the border fires before the merges that use up its sides."""
        known = self.known.get((a, b))
        if known is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            known = self.known[a, b] = self._stays(a, b)
        return known

    def _stays(self, r: int, l: int) -> bool:  # noqa: E741
        rank, never = self.rank, 1 << 60
        r_used = l_used = never
        while True:
            k = self.by_pair.get((r, l))
            # On equal ranks the pair further left is merged first.
            if k is not None and k < r_used and k <= l_used:
                return False
            if rank[r] < 0 and rank[l] < 0:
                return True
            if rank[r] > rank[l]:
                r_used, r = rank[r], self.right[r]
            else:
                l_used, l = rank[l], self.left[l]  # noqa: E741

    def alone(self, t: int) -> bool:
        """The token's own text is encoded as this one token."""
        known = self._alone.get(t)
        if known is None:
            known = self.rank[t] < 0 or (self.made[self.rank[t]] == t and self.alone(self.left[t])
                                         and self.alone(self.right[t]) and self._builds(t))
            self._alone[t] = known
        return known

    def _builds(self, t: int) -> bool:
        """Its two parts stay apart until the rule that joins them."""
        rank, (r, l) = self.rank, (self.left[t], self.right[t])  # noqa: E741
        own, r_used, l_used = rank[t], 1 << 60, 1 << 60
        while True:
            k = self.by_pair.get((r, l))
            if k is not None and k != own and k < own and k < r_used and k <= l_used:
                return False
            if rank[r] < 0 and rank[l] < 0:
                return True
            if rank[r] > rank[l]:
                r_used, r = rank[r], self.right[r]
            else:
                l_used, l = rank[l], self.left[l]  # noqa: E741


def encode_words(words: set[str], merges: Merges) -> dict[str, list[int]]:
    """Token ids of every word, by a depth-first walk of the trie of the words.

    Sorted words are the trie's leaves in depth-first order: what a word shares
    with the one before is the path already walked, and the last tokens on that
    path stay as they are; only the rest of the word is new to the trie.
    """
    inner, final, reach, reach_final = merges.inner, merges.final, merges.reach, merges.reach_final
    known, beside, alone = merges.known, merges.beside, merges.alone
    out: dict[str, list[int]] = {}
    before = ""
    last: list[int] = []  # last token of each prefix on the path
    size: list[int] = []  # its length
    for word in sorted(words):
        n = len(word)
        d, most = 0, min(n - 1, len(last))
        while d < most and word[d] == before[d]:
            d += 1
        del last[d:], size[d:]
        before = word
        for d in range(d, n):
            # The word's last character carries the end-of-word mark.
            tail = word[d - 2 if d > 2 else 0:d + 1]
            if d == n - 1:
                tokens, far = final, reach_final.get(tail, 2)
            else:
                tokens, far = inner, reach.get(tail, 2)
            for j in range(d + 1 - far if far <= d else 0, d + 1):
                t = tokens.get(word[j:d + 1])
                if t is None:
                    continue
                if j:
                    pair = last[j - 1], t
                    fits = known.get(pair)
                    if fits is None:
                        fits = beside(*pair)
                else:
                    fits = alone(t)
                if fits:
                    break
            else:
                raise ValueError("no encoding for a word")
            if d < n - 1:
                last.append(t)
                size.append(d + 1 - j)
        ids = [t]
        while j:
            ids.append(last[j - 1])
            j -= size[j - 1]
        ids.reverse()
        out[word] = ids
    return out


class Splitter:
    """Cuts pieces of text into the words of one tokenizer file, as the library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = "".join(c for c in map(chr, LETTERS) if self._plain_letter(c))
        self.words_of = re.compile(WORDS.format(letters)).findall
        self.known_letters = re.compile(f"[\\x00-\\x7f{letters}]*").fullmatch
        # Bytes as the tokenizer's printable characters.
        self.byte_chars = {b: self.library.pre_tokenizer.pre_tokenize_str(chr(b))[0][0]
                           for b in range(128) if not chr(b).isalnum() and chr(b) not in " \t\n\x0b\x0c\r"}
        for c in map(chr, LETTERS):
            for byte, char in zip(c.encode(), self.library.pre_tokenizer.pre_tokenize_str(c)[0][0]):
                self.byte_chars[byte] = char
        self.byte_chars = {b: c for b, c in self.byte_chars.items() if c != chr(b)}

    def _plain_letter(self, c: str) -> bool:
        """The library lower-cases ``c`` to one character of itself, as str.lower does, and takes it for a letter."""
        small = c.lower()
        return (len(small) == 1 and ord(small) in LETTERS and self.library.normalizer.normalize_str(c) == small
                and len(self.library.pre_tokenizer.pre_tokenize_str(f"a{c}a{small}a")) == 1)

    def split(self, piece: str) -> list[str]:
        """Words of a piece without blanks, as byte characters."""
        if piece.isascii():
            return [w if w.isalnum() else w.translate(self.byte_chars) for w in self.words_of(piece.lower())]
        if self.known_letters(piece):
            return [w.encode().decode("latin-1").translate(self.byte_chars) for w in self.words_of(piece.lower())]
        normal = self.library.normalizer.normalize_str(piece)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def parts(self, piece: str) -> list[str | int]:
        """Words, and ids of special tokens, of a piece."""
        if self.special_cut is None or "<|" not in piece:
            return self.split(piece)
        out: list[str | int] = []
        for part in self.special_cut.split(piece):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self.split(part))
        return out


class PieceCutter(Splitter):
    """Cuts batches of texts into pieces, and tells which pieces are equal.

    A batch is cut as bytes, in numpy: at blanks and line ends, and between an
    ASCII letter or digit and ASCII punctuation (but for the apostrophe). No rule
    of the tokenizer joins what stands on two sides of such a cut; special
    tokens could, so texts with their first characters are left whole. Pieces
    are told apart by their bytes: up to seven of them, with their number, are one
    64-bit integer; longer pieces are numbered by a table of the batch's long pieces.
    """

    def __init__(self, path: str):
        import numpy as np

        super().__init__(path)
        self.kind = np.full(256, 3, np.uint8)  # 0 blank, 1 letter or digit, 2 punctuation, 3 all else
        self.kind[[10, 32]] = 0
        for b in range(33, 127):
            self.kind[b] = 1 if chr(b).isalnum() else 3 if chr(b) == "'" else 2
        self.first = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)

    def _groups(self, data, raw: bytes, start, stop):
        """(first piece of every group of equal pieces, which group each piece is in)."""
        import numpy as np

        size = stop - start
        padded = np.append(data, np.zeros(8, np.uint8))
        # The eight bytes from every place on, read where they stand.
        eight = np.ndarray((len(data),), "<u8", padded, strides=(1,))
        key = eight[start] & self.first[np.minimum(size, 7)] | (np.minimum(size, 8).astype(np.uint64) << np.uint64(56))
        long = np.flatnonzero(size > 7)
        known: dict[bytes, int] = {}
        key[long] = np.fromiter((known.setdefault(raw[s:e], len(known)) for s, e in zip(
            start[long].tolist(), stop[long].tolist())), np.uint64, len(long)) | np.uint64(8 << 56)
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        return one, which

    def cut(self, texts: list[str]):
        """(texts left whole, distinct pieces, which of them each piece is, how many pieces there are up to
        the end of each text)."""
        import numpy as np

        coded = [t.encode() for t in texts]
        whole = [i for i, c in enumerate(coded) if b"<|" in c]
        for i in whole:
            coded[i] = b""
        data = np.frombuffer(b" ".join(coded), np.uint8)
        kind = self.kind[data]
        white = kind == 0
        before = np.append(np.uint8(0), kind[:-1])[:len(kind)]
        # Kinds 1 and 2 side by side add up to 3 without either being 0 or 3.
        cut = ~white & ((before == 0) | ((before + kind == 3) & (before != 3) & (kind != 3)))
        start = np.flatnonzero(cut)
        if not len(start):
            return whole, [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        stop = np.flatnonzero(~white & np.append(cut[1:] | white[1:], True)) + 1
        raw = data.tobytes()
        one, which = self._groups(data, raw, start, stop)
        pieces = [raw[s:e] for s, e in zip(start[one].tolist(), stop[one].tolist())]
        end = np.cumsum([len(c) + 1 for c in coded])
        return whole, pieces, which, np.searchsorted(start, end, "left")


def gather(found: list[bytes], which, ends, dtype) -> list:
    """Per text the items of its pieces, one after the other; ``found`` has the distinct pieces' items."""
    import numpy as np

    if not len(ends):
        return []
    item = np.dtype(dtype).itemsize
    flat = np.frombuffer(b"".join(found), dtype)
    size = np.fromiter(map(len, found), np.int64, len(found)) // item
    place = (np.cumsum(size) - size)[which]
    size = size[which]
    upto = np.append(0, np.cumsum(size))
    items = flat[np.repeat(place - upto[:-1], size) + np.arange(upto[-1])]
    return np.split(items, upto[ends][:-1])


@contextmanager
def no_cycle_collection():
    """What is remembered has no cycles to look for, and grows too large to be looked through so often."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


class Codec(PieceCutter):
    """Encodes and decodes whole texts with one tokenizer file."""

    def __init__(self, path: str):
        super().__init__(path)
        self.merges = Merges(self.spec["model"])
        self.texts = {i: f"{t} " for t, i in (self.merges.vocab | self.special).items()}
        self.words: dict[str, list[int]] = {}
        self.pieces: dict[bytes, tuple[bytes, bytes]] = {}
        self.older_words: dict[str, list[int]] = {}
        self.older_pieces: dict[bytes, tuple[bytes, bytes]] = {}

    def _coded(self, parts: list[str | int], more: dict) -> tuple[bytes, bytes]:
        """Ids, and the tokens' texts with a blank behind each, of a piece's words."""
        import numpy as np

        ids: list[int] = []
        for w in parts:
            if isinstance(w, int):
                ids.append(w)
            else:
                ids += more.get(w) or self.words[w]
        texts = self.texts
        return np.array(ids, "<u4").tobytes(), "".join([texts[i] for i in ids]).encode()

    def _encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Encodes the words not known yet; returns those too long to be remembered."""
        new = words.difference(self.words)
        self.words.update((w, self.older_words[w]) for w in new.intersection(self.older_words))
        found = encode_words(new.difference(self.words), self.merges)
        self.words.update((w, ids) for w, ids in found.items() if len(w) <= REMEMBER_LENGTH)
        return {w: ids for w, ids in found.items() if len(w) > REMEMBER_LENGTH}

    def _codes(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        if len(self.pieces) > REMEMBER:
            self.older_pieces, self.pieces = self.pieces, {}
        if len(self.words) > REMEMBER:
            self.older_words, self.words = self.words, {}
        known = self.pieces
        missing = [p for p in pieces if p not in known]
        known.update((p, self.older_pieces[p]) for p in missing if p in self.older_pieces)
        fresh = {p: self.split(p.decode()) for p in missing if p not in known}
        more = self._encode_words(set().union(*fresh.values()))
        for p, words in fresh.items():
            known[p] = self._coded(words, more)
        out = [known[p] for p in pieces]
        for p in fresh:
            if len(p) > REMEMBER_LENGTH:
                del known[p]
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text in UTF-8) of every text."""
        whole, pieces, which, ends = self.cut(texts)
        with no_cycle_collection():
            codes = self._codes(pieces)
            ids = gather([i for i, _ in codes], which, ends, "<u4")
            decoded = gather([t for _, t in codes], which, ends, "u1")
            # Each token's text has a blank behind it; the last one goes.
            out = [(i.tobytes(), d.tobytes()[:-1]) for i, d in zip(ids, decoded)]
            for i in whole:
                parts = [p for piece in texts[i].replace("\n", " ").split(" ") for p in self.parts(piece)]
                more = self._encode_words({w for w in parts if isinstance(w, str)})
                coded = self._coded(parts, more)
                out[i] = coded[0], coded[1][:-1]
        return out


def text_batches(batches, rows: int = 512, chars: int = 4 << 20):
    """(batch slice, texts) of bounded size; a NULL text counts as empty."""
    for b in batches:
        i = 0
        texts = b.column("text")
        while i < b.num_rows:
            part, total = [], 0
            while i + len(part) < b.num_rows and len(part) < rows and total < chars:
                part.append(texts[i + len(part)].as_py() or "")
                total += len(part[-1])
            yield b.slice(i, len(part)), part
            i += len(part)


def bpe_encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    with ``keep_ids`` also ids (array<int>) and decoded.

    ``tokenizer`` is the path of a tokenizers file, readable on every executor.
    One pass without a shuffle; a task holds one batch of texts, its trie and
    the remembered pieces. NULL texts are empty texts: no ids, empty decoding.
    Repeated rows give repeated results; NULL ids stay NULL; other columns are
    not read. Texts without blanks are one piece of any length.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec = Codec(tokenizer)
        for b, texts in text_batches(batches, rows=1024, chars=1 << 20):
            coded = codec.encode(texts)
            cols = [b.column("doc_id").cast(pa.int64()),
                    pa.array([len(i) // 4 for i, _ in coded], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in coded]),
                    pa.array([hashlib.sha256(t).hexdigest() for _, t in coded])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array([np.frombuffer(i, "<u4").astype("int32") for i, _ in coded], pa.list_(pa.int32())),
                         pa.array([t.decode() for _, t in coded])]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)
