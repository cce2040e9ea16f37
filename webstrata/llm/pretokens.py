"""Byte-level BPE ids of whole texts, each distinct pre-token encoded once.

The pre-tokens are those of the byte-level pattern (contractions, and runs of letters, numbers, others and
white space, with a leading space): their borders are found on arrays of character classes. Since BPE never
merges across a border, the ids of a text are those of its pre-tokens in turn, and these repeat: each is
encoded by the tokenizer's model when first met and then looked up. Texts are split at the file's added tokens
before, as the tokenizer does."""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa

from .memory import forgotten_after_tasks

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
#: White space of Unicode. Fixed values.
_WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Contractions of the pattern after an apostrophe. Fixed values.
_SHORT, _LONG = "stmd", ("re", "ve", "ll")
#: Distinct pre-tokens that a task remembers, some 60 MB; of more it keeps those of the texts at hand.
REMEMBER = 150_000

#: The sign that stands for each byte in the vocabulary: printable ones for themselves, the others
#: for the code points from 256 on, in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_SIGNS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}

_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    global _classes
    if _classes is None:
        table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
        kinds = {"L": _LETTER, "N": _NUMBER}
        for c in range(sys.maxunicode + 1):
            table[c] = kinds.get(unicodedata.category(chr(c))[0], _OTHER)
        table[list(_WHITE)] = _SPACE
        _classes = table
    return _classes


def borders(chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in code points of joined texts; ``ends`` is where each text ends."""
    n = len(chars)
    kind = _class_table()[chars]
    begin = np.ones(n, dtype=bool)
    begin[1:] = kind[1:] != kind[:-1]
    text_begin = np.zeros(n + 1, dtype=bool)
    text_begin[0] = True
    text_begin[ends] = True
    begin |= text_begin[:n]
    last = text_begin[1:]  # the last character of a text
    space = kind == _SPACE
    # The last of several white characters stands apart when something follows in the text; a plain
    # space there belongs to what follows.
    before_other = np.zeros(n, dtype=bool)
    before_other[:-1] = space[:-1] & ~space[1:]
    before_other &= ~last
    begin |= before_other
    blank = before_other & (chars == 0x20)
    joined = np.flatnonzero(blank) + 1
    begin[joined] = False
    for p in np.flatnonzero(chars == 0x27):
        # only where a match begins: not inside a run of other signs, and not behind a space
        at_begin = text_begin[p]
        if not at_begin and (kind[p - 1] == _OTHER or chars[p - 1] == 0x20):
            continue
        end = p + 1
        while end < min(n, p + 3) and not text_begin[end]:
            end += 1
        tail = "".join(map(chr, chars[p + 1 : end]))
        size = 2 if tail[:1] and tail[0] in _SHORT else 3 if tail in _LONG else 0
        if size:
            begin[p + 1 : p + size] = False
            if p + size < n:
                begin[p + size] = True
    return np.flatnonzero(begin)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {token.content.encode(): i for i, token in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")").split if longest else None
        #: Tokens that take blanks around them, or whole words only, are left to the tokenizer.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin = np.zeros(1, dtype=np.int64)  # in self.ids, of each known pre-token, and the end
        self.ids = np.zeros(0, dtype=np.uint32)

    def _keep(self, some: list[tuple[bytes, int]]) -> None:
        """Forget all pre-tokens but some of the known ones."""
        at = np.array([code for _, code in some], dtype=np.int64)
        starts, sizes = self.begin[at], self.begin[at + 1] - self.begin[at]
        until = np.cumsum(sizes)
        self.ids = self.ids[np.repeat(starts - (until - sizes), sizes) + np.arange(until[-1] if len(some) else 0)]
        self.begin = np.concatenate([[0], until]).astype(np.int64)
        self.known = {t: i for i, (t, _) in enumerate(some)}

    def _codes(self, tokens: list[bytes]) -> np.ndarray:
        """Numbers of the pre-tokens among the known ones; encodes those that are new."""
        codes = list(map(self.known.get, tokens))
        new = [t for t, code in zip(tokens, codes) if code is None]
        if new:
            if len(self.known) + len(new) > REMEMBER and len(self.known) + len(new) > len(tokens):
                self._keep([(t, code) for t, code in zip(tokens, codes) if code is not None])
                return self._codes(tokens)
            tokenize = self.tokenizer.model.tokenize
            coded = [[t.id for t in tokenize(word.decode("latin-1").translate(_BYTE_SIGNS))] for word in new]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            ends = self.begin[-1] + np.cumsum([len(c) for c in coded])
            self.begin = np.concatenate([self.begin, ends])
            self.ids = np.concatenate([self.ids, np.fromiter((i for c in coded for i in c), np.uint32)])
            codes = map(self.known.__getitem__, tokens)
        return np.fromiter(codes, np.int64, len(tokens))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where those of each text begin (and the last end)."""
        if not any(token in text for token in self.added for text in texts):
            return self._encode_plain(texts)
        pieces: list[bytes] = []
        behind: list[int] = []  # the number of pieces before each id of an added token
        ids: list[int] = []
        begin = [(0, 0)]  # pieces and such ids before each text
        for text in texts:
            parts = self.split(text)
            if self.plain or len(parts) == 1:
                pieces.append(parts[0])
                for token, part in zip(parts[1::2], parts[2::2]):
                    behind.append(len(pieces))
                    ids.append(self.added[token])
                    pieces.append(part)
            else:
                pieces.append(b"")
                whole = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
                behind += [len(pieces)] * len(whole)
                ids += whole
            begin.append((len(pieces), len(ids)))
        out, first = self._encode_plain(pieces)
        at = np.array(begin)
        return np.insert(out, first[behind], ids), first[at[:, 0]] + at[:, 1]

    def _encode_plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        data = b"".join(texts)
        sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not data:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        chars = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
        raw = np.frombuffer(data, dtype=np.uint8)
        char_at = np.flatnonzero((raw & 0xC0) != 0x80)  # byte where each character begins
        ends = np.searchsorted(char_at, sizes[1:])
        at = char_at[borders(chars, ends)]
        offsets = pa.array(np.append(at, len(data)), pa.int32())
        column = pa.Array.from_buffers(pa.binary(), len(at), [None, offsets.buffers()[1], pa.py_buffer(data)])
        coded = column.dictionary_encode()
        code = self._codes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        starts = self.begin[code]
        each = self.begin[code + 1] - starts
        until = np.cumsum(each)
        out = self.ids[np.repeat(starts - (until - each), each) + np.arange(until[-1])]
        counts = np.concatenate([[0], until])
        return out, counts[np.searchsorted(at, sizes)]


_encoders: dict[str, Encoder] = {}


@forgotten_after_tasks
def _forget_pretokens() -> None:
    for one in _encoders.values():
        one._forget()


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it keeps the vocabulary, and pre-tokens until the task ends."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
