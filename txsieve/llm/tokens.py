"""Token ids of whole texts, with pieces of text encoded once and kept in a bounded cache."""

from __future__ import annotations

import functools
import itertools
import struct
import sys
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

#: Pieces in each of the two generations that a worker remembers, about 200 bytes each, and the longest piece worth it.
CACHE = 250_000
LONGEST = 64
#: Marks that make a token of their own behind a word, alone or in a row; an apostrophe may belong to the word.
_MARKS = '.,;:!?%&#*$|<>()[]{}"/+=@^~-'
#: White space other than space and line end, and the mark that cuts pieces. A text with one takes the long way.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"] + ["\0"]
_DOUBLE = ("  ", " \n", "\n ", "\n\n")

#: Kinds of bytes: space or line end, control, letter, digit, apostrophe, mark, other UTF-8, other UTF-8 that may end white space.
_GAP, _CONTROL, _LETTER, _DIGIT, _QUOTE, _MARK, _HIGH, _HIGH_GAP = range(8)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _CONTROL, np.uint8)
    kinds[33:127], kinds[128:] = _MARK, _HIGH
    for low, high, kind in (("A", "Z", _LETTER), ("a", "z", _LETTER), ("0", "9", _DIGIT), ("'", "'", _QUOTE)):
        kinds[ord(low) : ord(high) + 1] = kind
    kinds[[ord(" "), ord("\n")]] = _GAP
    kinds[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = _HIGH_GAP
    return kinds


def _word_ends() -> np.ndarray:
    """By 8 * kind of a byte + kind of the next: whether no token of a byte-level tokenizer can hold both.

    Its words are letters, digits or marks, perhaps behind one space, or white space. An
    apostrophe takes the letters behind it along.
    """
    ends = np.zeros((8, 8), bool)
    ends[_LETTER, [_GAP, _CONTROL, _DIGIT, _QUOTE, _MARK]] = True
    ends[_DIGIT, [_GAP, _LETTER, _MARK]] = True
    ends[_MARK, [_GAP, _LETTER, _DIGIT]] = True
    ends[[_QUOTE, _HIGH], _GAP] = True
    return ends.reshape(-1)


_KINDS, _WORD_ENDS = _kinds(), _word_ends()


def word_starts(raw: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8: whether a token surely starts there, whatever lies before and behind."""
    kinds = _KINDS[raw]
    starts = np.zeros(len(raw), bool)
    pairs = (kinds[:-1] << 3) + kinds[1:]
    starts[1:] = _WORD_ENDS[pairs]
    # behind a character that ends like white space, but has two bytes other than C2 .. or three from E4 on
    at = np.flatnonzero(pairs == 8 * _HIGH_GAP + _GAP) + 1
    at = at[at >= 3]
    two, three = raw[at - 2], raw[at - 3]
    starts[at[((two > 0xC2) & (two < 0xE0)) | ((three >= 0xE4) & (three < 0xF0))]] = True
    # behind a Latin letter of two bytes, U+00C0 to U+017F
    at = np.flatnonzero((pairs >> 3 >= _HIGH) & ((pairs & 7) >= _DIGIT) & ((pairs & 7) <= _MARK)) + 1
    at = at[at >= 2]
    two, one = raw[at - 2], raw[at - 1]
    starts[at[(two >= 0xC3) & (two <= 0xC5) & ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7)))]] = True
    # behind a line end that stands alone
    at = np.flatnonzero(raw[:-1] == 10)
    at = at[starts[at] & (kinds[at + 1] >= _LETTER) & (kinds[at + 1] <= _MARK)]
    starts[at + 1] = True
    return starts


def pack_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else struct.pack(f"<{len(ids)}I", *ids)


def plain_pieces(text: str) -> list[str] | None:
    """``text`` cut in front of its spaces and line ends; None if white space of another kind or place is in it."""
    if text[0] == "\n" or text[-1] in " \n" or any(x in text for x in _DOUBLE) or any(x in text for x in _OTHER_SPACE):
        return None
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


class Remembered(dict):
    """Values of ``make`` by key. A full generation becomes the old one and the old one goes;
    a hit in the old one moves up, so what is frequent stays."""

    def __init__(self, make: Callable[[str], bytes], limit: int) -> None:
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

    def many(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Values of different keys; those of all new keys are made together."""
        values = list(map(self.get, keys))
        absent = [k for k, value in enumerate(values) if value is None]
        wanted = [keys[k] for k in absent]
        found = list(map(self.old.get, wanted))
        made = iter(make([key for key, value in zip(wanted, found, strict=True) if value is None]))
        found = [next(made) if value is None else value for value in found]
        for k, value in zip(absent, found, strict=True):
            values[k] = value
        short = {key: value for key, value in zip(wanted, found, strict=True) if len(key) <= LONGEST}
        if len(self) + len(short) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(itertools.islice(short.items(), self.limit))
        return values


class TextEncoder:
    """Ids of a text as the tokenizer file gives them, without added special tokens.

    Special tokens inside a text are what the library makes of them: with ``special``
    their own ids, as by default, else ordinary text.

    A text is cut in front of spaces and line ends that stand alone between two
    characters that aren't white space. No token of these tokenizers crosses such
    a cut: they split texts into words first, and a word starts at the space
    or after it. So a piece is encoded once and then looked up; ``pieces``
    maps pieces to their ids as bytes. A piece of Latin letters, with marks at the
    end perhaps, is one word and goes straight to the model of the tokenizer.
    """

    def __init__(self, name: str, limit: int = CACHE, special: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.lower() for t in added] if special else []
        self.model = self.tokenizer.model
        # the tokenizer with a normalizer lowers letters and drops white space
        self.lower = self.tokenizer.normalizer is not None
        self.pieces, self.marks = Remembered(self.encode_piece, limit), Remembered(self._word, limit)
        self.letters = self._letters()
        if not self.lower:
            self.line_end = self.tokenizer.token_to_id(self.letters[10])
            vocabulary = self.tokenizer.get_vocab()
            self.led_by_space = np.zeros(max(vocabulary.values()) + 1, bool)
            self.led_by_space[[i for token, i in vocabulary.items() if token.startswith(self.letters[32])]] = True

    @staticmethod
    def _letters() -> list[str]:
        """The character that stands for each byte in the vocabulary; printable ones stand for themselves."""
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        return [chr(b) if b in plain else chr(next(others)) for b in range(256)]

    def _word(self, word: str) -> bytes:
        """Ids of one word, or of marks in a row."""
        return pack_ids([t.id for t in self.model.tokenize(self._spelled(word))])

    def encode_piece(self, piece: str) -> bytes:
        space = piece[:1] == " "
        body = piece[1:] if space else piece
        if self.lower:
            space, body = False, body.lower()
        word = body.rstrip(_MARKS)
        if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
            if len(word) < len(body):  # words are remembered by themselves, and come with other marks
                return self.pieces[" " + word if self.lower or space else word] + self.marks[body[len(word) :]]
            return self._word(" " + word if space else word)
        return pack_ids(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<" in text and any(s in text.lower() for s in self.special):
            return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        cut = plain_pieces(text)
        if cut:
            return b"".join(map(self.pieces.__getitem__, cut))
        # cut at the plain places only
        parts, held, previous = [], "", ""
        for k, part in enumerate(text.split(" ")):
            whole = " " + part if k else part
            if part and previous and not part[0].isspace() and not previous[-1].isspace():
                parts.append(held)
                held = whole
            else:
                held += whole
            previous = part
        parts.append(held)
        return b"".join([self.pieces[x] for x in parts if x])

    def _spelled(self, word: str) -> str:
        """``word`` in the characters of the vocabulary."""
        if word.isascii():  # printable letters stand for themselves
            return word.replace(" ", self.letters[32]).replace("\n", self.letters[10])
        return "".join([self.letters[b] for b in word.encode()])

    def _together(self, words: list[str], led: bool) -> list[bytes]:
        """Ids of words of Latin letters, ``led`` by a space or not, that the model takes several at a time.

        The space of each word, or a line end behind it, divides them. If a token of its own
        starts at each of those, no token crosses from word to word, and each word has the ids it has alone.
        """
        found: list[int] = []
        for at in range(0, len(words), 8):
            several = words[at : at + 8]
            joined = "".join(several) if led else "\n".join(several) + "\n"
            found += [t.id for t in self.model.tokenize(self._spelled(joined))]
        ids = np.array(found, "<u4")
        if led:
            begins = np.flatnonzero(self.led_by_space[ids])
            ends = np.append(begins[1:], len(ids))
        else:
            ends = np.flatnonzero(ids == self.line_end)
            begins = np.append(0, ends[:-1] + 1)
        if len(ends) != len(words):
            return [self._word(word) for word in words]
        packed = ids.tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that stand alone."""
        made: list[bytes] = [b""] * len(pieces)
        led, bare = [], []
        for k, piece in enumerate(pieces):
            space = piece[0] == " "
            if not (piece[1:] if space else piece).isalpha() or max(piece) >= "\u0250":
                made[k] = pack_ids(self.tokenizer.encode(piece, add_special_tokens=False).ids)
            elif space:
                led.append(k)
            else:
                bare.append(k)
        for at in (led, bare):
            if at:
                for k, ids in zip(at, self._together([pieces[k] for k in at], at is led), strict=True):
                    made[k] = ids
        return made

    def all_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` (NULL: none) in a row, and how many each text has, as ``packed`` gives them.

        For byte-level tokenizers without a normalizer. The texts are cut where words
        end, and each different piece is looked up once.
        """
        texts = texts.fill_null("").cast(pa.large_string())
        if self.lower:
            whole = [self.packed(text) for text in texts.to_pylist()]
            return np.frombuffer(b"".join(whole), "<u4"), np.array([len(w) // 4 for w in whole], np.int64)
        odd: dict[int, np.ndarray] = {}
        if self.special and any("<" in text for text in texts.to_pylist()):
            listed = texts.to_pylist()
            for k, text in enumerate(listed):
                if any(s in text.lower() for s in self.special):
                    odd[k], listed[k] = self.ids(text), ""
            if odd:
                texts = pa.array(listed, pa.large_string())
        ids, counts = self._plain_ids(texts)
        if odd:
            parts, at = [], 0
            for k, upto in enumerate(np.cumsum(counts).tolist()):
                parts.append(odd.get(k, ids[at:upto]))
                at = upto
            counts = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids, counts

    def _plain_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``all_ids`` of texts without special tokens."""
        if len(texts) == 0:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        if len(raw) == 0:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        starts = word_starts(raw)
        starts[bounds[bounds < len(raw)]] = True
        places = np.flatnonzero(starts)
        ends = pa.py_buffer(np.append(places, len(raw)))
        pieces = pa.Array.from_buffers(pa.large_string(), len(places), [None, ends, pa.py_buffer(raw)]).dictionary_encode()
        known = self.pieces.many(pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), self.encode_pieces)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        pool = np.frombuffer(b"".join(known), "<u4")
        which = pieces.indices.to_numpy()
        counts = sizes[which]
        upto = np.append(0, np.cumsum(counts))
        # where a piece lies in the pool, less where it comes to lie
        shift = (np.cumsum(sizes) - sizes)[which] - upto[:-1]
        ids = pool[np.repeat(shift, counts) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(places, bounds)])

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u4")


@functools.lru_cache(maxsize=2)
def encoder(name: str, special: bool = True, limit: int = CACHE) -> TextEncoder:
    """The encoder of this worker process, kept from task to task."""
    return TextEncoder(name, limit, special)
