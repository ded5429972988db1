"""Token ids of whole texts, with the tokenizers library.

Both byte-level and word-end vocabularies cut a text at least before every
single blank that stands between two non-blanks, and encode what lies between
cuts on its own. So the ids of a text are those of its pieces, and a piece
seen before is looked up instead of encoded again. New pieces of letters below
U+0250 only are one unit for either vocabulary, and go to the library's merge
model directly; other pieces and texts with any other white space go through
its whole chain, and so do texts that hold a string of the vocabulary's added
tokens. Such a string is its own token, as in the library's plain call;
``special_text=True`` reads it as ordinary text instead.

Texts are cut and their pieces numbered by Arrow, slices of ``_SLICE_BYTES``
at a time, and a word is parted from the ASCII punctuation after it; Python
sees every distinct piece of a slice once. A worker keeps the pieces it met,
in two tables of about ``table_bytes`` each.
"""

from __future__ import annotations

import codecs
import re
import string
import sys
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_BYTES = 100 << 20  # of each of a worker's two tables, the current and the one before
_ENTRY_BYTES = 150  # of a piece, its ids and their place in a table, besides their lengths
_SLICE_BYTES = 8 << 20
_KEPT = 10_000  # pieces that go into the table at a time
_START = "\0"  # marks a piece at a line's start, without the blank before it
_LATIN = map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x250)])
# of a word that punctuation may be parted from
_STEM = _START + string.digits + string.ascii_letters + "".join(c for c in _LATIN if c.lower().isalnum())
_PROBES = ("a", "The", "zażółć", "ÉCOLE", "straße")
_LOADED: dict[tuple[str, bool], Pieces] = {}


def _byte_letters() -> str:
    """The byte alphabet of byte-level vocabularies: a printable Latin-1 byte
    is its own letter, the others take the letters from U+0100 on in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(others)) for b in range(256))


_LETTERS = _byte_letters()
_BLANK = _LETTERS[0x20]


class Pieces(dict):
    """Piece -> its ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, special_text: bool = False):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content.strip()]
        # in any case of letters: a normalizer may lower them before it looks for them
        self.table_bytes = TABLE_BYTES
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.I)
        self.held = 0
        self.dtype = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.older: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.word_ends = bool(getattr(self.model, "end_of_word_suffix", None))
        self.direct = all(
            self.merged([self.unit(w, b)]) == [self.whole(b * " " + w)] for w in _PROBES for b in (True, False)
        )
        self.line_break = self.whole("\n")  # between two non-blanks a piece of its own

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def unit(self, word: str, blank: bool) -> str:
        """What the merge model reads for a word of letters."""
        unit = word.lower() if self.word_ends else word
        if not unit.isascii():
            unit = codecs.charmap_decode(unit.encode(), "strict", _LETTERS)[0]
        return _BLANK + unit if blank and not self.word_ends else unit

    def merged(self, units: list[str]) -> list[bytes]:
        flat, ends, tokenize = array(self.code), [0], self.model.tokenize
        for unit in units:
            flat.extend([t.id for t in tokenize(unit)])
            ends.append(len(flat) * flat.itemsize)
        if sys.byteorder == "big":
            flat.byteswap()
        data = flat.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def known(self, units: list[str]) -> list[bytes]:
        """The ids of distinct pieces; those not met before are encoded."""
        out = list(map(self.get, units))
        new = [i for i, ids in enumerate(out) if ids is None]
        older = self.older.get if self.older else {}.get
        words, places = [], []
        for i in new:
            piece = units[i]
            out[i] = older(piece)
            if out[i] is not None:
                continue
            if piece.isalpha() and piece.isascii() and self.direct:  # most of them
                words.append(self.unit(piece, True))
                places.append(i)
                continue
            blank = piece[0] != _START
            word = piece if blank else piece[1:]
            if self.direct and word.isalpha() and max(word) < "\u0250" and word.lower().isalpha():
                words.append(self.unit(word, blank))
                places.append(i)
            else:
                out[i] = self.line_break if piece == "\n" else self.whole(blank * " " + word)
        for i, ids in zip(places, self.merged(words), strict=True):
            out[i] = ids
        self.keep([units[i] for i in new], [out[i] for i in new])
        return out

    def keep(self, units: list[str], ids: list[bytes]) -> None:
        for a in range(0, len(units), _KEPT):
            if self.held >= self.table_bytes:  # pieces not met again since the last time are forgotten
                self.older = dict(self)
                self.clear()
                self.held = 0
            some = units[a : a + _KEPT], ids[a : a + _KEPT]
            self.update(zip(*some, strict=True))
            self.held += _ENTRY_BYTES * len(some[0]) + sum(map(len, chain(*some)))

    def rest(self) -> None:
        """Between tasks a worker keeps one table."""
        self.older = {}

    def plain(self, text: str) -> bool:
        """Whether single blanks and line breaks between printable characters
        cut the text into pieces."""
        flat = text.replace("\n", " ")
        # printable: no other white space, and no control characters
        return not ("  " in flat or flat[0] == " " or flat[-1] == " " or not flat.isprintable() or self.added.search(text))

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text, as little-endian bytes."""
        out: list[bytes] = [b""] * len(texts)
        some, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.plain(text):
                out[i] = self.whole(text)
                continue
            some.append(i)
            size += len(text)
            if size >= _SLICE_BYTES:
                self._slice(texts, some, out)
                some, size = [], 0
        if some:
            self._slice(texts, some, out)
        return out

    def _slice(self, texts: list, some: list[int], out: list[bytes]) -> None:
        """The ids of the plain texts ``some``."""
        # "a b\nc" is "a", " b", "\n" and "c"; a mark stands for "without the blank before it"
        lines = pa.array([(_START + texts[i]).replace("\n", f" \n {_START}") for i in some], pa.large_string())
        words = pc.split_pattern(lines, " ")
        ends = np.asarray(words.offsets)[1:] - words.offsets[0].as_py()
        numbered = pc.dictionary_encode(words.flatten())
        firsts, cut, second = _parted(numbered.dictionary)
        units = pc.dictionary_encode(pa.concat_arrays([firsts, second]))
        known = self.known(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // ids.itemsize
        starts = np.cumsum(sizes) - sizes
        # the units of the distinct pieces, in their order
        unit = np.asarray(units.indices)
        order = np.empty(len(unit), np.int64)
        first = np.arange(len(cut)) + np.cumsum(cut) - cut
        order[first] = unit[: len(cut)]
        order[first[cut] + 1] = unit[len(cut) :]
        ids = ids[_runs(starts[order], sizes[order])]
        of_piece = sizes[unit[: len(cut)]]
        of_piece[cut] += sizes[unit[len(cut) :]]
        starts = np.cumsum(of_piece) - of_piece
        place = np.asarray(numbered.indices)
        sizes = of_piece[place]
        flat = ids[_runs(starts[place], sizes)].tobytes()
        ends = (np.cumsum(sizes)[ends - 1] * ids.itemsize).tolist()
        for i, a, b in zip(some, [0, *ends], ends, strict=False):
            out[i] = flat[a:b]


def _parted(distinct: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Pieces without the ASCII punctuation after their letters and digits,
    which pieces had some, and that of those as pieces. Such punctuation never
    shares an id with the letters and digits, but it may with the mark that a
    letter's lower case carries."""
    stem = pc.utf8_rtrim(distinct, string.punctuation)
    tail = pc.utf8_ltrim(distinct, _STEM)
    n_stem, n_tail = (np.asarray(pc.binary_length(x)) for x in (stem, tail))
    cut = (n_tail > 0) & (n_stem > 0) & (n_stem + n_tail == np.asarray(pc.binary_length(distinct)))
    cut &= ~np.asarray(pc.equal(stem, _START).to_numpy(zero_copy_only=False))
    mask = pa.array(cut)
    second = pc.binary_join_element_wise(pa.scalar(_START, distinct.type), tail.filter(mask), pa.scalar("", distinct.type))
    return pc.if_else(mask, stem, distinct), cut, second


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start + 1``, ... of every run, one run after another."""
    run = np.repeat((starts - (np.cumsum(sizes) - sizes)).astype(np.int32), sizes)
    run += np.arange(len(run), dtype=np.int32)
    return run


def pieces(path: str, special_text: bool = False, table_bytes: int = TABLE_BYTES) -> Pieces:
    """The worker's table for a vocabulary file, kept between tasks."""
    if (path, special_text) not in _LOADED:
        _LOADED[path, special_text] = Pieces(path, special_text)
    known = _LOADED[path, special_text]
    known.table_bytes = table_bytes
    return known
