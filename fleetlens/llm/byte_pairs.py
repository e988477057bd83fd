"""Token ids of many texts by a byte-level pair vocabulary: each distinct stretch of text is looked up once.

Texts are cut before every blank that something visible follows, and around single line feeds between
visible characters. No token of this kind of vocabulary crosses such a place, so a text's ids are those
of its stretches. The stretches of a piece of a batch are made distinct by their bytes, and only these
are encoded; ids are then gathered for the whole piece.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from fleetlens.llm.words import distinct_ranges, range_places

#: So many encoded stretches, and half as many parts of them, are remembered between pieces and batches.
REMEMBERED = 600_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Stretches of this form are parted here by the vocabulary's pattern; all others by the library.
_WORD = re.compile(rf" ?[{_LETTERS}]+|\n")
_KNOWN = re.compile(rf" ?[\x21-\x7E{_LETTERS}]+")
_PART = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ {_LETTERS}0-9]+")
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
#: Visible ASCII and leading bytes of characters that are never white space.
_AFTER = _VISIBLE.copy()
_AFTER[0xC3:0xF8] = True
_AFTER[0xE1:0xE4] = False


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of whole pieces of texts, equal to the library's for each text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_special = re.compile(b"|".join(map(re.escape, self.special)) or b"(?!)").search
        self.letters = byte_letters()
        self.remembered = remembered
        self.stretches: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def ids(self, part: str) -> bytes:
        """Ids of one word, number, run of marks or line feed."""
        if part.isascii():
            spelt = part.replace(" ", self.letters[0x20]).replace("\n", self.letters[0x0A])
        else:
            spelt = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self.ids(part)
            if len(self.parts) >= self.remembered // 2:
                self.parts.clear()
            self.parts[part] = found
        return found

    def stretch(self, data: bytes) -> bytes:
        text = data.decode()
        if _WORD.fullmatch(text):
            return self.parts.get(text) or self.ids(text)
        if not _KNOWN.fullmatch(text) or self.has_special(data):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join([self.part(p) for p in _PART.findall(text)])

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where stretches begin."""
        begin = np.zeros(len(data), bool)
        if len(data):
            line = data == 0x0A
            line[0] = False
            line[1:] &= _VISIBLE[data[:-1]]
            begin[:-1] = (data[:-1] == 0x20) & _AFTER[data[1:]] | line[:-1]
            begin[1:] |= line[:-1] & _AFTER[data[1:]]
            # what depends on the next text's first byte or the last one's end
            last = offsets[1:][np.diff(offsets) > 0] - 1
            begin[last] &= line[last]
            if self.has_special(whole := data.tobytes()):  # such texts are one stretch: the string ends a run of blanks
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    if self.has_special(whole, a, b):
                        begin[a:b] = False
            begin[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(begin)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin and the last one's end."""
        starts = self.cuts(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), bounds
        stops = np.append(starts[1:], len(data))
        first, number = distinct_ranges(data, starts, stops)
        whole, known, found = data.tobytes(), self.stretches, []
        for a, b in zip(starts[first].tolist(), stops[first].tolist()):
            key = whole[a:b]
            ids = known.get(key)
            if ids is None:
                ids = self.stretch(key)
                if len(known) >= self.remembered:
                    known.clear()
                known[key] = ids
            found.append(ids)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        each = lengths[number]
        ids = flat[range_places((np.cumsum(lengths) - lengths)[number], each)]
        return ids, np.concatenate([[0], np.cumsum(each)])[bounds]
