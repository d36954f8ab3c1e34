"""Pieces of many texts at a time, as arrays: where they begin, and the numbers of those met before.

For texts of the characters that `bpe` splits by itself. A piece of at most KEY_BYTES bytes is its own key, three words
with its bytes and length, so equal keys are equal pieces; longer ones have no key and are looked up as strings.
"""

from __future__ import annotations

import unicodedata

import numpy as np

#: Stands behind every text; no such text has it.
END = "￿"
KEY_BYTES = 23
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)
_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: For each number of bytes, a word with so many of its lowest bytes set.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def kinds_of_characters(last: int) -> np.ndarray:
    """The class of each character up to `last` in the byte-level pattern; others that `bpe` allows are of the rest."""
    kinds = np.full(1 << 16, _OTHER, np.uint8)
    for code in range(last + 1):
        kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _OTHER)
    kinds[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = _SPACE
    kinds[ord(END)] = _END
    return kinds


def starts_of_pieces(joined: str, kinds: np.ndarray) -> np.ndarray:
    """Where in texts with END behind each their pieces begin, by the byte-level pattern; END is a piece of its own."""
    codes = np.frombuffer(joined.encode("utf-16-le"), "<u2")
    kind = kinds.take(codes)
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _END)
    # the last white space before something else is by itself, or in front of it if it is a space
    before = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] < _SPACE))
    begins[before] = True
    begins[before[codes[before] == 0x20] + 1] = False
    # 's, 't, 'm, 'd, 're, 've and 'll where a piece begins; every text has END behind it, so there is a next one
    quotes = np.flatnonzero((codes == 0x27) & begins)
    if len(quotes):
        padded = np.append(codes, codes[-1:])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        begins[quotes[short | long] + 1] = False
        begins[quotes[short] + 2] = True
        begins[quotes[long] + 3] = True
    return np.flatnonzero(begins)


def keys_of(joined: str, starts: np.ndarray) -> np.ndarray:
    """Three words for each piece; the length in the highest byte, 0 for pieces that are too long."""
    data = joined.encode()
    ends = np.append(starts[1:], len(joined))
    if len(data) > len(joined):
        place = np.append(np.flatnonzero(np.frombuffer(data, np.int8) >= -0x40), len(data))
        starts, ends = place.take(starts), place.take(ends)
    length = ends - starts
    # the eight bytes from each place on as a word; zeros follow the data
    words = np.ndarray(len(data) + KEY_BYTES, "<u8", data + bytes(KEY_BYTES + 8), strides=(1,))
    out = np.empty((3, len(starts)), np.uint64)
    for k in range(3):
        out[k] = words[starts + 8 * k] & _MASK.take(length - 8 * k, mode="clip")
    length[length > KEY_BYTES] = 0
    out[2] = out[2] & _MASK[7] | length.astype(np.uint64) << np.uint64(56)
    return out


def room_for(values: np.ndarray, size: int) -> np.ndarray:
    """`values`, or with twice the room at least, and zeros behind, if `size` do not fit."""
    old = values.shape[-1]
    if size <= old:
        return values
    out = np.zeros((*values.shape[:-1], max(size, 2 * old)), values.dtype)
    out[..., :old] = values
    return out


class PieceTable:
    """Numbers of pieces by their keys, in an open table of twice to four times as many slots as there are pieces."""

    def __init__(self, keys: np.ndarray | None = None):
        self.keys = np.empty((3, 0), np.uint64) if keys is None else keys
        self.size = self.keys.shape[1]
        self._room(1 << 16)

    def _room(self, slots: int) -> None:
        while slots < 2 * self.size:
            slots *= 2
        self.number = np.full(slots, -1, np.int32)
        self._enter(np.arange(self.size))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[0] * _MIX[0] ^ keys[1] * _MIX[1] ^ keys[2] * _MIX[2]
        mixed ^= mixed >> np.uint64(32)
        return (mixed * _MIX[0] >> np.uint64(32)).view(np.int64) & len(self.number) - 1

    def _enter(self, numbers: np.ndarray) -> None:
        numbers = numbers[self.keys[2].take(numbers) > _MASK[7]]
        slots = self._slots(self.keys.take(numbers, axis=1))
        while len(numbers):
            free = self.number.take(slots) < 0
            self.number[slots[free]] = numbers[free]
            left = np.flatnonzero(self.number.take(slots) != numbers)
            numbers, slots = numbers[left], slots[left] + 1 & len(self.number) - 1

    def put(self, total: int, numbers: np.ndarray, keys: np.ndarray) -> None:
        """There are now `total` pieces, and those with these numbers, all different, have these keys."""
        self.keys, self.size = room_for(self.keys, total), total
        self.keys[:, numbers] = keys
        if 2 * total > len(self.number):
            self._room(2 * len(self.number))
        else:
            self._enter(numbers)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those not known."""
        slots = self._slots(keys)
        found = self.number.take(slots)
        # what stands in a slot is the key's number, another's, or none
        open_ = np.flatnonzero((found >= 0) & ~self._equal(found, keys))
        while len(open_):
            slots[open_] = slots[open_] + 1 & len(self.number) - 1
            here = self.number.take(slots[open_])
            found[open_] = here
            open_ = open_[(here >= 0) & ~self._equal(here, keys.take(open_, axis=1))]
        return found

    def _equal(self, numbers: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(numbers), bool)
        one, two, three = (own.take(numbers, mode="clip") == key for own, key in zip(self.keys, keys))
        return one & two & three
