"""Byte-level BPE encoding and decoding; long texts are encoded as trees of halves.

A text is first split to pieces by the vocabulary's pattern, and every piece is merged by itself. Both steps can be
done in halves: only around a join can the two halves be wrong about the whole, so a window around it is done again,
and grown until it agrees with both sides.

* Pieces: matching is memoryless from the start of a piece, and looks at most LOOK characters ahead. So the left half
  is right up to LOOK characters before its end, and the right half from the first boundary that the window shares.
* Tokens of one piece: a sequence of tokens is the encoding of its text exactly if each two neighbours are. So the
  parts fit as soon as the window begins with the left side's token and ends with the right side's.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopledger.llm.piece_table import END, PieceTable, keys_of, kinds_of_characters, room_for, starts_of_pieces
from shopledger.llm.tables import small_batches

#: Characters behind a piece's end that may have decided where it ends.
LOOK = 3
#: Pieces, and texts that the library splits, of more characters are done in halves.
LEAF_CHARS = 4096
#: Pieces whose ids a worker remembers; beyond, it forgets those not met since it last forgot some.
REMEMBERED = 250_000
#: The same for numbered pieces, which take some 200 bytes each.
NUMBERED = 1_000_000

#: Texts of characters up to LAST only are split here; others by the library, whose character tables decide.
LAST = 0x24F
_OTHER = re.compile(f"[^\x00-{chr(LAST)}\u2010-\u2027\u20ac]")


def _pattern() -> re.Pattern[str]:
    """The byte-level pattern with its classes spelled out, which have long been the same in every Unicode version."""
    kinds = {k: "".join(c for c in map(chr, range(LAST + 1)) if unicodedata.category(c)[0] == k) for k in "LN"}
    letter, number = kinds["L"], kinds["N"]
    space = r"\t-\r \x85\xa0"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


_PIECE = _pattern()
_KINDS = kinds_of_characters(LAST)


class _Numbers(dict):
    """Numbers of pieces in the order they are first asked for; `new` are those that came since it was last emptied."""

    def __init__(self, known: Iterable[tuple[str, int]] = ()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, with its byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder over a vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str, leaf_chars: int = LEAF_CHARS):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf = max(leaf_chars, 2 * LOOK)
        alphabet = byte_alphabet()
        self._char_of = {b: c for c, b in alphabet.items()}
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes_of = [
            bytes(map(alphabet.__getitem__, name)) if all(c in alphabet for c in name) else name.encode()
            for name in names
        ]
        self.decimal = [str(i) for i in range(size)]
        added = {token.content: i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self._added = added
        longest_first = sorted(added, key=len, reverse=True)
        self._added_pattern = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self._ids: dict[str, tuple[int, ...]] = {}
        self._met: set[str] = set()
        # one object for each id, shared by all pieces
        self._number = list(range(size))
        self._model = self.tokenizer.model  # asking the tokenizer for it makes a new object every time
        self._sizes: dict[str, int] = {}
        # pieces by number: all their ids in one array, where each begins and how many it has, whether it came again;
        # the arrays have room for more
        self._numbers, self._table = _Numbers(), PieceTable()
        self._flat, self._starts, self._counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self._again, self._used = np.empty(0, bool), 0
        self._shown = str.maketrans({b: c for b, c in enumerate(map(self._char_of.__getitem__, range(256)))})

    # pieces

    def _library_pieces(self, text: str) -> list[str]:
        return [text[s:e] for _, (s, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """What the vocabulary's pattern splits `text` into. One pass over all of it, but for the library's halves."""
        return self._tree(text, self._library_pieces) if _OTHER.search(text) else _PIECE.findall(text)

    def _tree(self, text: str, split: Callable[[str], list[str]]) -> list[str]:
        if len(text) <= self.leaf:
            return split(text)
        middle = len(text) // 2
        return self._join(text, middle, self._tree(text[:middle], split), self._tree(text[middle:], split), split)

    def _join(self, text: str, middle: int, left: list[str], right: list[str], split) -> list[str]:
        start = middle
        while left and start + LOOK > middle:
            start -= len(left.pop())
        reach, n_right, at = 32, 0, middle
        ends: dict[int, int] = {}  # of the right half's pieces: place in the text -> how many pieces end there
        while True:
            stop = min(len(text), middle + reach)
            while n_right < len(right) and at < stop:
                at += len(right[n_right])
                n_right += 1
                ends[at] = n_right
            window, place = split(text[start:stop]), start
            for n, piece in enumerate(window, 1):
                place += len(piece)
                if place > middle and place + LOOK <= stop and place in ends:
                    return left + window[:n] + right[ends[place] :]
            if stop == len(text):
                return left + window
            reach *= 2

    # tokens

    def merge(self, piece: str) -> list[int]:
        """The ids of one piece, of a long one from the ids of its halves."""
        return self._merged(piece.encode().decode("latin-1").translate(self._shown))

    def _merged(self, shown: str) -> list[int]:
        if len(shown) <= self.leaf:
            return [t.id for t in self._model.tokenize(shown)]
        middle = len(shown) // 2
        left, right = self._merged(shown[:middle]), self._merged(shown[middle:])
        reach = 4
        while True:
            i, j = min(reach, len(left)), min(reach, len(right))
            text = b"".join(self.bytes_of[t] for t in (*left[-i:], *right[:j]))
            window = [t.id for t in self._model.tokenize("".join(map(self._char_of.__getitem__, text)))]
            left_agrees = i == len(left) or window[0] == left[-i]
            right_agrees = j == len(right) or window[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return left[:-i] + window + right[j:]
            reach *= 2

    def _learn(self, used: set[str]) -> None:
        if len(self._ids) > REMEMBERED:
            kept = self._met if len(self._met) <= REMEMBERED // 2 else used
            self._ids = {p: self._ids[p] for p in kept & self._ids.keys()}
            self._met = set()
        new = used - self._ids.keys()
        self._met |= used - new
        number = self._number
        self._ids.update((p, tuple([number[i] for i in self.merge(p)])) for p in new)

    def _known(self, texts: list[str | None]) -> tuple[list[list[str]], dict[str, tuple[int, ...]]]:
        """The pieces of every text, and the ids of each."""
        split = [self._pieces_and_added(text or "") for text in texts]
        used: set[str] = set()
        for own in split:
            used.update(own)
        own_ids = {p: (self._added[p],) for p in used & self._added.keys()}
        self._learn(used - own_ids.keys())
        known = self._ids if not own_ids else {p: self._ids[p] for p in used - own_ids.keys()} | own_ids
        return split, known

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of every text."""
        split, known = self._known(texts)
        return [list(chain.from_iterable(map(known.__getitem__, own))) for own in split]

    def encode_arrays(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text as arrays, put together from those of its numbered pieces without lists of ids."""
        if not texts:
            return []
        known = len(self._numbers)
        numbers = self._numbers_of(["" if text is None else text for text in texts])
        used = np.concatenate(numbers)
        self._again[used[used < known]] = True
        self._learn_numbered(known)
        ids, counts = self._ids_of(used)
        ends = np.append(0, np.cumsum(counts)).take(np.cumsum([len(n) for n in numbers]))
        if len(self._numbers) > NUMBERED:
            self._forget(used)
        return np.split(ids, ends[:-1])

    def _numbers_of(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the pieces of every text; pieces not met before get theirs."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        plain = []
        for at, text in enumerate(texts):
            if _OTHER.search(text) or self._added_pattern and self._added_pattern.search(text):
                own = self._pieces_and_added(text)
                out[at] = np.fromiter(map(self._numbers.__getitem__, own), np.int32, len(own))
            else:
                plain.append(at)
        if plain:
            for at, own in zip(plain, self._plain_numbers([texts[at] for at in plain])):
                out[at] = own
        return out

    def _plain_numbers(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(text + END for text in texts)
        starts = starts_of_pieces(joined, _KINDS)
        ends = np.append(starts[1:], len(joined))
        last = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]) - 1)
        keys = keys_of(joined, starts)
        numbers = self._table.find(keys)
        numbers[last] = 0
        unknown = np.flatnonzero(numbers < 0)
        places = zip(starts[unknown].tolist(), ends[unknown].tolist())
        numbers[unknown] = [self._numbers[joined[start:end]] for start, end in places]
        new, where = np.unique(numbers[unknown], return_index=True)
        self._table.put(len(self._numbers), new, keys.take(unknown[where], axis=1))
        return [own[:-1] for own in np.split(numbers, last[:-1] + 1)]

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces with these numbers, one behind the other, and how many each has."""
        counts = self._counts.take(numbers)
        ends = np.cumsum(counts)
        at = np.repeat(self._starts.take(numbers) - ends + counts, counts)
        return self._flat.take(at + np.arange(len(at))), counts

    def _learn_numbered(self, known: int) -> None:
        new, self._numbers.new = self._numbers.new, []
        merged = [(self._added[p],) if p in self._added else self.merge(p) for p in new]
        counts = np.fromiter(map(len, merged), np.int64, len(new))
        ends, total = self._used + np.cumsum(counts), known + len(new)
        self._flat = room_for(self._flat, int(self._used + counts.sum()))
        self._starts, self._counts = room_for(self._starts, total), room_for(self._counts, total)
        self._again = room_for(self._again, total)
        start, self._used = self._used, self._used + int(counts.sum())
        self._flat[start : self._used] = np.fromiter(chain.from_iterable(merged), np.int32, self._used - start)
        self._starts[known:total], self._counts[known:total] = ends - counts, counts

    def _forget(self, used: np.ndarray) -> None:
        """Keep only pieces that came again, or if these are too many those just used, and number them anew."""
        kept = np.flatnonzero(self._again)
        if len(kept) > NUMBERED // 2:
            kept = np.unique(used)
        self._table.put(len(self._numbers), kept[:0], np.empty((3, 0), np.uint64))
        pieces = list(self._numbers)
        self._numbers = _Numbers(zip(map(pieces.__getitem__, kept.tolist()), range(len(kept))))
        self._table = PieceTable(self._table.keys.take(kept, axis=1))
        self._flat, self._counts = self._ids_of(kept)
        self._starts, self._used = np.cumsum(self._counts) - self._counts, len(self._flat)
        self._again = np.zeros(len(kept), bool)

    def count_all(self, texts: list[str | None]) -> list[int]:
        """The number of ids of every text. Only numbers are remembered, so a worker holds no id lists."""
        counts = []
        for text in texts:
            own = self._pieces_and_added(text or "")
            new = [piece for piece in set(own) if piece not in self._sizes]
            for piece in new:
                self._sizes[piece] = 1 if piece in self._added else self._size(piece)
            counts.append(sum(map(self._sizes.__getitem__, own)))
            if len(self._sizes) > REMEMBERED:
                # those of this text, and the later half: what was met lately is likely to be met again
                late = islice(self._sizes.items(), len(self._sizes) - REMEMBERED // 2, None)
                self._sizes = dict(late) | {piece: self._sizes[piece] for piece in set(own)}
        return counts

    def _size(self, piece: str) -> int:
        shown = piece.encode().decode("latin-1").translate(self._shown)
        return len(self._model.tokenize(shown)) if len(piece) <= self.leaf else len(self._merged(shown))

    def _pieces_and_added(self, text: str) -> list[str]:
        """The pieces in order. An added token is a piece of its own, which the pattern never makes of its text."""
        if not self._added_pattern or not self._added_pattern.search(text):
            return self.pieces(text)
        parts = self._added_pattern.split(text)
        return [p for part in parts for p in ([part] if part in self._added else self.pieces(part))]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(vocabulary: str | None, leaf_chars: int) -> ByteBpe:
    return ByteBpe(vocabulary or default_vocabulary(), leaf_chars)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(doc_id, ids) for every row, without a shuffle. A null text counts as empty; an empty text has no ids; a null id
    is passed on; repeated rows each get their row; an empty table gives an empty table; other columns are not looked
    at. `vocabulary` is a file that every executor can open; None names the installed one."""
    picked = _picked(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary, leaf_chars)
        for batch in batches:
            ids = bpe.encode_all(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids count as none. Bytes that are no UTF-8 become U+FFFD."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary, LEAF_CHARS)
        for batch in batches:
            texts = [bpe.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length): ids of each text and one more for its end. Cases as for `encode`."""
    picked = _picked(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(None, LEAF_CHARS)
        for batch in batches:
            lengths = [n + 1 for n in bpe.count_all(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64())], ["doc_id", "length"])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, length long")


def round_trip(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, of which only digests leave the
    worker. Cases as for `encode`."""
    picked = _picked(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary, leaf_chars)
        for batch in batches:
            encoded = bpe.encode_all(batch.column("text").to_pylist())
            spelled = (",".join(map(bpe.decimal.__getitem__, ids)).encode() for ids in encoded)
            decoded = (bpe.decode(ids).encode() for ids in encoded)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.fromiter(map(len, encoded), np.int64, len(encoded))),
                    pa.array([hashlib.sha256(x).hexdigest() for x in spelled], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
