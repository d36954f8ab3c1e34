"""Secrets in texts: plain patterns, and a linear-chain conditional random field over tokens.

The field tags every token of a text, words included, as outside, begin or inside of a secret, from its shape, the
tokens next to it, how far behind a word such as "password" it stands, and features of the whole text. The best path
is that of the whole text. Where a bound on the scores proves that the best path is outside, it isn't searched for.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.tables import bounded_sample, small_batches

#: Kinds in the order that decides between spans of equal start.
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by start and then kind. A match whose value is too short is passed over, but what
    it covers is used up."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# tokens

#: Tokens are runs of anything but white space and quotes; what is between them is a gap.
_GAP = re.compile(r"""([\s"'`]+)""")
#: Marks around a token that its span leaves out, if there is anything else.
_OPENS, _CLOSES = "([{<,;", ".,;:)]}>"
_ASKS = re.compile(
    r"(?:\A|[^a-z])(?:pass|pwd|pass_?(?:word|wd|phrase|code)|phrase|secret|token|key|api_?key|credentials?|bearer)\W{0,3}\Z"
)
_MARK = re.compile(r"\W{0,3}\Z")
#: Tokens behind an asking word, on its line, that are told apart by their distance and the quotes between.
REACH = 9

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
BUCKETS = 1 << 16


def split(text: str) -> tuple[list[str], list[str]]:
    """Tokens of a text, and the gaps before, between and behind them, one more than tokens."""
    parts = _GAP.split(text)
    words, gaps = parts[::2], ["", *parts[1::2], ""]
    if not words[-1]:
        words.pop(), gaps.pop()
    if words and not words[0]:
        words.pop(0), gaps.pop(0)
    return words, gaps


def places(words: list[str], gaps: list[str]) -> list[tuple[int, int]]:
    """Start and end of each token, without the marks around it."""
    out, at = [], 0
    for gap, word in zip(gaps, words):
        at += len(gap)
        core = word.lstrip(_OPENS).rstrip(_CLOSES)
        start = at + len(word) - len(word.lstrip(_OPENS)) if core else at
        out.append((start, start + len(core or word)))
        at += len(word)
    return out


def _entropy(token: str) -> float:
    n = len(token)
    return math.log2(n) - sum(c * math.log2(c) for c in map(token.count, set(token)) if c > 1) / n


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


#: For names of which there are few.
_few = lru_cache(maxsize=1 << 14)(_feature)


def file_features(words: list[str], text: str) -> list[int]:
    lines = text.count("\n") + 1
    names = (
        f"file:tokens{min(len(words).bit_length(), 12)}",
        f"file:settings{min(4 * (text.count('=') + text.count(': ')) // lines, 4)}",
        f"file:key{'PRIVATE KEY' in text}",
    )
    return [_feature(name) for name in names]


def word_features(raw: str) -> tuple[list[int], list[int], list[int], list[int], bool]:
    """Features that a token has by its shape, that it gives to the token behind it, to the one after that and to the
    token before it, always as many of each; and whether it asks for a secret."""
    word = raw.lstrip(_OPENS).rstrip(_CLOSES) or raw
    lower = raw.lower()
    plain = word.isalpha()
    kinds = "".join(
        mark
        for mark, there in (
            ("A", word != word.lower()),
            ("a", word != word.upper()),
            ("9", not plain and any("0" <= c <= "9" for c in word)),
            ("+", not plain and any(c in "+/=" for c in word)),
            ("_", not plain and any(c in "_.-" for c in word)),
            ("!", not plain and any(c in "!#$%&*?@^~|" for c in word)),
            ("u", not word.isascii()),
        )
        if there
    )
    hexadecimal = all(c in "0123456789abcdef" for c in word.lower())
    switches = 0 if plain else sum((a.isdigit()) != (b.isdigit()) for a, b in zip(word, word[1:]))
    humps = 0 if word[1:] == word[1:].lower() else sum(a.islower() and b.isupper() for a, b in zip(word, word[1:]))
    shape = (
        f"kinds:{kinds}",
        f"length:{min(len(word) // 4, 12)}",
        f"kinds+length:{kinds}{min(len(word) // 8, 6)}",
        f"hex:{hexadecimal}:{min(len(word) // 8, 6)}",
        f"entropy:{int(2 * _entropy(word[:256]))}",
        f"switches:{min(switches, 8)}",
        f"humps:{min(humps, 4)}",
    )
    asks = bool(_ASKS.search(lower[-24:]))
    mark = _MARK.search(lower)[0]
    return (
        [*map(_few, shape), _few(f"prefix:{word[:4]}")],
        [_feature(f"before:{lower[-16:]}"), _few(f"before+mark:{asks}{mark}")],
        [_feature(f"second before:{lower[-16:]}"), _few(f"second before asks:{asks}")],
        [_feature(f"after:{lower[:16]}")],
        asks,
    )


#: What a character says about a token that holds it; the first ones in the order of the marks of `kinds`.
_UPPER, _LOWER, _DIGIT, _SUM, _JOINT, _SIGN, _WIDE, _NO_HEX, _IS_LOWER, _IS_UPPER, _IS_DIGIT, _PUNCTUATION = (
    1 << bit for bit in range(12)
)
_KNOWN = 1 << 15
_KINDS = 1 << 7
#: By code point, filled in as characters are met; 0 is one not met yet.
_CHARACTERS = np.zeros(0x110000, np.uint16)


def _character(c: str) -> int:
    says = (
        (_UPPER, c != c.lower()),
        (_LOWER, c != c.upper()),
        (_DIGIT, "0" <= c <= "9"),
        (_SUM, c in "+/="),
        (_JOINT, c in "_.-"),
        (_SIGN, c in "!#$%&*?@^~|"),
        (_WIDE, not c.isascii()),
        (_NO_HEX, any(x not in "0123456789abcdef" for x in c.lower())),
        (_IS_LOWER, c.islower()),
        (_IS_UPPER, c.isupper()),
        (_IS_DIGIT, c.isdigit()),
        (_PUNCTUATION, not (c.isalnum() or c == "_")),
    )
    return _KNOWN + sum(flag for flag, there in says if there)


def _characters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text, and what each says."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    flags = _CHARACTERS[points]
    new = points[flags == 0]
    if len(new):
        for point in set(new.tolist()):
            _CHARACTERS[point] = _character(chr(point))
        flags = _CHARACTERS[points]
    return points, flags


def _half_bits(words: list[str], points: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """int(2 * _entropy(word[:256])) of every word."""
    kept = np.minimum(lengths, 256)
    n = np.repeat(np.arange(len(words)), kept)
    at = np.arange(len(n)) + (starts - (np.cumsum(kept) - kept))[n]
    keys = np.sort(n << 21 | points[at])
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(first, append=len(keys))
    more = counts > 1
    terms = np.bincount(keys[first[more]] >> 21, counts[more] * np.log2(counts[more]), len(words))
    halves = 2 * (np.log2(kept) - terms / kept)
    out = halves.astype(np.int64)
    # rounding decides next to a whole number, so there the sum is done as it is for a single word
    for i in np.flatnonzero(np.abs(halves - np.rint(halves)) < 1e-9):
        out[i] = round(halves[i]) if not terms[i] and not kept[i] & kept[i] - 1 else int(2 * _entropy(words[i][:256]))
    return out


def _table(names: Iterable[str]) -> np.ndarray:
    return np.array([_feature(name) for name in names])


_MARKS = ["".join(mark for bit, mark in enumerate("Aa9+_!u") if kinds >> bit & 1) for kinds in range(_KINDS)]
_KIND = _table(f"kinds:{marks}" for marks in _MARKS)
_LENGTH = _table(f"length:{n}" for n in range(13))
_KIND_LENGTH = _table(f"kinds+length:{marks}{n}" for marks in _MARKS for n in range(7)).reshape(_KINDS, 7)
_HEXADECIMAL = _table(f"hex:{there}:{n}" for there in (False, True) for n in range(7)).reshape(2, 7)
_ENTROPY = _table(f"entropy:{n}" for n in range(17))
_SWITCHES = _table(f"switches:{n}" for n in range(9))
_HUMPS = _table(f"humps:{n}" for n in range(5))
_PLAIN_END = _table(f"before+mark:{asks}" for asks in (False, True))
_SECOND_ASKS = _table(f"second before asks:{asks}" for asks in (False, True))
_BEFORE, _SECOND, _AFTER, _PREFIX = (zlib.crc32(name) for name in (b"before:", b"second before:", b"after:", b"prefix:"))
#: By length in bytes: how the checksums of a text behind one name and behind another differ, whatever the text is.
_SECOND_BEFORE, _AFTER_BEFORE = (
    np.array([zlib.crc32(bytes(n), name) ^ zlib.crc32(bytes(n), _BEFORE) for n in range(4 * 16 + 1)]) for name in (_SECOND, _AFTER)
)
#: Words of `_ASKS` at the ends of lines.
_ASKS_IN_LINES = re.compile(_ASKS.pattern.replace(r"\A", "^").replace(r"\W{0,3}\Z", r"[^\w\n]{0,3}$"), re.M)


def _spelled(texts: list[str]) -> list[bytes]:
    try:
        return [text.encode() for text in texts]
    except UnicodeEncodeError:
        return [text.encode("utf-8", "surrogatepass") for text in texts]


def _hashed(texts: list[bytes], name: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, texts, repeat(name)), np.int64, len(texts))


def all_word_features(raws: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """What `word_features` says of every word, none of them empty or with white space: features by role, one row for
    each word, and whether it asks."""
    words = [raw.lstrip(_OPENS).rstrip(_CLOSES) or raw for raw in raws]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points, flags = _characters("".join(words))
    any_of = np.bitwise_or.reduceat(flags, starts)
    kinds = (any_of & _KINDS - 1).astype(np.int64)
    hexadecimal = (any_of & _NO_HEX == 0).astype(np.int64)

    def pairs(there: np.ndarray) -> np.ndarray:
        """Number of places by word, of those where two characters of the text meet; not those between words."""
        there[ends[:-1] - 1] = False
        return np.add.reduceat(np.append(there, False), starts, dtype=np.int64)

    digit, lower, upper = flags & _IS_DIGIT != 0, flags & _IS_LOWER != 0, flags & _IS_UPPER != 0
    switches = pairs(digit[1:] != digit[:-1])
    humps = pairs(lower[:-1] & upper[1:])
    # there are letters that count as upper case but have no lower case; alone they make no hump
    humps[pairs(flags[1:] & _UPPER != 0) == 0] = 0
    quarter = np.minimum(lengths // 4, 12)
    eighth = quarter // 2

    lowers = [raw.lower() for raw in raws]
    tails = [low[-16:] for low in lowers]
    asks = np.zeros(len(raws), np.int64)
    lines = np.cumsum(np.fromiter(map(len, tails), np.int64, len(tails)) + 1)
    found = [match.end() for match in _ASKS_IN_LINES.finditer("\n".join(tails))]
    asks[np.searchsorted(lines, found, side="right")] = 1
    marked = _PLAIN_END[asks]
    last = _characters("".join([low[-1] for low in lowers]))[1]
    for i in np.flatnonzero(last & _PUNCTUATION):
        marked[i] = _few(f"before+mark:{bool(asks[i])}{_MARK.search(tails[i])[0]}")

    spelled = _spelled(tails)
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
    before = _hashed(spelled, _BEFORE)
    after = before ^ _AFTER_BEFORE[sizes]
    long = np.flatnonzero(np.fromiter(map(len, lowers), np.int64, len(lowers)) > 16)
    after[long] = _hashed(_spelled([lowers[i][:16] for i in long]), _AFTER)
    prefix = _hashed(_spelled([word[:4] for word in words]), _PREFIX)
    shape = (
        _KIND[kinds],
        _LENGTH[quarter],
        _KIND_LENGTH[kinds, eighth],
        _HEXADECIMAL[hexadecimal, eighth],
        _ENTROPY[_half_bits(words, points, lengths, starts)],
        _SWITCHES[np.minimum(switches, 8)],
        _HUMPS[np.minimum(humps, 4)],
        prefix % BUCKETS,
    )
    second = before ^ _SECOND_BEFORE[sizes]
    roles = (shape, (before % BUCKETS, marked), (second % BUCKETS, _SECOND_ASKS[asks]), (after % BUCKETS,))
    return [np.stack(role, axis=1) for role in roles], asks.astype(bool)


def gap_features(gap: str) -> tuple[int, int]:
    """Features that a gap gives to the token behind it and to the one before it."""
    kind = re.sub(r"[^\S\n]+", " ", gap)[:4]
    return _feature(f"gap before:{kind}"), _feature(f"gap behind:{kind}")


def _quotes(gap: str) -> int:
    return sum(map(gap.count, "\"'`"))


_ASK_FEATURES = np.array([[_feature(f"asked:{d}:{q}") for q in range(3)] for d in range(REACH + 1)])


def _asked(asks: np.ndarray, quotes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each token from the asking token before it, 0 if there is none in reach and on its line, and the
    quotes between them, two at most. quotes and breaks are of the gap before each token."""
    at = np.arange(len(asks))
    last = np.maximum.accumulate(np.where(asks, at, -1))
    last = np.concatenate(([-1], last[:-1]))
    lines, seen = np.cumsum(breaks), np.cumsum(quotes)
    near = (last >= 0) & (at - last <= REACH) & (lines == lines[last])
    return np.where(near, at - last, 0), np.where(near, np.minimum(seen - seen[last], 2), 0)


#: Tokens and gaps that a reader remembers; beyond, it forgets the tokens that came in one batch only, and all gaps.
REMEMBERED = 200_000
_END = ""


class Reader:
    """Scores of the tokens of texts; what a token adds to them by itself is remembered."""

    def __init__(self, field: "Field"):
        self.field = field
        self._weights = field.weights.astype(np.float64)
        self._asked = self._weights[_ASK_FEATURES.ravel()]
        self._forget()

    def _forget(self) -> None:
        self._word: dict[str, int] = {}
        #: by word: what it adds to its own scores, to those of the next two tokens and to those before it
        self._own = [np.empty((0, 3)) for _ in range(4)]
        self._asks = np.empty(0, bool)
        # whether it came again in a later batch, since some were last forgotten
        self._again = np.empty(0, bool)
        self._forget_gaps()

    def _forget_gaps(self) -> None:
        self._gap: dict[str, int] = {}
        self._beside = [np.empty((0, 3)) for _ in range(2)]
        self._quotes = np.empty(0, np.int64)
        self._breaks = np.empty(0, bool)

    def _forget_some(self) -> None:
        kept = np.flatnonzero(self._again)
        if len(kept) > REMEMBERED // 2:
            kept = kept[:0]
        words = list(self._word)
        self._word = {words[i]: n for n, i in enumerate(kept.tolist())}
        self._own = [own[kept] for own in self._own]
        self._asks, self._again = self._asks[kept], np.zeros(len(kept), bool)

    def learn(self, texts: list[tuple[list[str], list[str]]]) -> None:
        if len(self._word) > REMEMBERED:
            self._forget_some()
        if len(self._gap) > REMEMBERED:
            self._forget_gaps()
        weights = self.field.weights
        used = {_END}.union(*(words for words, _ in texts))
        new = used - self._word.keys()
        old = used - new
        self._again[np.fromiter(map(self._word.__getitem__, old), np.int64, len(old))] = True
        if new:
            found, asks = all_word_features([word or "\x00" for word in new])
            self._word.update(zip(new, range(len(self._word), len(self._word) + len(new))))
            for role, features in enumerate(found):
                own = sum(self._weights.take(column, axis=0) for column in features.T)
                self._own[role] = np.concatenate([self._own[role], own])
            self._asks = np.concatenate([self._asks, asks])
            self._again = np.concatenate([self._again, np.zeros(len(asks), bool)])
        gaps = set().union(*(gaps for _, gaps in texts)) - self._gap.keys()
        if gaps:
            self._gap.update(zip(gaps, range(len(self._gap), len(self._gap) + len(gaps))))
            both = np.array([gap_features(gap) for gap in gaps])
            for side in range(2):
                self._beside[side] = np.concatenate([self._beside[side], weights[both[:, side]].astype(np.float64)])
            self._quotes = np.concatenate([self._quotes, [_quotes(gap) for gap in gaps]])
            self._breaks = np.concatenate([self._breaks, ["\n" in gap for gap in gaps]])

    def scores(self, words: list[str], gaps: list[str], text: str) -> np.ndarray:
        """Scores of the tags of every token; of texts that `learn` has been given."""
        n, number, end = len(words), self._word.__getitem__, self._word[_END]
        ids = np.fromiter((end, end, *map(number, words), end), np.int64, n + 3)
        beside = np.fromiter(map(self._gap.__getitem__, gaps), np.int64, n + 1)
        shape, before, second, after = self._own
        out = shape.take(ids[2:-1], axis=0) + before.take(ids[1:-2], axis=0)
        out += second.take(ids[:-3], axis=0) + after.take(ids[3:], axis=0)
        out += self._beside[0].take(beside[:-1], axis=0) + self._beside[1].take(beside[1:], axis=0)
        far, between = _asked(self._asks[ids[2:-1]], self._quotes[beside[:-1]], self._breaks[beside[:-1]])
        out += self._asked.take(3 * far + between, axis=0)
        return out + self.field.weights[file_features(words, text)].sum(axis=0, dtype=np.float64)


# the field


@dataclass
class Field:
    """Weights of features by tag, and of tags after tags; inside can't follow outside."""

    weights: np.ndarray
    steps: np.ndarray

    @staticmethod
    def empty() -> "Field":
        # without any training every token is outside
        weights = np.zeros((BUCKETS, 3), np.float32)
        steps = np.zeros((3, 3))
        steps[:, (BEGIN, INSIDE)] = -1.0
        steps[OUTSIDE, INSIDE] = -np.inf
        return Field(weights, steps)

    def scores(self, tokens: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[t].sum(axis=0) for t in tokens], np.float64)

    def viterbi(self, emit: np.ndarray) -> list[int]:
        """The best tags of a run with outside on both ends; of equal paths the one with smaller tags."""
        best, back = self.steps[OUTSIDE] + emit[0], []
        for row in emit[1:]:
            through = best[:, None] + self.steps
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        tags = [int((best + self.steps[:, OUTSIDE]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def path(self, emit: np.ndarray) -> list[tuple[int, int]]:
        """Place and tag of the tokens of a text that the best path has not outside.

        Against the path that is outside throughout, a stretch of other tags gains at most the sum of its tokens'
        bounds. So a token is outside if no stretch over it has a sum above 0, and only what is left is searched.
        """
        steps = self.steps - self.steps[OUTSIDE, OUTSIDE]
        most = (emit - emit[:, :1] + steps.max(axis=0) + np.maximum(steps[:, OUTSIDE], 0))[:, 1:].max(axis=1)
        total = np.cumsum(most)
        before = np.concatenate(([0.0], total[:-1]))
        ending = total - np.minimum.accumulate(before)
        starting = np.maximum.accumulate(total[::-1])[::-1] - before
        # the margin is for sums that are rounded
        left = np.flatnonzero(ending + starting - most > -1e-6)
        out = []
        for part in np.split(left, np.flatnonzero(np.diff(left) > 1) + 1):
            if len(part):
                tags = self.viterbi(emit[part])
                out += [(int(at), tag) for at, tag in zip(part, tags) if tag != OUTSIDE]
        return out

    def marginals(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Chances of each token's tags, expected number of each step between tags (the ends included), and log of the
        sum over all paths."""
        n = len(emit)
        ahead, behind = np.empty((n, 3)), np.empty((n, 3))
        ahead[0] = self.steps[OUTSIDE] + emit[0]
        for i in range(1, n):
            ahead[i] = np.logaddexp.reduce(ahead[i - 1][:, None] + self.steps, axis=0) + emit[i]
        behind[-1] = self.steps[:, OUTSIDE]
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp.reduce(self.steps + (emit[i + 1] + behind[i + 1])[None, :], axis=1)
        total = float(np.logaddexp.reduce(ahead[-1] + behind[-1]))
        single = np.exp(ahead + behind - total)
        pairs = np.zeros((3, 3))
        for i in range(n - 1):
            pairs += np.exp(ahead[i][:, None] + self.steps + (emit[i + 1] + behind[i + 1])[None, :] - total)
        pairs[OUTSIDE] += single[0]
        pairs[:, OUTSIDE] += single[-1]
        return single, pairs, total


@dataclass(frozen=True)
class Training:
    """sample: documents the field is fitted on, at most twice as many; drop: chance that one group of a token's
    features is hidden in a step, so that no group is relied on alone; window: tokens of a chain to be fitted; plain,
    digits: chains at most without a secret, anywhere and around digits; rows: lines made up with secrets that the
    patterns miss, and half as many without one; the rest is plain gradient descent."""

    sample: int = 4000
    epochs: int = 6
    rate: float = 0.2
    decay: float = 1e-4
    drop: float = 0.3
    seed: int = 11
    window: int = 16
    plain: int = 2000
    digits: int = 1500
    rows: int = 1000


_NAMES = ("password", "Password", "passwd", "pwd", "passphrase", "pass phrase", "secret", "api key", "access key", "token", "credential")
_PROSE = ("the password was", "a token of", "the key to the", "this secret", "bearer of", "to pass the", "a phrase that", "the credentials of")
_WORDS = "correct horse battery staple river orange window silver garden purple mountain yellow candle coffee".split()
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def made_up(rng: np.random.Generator, words: list[str]) -> tuple[str, list[tuple[int, int]]]:
    """A line with a secret that has no digit, other symbols, 6 or 7 characters or several tokens; `words` around."""

    def some(of, least: int, most: int) -> list[str]:
        return [of[i] for i in rng.integers(len(of), size=rng.integers(least, most + 1))]

    kind = rng.integers(5)
    quote = ("", '"', "'")[rng.integers(3)]
    tail = some(words, 1, 6)
    if kind == 0:
        value = "".join(some(_LETTERS, 12, 24))
    elif kind == 1:
        value = "".join(some(_LETTERS[26:], 2, 4) + some("@!$%#&", 1, 1) + some(_LETTERS[26:], 1, 3) + some("!@$0134", 1, 2) + some(_LETTERS, 2, 4))
    elif kind == 2:
        value = "".join(some(_LETTERS[26:], 4, 5) + some("0123456789", 2, 2))
    elif kind == 3:
        value = " ".join(some([*_WORDS, *words], 3, 6))
        quote = quote or '"'
    else:
        value = " ".join("".join(some(_LETTERS + "0123456789", 4, 6)) for _ in range(rng.integers(2, 6)))
        tail = tail if quote else []
    name = _NAMES[rng.integers(len(_NAMES))]
    join = (" = ", ": ", " is ", " := ")[rng.integers(4)]
    if kind == 0 and rng.random() < 0.4:
        name, join, quote = ("Bearer", "Authorization: Bearer")[rng.integers(2)], " ", ""
    head = " ".join([*some(words, 0, 6), name]) + join + quote
    return head + value + quote + " " + " ".join(tail), [(len(head), len(head) + len(value))]


def taught_spans(text: str) -> list[tuple[int, int]]:
    """What the plain patterns cover, of an assignment the value only."""
    found = [m.span(1) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    return found + [m.span() for pattern in (_ACCESS, _HEX) for m in pattern.finditer(text)]


def _chain(words: list[str], gaps: list[str], text: str) -> list[dict[str, list[int]]]:
    """Features of every token by group: its shape, its neighbours, its file."""
    of = [word_features(word) for word in words]
    end, beside = word_features("\x00"), [gap_features(gap) for gap in gaps]
    breaks = np.array(["\n" in gap for gap in gaps[:-1]])
    far, between = _asked(np.array([f[4] for f in of]), np.array([_quotes(gap) for gap in gaps[:-1]]), breaks)
    of_file, padded = file_features(words, text), [end, end, *of, end]
    return [
        {
            "shape": own[0],
            "near": [*padded[i + 1][1], *padded[i][2], *padded[i + 3][3], beside[i][0], beside[i + 1][1], int(_ASK_FEATURES[far[i], between[i]])],
            "file": of_file,
        }
        for i, own in enumerate(of)
    ]


def _tags(words: list[str], gaps: list[str], spans: list[tuple[int, int]]) -> list[int]:
    """Begin or inside where a token overlaps a span; inside where the token before overlaps the same one."""
    tags, held, spans = [], None, sorted(spans)
    own = places(words, gaps)
    for start, end in own:
        over = next((s for s in spans if s[0] < end and start < s[1]), None)
        tags.append(OUTSIDE if over is None else INSIDE if over == held else BEGIN)
        held = over
    return tags


def teach(texts: list[str | None], training: Training = Training()) -> Field:
    """A field fitted to the tags that the plain patterns give, and to lines made up with secrets that they miss.

    Of texts only stretches are fitted: all around a span, and some of the others.
    """
    rng, half = np.random.default_rng(training.seed), training.window // 2
    chosen: dict[str, list[tuple[int, int]]] = {"spans": [], "digits": [], "plain": []}
    held = []
    for text in texts:
        words, gaps = split(text or "")
        if not words:
            continue
        spans = taught_spans(text)
        tags = _tags(words, gaps, spans) if spans else [OUTSIDE] * len(words)
        held.append((words, gaps, text, tags))
        n, number = len(held) - 1, [i for i, word in enumerate(words) if any("0" <= c <= "9" for c in word)]
        chosen["spans"] += [(n, i) for i, tag in enumerate(tags) if tag == BEGIN]
        chosen["digits"] += [(n, i) for i in number if not tags[i]][:20]
        chosen["plain"] += [(n, int(i)) for i in rng.integers(len(words), size=3)]
    for name, most in (("digits", training.digits), ("plain", training.plain)):
        if len(chosen[name]) > most:
            chosen[name] = [chosen[name][i] for i in rng.choice(len(chosen[name]), most, replace=False)]
    chains = []
    for n, at in chain.from_iterable(chosen.values()):
        words, gaps, text, tags = held[n]
        first, last = max(0, at - half), min(len(words), at + half)
        # a stretch starts and ends outside
        while first and tags[first] != OUTSIDE:
            first -= 1
        while last < len(words) and tags[last - 1] != OUTSIDE:
            last += 1
        around = slice(max(0, first - REACH), last + 1)
        features = _chain(words[around], gaps[around.start : last + 2], text)
        skip = first - around.start
        chains.append((features[skip : skip + last - first], tags[first:last]))
    common = [words[i] for words, *_ in held[:2000] for i in rng.integers(len(words), size=2)] or _WORDS
    for n in range(training.rows + training.rows // 2):
        text, spans = made_up(rng, common)
        if n >= training.rows:
            pick = [common[i] for i in rng.integers(len(common), size=8)]
            text, spans = " ".join([*pick[:3], _PROSE[n % len(_PROSE)], *pick[3:]]), []
        words, gaps = split(text)
        if words:
            chains.append((_chain(words, gaps, text), _tags(words, gaps, spans)))
    field = Field.empty()
    for epoch in range(training.epochs):
        rate = training.rate / (1 + epoch)
        for at in rng.permutation(len(chains)):
            groups, tags = chains[at]
            hidden = ("shape", "near", "file")[rng.integers(3)] if rng.random() < training.drop else ""
            tokens = [[f for k, v in g.items() if k != hidden for f in v] for g in groups]
            single, pairs, _ = field.marginals(field.scores(tokens))
            gold = np.eye(3)[tags]
            for token, step in zip(tokens, gold - single):
                field.weights[token] += rate * step
            seen = np.zeros((3, 3))
            for a, b in zip([OUTSIDE, *tags], [*tags, OUTSIDE]):
                seen[a, b] += 1
            field.steps += rate * np.where(np.isinf(field.steps), 0, seen - pairs)
        field.weights *= 1 - training.decay
    return field


def _covered(span: Span, base: list[Span]) -> bool:
    """Whether base spans, which are in order of their start and may overlap, cover the whole span together."""
    _, at, end = span
    for _, start, stop in base:
        if start <= at < stop:
            at = stop
    return at >= end


def all_spans(texts: list[str], reader: Reader) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and all spans: those and what the field finds that they don't cover, by start
    and then kind."""
    cut = [split(text) for text in texts]
    reader.learn(cut)
    out = []
    for text, (words, gaps) in zip(texts, cut):
        base = base_spans(text)
        tagged = reader.field.path(reader.scores(words, gaps, text)) if words else []
        found: list[Span] = []
        if tagged:
            own = places(words, gaps)
            for at, tag in tagged:
                start, end = own[at]
                if tag == INSIDE:
                    start = found.pop()[1]
                found.append(("crf", start, end))
        beside = [f for f in found if not _covered(f, base)]
        out.append((base, sorted(base + beside, key=lambda s: (s[1], KINDS.index(s[0])))))
    return out


def secret_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of one text."""
    return all_spans([text], Reader(field))[0]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def train(docs: DataFrame, text_col: str = "text", training: Training = Training()) -> Field:
    """A field fitted on a bounded sample of `docs`; the driver sees that sample's texts and no others."""
    text = F.col(f"`{text_col}`").alias("text")
    texts = bounded_sample(docs.select(text).filter("text is not null"), training.sample, "text").collect()
    return teach([row.text for row in texts], training)


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans, redacted) for every row, without a shuffle.

    Places are in code points, ends exclusive; `redacted` is the text with every span, overlapping ones as one,
    replaced by [SECRET], and null where there is none.

    Defined cases: a null or empty text has no spans; a null id is passed on; repeated rows each get their row; an
    empty table gives an empty table; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(field)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = all_spans(texts, reader)
            counts = {
                f"n_{kind}": pa.array([sum(s[0] == kind for s in spans) for _, spans in found], pa.int64())
                for kind in KINDS
            }
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id")}
                | counts
                | {
                    "base_sha256": pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], pa.string()),
                    "spans": pa.array([joined(spans) for _, spans in found], pa.string()),
                    "redacted": pa.array([redacted(t, s) if s else None for t, (_, s) in zip(texts, found)], pa.string()),
                }
            )

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string, "
        "redacted string",
    )


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
