"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are the 2- to 4-character parts of its words, word ends marked. Each has an embedding, found by a
hash; their mean goes through a linear layer and a softmax. As both are linear up to there, a trained model is folded
to one score for each bucket and language, and a text's scores are the mean over its subwords.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.tables import bounded_sample, small_batches

UNKNOWN = "und"
FOLDS = 5
#: An embedding sees only few of the subwords, and its share of their mean is small, so its steps are so much longer.
EMBED_RATE = 16.0


@dataclass(frozen=True)
class Training:
    """sample: documents the model is fitted on, at most twice as many; they are cut into lines of `chunk` characters
    at most, of which `steps` batches of `batch` are drawn. reject: share of rightly named held-back texts of the
    sample that the rejection threshold may cost; and of their lines, where the texts are too few to tell."""

    sample: int = 3000
    buckets: int = 1 << 16
    dimension: int = 8
    chunk: int = 120
    batch: int = 32
    steps: int = 2500
    rate: float = 0.5
    reject: float = 0.001
    seed: int = 5


@dataclass
class Model:
    languages: list[str]
    #: score by bucket and language, the language's own offset included
    table: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def subwords(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all texts, and the text that each belongs to. Repeats are kept.

    All but letters are word ends; one end stands between two words, and between two texts."""
    codes = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # lower-casing may change a text's length, so the ends of texts are found in what came out
    single = [len(t.lower()) for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.array(single, np.int64) + 1)[: len(codes)]
    codes = np.where(_letters()[codes], codes, 0)
    kept = np.empty(len(codes), bool)
    kept[:1] = True
    kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes, owner = codes[kept], owner[kept]
    codes = np.concatenate(([0], codes, [0])).astype(np.uint32) if len(codes) else codes
    owner = np.concatenate((owner[:1], owner, owner[-1:]))
    hashes, texts_of = [], []
    for n in (2, 3, 4):
        size = len(codes) - n + 1
        if size <= 0:
            continue
        inner = np.ones(size, bool)
        for k in range(1, n - 1):
            inner &= codes[k : k + size] != 0
        if n == 2:
            inner = (codes[:size] != 0) | (codes[1 : 1 + size] != 0)
        at = np.flatnonzero(inner)
        value = np.full(len(at), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            value = (value ^ codes[at + k]) * np.uint32(0x01000193)
            value ^= value >> np.uint32(15)
        hashes.append(value % np.uint32(buckets))
        # a part belongs to the text of its first letter, not of the word end before it
        texts_of.append(owner[at + (codes[at] == 0)])
    if not hashes:
        return np.empty(0, np.uint32), np.empty(0, np.int32)
    return np.concatenate(hashes), np.concatenate(texts_of)


def scores(texts: list[str], model: Model) -> np.ndarray:
    """Mean scores of each text by language; NaN for a text without letters."""
    buckets, owner = subwords(texts, len(model.table))
    count = np.bincount(owner, minlength=len(texts))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.stack(
            [
                np.bincount(owner, weights=model.table[buckets, k], minlength=len(texts)) / count
                for k in range(len(model.languages))
            ],
            axis=1,
        )


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and calibrated chance of each text; `und` and 0 for a null text, one without letters, or no model."""
    names, chances = [UNKNOWN] * len(texts), [0.0] * len(texts)
    at = [i for i, t in enumerate(texts) if t and has_letter(t)] if model.languages else []
    if at:
        chance = _softmax(scores([texts[i] for i in at], model) / model.temperature)
        for i, best, p in zip(at, chance.argmax(axis=1), chance.max(axis=1)):
            names[i], chances[i] = model.languages[best], float(p)
    return names, chances


def _chunks(text: str, size: int) -> list[str]:
    """Lines, the long ones cut at the space before `size` characters."""
    out = []
    for line in text.split("\n"):
        while len(line) > size:
            cut = line.rfind(" ", 1, size)
            cut = cut if cut > 0 else size
            out.append(line[:cut])
            line = line[cut:]
        out.append(line)
    return [c for c in out if has_letter(c)]


def fit(texts: list[str], languages: list[str], training: Training = Training()) -> Model:
    """Stochastic gradient descent on the chunks of the texts; every eighth text is held back for calibration."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((1, 0), np.float32))
    label_of = {name: i for i, name in enumerate(names)}
    parts: tuple[list[str], list[str]] = ([], [])
    labels: tuple[list[int], list[int]] = ([], [])
    whole: list[tuple[str, int]] = []
    for n, (text, language) in enumerate(zip(texts, languages)):
        held = n % 8 == 7
        if held and has_letter(text):
            whole.append((text, label_of[language]))
        for chunk in _chunks(text, training.chunk):
            parts[held].append(chunk)
            labels[held].append(label_of[language])
    rng = np.random.default_rng(training.seed)
    embed = rng.uniform(-1, 1, (training.buckets, training.dimension)).astype(np.float32) / training.dimension
    layer = np.zeros((training.dimension, len(names)), np.float32)
    offset = np.zeros(len(names), np.float32)
    gold, n_parts = np.array(labels[0], np.int64), len(parts[0])
    for step in range(training.steps if n_parts else 0):
        rate = training.rate * (1 - step / training.steps)
        pick = rng.integers(0, n_parts, training.batch)
        buckets, owner = subwords([parts[0][i] for i in pick], training.buckets)
        count = np.bincount(owner, minlength=len(pick)).astype(np.float32)
        held = embed[buckets]
        mean = np.stack([np.bincount(owner, weights=held[:, k], minlength=len(pick)) for k in range(held.shape[1])], 1)
        mean = (mean / np.maximum(count, 1)[:, None]).astype(np.float32)
        slope = _softmax(mean @ layer + offset)
        slope[np.arange(len(pick)), gold[pick]] -= 1
        back = (slope @ layer.T) / np.maximum(count, 1)[:, None]
        layer -= rate * (mean.T @ slope)
        offset -= rate * slope.mean(axis=0)
        order = np.argsort(buckets)
        first = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        embed[buckets[order[first]]] -= rate * EMBED_RATE * np.add.reduceat(back[owner[order]], first, axis=0)
    model = Model(names, (embed @ layer + offset).astype(np.float32))
    return _calibrated(model, parts[1], labels[1], whole, training.reject)


def _calibrated(
    model: Model, parts: list[str], labels: list[int], whole: list[tuple[str, int]], reject: float
) -> Model:
    """Temperature of least loss on the held-back chunks, and the threshold that costs a share `reject` of the rightly
    named held-back texts, as they are, whole. Texts are judged whole, but a few hundred of them don't show where the
    rarest lie; their chunks are many and score lower, so the threshold is not above what costs that share of them."""
    if not parts:
        return model
    raw, gold = scores(parts, model), np.array(labels, np.int64)
    grid = np.geomspace(0.02, 5, 60)

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(raw / t)[np.arange(len(gold)), gold], 1e-12)).mean())

    model.temperature = float(min(grid, key=loss))
    texts, names = zip(*whole)
    levels = []
    for raw, gold in ((raw, gold), (scores(list(texts), model), np.array(names, np.int64))):
        chance = _softmax(raw / model.temperature)
        right = chance.argmax(axis=1) == gold
        if right.any():
            levels.append(float(np.quantile(chance.max(axis=1)[right], reject)))
    model.threshold = min(levels, default=0.0)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    training: Training = Training(),
) -> Model:
    """A model fitted on a bounded sample of the rows with text and language outside the held-out fold; the driver
    sees that sample's texts and no others."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    ).filter(~held_out(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = bounded_sample(rows, training.sample, "id").select("text", "lang", F.xxhash64("id", "text").alias("at"))
    # in an order of its own, so that the model doesn't depend on the partitions
    taken = sorted(sample.collect(), key=lambda r: (r.at, r.text, r.lang))
    return fit([r.text for r in taken], [r.lang for r in taken], training)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row, from its whole text and nothing else, without a
    shuffle. `rejected` is true for `und` and for a score under the model's calibrated threshold.

    Defined cases: a text that is null or has no letters is `und` with score 0, as is every text if nothing could be
    learned; of equal scores the language first in alphabetical order wins; repeated rows each get their row; an empty
    table gives an empty table; a null id counts as held out; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    picked = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, chances = predict(batch.column("text").to_pylist(), model)
            refused = [n == UNKNOWN or p < model.threshold for n, p in zip(names, chances)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(chances, pa.float64()),
                    pa.array(refused, pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
