"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rows import TEXTS, clashing, documents
from shopledger.llm.ranked_search import ImpactLists, Search, search

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL_SHARDS = Search(shard_documents=7, step=2, filter_bits=4)


def _terms(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _plain(texts, questions, k=50):
    rows = [(i, Counter(found)) for i, text in texts if (found := _terms(text))]
    n_docs, n_words = len(rows), sum(c.total() for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in questions:
        scored = []
        for i, counts in rows:
            m = 100 - 50 + 50 * counts.total() * n_docs // n_words
            score = 0
            for t in set(_terms(text)):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
            if score:
                scored.append((-score, i is None, i))
        out += [(item, n, i, -s) for n, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _questions(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def invented():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Straße", "ÉCOLE", "école", "日本"]
    weights = [1 / (1 + i) for i in range(len(words))]
    texts = [(i, " ".join(rnd.choices(words, weights, k=rnd.choice([1, 5, 30, 200])))) for i in range(300)]
    texts += [(400 + i, texts[5][1]) for i in range(120)]
    questions = [(n, " - ".join(rnd.choices(words, k=rnd.choice([1, 3, 12])))) for n in range(25)]
    return texts, questions


@pytest.mark.parametrize("options", [Search(), SMALL_SHARDS, Search(shard_documents=100, results=3)])
def test_results_equal_scores_of_all_documents(spark, invented, options):
    texts, questions = invented
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = _found(search(docs, _questions(spark, questions), options))
    assert found == _plain(texts, questions, options.results)


def test_hard_texts_and_questions(spark):
    texts = [r[:2] for r in TEXTS]
    questions = [(1, "The DOG is in the garden"), (1, "one two"), (2, None), (3, ""), (4, "???"), (None, "日本 x 1")]
    expected = _plain(texts, questions)
    docs, asked = documents(spark), _questions(spark, questions)
    assert _found(search(docs, asked)) == expected
    assert _found(search(clashing(docs), clashing(asked), SMALL_SHARDS)) == expected
    assert _found(search(documents(spark, []), asked)) == []
    assert _found(search(docs, _questions(spark, []))) == []


def _lists(counts):
    """Lists of documents of 100 terms each, from what each has of the terms."""
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(counts)), pa.int64()),
            pa.array([100] * len(counts), pa.int64()),
            pa.array([list(c) for c in counts], pa.list_(pa.string())),
            pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
        ],
        ["doc_id", "n", "terms", "counts"],
    )
    return ImpactLists([batch], len(counts), 100 * len(counts))


def test_reading_stops_at_best_positions_before_the_lists_end():
    rnd = random.Random(2)
    counts = []
    for i in range(4000):
        # where one term is frequent the other is as well, so the first positions of both lists hold the best
        level = rnd.randrange(1, 60)
        counts.append({"a": level, "b": max(1, level + rnd.randrange(-2, 3))})
    lists = _lists(counts)
    touched = []
    positions = lists.positions

    def watched(start, end):
        found = positions(start, end)
        touched.append(np.zeros(len(found), bool))

        class Reader:
            def __getitem__(self, key):
                touched[-1][key] = True
                return found[key]

        return Reader()

    lists.positions = watched
    found, scores = lists.search(["a", "b"], [5, 5], 50, 16)
    lists.positions = positions
    everything, all_scores = lists.search(["a", "b"], [5, 5], len(counts), 16)
    assert len(everything) == len(counts)
    assert found.tolist() == everything[:50].tolist() and scores.tolist() == all_scores[:50].tolist()
    assert touched[-1].sum() < 2000
    assert not lists.scored.any()
