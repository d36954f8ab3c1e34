"""Ranked lexical search by the Best Position Algorithm over impact lists.

A query term's list holds the documents with the term by falling impact. The lists of a question are read side by side;
whatever document turns up is looked up in all the other lists at once (direct access), which marks its positions there
as seen too. The best position of a list is the last of the stretch from its start that is seen without a gap, whoever
saw it. A document not met yet stands behind the best position of every list, so the sum of the impacts there bounds
its score. That bound is no looser than the one at the last positions read, and reading stops as soon as it lies
strictly below the k-th score found.

Documents are dealt to shards of bounded size; a shard keeps lists of its own documents only, and its best rows for
every question are merged with those of the other shards.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.llm.shards import answers, asked_of_all, dealt
from shopledger.llm.tables import small_batches, written

#: A term: the longest stretch of ASCII letters, ASCII digits and characters beyond ASCII (their UTF-8 bytes).
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Fixed values of the impact: its length normalisation per hundred, its saturation, and its whole-number scale.
LENGTH_SHARE, SATURATION, SCALE, WEIGHT_SCALE = 50, 20, 1_000_000_000, 1000


@dataclass(frozen=True)
class Search:
    """Shards hold about so many documents and postings; `filter_bits` is the size of the filter on terms, whatever the
    number of questions. Lists are read `step` positions at first, then twice as many each time."""

    results: int = 50
    shard_documents: int = 16_384
    shard_postings: int = 2_000_000
    filter_bits: int = 20
    step: int = 64


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, only A-Z lower-cased."""
    return TERM.findall(text.lower()) if text else []


def _place(term: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - bits)


def question_terms(questions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(question, item_id, term) for the different terms of every question; `question` numbers the rows."""
    rows = questions.select(
        F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    ).withColumn("question", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(text))) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("question"),
                    batch.column("item_id"),
                    pa.array([[t.decode() for t in own] for own in found], pa.list_(pa.string())),
                ],
                ["question", "item_id", "terms"],
            )

    listed = rows.mapInArrow(run, "question long, item_id long, terms array<string>")
    return listed.select("question", "item_id", F.explode("terms").alias("term"))


def term_filter(terms: DataFrame, bits: int) -> bytes:
    """A bitmap of 2^bits places, those of the given terms set: whatever its size, a term whose place is not set is none
    of them. The places are found by tasks; the driver gathers at most 2^bits of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {_place(t.encode(), bits) for t in batch.column("term").to_pylist()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["place"])

    places = terms.select("term").distinct().mapInArrow(run, "place int").distinct().toArrow().column("place")
    marked = np.zeros(1 << bits, np.uint8)
    marked[places.to_numpy()] = 1
    return np.packbits(marked).tobytes()


def document_terms(docs: DataFrame, wanted: bytes, bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, n, terms, counts) of every document with a term: n of all its terms with repeats, and those terms
    that the filter lets pass, each with its number of occurrences. No shuffle."""
    small_batches(docs.sparkSession)
    picked = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(wanted, np.uint8)).astype(bool)
        known: dict[bytes, str | None] = {}  # what a term becomes; emptied now and then, so it stays bounded

        def passed(term: bytes) -> str | None:
            if term not in known:
                if len(known) >= 200_000:
                    known.clear()
                known[term] = term.decode() if marked[_place(term, bits)] else None
            return known[term]

        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = terms_of(text)
                if found:
                    own = [(p, c) for t, c in Counter(found).items() if (p := passed(t)) is not None]
                    ids.append(doc_id)
                    lengths.append(len(found))
                    terms.append([t for t, _ in own])
                    counts.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.string())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    found = picked.mapInArrow(run, "doc_id long, n long, terms array<string>, counts array<long>")
    return found.withColumn("row", F.monotonically_increasing_id())


def _seen_up_to(seen: np.ndarray, start: int) -> int:
    """The first place from `start` on that is not seen."""
    if start == len(seen):
        return start
    gap = int(seen[start:].argmin())
    return len(seen) if seen[start + gap] else start + gap


class ImpactLists:
    """The lists of one shard. Impacts here are without the term's weight, which doesn't change the order of a list."""

    def __init__(self, batches: list[pa.RecordBatch], documents: int, words: int):
        """`documents` and `words`: of the whole table, as the length normalisation asks for."""
        table = pa.Table.from_batches(batches)
        lengths = table.column("n").to_numpy()
        missing = table.column("doc_id").is_null().to_numpy()
        ids = table.column("doc_id").fill_null(0).to_numpy()
        # documents are numbered by falling preference among equal scores: smaller ids first, those without an id last
        order = np.lexsort((ids, missing))
        self.ids, self.missing = ids[order], missing[order]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        listed = table.column("terms").combine_chunks()
        per_document = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(listed.flatten())
        counts = table.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        length = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * documents) // words
        impact = (SCALE * counts) // (WEIGHT_SCALE * counts + SATURATION * np.repeat(length, per_document))
        owner = np.repeat(number, per_document).astype(np.int32)
        term = coded.indices.to_numpy(zero_copy_only=False)
        place = np.lexsort((owner, -impact, term))
        self.documents, self.impacts = owner[place], impact[place]
        bounds = np.searchsorted(term[place], np.arange(len(coded.dictionary) + 1)).tolist()
        self.lists = {t: (bounds[k], bounds[k + 1]) for k, t in enumerate(coded.dictionary.to_pylist())}
        self.scored = np.zeros(len(ids), bool)

    def positions(self, start: int, end: int) -> np.ndarray:
        """For every document its position in a list, -1 if it isn't there: what direct access reads."""
        found = np.full(len(self.ids), -1, np.int32)
        found[self.documents[start:end]] = np.arange(end - start, dtype=np.int32)
        return found

    def search(self, terms: list[str], weights: list[int], k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best with a score above 0, best first."""
        asked = [(*self.lists[t], w) for t, w in zip(terms, weights) if t in self.lists and w > 0]
        at = [self.positions(start, end) for start, end, _ in asked]
        seen = [np.zeros(end - start, bool) for start, end, _ in asked]
        best = [0] * len(asked)  # positions before it are all seen
        met, scores, top = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.empty(0, np.int64)
        read = 0
        while any(b < len(s) for b, s in zip(best, seen)):
            ahead = [self.documents[start + read : min(end, start + read + step)] for start, end, _ in asked]
            read, step = read + step, 2 * step
            new = np.unique(np.concatenate(ahead)).astype(np.int64)
            new = new[~self.scored[new]]
            self.scored[new] = True
            total = np.zeros(len(new), np.int64)
            bound = 0
            for i, (start, end, weight) in enumerate(asked):
                there = at[i][new]
                held = there >= 0
                seen[i][there[held]] = True
                total[held] += weight * self.impacts[start + there[held]]
                best[i] = _seen_up_to(seen[i], best[i])
                if best[i] < len(seen[i]):
                    bound += weight * int(self.impacts[start + max(best[i] - 1, 0)])
            met.append(new)
            scores.append(total)
            top = np.concatenate([top, total])
            top = np.partition(top, len(top) - k)[len(top) - k :] if len(top) > k else top
            if len(top) == k and bound < top.min():
                break
        found, score = np.concatenate(met), np.concatenate(scores)
        self.scored[found] = False
        order = np.lexsort((found, -score))[:k]
        order = order[score[order] > 0]
        return found[order], score[order]


class SearchShard:
    SCHEMA = "question long, item_id long, doc_id long, score long"

    def __init__(self, options: Search, documents: int, words: int):
        self.options, self.documents, self.words = options, documents, words
        self.batches: list[pa.RecordBatch] = []
        self.rows: np.ndarray | None = None
        self.index: ImpactLists | None = None

    def add(self, rows: pa.RecordBatch) -> None:
        self.batches.append(rows.select(["doc_id", "n", "terms", "counts"]))

    def answer(self, questions: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.batches:
            self.index = ImpactLists(self.batches, self.documents, self.words)
            self.batches = []
        if self.index is None:
            return
        columns = (questions.column(c).to_pylist() for c in ("question", "item_id", "terms", "weights"))
        for question, item_id, terms, weights in zip(*columns):
            found, scores = self.index.search(terms, weights, self.options.results, self.options.step)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([question] * len(found), pa.int64()),
                    pa.array([item_id] * len(found), pa.int64()),
                    pa.array(self.index.ids[found], mask=self.index.missing[found]),
                    pa.array(scores, pa.int64()),
                ],
                ["question", "item_id", "doc_id", "score"],
            )


def search(
    docs: DataFrame,
    questions: DataFrame,
    options: Search = Search(),
    id_col: str = "doc_id",
    text_col: str = "text",
    question_id_col: str = "item_id",
    question_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of every question, over all documents with a term.

    Scores sum, over the question's different terms, the term's weight floor(1000 ln((2N + 2) / (2df + 1))) times its
    impact in the document, (10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L.

    Documents are read once, and only the terms that some question may hold are kept, with their numbers, in a stored
    table. A filter of constant size on terms goes to the tasks; what it lets pass too much is never asked for.

    Defined cases: a text that is null, empty or has no terms is no document, and as a question has no rows; documents
    with score 0 are not returned; equal scores go by ascending id, a missing id last; repeated rows are documents, or
    questions, of their own; other columns are not looked at; empty tables give an empty table.
    """
    spark: SparkSession = docs.sparkSession
    asked = written(spark, question_terms(questions, question_id_col, question_text_col), "questions")
    wanted = term_filter(asked, options.filter_bits)
    listed = document_terms(docs, wanted, options.filter_bits, id_col, text_col)
    listed = written(spark, listed, "document-terms")
    sums = listed.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("terms"))).first()
    documents, words, postings = sums[0], sums[1] or 1, sums[2] or 0
    shards = max(1, -(-documents // options.shard_documents), -(-postings // options.shard_postings))
    held = listed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = (F.lit(2.0) * documents + 2) / (F.lit(2.0) * F.col("df") + 1)
    weighted = asked.join(held, "term").withColumn("weight", F.floor(F.lit(float(WEIGHT_SCALE)) * F.log(ratio)))
    pairs = F.struct("term", "weight")
    whole = weighted.groupBy("question", "item_id").agg(F.collect_list(pairs).alias("pairs"))
    whole = whole.select("question", "item_id", F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("weights"))
    found = answers(
        dealt(listed, shards, "row"),
        asked_of_all(whole, shards),
        shards,
        lambda: SearchShard(options, documents, words),
        SearchShard.SCHEMA,
    )
    order = Window.partitionBy("question", "item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.results)
    return ranked.select("item_id", "rank", "doc_id", "score")
