"""Token-id files: the ids of all documents in order, in compressed blocks that can be read alone.

A folder of files is a Parquet table, so that Spark's committer decides which attempt of a task counts. A row is a block:
    part       number of the file in ascending order of documents
    block      number of the block in its part
    n_ids      ids in the block, at most BLOCK_IDS
    crc        unsigned CRC-32 of the payload, checked before it is decoded
    payload    the ids by the context-mixing coder, from an empty model
    docs       whose ids they are, in order: seq (number in the part), doc_id, at (place of the first of these ids in
               the part), piece (0 for the first ids of a document, counting on in later blocks), n
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import bpe
from shopledger.llm.id_coder import BLOCK_IDS, crc32_ids, crc32_joined, decode_blocks, encode_blocks
from shopledger.llm.tables import small_batches

END = 0
_DOCS = "array<struct<seq:bigint,doc_id:bigint,at:bigint,piece:bigint,n:bigint>>"
_BLOCK = f"part int, block bigint, n_ids bigint, crc bigint, payload binary, docs {_DOCS}"
_DOC_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in ("seq", "doc_id", "at", "piece", "n")]))


def _blocks(vocabulary: str | None, block_ids: int, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe._loaded(vocabulary, bpe.LEAF_CHARS)
        part = TaskContext.get().partitionId()
        # cut, not yet coded: ids and whose they are; the last one still fills up
        ids: list[list[np.ndarray]] = [[]]
        docs: list[list[dict]] = [[]]
        room, at, seq, written = block_ids, 0, 0, 0

        def coded(n: int) -> pa.RecordBatch:
            nonlocal written
            blocks = [np.concatenate(x) for x in ids[:n]]
            payloads = encode_blocks(blocks)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()),
                    pa.array(range(written, written + n), pa.int64()),
                    pa.array([len(b) for b in blocks], pa.int64()),
                    pa.array([zlib.crc32(p) for p in payloads], pa.int64()),
                    pa.array(payloads, pa.binary()),
                    pa.array(docs[:n], _DOC_TYPE),
                ],
                ["part", "block", "n_ids", "crc", "payload", "docs"],
            )
            del ids[:n], docs[:n]
            written += n
            return batch

        for batch in batches:
            for doc_id, own in zip(
                batch.column("doc_id").to_pylist(), encoder.encode_arrays(batch.column("text").to_pylist())
            ):
                rest, piece = np.append(own, np.int32(END)), 0
                while len(rest):
                    some, rest = rest[:room], rest[room:]
                    ids[-1].append(some)
                    docs[-1].append({"seq": seq, "doc_id": doc_id, "at": at, "piece": piece, "n": len(some)})
                    room, at, piece = room - len(some), at + len(some), piece + 1
                    if not room:
                        ids.append([])
                        docs.append([])
                        room = block_ids
                        if len(ids) > lanes:
                            yield coded(lanes)
                seq += 1
        n = len(ids) - (not ids[-1])
        if n:
            yield coded(n)

    return run


def write(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    parts: int | None = None,
    block_ids: int = BLOCK_IDS,
    lanes: int = 1,
) -> None:
    """Encode every document, append END to it, and write the files to `path`, which must not exist.

    Documents are dealt to parts by range of their id, then of a hash of their text, so that an id that many rows have
    fills several parts. Rows without an id come first. Two attempts of a task write the same file. A task keeps `lanes`
    blocks until they are coded.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie", "nth"]
    keyed = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.xxhash64(f"`{text_col}`").alias("tie"),
        F.monotonically_increasing_id().alias("nth"),
    )
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(_blocks(vocabulary, block_ids, lanes), _BLOCK).write.parquet(path)


def _decoded(lanes: int):
    def pieces(rows: list[dict]) -> dict[str, list]:
        for row in rows:
            if zlib.crc32(row["payload"]) != row["crc"]:
                raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
        out: dict[str, list] = {c: [] for c in ("part", "seq", "doc_id", "at", "piece", "n", "ids")}
        for row, ids in zip(rows, decode_blocks([r["payload"] for r in rows], [r["n_ids"] for r in rows])):
            place = 0
            for doc in row["docs"]:
                out["part"].append(row["part"])
                for c in ("seq", "doc_id", "at", "piece", "n"):
                    out[c].append(doc[c])
                out["ids"].append(ids[place : place + doc["n"]])
                place += doc["n"]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, lanes):
                yield pieces(batch.slice(at, lanes).to_pylist())

    return run


_PLACE = "part int, seq long, doc_id long, at long, piece long, n long"


def _place_arrays(out: dict) -> list[pa.Array]:
    kinds = [pa.int32(), *[pa.int64()] * 5]
    return [pa.array(out[c], k) for c, k in zip(("part", "seq", "doc_id", "at", "piece", "n"), kinds)]


def read_pieces(spark: SparkSession, path: str, lanes: int = 1) -> DataFrame:
    """(part, seq, doc_id, at, piece, n, ids): the ids of every document, one row for each block it has ids in."""
    small_batches(spark)
    names = ["part", "seq", "doc_id", "at", "piece", "n", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _decoded(lanes)(batches):
            arrays = [*_place_arrays(out), pa.array(out["ids"], pa.list_(pa.int32()))]
            whole = pa.RecordBatch.from_arrays(arrays, names)
            for at in range(0, whole.num_rows, 512):
                yield whole.slice(at, 512)

    return spark.read.schema(_BLOCK).parquet(path).mapInArrow(run, f"{_PLACE}, ids array<int>")


def read_digests(spark: SparkSession, path: str, lanes: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    A block is decoded where it is read; of a document in several blocks only their checksums meet. The driver sees
    the number of ids of each part.

    Defined cases: a document without text has its end id; rows without an id come first; of rows with the same id the
    order is that of a hash of their text; no documents: no rows; a block whose checksum is wrong ends the job.
    """
    small_batches(spark)
    names = ["part", "seq", "doc_id", "at", "piece", "n", "crc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _decoded(lanes)(batches):
            crc = pa.array([crc32_ids(x) for x in out["ids"]], pa.int64())
            yield pa.RecordBatch.from_arrays([*_place_arrays(out), crc], names)

    blocks = spark.read.schema(_BLOCK).parquet(path)
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    sums = np.cumsum([0, *(n for _, n in totals)])
    before = {part: int(n) for (part, _), n in zip(totals, sums)}
    pieces = blocks.mapInArrow(run, f"{_PLACE}, crc long")
    whole = pieces.groupBy("part", "seq", "doc_id").agg(
        F.min("at").alias("at"),
        F.sum("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("pieces"),
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for own in batch.column("pieces").to_pylist():
                crc = own[0]["crc"]
                for piece in own[1:]:
                    crc = crc32_joined(crc, piece["crc"], 4 * piece["n"])
                crcs.append(crc)
            part, at = batch.column("part").to_pylist(), batch.column("at").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([before[p] + a for p, a in zip(part, at)], pa.int64()),
                    batch.column("n"),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return whole.mapInArrow(joined, "doc_id long, start long, n_tokens long, ids_crc32 long")
