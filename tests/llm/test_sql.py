"""Queries that SQL can express equal it; the pipeline equals its stages done plainly."""

import duckdb
import pytest
from compare import connect, difference, duck_rows, spark_rows
from conftest import SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from rows import documents
from shopledger.llm import bpe, secrets_crf
from shopledger.llm.queries import ORACLE_SQL, QUERIES
from test_document_operators import _plain_components, _plain_fingerprint


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, name, folder):
    assert difference(spark_rows(QUERIES[name](spark, folder)), duck_rows(connect(folder), ORACLE_SQL[name])) is None


WORDS = "the house is on the hill and one can see it from far away, as they say,"
LINES = [
    "design updates", "sign up", "Sign up!", "resign up", "sign up_x", "sign up click here", "click here, click here", "sign  up",
    "We accept cookies.", "accept\tcookies", f"{WORDS} privacy policy", f"{WORDS} sign up click here privacy policy terms of use",
    "all rights reserved all rights reserved", "É sign up é", "ésign up", "terms of service", "terms of uses", "click here" * 9,
    f"{WORDS} click here", f"click here {WORDS} click here", "one two three four five six seven eight nine ten eleven sign up",
    "one two three four five six seven eight nine ten sign up", "Lorem Ipsum dolor", "| a | b | c", "#$%& x",
]


def test_rules_equal_their_sql_on_hard_lines(spark, tmp_path):
    import random

    rnd = random.Random(3)
    rows = [(i, line, "en") for i, line in enumerate(LINES)]
    rows += [(100 + i, "\n".join(rnd.choices([*LINES, WORDS, "", " "], k=rnd.randrange(1, 9))), "en") for i in range(200)]
    rows += [(400, None, None), (401, "", None), (402, f"{WORDS} {WORDS} {WORDS}", "en"), (402, "a b c d e a b c d e a b c d e f", "en")]
    documents(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    name = "op1_quality_rules"
    assert difference(spark_rows(QUERIES[name](spark, str(tmp_path))), duck_rows(con, ORACLE_SQL[name])) is None


def test_there_is_a_query_for_every_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_packing_measures_documents_in_ids(spark):
    library = Tokenizer.from_file(bpe.default_vocabulary())
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in texts}
    found = {}
    for r in QUERIES["op8_best_fit_packing"](spark, SMALL).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == expected


def test_the_pipeline_equals_its_stages_done_plainly(spark):
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = [raw]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SMALL).cache())
    for frame in steps[1:-1]:
        assert frame.columns == list(corpus_pipeline.COLUMNS)
        assert frame.schema.simpleString() == raw.schema.simpleString()
    good, told, single, clean, packed = (frame.collect() for frame in steps[1:])

    sql = ORACLE_SQL["op1_quality_rules"]
    kept = {r[0] for r in connect(SMALL).execute(f"select doc_id from ({sql}) where kept").fetchall()}
    assert {r.doc_id for r in good} == kept and len(good) == len(kept)

    assert {r.doc_id for r in told} <= kept and len(told) >= 0.99 * len(good)

    fingerprints = [_plain_fingerprint(r.text) for r in told]
    components = _plain_components([r.doc_id for r in told], fingerprints, 3)
    assert sorted(r.doc_id for r in single) == sorted(set(components))

    text_of = {r.doc_id: r.text for r in single}
    assert {r.doc_id for r in clean} == set(text_of)
    for r in clean:
        spans = secrets_crf.base_spans(text_of[r.doc_id])
        assert not secrets_crf.base_spans(r.text)
        if r.text == text_of[r.doc_id]:
            assert not spans
        assert r.n_chars == len(r.text)

    library = Tokenizer.from_file(bpe.default_vocabulary())
    expected = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean}
    found, bins = {}, {}
    for r in packed:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        bins.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.length))
    assert found == expected
    for (_, capacity), own in bins.items():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity


def test_the_pipeline_on_hard_rows_and_none(spark):
    for rows in (documents(spark), documents(spark, [])):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        docs.collect()
