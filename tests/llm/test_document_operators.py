"""Every operator on documents: plain versions of the same, and rows that are hard on purpose."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from rows import LONG, TEXTS, clashing, collected, documents
from shopledger.llm import bpe, language_id, packing, piece_table, secrets_crf, simhash, token_files
from shopledger.llm.quality_rules import quality_rules
from shopledger.llm.tables import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIELD = secrets_crf.teach(["token = abcdef0123456789abcdef01 and 12345678901", "call 415-555-2671 now"])
MODEL = language_id.fit(["the house and the dog"] * 9, ["en"] * 9, language_id.Training(steps=20))


def _files(docs):
    path = fresh_path(docs.sparkSession, "test-ids")
    token_files.write(docs, path, parts=3, block_ids=64, lanes=4)
    return token_files.read_digests(docs.sparkSession, path, lanes=4)


OPERATORS = {
    "quality_rules": quality_rules,
    "encode": bpe.encode,
    "round_trip": bpe.round_trip,
    "token_counts": bpe.token_counts,
    "secrets": lambda docs: secrets_crf.scan(docs, FIELD),
    "language": lambda docs: language_id.identify(docs, MODEL),
    "files": _files,
    "byte_lengths": packing.byte_lengths,
    "simhash": simhash.simhash_components,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_each_whatever_the_rows(spark, name):
    docs = documents(spark)
    plain = collected(OPERATORS[name](docs))
    assert len(plain) == len(TEXTS)
    assert collected(OPERATORS[name](clashing(docs).repartition(3))) == plain
    empty = documents(spark, [])
    assert OPERATORS[name](empty).collect() == []


def test_quality_counts_equal_a_plain_count(spark):
    rnd = random.Random(2)
    rows = TEXTS + [
        (100 + n, "".join(rnd.choice(["a ", "b ", "c\n", "d# ", "\n", "é ", "| "]) for _ in range(rnd.randint(0, 60))), "en")
        for n in range(150)
    ]
    found = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(documents(spark, rows)).collect()}
    expected = set()
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        expected.add(
            (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)
        )
    assert found == expected


def test_bad_lines_go_and_documents_that_lose_too_much(spark):
    good = "The dog is in the garden, and the house is on the hill by the lake."
    other = "Nobody knows, it seems, what they were looking for by the river."
    menu = "Home | Shop | News | About | Help"
    noise = "#### $$$$ %%%% &&&& a b"
    rows = [
        (1, f"{good}\n{menu}\n{other}", "en"),
        (2, f"{good}\n{menu}\n{menu} | x\n{menu} | y\n{menu} | z", "en"),
        (3, f"{good}\n{noise}\nPlease accept cookies here.", "en"),
        (4, good, "en"),
    ]
    found = {r.doc_id: r for r in quality_rules(documents(spark, rows)).collect()}
    assert found[1].clean_text == f"{good}\n{other}" and found[1].kept
    assert not found[2].kept and found[2].n_lines_removed == 4
    assert found[3].clean_text == good and found[3].n_lines_removed == 2
    assert found[4].kept and found[4].lost_words == 0


def test_a_phrase_in_a_long_line_or_inside_words_is_no_boilerplate(spark):
    long = "Our privacy policy, which nobody reads, is on the hill. " + "The dog is in the garden, and the house is by the lake. " * 2
    inside = "The design updates of the house, it seems, are on the hill by the lake."
    rows = [
        (1, long, "en"),
        (2, inside, "en"),
        (3, f"{inside}\nSign up!", "en"),
        (4, f"{inside}\n{'Click here, accept cookies: ' * 4}", "en"),
    ]
    found = {r.doc_id: r.n_lines_removed for r in quality_rules(documents(spark, rows)).collect()}
    assert found == {1: 0, 2: 0, 3: 1, 4: 1}


def test_ids_and_texts_equal_the_library(spark):
    library = Tokenizer.from_file(bpe.default_vocabulary())
    found = {}
    for r in bpe.encode(documents(spark), leaf_chars=50).collect():
        found.setdefault(r.doc_id, []).append(list(r.ids))
    for doc_id, text, _ in TEXTS:
        if doc_id is not None:
            assert library.encode(text or "", add_special_tokens=False).ids in found[doc_id]
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(documents(spark)).collect()}
    for doc_id, text, _ in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        assert (doc_id, len(ids), *sha) in digests
    back = {r.text for r in bpe.decode(bpe.encode(documents(spark))).collect()}
    assert {t or "" for _, t, _ in TEXTS} == back


def test_arrays_of_ids_equal_the_library():
    library = Tokenizer.from_file(bpe.default_vocabulary())
    texts = [None, "", "a", *(text for _, text, _ in TEXTS), "the house <|endoftext|> the house\n\n  12,5 \u4e94\u00e9" * 3, "x" * 300]
    for leaf in (8, bpe.LEAF_CHARS):
        encoder = bpe.ByteBpe(bpe.default_vocabulary(), leaf)
        for some in (texts, texts[:2], []):
            arrays = encoder.encode_arrays(some)
            assert all(ids.dtype == "int32" for ids in arrays)
            assert [ids.tolist() for ids in arrays] == encoder.encode_all(some)
            assert [ids.tolist() for ids in arrays] == [library.encode(t or "", add_special_tokens=False).ids for t in some]


def test_pieces_of_many_texts_equal_the_pattern():
    rnd, kinds = random.Random(8), piece_table.kinds_of_characters(bpe.LAST)
    common = [chr(c) for c in (*range(bpe.LAST + 1), *range(0x2010, 0x2028), 0x20AC)]
    sources = [common, "aeiou   \n\n''''sltrevmd  1!", "ab'sl !", "abé ", " \n'", "'sretvl m"]
    table, numbers = piece_table.PieceTable(), {}
    for n in range(1500):
        texts = ["".join(rnd.choice(sources[n % 6]) for _ in range(rnd.choice([0, 1, 2, 5, 30, 100]))) for _ in range(3)]
        joined = "".join(t + piece_table.END for t in texts)
        starts = piece_table.starts_of_pieces(joined, kinds)
        pieces = [joined[s:e] for s, e in zip(starts, [*starts[1:], len(joined)])]
        assert pieces == [p for t in texts for p in [*bpe._PIECE.findall(t), piece_table.END]]
        keys = piece_table.keys_of(joined, starts)
        for piece, key, number in zip(pieces, keys.T.tolist(), table.find(keys).tolist()):
            size = len(piece.encode())
            short = size <= piece_table.KEY_BYTES
            assert key[2] >> 56 == (size if short else 0)
            assert number == (numbers.get(piece, -1) if short else -1)
        new = {p: at for at, p in enumerate(pieces) if p not in numbers}
        numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
        table.put(len(numbers), np.array([numbers[p] for p in new], np.int64), keys.take(list(new.values()), axis=1))


@pytest.mark.parametrize("most", [4, 40, 1000])
def test_numbered_pieces_are_bounded(monkeypatch, most):
    monkeypatch.setattr(bpe, "NUMBERED", most)
    rnd, encoder = random.Random(most), bpe.ByteBpe(bpe.default_vocabulary())
    library = Tokenizer.from_file(bpe.default_vocabulary())
    for _ in range(60):
        texts = [" ".join(rnd.choice(["the", "house", f"w{rnd.randint(0, 999)}", "\u00e9t\u00e9"]) for _ in range(9)) for _ in range(4)]
        found = [ids.tolist() for ids in encoder.encode_arrays([*texts, "a<|endoftext|>b"])]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in [*texts, "a<|endoftext|>b"]]
        assert len(encoder._numbers) <= most + 45


@pytest.mark.parametrize("leaf", [6, 17, 64])
def test_halves_agree_with_the_whole(leaf):
    rnd, encoder = random.Random(leaf), bpe.ByteBpe(bpe.default_vocabulary(), leaf)
    library = Tokenizer.from_file(bpe.default_vocabulary())
    common = [chr(c) for c in range(0x250)] + list("aeiou   \n\n''''sltrevm  ") * 20 + ["’", "€"]
    sources = [common, common + list("日本 　١﻿​ "), list("ab'sl !"), ["a", "b", "é"], [" ", "\n"]]
    for n in range(300):
        text = "".join(rnd.choice(sources[n % 5]) for _ in range(rnd.choice([0, 5, 30, 200, 700])))
        if n % 11 == 0:
            text = text[:20] + "<|endoftext|>" + text[20:] + "<|endoftext|><|endoftext"
        ids = encoder.encode_all([text])[0]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)
        scrambled = rnd.sample(range(50257), 20)
        assert encoder.decode(scrambled) == library.decode(scrambled, skip_special_tokens=False)


def test_held_out_languages_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    rows = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_language_alone_and_in_company_are_the_same():
    texts = ["The house.", "", None, "über die Berge", "123", "ß", "x" * 100]
    model = language_id.fit(["the house is here"] * 9 + ["die Berge sind über"] * 9, ["en"] * 9 + ["de"] * 9)
    names, scores = language_id.predict(texts, model)
    for text, name, score in zip(texts, names, scores):
        alone = language_id.predict([text], model)
        assert alone[0] == [name] and alone[1][0] == pytest.approx(score)
    assert names[:5] == ["en", "und", "und", "de", "und"]
    assert language_id.predict(["text"], language_id.fit([], []))[0] == ["und"]


def _plain_subwords(text, buckets):
    """All runs of 2 to 4 signs of every word, an end mark on both of its sides."""
    out = []
    for word in re.split(r"[^a-zà-öø-ÿ日本]+", text.lower()):
        signs = [0, *map(ord, word), 0] if word else []
        for n in (2, 3, 4):
            for start in range(len(signs) - n + 1):
                value = n * 0x9E3779B1 & 0xFFFFFFFF
                for sign in signs[start : start + n]:
                    value = (value ^ sign) * 0x01000193 & 0xFFFFFFFF
                    value ^= value >> 15
                out.append(value % buckets)
    return out


def test_scores_equal_a_plain_mean_over_subwords():
    texts = ["The house.", "über  die\nBerge", "x", "a b 1 a", "ß und ÉCOLE 12ab3", "日本 x", "the " * 500]
    model = language_id.fit(["the house is here"] * 9 + ["die Berge sind über"] * 9, ["en"] * 9 + ["de"] * 9)
    names, chances = language_id.predict(texts, model)
    for text, name, chance in zip(texts, names, chances):
        found = _plain_subwords(text, len(model.table))
        mean = [sum(float(model.table[b, k]) for b in found) / len(found) / model.temperature for k in (0, 1)]
        share = [math.exp(m) / sum(map(math.exp, mean)) for m in mean]
        assert chance == pytest.approx(max(share), abs=1e-6)
        if abs(share[0] - share[1]) > 1e-6:
            assert name == model.languages[share.index(max(share))]


FOREIGN = [
    "Suomen kieli on uralilaisten kielten itämerensuomalaiseen ryhmään kuuluva kieli, jota puhuvat pääosin suomalaiset.",
    "Język polski należy do grupy zachodniosłowiańskiej rodziny języków indoeuropejskich.",
    "Türkçe, Güneydoğu Avrupa ve Batı Asya'da konuşulan, Türk dilleri dil ailesine ait sondan eklemeli bir dildir.",
    "日本語は日本国内や日本人同士の間で使われている言語", "Русский язык один из восточнославянских языков",
]


def test_foreign_and_random_text_is_rejected_and_clean_text_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language_id.train(docs)
    rnd = random.Random(1)
    odd = FOREIGN + ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=400)) for _ in range(20)]
    odd += [base64.b64encode(rnd.randbytes(300)).decode() for _ in range(20)]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert [r.rejected for r in language_id.identify(rows, model).collect()] == [True] * len(odd)
    clean = language_id.identify(docs.filter("text IS NOT NULL AND lang IS NOT NULL AND length(text) >= 20"), model)
    assert clean.filter("held_out AND rejected").count() <= 0.01 * clean.filter("held_out").count()


def _plain_fingerprint(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("cell", [3, simhash.CELL])
def test_components_equal_all_pairs(spark, cell):
    rnd = random.Random(4)
    words = "the a of to in it is on by as be or we an he".split()
    base = [[rnd.choice(words) for _ in range(rnd.choice([3, 40, 200]))] for _ in range(25)]
    rows = [r for r in TEXTS if r[1] != LONG]
    for n in range(220):
        own = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 1, 2, 5])):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        rows.append((1000 - n, " ".join(own), "en"))
    found = collected(simhash.simhash_components(documents(spark, rows), cell=cell))
    fps = [_plain_fingerprint(t) for _, t, _ in rows]
    component = _plain_components([r[0] for r in rows], fps, 3)
    expected = [(r[0], f"{fp:016x}", c) for r, fp, c in zip(rows, fps, component)]
    assert found == sorted(expected, key=repr)
    kept = simhash.one_of_each(documents(spark, rows), cell=cell).collect()
    groups = {c for c in component if c is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(groups)


def test_every_close_pair_collides():
    rnd = random.Random(5)
    for radius in range(1, 5):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(500):
            differing = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, radius)))
            assert any(differing & mask == 0 for mask in masks)


def test_files_give_back_ids_starts_and_checksums(spark):
    import numpy as np

    library = Tokenizer.from_file(bpe.default_vocabulary())
    docs = documents(spark, [r for r in TEXTS if r[0] is not None])
    path = fresh_path(spark, "test-ids")
    token_files.write(docs, path, parts=4, block_ids=100, lanes=3)
    pieces = token_files.read_pieces(spark, path, lanes=3).collect()
    found = {}
    for p in sorted(pieces, key=lambda p: (p.part, p.seq, p.piece)):
        found.setdefault((p.part, p.seq, p.doc_id), []).extend(p.ids)
    digests = sorted(token_files.read_digests(spark, path, lanes=3).collect(), key=lambda r: r.start)
    start = 0
    for (key, ids), digest in zip(sorted(found.items()), digests):
        assert digest.start == start and digest.doc_id == key[2] and digest.n_tokens == len(ids)
        assert digest.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        texts = [t or "" for i, t, _ in TEXTS if i == key[2]]
        assert ids in [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
        start += len(ids)
    assert [d.doc_id for d in digests] == sorted(r[0] for r in TEXTS if r[0] is not None)


def test_a_damaged_block_is_noticed(spark):
    from pyspark.sql import functions as F

    path, broken = fresh_path(spark, "test-ids"), fresh_path(spark, "test-ids")
    token_files.write(documents(spark), path, parts=1)
    blocks = spark.read.parquet(path)
    blocks.withColumn("payload", F.concat("payload", F.expr("X'00'"))).write.parquet(broken)
    with pytest.raises(Exception, match="is damaged"):
        token_files.read_digests(spark, broken).collect()


def test_one_of_many_copies_stays(spark):
    twice = documents(spark, [TEXTS[0]] * 5 + [(None, None, None)] * 3)
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(twice).collect()) == ["1", "None"]
    assert {r.component_id for r in simhash.simhash_components(twice).collect()} == {1, None}
