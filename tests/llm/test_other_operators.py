"""Vectors, pages, secrets, packing and coding against plain versions."""

import itertools
import random
import re
import zlib
from html import unescape

import numpy as np
import pytest

from rows import clashing, collected
from shopledger.llm import bit_codes, html_text, id_coder, packing, secrets_crf
from shopledger.llm.components import components
from shopledger.llm.url_filter import TemplateOptions, UrlRule, judge_urls
from shopledger.llm.queries import URL_RULES

# nearest neighbours


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _plain_nearest(rows, k):
    usable = [
        (i, np.array(v, np.float32).astype(np.float64))
        for i, v, _ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for query_id, query in usable:
        if query_id % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, query)), i) for i, v in usable if i != query_id)
            out += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("dimension", [1, 7, 64])
def test_nearest_equal_all_pairs(spark, dimension):
    rnd = np.random.default_rng(dimension)
    rows = [(i, (rnd.standard_normal(dimension) * rnd.choice([0.1, 1, 9])).tolist(), 1) for i in range(300)]
    same = rnd.standard_normal(dimension).tolist()
    rows += [(1000 + i, same, None) for i in range(70)]
    bad = [None, [], [0.0] * dimension, [float("nan")] * dimension, [None] * dimension, [float("inf")] * dimension]
    rows += [(2000 + 20 * i, v, None) for i, v in enumerate(bad)] + [(None, same, None)]
    options = bit_codes.BitCodes(candidate_block=64, query_block=8)
    found = bit_codes.nearest(_vectors(spark, rows), options)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == _plain_nearest(rows, 20)
    assert collected(bit_codes.nearest(clashing(_vectors(spark, rows)), options)) == collected(found)


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 2.0], 0), (3, [2.0, 1.0], 0), (4, [2.0, 1.0], 0)]
    found = bit_codes.nearest(_vectors(spark, rows)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 3, 4.0), (0, 2, 4, 4.0)]
    assert bit_codes.nearest(_vectors(spark, [])).collect() == []
    assert bit_codes.nearest(_vectors(spark, rows[:1])).collect() == []


def test_bounds_hold():
    rnd = np.random.default_rng(3)
    vectors, queries = rnd.standard_normal((2000, 64)) * 3, rnd.standard_normal((40, 64))
    turn = bit_codes.rotation(64, 7)
    assert np.allclose(turn @ turn.T, np.eye(64))
    guess, width = bit_codes.estimate(*bit_codes.encode(vectors, turn), queries @ turn.T, 64, 4.0)
    off = np.abs(guess - queries @ vectors.T)
    assert (off <= width).mean() > 0.9995 and (off <= width / 4).mean() > 0.6


# secrets


def _plain_spans(text):
    found = []
    for kind, pattern, enough in (
        ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        ("access", r"(AKIA[A-Z0-9]+)", 20),
        ("hex", r"([0-9a-f]+)", 24),
    ):
        found += [(kind, *m.span()) for m in re.finditer(pattern, text, re.A) if len(m[1]) >= enough]
    return sorted(found, key=lambda s: (s[1], secrets_crf.KINDS.index(s[0])))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    parts = ["token", "TOKEN", "ſecret", "toKen", "api_key", "apikey", '"', "'", " ", "=", ":", "AKIA", "A1B2C3D4", "0a1b2c3d4e5f", "f" * 24, "é", "\n", "x."]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert secrets_crf.base_spans(text) == _plain_spans(text)
    assert secrets_crf.base_spans("token=token:abcdef12") == []


def _random_field(rnd):
    field = secrets_crf.Field.empty()
    field.steps = np.where(np.isinf(field.steps), field.steps, rnd.standard_normal((3, 3)))
    return field


def test_best_path_and_sums_equal_all_paths():
    rnd = np.random.default_rng(8)
    for n in range(1, 6):
        field, emit = _random_field(rnd), rnd.standard_normal((n, 3))

        def score(tags):
            path = [0, *tags, 0]
            return sum(field.steps[a, b] for a, b in zip(path, path[1:])) + sum(emit[i, t] for i, t in enumerate(tags))

        paths = list(itertools.product(range(3), repeat=n))
        scores = np.array([score(p) for p in paths])
        assert field.viterbi(emit) == list(paths[int(scores.argmax())])
        single, pairs, total = field.marginals(emit)
        chance = np.exp(scores - np.logaddexp.reduce(scores))
        assert total == pytest.approx(np.logaddexp.reduce(scores))
        for i in range(n):
            for tag in range(3):
                assert single[i, tag] == pytest.approx(sum(c for c, p in zip(chance, paths) if p[i] == tag))
        assert pairs.sum() == pytest.approx(n + 1)


def test_the_field_finds_what_the_patterns_miss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = secrets_crf.train(docs, training=secrets_crf.Training(sample=3000))
    missed = 'the deploy credential "9f8e7d6c5b4a39281706f5e4" works'
    assert secrets_crf.base_spans(missed.replace("9f8e7d6c5b4a39281706f5e4", "9f8e7d6c5b4a39281706")) == []
    found = secrets_crf.secret_spans('my key = "9f8e7d6c5b4a39281706" works', field)[1]
    assert found == [("crf", 10, 30)]
    for clean in ("call 415-555-2671 now", "mail bosbt.42@mail8.example.com", "on 2024-01-31 at 10.20.30.40"):
        assert secrets_crf.secret_spans(clean, field)[1] == []
    assert secrets_crf.redacted("my ab cd", [("hex", 3, 5), ("crf", 4, 8)]) == "my [SECRET]"


def test_the_field_sees_every_token():
    field = secrets_crf.teach(["the house is on the hill and the dog is in the garden by the lake"] * 50)
    for before, secret, behind in (
        ("Authorization: Bearer ", "AbCdEfGhIjKlMnOpQrSt", ""),
        ("the password is ", "p@ss!w0rd", " on the hill"),
        ("pwd: ", "hunt3r7", " and the dog"),
        ('passphrase = "', "correct horse battery staple", '" in the garden'),
    ):
        found = secrets_crf.secret_spans(before + secret + behind, field)[1]
        assert found[-1:] == [("crf", len(before), len(before + secret))]
    assert secrets_crf.secret_spans("the password was on the hill and the key to the house is in the garden", field)[1] == []


def test_a_span_that_reaches_beyond_a_base_span_stays():
    field = secrets_crf.Field.empty()
    field.steps[secrets_crf.OUTSIDE, secrets_crf.BEGIN] = 5.0
    text = "ZzQq" + "0a1b2c3d" * 3 + "XyWv"
    base, spans = secrets_crf.secret_spans(text, field)
    assert base == [("hex", 4, 28)] and spans == [("crf", 0, 32), ("hex", 4, 28)]
    assert secrets_crf.redacted(text, spans) == "[SECRET]"
    assert secrets_crf.secret_spans("0a1b2c3d" * 3, field)[1] == [("hex", 0, 24)]


def test_tokens_passed_over_are_outside_on_the_best_path():
    rng, some = np.random.default_rng(9), 0
    for n in range(400):
        field, emit = _random_field(rng), rng.standard_normal((rng.integers(1, 30), 3)) - [0, 1, 1] * rng.random(3) * 3
        tags = field.viterbi(emit)
        assert field.path(emit) == [(i, tag) for i, tag in enumerate(tags) if tag]
        some += any(tags)
    assert 50 < some < 400


def test_a_reader_adds_up_what_the_features_say():
    field = secrets_crf.Field.empty()
    field.weights = np.random.default_rng(10).standard_normal(field.weights.shape).astype(np.float32)
    texts = ['my token = "ab cd"\nnext: x', "a", "  pwd:  \u00fc `q1`, end. ", "pass a b c d e f g h i j k l"]
    reader, cut = secrets_crf.Reader(field), [secrets_crf.split(t) for t in texts]
    reader.learn(cut)
    for text, (words, gaps) in zip(texts, cut):
        assert "".join(g + w for g, w in zip(gaps, [*words, ""])) == text
        plain = [[f for v in token.values() for f in v] for token in secrets_crf._chain(words, gaps, text)]
        assert reader.scores(words, gaps, text) == pytest.approx(field.scores(plain), abs=1e-4)


def test_features_of_many_words_equal_those_of_each():
    rnd = random.Random(12)
    parts = [*"aabzZAF0159+/=_.-!#$%&*(){}[]<>;:,|~", "é", "ß", "ſ", "İ", "Σ", "𝐀", "Ⓐ", "²", "五", "٠", "ǅ", "\x00", "\ud800"]
    parts += "password passwd pass_phrase key api_key apikey token bearer secret credentials pwd phrase".split()
    words = ["".join(rnd.choices(parts, k=rnd.randint(1, rnd.choice([3, 9, 40])))) for _ in range(4000)]
    words += ["aB" * 200, "a" * 600, "x" * 255 + "Yz9", "(((", ")", "a𝐀", "a𝐀B", "aaabbb", "abcd", "aabbccdd", "aaabbbcccccc"]
    for some in ([words[0]], words[-3:], words):
        roles, asks = secrets_crf.all_word_features(some)
        each = [secrets_crf.word_features(word) for word in some]
        for role, features in enumerate(roles):
            assert features.tolist() == [found[role] for found in each]
        assert asks.tolist() == [found[4] for found in each]
    assert 100 < sum(asks) < 4000


def test_new_words_are_learned_together(monkeypatch):
    def one_by_one(word):
        raise AssertionError(f"{word} by itself")

    reader, text = secrets_crf.Reader(secrets_crf.Field.empty()), "my token is ab cd"
    monkeypatch.setattr(secrets_crf, "word_features", one_by_one)
    assert secrets_crf.all_spans([text, ""], reader) == [([], []), ([], [])]


def test_a_reader_that_forgets_finds_the_same(monkeypatch):
    rnd, field = random.Random(13), secrets_crf.Field.empty()
    field.weights = np.random.default_rng(14).standard_normal(field.weights.shape).astype(np.float32)
    words = ["the", "key", "of", *(f"w{i}" for i in range(300))]
    batches = [[" \n"[rnd.random() < 0.1].join(rnd.choices(words, k=20)) + " " * rnd.randint(0, 40)] for _ in range(60)]
    whole = secrets_crf.Reader(field)
    expected = [secrets_crf.all_spans(batch, whole) for batch in batches]
    for most in (10, 100):
        monkeypatch.setattr(secrets_crf, "REMEMBERED", most)
        reader = secrets_crf.Reader(field)
        for batch, found in zip(batches, expected):
            assert secrets_crf.all_spans(batch, reader) == found
            assert len(reader._word) <= most + 21 and len(reader._own[0]) == len(reader._asks) == len(reader._word)
    assert any(spans for found in expected for _, spans in found)


# pages


def test_main_text_of_the_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in html_text.extract(clashing(pages)).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?p>|</?h1>", article))
        assert found[r.page_id].text == "\n".join(p for p in parts if p)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


PARAGRAPH = "It was the house on the hill that they had seen from the road, and it was not as far as we thought."
MENU = "<div><a href=/a>Home of all</a> <a href=/b>Our shop is here</a></div>"


def test_blocks_inherit_from_decided_neighbours():
    page = f"{MENU}<div>Title</div><div>{PARAGRAPH}</div><div>Short.</div><div>{PARAGRAPH}</div>{MENU}<p>x</p>{MENU}"
    assert html_text.main_text(page) == f"Title\n{PARAGRAPH}\nShort.\n{PARAGRAPH}"
    assert html_text.main_text(f"<div>{'zq xk ' * 60}</div>") == ""


@pytest.mark.parametrize(
    "around",
    [
        "<nav>{}</nav>", "<header>{}</header>", "<footer>{}</footer>", "<aside>{}</aside>", "<form>{}</form>",
        "<div class='cookie-notice'>{}</div>", "<div id=comments><p>{}</p></div>", "<section role=navigation>{}</section>",
        "<div class='ad'>{}</div>", "<script>'<p>{}</p>'</script>", "<style>p{{}} {}</style>", "<!-- {} -->",
        "<div hidden>{}</div>", "<div class=\"post sidebar\"><ul><li>{}</ul></div>", "<noscript>{}</noscript>",
    ],
)
def test_parts_around_the_article_go(around):
    other = PARAGRAPH.replace("house", "shop")
    page = f"<body>{around.format(other)}<article><h1>T &amp; t</h1><p>{PARAGRAPH}<br>On.</p>{around.format(other)}</article>"
    assert html_text.main_text(page) == f"T & t\n{PARAGRAPH} On."


ARTICLE = f"<article><h1>T</h1><p>{PARAGRAPH}</p></article>"


@pytest.mark.parametrize(
    "around",
    [
        '<div class="layout has-sidebar">{}</div>', '<div class="page no-banner">{}</div>', '<div class="with-nav">{}</div>',
        '<div class="entry-content page-with-comments">{}</div>', '<div class="social-proof">{}</div>',
        '<form id="aspnetForm"><div>{}</div></form>', '<div class="sidebar-layout"><div id="formWidget">{}</div></div>',
        '<main class="banner">{}</main>', '<main><section class="modal"><div class="promo">{}</div></section></main>',
        '<div role="dialog">{}</div>', '<body class="no-sidebar nav-open">{}</body>',
    ],
)
def test_no_name_of_a_wrapper_takes_the_article_away(around):
    other = PARAGRAPH.replace("house", "shop")
    rest = f"<nav>{other}</nav><div class='sidebar'><p>{other}</p></div><div id=comments><article>{other}</article></div>"
    assert html_text.main_text(f"{MENU}{around.format(ARTICLE)}{rest}") == f"T\n{PARAGRAPH}"
    # without article elements it is the text that a name would take away altogether
    plain = ARTICLE.replace("article", "div")
    assert html_text.main_text(f"{MENU}{around.format(plain)}") == f"T\n{PARAGRAPH}"


def test_what_stands_beside_an_article_goes_whatever_its_length():
    other = PARAGRAPH.replace("house", "shop")
    for beside in ("<div class=comments>{}</div>", "<form>{}</form>", "<div class='sidebarBox'>{}</div>", "<div id=adWidget>{}</div>"):
        long = beside.format(f"<p>{other}</p>" * 30)
        assert html_text.main_text(f"<div class=wrap>{ARTICLE}</div>{long}") == f"T\n{PARAGRAPH}"
        assert html_text.main_text(f"<div><p>{PARAGRAPH}</p></div>{long}") == PARAGRAPH
    # readers' comments are never the article, also alone
    assert html_text.main_text(f"<div id=comments><article><p>{other}</p></article></div>") == ""


def test_pages_that_are_hard(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p"), (3, "u", "<!--"), (4, "u", f"<article><p>{PARAGRAPH * 3000}")]
    rows += [(5, "u", "<b>" * 3000 + "<div>" * 3000 + PARAGRAPH), (6, "u", "&notanentity; &lt;p&gt; \x00 <a"), (6, "u", "\ufeff")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.page_id, []).append(r)
    assert by_id[1][0].text == by_id[None][0].text == by_id[2][0].text == by_id[3][0].text == ""
    assert by_id[4][0].text == PARAGRAPH * 3000 and by_id[5][0].text == PARAGRAPH and len(by_id[6]) == 2
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# urls


def _plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    after = rest[len(host) :]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split(r"[?#]", after, maxsplit=1)[0]


def _plain_rule(host, path):
    fitting = [
        (p, v) for p, v in ((r.pattern, r.verdict) for r in URL_RULES)
        for h, _, rest in [p.partition("/")]
        if (host == h or host.endswith("." + h)) and path.startswith("/" + rest)
    ]
    return max(fitting, key=lambda x: len(x[0]), default=(None, None))


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "http://a.net", "http://net/", "http://xnet/", "http://a.example.net/en/1?x=/de/",
    "http://a.example.net/EN/1", "https://example.com/de/x#y", "https://notexample.com/de/x", "http://x.org/fr/", "http://x.org/fr",
    "http://x.org//fr/", "a://b://c.net/", "http://É.example.NET/en/", "http://h/1/2/3/4/5/6/7", "http://h?/en/", "http://x.net/\n?a",
]


def test_rules_decide_first(spark):
    rows = [(n, u) for n, u in enumerate(URLS)] + [(None, URLS[5]), (3, URLS[3]), (3, URLS[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = judge_urls(pages, URL_RULES)
    expected = []
    for page_id, url in rows:
        host, path = _plain_split(url)
        expected.append((page_id, host, path, *_plain_rule(host, path)))
    got = [tuple(r)[:4] + (r.verdict if r.rule else None,) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert collected(judge_urls(clashing(pages), URL_RULES)) == collected(found)
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []


def test_templates_carry_labels_to_unlabelled_urls(spark):
    rows = [(n, f"http://a.x/promo/item{n}/{n}.html", True if n < 40 else None) for n in range(80)]
    rows += [(100 + n, f"http://a.x/news/story{n}/{n}.html", False if n < 40 else None) for n in range(80)]
    rows += [(200 + n, f"http://b.x/promo/{n}", None) for n in range(5)] + [(300, "http://c.x/one", True)]
    pages = spark.createDataFrame(rows, "page_id long, url string, spam boolean")
    found = {r.page_id: r for r in judge_urls(pages, [UrlRule("b.x/promo/", "allow")], bad=pages["spam"]).collect()}
    assert {found[n].verdict for n in range(80)} == {"block"} and found[60].template == "/promo/*/{n}.html"
    assert {found[n].verdict for n in range(100, 180)} == {"allow"}
    assert found[300].verdict == "allow"  # one label decides nothing
    assert {found[n].rule for n in range(200, 205)} == {"b.x/promo/"}
    strict = TemplateOptions(reject=0.5)
    assert judge_urls(pages, [], bad=pages["spam"], options=strict).filter("page_id = 300").first().verdict == "block"


# packing


def _plain_best_fit(histogram, options, credit, least):
    capacities, bins = sorted(options.capacities), []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [b for b in bins if b[0] - b[1] >= length]
            if fitting:
                min(fitting, key=lambda b: b[0] - b[1])[1] += length
            else:
                def price(c):
                    return (options.cost(c) - credit * (c % length)) / (c // length), c

                bins.append([min((c for c in capacities if c >= max(length, least)), key=price), length])
    return sorted((next(c for c in capacities if c >= b[1]), b[1]) for b in bins)


def test_plans_equal_one_item_at_a_time():
    rnd = random.Random(3)
    for _ in range(120):
        options = packing.Packing(tuple(sorted(rnd.sample(range(5, 60), rnd.randint(1, 4)))), rnd.choice([0, 3]))
        histogram = {}
        for _ in range(rnd.randint(0, 50)):
            histogram[rnd.randint(1, max(options.capacities))] = rnd.choice([1, 1, 2, 9])
        for credit, least in itertools.product(options.credits, options.capacities):
            plan = packing.best_fit(histogram, options, credit, least)
            bins = sorted((capacity, used) for _, count, capacity, used in plan.bins for _ in range(count))
            assert bins == _plain_best_fit(histogram, options, credit, least)


def test_pieces_fill_their_bins_without_gaps(spark):
    rnd = random.Random(9)
    rows = [(n, rnd.choice([1, 7, 40, 100, 101, 250, None, 0, -3])) for n in range(400)] + [(None, 5), (1, 7), (1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, length long")
    options = packing.Packing((20, 50, 100), overhead=2, bucket_rows=50)
    found = packing.pack(clashing(docs.withColumnRenamed("length", "size")), "size", options=options).collect()
    assert sum(r.length for r in found) == sum(max(n or 1, 1) for _, n in rows)
    bins = {}
    for r in found:
        bins.setdefault(r.bin_id, []).append(r)
    assert sorted(bins) == list(range(len(bins)))
    for own in bins.values():
        place = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert own[0].capacity == min(c for c in options.capacities if c >= place)
    whole = {}
    for r in found:
        whole.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    assert whole[next(i for i, n in rows if n == 250)] != []
    for doc_id, size in rows:
        if doc_id not in (None, 1) and size == 250:
            assert sorted(whole[doc_id]) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert packing.pack(spark.createDataFrame([], "doc_id long, length long")).collect() == []


# coding and components


def test_blocks_come_back():
    rnd = np.random.default_rng(1)
    for n in range(12):
        most = [1, 3, 50, 50257, 65536][n % 5]
        blocks = [rnd.integers(0, most, rnd.integers(0, 200)).astype(np.int32) for _ in range(rnd.integers(0, 30))]
        back = id_coder.decode_blocks(id_coder.encode_blocks(blocks), [len(b) for b in blocks])
        assert [b.tolist() for b in back] == [b.tolist() for b in blocks]
    repeated = [np.tile(np.arange(50, dtype=np.int32), 100)]
    assert len(id_coder.encode_blocks(repeated)[0]) < 1000


def test_running_sums_equal_plain_counts():
    rng, step = np.random.default_rng(15), id_coder.STEP
    for symbols, longest in ((3, 100), (32, 100), (64, 20_000)):
        counts, plain = id_coder._Counts(5, symbols, longest), np.ones((5, symbols), np.int64)
        assert step * longest + symbols <= np.iinfo(counts.kind).max
        for _ in range(100):
            contexts = rng.permutation(5)[:3]
            symbol, rows = rng.integers(0, symbols, 3), counts.rows(contexts)
            before = np.array([plain[c, :s].sum() for c, s in zip(contexts, symbol)])
            low, freq = counts.bounds(rows, symbol)
            assert (low == before).all() and (freq == plain[contexts, symbol]).all()
            assert (rows[:, 0] == plain[contexts].sum(axis=1)).all()
            for share in (low, low + freq - 1):
                assert (counts.symbol(rows, share.astype(np.uint64)) == symbol).all()
            counts.add(contexts, rows, symbol)
            plain[contexts, symbol] += step


def test_long_blocks_come_back():
    blocks = [np.full(30_000, 7, np.int32), np.arange(12_000, dtype=np.int32) % 3]
    back = id_coder.decode_blocks(id_coder.encode_blocks(blocks), [len(b) for b in blocks])
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]


def test_streams_of_a_block_share_a_model(monkeypatch):
    steps, look = [], id_coder._Model.look
    monkeypatch.setattr(id_coder._Model, "look", lambda model, *last: steps.append(0) or look(model, *last))
    rng = np.random.default_rng(4)
    ids = rng.permutation(1 << 16)[(3000 * rng.random(60_000) ** 4).astype(int)].astype(np.int32)
    payload = id_coder.encode_blocks([ids])[0]
    # positions one after another, not ids
    assert len(steps) < 1000
    _, counts = np.unique(ids, return_counts=True)
    entropy = -(counts * np.log2(counts / len(ids))).sum()
    assert 8 * len(payload) < 1.2 * entropy
    assert id_coder.decode_blocks([payload], [len(ids)])[0].tolist() == ids.tolist()


@pytest.mark.parametrize("odd", [70000, 1 << 16, -1])
def test_ids_that_do_not_fit_are_an_error(odd):
    with pytest.raises(ValueError, match="65535"):
        id_coder.encode_blocks([np.array([5, 6]), np.array([1, odd, 5])])
    assert [x.tolist() for x in id_coder.decode_blocks(id_coder.encode_blocks([np.array([1, 65535, 0])]), [3])] == [[1, 65535, 0]]


def test_joined_checksums():
    rnd = random.Random(2)
    for _ in range(50):
        a, b = rnd.randbytes(rnd.randint(0, 300)), rnd.randbytes(rnd.randint(0, 300))
        assert id_coder.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 80)]
    edges += [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(7, 7), (-5, 2), (2, -9)]
    found = dict(collected(components(spark, spark.createDataFrame(edges, "a long, b long"))))
    expected = {i: 100 for i in range(100, 161)} | {1000 + i: 1000 for i in range(80)} | {300 + i: 300 for i in range(9)}
    assert found == expected | {-5: -9, 2: -9, -9: -9}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
