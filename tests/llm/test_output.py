"""Packing, training shards, page text, the pipeline."""

import itertools
import json
import random
import time
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from llm_rows import ODD_ROWS, SF_DIR, prose
from tokenizers import Tokenizer

import corpus_pipeline
from orderlake.llm import html, packing, shards, tokens
from orderlake.llm.queries import QUERIES

BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# --- packing -----------------------------------------------------------------------
def test_ids_equal_the_tokenizer():
    encoder, plain = tokens.load(BPE), Tokenizer.from_file(BPE)
    texts = [
        "I'M don't  <|endoftext|> x", "İstanbul ŞŞ ½ 12 á ", "", " ", "\x1c a\x85b", "it's!'s '' 'll'd", "Σίσυφος ΣΑΣ", "日本語テキスト", "²³¼ ªº ﬁ…—“”",
        "ǅ ŉ Ǆx ¡¿ Þß€ # ## a­b \xa0c 'S 'LL O'RE", prose(3, 400), "a" * 5000, "\t\n\r\x0b\x0c", "é café",
    ]
    for text in texts:
        assert np.frombuffer(encoder.text(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_merges_are_those_of_byte_pairs_in_order_of_ids():
    """Merging the adjacent pair with the smallest id gives what the file's merges give, as each token comes from its own merge alone."""
    model = json.loads(Path(BPE).read_text())["model"]
    vocabulary, merges = model["vocab"], [tuple(m) for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in merges]
    assert made == sorted(set(made)) and len(vocabulary) == len(made) + 512 and min(made) == 512
    assert len(tokens.byte_ranks(vocabulary)) == len(vocabulary)
    rank = {m: i for i, m in enumerate(merges)}
    for a, b in merges:
        ended, symbols = (a + b).endswith("</w>"), list((a + b).removesuffix("</w>"))
        if ended:
            symbols[-1] += "</w>"
        while len(symbols) > 2:
            best = min(range(len(symbols) - 1), key=lambda k: rank.get((symbols[k], symbols[k + 1]), len(rank)))
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        assert tuple(symbols) == (a, b)


def test_ids_of_random_plain_texts_equal_the_tokenizer():
    encoder, plain = tokens.load(BPE), Tokenizer.from_file(BPE)
    choice = random.Random(5).choice
    plain_characters = [c for c in map(chr, range(0x20AD)) if tokens.PLAIN.fullmatch(c)]
    for alphabet in (plain_characters, "'strevmld ,.!", "ab1²½ \n'-", "thean in"):
        for length in [0, 1, 2, 3, *[60] * 300, 3000]:
            text = "".join(choice(alphabet) for _ in range(length))
            assert np.frombuffer(encoder.text(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_an_encoder_remembers_no_texts():
    encoder = tokens.load(BPE)
    encoder.text("warm up")
    choice = random.Random(7).choice
    texts = [" ".join("".join(choice("abcdefgh") for _ in range(9)) for _ in range(300)) for _ in range(50)]
    tracemalloc.start()
    try:
        for text in texts:
            encoder.text(text)
        assert tracemalloc.get_traced_memory()[0] < 100_000
    finally:
        tracemalloc.stop()


def check_packed(rows, capacity=packing.CAPACITY):
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) or any(n > 1 for n in Counter((r.doc_id, r.piece) for r in rows).values())
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        end = 0
        for r in group:
            assert r.offset == end
            end += r.length
        assert end <= capacity


def test_packing_query_equals_plain_encoding(spark, documents):
    plain = Tokenizer.from_file(BPE)
    rows = QUERIES["op9_best_fit_packing"](spark, SF_DIR).collect()
    expected = {}
    for r in documents.collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            expected[r.doc_id, at // 2048] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    check_packed(rows)
    assert len({r.sequence_id for r in rows}) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("counts", [{}, {5: 1}, {10: 7}, {6: 4, 4: 3, 3: 5, 2: 1, 1: 9}, {9: 3, 8: 2, 7: 5}, {4: 3, 3: 2, 2: 2}, {5: 3, 2: 1, 3: 1}])
def test_plan_uses_each_piece_once(counts):
    made = packing.plan(counts, 10)
    used = Counter()
    for filling, times in made:
        assert times > 0 and sum(filling) <= 10
        used.update({x: n * times for x, n in Counter(filling).items()})
    assert used == Counter({k: v for k, v in counts.items() if v})
    assert sum(t for _, t in made) <= 1.5 * sum(k * v for k, v in counts.items()) / 10 + 1


def test_plan_fills_exactly_where_it_can():
    assert packing.plan({7: 5, 3: 5}, 10) == [((7, 3), 5)]
    assert packing.plan({6: 2, 3: 2, 1: 2}, 10) == [((6, 3, 1), 2)]
    assert packing.plan({5: 2, 3: 2, 1: 4}, 10) == [((5, 5), 1), ((3, 3, 1, 1, 1, 1), 1)]  # the rest best fit
    assert all(sum(filling) == 10 for filling, _ in packing.plan({4: 2, 3: 2, 2: 2, 1: 2}, 10))


def test_odd_and_empty_tables_are_packed(odd, none):
    rows = packing.pack(odd, BPE).collect()
    check_packed(rows)
    assert sum(r.piece == 0 for r in rows) == len(ODD_ROWS) and sum(r.doc_id == 6 for r in rows) > 10
    assert [(r.length, r.ids_crc32) for r in rows if r.doc_id == 1] == [(1, zlib.crc32(bytes(4)))]
    assert packing.pack(none, BPE).count() == 0


# --- shards ------------------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation_is_a_bijection_by_key(size):
    orders = [shards.permute(np.arange(size), size, key).tolist() for key in (1, 2)]
    assert all(sorted(o) == list(range(size)) for o in orders) and (size < 64 or orders[0] != orders[1])


def test_shards_round_trip(spark, odd, none, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_SLOTS", 64)
    odd.write.parquet(f"{tmp_path}/odd")  # both passes read files
    rows = shards.write_shards(spark.read.parquet(f"{tmp_path}/odd"), f"file:{tmp_path}/a", *RANKS).collect()
    rows.sort(key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows))) and len(rows) > 128
    read = shards.read_slots(f"file:{tmp_path}/a", 0, len(rows))
    assert [zlib.crc32(x.tobytes()) for x in read] == [r.crc32 for r in rows]
    assert all((x == y).all() for x, y in zip(shards.read_slots(f"{tmp_path}/a", 60, 10), read[60:70]))  # across two shards
    encoding, end = shards.encoder(*RANKS)
    parts = {}
    for r, ids in zip(rows, read):
        parts.setdefault(r.doc_id, {}).setdefault(r.piece, ids)
    texts = {i: encoding.decode(np.concatenate([p[k] for k in sorted(p)])[:-1].tolist()) for i, p in parts.items()}
    assert texts == {r[0]: r[1] or "" for r in ODD_ROWS}
    assert sum(r.piece == 0 for r in rows) == len(ODD_ROWS)
    assert shards.write_shards(none, f"file:{tmp_path}/b", *RANKS).count() == 0


def test_ids_equal_plain_encoding():
    encoding, end = shards.encoder(*RANKS)
    for text in [None, "", "I'll  go\n\n", f"a{shards.UNUSED}b {shards.UNUSED}", "<|endoftext|> x", "été \U0001F600 日本", prose(3, 2000), "a" * 5000]:
        found = shards.ids_of(text, encoding, end)
        assert found.dtype == np.uint16 and found.tolist() == [*encoding.encode_ordinary(text or ""), end], text


def test_ids_without_look_ahead_equal_plain_encoding():
    assert public_tokenizers.PATTERN == shards.LOOKING_AHEAD  # or the slower pattern is taken
    (ids, end), (encoding, _) = shards.text_ids(*RANKS), shards.encoder(*RANKS)
    choice = random.Random(3).choice
    texts = [None, "", " ", "a  b", "a\n\n  b \t", "  x", "x  ", f"a  {shards.UNUSED} b", f"  {shards.UNUSED}", "<|endoftext|>   x", "if x:\n    y = 1\n\n\treturn  y "]
    for alphabet in (" \n\ta'1.", "é \u3000\x85\xa0\x1c\x1f\u2028 ", f" \n{shards.UNUSED}a!"):
        texts += ["".join(choice(alphabet) for _ in range(choice(range(14)))) for _ in range(2000)]
    for text in texts:
        found = ids(text)
        assert found.dtype == np.uint16 and found.tolist() == [*encoding.encode_ordinary(text or ""), end], text
    other = RANKS[0], r"\S+\s*(?!x)|\s"
    assert shards.text_ids(*other)[0]("a  xb  c").tolist() == [*shards.encoder(*other)[0].encode_ordinary("a  xb  c"), end]


def test_addresses():
    spelled = {"file:/a/b": "file:///a/b", "file:///a": "file:///a", "/a": "/a", "s3a://b/x": "s3://b/x", "s3n://b/x": "s3://b/x", "hdfs://h:8020/x": "hdfs://h:8020/x"}
    assert {root: shards.address(root) for root in spelled} == spelled


def plain_slot(number: int, size: int, key: int) -> int:
    """The permutation, one number at a time."""
    half = 1
    while 4**half < size:
        half += 1
    seeds = [int(x) for x in np.random.default_rng(key).integers(1, 1 << 63, shards.ROUNDS, dtype=np.uint64)]
    while True:
        left, right = number >> half, number % 2**half
        for seed in seeds:
            mixed = (right + seed) % 2**64 * 0x9E3779B97F4A7C15 % 2**64
            mixed = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 % 2**64
            left, right = right, left ^ (mixed >> 32) % 2**half
        number = left * 2**half + right
        if number < size:
            return number


def test_training_shards_equal_plain_encoding_and_permutation(spark):
    encoding, end = shards.encoder(*RANKS)
    expected = []
    for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        ids = [*encoding.encode_ordinary(row.text or ""), end]
        for piece, start in enumerate(range(0, len(ids), shards.SEQUENCE)):
            part = np.array(ids[start : start + shards.SEQUENCE], "<u2")
            expected.append((row.doc_id, piece, len(part), zlib.crc32(part.tobytes())))
    found = QUERIES["op4_training_shards"](spark, SF_DIR).collect()
    assert len(found) == len(expected) > 200
    assert all((r.shard, r.record) == divmod(r.slot, shards.SHARD_SLOTS) for r in found)
    at = {r.slot: (r.doc_id, r.piece, r.n_tokens, r.crc32) for r in found}
    assert at == {plain_slot(n, len(expected), 1): row for n, row in enumerate(expected)}


# --- pages -------------------------------------------------------------------------
PAGE = """<!doctype html><html><head><title>t</title><style>p{{a:b}}</style><script>var x="</p><article>";</script></head><body>
<header class="top">Site</header><nav><ul><li><a href="/">Home</a><li>About</ul></nav><div class="ad-box ad">Buy</div>
<{0}><h1>Head &amp; line</h1><p>One&nbsp;two<br>three <b>four</b> &#x1F600;<p>caf&eacute; &lt;x&gt;<!-- no --><ul><li>a<li>b</ul>
<div class="share">Share</div><form><input value="x">Send</form><aside>Side</aside><section id="comments"><p>First!</section></{0}>
<footer>&copy; Site</footer></body></html>"""
MAIN = "Head & line\nOne two three four \U0001F600\ncafé <x>\na\nb"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_main_element(spark, tag):
    pages = [(i, "https://a.example/x", PAGE.format(tag)) for i in range(3)]
    for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        assert (r.text, r.n_chars) == (MAIN, len(MAIN))


SHARED = "these words stand on each of the pages of the host and belong to none"


@pytest.mark.parametrize("group", [400, 1])
def test_runs_shared_by_pages_go_and_unique_ones_stay(spark, group):
    own = [prose(i, 25) for i in range(5)]
    pages = [(i, f"http://h{i % 2}.example/{i}", f"<body><p>{SHARED}</p><p>{own[i]}</p><footer>{prose(60 + i, 9)}</footer>") for i in range(4)]
    pages += [(4, "http://other.example/", f"<p>{SHARED}</p>"), (4, "http://other.example/", f"<p>{SHARED}</p>")]  # one page, twice
    found = sorted((r.page_id, r.text) for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), group).collect())
    assert found == [(i, own[i]) for i in range(4)] + [(4, SHARED)] * 2


@pytest.mark.parametrize("group", [400, 1])
def test_copies_of_a_page_are_one_page(spark, group):
    own, other = prose(30, 40), prose(31, 40)
    pages = [(i, f"http://m.example/{i}?from={i}", f"<body><p>{SHARED}</p><p>{own}</p>") for i in range(2)]
    pages += [(2, "http://m.example/other", f"<body><p>{SHARED}</p><p>{other}</p>")]
    found = sorted((r.page_id, r.text) for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), group).collect())
    assert found == [(0, own), (1, own), (2, other)]


@pytest.mark.parametrize("sizes", [{}, {"group_pages": 3}, {"group_pages": 3, "few_runs": 0}])
def test_runs_are_found_between_any_two_pages_of_a_host_of_any_size(spark, sizes):
    # each line but for a counter stands on two pages only; two words are no run
    own, lines = [prose(900 + i, 12) for i in range(24)], [prose(940 + i, 20) for i in range(12)]
    pages = [(i, f"http://large.example/{i}", f"<p>{lines[i % 12]} {i}</p><p>Thank you.</p><p>{own[i]}</p>") for i in range(24)]
    found = sorted((r.page_id, r.text) for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), **sizes).collect())
    assert found == [(i, f"Thank you.\n{own[i]}") for i in range(24)]


def test_names_inside_an_article():
    def zone(element):
        return [z for z, _ in html.blocks(f"<article><p>First</p>{element}</article>")][1:]

    for side in ('<div class="comment-list">x</div>', '<p class="ad-300x250 left">x</p>', '<div id="related-posts share">x</div>', '<ul role="menu"><li>x</ul>', "<p hidden>x</p>"):
        assert zone(side) == ["side"], side
    for doubt in ('<div class="article-header"><h2>x</h2></div>', '<p class="notice">x</p>', '<div class="social-history">x</div>', '<section id="related-work">x</section>'):
        assert zone(doubt) == ["doubt"], doubt
    for none in ('<p class="address">x</p>', '<p data-id="share" title="class=ad">x</p>', "<header><h2>x</h2></header>", '<p class="lead">x</p>'):
        assert zone(none) == ["main"], none
    assert html.blocks('<div class="article-header">x</div>') == [("side", "x")]


@pytest.mark.parametrize("group", [400, 1])
def test_runs_decide_what_is_in_doubt(spark, group):
    pages = [
        (i, f"http://d.example/{i}", f"<article><p class=notice>{SHARED}</p><p class=notice>{prose(300 + i, 9)}</p><p>{SHARED}</p></article><p>{prose(310 + i, 9)}</p>")
        for i in range(3)
    ]
    found = html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), group).collect()
    assert sorted((r.page_id, r.text, r.n_run_tokens) for r in found) == [(i, f"{prose(300 + i, 9)}\n{SHARED}", len(SHARED.split())) for i in range(3)]


@pytest.mark.parametrize("group", [400, 1])
def test_a_shared_passage_between_unique_ones_stays(spark, group):
    own = [prose(320 + i, 12) for i in range(8)]
    frame, end = prose(340, 20), prose(341, 15)
    pages = [(i, f"http://p.example/{i}", f"<p>{frame}</p><p>{own[i]}</p><p>{SHARED}</p><p>{own[i + 4]}</p><p>{end}</p>") for i in range(3)]
    pages += [(7, "http://p.example/7", f"<div>{frame}</div><p>{SHARED}</p>")]  # nothing of its own
    found = html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), group).collect()
    expected = [(i, f"{own[i]}\n{SHARED}\n{own[i + 4]}", 35) for i in range(3)] + [(7, f"{frame}\n{SHARED}", 0)]
    assert sorted((r.page_id, r.text, r.n_run_tokens) for r in found) == expected


@pytest.mark.parametrize("group", [400, 1])
def test_pages_equal_brute_force(spark, group):
    """Any two pages of a host are compared word by word; few words, so runs overlap blocks and pages."""
    rng = np.random.default_rng(11)
    kinds = ["p", "p", "p", "footer", 'p class="notice"', "article"]

    def page():
        return "".join(f"<{k}>{' '.join(map(str, rng.integers(0, 2, rng.integers(1, 14))))}</{k.split()[0]}>" for k in rng.choice(kinds, rng.integers(1, 7)))

    rows = [(i, f"http://b{i % 4}.example/{i}", page()) for i in range(48)]
    cut = {i: html.blocks(h) for i, _, h in rows}
    expected = []
    for i, _, _ in rows:
        words = {j: [(b, w) if z == "main" else w for b, (z, t) in enumerate(cut[j]) for w in (t.split() if z != "main" else [None])] for j in cut if j % 4 == i % 4}
        others = {
            tuple(w[a : a + html.RUN]) for j, w in words.items() if [t for _, t in cut[j]] != [t for _, t in cut[i]]
            for a in range(len(w) - html.RUN + 1) if not any(isinstance(x, tuple) for x in w[a : a + html.RUN])
        }
        mine, covered = words[i], [False] * len(words[i])
        for a in range(len(mine) - html.RUN + 1):
            if tuple(mine[a : a + html.RUN]) in others:
                covered[a : a + html.RUN] = [True] * html.RUN
        at, shares, counts = 0, [], []
        for z, t in cut[i]:
            size = 1 if z == "main" else len(t.split())
            counts.append(sum(covered[at : at + size]))
            shares.append(counts[-1] / size)
            at += size
        stay = html.staying([z for z, _ in cut[i]], [t for _, t in cut[i]], shares)
        expected.append((i, "\n".join(t for (_, t), s in zip(cut[i], stay) if s), sum(c for c, s in zip(counts, stay) if not s)))
    assert sum(e[2] for e in expected) > 50
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), group).collect()
    assert sorted((r.page_id, r.text, r.n_run_tokens) for r in found) == expected


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, '<a b="' * 170_000, "<a b='>" * 150_000 + '"', "<div>" * 100_000 + "</b>" * 120_000, "<script" * 140_000, "<script>" + "</script " * 110_000,
     "<" * 1_000_000, "<a " + "= " * 500_000, '<p class="' * 100_000, "<!--" * 250_000, "<p><b>" * 150_000, "<span class=ad>x" * 60_000, "word " * 200_000],
    ids=range(13),
)
def test_long_and_broken_pages_take_time_in_proportion(page):
    before = time.process_time()
    html.blocks(page)
    assert time.process_time() - before < 5


def test_broken_tags():
    assert html.blocks("<p>a < b <3</p><p title=don't>c</p>") == [("plain", "a < b <3"), ("plain", "c")]
    assert html.blocks('<p>x</p><p class="lead>y</p><p>z</p>') == [("plain", "x"), ("plain", "y"), ("plain", "z")]
    assert html.blocks("<p>x</p><p>y<p class=") == [("plain", "x"), ("plain", "y<p class=")]


def test_shared_tokens_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        token, page = rng.integers(0, 3, 120), np.sort(rng.integers(0, 6, 120))
        runs = {}
        for i in range(120 - 4):
            if page[i] == page[i + 4]:
                runs.setdefault(tuple(token[i : i + 5]), set()).add(page[i])
        expected = np.zeros(120, bool)
        for i in range(120 - 4):
            if page[i] == page[i + 4] and len(runs[tuple(token[i : i + 5])]) > 1:
                expected[i : i + 5] = True
        assert (html.shared_tokens(token, page, 5) == expected).all()


def test_odd_and_empty_pages(spark):
    schema = "page_id long, url string, html string, host string, page long"
    rows = [(1, None, None, None, None), (2, "x", "", "h", 1), (None, "http://q/", "<p>a<p", "h", 1), (3, "http://q/", "<div " * 3000 + "text", "h", 1), (4, "u", "a < b & c", "h", 1)]
    found = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, schema)).collect()}
    assert (found[1], found[2], found[None], found[4]) == ("", "", "a<p" if "<p" in found[None] else "a", "a < b & c")
    assert html.main_text(spark.createDataFrame([], schema)).count() == 0


# --- pipeline ----------------------------------------------------------------------
def test_each_stage_does_its_part(spark, documents, tmp_path):
    docs, kept = documents, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = docs.collect()
        if name != "packed sequences":
            assert docs.dtypes == documents.dtypes
    quality = {r.doc_id for r in QUERIES["op3_quality_cascade"](spark, SF_DIR).filter("kept").collect()}
    assert {r.doc_id for r in kept["quality rules"]} == quality and 0 < len(quality) < documents.count()
    near, cut, clean = ({r.doc_id: r.text for r in kept[n]} for n in ("near duplicates", "repeated passages", "benchmark leaks"))
    assert set(near) < quality and set(cut) == set(near) and set(clean) < set(cut)
    assert all(clean[i] == cut[i] for i in clean) and sum(len(t) for t in cut.values()) < sum(len(t) for t in near.values())
    packed = kept["packed sequences"]
    assert {r.doc_id for r in packed} == set(clean)
    check_packed(packed)


def test_stages_take_empty_and_odd_tables(spark, odd, none, tmp_path):
    for at, docs in enumerate((none.select("doc_id", "text", "lang", "source", "n_chars"), odd)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{at}-{number}")
            docs = spark.read.parquet(f"{tmp_path}/{at}-{number}")
    assert sorted({r.doc_id or -1 for r in docs.collect()}) == [-1, 4, 6]
