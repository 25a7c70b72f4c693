"""Near copies, repeated strings, benchmark passages."""

import hashlib
import random
import sys
import types
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_rows import ODD_ROWS, SF_DIR, prose

from orderlake.llm import bwt, decontaminate, simhash, suffix, winnow
from orderlake.llm.common import KEPT
from orderlake.llm.components import components
from orderlake.llm.queries import QUERIES


# --- near copies --------------------------------------------------------------------
def fingerprint_by_hand(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_near_duplicate_query_equals_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    prints = {i: fingerprint_by_hand(t) for i, t in texts.items()}
    links = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2]
    expected = roots(links, prints)
    for r in QUERIES["op2_simhash_trie"](spark, SF_DIR).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], expected[r.doc_id]) and len(r.fingerprint) == 16


@pytest.mark.parametrize("task_pair", [8, 200, 100_000])
def test_trie_finds_every_link_at_any_depth(spark, task_pair):
    """Chains and clusters of flipped bits, and strangers, walked in one task or down the table."""
    rng = np.random.default_rng(3)
    values = set(rng.integers(0, 1 << 64, 120, dtype=np.uint64).tolist()) | {0, (1 << 64) - 1}
    for seed in list(values)[:25]:
        x = seed
        for _ in range(6):
            for bit in rng.choice(64, rng.integers(1, 4), replace=False).tolist():
                x ^= 1 << bit
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    expected = roots([(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2], signed)
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.trie_links(prints, task_pair)).collect()}
    assert {v: found.get(v, v) for v in signed} == expected


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 7)]
    hub = [(1, 1000 + i) for i in range(300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + hub, "u long, v long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[1000 + i] for i in range(300)} == {1} and 7 not in found
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_and_empty_tables(odd, none):
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()), key=str)
    assert len(found) == len(ODD_ROWS) and (1, 1) in found and (2, 1) in found and (3, 1) in found and (7, 4) in found and (None, None) in found
    assert simhash.near_duplicates(none).count() == 0 and simhash.deduplicate(none).count() == 0
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 6, 8]


# --- repeated strings -----------------------------------------------------------------
def removal_by_hand(docs, length=100):
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(data[s : s + length])
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(bytes(b for b, c in zip(data, covered) if not c)).hexdigest())
    return out


PASSAGE = prose(9, 40)
PLANTED = [
    (1, prose(11, 60) + PASSAGE + prose(12, 50)),
    (2, PASSAGE + prose(13, 70)),
    (3, prose(14, 20) + PASSAGE),
    (4, PASSAGE[:99] + prose(15, 30)),  # a byte too short
    (5, PASSAGE[:100] + prose(16, 30)),
    (6, "ab" * 400),
    (7, "é" * 130 + prose(17, 20) + "é" * 130),
    (8, prose(11, 60) + PASSAGE + prose(12, 50)),
    (9, "x" * 99), (10, "x" * 99), (11, "y" * 100), (12, "y" * 100), (13, None), (14, ""), (None, PASSAGE),
    (16, "The line that every page of this site has at its end, word for word, all of its hundred bytes and more.\n" + prose(18, 15)),
    (17, "The line that every page of this site has at its end, word for word, all of its hundred bytes and more.\n" + prose(19, 15)),
]


@pytest.mark.parametrize("sizes", [{}, {"bundle": 5, "shard_size": 2}])
def test_planted_repeats_equal_brute_force(spark, sizes):
    docs = spark.createDataFrame(PLANTED, "doc_id long, text string").repartition(4)
    found = {r.doc_id: tuple(r)[1:] for r in suffix.digest(docs, **sizes).collect()}
    assert found == removal_by_hand(PLANTED)


def test_near_copies_edited_at_chunk_borders_equal_brute_force(spark):
    text = np.random.default_rng(4).integers(97, 123, 300_000).astype(np.uint8)
    docs = [(0, text.tobytes().decode())]
    for border in (131_072, 131_408, 262_144, 262_480):
        for at in (border - 90, border - 30, border - 1, border, border + 30, border + 90):
            part = text[border - 3000 : border + 3000].copy()
            part[3000 + at - border] = 65
            docs.append((len(docs), part.tobytes().decode()))
    for k, border in enumerate((131_072, 131_408)):
        edited = text.copy()
        edited[[border - 30 - k, border + 40 + k, 262_144 - 20, 262_480 + 25]] = 66 + k
        docs.append((len(docs), edited.tobytes().decode()))
    found = {r.doc_id: tuple(r)[1:] for r in suffix.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert found == removal_by_hand(docs)


def test_surroundings_do_not_depend_on_chunks():
    text = np.random.default_rng(6).integers(97, 101, 400_000).astype(np.uint8).tobytes()
    _, at, gram, around = winnow.anchors([text], 100)
    assert len(np.unique(at)) == len(at)
    found = dict(zip(at.tolist(), zip(gram.tolist(), around.tolist())))
    for border in (131_072, 131_408, 262_144, 262_480):
        low = border - 1000
        _, place, *hashes = winnow.anchors([text[low : low + 2000]], 100)
        inner = {p + low: (g, a) for p, g, a in zip(place.tolist(), *(h.tolist() for h in hashes)) if 68 <= p < 1900}
        assert inner == {p: v for p, v in found.items() if low + 68 <= p < low + 1900}


def test_suffix_query_equals_brute_force(spark, documents):
    expected = removal_by_hand([(r.doc_id, r.text) for r in documents.collect()])
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_suffix_dedup"](spark, SF_DIR).collect()}
    assert found == expected and sum(x[1] for x in found.values()) > 0


UNNAMED = [(3, prose(601, 60) + PASSAGE), (None, prose(602, 60) + PASSAGE), (None, prose(603, 90)), (None, prose(603, 90)), (5, prose(604, 60)), (5, prose(605, 40) + PASSAGE)]


def test_texts_without_an_id_or_under_one_id_are_cut_one_by_one(spark):
    docs = spark.createDataFrame(UNNAMED, "doc_id long, text string").repartition(3)
    found = sorted(r.text for r in suffix.without_repeats(docs).collect())
    assert found == sorted([prose(601, 60) + PASSAGE, prose(602, 60), prose(603, 90), prose(603, 90), prose(604, 60), prose(605, 40)])


def test_texts_without_an_id_or_under_one_id_stay_one_by_one(spark):
    docs = [*UNNAMED, (7, prose(606, 80)), (None, prose(606, 80))]
    kept = simhash.deduplicate(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(r.text for r in kept.collect()) == sorted({text for _, text in docs})


def test_cut_texts_keep_their_columns(spark, odd, none):
    cut = suffix.without_repeats(odd)
    assert cut.dtypes == odd.dtypes and cut.count() == len(ODD_ROWS)
    rows = {r.doc_id: r for r in cut.collect()}
    assert rows[7].text == "" and rows[7].n_chars == 0 and rows[4].text == prose(1, 80) and rows[1].text is None
    assert suffix.without_repeats(none).count() == 0 and suffix.digest(none).count() == 0


def test_merged_transform_is_that_of_all_strings():
    strings = [prose(s, 12).encode() for s in range(6)] + [b"abab" * 5, b"", b"ba", prose(2, 12).encode()[5:]]
    merged = bwt.merge_all([bwt.shard(strings[i : i + 3]) for i in range(0, len(strings), 3)], 200)

    def rotations(s):
        data = merged.symbols
        ends = np.flatnonzero(data == 0)
        first = np.concatenate([[0], ends[:-1] + 1])
        k = np.searchsorted(ends, s)
        ring = data[first[k] : ends[k] + 1].tobytes()
        return (ring[s - first[k] :] + ring[: s - first[k]]) * 8

    keys = [rotations(int(s))[:200] for s in merged.rows]
    assert keys == sorted(keys) and sorted(merged.rows.tolist()) == list(range(len(merged.symbols)))
    assert [k[-1] for k in (rotations(int(s))[: len(rotations(int(s))) // 8] for s in merged.rows)] == merged.before.tolist()


@pytest.mark.parametrize("kinds", [1 << 16, 20])
@pytest.mark.parametrize("depth", [1, 7, 20, 101])
def test_blocks_and_intervals_are_those_of_plain_prefixes(monkeypatch, kinds, depth):
    """Rings shorter than a round, equal strings, every remainder of a round; by fours and by twos."""
    monkeypatch.setattr(bwt, "KINDS", kinds)
    strings = [prose(s, 12).encode() for s in (1, 2, 1, 3)] + [b"", b"a", b"ab" * 90, b"ba" * 70, b"", prose(2, 12).encode()[5:]]
    merged = bwt.merge_all([bwt.shard(strings[i : i + 2]) for i in range(0, len(strings), 2)], depth)
    laid = [s + b"\0" for s in strings]
    rotations = [((ring[i:] + ring[:i]) * (1 + depth // len(ring)))[:depth] for ring in laid for i in range(len(ring))]
    prefixes = [rotations[row] for row in merged.rows]
    assert prefixes == sorted(prefixes)
    expected = np.cumsum([0] + [a != b for a, b in zip(prefixes[:-1], prefixes[1:])])
    assert bwt.blocks(merged, depth).tolist() == expected.tolist()
    suffixes = [s[i:] for s in laid for i in range(len(s))]
    rows, interval = bwt.repeated(merged, depth)
    assert sorted(rows.tolist()) == [i for i, s in enumerate(suffixes) if len(s) > depth]
    classes = {}
    for row, number in zip(rows.tolist(), interval.tolist()):
        classes.setdefault(number, set()).add(suffixes[row][:depth])
    assert all(len(c) == 1 for c in classes.values()) and len(classes) == len(set.union(*classes.values(), set()))


# --- benchmark passages -----------------------------------------------------------------
def test_leaks_are_found_and_clean_documents_left(spark):
    bench = [(i, prose(100 + i, 30 + i)) for i in range(12)] + [(50, None), (51, ""), (52, prose(150, 200))]
    verbatim = [(i, f"{prose(200 + i, 90)} {bench[i][1].upper() if i % 2 else bench[i][1]} {prose(220 + i, 60)}") for i in range(12)]
    words = bench[3][1].split()
    near = " ".join(w for k, w in enumerate(words) if k % 7)
    docs = verbatim + [(20, prose(300, 40) + " " + near + " " + prose(301, 40)), (21, prose(302, 50) + " " + " ".join(bench[14][1].split()[90:160]))]
    clean = [(30 + i, prose(400 + i, 120)) for i in range(20)] + [(60, None), (61, ""), (None, prose(500, 20))]
    table = spark.createDataFrame(docs + clean, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, benchmark).collect()}
    assert found == {(i, i) for i in range(12)} | {(20, 3), (21, 52)}
    assert sorted(r.doc_id or -1 for r in decontaminate.decontaminate(table, benchmark).collect()) == sorted([-1, *range(30, 50), 60, 61])


@pytest.mark.parametrize("holders, others", [(20, 40), (2, 6), (9, 0)])
def test_leaks_that_many_documents_hold_are_found(spark, holders, others):
    item = prose(700, 40)
    docs = [(i, f"{prose(710 + i, 70)} {item} {prose(780 + i, 50)}") for i in range(holders)] + [(100 + i, prose(850 + i, 120)) for i in range(others)]
    table, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contaminated(table, benchmark).collect()) == list(range(holders))
    assert sorted(r.doc_id for r in decontaminate.decontaminate(table, benchmark).collect()) == [100 + i for i in range(others)]


def test_every_passage_of_a_full_block_is_found(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    often = 1 / np.arange(1, 3001)
    bench = [(i, " ".join(rng.choice(vocabulary, n, p=often / often.sum()))) for i, n in enumerate(np.tile([8, 20, 40, 64], decontaminate.BLOCK // 4))]
    # each item whole, at a place that is no window's start, among words of all items
    texts = [" ".join([*rng.choice(vocabulary, 90 + i % 16, p=often / often.sum()), item, *rng.choice(vocabulary, 90, p=often / often.sum())]) for i, item in bench]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert {(i, i) for i, _ in bench} - found == set()


def test_query_finds_what_a_search_for_runs_of_words_finds(spark, documents):
    bench = {r.item_id: decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    expected = set()
    for r in documents.collect():
        words = decontaminate.words_of(r.text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item, own in bench.items():
            grams = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
            if grams and sum(g in runs for g in grams) >= 0.6 * len(grams):
                expected.add((r.doc_id, item))
    found = {(r.doc_id, r.item_id) for r in QUERIES["op7_latent_decontamination"](spark, SF_DIR).collect()}
    assert found == expected and expected


def test_no_benchmark_and_no_documents(spark, odd, none):
    nothing = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, prose(2, 40))], "item_id long, text string")
    assert decontaminate.contaminated(odd, nothing).count() == 0 and decontaminate.decontaminate(odd, nothing).count() == len(ODD_ROWS)
    assert decontaminate.contaminated(none, some).count() == 0 and decontaminate.decontaminate(none, some).count() == 0
    clean = decontaminate.decontaminate(odd, some)
    assert clean.dtypes == odd.dtypes and clean.count() == len(ODD_ROWS) - 1


def test_common_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [0] * len(b) if False else [*(lambda prev: __import__("itertools").accumulate(range(len(b)), lambda left, j: max(left, prev[j + 1], prev[j] + (x == b[j])), initial=0))(row)]
        return row[-1]

    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = ([bytes([97 + x]) for x in rng.integers(0, 5, rng.integers(1, 80))] for _ in range(2))
        assert decontaminate.lcs(a, b) == slow(a, b)


def test_shares_are_those_of_plain_subsequences():
    rng = np.random.default_rng(3)
    parts = [[b"w%d" % w for w in rng.integers(0, 30, n)] for n in rng.integers(3, 60, 12)]
    terms = {w: t for t, w in enumerate(sorted({w for p in parts for w in p}))}
    block = decontaminate.Block(list(range(12)), parts, terms, np.ones(len(terms)), np.eye(len(terms), dtype=np.float32))
    told = 0
    for k, part in enumerate(parts):
        for _ in range(60):
            near = [w if rng.random() < 0.7 else b"w%d" % rng.integers(0, 60) for w in part if rng.random() < 0.9]
            numbers = np.array([terms.get(w, -1) for w in near], np.int64)
            share = decontaminate.lcs(part, near) / len(part)
            for above in (0.0, 0.6, 0.9):
                found = block._in_order(k, numbers, above)
                assert found == share or (found == 0 and (share < decontaminate.PARAPHRASE or share < above))
                told += found > 0
    assert told > 300


def test_candidates_are_counted_together_before_any_is_read(monkeypatch):
    """Texts of the passages' own words, shuffled or with one word over and over, are no leaks: counts tell, no candidate is read in order."""
    rng = np.random.default_rng(6)
    common = [b"c%d" % w for w in range(12)]
    parts = [[b"p%d_%d" % (k, i) if i % 3 else common[rng.integers(12)] for i in range(n)] for k, n in enumerate(rng.integers(9, 64, 40))]
    terms = {w: t for t, w in enumerate(sorted({w for p in parts for w in p}))}
    block = decontaminate.Block(list(range(40)), parts, terms, np.ones(len(terms)), np.eye(len(terms), dtype=np.float32))
    read, in_order = [], block._in_order
    monkeypatch.setattr(block, "_in_order", lambda k, near, above: read.append((k, near, above)) or in_order(k, near, above))
    clean = [" ".join(rng.choice([w.decode() for w in common], 300)) for _ in range(30)] + ["c1 " * 500, "", None]
    assert block.find(clean) == [[] for _ in clean] and not read
    assert block.find([]) == []
    leaks = [b" ".join(rng.permutation(common).tolist() * 3 + p + rng.permutation(common).tolist() * 3).decode() for p in parts]
    monkeypatch.setattr(decontaminate, "SPANS", 7)
    monkeypatch.setattr(decontaminate, "CHUNK", 16)
    found = block.find([x for pair in zip(leaks, clean * 2) for x in pair])
    assert all(k in [f[0] for f in here] for k, here in enumerate(found[::2])) and not any(found[1::2])
    # every candidate whose plain count suffices was let through
    words = np.array([terms.get(w, len(terms)) for w in decontaminate.words_of(leaks[5])], np.int64)
    last = {}
    before = np.array([(last.get(w, -1), last.update({w: i}))[0] for i, w in enumerate(words.tolist())])
    k, low = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(0, len(words), 5)))
    high = np.minimum(low + rng.integers(1, 90, len(low)), len(words))
    for passage, i, j, may in zip(k.tolist(), low.tolist(), high.tolist(), block._enough(k, low, high, words, before).tolist()):
        near, own = words[i:j].tolist(), block.numbers[passage]
        enough = min(sum(w in own for w in near), sum(w in near for w in own)) >= decontaminate.PARAPHRASE * len(own)
        assert may == enough


@pytest.mark.parametrize("start", [simhash.fingerprints, lambda docs: suffix.occurrences(docs, 100)])
def test_a_worker_lets_go_of_the_encoders_of_another_operator(spark, monkeypatch, start):
    class Docs:
        def select(self, *columns):
            return self

        def mapInPandas(self, task, schema):
            self.task = task
            return self

    docs = Docs()
    start(docs)
    monkeypatch.setitem(sys.modules, KEPT, types.ModuleType(KEPT))
    list(docs.task(iter([])))
    assert KEPT not in sys.modules


def test_vectors_reach_the_tasks_without_python_rows(spark):
    """A list of rows would be made in Python workers of another kind, which stay beside those of the operators."""
    vectors = [([0, 2], [1.0, 0.5]), ([1], [2.0]), ([0, 1, 2], [0.25, 1.0, 1.5])]
    made, plain = [], type(spark).createDataFrame
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: made.append(type(data)) or plain(self, data, *a, **k))
        space = decontaminate.latent_space(spark, vectors, 3, 3)
    dense = np.zeros((3, 3))
    for i, (terms, weights) in enumerate(vectors):
        dense[i, terms] = weights
    assert made == [pa.Table] and np.allclose(space @ space.T, np.eye(3), atol=1e-5) and np.allclose(dense @ space @ space.T, dense, atol=1e-5)


@pytest.mark.parametrize("block", [512, 40])
def test_leaks_of_every_kind_in_several_blocks(spark, monkeypatch, block):
    """Whole, shifted, reworded with the answer kept, and short items; each of equal rows; nothing in clean texts."""
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    rng = random.Random(4)
    items = [(i, " ".join(f"q{rng.randrange(3000)}" for _ in range(18 + i % 44)) + ". The answer is " + f"a{i} b{i} c{i}") for i in range(60)]

    def reworded(words, answer):
        return [w if rng.random() < 0.7 else f"other{rng.randrange(10**6)}" for w in words[:-answer]] + words[-answer:]

    docs, expected = [], {}
    for i, text in items:
        words = text.split()
        kinds = [words, words[: len(words) * 9 // 10], words[len(words) // 10 :], reworded(words, 6), reworded(words, 6)]
        doc = 10 * i
        for part in kinds:
            docs.append((doc, f"{prose(doc, 50 + doc % 37)} {' '.join(part)} {prose(doc + 5000, 40)}"))
            expected[doc] = i
            doc += 1
        docs.append((doc, prose(doc + 9000, 150)))  # clean
    docs += [docs[0], docs[0], (None, docs[1][1]), (9_999, None), (9_998, "")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([*items, (70, None), (71, " ")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(rows, benchmark).collect()}
    assert {d for d, _ in found} <= {*expected, None}
    assert sum((d, i) in found for d, i in expected.items()) >= 0.95 * len(expected)
    kept = Counter(r.doc_id for r in decontaminate.decontaminate(rows, benchmark).collect())
    assert kept == Counter(d for d, _ in docs if d not in {x for x, _ in found})
