"""Conversation repair, spelling variants, piecewise fingerprints."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_rows import COLUMNS, ODD_ROWS, SF_DIR, prose
from pyspark.sql import functions as F

from orderlake.llm import conversations as conv
from orderlake.llm import fingerprints as fp
from orderlake.llm import spelling
from orderlake.llm.queries import MISSPELT, QUERIES


# --- conversations -----------------------------------------------------------------
def plain_best(rows, start=conv.START, ends=conv.ENDS):
    """Every sequence of edits with at most two insertions in a row; the definition, with no bound."""
    found = []
    inserts = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            audit = gaps[0] + "".join(e + g for e, g in zip(edits, gaps[1:]))
            cost, roles, left = 0, {0: "", 1: "s", 2: "u", 3: "a"}[start], iter(rows)
            for edit in audit:
                row = None if edit == "I" else next(left)
                wanted = "a" if roles[-1:] == "u" else "u"
                if edit == "I":
                    cost, roles = cost + 5, roles + wanted
                elif edit == "D":
                    cost += 2
                elif row == "-":
                    cost = 10**6
                else:
                    cost += 5 * row.isupper() + (edit == "R")
                    roles += wanted if edit == "R" else row.lower()
            legal = not any(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])) and "x" not in roles
            if legal and "s" not in roles[1:] and (not roles or roles[0] != "a" or start == conv.ASSISTANT) and cost < 10**6:
                end = {"": 0, "s": 1, "u": 2, "a": 3}[roles[-1:]]
                if end in ends:
                    found.append((cost, audit))
    return min(found, default=None)


@pytest.mark.parametrize("seed", range(12))
def test_search_equals_trying_everything(seed):
    rng = random.Random(seed)
    for n in range(4):
        rows = "".join(rng.choice("suaxSUAX-") for _ in range(n))
        assert conv.search(rows) == plain_best(rows), rows
        start, end = rng.randrange(4), rng.randrange(4)
        assert conv.search(rows, start, (end,)) == plain_best(rows, start, (end,)), (rows, start, end)


def test_search_of_long_rows_ends_and_blocks_join_to_it():
    rng = random.Random(5)
    for n in (300, 1200):
        rows = "".join(rng.choice("suaua-uaUAx") for _ in range(n))
        whole = conv.search(rows)
        cut = [0, *sorted(rng.sample(range(1, n), 5)), n]
        joined = {(0, s): (0, "") for s in (0,)}
        for a, b in zip(cut, cut[1:]):
            step = {}
            for (first, state), (cost, audit) in joined.items():
                for end in range(4):
                    best = conv.search(rows[a:b], state, (end,))
                    if best:
                        option = (cost + best[0], audit + best[1])
                        step[first, end] = min(step.get((first, end), option), option)
            joined = step
        assert whole == min(joined[0, e] for e in conv.ENDS if (0, e) in joined)


def plain_repair(rows):
    """The contract read word by word over (turn, role, text) rows with nulls replaced."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    space = " \t\n\x0b\x0c\r"
    seen, letters, counts = set(), "", Counter()
    for _, role, text in rows:
        body = text.strip(space)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = conv.search(letters)
    out, at, state = [], 0, ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit != "D":
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            out.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def check_repair(spark, rows, columns="conv_id long, turn long, role string, text string"):
    found = {r[0]: tuple(r)[1:] for r in conv.repair(spark.createDataFrame(rows, columns).repartition(3)).collect()}
    groups = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        groups[conv_id].append((turn, " " if role is None else role, " " if text is None else text))
    assert found == {c: plain_repair(g) for c, g in groups.items()}


ODD_TURNS = [
    (1, None, "user", "First."), (1, 0, "user", "Second."), (1, 0, "assistant", "Third."), (1, 5, None, None), (1, 7, "", "No role."),
    (None, 1, "user", "Orphan."), (None, None, None, "Orphan?"), (2, 3, "assistant", ""), (2, 4, "system", "late."), (3, 9, "user", "x" * 200_000),
    (3, 10, "assistant", "Ends here! \n\t"), (4, 0, "tool", "Used."), (4, 1, "assistant", "Yes."), (4, 1, "assistant", "Yes."), (4, 2, "assistant", "Yes."),
    (5, -3, "system", "Be kind."), (5, 8, "user", "a "), (5, 9, "assistant", "b.  "), (6, 0, "user", " " * 50_000 + "end."),
]


def test_odd_conversations(spark):
    check_repair(spark, ODD_TURNS)
    wide = [(*r, 1, "k", 2) for r in ODD_TURNS]
    check_repair(spark, wide, "conv_id long, turn long, role string, text string, pos long, block string, fault int")
    assert conv.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("block", [3, 512])
def test_a_conversation_with_most_rows(spark, monkeypatch, block):
    monkeypatch.setattr(conv, "BLOCK", block)
    monkeypatch.setattr(conv, "PIECE", 200)
    rng = random.Random(2)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    rows = [(7, t if t % 11 else None, rng.choice(roles), rng.choice(["Yes.", "", f"Turn {t}.", f"Cut {t}"])) for t in range(400)]
    rows += [(8, 3, "user", "Same words.")] * 60 + [(c, t, roles[t], f"{c} {t}.") for c in range(20, 40) for t in range(4)]
    rows += [(9, t, "user", "") for t in range(30)]  # all deleted
    check_repair(spark, rows)


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(12) for t in range(20)] + [(None, None, None, None)]
    found = defaultdict(list)
    for r in conv.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        found[r.conv_id, r.turn].append((r.role, r.text))
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        expected = {0: [], 1: [(role, "")], 2: [(role, text and "One Two")], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert found[conv_id, turn] == expected.get(kind, [(role, text)])


# --- spelling ------------------------------------------------------------------------
def plain_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    out = []
    near = {w: [v for v in counts if v != w and plain_near(w, v)] for w in counts}
    form = {w: min((v for v in near[w] if counts[v] >= 5 * counts[w]), key=lambda v: (-counts[v], v), default=None) for w in counts}
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), form[word] and counts[form[word]]))
    return sorted(out)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("letters, longest, n, seed", [("ab", 9, 250, 1), ("abc", 8, 300, 2), ("aéz", 12, 250, 3), ("a", 20, 15, 4)])
def test_variants_equal_comparing_all_words(spark, letters, longest, n, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(6, longest))): 5 * 5 ** rng.randint(0, 4) for _ in range(n)}
    assert sorted_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain_variants(counts)


def test_a_chain_of_forms_ends_at_its_last(spark):
    words = ["aaaaaaaaaaaa"[:i] + "bbbbbbbbbbbb"[i:] for i in range(9)]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(words)}
    found = sorted_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == plain_variants(counts) and {r[2] for r in found} == {words[-1]}


def test_query_equals_plain_words(spark, documents):
    import re

    counts = Counter()
    for r in documents.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % MISSPELT == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert sorted_rows(QUERIES["op12_spelling_pivots"](spark, SF_DIR)) == plain_variants(counts)


def test_odd_and_empty_tables_have_words(spark, odd, none):
    words = {r.word: r.n for r in spelling.vocabulary(spelling.runs(odd)).collect()}
    counts = Counter(w for r in ODD_ROWS for w in spelling_words(r[1] or ""))
    assert words == {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6} and words
    assert spelling.variants(spelling.vocabulary(spelling.runs(none))).count() == 0


def spelling_words(text):
    import re

    return [w.lower() for w in re.findall("[A-Za-zÀ-ÿ]+", text)]


# --- fingerprints ----------------------------------------------------------------------
def plain_hashes(data):
    """The rolling hash, byte by byte."""
    out, mask = [], 2**32 - 1
    for i in range(len(data)):
        window = data[max(0, i - 6) : i + 1]
        h = sum(c * pow(0x01000193, k, 2**32) for k, c in enumerate(reversed(window))) & mask
        h ^= h >> 15
        h = h * 0x85EBCA6B & mask
        out.append(h ^ h >> 13)
    return out


def plain_fingerprint(text):
    hashes = plain_hashes(text.encode())
    level = 0
    while len(hashes) >= 64 * 2**level:
        level += 1
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def signature(k):
        out, total, seen = "", 0, Counter()
        for i, h in enumerate(hashes):
            total += h
            if h % 2**k == 0 or i == len(hashes) - 1:
                seen[total] += 1
                if seen[total] <= 2:
                    out += letters[(total * 0x9E3779B97F4A7C15 % 2**64) >> 58]
                total = 0
        return out

    return f"{level}:{signature(level)}:{signature(level + 1)}"


TEXTS = ["", "a", "été", "ab" * 40, prose(1, 3), prose(2, 30), prose(3, 400), "same line\n" * 300, "\U0001F600" * 9, "x" * 63, "x" * 64, "y" * 65, prose(4, 7000)]


def test_fingerprint_equals_the_definition():
    for text in TEXTS:
        assert fp.fingerprint(text) == plain_fingerprint(text), text[:30]
    hashes = fp.rolling(TEXTS[-1].encode())
    assert (fp.rolling(TEXTS[-1].encode()[1000:], TEXTS[-1].encode()[:1000]) == hashes[1000:]).all()


def test_repeated_lines_do_not_drown_the_rest():
    for lines in (30, 300, 3000):
        text = prose(21, 120) + "\n" + "the same line again and again\n" * lines
        kept = len(text) - len(text) // 3
        edited = text[:kept] + prose(22, 20_000)[: len(text) - kept]
        one, two = fp.fingerprint(text), fp.fingerprint(edited)
        assert len(one.split(":")[1]) < 100 and fp.likeness(one, two) > 0.1


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] if x == y else 1 + min(before[j], row[-1]))
    return row[-1]


def test_likeness_is_one_less_the_edit_distance():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(1, 64))) for _ in range(2))
        assert len(a) + len(b) - 2 * fp._common(a, b) == plain_distance(a, b)
    marks = [fp.fingerprint(t) for t in TEXTS]
    for a, b in itertools.product(marks, marks):
        assert fp.likeness(a, b) == fp.likeness(b, a) and 0 <= fp.likeness(a, b) <= 1
    assert all(fp.likeness(m, m) == 1 for m in marks)


def test_edits_stay_alike_and_strangers_do_not():
    for n in (40, 300, 3000, 20_000):
        text, other = prose(11, n), prose(12, n)
        kept = len(text) - len(text) // 3
        assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text[:kept] + other[: len(text) // 3])) > 0.5
        assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text[: kept // 2] + "one more word " + text[kept // 2 :])) > 0.85
        assert fp.likeness(fp.fingerprint(text), fp.fingerprint(other)) == 0


def plain_edits(rows):
    """Expected rows for (doc_id, text) by descending doc_id; ties among equal ids are tried by the caller."""
    out = []
    for (doc_id, text), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        given = len(text) // 3
        edited = text[: len(text) - given] + following[:given]
        own, other = fp.fingerprint(text), fp.fingerprint(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, fp.likeness(own, other), fp.likeness(own, fp.fingerprint(following))))
    return sorted(out, key=repr)


def test_fingerprint_query_equals_plain_order(spark, documents):
    rows = sorted(((r.doc_id, r.text or "") for r in documents.collect()), key=lambda r: -r[0])
    found = sorted((tuple(r) for r in QUERIES["op13_piecewise_fingerprints"](spark, SF_DIR).collect()), key=repr)
    assert found == plain_edits(rows)


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_order_with_odd_ids(spark, odd, none, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = fp.against_edits(odd).collect()
        hashes = {r.text: r.h for r in odd.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
        rows = [(r[0], r[1] or "") for r in ODD_ROWS]
        rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]] % 2**64))
        assert sorted((tuple(r) for r in found), key=repr) == plain_edits(rows)
        one = spark.createDataFrame([ODD_ROWS[3]], COLUMNS)
        assert [r.near_next for r in fp.against_edits(one).collect()] == [1.0]  # its own next
        same = spark.createDataFrame([(None, "equal rows of text")] * 50 + [(-(2**63), "a"), (2**63 - 1, "b")], "doc_id long, text string").repartition(5)
        assert fp.against_edits(same).count() == 52
        assert fp.against_edits(none).count() == 0
        assert {r.fingerprint for r in fp.fingerprints(odd).filter("text is null").select("fingerprint").collect()} == {"0::"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
