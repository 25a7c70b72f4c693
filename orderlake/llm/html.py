"""Main text of web pages: structure marks it, runs that a host's pages share decide what structure leaves open.

A page is cut into blocks, each in a zone: ``main`` (inside an article or main element), ``doubt`` (inside one, under a
class or id that may name a side part, such as ``notice`` or ``article-header``), ``side`` (menus, headers, footers,
sidebars, adverts, forms, comments) or ``plain`` (none of these). The pages of a host lie end to end as token streams, in which
an article's sure blocks are one token that equals no other, since nothing can remove them. The suffix array of the streams gives all
long runs of tokens that stand on at least two pages. Then

* a ``main`` block stays, also where another page quotes it, and a ``side`` block goes, also where it is unique;
* a ``doubt`` block goes where runs cover it and stays where it is unique;
* on a page without a main element a ``plain`` block stays where it is unique. One that runs cover is the page's frame
  and goes, unless it stands between two longer unique blocks: then it is a passage that another page shares.
  A page all of whose plain blocks are shared keeps them, as nothing tells its frame from its text.

``n_run_tokens`` counts the tokens of removed blocks that runs cover.

The suffix array holds a whole host of up to ``GROUP_PAGES`` pages. The pages of a larger host are not dealt at all but their
runs are, by hash: the runs that stand on two pages are found in one aggregation, and cover the same tokens as the suffix array's.

Defined results: a null or empty page has an empty text; a null url is a host of its own kind; pages with
equal blocks are one page whatever their ids and urls, so copies do not make each other boilerplate; repeated rows give a row each;
an empty table gives an empty result. A page of any length is scanned once, in time in proportion to its length, broken or not: a tag whose quotes do
not close ends at the next ``>``, a ``<`` with no ``>`` behind it is text, an element that stays open ends with the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .winnow import _mix

#: Pages of a host whose streams are sorted together (more are compared by the hashes of their runs), and tokens of a run that counts.
GROUP_PAGES, RUN = 400, 8
#: Hosts that are broadcast, some 10 MB; more of them are joined by shuffle.
FEW_HOSTS = 100_000
#: Shared runs of large hosts that are sent to every task, 8 MB; more of them are joined by shuffle.
FEW_RUNS = 1_000_000
#: Share of a plain block's tokens that runs must cover for it to go.
COVERED = 0.8

#: Possessive throughout: a tag that does not end is given up after one reading.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>=]++|=)*+)>", re.S
)
BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
# fixed values: element names
RAW = frozenset("script style noscript template iframe svg canvas object textarea title math audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SIDE = frozenset("nav menu footer aside form dialog head button select fieldset".split())
CLOSED_BY_ITSELF = frozenset("p li dt dd tr td th option".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# fixed values: parts of class and id names that mark a side part, that may mark one, and that say nothing
SIDE_WORDS = frozenset(
    "nav navbar navigation menu masthead footer sidebar aside ad ads advert adverts advertisement adsense banner promo sponsor sponsored "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login share sharing "
    "comment comments reply replies respond disqus breadcrumb breadcrumbs pagination pager widget toolbar skip".split()
)
DOUBT_WORDS = frozenset("header notice notification alert social related recommended discussion search".split())
NEUTRAL_WORDS = frozenset(
    "list item items box bar area section wrapper wrap container inner outer block slot unit group row col column button buttons link links icon icons "
    "post posts articles left right top bottom main site page global primary secondary form body text title id js".split()
)
NAME_PARTS = re.compile(r"[^\s_-]+")
ATTRIBUTE = re.compile(r"""([^\s"'=/>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")


def _named(value: str, in_main: bool) -> str:
    """What the names in a class or id say: "side", "doubt" or nothing.

    Outside an article any part of a name counts. Inside one a name is sure only if all its parts are of the fixed lists, so
    that ``comment-list`` is a side part while ``article-header`` or ``social-history`` is in doubt.
    """
    found = ""
    for name in value.split():
        parts = [p for p in NAME_PARTS.findall(name) if not p[0].isdigit()]
        sure = any(p in SIDE_WORDS for p in parts)
        if not sure and not any(p in DOUBT_WORDS for p in parts):
            continue
        if not in_main or (sure and all(p in SIDE_WORDS or p in DOUBT_WORDS or p in NEUTRAL_WORDS for p in parts)):
            return "side"
        found = "doubt"
    return found


def _mark(name: str, attributes: str, in_main: bool) -> str:
    """What an element says of its blocks: "side", "doubt" or nothing."""
    if name in SIDE or (name == "header" and not in_main):
        return "side"
    found = ""
    for key, value in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in SIDE_ROLES):
            return "side"
        # a site's own name for the body or the article says nothing against it
        if key in ("class", "id") and name not in ("body", "html", "main") and not (name == "article" and not in_main):
            named = _named(value, in_main)
            if named == "side":
                return named
            found = named or found
    return found


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of every block with a word, in page order."""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    open_: list[tuple[str, bool, str]] = [("", False, "")]  # name, inside main, mark
    names: Counter[str] = Counter()  # of what is open
    page = page or ""

    def end() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, main, mark = open_[-1]
            out.append((mark or ("main" if main else "plain"), text))
        parts.clear()

    def close() -> None:
        names[open_.pop()[0]] -= 1

    at = 0
    while (start := page.find("<", at)) >= 0:
        parts.append(page[at:start])
        match = MARKUP.match(page, start)
        if match is None:
            if page.find(">", start) < 0:
                at = start
                break
            match = BROKEN.match(page, start)
            if match is None:
                parts.append("<")
                at = start + 1
                continue
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            if match[0].startswith("<![CDATA["):
                parts.append(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        closing = bool(match[1])
        if name in RAW and not closing:
            if not match[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
                at = page.find(">", stop.end()) + 1 if stop else 0
                at = at or len(page)
            continue
        if name == "br" or (name in VOID and name != "hr"):
            parts.append(" ")
            continue
        _, main, mark = open_[-1]
        marked = "" if closing or not match[3] and name not in SIDE and name != "header" else _mark(name, match[3], main)
        if name not in BLOCK and name not in SIDE and not marked and not (closing and names[name]):
            continue  # inline markup
        end()
        if closing:
            if names[name]:
                while open_[-1][0] != name:
                    close()
                close()
        elif name != "hr":
            if name in BLOCK and open_[-1][0] == "p":
                close()
            if name in CLOSED_BY_ITSELF and open_[-1][0] == name:
                close()
            _, main, mark = open_[-1]
            mark = "side" if "side" in (mark, marked) else mark or marked
            main = main or name in ("article", "main") or 'role="main"' in match[3]
            open_.append((name, main, mark))
            names[name] += 1
    parts.append(page[at:])
    end()
    return out


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` tokens at least, by prefix doubling."""
    rank, step = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while step < depth:
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


def shared_tokens(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which tokens lie in a run of ``run`` tokens that stands on at least two pages."""
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n < run:
        return covered
    order = suffix_order(tokens, run)
    inside = np.zeros(n, bool)
    inside[: n - run + 1] = page[: n - run + 1] == page[run - 1 :]  # a run does not leave its page
    order = order[inside[order]]
    if len(order) < 2:
        return covered
    same = np.ones(len(order) - 1, bool)
    for k in range(run):
        same &= tokens[order[1:] + k] == tokens[order[:-1] + k]
    interval = np.concatenate([[0], np.cumsum(~same)])
    low = np.full(interval[-1] + 1, n)
    high = np.full(interval[-1] + 1, -1)
    np.minimum.at(low, interval, page[order])
    np.maximum.at(high, interval, page[order])
    starts = order[(low < high)[interval]]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + run, -1)
    return np.cumsum(change[:-1]) > 0


def with_host(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host, row``; ``row`` is a hash of the row."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("row"))


def parsed(frame: pd.DataFrame) -> pd.DataFrame:
    """``page_id, url, host, row, page, zones, texts``; ``page`` is a hash of the blocks' texts, so copies are one page."""
    found = [blocks(x) for x in frame["html"]]
    page = np.array([xxhash.xxh64_intdigest("\n".join(t for _, t in f).encode("utf-8", "replace")) for f in found], np.uint64)
    kept = frame[["page_id", "url", "host", "row"]].assign(page=page.view(np.int64))
    return kept.assign(zones=[[z for z, _ in f] for f in found], texts=[[t for _, t in f] for f in found])


def page_blocks(pages: DataFrame) -> DataFrame:
    """Rows as ``with_host`` makes them, ``parsed``."""
    return pages.mapInPandas(lambda frames: map(parsed, frames), "page_id string, url string, host string, row long, page long, zones array<string>, texts array<string>")


def _asked(zones: list[str], texts: list[str]) -> Iterator[list[str]]:
    """Words of the blocks that runs can decide; an empty list stands for a block that stays whatever they say."""
    return ([] if z == "main" else t.split() for z, t in zip(zones, texts))


def covered_in_group(frame: pd.DataFrame, run: int = RUN) -> list[list[float]]:
    """Share of each block's tokens that runs shared by pages of the group cover."""
    ids: dict[str, int] = {}
    numbers: dict[int, int] = {}
    streams, owner, sizes = [], [], []
    breaks = 0
    for page, zones, texts in zip(frame["page"], frame["zones"], frame["texts"]):
        mine = []
        for words in _asked(zones, texts):
            breaks += not words
            mine.append([ids.setdefault(w, len(ids)) for w in words] or [-breaks])
        sizes.append([len(m) for m in mine])
        flat = [t for m in mine for t in m]
        streams.append(np.array(flat, np.int64))
        owner.append(np.full(len(flat), numbers.setdefault(page, len(numbers))))
    covered = shared_tokens(np.concatenate(streams), np.concatenate(owner), run) if streams else np.zeros(0, bool)
    sums, out, at = np.concatenate([[0], np.cumsum(covered)]), [], 0
    for size in sizes:
        ends = at + np.cumsum([0, *size])
        out.append([float(sums[b] - sums[a]) / max(1, b - a) for a, b in zip(ends[:-1], ends[1:])])
        at = int(ends[-1])
    return out


def run_hashes(host: str, zones: list[str], texts: list[str], known: dict[str, int], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of a page's runs of ``run`` tokens, hashes of the host and the run, ends of the blocks; ``known``: hashes of tokens."""
    tokens, ends, broken = [], [0], []
    for words in _asked(zones, texts):
        if not words:
            broken.append(len(tokens))
            tokens.append(0)
        for w in words:
            if (h := known.get(w)) is None:
                h = known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
            tokens.append(h)
        ends.append(len(tokens))
    stream, n = np.array(tokens, np.uint64), max(0, len(tokens) - run + 1)
    breaks = np.zeros(len(tokens) + 1, np.int64)
    breaks[np.array(broken, np.int64) + 1] = 1
    breaks = np.cumsum(breaks)
    starts = np.flatnonzero(breaks[run : run + n] == breaks[:n])
    out = np.full(len(starts), xxhash.xxh64_intdigest(host.encode("utf-8", "replace")), np.uint64)
    for k in range(run):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + stream[starts + k])
    return starts, out.view(np.int64), np.array(ends)


def covered_by(starts: np.ndarray, hashes: np.ndarray, ends: np.ndarray, shared: np.ndarray, run: int = RUN) -> list[float]:
    """Share of each block's tokens that runs among ``shared`` (sorted) cover; the rest as ``run_hashes`` gives it."""
    change = np.zeros(int(ends[-1]) + 1, np.int64)
    if len(shared) and len(hashes):
        starts = starts[shared[np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)] == hashes]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + run, -1)
    sums = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return [float(sums[b] - sums[a]) / max(1, b - a) for a, b in zip(ends[:-1], ends[1:])]


def staying(zones: list[str], texts: list[str], shares: list[float], run: int = RUN) -> list[bool]:
    """Which blocks of a page are its text; ``shares``: of each block's tokens that runs cover."""
    if "main" in zones or "doubt" in zones:
        return [z == "main" or (z == "doubt" and s < COVERED) for z, s in zip(zones, shares)]
    unique = [z == "plain" and s < COVERED for z, s in zip(zones, shares)]
    if not any(unique):
        return [z == "plain" for z in zones]
    long = [i for i, u in enumerate(unique) if u and len(texts[i].split()) >= run]
    return [z == "plain" and (u or bool(long) and long[0] < i < long[-1]) for i, (z, u) in enumerate(zip(zones, unique))]


RESULT = "page_id string, url string, text string, n_run_tokens long"


def _result(frame: pd.DataFrame, shares: list[list[float]]) -> pd.DataFrame:
    """``RESULT`` of parsed pages."""
    text, gone = [], []
    for zones, texts, share in zip(frame["zones"], frame["texts"], shares):
        stay = staying(list(zones), list(texts), share)
        text.append("\n".join(t for t, s in zip(texts, stay) if s))
        gone.append(sum(round(c * len(t.split())) for t, s, c in zip(texts, stay, share) if c and not s))
    return frame[["page_id", "url"]].assign(text=text, n_run_tokens=gone)


def shared_runs(pages: DataFrame) -> DataFrame:
    """``run``: hashes of the runs that stand on two pages of a host. What a batch repeats is settled before the shuffle."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in map(parsed, frames):
            known: dict[str, int] = {}
            found = [run_hashes(h, z, t, known)[1] for h, z, t in zip(frame["host"], frame["zones"], frame["texts"])]
            run, page = np.concatenate([np.zeros(0, np.int64), *found]), np.repeat(frame["page"].to_numpy(np.int64), [len(f) for f in found])
            order = np.lexsort((page, run))
            run, page = run[order], page[order]
            edge = np.flatnonzero(np.diff(run)) + 1
            first, last = np.append(0, edge)[: len(run)], np.append(edge, len(run))[: len(run)] - 1
            yield pd.DataFrame({"run": run[first], "low": page[first], "high": page[last]})

    seen = pages.mapInPandas(batches, "run long, low long, high long")
    return seen.groupBy("run").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("run")


def covered_in_large(pages: DataFrame, few_runs: int) -> DataFrame:
    """``RESULT`` of the pages of large hosts."""
    shared = durable(shared_runs(pages))
    if shared.count() <= few_runs:
        everywhere = np.sort(shared.toArrow()["run"].to_numpy().astype(np.int64))
    else:
        everywhere = None

        def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in map(parsed, frames):
                known: dict[str, int] = {}
                for row, host, zones, texts in zip(frame["row"], frame["host"], frame["zones"], frame["texts"]):
                    yield pd.DataFrame({"run": np.unique(run_hashes(host, zones, texts, known)[1])}).assign(row=np.int64(row))

        marks = pages.mapInPandas(runs, "run long, row long").join(shared, "run").groupBy("row").agg(F.sort_array(F.collect_set("run")).alias("runs"))
        pages = pages.join(marks, "row", "left")

    def cover(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for raw in frames:
            frame, known = parsed(raw), {}
            own = [everywhere] * len(raw) if everywhere is not None else [np.array([] if r is None else r, np.int64) for r in raw["runs"]]
            yield _result(frame, [covered_by(*run_hashes(h, z, t, known), s) for h, z, t, s in zip(frame["host"], frame["zones"], frame["texts"], own)])

    return pages.mapInPandas(cover, RESULT)


def main_text(pages: DataFrame, group_pages: int = GROUP_PAGES, few_runs: int = FEW_RUNS) -> DataFrame:
    """``page_id, url, text, n_chars, n_run_tokens`` of each row of ``pages`` (page_id, url, html)."""
    pages = with_host(pages)
    hosts = durable(pages.groupBy("host").agg((F.count("*") > group_pages).alias("large")))
    # a list of hosts counted to be small is sent to the pages, or the pages would be shuffled to it
    sizes = F.broadcast(hosts) if hosts.count() <= FEW_HOSTS else hosts
    pages = pages.join(sizes, "host").select("page_id", "url", "html", "host", "row", "large")

    def runs(frame: pd.DataFrame) -> pd.DataFrame:
        return _result(frame, covered_in_group(frame))

    found = page_blocks(pages.filter("NOT large")).groupBy("host").applyInPandas(runs, RESULT)
    if not hosts.filter("large").isEmpty():
        found = found.unionByName(covered_in_large(pages.filter("large"), few_runs))

    return found.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "n_run_tokens")
