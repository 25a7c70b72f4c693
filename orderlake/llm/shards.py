"""Token ids written in training order to shards of fixed stride.

Every text becomes sequences of at most ``SEQUENCE`` ids. Sequences are numbered over the corpus, and a keyed
Feistel permutation with cycle-walking gives each number its global slot: the training order needs no
sort key, no random state and no table. A shard is a range of slots; its file holds one record for each slot,
all of the same size, so the place of a slot follows by arithmetic and a reader starts anywhere.

Texts are encoded twice, once to count and once to write, so that ids are moved only once and
never stored in between. The splitting pattern's look-ahead takes some two fifths of the encoding, so texts are encoded
without it, after they are cut where it would. Both passes must see the same partitions: ``docs`` is a plain read of files, and a
partition that changed between the passes fails the job. A file is written aside and moved into place when it is
whole, so a lost or repeated task leaves no part of one.

Defined results: a null or empty text is one sequence that holds the end token alone; a text of any length is
encoded whole and gives as many sequences as its ids fill; each of several equal rows has its own sequences (no two
numbers and so no two slots tie); a null doc_id is written like any other; other columns are not read; an empty table gives no
shard and an empty manifest.
"""

from __future__ import annotations

import base64
import re
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Ids of a sequence and slots of a shard.
SEQUENCE, SHARD_SLOTS = 512, 16_384
ROUNDS = 6
#: A record: the number of ids, then the ids padded with the end token.
RECORD = np.dtype([("n", "<u4"), ("ids", "<u2", SEQUENCE)])

#: The splitting pattern of the public file, which leaves the last of several white-space characters to what follows, by looking ahead.
LOOKING_AHEAD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of that pattern's library, and the characters behind which the look-ahead cuts. No other place of a text depends on it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = re.compile(f"[{WHITE}](?=[{WHITE}][^{WHITE}])")

#: Spelling of the end token for the library, which wants one to hand over ids as a buffer; in a text it is text like any other.
UNUSED = "\U0010ffff"

MANIFEST = "slot long, shard long, record long, doc_id string, piece int, n_tokens int, crc32 long"


def address(root: str) -> str:
    """``root`` as pyarrow spells it: Hadoop may say ``file:/a`` for a local folder, and ``s3a`` or ``s3n`` for ``s3``."""
    scheme, colon, rest = root.partition(":")
    if not colon:
        return root
    if scheme == "file" and not rest.startswith("//"):
        rest = f"//{rest}"
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``root`` and the folder in it."""
    return fs.FileSystem.from_uri(address(root))


def encoder(ranks_path: str, pattern: str):
    """The encoder of this worker process, and its end token (the first free id)."""
    import tiktoken

    shared = sys.modules.setdefault("_shard_encoders", types.ModuleType("_shard_encoders")).__dict__
    key = f"{ranks_path} {pattern}"
    if key not in shared:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        shared[key] = tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={UNUSED: len(ranks)}), len(ranks)
    return shared[key]


def ids_of(text: str | None, encoding, end: int) -> np.ndarray:
    return _ended(encoding.encode_to_numpy(text or "", disallowed_special=()), end)


def _ended(found: np.ndarray, end: int) -> np.ndarray:
    out = np.empty(len(found) + 1, np.uint16)
    out[:-1], out[-1] = found, end
    return out


def text_ids(ranks_path: str, pattern: str) -> tuple[Callable[[str | None], np.ndarray], int]:
    """What gives the same as ``ids_of`` with ``pattern``, sooner where it is the public one; and the end token."""
    if pattern != LOOKING_AHEAD:
        encoding, end = encoder(ranks_path, pattern)
        return lambda text: ids_of(text, encoding, end), end
    encoding, end = encoder(ranks_path, pattern.replace(r"\s+(?!\S)|", ""))

    def ids(text: str | None) -> np.ndarray:
        cut, times = CUT.subn(rf"\g<0>{UNUSED}", text or "")
        if not times:
            return ids_of(text, encoding, end)
        if UNUSED in text:  # cannot mark a cut
            ends = [m.end() for m in CUT.finditer(text)]
            parts = [encoding.encode_to_numpy(text[a:b], disallowed_special=()) for a, b in zip([0, *ends], [*ends, None])]
            return _ended(np.concatenate(parts), end)
        found = encoding.encode_to_numpy(cut, allowed_special={UNUSED}, disallowed_special=())
        return _ended(found[found != end], end)

    return ids, end


def permute(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Slots of ``numbers``: a bijection of 0 ... size - 1 that depends on ``key``."""
    half = max(1, ((max(2, size) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    seeds = np.random.default_rng(key).integers(1, 1 << 63, ROUNDS, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for seed in seeds:
            mixed = (right + seed) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(32)) & mask
        return left << np.uint64(half) | right

    out = once(numbers.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():  # walk on along the cycle until back inside
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _sequences(n: int) -> int:
    return -(-n // SEQUENCE)


def counts(docs: DataFrame, ranks_path: str, pattern: str) -> dict[int, int]:
    """Sequences of each partition of ``docs``: one number for each partition comes to the driver."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, _ = text_ids(ranks_path, pattern)
        total = sum(_sequences(len(ids(text))) for frame in frames for text in frame["text"])
        yield pd.DataFrame({"partition": [TaskContext.get().partitionId()], "n": [total]})

    return {r["partition"]: r["n"] for r in docs.select("text").mapInPandas(count, "partition int, n long").collect()}


def write_shards(docs: DataFrame, root: str, ranks_path: str, pattern: str, key: int = 1) -> DataFrame:
    """Write all of ``docs`` (doc_id, text) under ``root``; returns the manifest, one row for each slot."""
    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    # both passes read the same columns, so that files are cut into the same partitions
    found = counts(narrow, ranks_path, pattern)
    size = sum(found.values())
    first, at = {}, 0
    for partition in sorted(found):
        first[partition] = at
        at += found[partition]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of_text, _ = text_ids(ranks_path, pattern)
        partition = TaskContext.get().partitionId()
        done = 0
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = ids_of_text(text)
                rows += [(doc_id, p, ids[p * SEQUENCE : (p + 1) * SEQUENCE].tobytes()) for p in range(_sequences(len(ids)))]
            if not rows:
                continue
            slots = permute(np.arange(len(rows)) + first[partition] + done, size, key)
            done += len(rows)
            yield pd.DataFrame({
                "slot": slots, "shard": slots // SHARD_SLOTS, "doc_id": [r[0] for r in rows], "piece": [r[1] for r in rows], "ids": [r[2] for r in rows],
            })
        if done != found.get(partition, 0):
            raise RuntimeError("the partitions of the documents changed between the passes")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, end = text_ids(ranks_path, pattern)
        store, folder = opened(root)
        store.create_dir(folder, recursive=True)
        current, out, aside = None, None, ""

        def close() -> None:
            if out is not None:
                out.close()
                store.move(aside, f"{folder}/shard-{current:08d}.bin")

        for frame in frames:
            for shard, part in frame.groupby("shard", sort=False):
                if shard != current:
                    close()
                    current, aside = shard, f"{folder}/.{shard}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(aside)
                block = np.zeros(len(part), RECORD)
                block["ids"] = end
                for row, ids in enumerate(part["ids"]):
                    values = np.frombuffer(ids, np.uint16)
                    block["n"][row] = len(values)
                    block["ids"][row, : len(values)] = values
                out.write(block.tobytes())
            yield pd.DataFrame({
                "slot": frame["slot"], "shard": frame["shard"], "record": frame["slot"] % SHARD_SLOTS, "doc_id": frame["doc_id"], "piece": frame["piece"],
                "n_tokens": [len(x) // 2 for x in frame["ids"]], "crc32": [zlib.crc32(x) for x in frame["ids"]],
            })
        close()

    placed = narrow.mapInPandas(place, "slot long, shard long, doc_id string, piece int, ids binary")
    ranged = placed.repartition("shard").sortWithinPartitions("slot")
    manifest = durable(ranged.mapInPandas(write, MANIFEST))
    return manifest.withColumn("doc_id", F.col("doc_id").cast("long"))


def read_slots(root: str, start: int, n: int) -> list[np.ndarray]:
    """Ids of the slots from ``start`` on, at most ``n``, read in order from the one place where they begin."""
    store, folder = opened(root)
    out: list[np.ndarray] = []
    while n > 0:
        shard, record = divmod(start, SHARD_SLOTS)
        path = f"{folder}/shard-{shard:08d}.bin"
        if store.get_file_info(path).type == fs.FileType.NotFound:
            break
        with store.open_input_file(path) as source:
            source.seek(record * RECORD.itemsize)
            data = source.read(min(n, SHARD_SLOTS - record) * RECORD.itemsize)
        block = np.frombuffer(data, RECORD)
        out += [row["ids"][: row["n"]].copy() for row in block]
        n, start = n - (SHARD_SLOTS - record), (shard + 1) * SHARD_SLOTS
    return out
