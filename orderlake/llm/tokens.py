"""Token ids of whole texts with a public word-level BPE file, fast enough for a corpus.

The file's normalizer and splitter are applied to texts of plain Latin characters by setting every piece
between spaces; its merges are those of byte pairs in order of their ids, where the space behind a piece stands for the file's mark of a word's end.
So pieces are encoded natively, text by text, and nothing is remembered between texts.
All other texts (other scripts, control characters, special tokens) go through the tokenizer whole.
"""

from __future__ import annotations

import re
import sys
import types

import regex
from tokenizers import Tokenizer

from .common import KEPT

#: Characters whose lower case and class are the same in every Unicode version; no composition among them.
PLAIN_CHARACTERS = "\t-\r -~¡-įı-ɏ‐-―‘-‟†-…€"
PLAIN = re.compile(f"[{PLAIN_CHARACTERS}]*+")
# fixed values of the tokenizer file, which splits by '(?:CONTRACTIONS)|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+, and how it marks a word's end
CONTRACTIONS, END_OF_WORD = "s|t|re|ve|m|ll|d", "</w>"


def _all(kind: str) -> str:
    """The plain characters in lower case that are of a kind, as the inside of a class."""
    plain = regex.compile(f"[{PLAIN_CHARACTERS}]")
    lower = {chr(c).lower() for c in range(0x2100) if plain.fullmatch(chr(c))}
    return "".join(re.escape(c) for c in sorted(lower) if regex.fullmatch(kind, c))


DIGITS, SYMBOLS = _all(r"\p{N}"), _all(r"[^\s\p{L}\p{N}]")
#: All pieces of a plain text in lower case but its runs of letters; begins with one class, as the library finds that sooner than a choice.
APART = re.compile(rf"[{DIGITS}{SYMBOLS}](?:(?<=')(?:{CONTRACTIONS})|(?<=[{SYMBOLS}])[{SYMBOLS}]+|)")
#: No character of a plain text; the library wants a special token to hand over ids as a buffer.
UNUSED = "\U0010ffff"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: a printable byte is its own letter, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Ids of the bytes that tokens stand for; a space behind them is the end of a word.

    A byte and the end of a word have smaller ids than any longer token, so the end is always merged first.
    """
    byte = {letter: b for b, letter in _byte_letters().items()}
    ranks = {}
    for token, number in vocabulary.items():
        inner = token.removesuffix(END_OF_WORD)
        ranks[bytes(byte[c] for c in inner) + b" " * (inner != token)] = number
    if len(ranks) != len(vocabulary):
        raise ValueError("two tokens stand for the same bytes")
    return ranks


class TextIds:
    """Ids of texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer):
        import tiktoken

        self.tokenizer = tokenizer
        ranks = byte_ranks(tokenizer.get_vocab(with_added_tokens=False))
        self.pieces = tiktoken.Encoding("pieces", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={UNUSED: tokenizer.get_vocab_size()})

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def text(self, text: str) -> bytes:
        """Ids of a whole text."""
        if "<|" in text or not PLAIN.fullmatch(text):
            return self.whole(text)
        spaced = APART.sub(r" \g<0> ", text.lower()) + " "
        for space in "\t\n\v\f\r":
            spaced = spaced.replace(space, " ")
        return self.pieces.encode_to_numpy(spaced, disallowed_special=()).astype("<u4", copy=False).tobytes()


def load(path: str) -> TextIds:
    """The encoder of this worker process, for every task of the worker."""
    shared = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if path not in shared:
        shared[path] = TextIds(Tokenizer.from_file(path))
    return shared[path]
