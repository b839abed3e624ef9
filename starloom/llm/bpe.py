"""Byte-level BPE of a ``tokenizers`` JSON file, one pre-token at a time.

The file's own split pattern cuts a text into pre-tokens that are merged
independently, so ids are kept per pre-token and looked up; only pre-tokens
not met before are merged. Prose made of characters on which Python's ``re``
classes agree with the Unicode ones is split by a compiled ``re`` pattern, any
other text by the library's own pre-tokenizer.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed values of the format: the split pattern of byte-level BPE and the
#: bytes that stand for themselves in its alphabet.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: The same split for characters outside UNLIKE.
_FAST = re.compile(r" ?[^\W\d_]++| ?[0-9]++|'(?:[sdmt]|ll|ve|re)| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")
#: Characters that may fall in other classes there: separators 1C-1F, Latin-1 numerals, and all
#: beyond Cyrillic but common punctuation, kana, unified ideographs and Hangul.
_UNLIKE = re.compile(
    "[^\x00-\x1b\x20-\x7f\x80-\xb1\xb4-\xb8\xba\xbb\xbf-ʯͰ-҂Ҋ-ԯ"
    "‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]")

CACHE_WORDS = 120_000  # pre-tokens kept per Python worker
CACHE_CHARS = 48  # longer ones are merged each time


def byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class BpeEncoder:
    """Ids of texts exactly as the ``tokenizers`` library gives them for the
    file at ``path`` (special strings inside a text become their ids; nothing
    is added, cut or padded). Raises ValueError for other kinds of file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
                 and not model.get("ignore_merges"))
        added = spec.get("added_tokens") or []
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self._library = Tokenizer.from_file(path)
        as_byte = byte_alphabet()
        special = {t["content"]: t["id"] for t in added}
        raw = lambda token: bytes(map(as_byte.__getitem__, token))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [c for c in as_byte if c in model["vocab"]] + [a + b for a, b in merges]
        if len(order) - len(merges) < 256 or len(set(order)) < len(order):
            raise ValueError(f"{path}: a byte is missing or two merges give one token")
        self._merge = tiktoken.Encoding("file", pat_str=SPLIT, special_tokens={},
                                        mergeable_ranks={raw(t): i for i, t in enumerate(order)})
        self._id_of = np.array([model["vocab"][t] for t in order], dtype="<u4")
        self._special = {s: np.array([i], dtype="<u4").tobytes() for s, i in special.items()}
        self._cut = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        #: Characters before the end of a cut text on which its last pre-tokens may depend.
        self.horizon = max([0, *map(len, special)]) + 8
        self._ids: dict[str, bytes] = dict(self._special)

    def _split(self, text: str) -> list[str]:
        if not _UNLIKE.search(text):
            return _FAST.findall(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens and special strings that make up ``text``."""
        if self._cut is None or not self._cut.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += self._split(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._split(text[at:])

    def ids_of(self, pretokens: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each pre-token."""
        known = self._ids
        try:
            return list(map(known.__getitem__, pretokens))
        except KeyError:
            pass
        if len(known) > CACHE_WORDS:
            known.clear()
            known.update(self._special)
        out = []
        for p in pretokens:
            ids = known.get(p)
            if ids is None:
                ids = self._encode(p)
                if len(p) <= CACHE_CHARS:
                    known[p] = ids
            out.append(ids)
        return out

    def _encode(self, pretoken: str) -> bytes:
        if _UNLIKE.search(pretoken):
            return np.array(self._library.encode(pretoken, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self._id_of[self._merge.encode_ordinary(pretoken)].tobytes()

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(self.ids_of(self.pretokens(text)))

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


@lru_cache(maxsize=4)
def encoder(path: str) -> BpeEncoder:
    """One encoder per file and Python worker."""
    return BpeEncoder(path)
