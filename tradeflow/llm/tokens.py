"""Token ids of whole texts by pieces that byte-level BPE never merges across.

A single blank or line break between two non-blank characters always starts a new
pretoken, so a text can be cut there and the pieces encoded once each.  Pieces repeat
(words do), so a bounded cache answers most of them; a full cache is emptied.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

#: Two blanks in a row, or a blank at either end: such texts are cut by the pattern below.
_ODD = re.compile(r"\s\s|\A\s|\s\Z")
_CUT = re.compile(r"(?<=\S)([ \n])(?=\S)")
#: So many blanks in a row are left to the tokenizers library.
LONG_RUN = 1 << 16
_LONG = re.compile(r"\s{%d}" % LONG_RUN)
#: Cached pieces of each kind, the longest piece that is kept, and characters encoded at a time.
MAX_PIECES, MAX_PIECE_CHARS, PART_CHARS = 1 << 20, 48, 1 << 16


class PieceEncoder:
    """``encode(text)`` -> little-endian uint32 ids, given ``encode_many`` for lists of pieces."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]]):
        self.encode_many = encode_many
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.line_break = encode_many(["\n"])[0]

    def _lookup(self, cache: dict[str, bytes], words: list[str], prefix: str) -> list[bytes]:
        found = list(map(cache.get, words))
        if None in found:
            places = [k for k, x in enumerate(found) if x is None]
            missing = list({words[k] for k in places})
            new = dict(zip(missing, self.encode_many([prefix + w for w in missing])))
            for k in places:
                found[k] = new[words[k]]
            if len(cache) + len(new) > MAX_PIECES:
                cache.clear()
            cache.update((w, x) for w, x in new.items() if len(w) <= MAX_PIECE_CHARS)
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(self.stream(text))

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids part by part, so that the lists of pieces follow ``PART_CHARS`` and not the text."""
        if len(text) <= 2 * PART_CHARS:
            yield self._part(text)
            return
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + PART_CHARS)
            end = cut.start() if cut and cut.start() > at else len(text)
            # A part that does not begin the text begins with its cut: a blank or a line break.
            yield self._part(text[at:end])
            at = end

    def _part(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            parts = _CUT.split(text)
            lines = [[parts[0]]]
            for sep, piece in zip(parts[1::2], parts[2::2]):
                if sep == " ":
                    lines[-1].append(piece)
                else:
                    lines.append([piece])
        else:
            lines = [line.split(" ") for line in text.split("\n")]
        rest = self._lookup(self.spaced, [w for words in lines for w in words[1:]], " ")
        out, k = [], 0
        for first, words in zip(self._lookup(self.bare, [words[0] for words in lines], ""), lines):
            out.append(first)
            out += rest[k : k + len(words) - 1]
            out.append(self.line_break)
            k += len(words) - 1
        return b"".join(out[:-1])


def byte_alphabet() -> dict[str, int]:
    """The printable character that vocabulary files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def library_ids(tokenizer_path: str) -> Callable[[str], bytes]:
    """``ids(text)`` as little-endian uint32 bytes, equal to the tokenizers library's on the same file.

    The file's vocabulary (byte-level BPE whose ids follow the merge ranks) and its added
    tokens are loaded into the faster of the two installed BPE libraries; a test compares
    both over all code points.  Its pattern engine gives up on about a million blanks in a row, so a
    text with a run of ``LONG_RUN`` is encoded by the tokenizers library itself.  One for each worker process, on one core.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in s): k for s, k in spec["model"]["vocab"].items()}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    coder = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    exact = Tokenizer.from_file(tokenizer_path)
    exact.no_truncation()
    exact.no_padding()

    def ids(text: str) -> bytes:
        if len(text) >= LONG_RUN and _LONG.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return coder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    return ids


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


__all__ = ["PieceEncoder", "library_ids", "byte_alphabet", "default_tokenizer", "MAX_PIECES"]
