"""Operator 8, BPE encoding and decoding by a bounded-lookahead streaming transducer.

Encoding.  The last token of a prefix's BPE tokenisation determines the rest: the
tokenisation of ``b[:i]`` is that of ``b[:i - len(t)]`` followed by the one token ``t``
that ends at ``i`` and stays apart from its left neighbour, i.e. whose merges
with it never fire.  The transducer reads bytes left to right and holds, for each recent
position, only that last token.  A token that ends later starts at most as many bytes back as the longest
product that the merge list can make: this is its sufficient lookahead (products whose own bytes merge into something else
never occur, and do not count).  A boundary that the tokenisations of all positions inside the lookahead
share is stable; tokens before it are emitted and forgotten.  Every pretoken takes this way, short or long; a text is
read, encoded, decoded and hashed part by part, cut where no pretoken crosses, so a task holds one text and
small buffers.

Decoding.  Ids become bytes, and an incremental UTF-8 state machine turns bytes into
text as they come, holding at most three bytes; ill-formed bytes become U+FFFD.

Defined results: a null text counts as empty (no ids, decoded text empty); repeated rows
and null ids are answered row by row; added tokens of the vocabulary file inside a text
become their ids, as in the library; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
import unicodedata
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import MAX_PIECE_CHARS, PieceEncoder, byte_alphabet, default_tokenizer

#: The White_Space characters, and the public byte-level pattern that cuts text before the merges.
SPACES = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = r"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Remembered neighbour tests, and short pretokens; a full memory is emptied.
MAX_PAIRS = 1 << 20


#: Letters and numbers that Unicode 16.0 (the tokenizer library's version) adds to 15.1.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))


def _ranges(inside: np.ndarray) -> str:
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    return "".join(f"\\U{a:08X}-\\U{z - 1:08X}" for a, z in edges.reshape(-1, 2).tolist())


def _category(kind: str, newer: tuple[tuple[int, int], ...]) -> str:
    """The code points of a general category as a set for a pattern: the interpreter's and ``newer``.

    The pattern library's own table is of a later Unicode version than the tokenizer's; the set is that table
    with the difference taken out.  A test holds it against the tokenizer.
    """
    wanted, given = np.zeros((2, 0x110000), bool)
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    wanted[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind]] = True
    for a, z in newer:
        wanted[a : z + 1] = True
    given[list(map(ord, regex.findall(rf"\p{{{kind}}}", everything)))] = True
    out = rf"\p{{{kind}}}"
    if (given & ~wanted).any():
        out = f"[{out}--[{_ranges(given & ~wanted)}]]"
    return f"[{out}{_ranges(wanted & ~given)}]"


@lru_cache(maxsize=1)
def pretokens() -> regex.Pattern:
    return regex.compile(PATTERN.format(S=SPACES, L=_category("L", LETTERS_16), N=_category("N", NUMBERS_16)))


class Transducer:
    """A byte-level BPE vocabulary file as encoder and decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.vocab = {raw(s): k for s, k in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: By both ids: the merge's rank.  By product: rank, left and right part.
        self.rank: dict[int, int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for k, (x, y) in enumerate(merges):
            left, right = self.vocab[raw(x)], self.vocab[raw(y)]
            self.rank[left << 32 | right] = k
            self.made[self.vocab[raw(x + y)]] = (k, left, right)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {k: b for b, k in self.vocab.items()}
        self.bytes_of |= {k: s.encode() for s, k in self.added.items()}
        self.alone: dict[int, bool] = {}
        self.apart: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        #: Sufficient lookahead of the merge list: the bytes of the longest product that merging makes.
        self.lookahead = max((len(self.bytes_of[k]) for k in self.made if self._reachable(k)), default=1)
        #: Tokens read backwards, as a state machine: state << 8 | byte -> state, and each state's token (-1: none).
        self.back: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for b, k in self.vocab.items():
            state = 0
            for byte in reversed(b):
                key = state << 8 | byte
                if (state := self.back.get(key, 0)) == 0:
                    state = self.back[key] = len(self.ends)
                    self.ends.append(-1)
            self.ends[state] = k
        self.pretoken = pretokens()
        names = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(names) + ")") if names else None

    def _reachable(self, token: int) -> bool:
        """Whether BPE makes this token of its own bytes: its two parts must, and must not merge sooner."""
        if (found := self.alone.get(token)) is None:
            if token not in self.made:
                found = len(self.bytes_of[token]) == 1
            else:
                rank, left, right = self.made[token]
                found = self._reachable(left) and self._reachable(right) and self._meets(left, right) == rank
            self.alone[token] = found
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces at the token's left (0) or right (1) end while it is merged, each with the rank that ends it."""
        if (found := self.edges[side].get(token)) is None:
            found, end = [], float("inf")
            while True:
                found.append((token, end))
                if token not in self.made:
                    break
                end = self.made[token][0]
                token = self.made[token][1 + side]
            found.reverse()
            self.edges[side][found[-1][0]] = found
        return found

    def _meets(self, left: int, right: int) -> int | None:
        """The rank of the first merge across the seam of two neighbours, if one ever fires.

        Both sides are merged on their own until a pair of pieces that face each other
        has a rank below the next merge of either (at equal ranks the pair further left goes first).
        """
        a, b, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            rank = self.rank.get(x << 32 | y)
            if rank is not None and rank < x_end and rank <= y_end:
                return rank
            if x_end == y_end == float("inf"):
                return None
            if x_end <= y_end:
                i += 1
            if y_end <= x_end:
                j += 1

    def _fits(self, left: int, token: int) -> bool:
        """Whether ``token`` can follow ``left`` (-1: nothing before it) in a BPE tokenisation."""
        if (found := self.apart.get(left << 32 | token)) is None:
            if len(self.apart) >= MAX_PAIRS:
                self.apart.clear()
            found = self.apart[left << 32 | token] = self._reachable(token) and (left < 0 or self._meets(left, token) is None)
        return found

    def transduce(self, data: bytes) -> Iterator[list[int]]:
        """Ids of one pretoken of any length, in lists that are emitted as soon as they are stable."""
        back, ends, apart, fits = self.back.get, self.ends, self.apart.get, self._fits
        n, base, limit = len(data), 0, 4 * self.lookahead
        last = [-1]  # last[i]: the token that ends at base + i; last[0]: the one emitted last
        for i in range(1, n + 1):
            state, found, j = 0, [], i
            while j > base:  # the tokens that end here, by their bytes from the last to the first
                j -= 1
                if (state := back(state << 8 | data[j])) is None:
                    break
                if (token := ends[state]) >= 0:
                    found.append((j, token))
            while True:  # only one stays apart from its left neighbour, most often the longest
                if not found:
                    raise ValueError("a byte is not in the vocabulary")
                j, token = found.pop()
                left = last[j - base]
                if (good := apart(left << 32 | token)) is None:
                    good = fits(left, token)
                if good:
                    last.append(token)
                    break
            if i - base >= limit and i < n:
                if stable := self._stable(last):
                    out = self._chain(last, stable)
                    yield out
                    base, last = base + stable, [out[-1], *last[stable + 1 :]]
                limit = max(4 * self.lookahead, 2 * (i - base))  # no boundary is stable yet: look again later
        yield self._chain(last, n - base)

    def _stable(self, last: list[int]) -> int:
        """The last boundary that the tokenisations of all positions inside the lookahead share."""
        ends = set(range(max(0, len(last) - self.lookahead), len(last)))
        while len(ends) > 1:
            top = max(ends)
            ends.remove(top)
            ends.add(top - len(self.bytes_of[last[top]]) if top else 0)
        return ends.pop()

    def _chain(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return out[::-1]

    def encode_piece(self, text: str) -> list[int]:
        ids: list[int] = []
        # Added tokens stand at the odd places.
        for k, part in enumerate(self.special.split(text) if self.special and self.special.search(text) else (text,)):
            if k % 2:
                ids.append(self.added[part])
                continue
            for word in self.pretoken.findall(part):
                if (found := self.known.get(word)) is None:
                    found = [*chain.from_iterable(self.transduce(word.encode()))]
                    if len(word) <= MAX_PIECE_CHARS:
                        if len(self.known) >= MAX_PAIRS:
                            self.known.clear()
                        self.known[word] = found
                ids += found
        return ids

    @cached_property
    def decimal(self) -> list[bytes]:
        """Each id as decimal text."""
        return [b"%d" % k for k in range(max(self.bytes_of) + 1)]

    @cached_property
    def encoder(self) -> PieceEncoder:
        return PieceEncoder(lambda pieces: [array("I", self.encode_piece(p)).tobytes() for p in pieces])

    def decode(self, ids: Iterable[int], block: int = 4096) -> Iterator[str]:
        """Text as it becomes complete: an incremental byte-to-text state machine."""
        machine, ids = codecs.getincrementaldecoder("utf-8")("replace"), iter(ids)
        while part := list(islice(ids, block)):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, part)))
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each worker process: tasks share its bounded memories."""
    return Transducer(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Ids of every text and the text they decode to, as digests.  A map over the rows: no shuffle."""
    path = tokenizer_path or default_tokenizer()

    def digests(bpe: Transducer, text: str) -> tuple[int, str, str]:
        count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()

        def told(part: bytes) -> list[int]:
            nonlocal count
            ids = np.frombuffer(part, "<u4").tolist()
            ids_hash.update((b"," if count and ids else b"") + b",".join(map(bpe.decimal.__getitem__, ids)))
            count += len(ids)
            return ids

        for part in bpe.decode(chain.from_iterable(map(told, bpe.encoder.stream(text)))):
            text_hash.update(part.encode())
        return count, ids_hash.hexdigest(), text_hash.hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = transducer(path)
        for b in batches:
            found = [digests(bpe, text.as_py() or "") for text in b.column(1)]
            counts, ids_hex, text_hex = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))


__all__ = ["Transducer", "encode_decode", "op8_bpe_transducer"]
