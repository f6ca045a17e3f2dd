"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A piece's bytes are mapped to Latin-1 characters, so that pyahocorasick finds
every vocabulary token in one pass. The encoder goes left to right with the
longest match at each place, takes a shorter token or steps back when a token
cannot follow its predecessor, and closes each place it stepped back from. Two
tokens can be neighbours exactly if merging by rank would keep them apart; the
answers are memoised. The result equals merging by rank, in time linear in the
piece's length.

Nulls and edges: a null or empty text has no tokens and decodes to no bytes;
repeated rows are encoded row by row; an empty table gives an empty result; input
columns with the name of an output column are replaced by it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import map_arrow

#: Distinct words and distinct pieces whose ids a Python worker remembers; beyond that it forgets them.
MEMO_PIECES = 300_000
#: Pairs of tokens of which a worker remembers whether they can be neighbours; beyond that it forgets them.
MEMO_PAIRS = 300_000
#: Bytes of text after which a worker hands back what it has encoded.
OUT_BYTES = 4 << 20
_NEVER = 1 << 62
#: A character that is neither a letter, a number nor white space.
_SYMBOL = "\u2042"
#: A single space between two characters that aren't white space. The pattern must
#: never match across such a place, other than from the space on.
_CUT = re.compile(r" (?=\S)(?<=\S )")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Characters that the regex module takes for letters or numbers and tiktoken's own expressions don't.

    The two follow different Unicode versions; a code point that one of them
    does not know yet is a symbol there.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    newer: list[str] = []
    for kind in (r"\p{L}+", r"\p{N}+"):
        plain = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        known = set(bytes(plain.encode_ordinary(every)).decode())
        newer += [c for c in "".join(regex.findall(kind, every)) if c not in known]
    return "".join(sorted(newer))


def _ranges(chars: str) -> str:
    """The inside of a character class for sorted, plain characters."""
    spans: list[list[int]] = []
    for c in map(ord, chars):
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in spans)


class Encoder:
    """Encodes and decodes with one vocabulary; ``pattern`` cuts texts into pieces.

    The characters of ``symbols`` count as symbols for the pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, symbols: str = "") -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks some single bytes")
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self._by_rank = [self.token_bytes.get(rank, b"") for rank in range(max(self.token_bytes) + 1)]
        self._find = regex.compile(pattern).findall
        self._has_symbol = re.compile(f"[{_ranges(symbols)}]").search if symbols else None
        self._as_symbol = dict.fromkeys(map(ord, symbols), _SYMBOL)
        self._fits: dict[tuple[int, int], bool] = {}
        #: Ids of words met since the last change of memos, and of those met before it.
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._packed = {rank: rank.to_bytes(4, "little") for rank in self.token_bytes}
        #: Of each token that merging reaches, the two tokens of its last merge.
        self._halves = {
            rank: (ranks[pair[0]], ranks[pair[1]])
            for token, rank in ranks.items()
            if len(pair := self._last_parts(token)) == 2
        }
        reached = {token: rank for token, rank in ranks.items() if len(token) == 1 or rank in self._halves}
        #: Of each token, its longest proper prefix that is a token, and that one's length.
        self._shorter: dict[int, tuple[int, int] | None] = {}
        self._tokens = ahocorasick.Automaton()
        for token, rank in reached.items():
            size = next((k for k in range(len(token) - 1, 0, -1) if token[:k] in reached), 0)
            self._shorter[rank] = (reached[token[:size]], size) if size else None
            self._tokens.add_word(token.decode("latin-1"), (rank, len(token)))
        self._tokens.make_automaton()

    def _last_parts(self, token: bytes) -> list[bytes]:
        """What merging by rank (lowest first, then leftmost) leaves of a token's bytes before its own merge."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(x + y, _NEVER), k) for k, (x, y) in enumerate(zip(parts, parts[1:])))
            if rank >= self.ranks[token]:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves these two tokens apart when they are neighbours.

        Takes back the later merge of the two sides again and again; before each, a
        merge across the border of a lower rank would have come first.
        """
        pair = left, right
        known = self._fits.get(pair)
        if known is None:
            known = self._fits[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        limit = _NEVER
        while True:
            if self.ranks.get(self.token_bytes[left] + self.token_bytes[right], _NEVER) < limit:
                return False
            from_left, from_right = self._halves.get(left), self._halves.get(right)
            if from_left and (left > right or not from_right):
                limit, left = left, from_left[1]
            elif from_right:
                limit, right = right + 1, from_right[0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        latin = piece.decode("latin-1")
        found = [match for _, match in self._tokens.iter_long(latin)]
        greedy = [rank for rank, _ in found]
        known = self._fits
        for k, pair in enumerate(zip(greedy, greedy[1:])):
            if not (known[pair] if pair in known else self.fits(*pair)):
                return self._backtrack(latin, greedy[: k + 1], sum([size for _, size in found[: k + 1]]), found[k + 1])
        return greedy

    def _backtrack(self, piece: str, out: list[int], at: int, match: tuple[int, int]) -> list[int]:
        """The tokens of a piece whose longest matches are ``out`` up to ``at``, where the longest one can't follow."""
        n = len(piece)
        is_open = bytearray(b"\x01") * (n + 1)
        known, shorter_of = self._fits, self._shorter
        token, size = match
        while at < n:
            pair = (out[-1], token) if out else None
            if is_open[at + size] and (pair is None or (known[pair] if pair in known else self.fits(*pair))):
                out.append(token)
                at += size
                if at < n:
                    _, (token, size) = next(self._tokens.iter_long(piece, at))
            elif shorter := shorter_of[token]:
                token, size = shorter
            else:
                is_open[at] = 0
                token = out.pop()
                size = len(self._by_rank[token])
                at -= size
        return out

    def pieces(self, text: str) -> list[str]:
        if self._has_symbol is None or text.isascii() or not self._has_symbol(text):
            return self._find(text)
        ends = np.cumsum([len(piece) for piece in self._find(text.translate(self._as_symbol))]).tolist()
        return [text[start:end] for start, end in zip([0, *ends], ends)]

    def _piece_ids(self, piece: str) -> bytes:
        known = self._pieces.get(piece)
        if known is None:
            known = self._pieces[piece] = b"".join([self._packed[token] for token in self.encode_piece(piece.encode())])
        return known

    def _learn(self, words: set[str]) -> None:
        """Memoise the ids of words that follow a space.

        Those that end in no white space are cut into pieces in one go, as they may stand next to each other.
        """
        older, known = self._older, self._words
        known.update([(word, older[word]) for word in words if word in older])
        new = [word for word in words.difference(older) if not word[-1].isspace()]
        pieces = iter(self.pieces("".join([" " + word for word in new])))
        for word in new:
            piece = next(pieces)
            left = len(word) + 1 - len(piece)
            ids = self._piece_ids(piece)
            while left:
                piece = next(pieces)
                left -= len(piece)
                ids += self._piece_ids(piece)
            known[word] = ids
        for word in words.difference(known):
            known[word] = self._text_ids(" " + word)

    def _text_ids(self, text: str) -> bytes:
        return b"".join(map(self._piece_ids, self.pieces(text)))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        first, *words = _CUT.split(text)
        if len(self._words) > MEMO_PIECES:
            self._older, self._words = self._words, {}
        if len(self._pieces) > MEMO_PIECES:
            self._pieces.clear()
        if len(self._fits) > MEMO_PAIRS:
            self._fits.clear()
        if new := set(words).difference(self._words):
            self._learn(new)
        return self._text_ids(first) + b"".join(map(self._words.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the text whose ``encode`` result is given."""
        return b"".join(map(self._by_rank.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def _encoder(vocabulary: bytes, pattern: str, symbols: str) -> Encoder:
    return Encoder(read_ranks(vocabulary), pattern, symbols)


def encode_documents(docs: DataFrame, vocabulary: bytes, pattern: str, text: str = "text") -> DataFrame:
    """Add n_tokens (long), ids (binary, little-endian unsigned 32-bit) and decoded (binary).

    ``vocabulary`` is the content of a rank file (under 1 MB for 50,000 tokens); it
    travels once in a broadcast. Each task works on its own rows: no shuffle, and
    rows leave in batches of a few MB.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, pattern, newer_characters()))
    new = ("n_tokens", "ids", "decoded")
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    source = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text).alias("_text"))
    schema = T.StructType(
        [*kept, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            start = 0
            while start < batch.num_rows:
                ids: list[bytes] = []
                decoded: list[bytes] = []
                size = 0
                while start + len(ids) < batch.num_rows and size < OUT_BYTES:
                    body = texts[start + len(ids)].as_py() or ""
                    ids.append(encoder.encode(body))
                    decoded.append(encoder.decode(ids[-1]))
                    size += len(ids[-1]) + len(decoded[-1])
                out = [batch.column(k).slice(start, len(ids)) for k in range(len(kept))]
                out += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
                start += len(ids)

    return map_arrow(source, work, schema)
