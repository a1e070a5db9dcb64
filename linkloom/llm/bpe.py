"""Byte-level BPE encoding and decoding by prefix states on a trie of distinct words."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split of a text into words that byte-level BPE vocabularies are made for.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Words encoded so far that a task keeps; beyond that it starts afresh.
KEPT_WORDS = 500_000
#: Characters split into words at once.
PIECE_CHARS = 1 << 20

_WORDS = regex.compile(WORD_PATTERN)
_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE vocabulary."""

    def __init__(self, file: str) -> None:
        self._load(json.loads(file))

    def _load(self, file: dict) -> None:
        byte = _byte_characters()
        model = file["model"]
        self.ids = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        # Every end of a token, with the token it is itself or -1.
        self.ends = {t[i:]: -1 for t in self.ids for i in range(len(t))} | self.ids
        self.size = {i: len(t) for t, i in self.ids.items()}
        self.text = {i: str(i) for i in self.bytes}
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (bytes(byte[c] for c in t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b = self.ids[left], self.ids[right]
            self.rank[a, b] = rank
            parts.setdefault(self.ids[left + right], (a, b, rank))
        self._right = {i: self._spine(i, 1, parts) for i in self.ids.values()}
        self._left = {i: self._spine(i, 0, parts) for i in self.ids.values()}
        self._stays: dict[int, bool] = {}
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    @staticmethod
    def _spine(token: int, side: int, parts: dict) -> list[tuple[int, float]]:
        """A token and its parts along one edge, each with the rank of the merge that took it in."""
        found, until = [(token, float("inf"))], None
        while token in parts:
            until = parts[token][2]
            token = parts[token][side]
            found.append((token, until))
        return found

    def stays(self, pair: int) -> bool:
        """Whether the border between two tokens (one in the upper half) outlives all merges.

        It falls if some part at the end of the left token and some part at the start of the right
        one merge before either is taken into its own whole.  At equal rank the merge further left
        comes first.
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        stay = not any(
            rank < x_until and rank <= y_until
            for x, x_until in self._right[left]
            for y, y_until in self._left[right]
            if (rank := self.rank.get((x, y))) is not None
        )
        if len(self._stays) > 1_000_000:
            self._stays.clear()
        self._stays[pair] = stay
        return stay

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """The tokens of distinct words, by a depth-first walk of their trie.

        Sorted words visit the trie in depth-first order, and the walk keeps the path to the present
        node.  A node's state is the last token of the encoding of its prefix: the one token that
        ends there and stays apart from the last token of the prefix before it.  It is found once,
        however many words share the prefix.
        """
        ordered = sorted(words)
        ends, known, stays, size = self.ends.get, self._stays.get, self.stays, self.size
        last: list[int] = [-1]  # by depth
        encoded = []
        for word, depth in zip(ordered, shared_prefixes(ordered)):
            del last[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                hits, start = [], end - 1
                token = ends(word[start:end])
                while token is not None:
                    if token >= 0:
                        hits.append((start, token))
                    start -= 1
                    token = ends(word[start:end]) if start >= 0 else None
                while hits:
                    start, token = hits.pop()
                    if start:
                        pair = last[start] << 32 | token
                        stay = known(pair)
                        if stay is None:
                            stay = stays(pair)
                        if not stay:
                            continue
                    last.append(token)
                    break
                else:
                    raise ValueError(f"no token ends at byte {end} of {word!r}")
            tokens, end = [], len(word)
            while end:
                token = last[end]
                tokens.append(token)
                end -= size[token]
            tokens.reverse()
            encoded.append(tokens)
        return dict(zip(ordered, encoded))

    def split(self, text: str) -> Iterator[list[str | int]]:
        """The words of a text, and ids for special tokens in it, in pieces of bounded size."""
        start = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            yield from self._pieces(text[start : mark.start()])
            yield [self.special[mark[0]]]
            start = mark.end()
        yield from self._pieces(text[start:])

    @staticmethod
    def _pieces(text: str) -> Iterator[list[str | int]]:
        """Long texts are cut before a blank between letters, where a word always starts."""
        start = 0
        while len(text) - start > PIECE_CHARS and (cut := _CUT.search(text, start + PIECE_CHARS)):
            yield _WORDS.findall(text[start : cut.start()])
            start = cut.start()
        if start < len(text):
            yield _WORDS.findall(text[start:] if start else text)

    def decode(self, tokens: Iterable[int]) -> str:
        """The text of tokens; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, tokens)).decode("utf-8", "replace")


def shared_prefixes(ordered: list[bytes]) -> Iterator[int]:
    """For each of sorted words the length of the prefix it shares with the one before."""
    wide = 24
    for i in range(0, len(ordered), 65536):
        own = ordered[max(0, i - 1) : i + 65536]
        cut = np.array(own, dtype=f"S{wide}").view(np.uint8).reshape(-1, wide)
        apart = cut[1:] != cut[:-1]
        found = np.where(apart.any(1), apart.argmax(1), wide).tolist()
        if not i:
            yield 0
        for a, b, n in zip(own, own[1:], found):
            n = min(n, len(a), len(b))
            if n == wide:
                n = len(os.path.commonprefix([a, b]))
            yield n


class Encoder:
    """Encodes texts and keeps the tokens of words met before."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str | int, tuple[str, bytes]] = {}
        self._clear()

    def _clear(self) -> None:
        marks = self.vocabulary.special.items()
        self.known = {i: (str(i), text.encode()) for text, i in marks}

    def learn(self, new: set[str | int]) -> None:
        """Adds words; beyond KEPT_WORDS only those in use next are kept."""
        read, text = self.vocabulary.bytes.__getitem__, self.vocabulary.text.__getitem__
        for word, tokens in self.vocabulary.encode_words([w.encode() for w in new]).items():
            self.known[word.decode()] = (",".join(map(text, tokens)), b"".join(map(read, tokens)))

    def tokens(self, text: str) -> list[int]:
        pieces = list(self.vocabulary.split(text))
        self.learn(set(chain.from_iterable(pieces)) - self.known.keys())
        found = [int(i) for p in pieces for w in p for i in self.known[w][0].split(",")]
        self._bound()
        return found

    def _bound(self) -> None:
        if len(self.known) > KEPT_WORDS:
            self._clear()

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of tokens, digest of the ids, digest of the decoded text, of each text."""
        held: list[list[list[str | int]]] = []
        new: set[str | int] = set()
        size = 0
        for text in texts:
            pieces = list(self.vocabulary.split(text))
            held.append(pieces)
            for piece in pieces:
                new |= set(piece).difference(self.known)
                size += len(piece)
            if size > 1_000_000:
                yield from self._digests(held, new)
                held, new, size = [], set(), 0
        yield from self._digests(held, new)

    def _digests(self, held: list, new: set) -> Iterator[tuple[int, str, str]]:
        self.learn(new)
        known = self.known.__getitem__
        for pieces in held:
            n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for piece in pieces:
                texts, raw = zip(*map(known, piece))
                joined = ",".join(texts)
                ids.update(b"," * (n > 0) + joined.encode())
                decoded.update(b"".join(raw))
                n += joined.count(",") + 1
            yield n, ids.hexdigest(), decoded.hexdigest()
        self._bound()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(tokenizer: str) -> Encoder:
    """The worker's encoder, kept for the tasks that follow."""
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = Encoder(Vocabulary(tokenizer))
    return _ENCODERS[tokenizer]


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode each whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``tokenizer`` is the content of a vocabulary file (about 2 MB), sent to each executor once.  A
    task works on its own rows: it collects the distinct words of a batch, walks their trie, and
    replaces each word by its tokens.  There is no shuffle, and a task keeps KEPT_WORDS words at
    most.  Special tokens in a text are encoded as such.

    Null text counts as empty: no tokens.  Rows come out as they come in, repeated ones too.  Other
    columns are not read.  No rows in, no rows out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            rows = list(encoder.digests(batch.column(1).to_pylist()))
            kinds = [pa.int64(), pa.string(), pa.string()]
            found = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names)

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The tokens themselves: doc_id, ids.  Null text gives no tokens; see :func:`token_digests`."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            found = pa.array(map(encoder.tokens, batch.column(1).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "ids"])

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(ids, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The texts of token lists (doc_id, ids): doc_id, text.  A null list gives an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            found = pa.array([vocabulary.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
