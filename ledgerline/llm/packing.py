"""Vector bin packing of token sequences.

Examples are placed into sequences under three limits at a time: tokens, segments (pieces in a sequence) and
loss-bearing tokens. The open sequence has a rest of each; of the pieces that fit, the one with the largest dot product
of its needs and that rest is placed next, both as shares of the limits. What no piece fits into is filled by cutting one
off an example, unless no more than ``spare`` tokens are left.

Each task packs its own rows in windows of bounded size, so nothing is shuffled and no task holds more than a window;
at the end of a task what is left goes into sequences whose lengths are powers of two, which need no padding.
Sequence numbers are the task's partition number times 2**32 plus a count, so a task that runs again gives the same.

Nulls and odd rows: a null text is the empty text and gives its end token alone; a long text is cut into as many
pieces as it needs; repeated rows are packed each for itself; a null id is kept; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.texts import slices, utf8

#: Words in one generation of those that a task remembers the ids of.
KNOWN_WORDS = 300_000
#: Tokens that a task collects before it packs, and down to how many it then packs.
WINDOW_TOKENS = 1 << 21
ID_BYTES = 4


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold, and how many tokens may stay unused rather than cut an example."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048
    spare: int = 8


#: Never part of UTF-8 text: marks the end of a word as one more byte.
WORD_END = b"\xff"


def _shown_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Fixed rule of that form: printable Latin-1 bytes stand for themselves, the rest take the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_ranks(tokenizer) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE with word ends as bytes and ids, an end being the byte ``WORD_END``.

    Its ids must count single bytes, single bytes that end a word, then the merges in order, so that an id is also the
    merge's priority.
    """
    model = json.loads(tokenizer.to_str())["model"]
    suffix, vocab, merges = model["end_of_word_suffix"], model["vocab"], model["merges"]
    if not suffix or any(vocab["".join(pair)] != 512 + i for i, pair in enumerate(merges)):
        raise ValueError("not a byte-level vocabulary with word ends whose ids follow its merges")
    meant = _shown_bytes()
    ranks = {}
    for token, i in vocab.items():
        if i < 512 + len(merges):
            ends = i >= 256 and token.endswith(suffix)
            core = token[: -len(suffix)] if ends else token
            ranks[bytes(meant[c] for c in core) + WORD_END * ends] = i
    return ranks


class _Known(dict):
    """Ids of words, found out when first asked for.

    Two generations of at most ``KNOWN_WORDS``: the older one is given up when the younger is full, so memory stays bounded
    and frequent words stay known.
    """

    def __init__(self, find):
        super().__init__()
        self.find, self.older = find, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.find(word)
        if len(self) >= KNOWN_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts by a byte-level BPE with word ends that drops white space.

    Such a tokenizer's ids of a text are those of its words in turn, so each word is encoded once and remembered. Words
    are what lies between ASCII white space, whatever their form. A word of letters below U+0300, where nothing
    composes, is lowered and merged by byte ranks; its end marks are a token of their own. Any other word goes
    through the tokenizer's own steps, and one that may hold a special token is encoded as a text.
    """

    MARKS = b".,;:!?"
    SPECIAL = b"<|"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        ranks = byte_ranks(self.tokenizer)
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.known = _Known(self._ids)

    @staticmethod
    def _letters(word: bytes) -> bytes:
        """The word in lower case if it is made of letters below U+0300, else nothing."""
        if word.isalpha():
            return word.lower()
        if word.isascii():
            return b""
        shown = word.decode()
        if not shown.isalpha() or max(shown) >= "\u0300":
            return b""
        shown = shown.lower()
        return shown.encode() if shown.isalpha() else b""

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word that is not remembered."""
        if lowered := self._letters(word):
            ids = self.merge(lowered + WORD_END)
        else:
            core = word.rstrip(self.MARKS)
            if core != word and self._letters(core):
                return self.known[core] + self.known[word[len(core) :]]
            shown = word.decode()
            if self.SPECIAL in word:
                ids = self.tokenizer.encode(shown, add_special_tokens=False).ids
            else:
                normalizer, pre_tokenizer, model = self.steps
                pieces = pre_tokenizer.pre_tokenize_str(normalizer.normalize_str(shown))
                ids = [t.id for piece, _ in pieces for t in model.tokenize(piece)]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        known = self.known.__getitem__
        return [b"".join(map(known, text.split())) for text in texts]


class Packer:
    """Places the pieces of one task."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits, self.sequence = limits, first_sequence
        #: Pieces of each kind (tokens, loss-bearing tokens): key, start, ids, where loss begins, tokens of the example.
        self.waiting: list[list[tuple]] = []
        self.place: dict[tuple[int, int], int] = {}
        self.kinds = np.zeros((1024, 2), dtype=np.int64)
        self.counts = np.zeros(1024, dtype=np.int64)
        self.tokens = 0
        self.out: list[tuple] = []

    @staticmethod
    def _loss(start: int, length: int, loss_from: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def _add(self, piece: tuple) -> None:
        key, start, ids, loss_from, whole = piece
        length = len(ids) // ID_BYTES
        kind = (length, self._loss(start, length, loss_from))
        at = self.place.get(kind)
        if at is None:
            at = self.place[kind] = len(self.waiting)
            self.waiting.append([])
            if at == len(self.counts):
                self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.kinds[at] = kind
        self.waiting[at].append(piece)
        self.counts[at] += 1
        self.tokens += length

    def _take(self, at: int) -> tuple:
        self.counts[at] -= 1
        self.tokens -= int(self.kinds[at, 0])
        return self.waiting[at].pop()

    def example(self, key, ids: bytes, loss_from: int) -> None:
        """Take in an example; what fills a sequence by itself is placed at once."""
        whole = len(ids) // ID_BYTES
        most = min(self.limits.tokens, self.limits.loss)
        start = 0
        while whole - start >= most:
            self._emit([(key, start, ids[start * ID_BYTES : (start + most) * ID_BYTES], loss_from, whole)])
            start += most
        if start < whole:
            self._add((key, start, ids[start * ID_BYTES :], loss_from, whole))

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, loss_from, whole in pieces:
            length = len(ids) // ID_BYTES
            loss = self._loss(start, length, loss_from)
            self.out.append((key, start, length, crc32(ids), whole, self.sequence, offset, loss))
            offset += length
        self.sequence += 1

    def _target(self) -> int:
        """Tokens of the next sequence: the limit, or the largest power of two that can be reached."""
        if self.tokens >= self.limits.tokens and self.counts.sum() <= self.limits.segments:
            return self.limits.tokens
        order = np.argsort(-self.kinds[:, 0], kind="stable")
        counts = self.counts[order]
        room = np.minimum(counts, np.maximum(0, self.limits.segments - np.cumsum(counts) + counts))
        reach = int((self.kinds[order, 0] * room).sum())
        if reach >= self.limits.tokens:
            return self.limits.tokens
        return 1 << (reach.bit_length() - 1)

    def _fill(self) -> None:
        """One sequence."""
        limits = self.limits
        target = self._target()
        spare = limits.spare if target == limits.tokens else 0
        used = len(self.waiting)
        kinds = self.kinds[:used]
        share = kinds / np.array([limits.tokens**2, limits.loss**2])
        rest = np.array([target, limits.loss])
        pieces: list[tuple] = []
        while rest[0] > 0 and len(pieces) < limits.segments:
            counts = self.counts[:used]
            fits = (counts > 0) & (kinds[:, 0] <= rest[0]) & (kinds[:, 1] <= rest[1])
            # One segment is the same share for every piece, so it decides whether a piece fits but not which.
            score = np.where(fits, share @ rest, -1.0)
            at = int(score.argmax()) if used else 0
            if fits[at]:
                pieces.append(self._take(at))
                rest = rest - kinds[at]
                continue
            if rest[0] <= spare or rest[1] <= 0 or not counts.any():
                break
            # Cut off the longest example what is still free.
            key, start, ids, loss_from, whole = self._take(int(np.where(counts > 0, kinds[:, 0], -1).argmax()))
            free = min(int(rest[0]), len(ids) // ID_BYTES)
            free -= max(0, self._loss(start, free, loss_from) - int(rest[1]))
            pieces.append((key, start, ids[: free * ID_BYTES], loss_from, whole))
            self._add((key, start + free, ids[free * ID_BYTES :], loss_from, whole))
            break
        self._emit(pieces)

    def pack(self, down_to: int) -> None:
        """Fill sequences until no more than so many tokens wait."""
        while self.tokens > down_to:
            self._fill()


def tokenize_and_pack(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    loss_from: str | None = None,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece of every row of ``docs``, encoded by the tokenizer file and ended by ``end_id``.

    ``loss_from`` names a column with the number of leading ids that bear no loss (a prompt); without it that is the
    first id alone. Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.
    """
    kind = docs.schema[key].dataType.simpleString()
    begins = F.lit(1) if loss_from is None else F.coalesce(F.col(loss_from), F.lit(1))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), begins.cast("bigint").alias("loss_from"))
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    end = int(end_id).to_bytes(ID_BYTES, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        key_type = None

        def placed() -> pa.RecordBatch:
            columns = list(zip(*packer.out)) if packer.out else [()] * len(names)
            packer.out.clear()
            arrays = [pa.array(columns[0], key_type), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            key_type = batch.schema.field("key").type
            keys, texts = batch.column("key").to_pylist(), utf8(batch.column("text"))
            begins = batch.column("loss_from").to_pylist()
            for a, b in slices(texts, 1 << 20):
                for i, ids in zip(range(a, b), encoder.encode(texts[a:b])):
                    packer.example(keys[i], ids + end, begins[i])
                if packer.tokens > WINDOW_TOKENS:
                    packer.pack(WINDOW_TOKENS // 2)
                if packer.out:
                    yield placed()
        packer.pack(0)
        if packer.out:
            yield placed()

    schema = f"key {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])
    return rows.mapInArrow(task, schema).withColumnRenamed("key", key)
