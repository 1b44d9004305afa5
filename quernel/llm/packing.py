"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding.

A document's token ids are cut into as many full pieces as fit and then by the binary digits of what is left, longest piece
first. Every piece is a sequence of its own, 2^k long, and equal lengths form bucket k. Within a task the sequences of a bucket are dealt to
batches of `most` tokens, so every batch is rectangular without padding; the task's last batch of a bucket may hold fewer rows. Nothing is
sorted or shuffled for that.

Tokens: the tokenizer drops white space and never joins words across it, so the ids of a text are those of its
white-space-separated words in order; workers keep a bounded table of words they have seen.

Defined results: a null, empty or blank text is the end id alone (one piece of length 1); repeated rows are packed each on
its own; a null doc_id is carried along; an empty table gives no pieces; extra columns are ignored. The strings of the tokenizer's special tokens
inside a text become their ids, as the tokenizer does it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import small_batches, table

MOST_TOKENS = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Words a worker remembers; beyond that it starts anew, so memory stays bounded.
CACHE_WORDS = 500_000
#: Longer words are encoded each time.
CACHED_BYTES = 64
END = END_ID.to_bytes(4, "little")


#: Letters (ASCII, Latin-1), then marks that never join letters in the tokenizer's pieces.
ASCII = re.compile(rb"([A-Za-z]+)([.,;:!?]{0,3})")
LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]{0,3})")


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes themselves, the others in order from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}


BYTE_CHARS = _byte_chars()
#: Words on which the short way is compared with the tokenizer before it is used.
PROBES = ("The", "the.", "word", "Kühe,", "éçole", "NIÑO!?", "straße;", "thanedbleouou", "ÀÿÞ...", "a", "Zz:")


def plain_word_rule(tokenizer) -> bool:
    """Whether the tokenizer's merges alone give its ids for plain words (a lower-casing byte-level BPE with word ends)."""
    for word in PROBES:
        letters, marks = LATIN.fullmatch(word).groups()
        got = [t.id for t in tokenizer.model.tokenize(letters.lower().encode().decode("latin-1").translate(BYTE_CHARS))]
        if got + tokenizer.encode(marks, add_special_tokens=False).ids != tokenizer.encode(word, add_special_tokens=False).ids:
            return False
    return True


class WordIds(dict):
    """White-space-separated word (UTF-8) -> its ids as little-endian 32-bit numbers, filled on demand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = plain_word_rule(self.tokenizer)
        self.marks: dict[bytes, bytes] = {}

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = None
        if self.plain:  # letters are one piece and the marks after them another: only the merges are left to do
            parts = ASCII.fullmatch(word)
            if parts:
                letters, marks = parts.groups()
                pieces = self.model.tokenize(letters.lower().decode())
            elif parts := LATIN.fullmatch(word.decode("utf-8", "replace")):
                letters, marks = parts[1], parts[2].encode()
                pieces = self.model.tokenize(letters.lower().encode().decode("latin-1").translate(BYTE_CHARS))
            if parts:
                ids = b"".join([t.id.to_bytes(4, "little") for t in pieces])
                if marks:
                    if marks not in self.marks:
                        self.marks[marks] = self.whole(marks.decode())
                    ids += self.marks[marks]
        if ids is None:
            ids = self.whole(word.decode("utf-8", "replace"))
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        """The ids of a whole text and its end."""
        return b"".join(map(self.__getitem__, text.split())) + END


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    """One table for all tasks of a worker."""
    return WordIds(path)


def piece_lengths(n: int, most: int = MOST_TOKENS) -> list[int]:
    """n as full pieces of `most` (a power of two) and the binary digits of the rest, descending."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str | None = None, key: str = "doc_id", text: str = "text", most: int = MOST_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, bucket, batch_id, sequence_id, offset (and ids if asked for).

    bucket is the binary logarithm of the length. A sequence_id and a batch_id hold the number of their Spark partition in the high
    bits, so a task that is run again gives the same ids."""
    if most & (most - 1):
        raise ValueError("the longest sequence must be a power of two")
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = word_ids(tokenizer_path)
        first = TaskContext.get().partitionId() << 33
        opened, room, now = 0, [0] * most.bit_length(), [0] * most.bit_length()
        for b in batches:
            row, starts, lengths, crcs, totals, kept, buckets, batch_ids = [], [], [], [], [], [], [], []
            for at, value in enumerate(b.column(1).to_pylist()):
                view = memoryview(words.of(value or b""))
                total, begin = len(view) // 4, 0
                for n in piece_lengths(total, most):
                    row.append(at)
                    starts.append(begin)
                    lengths.append(n)
                    crcs.append(zlib.crc32(view[4 * begin : 4 * (begin + n)]))
                    totals.append(total)
                    k = n.bit_length() - 1
                    if not room[k]:
                        room[k], now[k] = most // n, first + opened
                        opened += 1
                    room[k] -= 1
                    buckets.append(k)
                    batch_ids.append(now[k])
                    if with_ids:
                        kept.append(np.frombuffer(view[4 * begin : 4 * (begin + n)], dtype="<u4"))
                    begin += n
            columns = [b.column(0).take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)], pa.array(buckets, pa.int32()), pa.array(batch_ids, pa.int64())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "batch_id", *["ids"] * with_ids])

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    pieces = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int, batch_id bigint" + ", ids array<bigint>" * with_ids
    )
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
