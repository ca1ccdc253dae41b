"""Cost-balanced packing of token sequences.

A document's cost is estimated as linear plus quadratic in its length (feed-forward and attention
work). In each task, documents gather in groups of a bounded number of tokens. What exceeds a whole
sequence is cut off in full sequences; the remainders are assigned in descending order, each to the
sequence of the lowest cost that still has room for it; one that fits nowhere is cut over the
sequences with the most room. A group gets just as many sequences as its tokens need, so at most
one sequence's worth of padding is left in each group.

No shuffle: a group is what one task has read, so no key can make it large, and a task that is run
again packs the same rows alike. A very long document stands alone in memory only as its own ids.

Defined cases: null text counts as empty; an empty text is its end token alone; ties go to the
longer document, then to the earlier row, then to the sequence with the lowest number; repeated rows
are packed one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Work of a token against that of a pair of tokens (its length in tokens at which both are equal).
EVEN_LENGTH = 2048
#: Tokens after which a group is packed: bounds a task's memory.
GROUP_TOKENS = 4_000_000
#: Words whose ids a worker keeps at most.
CACHED_WORDS = 100_000
#: Texts of a batch that are Python objects at the same time.
ROWS_AT_ONCE = 256
END_OF_TEXT = "<|endoftext|>"
#: A space that is not alone before a word: such texts are encoded as a whole.
MORE_SPACE = re.compile(r" (?:\s|$)")


class ByteTokens:
    """Ids of texts as the JSON tokenizer gives them, remembered word by word.

    The tokenizer first splits a text before each single space that has a character other than
    white space behind it, whatever else it splits, so the pieces between spaces are independent.
    The rank file holds the same vocabulary and is read by a faster library.
    """

    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # the special string in a text is that token, as in the JSON tokenizer's default
        self.special = len(ranks)
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words: dict[str, bytes] = {}

    def encoded(self, text: str) -> bytes:
        return array("H", self.encoding.encode_ordinary(text)).tobytes()

    def spaced(self, word: str) -> bytes:
        """Ids of a word with the space before it."""
        ids = self.encoded(" " + word)
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        if len(word) < 64:
            self.words[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        if MORE_SPACE.search(text):
            return self.encoded(text)
        head, *rest = text.split(" ")
        known, spaced = self.words.get, self.spaced
        return self.encoded(head) + b"".join([known(word) or spaced(word) for word in rest])

    def ids(self, text: str) -> np.ndarray:
        """Ids as unsigned 16-bit numbers (the vocabulary is smaller than 65,536)."""
        if END_OF_TEXT not in text:
            return np.frombuffer(self.plain(text), dtype="<u2")
        mark = np.array([self.special], dtype="<u2").tobytes()
        return np.frombuffer(mark.join(self.plain(part) if part else b"" for part in text.split(END_OF_TEXT)), dtype="<u2")


def cost(length: int) -> int:
    return length * EVEN_LENGTH + length * length


def pack(lengths: list[int], size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    sequence, rest, begin = 0, [], {}
    for i, length in enumerate(lengths):
        for start in range(0, length - size + 1, size):
            yield i, start, size, sequence, 0
            sequence += 1
        if length % size:
            rest.append((length % size, i))
            begin[i] = length - length % size
    tokens = sum(length for length, _ in rest)
    count = -(-tokens // size)
    used, costs = [0] * count, [0] * count
    # sequences by cost; one that lacks the room is set aside, for no later document is longer
    # than this one: it comes back when the documents have become short enough
    open_by_cost = [(0, s) for s in range(count)]
    aside: list[tuple[int, int]] = []  # largest room first
    uncut = []
    for length, i in sorted(rest, key=lambda x: (-x[0], x[1])):
        while aside and -aside[0][0] >= length:
            s = heapq.heappop(aside)[1]
            heapq.heappush(open_by_cost, (costs[s], s))
        while open_by_cost and size - used[open_by_cost[0][1]] < length:
            s = heapq.heappop(open_by_cost)[1]
            heapq.heappush(aside, (used[s] - size, s))
        if not open_by_cost:
            uncut.append((length, i))
            continue
        s = heapq.heappop(open_by_cost)[1]
        yield i, begin[i], length, sequence + s, used[s]
        used[s] += length
        costs[s] += cost(length)
        if used[s] < size:
            heapq.heappush(open_by_cost, (costs[s], s))
    free = [(used[s] - size, s) for s in range(count) if used[s] < size]
    heapq.heapify(free)
    for length, i in uncut:
        start = begin[i]
        while length:
            room, s = heapq.heappop(free)
            part = min(length, -room)
            yield i, start, part, sequence + s, used[s]
            start, length, used[s] = start + part, length - part, used[s] + part
            if used[s] < size:
                heapq.heappush(free, (used[s] - size, s))


class Group:
    """The documents that a task packs together: their ids end to end, two bytes each."""

    def __init__(self):
        self.names: list = []
        self.lengths: list[int] = []
        self.ids = bytearray()

    def add(self, name: object, ids: np.ndarray, end: bytes) -> None:
        self.names.append(name)
        self.lengths.append(len(ids) + 1)
        self.ids += ids.tobytes()
        self.ids += end

    def packed(self, size: int, base: int) -> tuple[list, list[np.ndarray]]:
        """The pieces' documents, and their start, length, checksum, document's length, sequence and offset."""
        pieces = np.array(list(pack(self.lengths, size)), dtype=np.int64).reshape(-1, 5)
        at, start, length, sequence, offset = pieces.T
        lengths, ids = np.array(self.lengths, dtype=np.int64), np.frombuffer(self.ids, dtype="<u2")
        first = (np.cumsum(lengths) - lengths)[at] + start
        sums = np.array([zlib.crc32(ids[i : i + n].astype("<u4")) for i, n in zip(first.tolist(), length.tolist(), strict=True)], dtype=np.int64)
        return [self.names[i] for i in at.tolist()], [start, length, sums, lengths[at], sequence + base, offset]


def pack_documents(
    docs: DataFrame, ranks_file: str, pattern: str, size: int = 1024, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = dict(docs.dtypes)[id_column]
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        base, tokens, group, id_type = TaskContext.get().partitionId() << 32, ByteTokens(ranks_file, pattern), Group(), None
        end = np.array([end_id], dtype="<u2").tobytes()

        def flush():
            nonlocal base, group
            names, numbers = group.packed(size, base)
            base, group = int(numbers[4].max()) + 1, Group()
            return pa.RecordBatch.from_arrays([pa.array(names, id_type), *map(pa.array, numbers)], columns)

        for batch in batches:
            id_type = batch.schema.field("id").type
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                for name, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    group.add(name, tokens.ids(text or ""), end)
                    if len(group.ids) >= 2 * GROUP_TOKENS:
                        yield flush()
        if group.names:
            yield flush()

    light = docs.selectExpr(f"`{id_column}` AS id", f"cast(`{text_column}` AS string) AS text")
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return light.mapInArrow(run, schema).withColumnRenamed("id", id_column)
