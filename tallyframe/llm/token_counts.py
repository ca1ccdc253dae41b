"""Exact token counts by heap-and-linked-list byte-pair merging; no ids are emitted.

A text becomes a doubly linked list of symbols (characters). A heap holds the adjacent pairs that
are pieces of the vocabulary, best rank first and leftmost first among equals; the best pair is
popped, merged if it still stands, and its new neighbours are pushed. The count is the number of
symbols minus the number of merges; a symbol left over that is no piece counts as its bytes.

No piece holds a space behind another character, so merges never cross the front of a run of
spaces: the text is cut there, and counts of short segments are remembered in a bounded table.

Defined cases: null text counts as empty and has no token; very long texts without a space are one
segment, merged in n log n steps; repeated rows are counted one by one; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

SPACE = "▁"
#: Segments whose counts a worker keeps at most.
CACHED_SEGMENTS = 500_000
LONGEST_CACHED = 48


class PieceCounts:
    """Counts for a byte-pair vocabulary with a space marker, a dummy space in front and byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = (i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        # a higher score merges earlier
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in normal}
        self.known: dict[str, int] = {}

    def merged(self, segment: str) -> int:
        symbols, rank = list(segment), self.rank
        if len(symbols) < 2:
            return sum(1 if s in rank else len(s.encode()) for s in symbols)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            # a pair stands only while both symbols are as they were when it was pushed
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if (right := pair + symbols[k]) in rank:
                    heapq.heappush(heap, (rank[right], i, right))
            h = before[i]
            if h >= 0 and (left := symbols[h] + pair) in rank:
                heapq.heappush(heap, (rank[left], h, left))
        return count + sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in rank)

    def segment(self, segment: str) -> int:
        count = self.merged(segment)
        if len(segment) <= LONGEST_CACHED:
            if len(self.known) >= CACHED_SEGMENTS:
                self.known.clear()
            self.known[segment] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total, spaces = self.known, 0, ""
        words = text.replace(SPACE, " ").split(" ")  # the dummy space and each space stand before a word
        if "" in words:
            last = len(words) - 1
            runs = []
            for i, word in enumerate(words):
                spaces += SPACE
                if word or i == last:
                    runs.append(spaces + word)
                    spaces = ""
        else:
            runs = [SPACE + word for word in words]
        for run in runs:
            count = known.get(run)
            total += self.segment(run) if count is None else count
        return total


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_tokens and whether it is over the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = PieceCounts(model_file)
        for batch in batches:
            yield batch[["id", "n_bytes"]].assign(n_tokens=[counts.count(text) for text in batch["text"]])

    light = docs.selectExpr(
        f"cast(`{id_column}` AS string) AS id", f"coalesce(cast(`{text_column}` AS string), '') AS text", f"cast(coalesce(octet_length(cast(`{text_column}` AS string)), 0) AS long) AS n_bytes"
    )
    out = light.mapInPandas(run, "id string, n_bytes long, n_tokens long")
    return out.select(out["id"].cast(dict(docs.dtypes)[id_column]).alias(id_column), "n_bytes", "n_tokens", (out["n_tokens"] > limit).alias("over_limit"))
