"""Repeated lines by a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z lower-cased. First the distinct keys of
every document are counted as 128-bit hashes, combined in the tasks. The distinct hashes that enough
documents hold are then indexed: each shard of the hash space gets a minimal perfect hash (levels of
bitmaps: a key stands where it meets no other of its level, the others go on to the next level; its
slot is its bit's rank) and arrays with a fingerprint, the number of documents and the keeper, the
document with the largest id, at each slot. Shards are built in parallel, each in bounded memory.

Documents probe the arrays where they are; no line is joined. The hottest keys, of which there can't be
more than ``HOT_KEYS`` whatever the data, are always broadcast, and so are all shards while they hold at
most ``BROADCAST_KEYS`` keys. Beyond that, the keys of the lines are sent to the shards instead, where
they stream past the arrays; what they find comes back as places in documents.

Slots come from one half of a hash and fingerprints are the other half, so a line that isn't indexed is
taken for one that is only where all 128 bits agree.

Defined cases: null and empty text are one empty line; every row is a document of its own, also one that
repeats an id; a null id is smaller than any other; where several rows have the largest id, all keep
their lines, and a line repeated inside the keeper stays as often as it stands there; an empty table
gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of

# What is stripped from a line's ends.
BLANK = " \t\n\x0b\x0c\r"
#: Keys of a shard on average: bounds the memory that building one takes.
SHARD_KEYS = 100_000
#: A key is hot when it is more than one in so many of all keys counted: there can't be more hot keys.
HOT_KEYS = 100_000
#: Indexed keys that are broadcast (about 25 bytes each).
BROADCAST_KEYS = 2_000_000
#: Bits of a level's bitmap for each key.
SPREAD = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + _ODD * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct 64-bit keys; of another key, any slot or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bitmaps as 64-bit words
        sizes = [np.bitwise_count(words).astype(np.int64) for words in levels]
        before = np.cumsum([0, *[int(x.sum()) for x in sizes]])
        #: Bits set before each word, over all levels.
        self.ranks = [np.cumsum(x) - x + b for x, b in zip(sizes, before, strict=False)]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            words = -(-SPREAD * len(keys) // 64)
            at = (_mixed(keys, len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at]]
        return cls(levels)

    @classmethod
    def loaded(cls, raw: bytes, sizes: list[int]) -> PerfectHash:
        words = np.frombuffer(raw, dtype="<u8")
        return cls(np.split(words, np.cumsum(sizes)[:-1]) if sizes else [])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_mixed(keys[open_], level) % np.uint64(64 * len(words))).astype(np.int64)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[found]] = (ranks[at >> 6] + np.bitwise_count(below))[found]
            open_ = open_[~found]
        return out


class Shard:
    """A perfect hash with the arrays at its slots."""

    def __init__(self, bits: bytes, levels: list[int], prints: bytes, counts: bytes, keepers: bytes):
        self.hash = PerfectHash.loaded(bits, list(levels))
        self.prints, self.keepers = np.frombuffer(prints, dtype="<u8"), np.frombuffer(keepers, dtype="<i8")
        self.counts = np.frombuffer(counts, dtype="<u4")

    @staticmethod
    def built(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> tuple[bytes, list[int], bytes, bytes, bytes]:
        hashed = PerfectHash.of(keys)
        order = np.argsort(hashed.slots(keys))
        bits = b"".join(words.tobytes() for words in hashed.levels)
        counts = np.minimum(counts[order], 2**32 - 1).astype("<u4")
        return bits, [len(words) for words in hashed.levels], prints[order].astype("<u8").tobytes(), counts.tobytes(), keepers[order].astype("<i8").tobytes()

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is indexed, and its keeper."""
        slots = self.hash.slots(keys)
        if not len(self.prints):
            return np.zeros(len(keys), dtype=bool), slots
        return (slots >= 0) & (self.prints[slots] == prints), self.keepers[slots]


#: Tuples of ``Shard``'s arguments by shard number.
Index = dict[int, tuple[bytes, list[int], bytes, bytes, bytes]]


def keys_of(text: str, least_chars: int) -> tuple[list[str], list[int], np.ndarray]:
    """A text's lines, the numbers of those with a key that is long enough, and these keys' hashes (two halves)."""
    from xxhash import xxh3_128_digest

    lines = text.split("\n")
    at, raw = [], bytearray()
    for i, line in enumerate(lines):
        if len(line) >= least_chars and len(key := line.strip(BLANK)) >= least_chars:
            at.append(i)
            # bytes.lower changes A-Z alone
            raw += xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())
    return lines, at, np.frombuffer(bytes(raw), dtype="<u8").reshape(-1, 2)


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)


def counted_keys(docs: DataFrame, id_column: str, text_column: str, least_chars: int) -> DataFrame:
    """(key, print, n, keeper) of the distinct keys: documents that hold it, and a hash of the largest of their ids."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [np.unique(keys_of(text, least_chars)[2], axis=0) for text in batch.column("text").to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            both = np.concatenate([np.empty((0, 2), np.uint64), *found]).view(np.int64)
            columns = [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("id").take(pa.array(rows))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "print", "id"])

    light = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(f"`{text_column}`").alias("text"))
    held = light.mapInArrow(run, f"key long, print long, id {kind}")
    return held.groupBy("key", "print").agg(F.count("*").alias("n"), F.xxhash64(F.max("id")).alias("keeper"))


def built_shards(keys: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its number and the parts of a ``Shard``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ("shard", "key", "print", "n", "keeper")
        held: list[list[np.ndarray]] = []
        columns = ["shard", "bits", "levels", "prints", "counts", "keepers"]

        def built():
            number, keys, prints, counts, keepers = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            parts = Shard.built(keys.view(np.uint64), prints.view(np.uint64), counts, keepers)
            kinds = (pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((int(number[0]), *parts), kinds, strict=True)], columns)

        for batch in batches:
            rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if not batch.num_rows:
                continue
            edges = np.flatnonzero(np.diff(rows[0])) + 1
            if held and held[-1][0][-1] != rows[0][0]:
                yield built()
            for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if low:
                    yield built()
                held.append([x[low:high].copy() for x in rows])
        if held:
            yield built()

    number = F.pmod(F.shiftrightunsigned("key", 32), F.lit(shards)).cast("int")
    dealt = keys.withColumn("shard", number).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "shard int, bits binary, levels array<int>, prints binary, counts binary, keepers binary")


def _collected(index: DataFrame) -> Index:
    return {r.shard: (bytes(r.bits), list(r.levels), bytes(r.prints), bytes(r.counts), bytes(r.keepers)) for r in index.collect()}


class Probe:
    """Looks lines up in broadcast shards."""

    def __init__(self, index: Index, shards: int):
        self.index, self.shards = {number: Shard(*parts) for number, parts in index.items()}, shards

    def dropped(self, hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether each line is indexed and its document, known by the hash ``own``, isn't the keeper."""
        out = np.zeros(len(hashes), dtype=bool)
        number = _shard_of(hashes[:, 0], self.shards)
        order = np.argsort(number, kind="stable")
        cuts = np.flatnonzero(np.diff(number[order])) + 1
        for part in np.split(order, cuts):
            if len(part) and (shard := self.index.get(int(number[part[0]]))):
                found, keepers = shard.probe(hashes[part, 0], hashes[part, 1])
                out[part] = found & (keepers != own[part])
        return out


def _cut(docs: DataFrame, text: Column, own: Column, places: Column | None, index: Index, shards: int, least_chars: int) -> Column:
    """struct(text, n_lines, n_dropped) of each row: without the lines that ``index`` or ``places`` (line numbers) name."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    local: list[Probe] = []

    def run(texts: pd.Series, owns: pd.Series, named: pd.Series) -> pd.DataFrame:
        if not local:
            local.append(Probe(shared.value, shards))
        split = [keys_of(t, least_chars) for t in texts]
        hashes = np.concatenate([np.empty((0, 2), np.uint64), *[x[2] for x in split]])
        counts = [len(x[1]) for x in split]
        gone = local[0].dropped(hashes, np.repeat(owns.to_numpy(dtype=np.int64), counts))
        out, low = [], 0
        for text, (lines, at, _), n, more in zip(texts, split, counts, named, strict=True):
            drop = {at[i] for i in np.flatnonzero(gone[low : low + n])}.union(() if more is None else more)
            low += n
            kept = "\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else text
            out.append((kept, len(lines), len(drop)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    none = F.lit(None).cast("array<int>")
    return F.pandas_udf(run, "text string, n_lines long, n_dropped long")(text, own, none if places is None else places)


def _routed(rows: DataFrame, index: DataFrame, shards: int, least_chars: int) -> DataFrame:
    """(document, places): line numbers to drop, found by sending the lines' hashes to the shards.

    ``rows`` has document (a hash), own and text. A shard's row comes first in its partition's order,
    its probes stream behind it.
    """

    def ask(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            split = [keys_of(text, least_chars)[1:] for text in batch.column("text").to_pylist()]
            row = pa.array(np.repeat(np.arange(len(split)), [len(x[0]) for x in split]))
            hashes = np.concatenate([np.empty((0, 2), np.uint64), *[x[1] for x in split]])
            line = pa.array([i for x in split for i in x[0]], pa.int32())
            columns = [_shard_of(hashes[:, 0], shards), hashes[:, 0].view(np.int64), hashes[:, 1].view(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column("document").take(row), batch.column("own").take(row), line], ["shard", "key", "print", "document", "own", "line"])

    def answer(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number, shard = -1, None
        names = ("key", "print", "own", "document", "line")
        for batch in batches:
            parts = batch.select(["bits", "levels", "prints", "counts", "keepers"])
            opens = np.flatnonzero(~np.array(batch.column("probe"), dtype=bool))
            for low, high in zip([0, *opens], [*opens, batch.num_rows], strict=True):
                if low in opens:
                    shard, number = Shard(*(parts.column(c)[int(low)].as_py() for c in parts.schema.names)), batch.column("shard")[int(low)].as_py()
                    low += 1
                if high <= low or shard is None:
                    continue
                key, prints, own, document, line = (batch.column(c).slice(low, high - low).to_numpy(zero_copy_only=False) for c in names)
                here = batch.column("shard").slice(low, high - low).to_numpy() == number
                found, keepers = shard.probe(key.view(np.uint64), prints.view(np.uint64))
                found &= (keepers != own) & here
                yield pa.RecordBatch.from_arrays([pa.array(document[found]), pa.array(line[found].astype(np.int32))], ["document", "line"])

    asked = rows.mapInArrow(ask, "shard int, key long, print long, document binary, own long, line int").withColumn("probe", F.lit(True))
    both = asked.unionByName(index.withColumn("probe", F.lit(False)), allowMissingColumns=True)
    # numbers stand for missing values in the shards' own rows, which are never looked up
    filled = both.fillna({"key": 0, "print": 0, "own": 0, "line": 0}).withColumn("document", F.coalesce("document", F.lit(b"")))
    dealt = filled.repartition("shard").sortWithinPartitions("shard", "probe")
    found = dealt.mapInArrow(answer, "document binary, line int")
    # rows that repeat id and text are asked for more than once
    return found.groupBy("document").agg(F.collect_set("line").alias("places"))


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_chars: int = 40, least_docs: int = 5, counts: tuple[str, str] = ("n_lines", "n_dropped")
) -> DataFrame:
    """``docs`` with shorter texts and two columns more: how many lines a text had, and how many of them went."""
    keys = staged(counted_keys(docs, id_column, text_column, least_chars).filter(F.col("n") >= least_docs), "line-keys")
    indexed, held = keys.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    everywhere = indexed <= BROADCAST_KEYS
    # more than one in HOT_KEYS of the keys held: fewer than HOT_KEYS
    sent = keys if everywhere else keys.filter(F.col("n") > max(least_docs, held // HOT_KEYS))
    count = min(indexed, BROADCAST_KEYS if everywhere else HOT_KEYS)
    shards = max(1, math.ceil(count / SHARD_KEYS))
    index = _collected(built_shards(sent, shards))

    columns = docs.columns
    text, own = text_of(f"`{text_column}`"), F.xxhash64(F.col(f"`{id_column}`"))
    # under names that no column of the table has
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), text.alias("text"), own.alias("own"))
    places = None
    if not everywhere:
        rest = keys.filter(F.col("n") <= max(least_docs, held // HOT_KEYS))
        more = max(1, math.ceil(indexed / SHARD_KEYS))
        document = F.unhex(F.sha2(F.concat_ws("\n", F.col("own").cast("string"), F.col("text")), 256))
        rows = rows.withColumn("document", document)
        asked = rows.select("document", "own", "text")
        found = _routed(asked, built_shards(rest, more), more, least_chars)
        rows = rows.join(found, "document", "left")
        places = F.col("places")
    rows = rows.withColumn("cut", _cut(docs, F.col("text"), F.col("own"), places, index, shards, least_chars))
    kept = [F.col("cut.text").alias(c) if c == text_column else F.col(f"row.`{c}`") for c in columns]
    return rows.select(*kept, F.col("cut.n_lines").alias(counts[0]), F.col("cut.n_dropped").alias(counts[1]))
