"""Best-fit packing of token ids into training sequences.

A document's ids end with ``end_id``. Only documents longer than a sequence
are cut, into pieces of a whole sequence and one rest. Pieces are packed by
bounded-space online best-fit: a packer holds a fixed number of open bins,
keyed by free space in a bitset; a piece goes to the bin with the least free
space that holds it, which is the lowest set bit from the piece's length
on. Where none does, a new bin opens, and if all ``open_bins`` are open, the
fullest closes first (the lowest set bit of all).

One scan encodes the texts and writes the pieces, narrow rows without text.
They are dealt evenly over packers of about ``block`` pieces by a hash of
their place in that table, so no document, length or group of copies can
fill a packer. A packer's closed bins are final; the pieces of the at most
``open_bins`` bins that it leaves open are packed again on the next level,
by fewer packers, until a single one is left, which closes all its bins. So
only one packer of the whole job ends with bins that are open for want of
pieces, and a packer holds one block at a time, whatever the input.

The ids are those of the vocabulary's own library. Words that a task has not
met are encoded many at once: rows of one length make a matrix of ids, and
every step does the merge of least rank, leftmost, in all of its rows.

Defined cases: a null or empty text has the end id alone; rows that repeat
an id, a text or both are packed row by row; null ids stay; very long texts
give as many pieces as they need, and words longer than ``_WIDEST`` bytes
are encoded one by one; extra columns are ignored whatever their names; an
empty table gives an empty result. Runs over the same files agree.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sightline.llm import bpe
from sightline.llm.common import small_batches
from sightline.session import materialize

#: Words of more bytes are encoded one by one.
_WIDEST = 48
#: A sequence's number: level, packer (36 bits), bin (20 bits).
_PACKER_BITS, _BIN_BITS = 36, 20


class WordBatch:
    """The model's merges as arrays, applied to many words at once."""

    def __init__(self, model: bpe.BpeModel):
        self.model = model
        pairs = [(a * len(model.next) + b, rank) for a, after in enumerate(model.next) for b, rank in after.items()]
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.ranks = np.array([r for _, r in pairs] + [0], dtype=np.int32)
        self.made = np.array(model.made, dtype=np.int32)
        self.byte_id = np.array(model.byte_id, dtype=np.int32)
        self.end_id = np.array(model.end_id, dtype=np.int32)
        self.none = len(model.made)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.model.next) + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def _merge(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their ids) for rows of one length, as they are done."""
        rows, n = np.arange(len(ids)), ids.shape[1]
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while n > 1:
            least = ranks.min(axis=1)
            done = least == self.none
            if done.any():
                yield rows[done], ids[done]
                rows, ids, ranks, least = rows[~done], ids[~done], ranks[~done], least[~done]
            if not len(ids):
                return
            at = (ranks == least[:, None]).argmax(axis=1)
            i, col = np.arange(len(ids)), np.arange(n - 1)
            ids[i, at] = self.made[least]
            ids = np.take_along_axis(ids, col + (col > at[:, None]), axis=1)
            col = col[:-1]
            ranks = np.take_along_axis(ranks, col + (col >= at[:, None]), axis=1)
            n -= 1
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < n - 1)
            x = at[left]
            ranks[left, x - 1] = self._rank(ids[left, x - 1], ids[left, x])
            x = at[right]
            ranks[right, x] = self._rank(ids[right, x], ids[right, x + 1])
        if len(ids):
            yield rows, ids

    def encode(self, words: list[str]) -> list[bytes]:
        """The packed ids of each word (no white space, normalised)."""
        out: list[bytes] = [b""] * len(words)
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw])
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            if n > _WIDEST:
                for i in at.tolist():
                    out[i] = self.model.encode_word(words[i])
                continue
            b = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), dtype=np.uint8).reshape(-1, n)
            ids = self.byte_id[b]
            ids[:, -1] = self.end_id[b[:, -1]]
            for rows, done in self._merge(ids):
                flat, step = done.astype("<i4").tobytes(), 4 * done.shape[1]
                for j, i in enumerate(at[rows].tolist()):
                    out[i] = flat[j * step:(j + 1) * step]
        return out


class Encoder:
    """Token ids of whole texts. The chunks between white space are numbered
    by Arrow, so each distinct one of a batch is looked up once; a bounded
    cache, in two generations, keeps the ids of chunks that a task has met,
    and the words of new chunks are encoded together."""

    def __init__(self, path: str, cache: int = 200_000):
        self.model = bpe.model(path)
        self.batch = WordBatch(self.model)
        self.limit, self.known, self.old = cache, {}, {}

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        known, old = self.known, self.old
        out = list(map(known.get, chunks))
        unmet = [i for i, ids in enumerate(out) if ids is None]
        for i in unmet:
            out[i] = old.get(chunks[i])
        new = [i for i in unmet if out[i] is None]
        parts = [[c] if c.isalpha() else self.model.words.findall(c) for c in (chunks[i] for i in new)]
        words = list(dict.fromkeys(w for p in parts for w in p))
        made = dict(zip(words, self.batch.encode(words)))
        for i, p in zip(new, parts):
            out[i] = made[p[0]] if len(p) == 1 else b"".join([made[w] for w in p])
        if len(known) > self.limit:
            self.old = known
            self.known = known = {}
        known.update((chunks[i], out[i]) for i in unmet if len(chunks[i]) <= 64)
        return out

    def _plain(self, text: str) -> bool:
        """No special token, no character that Python's tables do not know,
        and none that is white space to one side only."""
        m = self.model
        return not ("<|" in text or m.odd_blank.search(text) or m.unassigned.search(text))

    def encode(self, texts: list[str | None], together: int = 1 << 22) -> Iterator[np.ndarray]:
        """The ids of each text, of about ``together`` characters at a time."""
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held < together:
                held += len(texts[end] or "")
                end += 1
            some, at = texts[at:end], end
            plain = [bool(t) and self._plain(t) for t in some]
            flat = pa.array([unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() if ok else "" for t, ok in zip(some, plain)],
                            type=pa.large_string())
            split = pc.utf8_split_whitespace(flat)
            coded = split.flatten().dictionary_encode()
            ids = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            ends = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4, out=ends[1:])
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            every = lists.take(coded.indices)
            tokens = every.flatten().to_numpy()
            # text -> its chunks -> their ids; the split keeps empty strings at the ends
            stops = (every.offsets.to_numpy()[split.offsets.to_numpy()] - every.offsets[0].as_py()).tolist()
            for i, t in enumerate(some):
                yield tokens[stops[i]:stops[i + 1]] if plain[i] else self.model.encode(t)


@lru_cache(maxsize=1)
def encoder(path: str, cache: int) -> Encoder:
    """An encoder that the tasks of a worker process share, one after the
    other, with the chunks they have met."""
    return Encoder(path, cache)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
           end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(id, piece from 0, start, length, ids_crc32) of every document's
    pieces, and their ``ids`` on request."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = StructType([StructField(id_col, src.schema["id"].dataType), StructField("piece", IntegerType()),
                      StructField("start", LongType()), StructField("length", LongType()),
                      StructField("ids_crc32", LongType())]
                     + [StructField("ids", ArrayType(IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        tail = array("i", [end_id]).tobytes()
        for b in batches:
            row, piece, start, length, crc, flat = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(b.column("text").to_pylist())):
                raw = ids.astype("<i4").tobytes() + tail
                for p, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        flat.append(part)
            cols = [b.column("id").take(pa.array(row, type=pa.int64())), pa.array(piece, type=pa.int32()),
                    pa.array(start, type=pa.int64()), pa.array(length, type=pa.int64()), pa.array(crc, type=pa.int64())]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(flat), dtype="<i4"))))
            yield pa.RecordBatch.from_arrays(cols, names=out.names)
        pa.default_memory_pool().release_unused()
    return src.mapInArrow(run, out)


def fill_bins(sizes: Iterable[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, its offset there, bins left open) of one packer.

    Bit ``f`` of ``free`` says that some open bin has ``f`` places left;
    ``held[f]`` are those bins."""
    free = 0
    held: dict[int, list[int]] = {}
    bins, offsets = [], []
    made = n_open = 0

    def take(f: int) -> int:
        nonlocal free
        stack = held[f]
        b = stack.pop()
        if not stack:
            free ^= 1 << f
        return b
    for size in sizes:
        fits = free >> size
        if fits:
            f = size + (fits & -fits).bit_length() - 1
            b = take(f)
        else:
            if n_open == open_bins:
                take((free & -free).bit_length() - 1)        # the fullest closes
                n_open -= 1
            f, b = capacity, made
            made += 1
            n_open += 1
        bins.append(b)
        offsets.append(capacity - f)
        left = f - size
        if left:
            held.setdefault(left, []).append(b)
            free |= 1 << left
        else:
            n_open -= 1                                          # full
    return bins, offsets, [b for stack in held.values() for b in stack]


def best_fit(items: DataFrame, size_col: str = "length", capacity: int = 4096, open_bins: int = 256,
             block: int = 8192) -> DataFrame:
    """The rows of ``items`` (sizes from 1 to ``capacity``) with their
    sequence_id and offset. The input is read once a level, so pass a
    written table."""
    taken = items.columns
    if {"sequence_id", "offset"} & {c.lower() for c in taken}:
        raise ValueError("items already have a sequence_id or an offset")
    if open_bins * 8 > block:
        raise ValueError("a block must hold many more pieces than bins stay open")
    spec = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def packer(level: int, last: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("pack_place", kind="stable")
            bins, offsets, still = fill_bins(rows[size_col].tolist(), capacity, open_bins)
            first = (level << _PACKER_BITS | int(key[0])) << _BIN_BITS
            number = pd.Series(np.array(bins, dtype=np.int64) + first, index=rows.index, dtype="Int64")
            if not last:
                number[np.isin(bins, still)] = pd.NA
            return rows[taken].assign(sequence_id=number, offset=np.array(offsets, dtype=np.int64))
        return run

    left, level, packed = items, 0, None
    while True:
        n = left.count()
        packers = max(1, -(-n // block))
        place = F.xxhash64(F.monotonically_increasing_id(), F.lit(level))
        dealt = (left.select(*taken, place.alias("pack_place"))
                 .withColumn("pack_block", F.pmod("pack_place", F.lit(packers))))
        done = (dealt.groupBy("pack_block").applyInPandas(packer(level, packers == 1), spec)
                .transform(lambda df: materialize(df, "packed")))
        closed = done.where(F.col("sequence_id").isNotNull())
        packed = closed if packed is None else packed.unionByName(closed)
        if packers == 1:
            return packed
        left, level = done.where(F.col("sequence_id").isNull()).select(*taken), level + 1


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
                   end_id: int = 1, open_bins: int = 256, block: int = 8192, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    cut = materialize(pieces(docs, path, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return best_fit(cut, "length", capacity, open_bins, block)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with their ids: a group holds
    one sequence, so no more than its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))
