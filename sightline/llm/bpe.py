"""BPE encoding and decoding with forced boundaries.

Byte pairs that occur inside no vocabulary token can never be merged, so a
cut between them is certain before any merge is looked up. Every word is cut
at its forced boundaries, each fragment is encoded on its own, and the ids
are concatenated: a merge across a cut would make a token that holds the
pair, and merges inside a fragment depend on that fragment alone. The table
of pairs comes from the vocabulary. A bounded cache of words serves most of
a text; a word of any length costs n log n in its longest fragment.

Texts are processed whole, in Arrow batches where the scan put them; nothing
is shuffled. Ids and decoded texts come out as columns.

Defined cases: a null text is empty and gives no ids and an empty decoded
text; special tokens written in a text become their ids, as the tokenizer's
own library does; repeated rows, ties and extra columns pass through; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from sightline.llm.common import map_columns

#: The pattern that the vocabulary's file splits normalised text with.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level files:
    bytes that print stand for themselves, the others take the code points
    from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = (chr(256 + i) for i in range(256))
    return [chr(b) if b in own else next(rest) for b in range(256)]


class BpeModel:
    """Vocabulary, merges and forced boundaries of one tokenizer file."""

    def __init__(self, path: str, cache: int = 120_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.specials).items()}
        size = max(self.tokens) + 1
        self.token_list = [self.tokens.get(i, "") for i in range(size)]
        self.byte_id = [vocab[c] for c in letters]
        self.end_id = [vocab[c + WORD_END] for c in letters]
        # what may follow an id, with the rank of the merge; the id that each rank makes
        self.next: list[dict[int, int]] = [{} for _ in range(size)]
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.next[vocab[a]][vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.joined = self._pairs_inside(vocab, letters)
        self.split_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)))
        self.words = regex.compile(WORDS)
        self.unassigned = regex.compile(r"[^\x00-ɏḀ-ỿ‐-⁞]")
        self.cuts = [[not x for x in row] for row in self.joined.tolist()]
        self.names = np.array(self.token_list, dtype=object)
        self.chunks = _Packed(self.encode_chunk, cache)
        self.odd_blank = regex.compile(r"[\x1c-\x1f]")
        self.path = path
        self._library = None

    @staticmethod
    def _pairs_inside(vocab: dict[str, int], letters: list[str]) -> np.ndarray:
        """joined[a, b]: bytes a, b (a last byte of a word counts as 256 + b)
        are next to each other inside some token."""
        of = {c: b for b, c in enumerate(letters)}
        joined = np.zeros((256, 512), dtype=bool)
        for token in vocab:
            last = token.endswith(WORD_END) and len(token) > len(WORD_END)
            s = [of[c] for c in (token[:-len(WORD_END)] if last else token)]
            if last:
                s[-1] += 256
            for a, b in zip(s, s[1:]):
                joined[a, b] = True
        return joined

    # encoding -------------------------------------------------------------
    def fragments(self, word: bytes) -> list[tuple[bytes, bool]]:
        """The word's bytes between forced boundaries; the flag marks the
        fragment that ends the word."""
        last = len(word) - 1
        cuts, out, at = self.cuts, [], 0
        for i in range(last):
            b = word[i + 1]
            if cuts[word[i]][b + 256 if i + 1 == last else b]:
                out.append((word[at:i + 1], False))
                at = i + 1
        out.append((word[at:], True))
        return out

    def _merge(self, part: bytes, ends: bool) -> list[int]:
        """Ids of one fragment: the merge of the least rank, leftmost first,
        until none is left."""
        ids = [self.byte_id[b] for b in part]
        if ends:
            ids[-1] = self.end_id[part[-1]]
        if len(ids) > 64:
            return self._merge_long(ids)
        after, none = self.next, len(self.made)
        ranks = [after[a].get(b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            new = ids[i] = self.made[rank]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = after[new].get(ids[i + 1], none)
            if i:
                ranks[i - 1] = after[ids[i - 1]].get(new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same order of merges with a heap: n log n in the length."""
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            rank = self.next[ids[i]].get(ids[j]) if j >= 0 else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))
        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = self.made[rank], False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [t for t, live in zip(ids, alive) if live]

    def encode_word(self, word: str) -> bytes:
        """Ids as packed 32-bit numbers."""
        out: list[int] = []
        for part, ends in self.fragments(word.encode("utf-8")):
            out += self._merge(part, ends)
        return array("i", out).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """Packed ids of a chunk without white space: its words'."""
        words = self.words.findall(chunk)
        if words == [chunk]:
            return self.encode_word(chunk)
        return b"".join(map(self.chunks.__getitem__, words))

    def _packed(self, text: str) -> list[bytes]:
        """Packed ids of normalised text. No word holds white space, so the
        text is cut there first and most chunks come from the cache.
        Characters that Python's Unicode tables do not know yet are
        classified by the tokenizer's library instead."""
        if self.unassigned.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            if self._library is None:
                from tokenizers import Tokenizer
                self._library = Tokenizer.from_file(self.path)
            lib = self._library
            of = {c: b for b, c in enumerate(byte_letters())}
            shown = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
            return [self.encode_word(bytes(of[c] for c in p).decode("utf-8")) for p, _ in shown]
        # one letter at a time: a sigma that ends a word is lower-cased like any other
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.odd_blank.search(text):  # blank to Python's split only
            return [self.encode_word(w) for w in self.words.findall(text)]
        return list(map(self.chunks.__getitem__, text.split()))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        out: list[bytes] = []
        at = 0
        marks = list(self.split_special.finditer(text)) if "<|" in text else []
        for m in [*marks, None]:
            out += self._packed(text[at:m.start()] if m else text[at:])
            if m:
                out.append(array("i", [self.specials[m.group()]]).tobytes())
                at = m.end()
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The file names no decoder: tokens are joined by spaces; ids that
        are no token are left out."""
        ids = np.asarray(ids, dtype=np.int64)
        ok = (ids >= 0) & (ids < len(self.names))
        names = self.names[ids if ok.all() else ids[ok]]
        return " ".join(filter(None, names.tolist()))


class _Packed(dict):
    """Packed ids by string, in two generations, so the size is bounded and
    frequent strings stay."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


@lru_cache(maxsize=4)
def model(path: str) -> BpeModel:
    return BpeModel(path)


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus the token ids of the text."""
    def batch(m: BpeModel, texts: pa.Array) -> list:
        made = [m.encode(t) for t in texts.to_pylist()]
        ends = np.zeros(len(made) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in made], out=ends[1:])
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))]
    return map_columns(df, batch, [text_col], [StructField(out_col, ArrayType(IntegerType()))], keep,
                       setup=lambda: model(path))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus the text of the ids."""
    def batch(m: BpeModel, ids: pa.Array) -> list:
        flat = ids.values.to_numpy(zero_copy_only=False)
        ends = ids.offsets.to_numpy()
        return [[m.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]]
    return map_columns(df, batch, [ids_col], [StructField(out_col, StringType())], keep,
                       setup=lambda: model(path))
