"""BPE encoding and decoding with a word-end vocabulary file.

Each pre-token is merged with a priority queue of (rank, position) over a doubly linked list of symbols; entries made
stale by an earlier merge are skipped when they are popped.  Decoding concatenates vocabulary strings with one space
between tokens (the file names no decoder).  The steps before and after follow the file: special tokens are found in
the raw text, the rest is NFC-normalised, white space runs become one space, letters are lower-cased one by one, and
the pieces matched by the split pattern are mapped to the byte alphabet.

No piece crosses white space, so the token ids of whole white-space-separated words, and of their pieces, are kept in
bounded caches in each Python worker; these change speed only.  A batch is decoded at once, by gathering its tokens' bytes.  Letters, numbers and lower case are those of the
Unicode version that the library was built with (``unicode_classes``).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PerWorker, fresh
from .unicode_classes import has_later, lowered, pinned

CACHE_WORDS = 150_000  # words, and pieces, remembered by a worker before the cache is renewed from those still in use
CACHE_LENGTH = 64  # longer words are not remembered
OUT_BYTES = 1 << 20  # text encoded before a batch is handed back


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class WordEndBpe:
    """Encoder and decoder for a ``tokenizers`` JSON file of kind BPE with an end-of-word suffix."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = [vocab[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = text
        nothing: dict[int, int] = {}
        self.ranks = [nothing] * len(self.strings)  # by left symbol: the merge rank with each right one
        for rank, (a, b) in enumerate(merges):
            if self.ranks[vocab[a]] is nothing:
                self.ranks[vocab[a]] = {}
            self.ranks[vocab[a]][vocab[b]] = rank
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + self.suffix] for c in alphabet]
        # ranks of two neighbouring bytes, the second inside its piece or at the end of it
        self.byte_ranks = [self.ranks[a].get(b, -1) for a in self.inner for b in self.inner]
        self.end_ranks = [self.ranks[a].get(b, -1) for a in self.inner for b in self.last]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        split = split.replace(r"\s", r"\p{White_Space}")
        self.plain_pieces, self.exact_pieces = regex.compile(split).findall, pinned(split).findall
        self.spaces = regex.compile(r"\p{White_Space}+").split
        self.separators = regex.compile(r"[\x1c-\x1f]").search  # str.split() takes these for white space
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        coded = [(t + " ").encode() for t in self.strings]
        self.string_bytes = np.frombuffer(b"".join(coded), dtype=np.uint8)
        self.string_sizes = np.array([len(c) for c in coded], dtype=np.int64)
        self.string_starts = np.cumsum(self.string_sizes) - self.string_sizes
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def pieces(self, word: str) -> list[str]:
        return self.exact_pieces(word) if not word.isascii() and has_later(word) else self.plain_pieces(word)

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        data = piece.encode("utf-8")
        # the word end belongs to the last character of the byte alphabet, one per byte
        inner = self.inner
        ids = [inner[b] for b in data]
        n = len(ids)
        ids[-1] = self.last[data[-1]]
        if n == 1:
            return ids
        ranks, made, push, pop = self.ranks, self.made, heapq.heappush, heapq.heappop
        bits = n.bit_length()
        low = (1 << bits) - 1
        # the rank of each symbol with the one after it; an entry of the queue is that rank, then the position
        byte_ranks = self.byte_ranks
        own = [byte_ranks[a << 8 | b] for a, b in zip(data, data[1:-1])]
        own += (self.end_ranks[data[-2] << 8 | data[-1]], -1)
        queue = [r << bits | i for i, r in enumerate(own) if r >= 0]
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = pop(queue)
            i = entry & low
            best = entry >> bits
            if own[i] != best:
                continue  # stale: a side was merged meanwhile
            j = after[i]
            k = after[j]
            ids[i] = new = made[best]
            ids[j] = own[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                own[i] = r = ranks[new].get(ids[k], -1)
                if r >= 0:
                    push(queue, r << bits | i)
            else:
                own[i] = -1
            h = before[i]
            if h >= 0:
                own[h] = r = ranks[ids[h]].get(new, -1)
                if r >= 0:
                    push(queue, r << bits | h)
        return [i for i in ids if i >= 0]

    def _piece(self, piece: str) -> bytes:
        """Packed token ids of one piece, from memory if it is short and known."""
        found = self.known_pieces.get(piece)
        if found is None:
            found = array("i", self.merge(piece)).tobytes()
            if len(piece) <= CACHE_LENGTH:
                if len(self.known_pieces) >= CACHE_WORDS:
                    self.known_pieces.clear()
                self.known_pieces[piece] = found
        return found

    def _look_up(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = b"".join(map(self._piece, self.pieces(word)))
        if len(word) <= CACHE_LENGTH:
            if len(self.cache) >= CACHE_WORDS:
                self.cache, self.older = {}, self.cache
            self.cache[word] = found
        return found

    def words(self, text: str) -> list[str]:
        """The normalised text's runs without white space."""
        if text.isascii():
            return text.lower().split() if not self.separators(text) else self.spaces(text.lower())
        text = lowered(unicodedata.normalize("NFC", text))
        return self.spaces(text) if self.separators(text) else text.split()

    def encode(self, text: str) -> bytes:
        """Token ids as packed 32-bit integers."""
        parts = self.split_special(text) if self.split_special and "<|" in text else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(array("i", [self.special[part]]).tobytes())
            elif part:
                known, look_up = self.cache.get, self._look_up
                out += [known(w) or look_up(w) for w in self.words(part)]
        return b"".join(out)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """One string for each run ``offsets[i]:offsets[i + 1]`` of ids: their vocabulary strings, a space between two."""
        sizes = self.string_sizes[ids]  # each with a space after it
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.string_starts[ids] - ends[:-1], sizes)
        at += np.arange(ends[-1])
        data = self.string_bytes[at]
        row_ends = ends[offsets]
        last = row_ends[1:][np.diff(row_ends) > 0] - 1  # the space after a row's last token
        data = np.delete(data, last)
        rows = row_ends - np.concatenate([[0], np.cumsum(np.diff(row_ends) > 0)])
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(rows.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def coder_for(vocabulary: str) -> WordEndBpe:
    return WordEndBpe(json.loads(vocabulary))


def load(path: str) -> str:
    """The vocabulary file's text, read once on the driver; its size bounds what each task gets."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids", decoded: str | None = "decoded") -> DataFrame:
    """``df`` with the token ids of ``text`` and, unless ``decoded`` is None, the text they decode to.

    ``vocabulary`` is the file's content (a few megabytes; broadcast).  A null text counts as empty: no tokens and an
    empty decoding.  Whole texts are encoded; other columns pass through unchanged, but ones called like the outputs are
    replaced.  An empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(PerWorker(coder_for, vocabulary))
    names = [c for c in df.columns if c not in (ids, decoded)]
    hidden = fresh(df, "__encode")
    source = df.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hidden))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != hidden]
    schema = ", ".join([*fields, f"`{ids}` array<int>", *([f"`{decoded}` string"] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value.get()
        for batch in batches:
            texts = batch.column(hidden)
            first = 0
            while first < batch.num_rows:
                packed, size, last = [], 0, first
                while last < batch.num_rows and size < OUT_BYTES:
                    value = texts[last].as_py()
                    packed.append(coder.encode(value))
                    size += len(value)
                    last += 1
                values = np.frombuffer(b"".join(packed), dtype="<i4")
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                out = [batch.column(c).slice(first, last - first) for c in batch.schema.names if c != hidden]
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                if decoded:
                    out.append(coder.decode(values, offsets))
                yield pa.RecordBatch.from_arrays(out, names=[*names, ids, *([decoded] if decoded else [])])
                first = last

    return source.mapInArrow(run, schema)
