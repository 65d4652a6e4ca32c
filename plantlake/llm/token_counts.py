"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

The pre-tokens that a batch has not met before are held as ragged numpy arrays: the symbols of all of them one after
the other, and where each begins.  In every round each sequence applies its lowest-ranked pair at all its places at
once (from the left where places overlap); sequences without a pair are done, and what survives is counted.  Merging
all places of one rank together equals merging them one by one because a pair with the new symbol always ranks
later, which is checked when the vocabulary is loaded.

Special tokens of the file are found in the raw text first and count one each.  A worker remembers the counts of a
bounded number of short pre-tokens; this changes speed only.  Whole texts are counted, a long one in parts that end
where a pre-token ends; a part grows beyond ``GROUP`` only where no white space follows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bpe import byte_alphabet
from .common import PerWorker, fresh
from .unicode_classes import LETTER, SPACE, TEXT_BREAK, kinds
from .wordhash import mix, powers

# The endings that a byte-level vocabulary splits off at an apostrophe.
ONE_LETTER = [ord(c) for c in "stmd"]
TWO_LETTERS = ("re", "ve", "ll")

KNOWN_PIECES = 200_000  # pre-tokens whose counts a worker remembers
KNOWN_LENGTH = 48  # longer ones are not remembered
GROUP = 1 << 20  # code points looked at together
LOOKUP = 1 << 20  # pairs looked up at a time
NONE = np.int32(2**31 - 1)  # rank of a pair that does not merge


class RankMerger:
    """Counts of symbols that are left of byte strings after all merges of a ``tokenizers`` BPE file."""

    def __init__(self, spec: dict) -> None:
        model, before = spec["model"], spec["pre_tokenizer"]
        if before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level vocabulary without prefix space and normaliser is needed")
        if model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("plain merges are needed")
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        left, right = (np.array([vocab[p[side]] for p in pairs], dtype=np.int64) for side in (0, 1))
        since = np.full(max(vocab.values()) + 1, NONE, dtype=np.int64)  # the rank from which on a symbol exists
        since[self.made[::-1]] = np.arange(len(pairs) - 1, -1, -1)
        since[self.byte_ids] = -1
        if (np.maximum(since[left], since[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge comes before the symbols that it joins")
        keys = left << 32 | right
        keys, first = np.unique(keys[::-1], return_index=True)  # of repeated pairs the last one counts
        self.keys, self.ranks = keys, (len(pairs) - 1 - first).astype(np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.full(len(left), NONE, dtype=np.int32)
        if not len(self.keys):
            return out
        for a in range(0, len(left), LOOKUP):
            key = left[a : a + LOOKUP].astype(np.int64) << 32 | right[a : a + LOOKUP]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[a : a + LOOKUP] = np.where(self.keys[at] == key, self.ranks[at], NONE)
        return out

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string; 0 for an empty one."""
        done = np.zeros(len(pieces), dtype=np.int64)
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        names = np.flatnonzero(lengths)  # which piece each live sequence is
        lengths = lengths[names]
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = np.full(len(symbols), NONE, dtype=np.int32)  # of a symbol with the next one of its sequence
        if len(symbols) > 1:
            rank[:-1] = self.rank_of(symbols[:-1], symbols[1:])
        rank[np.cumsum(lengths) - 1] = NONE
        while len(names):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(rank, starts)
            live = lowest != NONE
            if not live.all():
                done[names[~live]] = lengths[~live]
                stay = np.repeat(live, lengths)
                symbols, rank = symbols[stay], rank[stay]
                names, lengths, lowest = names[live], lengths[live], lowest[live]
                if not len(names):
                    break
            places = np.flatnonzero(rank == np.repeat(lowest, lengths))
            run = np.concatenate([[True], np.diff(places) != 1])  # overlapping places are neighbours
            order = np.arange(len(places))
            places = places[(order - np.maximum.accumulate(np.where(run, order, 0))) % 2 == 0]
            symbols[places] = self.made[rank[places]]
            ends = np.cumsum(lengths)
            owner = np.searchsorted(ends, places, side="right")
            last = places + 2 == ends[owner]  # the new symbol ends its sequence
            first = places == ends[owner] - lengths[owner]  # or begins it
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            symbols, rank = symbols[keep], rank[keep]
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
            moved = places - np.arange(len(places))
            rank[moved] = NONE
            inner = moved[~last]
            rank[inner] = self.rank_of(symbols[inner], symbols[inner + 1])
            inner = moved[~first] - 1
            rank[inner] = self.rank_of(symbols[inner], symbols[inner + 1])
        return done


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of code points begin: runs of letters, of numbers and of other signs, each with a space
    before it; apostrophe endings; white space, whose last character before a word stands alone or is that space.
    """
    kind = kinds()[points]
    start = np.ones(len(points), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    before_word = (kind[:-1] == SPACE) & (kind[1:] < SPACE)
    start[:-1] |= before_word
    start[1:] &= ~(before_word & (points[:-1] == ord(" ")))
    quote = np.flatnonzero((points[:-1] == ord("'")) & start[:-1] & (kind[1:] == LETTER))
    one, two = points[quote + 1], points[np.minimum(quote + 2, len(points) - 1)]
    length = np.isin(one, ONE_LETTER).astype(np.int64)
    for a, b in TWO_LETTERS:
        length[(one == ord(a)) & (two == ord(b))] = 2
    quote, length = quote[length > 0], length[length > 0]
    start[quote + 1] = False
    after = quote + 1 + length
    start[after[after < len(points)]] = True
    return np.flatnonzero(start)


class TokenCounter:
    """Token counts of texts, with what a worker remembers."""

    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        self.merger = RankMerger(spec)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cut = regex.compile(r"(?<!\p{White_Space})\p{White_Space}")  # a pre-token always begins there
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> Iterator[str]:
        """A text without its special tokens, in parts that share no pre-token."""
        for part in self.special.splititer(text) if self.special else (text,):
            at = 0
            while len(part) - at > GROUP and (m := self.cut.search(part, at + GROUP)):
                yield part[at : m.start()]
                at = m.start()
            yield part[at:] if at else part

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        owners: list[int] = []
        held: list[str] = []
        size = 0
        for i, text in enumerate(texts):
            if self.special:
                total[i] = sum(1 for _ in self.special.finditer(text))
            for part in self.parts(text):
                if part:
                    owners.append(i)
                    held.append(part)
                    size += len(part)
                if size >= GROUP:
                    self._add(total, owners, held)
                    owners, held, size = [], [], 0
        self._add(total, owners, held)
        return total

    def _add(self, total: np.ndarray, owners: list[int], held: list[str]) -> None:
        if not held:
            return
        joined = TEXT_BREAK.join([*held, ""])  # each part ends with a break
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = piece_starts(points)
        lengths = np.diff(starts, append=len(points))
        breaks = np.flatnonzero(points == ord(TEXT_BREAK))
        text = points[starts] != ord(TEXT_BREAK)
        starts, lengths = starts[text], lengths[text]
        first, inverse = distinct(points, starts, lengths)
        pieces = [joined[a : a + n] for a, n in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)]
        known = self.known
        new = [p for p in pieces if p not in known]
        if new:
            known.update(zip(new, self.merger.counts([p.encode() for p in new]).tolist(), strict=True))
        each = np.array([known[p] for p in pieces], dtype=np.int64)[inverse]
        sums = np.concatenate([[0], np.cumsum(each)])
        ends = sums[np.searchsorted(starts, breaks)]
        np.add.at(total, owners, np.diff(ends, prepend=0))
        if len(known) > KNOWN_PIECES:
            known.clear()
        for p in new:
            if len(p) > KNOWN_LENGTH:
                known.pop(p, None)


def distinct(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each distinct piece, which of them each piece is): found by hashes, confirmed on all code points."""
    up, down = powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(mix(points.astype(np.uint64)) * up[: len(points)], out=sums[1:])
    hashes = mix((sums[starts + lengths] - sums[starts]) * down[starts] + lengths.astype(np.uint64))
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    model = first[inverse]
    same = lengths == lengths[model]
    size = np.where(same, lengths, 0)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    differs = points[np.repeat(starts, size) + inside] != points[np.repeat(starts[model], size) + inside]
    same[np.repeat(np.arange(len(starts)), size)[differs]] = False
    odd = np.flatnonzero(~same)  # another piece with the same hash: a piece of its own
    inverse[odd] = len(first) + np.arange(len(odd))
    return np.concatenate([first, odd]), inverse


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` without ``text``, with the number of tokens of each whole text in ``out`` (long).

    ``vocabulary`` is the content of a byte-level ``tokenizers`` file (broadcast; a file of a megabyte or two).  No
    tokens are added, special tokens that stand in a text count one each.  A null or empty text has 0 tokens; an empty
    table gives an empty result; repeated rows are counted each for itself; other columns pass through, one called
    like ``out`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(PerWorker(TokenCounter, vocabulary))
    names = [c for c in df.columns if c not in (text, out)]
    hidden = fresh(df, "__count")
    source = df.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hidden))
    schema = StructType([*(source.schema[c] for c in names), StructField(out, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value.get()
        for batch in batches:
            if batch.num_rows:
                counts = counter.count(batch.column(hidden).to_pylist())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(counts)], names=[*names, out])

    return source.mapInArrow(run, schema)
