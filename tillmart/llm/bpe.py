"""Byte-level BPE: whole texts to token ids and back.

Words are encoded over a contiguous rank array. Parts start as single bytes and
``ranks[i]`` is the merge rank of parts ``i`` and ``i + 1``. The smallest rank is
found by scanning, the boundary behind its left part is deleted, and the two
neighbouring ranks are read anew. All new words of one length in a batch take
these steps together, one row of the arrays for each. Scanning costs the square
of a word's length, so a run of more than ``SHORT`` bytes without a split point
takes the same merges from a heap of (rank, position), which gives equal ids.

Words repeat, so each task keeps the ids of words it has met in dictionaries of a
bounded number of entries. Nothing is shuffled.

Defined cases: a missing text is an empty one and has no ids; missing ids decode
to a missing text; ids outside the vocabulary are left out by ``decode``; special
tokens written in a text become their own id; a column that already has the name
of a result column is replaced.
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORT = 128
#: Entries of each dictionary of words; a fuller one is emptied before the next rows.
REMEMBERED = 100_000
#: Characters of text that are split and encoded at a time.
STRETCH = 1_500_000
NEVER = 1 << 30

# The split pattern that the vocabulary was made with, and the letters and numbers that
# the regex module knows but the tables of the tokenizers library (Unicode 16) do not.
LATER = (
    r"՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    r"\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """Letters by which the vocabulary file writes bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Encoder and decoder of one vocabulary file (the JSON text of the tokenizers library)."""

    def __init__(self, vocabulary: str):
        file = json.loads(vocabulary)
        letters = _byte_letters()
        ids = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(map(letters.__getitem__, token)) for token, i in ids.items() if letters.keys() >= set(token)
        } | {i: token.encode() for token, i in self.special.items()}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        #: For the left part's id: the right part's id -> (rank), and by rank the id of the joined part.
        self.rank_of: dict[int, dict[int, int]] = {}
        self.joined: list[int] = []
        for rank, (left, right) in enumerate(file["model"]["merges"]):
            self.rank_of.setdefault(ids[left], {})[ids[right]] = rank
            self.joined.append(ids[left + right])
        self.split = regex.compile(PATTERN)
        self.split_later = regex.compile(
            "(?V1)" + PATTERN.replace(r"\s\p{L}\p{N}]", rf"[\s\p{{L}}\p{{N}}]--[{LATER}]]")
            .replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{LATER}]]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{LATER}]]+")
        )
        self.later = regex.compile(f"[{LATER}]")
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.ids_of_byte = np.array(self.byte_ids, np.int32)
        pairs = sorted((left << 32 | right, rank) for left, row in self.rank_of.items() for right, rank in row.items())
        self.pair_keys, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        self.joined_ids = np.array(self.joined, np.int32)
        #: Ids by piece, and by run between two single spaces (None: a run that touches other white space).
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.runs: dict[str, tuple[int, ...] | None] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def scan(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words of equal length, each row of the arrays being one word's parts and ranks."""
        done: list = [()] * len(words)
        rows = np.arange(len(words))
        parts = self.ids_of_byte[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), -1)
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if parts.shape[1] == 1:
                least, going = None, np.zeros(len(rows), bool)
            else:
                at = ranks.argmin(1)
                least = ranks[np.arange(len(rows)), at]
                going = least < NEVER
            if not going.all():
                for row, ids in zip(rows[~going].tolist(), parts[~going].tolist(), strict=True):
                    done[row] = tuple(ids)
                if not going.any():
                    break
                rows, parts, ranks, at, least = rows[going], parts[going], ranks[going], at[going], least[going]
            here = np.arange(len(rows))
            whole = self.joined_ids[least]
            stay = np.ones(parts.shape, bool)
            stay[here, at + 1] = False
            parts = parts[stay].reshape(len(rows), -1)
            parts[here, at] = whole
            stay = np.ones(ranks.shape, bool)
            stay[here, at] = False
            ranks = ranks[stay].reshape(len(rows), -1)
            inner = np.flatnonzero(at < ranks.shape[1])
            ranks[inner, at[inner]] = self.ranks(whole[inner], parts[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.ranks(parts[inner, at[inner] - 1], whole[inner])
        return done

    def learn(self, pieces: set[str]) -> None:
        """Encodes the pieces that are not known yet, those of one length together."""
        by_length: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in pieces:
            if piece not in self.pieces:
                coded = piece.encode()
                if len(coded) > SHORT:
                    self.pieces[piece] = tuple(self.heap([self.byte_ids[b] for b in coded]))
                else:
                    names, words = by_length.setdefault(len(coded), ([], []))
                    names.append(piece)
                    words.append(coded)
        for names, words in by_length.values():
            self.pieces.update(zip(names, self.scan(words), strict=True))

    def heap(self, parts: list[int]) -> list[int]:
        """The same merges for long runs: stale entries are skipped when they come up."""
        count, nothing = len(parts), {}
        after, before = [*range(1, count), -1], [-1, *range(count - 1)]
        rank = lambda i: self.rank_of.get(parts[i], nothing).get(parts[after[i]], NEVER) if after[i] >= 0 else NEVER
        waiting = [(r, i) for i in range(count) if (r := rank(i)) < NEVER]
        heapq.heapify(waiting)
        while waiting:
            least, i = heapq.heappop(waiting)
            if parts[i] < 0 or rank(i) != least:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = self.joined[least], -1, after[gone]
            if after[gone] >= 0:
                before[after[gone]] = i
            for j in (before[i], i):
                if j >= 0 and (r := rank(j)) < NEVER:
                    heapq.heappush(waiting, (r, j))
        return [p for p in parts if p >= 0]

    def cut(self, text: str) -> list[str]:
        later = not text.isascii() and self.later.search(text)
        return (self.split_later if later else self.split).findall(text)

    def cut_run(self, run: str) -> list[str] | None:
        """Pieces of a run that follows a single space; the commonest shapes need no pattern."""
        if run.isascii():
            if run.isalpha():
                return [" " + run]
            if run[:-1].isalpha() and run[-1] in ".,;:!?":
                return [" " + run[:-1], run[-1]]
        if not run or run[0].isspace() or run[-1].isspace():
            return None
        return self.cut(" " + run)

    def segments(self, text: str) -> Iterator[str | int]:
        """Parts of a text that encode alone: ids of special tokens, and stretches of about ``STRETCH`` characters."""
        parts = [text]
        if self.special_split is not None and any(s in text for s in self.special):
            parts = self.special_split.split(text)
        for j, part in enumerate(parts):
            if j % 2:
                yield self.special[part]
                continue
            start, at = 0, STRETCH
            while at < len(part) - 1:
                at = part.find(" ", at, len(part) - 1)
                if at < 0:
                    break
                # A single space between other characters always starts a piece.
                if not part[at - 1].isspace() and not part[at + 1].isspace():
                    yield part[start:at]
                    start, at = at, at + STRETCH
                else:
                    at += 1
            yield part[start:]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of several texts, so that their new words are encoded together."""
        found: list[list[int]] = [[] for _ in texts]
        waiting, size = [], 0
        for k, text in enumerate(texts):
            for segment in self.segments(text):
                if isinstance(segment, str):
                    size += len(segment)
                waiting.append((k, segment))
                if size >= STRETCH:
                    self._encode(waiting, found)
                    waiting, size = [], 0
        self._encode(waiting, found)
        return found

    def _encode(self, segments: list[tuple[int, str | int]], found: list[list[int]]) -> None:
        if len(self.runs) > REMEMBERED:
            self.runs.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        # As in ``segments``, a text may be cut at single spaces first.
        split = [None if isinstance(s, int) else s.split(" ") for _, s in segments]
        unknown = set(chain.from_iterable(words[1:] for words in split if words)).difference(self.runs)
        cuts = {run: self.cut_run(run) for run in unknown}
        heads = [self.cut(words[0]) if words else [] for words in split]
        self.learn(set(chain(chain.from_iterable(filter(None, cuts.values())), chain.from_iterable(heads))))
        ids_of = self.pieces.__getitem__
        for run, pieces in cuts.items():
            self.runs[run] = None if pieces is None else tuple(chain.from_iterable(map(ids_of, pieces)))
        for (k, segment), words, head in zip(segments, split, heads, strict=True):
            if words is None:
                found[k].append(segment)
                continue
            runs = list(map(self.runs.__getitem__, words[1:]))
            if None in runs or words[0][-1:].isspace():
                pieces = self.cut(segment)
                self.learn(set(pieces))
                found[k].extend(chain.from_iterable(map(ids_of, pieces)))
            else:
                found[k].extend(chain.from_iterable(map(ids_of, head)))
                found[k].extend(chain.from_iterable(runs))

    def decode(self, ids) -> str:
        known = self.bytes_of
        try:
            found = b"".join(map(known.__getitem__, ids))
        except KeyError:
            found = b"".join(known[i] for i in ids if i in known)
        return found.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str) -> Tokenizer:
    return Tokenizer(vocabulary)


def _vocabulary(frame: DataFrame, path: str):
    """The vocabulary file, read once and sent to the tasks; its size is that of a file, not of the data."""
    with open(path, encoding="utf-8") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def _with_column(frame: DataFrame, name: str, kind: T.DataType, work: Callable, path: str, of: str) -> DataFrame:
    """``work(tokenizer, values)`` gives the new column's values for up to 500 rows."""
    kept = [c for c in frame.columns if c.lower() != name.lower()]
    schema = T.StructType([f for f in frame.schema.fields if f.name in kept] + [T.StructField(name, kind)])
    arrow = pa.list_(pa.int32()) if isinstance(kind, T.ArrayType) else pa.string()
    sent = _vocabulary(frame, path)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the dictionaries hold no cycles, and tracing them is slow
        known = tokenizer(sent.value)
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 500):
                rows = batch.slice(at, 500)
                place = rows.schema.get_field_index
                column = pa.array(work(known, rows.column(place(of))), type=arrow)
                yield pa.RecordBatch.from_arrays([rows.column(place(c)) for c in kept] + [column], [*kept, name])

    return frame.mapInArrow(made, schema)


def _encoded(known: Tokenizer, texts: pa.Array) -> list[list[int]]:
    return known.encode_all([t or "" for t in texts.to_pylist()])


def _decoded(known: Tokenizer, ids: pa.Array) -> list[str | None]:
    return [known.decode(row.values.to_numpy(zero_copy_only=False).tolist()) if row.is_valid else None for row in ids]


def encode(documents: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of every whole text."""
    return _with_column(documents, ids, T.ArrayType(T.IntegerType()), _encoded, vocabulary_path, text)


def decode(documents: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for, special tokens included."""
    return _with_column(documents, text, T.StringType(), _decoded, vocabulary_path, ids)
