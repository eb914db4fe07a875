"""Byte-level BPE encoding and decoding with contiguous rank arrays (operator 1).

A word is held as one contiguous row: the token that starts at every part
boundary, and beside it the merge rank of each adjacent pair.  One step scans
the ranks for the minimum, deletes the boundary between the two parts, and
refreshes the ranks to its left and right.  Words of similar length are
stacked, so one numpy step advances thousands of words; a word longer than
``SHORT`` bytes (whitespace or letter runs) is merged with a heap, since
rescanning would be quadratic there.

Texts are cut at single spaces and line ends between two non-space characters
before the pre-tokenising pattern runs.  Every alternative of the pattern either
starts with such a character or cannot cross it, so the pieces between them
encode independently and a bounded per-process table of pieces serves most words.

Spark side: ``encode`` and ``decode`` are Arrow-batched map stages without any
shuffle; memory is bounded by ``STEP_CHARS`` plus one text.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import id_of, lean, text_of

SHORT = 96            # longest word (bytes) merged by the rank array
STEP_CHARS = 1 << 20  # characters encoded together
MAX_PIECES = 200_000  # pieces remembered per process
NO_RANK = np.int32(2**31 - 1)


def _byte_chars() -> dict[str, int]:
    """The printable stand-in character of every byte in byte-level vocabularies:
    printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Vocabulary, merge ranks and encoder of one byte-level BPE file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        chars = _byte_chars()
        self.token_bytes: dict[int, bytes] = {
            i: bytes(chars[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in chars.items():
            self.byte_id[b] = vocab.get(c, 0)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_rank = keys[order], order.astype(np.int32)
        self.pair_of = dict(zip(keys.tolist(), range(len(pairs))))
        self.pattern = regex.compile(pattern)
        self.run_of_space = re.compile(r"\s\s")
        self.safe_space = regex.compile(r"(?<=\S) (?=\S)")
        self.safe_line = re.compile(r"(?<=\S)(?=\n\S)")
        self.special_split = (regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special else None)
        self.forget()

    def forget(self) -> None:
        """Drop the piece table (a task calls this when it ends)."""
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int64)

    # -- merging ---------------------------------------------------------
    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.pair_keys, key)
        np.minimum(at, len(self.pair_keys) - 1, out=at)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], NO_RANK)

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word (1 to SHORT bytes) by the contiguous rank array."""
        part, n = self._merge_stacked(words)
        return [row[:k] for row, k in zip(part, n.tolist())]

    def _merge_stacked(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words of ``merge_short``, a row each, and how many of a row count."""
        n = np.array([len(w) for w in words])
        wide = int(n.max())
        raw = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8)
        part = self.byte_id[raw].reshape(len(words), wide)
        col = np.arange(wide)
        rank = np.full((len(words), wide), NO_RANK, np.int32)
        if wide > 1:
            rank[:, :-1] = self._rank(part[:, :-1], part[:, 1:])
            rank[col[None, :] >= (n - 1)[:, None]] = NO_RANK
        out, size = np.zeros((len(words), wide), np.int32), np.zeros(len(words), np.int64)
        who = np.arange(len(words))
        while len(who):
            rows = np.arange(len(who))
            j = rank.argmin(1)
            low = rank[rows, j]
            live = low != NO_RANK
            if not live.all():
                out[who[~live]], size[who[~live]] = part[~live], n[~live]
                who, part, rank, n, j, low = (x[live] for x in (who, part, rank, n, j, low))
                if not len(who):
                    break
                rows = np.arange(len(who))
            # delete the boundary after part j: everything right of it moves one left
            src = np.minimum(col[None, :] + (col[None, :] > j[:, None]), wide - 1)
            part = np.take_along_axis(part, src, 1)
            src = np.minimum(col[None, :] + (col[None, :] >= j[:, None]), wide - 1)
            rank = np.take_along_axis(rank, src, 1)
            rank[:, -1] = NO_RANK
            part[rows, j] = self.merged[low]
            n = n - 1
            # refresh the neighbouring ranks
            has = j > 0
            rank[rows[has], j[has] - 1] = self._rank(part[rows[has], j[has] - 1], part[rows[has], j[has]])
            has = j < n - 1
            rank[rows[has], j[has]] = self._rank(part[rows[has], j[has]], part[rows[has], j[has] + 1])
            rank[rows[~has], j[~has]] = NO_RANK
        return out, size

    def merge_long(self, word: bytes) -> np.ndarray:
        """Token ids of one long word: the same merges from a heap of ranked pairs."""
        part = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        size, width, find = len(part), int(self.width), self.pair_of.get
        nxt, prv = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(size - 1)
                if (r := find(part[i] * width + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if part[i] != a or k >= size or part[k] != b:
                continue  # one of the two parts has changed since
            part[i], part[k] = int(self.merged[r]), -1
            nxt[i] = nxt[k]
            if nxt[k] < size:
                prv[nxt[k]] = i
            for lo, hi in ((prv[i], i), (i, nxt[i])):
                if lo >= 0 and hi < size and (q := find(part[lo] * width + part[hi])) is not None:
                    heapq.heappush(heap, (q, lo, part[lo], part[hi]))
        return np.array([p for p in part if p >= 0], np.int32)

    def encode_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of distinct pre-tokens end to end, and per word where its ids start and
        how many there are; neighbours in length share a rank array."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        n_short = sum(len(w) <= SHORT for w in words)
        ids, lens = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, n_short, 8192):
            part, n = self._merge_stacked([words[j] for j in order[i:min(i + 8192, n_short)]])
            ids.append(part[np.arange(part.shape[1]) < n[:, None]])
            lens.append(n)
        for j in order[n_short:]:
            ids.append(self.merge_long(words[j]))
            lens.append(np.array([len(ids[-1])], np.int64))
        starts, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        n = np.concatenate(lens)
        size[order], starts[order] = n, np.cumsum(n) - n
        return np.concatenate(ids), starts, size

    def encode_words(self, words: list[bytes]) -> dict[bytes, np.ndarray]:
        """Token ids of distinct pre-tokens."""
        ids, starts, size = self.encode_flat(words)
        return {w: ids[i:i + n] for w, i, n in zip(words, starts.tolist(), size.tolist())}

    # -- texts -----------------------------------------------------------
    def _pieces(self, text: str) -> list[str]:
        """Keys of the pieces of a text without special tokens: a key that starts with
        a space is the first piece as it is (its space is only a mark), one that
        starts with a line end is as it is, any other follows a space."""
        if not self.run_of_space.search(text):
            cut = text.replace("\n", " \n").split(" ")
        else:
            cut = []
            for piece in self.safe_space.split(text):
                cut += self.safe_line.split(piece) if "\n" in piece else [piece]
        cut[0] = " " + cut[0]
        return cut

    @staticmethod
    def _spelled(key: str) -> str:
        return key[1:] if key[:1] == " " else key if key[:1] == "\n" else " " + key

    def _learn(self, keys: set[str]) -> None:
        if len(self.index) + len(keys) > MAX_PIECES:
            self.forget()
        found = [self.pattern.findall(self._spelled(k)) for k in keys]
        words = list(itertools.chain.from_iterable(found))
        distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
        at = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
        ids, starts, n = self.encode_flat([w.encode() for w in distinct])
        got = gathered(ids, starts[at], n[at])
        ends = np.concatenate([[0], np.cumsum(n[at])])
        last = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        size, first, total = np.diff(ends[last], prepend=0), len(self.index), len(got)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(size) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lens = np.concatenate([self.lens, np.zeros_like(self.lens)])
        if total:
            self.flat[self.used:self.used + total] = got
        self.starts[first:first + len(size)] = self.used + np.cumsum(size) - size
        self.lens[first:first + len(size)] = size
        self.used += total
        self.index.update(zip(keys, range(first, first + len(size))))

    def _units(self, text: str) -> list[str | int]:
        """Texts between special tokens, and the ids of special tokens."""
        if not self.special_split or not any(s in text for s in self.special):
            return [text] if text else []
        return [self.special.get(u, u) for u in self.special_split.split(text) if u]

    def _located(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Per text its units — a count of pieces, or -1 - id of a special token —
        and the table rows of all pieces in order."""
        keys: list[str] = []
        shape: list[list[int]] = []
        for t in texts:
            units = []
            for u in self._units(t):
                if isinstance(u, int):
                    units.append(-1 - u)
                else:
                    p = self._pieces(u)
                    keys += p
                    units.append(len(p))
            shape.append(units)
        got = list(map(self.index.get, keys))
        if None in got:
            missing = {k for k, g in zip(keys, got) if g is None}
            if len(self.index) + len(missing) > MAX_PIECES:
                missing = set(keys)  # the table restarts with what this step needs
            self._learn(missing)
            got = list(map(self.index.__getitem__, keys))
        return shape, np.array(got, np.int64)

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text."""
        for step in steps(texts):
            shape, at = self._located(step)
            size = self.lens[at]
            ids = gathered(self.flat, self.starts[at], size)
            ends = np.concatenate([[0], np.cumsum(size)])
            piece = 0
            for units in shape:
                got = []
                for u in units:
                    if u < 0:
                        got.append(np.array([-1 - u], np.int32))
                    else:
                        got.append(ids[ends[piece]:ends[piece + u]])
                        piece += u
                yield got[0] if len(got) == 1 else np.concatenate([np.zeros(0, np.int32), *got])

    def count_many(self, texts: list[str]) -> Iterator[int]:
        """Number of tokens of each text: the table's lengths, no ids assembled."""
        for step in steps(texts):
            shape, at = self._located(step)
            ends = np.concatenate([[0], np.cumsum(self.lens[at])])
            piece = 0
            for units in shape:
                n = 0
                for u in units:
                    n += 1 if u < 0 else int(ends[piece + u] - ends[piece])
                    piece += max(u, 0)
                yield n

    def encode_text(self, text: str) -> np.ndarray:
        return next(self.encode_many([text]))

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids; unknown ids are skipped, broken UTF-8 is replaced."""
        return b"".join([self.token_bytes.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


def gathered(flat: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + size]``, end to end."""
    hop = np.repeat(starts - (np.cumsum(size) - size), size)
    hop += np.arange(len(hop))
    return flat[hop]


def steps(texts: list[str]) -> Iterator[list[str]]:
    """Slices of a batch with about STEP_CHARS characters each."""
    step: list[str] = []
    size = 0
    for t in texts:
        if step and size + len(t) > STEP_CHARS:
            yield step
            step, size = [], 0
        step.append(t)
        size += len(t)
    if step:
        yield step


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per process and file."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def slices(batches, rows: int = 1_024):
    """Arrow batches in slices, so that few rows are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_decoded: bool = False) -> DataFrame:
    """Token ids of every text: ``doc_id``, ``ids`` (little-endian unsigned 32-bit
    integers), ``n_tokens``; ``with_decoded`` adds ``decoded``, the text of the ids.

    ``path`` is a byte-level BPE file that every executor can read and
    ``pattern`` its pre-tokenising expression.  Special tokens inside texts are
    recognised; none are added.  Null text: no tokens.  Repeated rows: one
    result row each.
    """
    @lean
    def run(batches):
        bpe = load(path, pattern)
        for b in slices(batches):
            ids = [x.astype("<u4") for x in bpe.encode_many(b.column(1).to_pylist())]
            out = {"doc_id": b.column(0), "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
                   "n_tokens": pa.array([len(x) for x in ids], pa.int64())}
            if with_decoded:
                out["decoded"] = pa.array([bpe.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(out)
        bpe.forget()

    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    return src.mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint" + ", decoded string" * with_decoded)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Add the text of packed token ids to every row (null ids: empty)."""
    if out_col in encoded.columns:
        raise ValueError(f"column {out_col} already exists")
    at = encoded.columns.index(ids_col)

    @lean
    def run(batches):
        bpe = load(path, pattern)
        for b in slices(batches):
            got = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())],
                                             [*b.schema.names, out_col])
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))
