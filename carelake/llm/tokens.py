"""Token ids of whole text columns by a public tokenizer file, with each distinct piece of text encoded once.

A text is cut into units before every space, which is where a byte-level BPE with the usual pre-token pattern also cuts,
unless the space stands inside a longer run of white space; texts with such a space, and texts with special strings, go
to the tokenizer whole. A distinct unit is cut further between a letter or digit and a punctuation mark, and around single
line feeds. The ids of such a piece do not depend on its neighbours, so joining the ids of distinct pieces gives the
library's result for the text.

A piece of letters is one pre-token. Where the file lists its merges in the order of their ids, as byte-level files do, such
pieces are merged by the compiled byte-pair encoder of tiktoken over the vocabulary of the same file; all others, and all
pieces of other files, go to the tokenizers library.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
#: About so many bytes of pieces and ids make a generation of the cache; a worker holds two.
CACHE_BYTES = 24 << 20
#: What an entry takes beside its characters and ids.
_ENTRY_BYTES = 160
#: Bytes of text encoded at a time.
BATCH = 3 << 20

_W = "[\\x09-\\x0d \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_MARK = "\x01"
_LETTERS = "\\A ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+\\z"
#: Functions of this library reach workers by value, so what a worker keeps between tasks lives in a module of its own.
_KEPT = "carelake_worker_state"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    """Where the public vocabulary file lies on this machine; an absolute path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@contextmanager
def encoding(name: str = BYTE_BPE) -> Iterator[Encoder]:
    """This worker's encoder for the length of a task: its tables stay with the worker, what it remembers goes at the end."""
    kept = vars(sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)))
    if name not in kept:
        kept[name] = Encoder(name)
    try:
        yield kept[name]
    finally:
        kept[name].forget()


def slices(column: pa.Array, size: int = BATCH):
    """Parts of a text column with at most ``size`` bytes, or one text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(column):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + size, "right")))
        yield column.slice(first, last - first)
        first = last


class Units:
    """The units of some texts: distinct ones as lists of pieces, and for every text the units it is made of."""

    def __init__(self, column: pa.Array, special: str, letters_special: bool = False):
        column = column.cast(pa.string()).fill_null("")
        lists = pc.split_pattern(column, " ")
        off = lists.offsets.to_numpy().astype(np.int64)
        self.off = off - off[0]
        found = lists.flatten().dictionary_encode()
        n = len(found.dictionary)
        self.codes = found.indices.to_numpy().astype(np.int64)
        is_first = np.zeros(len(self.codes), bool)
        is_first[self.off[:-1]] = True  # splitting gives every text a unit at least
        # a unit that begins a text has no space of its own; it is another distinct unit
        begin, place = np.unique(self.codes[is_first], return_inverse=True)
        self.codes[is_first] = n + place
        spaced = pc.binary_join_element_wise("", found.dictionary, " ")
        units = pa.concat_arrays([spaced, found.dictionary.take(pa.array(begin))])
        flag = lambda texts, pattern: pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        # most units are letters alone: nothing cuts or joins them, so the other patterns are looked for in the rest
        letters = flag(units, _LETTERS) if not letters_special else np.zeros(len(units), bool)
        others = np.flatnonzero(~letters)
        rest = units.take(pa.array(others))
        rest_whole = flag(rest, special)

        def spread(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(units), bool)
            out[others] = values
            return out

        whole = spread(rest_whole)
        bad = whole[self.codes]
        ends, begins = spread(flag(rest, f"{_W}\\z")), spread(flag(rest, f"\\A (?:{_W}|\\z)"))
        inside = ends[self.codes[:-1]] & begins[self.codes[1:]]
        inside[self.off[1:-1] - 1] = False
        bad[1:] |= inside
        at = np.flatnonzero(bad)
        texts = np.unique(np.searchsorted(self.off, at, "right") - 1)
        if len(at):  # these texts are one unit each
            lens = np.diff(self.off)
            keep = np.ones(len(self.codes), bool)
            for t in texts:
                keep[self.off[t] + 1 : self.off[t + 1]] = False
                self.codes[self.off[t]] = len(units) + int(np.searchsorted(texts, t))
            lens[texts] = 1
            self.codes = self.codes[keep]
            self.off = np.concatenate(([0], np.cumsum(lens)))
        cut = pc.replace_substring_regex(rest, "([\\p{L}\\p{N}])([!-/:-@\\[-`{-~])", "\\1" + _MARK + "\\2")
        lines = pc.replace_substring(cut, "\n", _MARK + "\n" + _MARK)
        cut = pc.if_else(pa.array(rest_whole), rest, pc.if_else(pa.array(flag(rest, f"{_W}\n|\n{_W}|\n\\z")), cut, lines))
        pieces = pc.split_pattern(cut, _MARK)
        if rest_whole.any():
            pieces = pa.array([[u] if w else p for u, w, p in zip(rest.to_pylist(), rest_whole, pieces.to_pylist(), strict=True)], pa.list_(pa.string()))
        if len(at):
            pieces = pa.concat_arrays([pieces.cast(pa.list_(pa.string())), pa.array([[column[int(t)].as_py()] for t in texts], pa.list_(pa.string()))])
        # pieces of the units of letters, one each, then those of the others; codes in the order of units
        sizes = np.ones(len(units) + len(texts), np.int64)
        cut_sizes = np.diff(pieces.offsets.to_numpy().astype(np.int64))
        is_cut = np.append(~letters, np.ones(len(texts), bool))
        sizes[is_cut] = cut_sizes
        self.piece_off = np.concatenate(([0], np.cumsum(sizes)))
        found = pa.concat_arrays([units.filter(pa.array(letters)), pieces.flatten().cast(pa.string())]).dictionary_encode()
        #: Distinct pieces, and those that each distinct unit is made of.
        self.pieces, codes = found.dictionary, found.indices.to_numpy().astype(np.int64)
        n_letters = int(letters.sum())
        from_cut = np.repeat(is_cut, sizes)
        self.piece_codes = np.empty(len(codes), np.int64)
        self.piece_codes[~from_cut], self.piece_codes[from_cut] = codes[:n_letters], codes[n_letters:]

    def counts(self) -> np.ndarray:
        """How often each distinct piece occurs."""
        used = np.bincount(self.codes, minlength=len(self.piece_off) - 1)
        return np.bincount(self.piece_codes, np.repeat(used, np.diff(self.piece_off)), len(self.pieces)).astype(np.int64)

    def lengths(self, of_pieces: np.ndarray) -> np.ndarray:
        """Sum over each text of a number given per distinct piece."""
        total = np.concatenate(([0], np.cumsum(of_pieces[self.piece_codes])))
        of_units = total[self.piece_off[1:]] - total[self.piece_off[:-1]]
        total = np.concatenate(([0], np.cumsum(of_units[self.codes])))
        return total[self.off[1:]] - total[self.off[:-1]]


def _gather(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pool[starts[i] : starts[i] + lens[i]] joined, offsets)."""
    ends = np.concatenate(([0], np.cumsum(lens, dtype=np.int64)))
    return pool[np.repeat(starts - ends[:-1], lens) + np.arange(ends[-1])], ends


def _merger(path: str, special: list[str]) -> Callable[[bytes], list[int]] | None:
    """A compiled encoder of single pre-tokens over the file's own vocabulary; None unless ids follow the order of merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") or model.get("byte_fallback"):
        return None
    # one character per byte, as byte-level vocabularies spell bytes
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*printable}))}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if not all(c in byte_of for k in vocabulary for c in k) or [vocabulary.get(a + b) for a, b in merges] != [256 + i for i in range(len(merges))]:
        return None
    import tiktoken

    ranks = {bytes(byte_of[c] for c in k): v for k, v in vocabulary.items()}
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class _Generation:
    """Ids of pieces, one after the other in a pool."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.pool = np.zeros(1 << 12, np.uint32)
        self.starts = np.zeros(1 << 10, np.int64)
        self.lens = np.zeros(1 << 10, np.int64)
        self.used = self.bytes = 0

    def add(self, pieces: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        n = len(self.codes)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while n + len(pieces) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lens = np.concatenate((self.lens, np.zeros_like(self.lens)))
        self.pool[self.used : self.used + len(flat)] = flat
        self.starts[n : n + len(pieces)] = self.used + np.cumsum(lens) - lens
        self.lens[n : n + len(pieces)] = lens
        self.codes.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.used += len(flat)
        self.bytes += sum(map(len, pieces)) + 4 * len(flat) + _ENTRY_BYTES * len(pieces)


class Encoder:
    def __init__(self, name: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(" " in s for s in special):
            raise ValueError("special strings with a space are not supported")
        self.special = "|".join(["\\Q" + s + "\\E" for s in special] + [_MARK])
        #: Whether a special string may stand in a unit of letters.
        self.letters_special = bool(pc.any(pc.match_substring_regex(pa.array(special, pa.string()), _LETTERS)).as_py())
        self.merge = _merger(tokenizer_path(name), special)
        self.cache_bytes = cache_bytes
        self.forget()

    def forget(self) -> None:
        self.young, self.old = _Generation(), _Generation()

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        return list(map(self.merge, map(str.encode, pieces)))

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, pieces: list[str], encode: Callable[[list[str]], list[list[int]]]) -> None:
        for i in range(0, len(pieces), 20_000):
            part = pieces[i : i + 20_000]
            ids = encode(part)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            self.young.add(part, np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens)

    def _codes(self, pieces: pa.Array) -> np.ndarray:
        """Places of distinct pieces in the young generation, where all of them are afterwards."""
        distinct = pieces.to_numpy(zero_copy_only=False)
        if self.young.bytes > self.cache_bytes:
            self.old, self.young = self.young, _Generation()
        young, old = self.young, self.old
        code = np.fromiter(map(young.codes.get, distinct.tolist(), repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(code < 0)
        if len(missing) and old.codes:
            found = np.fromiter(map(old.codes.get, distinct[missing].tolist(), repeat(-1)), np.int64, len(missing))
            kept, found, missing = missing[found >= 0], found[found >= 0], missing[found < 0]
            lens = old.lens[found]
            # what is added gets the next codes in its order
            code[kept] = len(young.codes) + np.arange(len(kept))
            young.add(distinct[kept].tolist(), _gather(old.pool, old.starts[found], lens)[0], lens)
        if len(missing):
            simple = np.zeros(len(missing), bool)
            if self.merge is not None:
                simple = pc.match_substring_regex(pieces.take(pa.array(missing)), _LETTERS).to_numpy(zero_copy_only=False)
            for part, encode in ((missing[simple], self._merged), (missing[~simple], self._encoded)):
                code[part] = len(young.codes) + np.arange(len(part))
                self._learn(distinct[part].tolist(), encode)
        return code

    def units(self, column: pa.Array) -> Units:
        return Units(column, self.special, self.letters_special)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets per text), as the library gives them without added special tokens."""
        if not len(column):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        units = self.units(column)
        code = self._codes(units.pieces)[units.piece_codes]
        pool, ends = _gather(self.young.pool, self.young.starts[code], self.young.lens[code])
        starts = ends[units.piece_off]
        ids, ends = _gather(pool, starts[units.codes], np.diff(starts)[units.codes])
        return ids, ends[units.off]

    def lengths(self, pieces: pa.Array) -> np.ndarray:
        """Token counts of distinct pieces, from the cache or the library."""
        codes = self._codes(pieces)
        return self.young.lens[codes]
