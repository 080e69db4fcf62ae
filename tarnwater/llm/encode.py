"""Token ids of whole texts with a public tokenizer.

Where the loaded tokenizer's normal forms and split pattern are known not to look past a blank, a slice of texts is cut at ASCII
blanks, each distinct piece is encoded once by the tokenizers library and the ids are joined. A-Z are lower-cased first and a full
stop or comma behind a-z taken off, so that fewer pieces are encoded; not in pieces that then hold the content of an added token, which
is matched in the raw text. Units of plain pieces go to the library's model, other pieces through all its steps. The pieces of the last slices stay in two flat arrays of bounded size. For any other tokenizer whole texts are encoded.
"""

from __future__ import annotations

import contextlib
import ctypes
import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces that an encoder keeps, of at most LONGEST_KEPT bytes: some megabytes of flat arrays. Beyond, it keeps those of the last slice.
KEPT_PIECES, LONGEST_KEPT = 300_000, 64
#: Bytes of text encoded at a time; a longer text is cut at a blank.
TEXT_BYTES = 2_000_000
#: Signs of joined pieces given to the library at a time.
RUN_SIGNS = 32_000
END_ID = 2

_BLANK = re.compile(r"[ \t\n\r\f\v]")
_WORD_AND_MARK = "^[a-z]+[.,]$"
#: A piece of ASCII signs but the apostrophe and of Latin-1 letters, and the units into which the split below cuts it once it is lower-cased.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿß]+")
_UNITS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Signs that stand for the bytes without a printable sign of their own, in order: 256 and following.
_OWN_SIGN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _OWN_SIGN)}

# The parts of a tokenizer that are known not to look past an ASCII blank, nor past a full stop or comma behind a word
# of the letters a-z that ends there, and to drop the difference of A-Z and a-z. A tokenizer has to have these steps and no others.
_STEPS_BEFORE = (
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
)
_SPLITS = (
    {
        "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed", "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
)


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer, as its library describes it, gives a text the ids of its pieces between blanks."""
    normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or ()
    plain = not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")) and not any(_BLANK.search(t["content"]) for t in added)
    whole = not any(spec.get(k) for k in ("truncation", "padding")) and not (spec.get("model") or {}).get("dropout")
    return plain and whole and tuple(normal.get("normalizers", ())) == _STEPS_BEFORE and tuple(split.get("pretokenizers", ())) == _SPLITS


def whole_rows(table: DataFrame) -> DataFrame:
    """Each row of a table as one value, ``row``, so that no name of its columns meets one of an operator's own."""
    return table.select(F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("row"))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker and is shared by its tasks."""
    return sys.modules.setdefault("_tarnwater_worker", types.ModuleType("_tarnwater_worker")).__dict__


def release_memory(keep_encoders: bool = False) -> None:
    """Give back what a task of this worker no longer needs, so that workers that wait don't hold it; the encoders (some tens of MB) too, unless kept."""
    if not keep_encoders:
        worker_state().pop("encoders", None)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(task: Callable[[Iterator], Iterator], keep_encoders: bool = False) -> Callable[[Iterator], Iterator]:
    """The task over batches, with the worker's memory given back before and after it."""

    def run(batches: Iterator) -> Iterator:
        release_memory(keep_encoders)
        yield from task(batches)
        release_memory(keep_encoders)

    return run


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(texts: pa.Array, most: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of texts that hold about ``most`` bytes each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(size):
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + most, side="right")))
        yield start, stop
        start = stop


def gathered(flat: np.ndarray, first: np.ndarray, each: np.ndarray) -> np.ndarray:
    """``each[i]`` elements of ``flat`` from place ``first[i]`` on, for every i, one behind another."""
    index = np.repeat((first - (np.cumsum(each, dtype=np.int64) - each)).astype(np.int32), each)
    index += np.arange(len(index), dtype=np.int32)
    return flat[index]


class Encoder:
    """Texts to unsigned ids: 16 bit where every id of the vocabulary fits, else 32."""

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = splits_at_blanks(json.loads(self.tokenizer.to_str()))
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.dtype = np.dtype("<u2" if max(largest, end_id) < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype)
        self.model = self.tokenizer.model
        added = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.added = "|".join(map(re.escape, added))
        self.has_added = re.compile(self.added).search if added else lambda piece: None
        self._keep(pa.array([], pa.large_string()), np.empty(0, self.dtype), np.empty(0, np.int32))

    def _keep(self, pieces: pa.Array, flat: np.ndarray, length: np.ndarray) -> None:
        """Keep these pieces, of those within LONGEST_KEPT, and their ids."""
        short = np.asarray(pc.binary_length(pieces)) <= LONGEST_KEPT
        if not short.all():
            first = np.cumsum(length) - length
            pieces, flat, length = pieces.filter(pa.array(short)), gathered(flat, first[short], length[short]), length[short]
        self.kept, self.kept_flat, self.kept_length = pieces, flat, length

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces as one text with blanks between them: ids, and their number for each piece. An id belongs to the piece in which it starts."""
        found = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        starts = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found.ids))[::2]
        return np.array(found.ids, self.dtype), np.diff(np.searchsorted(starts, ends), prepend=0).astype(np.int32)

    def _units(self, piece: str, seen: dict[str, list[int]]) -> list[int] | None:
        """Ids of a plain piece, unit by unit from the tokenizer's model; None for other pieces."""
        if not _PLAIN.fullmatch(piece):
            return None
        lowered = piece.lower()
        if self.has_added(lowered):
            return None
        ids: list[int] = []
        for unit in _UNITS.findall(lowered):
            found = seen.get(unit)
            if found is None:
                signs = unit if unit.isascii() else unit.encode().decode("latin-1").translate(_BYTE_SIGNS)
                found = seen[unit] = [token.id for token in self.model.tokenize(signs)]
            ids += found
        return ids

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that aren't kept: plain ones by the model, the others joined, in runs of bounded length."""
        seen: dict[str, list[int]] = {}
        out = [self._units(piece, seen) for piece in pieces]
        run, signs = [], 0
        others = [i for i, ids in enumerate(out) if ids is None]
        for i in others:
            run.append(i)
            signs += len(pieces[i])
            if signs > RUN_SIGNS or i == others[-1]:
                flat, length = self._joined([pieces[j] for j in run])
                stop = np.cumsum(length).tolist()
                for j, n, end in zip(run, length.tolist(), stop, strict=True):
                    out[j] = flat[end - n : end].tolist()
                run, signs = [], 0
        length = np.fromiter(map(len, out), np.int32, len(out))
        return np.fromiter(chain.from_iterable(out), self.dtype, int(length.sum())), length

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: a flat array, and each piece's place and number there."""
        at = pc.index_in(pieces, self.kept)
        missing = at.is_null()
        new = pieces.filter(missing)
        new_flat, new_length = self._encoded(new.to_pylist())
        all_length = np.concatenate([self.kept_length, new_length])
        flat = np.concatenate([self.kept_flat, new_flat])
        first = np.cumsum(all_length, dtype=np.int64) - all_length
        place = np.asarray(at.fill_null(0), np.int64)
        place[np.asarray(missing)] = len(self.kept) + np.arange(len(new))
        first, length = first[place], all_length[place]
        if len(self.kept) + len(new) <= KEPT_PIECES:
            self._keep(pa.concat_arrays([self.kept, new]), flat, all_length)
        else:
            self._keep(pieces, gathered(flat, first, length), length)
        return flat, first, length

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, each with the end id, and the n + 1 places where texts begin. Null counts as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.by_pieces:
            return self._whole(texts.to_pylist())
        if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > TEXT_BYTES:
            parts = [self._slice(pa.array([part], pa.large_string()))[0][:-1] for part in _cut(texts[0].as_py())]
            ids = np.concatenate([*parts, self.end])
            return ids, np.array([0, len(ids)])
        return self._slice(texts)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for some texts without nulls, piece by piece."""
        words = pc.ascii_split_whitespace(texts)
        bounds = np.asarray(words.offsets, np.int64)
        coded = words.flatten().dictionary_encode()
        pieces = coded.dictionary
        lowered = pc.ascii_lower(pieces)
        if self.added:
            lowered = pc.if_else(pc.match_substring_regex(lowered, self.added), pieces, lowered)
        marked = pc.match_substring_regex(lowered, _WORD_AND_MARK)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(lowered, 0, -1), lowered)
        parts = pa.concat_arrays([stems, pa.array([".", ","], pa.large_string())]).dictionary_encode()
        flat, first, length = self._ids(parts.dictionary)
        codes = np.asarray(parts.indices, np.int64)
        stem, dot, comma = codes[:-2], codes[-2], codes[-1]
        # A piece is its stem and, in some, the mark behind it.
        mark = np.where(np.asarray(pc.ends_with(lowered, ".")), dot, comma)
        both = np.stack([stem, mark], 1).ravel()
        each = length[both]
        each[1::2] *= np.asarray(marked)
        flat = np.append(gathered(flat, first[both], each), self.end)
        length = np.append(each[::2] + each[1::2], 1).astype(np.int32)
        first = np.cumsum(length, dtype=np.int64) - length
        sequence = np.insert(np.asarray(coded.indices, np.int32), bounds[1:] - bounds[0], len(length) - 1)
        each = length[sequence]
        upto = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        return gathered(flat, first[sequence], each), upto[bounds - bounds[0] + np.arange(len(bounds))]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for a tokenizer about which nothing is known: texts are encoded whole, one by one."""
        parts = [np.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.dtype), self.end) for t in texts]
        return np.concatenate([np.empty(0, self.dtype), *parts]), np.cumsum([0, *map(len, parts)])


def _cut(text: str) -> Iterator[str]:
    """A long text in parts of about TEXT_BYTES / 2 signs that end before a blank; longer where there is no blank."""
    start = 0
    while start < len(text):
        blank = _BLANK.search(text, start + TEXT_BYTES // 2)
        stop = blank.start() if blank else len(text)
        yield text[start:stop]
        start = stop


def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """The worker's encoder of a vocabulary."""
    state = worker_state().setdefault("encoders", {})
    if (path, end_id) not in state:
        state[path, end_id] = Encoder(path, end_id)
    return state[path, end_id]


def binary_column(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that lie one behind another in ``flat``; bounds count its elements."""
    at = (bounds - bounds[0]) * flat.dtype.itemsize
    part = np.ascontiguousarray(flat[bounds[0] : bounds[-1]])
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(part)])
