"""Byte-level BPE encoding of whole texts with the tokenizers library.

Before merging, such a tokenizer splits a text so that a single space between two other characters
always begins a new piece, whatever stands before it, and so does punctuation behind a letter or a digit.
The texts of a batch are therefore cut at their spaces, every distinct part is encoded once by the library
and kept, without the punctuation at its end, and the ids of the texts are gathered by index.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

MOST_KEPT, LONGEST_KEPT = 600_000, 64
AT_ONCE = 256  # parts given to the library in one call
MARKS = ".,;:!?"
CUT = regex.compile(r"(?<=[^\s\x1c-\x1f])(?= [^\s\x1c-\x1f])", regex.V1)


def pieces(text: str) -> list[str]:
    """Parts that are encoded apart from each other; joined they are the text."""
    return CUT.split(text) if text else []


def in_a_row(ids: list[np.ndarray], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    return np.concatenate([np.zeros(0, dtype), *ids]), bounds


def gathered(values: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``at`` of values, one behind the other, and where each begins."""
    lengths = (bounds[1:] - bounds[:-1])[at]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    source = np.repeat(bounds[at] - ends[:-1], lengths)
    source += np.arange(len(source))
    return values[source], ends


class Encoder:
    """Token ids of texts, as little-endian integers of ``dtype``. One per process and file."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        before = described.get("pre_tokenizer") or {}
        #: The rule above holds for plain byte-level splitting only; other tokenizers get whole texts.
        self.cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not described.get("normalizer")
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        #: Numbers of the parts that follow a single space, without it, and the ids of part n: from bounds[n] on.
        self.kept: dict[str, int] = {}
        self.values, self.bounds = np.zeros(0, self.dtype), np.zeros(1, np.int64)
        self._mark("")  # number 0, without ids
        pieces_ = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Whether a token begins with a space, by its id.
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.begins[[i for piece, i in pieces_.items() if piece.startswith("Ġ")]] = True

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _whole(self, texts: Sequence[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            out += [np.array(one.ids, dtype=self.dtype) for one in found]
        return out

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of words that stand behind a space each, have none inside and are not kept yet."""
        ids, starts, total = [self.values], [self.bounds[:-1]], len(self.values)
        for at in range(0, len(words), AT_ONCE):
            some = words[at : at + AT_ONCE]
            (found,) = self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)
            new = np.array(found.ids, dtype=self.dtype)
            begins = np.flatnonzero(self.begins[new])
            if len(begins) != len(some):
                raise RuntimeError("the tokenizer does not begin a token at every space")
            ids.append(new)
            starts.append(begins + total)
            total += len(new)
        self.kept.update(zip(words, range(len(self.bounds) - 1, len(self.bounds) - 1 + len(words))))
        self.values, self.bounds = np.concatenate(ids), np.concatenate([*starts, [total]])

    def _loose(self, text: str) -> np.ndarray:
        """A text where white space stands together, or with very long parts."""
        return np.concatenate(self._whole(pieces(text)) or [np.zeros(0, self.dtype)])

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """Numbers of distinct parts that stand alone."""
        if len(self.kept) + len(parts) > MOST_KEPT:  # what is not asked for now is forgotten
            known = [" ", *(part for part in parts if part in self.kept)]
            at = np.array([self.kept[part] for part in known], dtype=np.int64)
            self.kept = dict(zip(known, range(len(known))))
            self.values, self.bounds = gathered(self.values, self.bounds, at)
        get = self.kept.get
        numbers = np.array([get(part, -1) for part in parts], dtype=np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(len(new)) + len(self.kept)
            self._learn([parts[i] for i in new.tolist()])
        return numbers

    def _mark(self, mark: str) -> int:
        """The number of punctuation that follows a letter or a digit."""
        key = " " + mark  # no part has a space
        if key not in self.kept:
            self.kept[key] = len(self.bounds) - 1
            (ids,) = self._whole([mark])
            self.values, self.bounds = np.concatenate([self.values, ids]), np.append(self.bounds, len(self.values) + len(ids))
        return self.kept[key]

    def encode_flat(self, texts: pa.Array | Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more: their end)."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.cuts or not len(column):
            return in_a_row(self._whole([text or "" for text in column.to_pylist()]), self.dtype)
        split = pc.split_pattern(pc.fill_null(column, ""), " ")
        coded = split.flatten().dictionary_encode()
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        part = coded.indices.to_numpy()
        names = coded.dictionary
        lengths = pc.utf8_length(names).to_numpy()
        stands = pc.equal(names, pc.utf8_trim_whitespace(names)).to_numpy(zero_copy_only=False)
        stands &= (lengths > 0) & (lengths <= LONGEST_KEPT)
        ends_open = (lengths == 0) | ~pc.equal(names, pc.utf8_rtrim_whitespace(names)).to_numpy(zero_copy_only=False)
        behind = np.ones(len(part), dtype=bool)
        behind[first[:-1]] = False  # the first part of a text has no space before it
        used = np.zeros(len(names), dtype=bool)
        used[part[behind]] = True
        stems = pc.utf8_rtrim(names, MARKS)
        marked = stands & pc.not_equal(stems, names).to_numpy(zero_copy_only=False)
        marked &= pc.match_substring_regex(stems, r"[\pL\pN]$").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(used & stands)
        stems = pc.if_else(pa.array(marked), stems, names).take(pa.array(at)).dictionary_encode()
        number, mark = np.zeros((2, len(names)), dtype=np.int64)
        number[at] = self._numbers(stems.dictionary.to_numpy(zero_copy_only=False).tolist())[stems.indices.to_numpy()]
        marked &= used
        tails = pc.replace_substring_regex(names.filter(pa.array(marked)), r"(?s)^.*[\pL\pN]", "").dictionary_encode()
        mark[marked] = np.array([self._mark(x) for x in tails.dictionary.to_pylist()], np.int64)[tails.indices.to_numpy()]
        heads, head = np.unique(part[first[:-1]], return_inverse=True)
        loose = np.logical_or.reduceat(behind & ~stands[part], first[:-1])
        loose |= (np.diff(first) > 1) & ends_open[part[first[:-1]]]
        more = self._whole([names[i].as_py() for i in heads.tolist()])
        place = number[part]
        place[first[:-1]] = len(self.bounds) - 1 + head
        second = np.where(behind, mark[part], 0)  # what stands behind the letters of a part; most have nothing
        if loose.any():  # these texts are encoded as they are, and stand for all of their parts
            nothing = len(self.bounds) - 1 + len(more)
            more.append(np.zeros(0, self.dtype))
            for row in np.flatnonzero(loose).tolist():
                place[first[row] : first[row + 1]] = nothing
                second[first[row] : first[row + 1]] = 0
                place[first[row]] = len(self.bounds) - 1 + len(more)
                more.append(self._loose(column[row].as_py() or ""))
        values, bounds = in_a_row(more, self.dtype)
        bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        ended = np.flatnonzero(second)
        place = np.insert(place, ended + 1, second[ended])
        first = first + np.searchsorted(ended, first)
        found, ends = gathered(np.concatenate([self.values, values]), bounds, place)
        return found, ends[first]

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[bytes]:
        """The ids of each text; of none for a null or empty text."""
        values, bounds = self.encode_flat(texts)
        raw, cuts = values.tobytes(), (bounds * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]
