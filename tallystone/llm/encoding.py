"""Token ids of many texts at once: each distinct word of a batch is encoded once.

The vocabulary's normaliser and splitter never look across ASCII white space, so a text's ids are
its words' ids in a row. ``applies_to`` checks that for the vocabulary at hand; another vocabulary
is encoded text by text. Words are told apart by 64-bit hashes: with half a million remembered, two
of them clash with a probability below one in a hundred million.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallystone.llm.arrow_text import Chunk, chunks
from tallystone.llm.words import hash_spans, lower_ascii, word_spans
from tallystone.llm.workers import trim

# Distinct words remembered by one Python worker; about 40 bytes each.
REMEMBERED = 300_000
# Bytes of text whose distinct words are looked up together, and new words encoded by one call.
BATCH_BYTES = 1 << 20
_CALL_WORDS = 8192

# ASCII marks that always form a token run of their own behind a letter. Not here: the apostrophe,
# which begins contractions, and the characters of special tokens.
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = True
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
# In a word without these bytes (U+0300 and above, and the bar of special tokens), lower-casing A-Z
# first changes no id: such a word holds no combining marks.
_NEEDS_CASE = np.arange(256) >= 0xCC
_NEEDS_CASE[ord("|")] = True


def _units(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chunk's bytes, mostly in lower case, and its words with trailing marks apart: fewer distinct units."""
    starts, ends, _ = word_spans(chunk.data, chunk.bounds)
    data = lower_ascii(chunk.data)
    odd = _NEEDS_CASE[chunk.data]
    if odd.any():
        before = np.concatenate([[0], np.cumsum(odd)])
        found = before[ends] > before[starts]
        step = np.zeros(len(data) + 1, np.int8)
        np.add.at(step, starts[found], 1)
        np.add.at(step, ends[found], -1)
        data = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, chunk.data, data)
    stems = ends.copy()
    for _ in range(5):
        marks = np.flatnonzero(_IS_MARK[data[stems - 1]] & (stems - 1 > starts))
        if not len(marks):
            break
        stems[marks] -= 1
    split = (stems < ends) & _IS_LETTER[data[stems - 1]]
    stems = np.where(split, stems, ends)
    begins = np.sort(np.concatenate([starts, stems[split]]), kind="stable")
    stops = np.sort(np.concatenate([stems, ends[split]]), kind="stable")
    return data, begins, stops, np.searchsorted(begins, chunk.bounds)


class WordEncoder:
    """Ids of whole texts by the public ``tokenizers`` library, without added special tokens."""

    def __init__(self, path: str):
        # One task, one thread: threads of the library's own would each keep memory, and take other tasks' cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_words = applies_to(json.load(file))
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.empty(0, np.uint64)  # of remembered units, ascending
        self._begins, self._lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self._table = np.empty(0, np.uint32)  # their ids, end to end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
        """(first row, ids, per row the number of ids before it, last): see ``Chunk`` for long rows."""
        if not self.by_words:
            for row, text in enumerate(column.fill_null("").to_pylist()):
                ids = self.encode([text])[0]
                yield row, ids, np.array([0, len(ids)]), True
            return
        for chunk in chunks(column, BATCH_BYTES):
            places, firsts = self._words(chunk)
            sizes = self._lengths[places]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            ids = self._table[np.arange(ends[-1]) + np.repeat(self._begins[places] - ends[:-1], sizes)]
            yield chunk.first, ids, ends[firsts], chunk.last

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Numbers of ids per row; the ids themselves are never put in a row."""
        totals = np.zeros(len(column), np.int64)
        if not self.by_words:
            for row, text in enumerate(column.fill_null("").to_pylist()):
                totals[row] = len(self.encode([text])[0])
            return totals
        for chunk in chunks(column, BATCH_BYTES):
            places, firsts = self._words(chunk)
            ends = np.concatenate([[0], np.cumsum(self._lengths[places])])
            totals[chunk.first : chunk.first + len(firsts) - 1] += np.diff(ends[firsts])
        return totals

    def _words(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Each unit's row in the remembered ones, and per text the number of units before it."""
        data, starts, ends, firsts = _units(chunk)
        if len(starts) == 0:
            return np.empty(0, np.int64), firsts
        hashes, at, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._hashes) > REMEMBERED:
            self._forget()
        new = ~self._has(hashes)
        if new.any():
            raw, at = data.tobytes(), at[new]
            self._learn(hashes[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        return np.searchsorted(self._hashes, hashes)[which], firsts

    def _has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._hashes):
            return np.zeros(len(hashes), bool)
        at = np.searchsorted(self._hashes, hashes)
        return self._hashes[np.minimum(at, len(self._hashes) - 1)] == hashes

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        lengths, tables = np.zeros(len(units), np.int64), [self._table]
        for at in range(0, len(units), _CALL_WORDS):
            ids = self._ids(units[at : at + _CALL_WORDS])
            lengths[at : at + len(ids)] = [len(x) for x in ids]
            tables.append(np.fromiter((i for x in ids for i in x), np.uint32))
        begins = np.cumsum(lengths) - lengths + len(self._table)
        self._table = np.concatenate(tables)
        merged = np.concatenate([self._hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self._hashes = merged[order]
        self._begins = np.concatenate([self._begins, begins])[order]
        self._lengths = np.concatenate([self._lengths, lengths])[order]
        trim()

    def _ids(self, units: list[bytes]) -> list[list[int]]:
        ids: list[list[int]] = [[]] * len(units)
        model, rest = self.tokenizer.model, []
        for i, unit in enumerate(units):
            if unit.isalpha():  # of bytes: letters a-z only, nothing for the normaliser and the splitter to do
                ids[i] = [t.id for t in model.tokenize(unit.decode())]
            else:
                rest.append(i)
        encoded = self.tokenizer.encode_batch_fast([units[i].decode("utf-8") for i in rest], add_special_tokens=False)
        for i, found in zip(rest, encoded, strict=True):
            ids[i] = found.ids
        return ids


def applies_to(vocabulary: dict) -> bool:
    """Whether the file describes lower-cased, white-space-dropping BPE with word ends, as assumed above."""
    normalizer = [x.get("type") for x in (vocabulary.get("normalizer") or {}).get("normalizers", [])]
    splitter = [x.get("type") for x in (vocabulary.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    model = vocabulary.get("model") or {}
    return (
        normalizer == ["NFC", "Replace", "Lowercase"]
        and splitter == ["Split", "ByteLevel"]
        and model.get("type") == "BPE"
        and bool(model.get("end_of_word_suffix"))
        and not model.get("dropout")
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in vocabulary.get("added_tokens", []))
    )


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per Python worker and vocabulary, with what it remembers."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
