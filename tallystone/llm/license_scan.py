"""License scans: winnowed template fingerprints pick candidates, banded alignment measures them."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystone.llm.arrow_text import chunks
from tallystone.llm.license_texts import TEMPLATES
from tallystone.llm.words import hash_spans, lower_ascii, shingle_hashes, word_spans
from tallystone.llm.workers import map_in_arrow

# Words in a fingerprint, and fingerprints of which the smallest is kept.
GRAM = 3
WINDOW = 3
# Templates of at most so many words keep all their fingerprints, so that a change in one line leaves some.
SHORT = 10
# Templates of at most so many words must be matched in full.
WHOLE_WORDS = 10
# Words that a match may gain or lose on its way, and the least share of a template to report.
BAND = 6
MIN_COVERAGE = 0.8

_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


@dataclass(frozen=True)
class Words:
    """Word hashes of whole rows, each word's first and last character in its row, words before each row."""

    first: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def _words(column: pa.Array) -> Iterator[Words]:
    """Words in lower case without the marks around them; words of marks only are left out."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    passed = 0
    for chunk in chunks(column):
        data = lower_ascii(chunk.data)
        starts, ends, firsts = word_spans(data, chunk.bounds)
        rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        plain = np.concatenate([[0], np.cumsum(~_IS_MARK[data])])
        kept = plain[ends] > plain[starts]
        starts, ends, rows = starts[kept], ends[kept], rows[kept]
        # From the first byte that is no mark to the last one.
        starts = np.searchsorted(plain, plain[starts], side="right") - 1
        ends = np.searchsorted(plain, plain[ends], side="left")
        bounds = np.searchsorted(rows, np.arange(len(firsts)))
        characters = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
        before = characters[chunk.bounds[:-1]][rows] if len(rows) else 0
        hashes = hash_spans(data, starts, ends)
        at, to = characters[starts] - before, characters[ends] - before
        if parts or not chunk.last:
            parts.append((hashes, at + passed, to + passed))
            passed += int(characters[-1])
            if chunk.last:
                hashes, at, to = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts, passed = [], 0
                yield Words(chunk.first, hashes, at, to, np.array([0, len(hashes)]))
        else:
            yield Words(chunk.first, hashes, at, to, bounds)


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash of every ``window`` neighbours (the last of equal ones); all windows are met."""
    if len(grams) == 0:
        return np.empty(0, np.int64)
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(grams[::-1].argmin())])
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


@dataclass(frozen=True)
class TemplateIndex:
    """Templates as word hashes, and an inverted index of their winnowed fingerprints."""

    names: list[str]
    words: list[np.ndarray]
    keys: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, templates: Mapping[str, str], gram: int = GRAM, window: int = WINDOW) -> TemplateIndex:
        names, words, keys, template, place = [], [], [], [], []
        for name, text in sorted(templates.items()):
            found = np.concatenate([w.hashes for w in _words(pa.array([text]))] or [np.empty(0, np.uint64)])
            if not len(found):
                continue
            grams, _ = shingle_hashes(found, np.array([0, len(found)]), gram)
            at = winnow(grams, window) if len(found) > SHORT else np.arange(len(grams))
            names.append(name)
            words.append(found)
            keys.append(grams[at])
            template.append(np.full(len(at), len(names) - 1))
            place.append(at)
        if not names:
            return cls([], [], np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        return cls(names, words, flat[order], np.concatenate(template)[order], np.concatenate(place)[order])


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND, last: int | None = None) -> tuple[int, int, int]:
    """(matched words, first, end) of the best alignment near a diagonal; text place - template place is it.

    Longest common subsequence within the band around the diagonals from ``diagonal`` to ``last``; of the
    longest, the tightest span of the text wins.
    """
    length = len(template)
    if last is None and 0 <= diagonal and diagonal + length <= len(text) and np.array_equal(template, text[diagonal : diagonal + length]):
        return length, diagonal, diagonal + length
    width = 2 * band + 1 + (0 if last is None else last - diagonal)
    # Per offset in the band: (words matched, first place), the latest first of equally many.
    none = (0, -1)
    row = [none] * (width + 1)
    sought, words = template.tolist(), text.tolist()
    found = (0, 0, 0)  # matched words, - length of the span, end
    for i, word in enumerate(sought):
        new = [none] * (width + 1)
        for o in range(width):
            j = i + diagonal + o - band
            best = max(row[o + 1], new[o - 1] if o else none)  # skip a template word, or a text word
            if 0 <= j < len(words) and word == words[j]:
                count, first = row[o]
                match = (count + 1, first if count else j)
                best = max(best, match)
                found = max(found, (match[0], match[1] - j - 1, j + 1))
            new[o] = best
        row = new
    count, span, end = found
    return count, end + span, end


class Spans:
    """Stretches of a text that do not overlap, in order."""

    def __init__(self):
        self.firsts: list[int] = []
        self.ends: list[int] = []

    def free(self, at: int, length: int) -> tuple[int, int] | None:
        """The stretch between the spans that a place lies in, or None if a span covers the place."""
        i = bisect_right(self.firsts, at)
        if i and self.ends[i - 1] > at:
            return None
        return self.ends[i - 1] if i else 0, self.firsts[i] if i < len(self.firsts) else length

    def add(self, first: int, end: int) -> bool:
        """Take a stretch unless a span overlaps it."""
        i = bisect_right(self.firsts, first)
        if (i and self.ends[i - 1] > first) or (i < len(self.firsts) and self.firsts[i] < end):
            return False
        self.firsts.insert(i, first)
        self.ends.insert(i, end)
        return True

    def remove(self, first: int) -> None:
        i = bisect_right(self.firsts, first) - 1
        del self.firsts[i], self.ends[i]


def _chains(hits: list[tuple[int, int]], slack: int, cost: float) -> Iterator[list[tuple[int, int]]]:
    """Hits (text place, template place) strung together where both rise, the strongest chains first.

    A chain gains the words it passes and pays ``cost`` for each word by which neighbours differ in their
    diagonals, which is at most ``slack``. Every hit is in one chain.
    """
    scores: list[float] = []
    links: list[int] = []
    for i, (at, place) in enumerate(hits):
        best, link = float(GRAM), -1
        for j in range(i - 1, -1, -1):
            gone, passed = at - hits[j][0], place - hits[j][1]
            if gone > 2 * slack:
                break
            if gone > 0 and passed > 0 and abs(gone - passed) <= slack:
                score = scores[j] + min(gone, passed) - cost * abs(gone - passed)
                if score > best:
                    best, link = score, j
        scores.append(best)
        links.append(link)
    used = [False] * len(hits)
    for i in sorted(range(len(hits)), key=lambda i: -scores[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(hits[i])
            i = links[i]
        if chain:
            yield chain[::-1]


def _places(template: np.ndarray, words: np.ndarray, hits: list[tuple[int, int]], least: float, band: int) -> list[tuple[int, int, int]]:
    """(matched words, first word, end word) of every place of one template with ``least`` matched words.

    Verbatim places come first, then chains of hits that stay near a diagonal, then chains across
    insertions of up to the template's own length each. A hit is done with only where it lies in a place
    already found; an incomplete place at last takes in what belongs to it behind an insertion.
    """
    length, spans, found = len(template), Spans(), []
    for diagonal in sorted({at - place for at, place in hits}):
        if 0 <= diagonal <= len(words) - length and np.array_equal(template, words[diagonal : diagonal + length]):
            if spans.add(diagonal, diagonal + length):
                found.append((length, diagonal, diagonal + length))
    tried = set()

    def aligned(part: list[tuple[int, int]], low: int, high: int) -> tuple[int, int, int] | None:
        diagonals = [at - place for at, place in part]
        start = max(low, part[0][0] - part[0][1] - band)
        stop = min(high, part[-1][0] + length - part[-1][1] + band)
        region = (start, stop, min(diagonals), max(diagonals))
        # No more words can match than the region holds at all.
        if region in tried or np.isin(template, words[start:stop]).sum() < least:
            return None
        tried.add(region)
        count, first, end = align(template, words[start:stop], region[2] - start, band, region[3] - start)
        return (count, start + first, start + end) if count and count >= least else None

    for cost in (0.5, 0.001):
        left = [h for h in hits if spans.free(h[0], len(words))]
        for chain in _chains(left, max(length, band), cost):
            stretches: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for hit in chain:
                stretch = spans.free(hit[0], len(words))
                if stretch:
                    stretches.setdefault(stretch, []).append(hit)
            for (low, high), part in stretches.items():
                place = aligned(part, low, high)
                if place and spans.add(*place[1:]):
                    found.append(place)
    ats = [at for at, _ in hits]
    for k, (count, first, end) in enumerate(found):
        if count == length:
            continue
        spans.remove(first)
        low, high = spans.free(first, len(words))
        near = hits[bisect_left(ats, max(low, first - 2 * length)) : bisect_left(ats, min(high, end + 2 * length))]
        if any(not first <= at < end for at, _ in near):
            place = aligned(next(_chains(near, max(length, band), 0.001)), low, high)
            if place and place[0] > count:
                found[k] = place
        spans.add(*found[k][1:])
    return found


def find_matches(index: TemplateIndex, words: np.ndarray, min_coverage: float = MIN_COVERAGE, gram: int = GRAM, band: int = BAND) -> Iterator[tuple[int, int, int, int]]:
    """(template, matched words, first word, end word) of every place of a template in one text."""
    grams, _ = shingle_hashes(words, np.array([0, len(words)]), gram)
    low, high = np.searchsorted(index.keys, grams, "left"), np.searchsorted(index.keys, grams, "right")
    hits: dict[int, list[tuple[int, int]]] = {}
    for p in np.flatnonzero(high > low).tolist():
        for t, q in zip(index.template[low[p] : high[p]].tolist(), index.place[low[p] : high[p]].tolist(), strict=True):
            hits.setdefault(t, []).append((p, q))
    for template, own in sorted(hits.items()):
        sought = index.words[template]
        # One word of a line like "under the X License" names it, so lines must be there whole.
        least = 1.0 if len(sought) <= WHOLE_WORDS else min_coverage
        for match in _places(sought, words, own, least * len(sought), band):
            yield template, *match


def scan_licenses(
    df: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    min_coverage: float = MIN_COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, license, coverage, matched_words, span_start, span_end``: one row per place of a license.

    Templates are few and short, so their index goes to every task. Each text's word groups are looked
    up in it; every hit names a template and where it would begin. Hits that follow one another in text and
    template are one candidate, aligned word by word; in between up to the template's own length may be
    inserted at a time (six words for shorter ones). Reported is the share of the template's words found in
    order, and the span as characters of the text, from 0, end excluded; templates of at most
    ``WHOLE_WORDS`` words count only with all of them. Of overlapping matches the one with
    more matched words stays, then the better covered, then the first by name and place; so a full
    notice hides the one-line reference that it begins with.

    Whole texts are read, however long. Null, empty and licenceless texts have no row; a null id stays
    null; repeated rows are reported once each; no templates or an empty table give an empty result.
    """
    index = TemplateIndex.of(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            found: list[tuple[str, float, int, int, int]] = []
            for words in _words(batch.column(1)):
                # Rows without any template fingerprint are passed over at once.
                grams, bounds = shingle_hashes(words.hashes, words.bounds, GRAM)
                hit = np.flatnonzero(np.isin(grams, index.keys))
                for i in np.unique(np.searchsorted(bounds, hit, side="right") - 1).tolist():
                    at = int(words.bounds[i])
                    own = words.hashes[at : int(words.bounds[i + 1])]
                    for template, count, first, end in _strongest(index, own, min_coverage):
                        rows.append(words.first + i)
                        coverage = count / len(index.words[template])
                        found.append((index.names[template], coverage, count, int(words.starts[at + first]), int(words.ends[at + end - 1])))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            types = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "license", "coverage", "matched_words", "span_start", "span_end"])

    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_in_arrow(
        rows, scan, "doc_id bigint, license string, coverage double, matched_words bigint, span_start bigint, span_end bigint"
    )


def _strongest(index: TemplateIndex, words: np.ndarray, min_coverage: float) -> list[tuple[int, int, int, int]]:
    """Matches that cover enough of their template, without those overlapped by a stronger one."""
    enough = list(find_matches(index, words, min_coverage))
    enough.sort(key=lambda m: (-m[1], -m[1] / len(index.words[m[0]]), m[0], m[2]))
    spans = Spans()
    return sorted((m for m in enough if spans.add(m[2], m[3])), key=lambda m: m[2])
