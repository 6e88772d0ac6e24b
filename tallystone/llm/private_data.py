"""Personal data in texts: rules, word lists and contexts vote on spans, and their agreement trains a classifier.

1. *Candidates.* Four strict patterns give the base spans, which always stay. Loose patterns give further
   candidates: addresses spelled out, numbers in other groupings, long network addresses.
2. *Labelers.* Each candidate gets a vote for, a vote against or no vote from each of six labelers: a
   pattern, a check of the digits or parts, a gazetteer, the words before it, the words around it that
   speak against, and the characters next to it.
3. *Reliabilities.* Nobody has labelled the candidates. Expectation-maximisation over the numbers of
   candidates by kind and votes estimates how often each labeler is right.
4. *Classifier.* A linear model over votes and the span's shape is fitted to the resulting probabilities and
   decides which of the loose candidates are added.

Only counts by (kind, votes, shape) leave the tasks: at most 4 * 3**6 * 2**SHAPE_BITS rows for any corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallystone.llm.arrow_text import slices
from tallystone.llm.workers import map_in_arrow

KINDS = ("email", "ip", "card", "phone")
# Probability from which on a loose candidate is added.
THRESHOLD = 0.5

# ---- gazetteers -------------------------------------------------------------------------

# Ends of public host names.
DOMAIN_ENDS = frozenset("com org net edu gov mil int info biz name io dev app de fr es it nl uk eu ch at be pl se no dk fi pt cz us ca au nz jp cn in br mx ru".split())
# First digits of the large card networks.
CARD_STARTS = ("2", "34", "35", "36", "37", "38", "39", "4", "5", "6")
# Words that announce a kind, in the four languages of the corpus, and words that speak against all kinds.
CUES = {
    "email": frozenset("email e-mail mail mailto contact write kontakt correo courriel adresse".split()),
    "ip": frozenset("ip ipv4 ipv6 host server address addr from login adresse servidor serveur".split()),
    "card": frozenset("card visa mastercard amex credit debit pan karte kreditkarte tarjeta carte".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax whatsapp telefon anruf telefono teléfono téléphone".split()),
}
AGAINST = frozenset("version v ver release isbn issn page pages pp doi chapter section no nr number order invoice id ref sku eur usd $ € £ %".split())

# ---- candidates -------------------------------------------------------------------------

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IS_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SPELLED_AT = re.compile(
    r"(?:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}"
    r"(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,5}",
    re.IGNORECASE,
)
_SPELLED = re.compile(r"[\[({]\x20?at\x20?[\])}]|\x20at\x20[^\n]{1,200}?(?:\x20dot\x20|[\[({]\x20?dot)", re.IGNORECASE)
_LONG_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_LOOSE_CARD = re.compile(
    r"(?<![0-9A-Za-z.+/-])(?:[0-9]{4}([\x20./-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([\x20./-])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])"
)
_LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z.+/-])(?:(?:\+|00)[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z-]|\.[0-9])"
)

# A text without any of these bytes has no candidate. (RE2)
_POSSIBLE = r"[0-9@]|:[0-9A-Fa-f]{1,4}:|(?i:[\[({ ]at[\])} ].*dot)"

Span = tuple[int, int, int]  # kind's number, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: at every @ that a host name follows, the characters before it back to the match before."""
    after = 0
    for host in _AT.finditer(text) if "@" in text else ():
        start = host.start()
        while start > after and text[start - 1] in _IS_LOCAL:
            start -= 1
        if start < host.start():
            yield start, host.end()
            after = host.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Of numbers joined by dots, four at a time from the left."""
    for run in _DOTTED.finditer(text):
        if text.count(".", run.start(), run.end()) < 3:
            continue
        for parts in batched(_DIGITS.finditer(text, run.start(), run.end()), 4):
            if len(parts) == 4 and all(_below_256(p.group()) for p in parts):
                yield parts[0].start(), parts[3].end()


def _below_256(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if 14 <= found.end() - found.start() <= 38:
            digits = _only_digits(found.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_only_digits(found.group())) <= 15:
            yield found.span()


_BASE: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[Span]:
    """Matches of the four strict patterns, by start and then kind."""
    found = [(kind, *span) for kind, spans in enumerate(_BASE) for span in spans(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    after = 0
    for host in _SPELLED_AT.finditer(text) if _SPELLED.search(text) else ():
        start = host.start()
        while start > after and host.start() - start < 64 and text[start - 1] in _IS_LOCAL:
            start -= 1
        if start < host.start() and re.search(r"dot", host.group(), re.IGNORECASE):
            yield start, host.end()
            after = host.end()


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (found.span() for found in pattern.finditer(text))


_LOOSE = (_spelled_emails, _matches(_LONG_IP), _matches(_LOOSE_CARD), _matches(_LOOSE_PHONE))


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """Further candidates, none of which overlaps a base span or one of an earlier kind, by start."""
    taken = sorted((a, b) for _, a, b in base)
    found: list[Span] = []
    for kind, spans in enumerate(_LOOSE):
        new = [(kind, a, b) for a, b in spans(text)]
        if new:
            new = _apart(new, taken)
            found += new
            taken = sorted(taken + [(a, b) for _, a, b in new])
    return sorted(found, key=lambda s: (s[1], s[0]))


def _apart(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans that overlap none of the taken ones; both by start."""
    kept, i = [], 0
    reach = 0
    for kind, a, b in spans:
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= a:
            kept.append((kind, a, b))
    return kept


# ---- labelers ---------------------------------------------------------------------------

LABELERS = ("pattern", "check", "gazetteer", "cue", "against", "neighbours")
SHAPE_BITS = 6
_WORD = re.compile(r"[^\W_][\w-]*|[$€£%]")
# Characters looked at before and after a span for words.
_REACH = 40


def _check(kind: int, text: str, digits: str) -> int:
    if kind == 0:
        return 1 if 3 <= len(text) <= 254 and ".." not in text and text[0] not in ".-" else -1
    if kind == 1:
        return 1 if ":" in text else (-1 if text.startswith(("0.", "255.")) else 1)
    if kind == 2:
        return 1 if 13 <= len(digits) <= 19 and _luhn(digits) and len(set(digits)) > 2 else -1
    return 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1


def _gazetteer(kind: int, text: str, digits: str) -> int:
    if kind == 0:
        return 1 if re.split(r"[^a-z]+", text.lower())[-1] in DOMAIN_ENDS else -1
    if kind == 1:
        return 0 if ":" in text else (-1 if text.startswith(("127.", "1.0.", "2.0.")) else 1)
    if kind == 2:
        return 1 if digits.startswith(CARD_STARTS) else -1
    return 1 if text.startswith(("+", "00", "(")) else -1


def votes(text: str, span: Span, is_base: bool) -> tuple[int, ...]:
    """Each labeler's vote: 1 for, -1 against, 0 for none."""
    kind, start, end = span
    inside = text[start:end]
    digits = _only_digits(inside)
    before = _WORD.findall(text[max(0, start - _REACH) : start].lower())[-3:]
    after = _WORD.findall(text[end : end + _REACH // 2].lower())[:1]
    next_to = text[max(0, start - 1) : start] + text[end : end + 1]
    return (
        1 if is_base else -1,
        _check(kind, inside, digits),
        _gazetteer(kind, inside, digits),
        1 if any(w in CUES[KINDS[kind]] for w in before) else 0,
        -1 if any(w in AGAINST for w in [*before[-2:], *after]) else 0,
        -1 if any(c.isalnum() or c in "/=_#" for c in next_to) else 1,
    )


def shape(text: str, span: Span) -> int:
    """Bits: a sign in front, brackets, blanks, dots, several groups of digits, a line's start."""
    kind, start, end = span
    inside = text[start:end]
    bits = (inside.startswith("+"), "(" in inside or "[" in inside, " " in inside, "." in inside, len(_DIGITS.findall(inside[:64])) > 2, start == 0 or text[start - 1] == "\n")
    return sum(bit << i for i, bit in enumerate(bits))


# ---- reliabilities and classifier -------------------------------------------------------


@dataclass(frozen=True)
class Patterns:
    """Numbers of candidates by kind, votes and shape; the order of the rows is that of the columns' values."""

    kind: np.ndarray
    votes: np.ndarray
    shape: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, tuple[int, ...], int, int]]) -> Patterns:
        rows = sorted(rows)
        table = np.array([(k, *v, s, n) for k, v, s, n in rows], dtype=np.int64).reshape(-1, len(LABELERS) + 3)
        return cls(table[:, 0], table[:, 1 : 1 + len(LABELERS)], table[:, -2], table[:, -1])

    def inputs(self) -> np.ndarray:
        """A row of the classifier's inputs per pattern: kind, votes for and against, bits of the shape."""
        kinds = self.kind[:, None] == np.arange(len(KINDS))
        bits = (self.shape[:, None] >> np.arange(SHAPE_BITS)) & 1
        return np.concatenate([kinds, self.votes == 1, self.votes == -1, bits], axis=1).astype(float)


# What is assumed of a labeler before the data speak: right in 8 of 10 votes, as if seen that often.
_RIGHT, _WRONG = 8.0, 2.0


def estimate(patterns: Patterns, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: each pattern's probability of personal data, and the labelers' reliabilities.

    Labelers are taken as independent given the truth, as in Dawid and Skene's model with missing votes.
    A reliability is the share of right votes among those cast, by kind, truth and labeler
    (``[kind, truth, labeler]``). It starts from the assumed shares, which also go on counting as a few
    votes, so a labeler that always agrees with itself cannot turn the truth round.
    """
    reliability = np.full((len(KINDS), 2, len(LABELERS)), _RIGHT / (_RIGHT + _WRONG))
    share = np.full(len(KINDS), 0.5)
    cast, is_for = patterns.votes != 0, patterns.votes == 1
    p = np.zeros(len(patterns.kind))
    for _ in range(rounds):
        right = reliability[patterns.kind]
        if_true = np.where(cast, np.log(np.where(is_for, right[:, 1], 1 - right[:, 1])), 0).sum(axis=1)
        if_false = np.where(cast, np.log(np.where(is_for, 1 - right[:, 0], right[:, 0])), 0).sum(axis=1)
        odds = np.log(share / (1 - share))[patterns.kind] + if_true - if_false
        before, p = p, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        for k in range(len(KINDS)):
            own = patterns.kind == k
            n = patterns.count[own].astype(float)
            yes, no = n * p[own], n * (1 - p[own])
            share[k] = (yes.sum() + 1) / (n.sum() + 2)
            for truth, mass, agrees in ((1, yes, is_for[own]), (0, no, ~is_for[own])):
                held = cast[own] * mass[:, None]
                reliability[k, truth] = ((held * agrees).sum(axis=0) + _RIGHT) / (held.sum(axis=0) + _RIGHT + _WRONG)
        if np.abs(p - before).max(initial=0) < 1e-10:
            break
    return p, reliability


def train(inputs: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Logistic regression on probabilities, weighted, by Newton steps; the penalty holds it in place where data are few."""
    w = np.zeros(inputs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -30, 30)))
        slope = inputs.T @ (weight * (p - target)) + penalty * w
        bend = inputs.T @ (inputs * (weight * p * (1 - p))[:, None]) + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        # A step far beyond the data's reach is shortened.
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class SpanModel:
    """The span classifier, with the reliabilities that it was trained from."""

    weights: np.ndarray
    reliability: np.ndarray

    def probability(self, kind: int, cast: tuple[int, ...], bits: int) -> float:
        x = Patterns.of([(kind, cast, bits, 1)]).inputs()[0]
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def fit(patterns: Patterns) -> SpanModel:
    p, reliability = estimate(patterns)
    # Numbers grow with the corpus; their logarithm keeps rare patterns in sight.
    return SpanModel(train(patterns.inputs(), p, np.log1p(patterns.count)), reliability)


# ---- passes over the texts --------------------------------------------------------------


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """(row, text) of the rows that can have a candidate."""
    possible = pc.fill_null(pc.match_substring_regex(batch.column(1), _POSSIBLE), False)
    for row in pc.indices_nonzero(possible).to_pylist():
        yield row, batch.column(1)[row].as_py()


def _rows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def count_patterns(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Patterns:
    """Candidates of all texts by kind, votes and shape, added up in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 1):
                for _, text in _texts(part):
                    base = base_spans(text)
                    spans = [(s, True) for s in base] + [(s, False) for s in loose_spans(text, base)]
                    seen.update((s[0], votes(text, s, is_base), shape(text, s)) for s, is_base in spans)
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in keys], pa.int32()), pa.array([v for _, v, _ in keys], pa.list_(pa.int32())),
             pa.array([s for _, _, s in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
            names=["kind", "votes", "shape", "n"],
        )

    counted = map_in_arrow(_rows(df, id_column, text_column), count, "kind int, votes array<int>, shape int, n bigint")
    found = counted.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")).collect()
    return Patterns.of([(r["kind"], tuple(r["votes"]), r["shape"], r["n"]) for r in found])


def find_private_data(
    df: DataFrame, model: SpanModel | None = None, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, spans`` for every row; spans are ``kind, start, end, text, is_base, p``, by start and then kind.

    Offsets are code points, the end exclusive. Base spans have the probability 1 and may overlap each
    other across kinds; added ones overlap nothing. Without a ``model`` one is fitted to all of ``df`` first. Null
    and empty texts have no spans; a null id stays null; repeated rows give equal rows; other columns
    are not read; texts count whole, however long. An empty table gives an empty result.
    """
    if model is None:
        model = fit(count_patterns(df, id_column, text_column))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, float] = {}
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("is_base", pa.bool_()), ("p", pa.float64())])
        for batch in batches:
            for part in slices(batch, 1):
                out: list[list] = [[]] * len(part)
                for row, text in _texts(part):
                    base = base_spans(text)
                    found = [(s, True, 1.0) for s in base]
                    for s in loose_spans(text, base):
                        key = s[0], votes(text, s, False), shape(text, s)
                        if key not in known:
                            known[key] = model.probability(*key)
                        if known[key] >= threshold:
                            found.append((s, False, known[key]))
                    found.sort(key=lambda x: (x[0][1], x[0][0]))
                    out[row] = [(KINDS[k], a, b, text[a:b], is_base, p) for (k, a, b), is_base, p in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.list_(item))], names=["doc_id", "spans"])

    schema = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,text:string,is_base:boolean,p:double>>"
    return map_in_arrow(_rows(df, id_column, text_column), find, schema)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
