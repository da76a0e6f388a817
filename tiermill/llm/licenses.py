"""Licence notices in texts: winnowed fingerprints find candidates, banded alignment measures them.

The templates' word n-grams are winnowed: of every few in a row the one with the smallest hash is kept, of a short template all. A
text's n-grams are looked up in that index. Hits of a template that agree on where it would begin are a candidate, and
the template is aligned with the words there, within a band around that beginning: long runs of equal words are anchors, and only
what lies between them is aligned word by word. Words that tell versions and names apart must be there; of notices that
overlap, the one with the most words in common is reported.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tiermill.llm.common import extended, full_text
from tiermill.llm.license_texts import OBLIGATORY, TEMPLATES

GRAM = 3
WINNOW = 4
COVERAGE = 0.8
# Of a template of so many words a smaller part is reported too, as incomplete.
LONG, PARTIAL = 200, 0.25
WIDEST_BAND = 16
# Equal words in a row that an alignment goes through without looking beside them.
ANCHOR = 24
# Of a template's fingerprints, the share that a candidate has within its band; at a coverage of 0.8 some four in ten are left.
LEAST_HITS = 0.05
PIECE = 1 << 20
_WORD = re.compile(rb"[a-z0-9]+")
_GAP = re.compile(rb"[^a-z0-9]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Runs of letters a-z and digits of lower-cased bytes, in lists of a bounded size."""
    begin = 0
    while begin < len(data):
        gap = _GAP.search(data, begin + PIECE) if len(data) - begin > PIECE else None
        end = gap.start() if gap else len(data)
        yield _WORD.findall(data, begin, end)
        begin = end


def _numbers(data: bytes) -> np.ndarray:
    hashed = [np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some)) for some in _words(data)]
    return np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` words in a row."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        key = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            key = (key ^ words[i : i + len(key)]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the smallest of each ``window`` in a row (the last of equals); all if there are few."""
    if len(grams) < 4 * window:
        return np.arange(len(grams))
    rows = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(rows)) + window - 1 - rows.argmin(axis=1))


def _places(name: str, words: np.ndarray, phrases: Sequence[str]) -> np.ndarray:
    """Positions of the words of each phrase where it stands first, in order."""
    places = set()
    for phrase in phrases:
        wanted = _numbers(phrase.encode())
        at = [i for i in range(len(words) - len(wanted) + 1) if np.array_equal(words[i : i + len(wanted)], wanted)]
        if not at:
            raise ValueError(f"template {name!r} has no {phrase!r}")
        places.update(range(at[0], at[0] + len(wanted)))
    return np.array(sorted(places), np.int64)


@dataclass(frozen=True)
class Index:
    """Fingerprints in order, the template and position of each, and the templates' words and obligatory positions."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    position: np.ndarray
    needed: list[np.ndarray]
    least: list[float]

    @classmethod
    def of(
        cls, templates: Mapping[str, str], gram: int = GRAM, window: int = WINNOW, obligatory: Mapping[str, Sequence[str]] | None = None
    ) -> Index:
        names, words, found, needed, least = list(templates), [], [], [], []
        for number, name in enumerate(names):
            words.append(_numbers(templates[name].lower().encode()))
            grams = _grams(words[-1], gram)
            if not len(grams):
                raise ValueError(f"template {name!r} is shorter than {gram} words")
            kept = winnowed(grams, window)
            found += [(int(grams[p]), number, int(p)) for p in kept]
            needed.append(_places(name, words[-1], (obligatory or {}).get(name, ())))
            least.append(LEAST_HITS * len(kept))
        found.sort()
        prints, template, position = zip(*found)
        return cls(names, words, np.array(prints, np.uint64), np.array(template), np.array(position), needed, least)

    def hits(self, grams: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, position in it, position in the text) of each equal fingerprint."""
        first = np.minimum(np.searchsorted(self.prints, grams), len(self.prints) - 1)
        for at in np.flatnonzero(self.prints[first] == grams).tolist():
            entry = int(first[at])
            while entry < len(self.prints) and self.prints[entry] == grams[at]:
                yield int(self.template[entry]), int(self.position[entry]), at
                entry += 1


def _equal(template: np.ndarray, text: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether template word i equals text word i + low + c, at [c, i], for all c up to high - low."""
    equal = np.zeros((high - low + 1, len(template)), bool)
    for c in range(len(equal)):
        begin, end = max(0, -low - c), min(len(template), len(text) - low - c)
        if begin < end:
            equal[c, begin:end] = template[begin:end] == text[begin + low + c : end + low + c]
    return equal


def _runs(equal: np.ndarray, length: int) -> np.ndarray:
    """(c, first, behind) of the runs of at least ``length`` equal words, by their first."""
    edges = np.diff(np.pad(equal, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (c, first), behind = np.nonzero(edges == 1), np.nonzero(edges == -1)[1]
    runs = np.stack([c, first, behind], axis=1)[behind - first >= length]
    return runs[np.argsort(runs[:, 1], kind="stable")]


def _anchors(equal: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Long runs one behind the other in template and text, with the most words in all, less what lies between their diagonals."""
    runs = _runs(equal, length)
    points, before = [], []
    for n, (c, first, behind) in enumerate(runs):
        # what an earlier run leaves of this one: the text moves on with the template, plus the step between diagonals
        begin = np.maximum(first, runs[:n, 2] + np.maximum(runs[:n, 0] - c, 0))
        gain = np.array(points[:n]) + 2 * (behind - begin) - abs(runs[:n, 0] - c)
        gain[behind - begin < 1] = 0
        best = int(gain.argmax()) if n else -1
        if n and gain[best] > 2 * (behind - first):
            points.append(int(gain[best]))
            before.append((best, int(begin[best])))
        else:
            points.append(int(2 * (behind - first)))
            before.append((-1, int(first)))
    chain, at = [], int(np.argmax(points)) if points else -1
    while at >= 0:
        c, begin, behind = int(runs[at, 0]), before[at][1], int(runs[at, 2])
        chain.append((c, begin, behind))
        at = before[at][0]
    return chain[::-1]


# A state of an alignment in one number: points, then equal words, then obligatory words.
_POINT, _WORD_FOUND = 1 << 40, 1 << 20


def align(
    template: Sequence[int],
    text: Sequence[int],
    low: int,
    high: int,
    needed: Collection[int] = (),
    anchor: int = ANCHOR,
    equal: np.ndarray | None = None,
) -> tuple[int, int, int]:
    """Best local alignment with text position minus template position between ``low`` and ``high``.

    Two points for an equal word, one off for a word left out, put in or changed. The template's words at the positions ``needed`` must
    all be there, with nothing between neighbours. It goes through runs of ``anchor`` equal words, chosen to have the most
    words in all. Returns (equal words, first and behind the last aligned position of the text).
    """
    template, text = np.asarray(template, np.uint64), np.asarray(text, np.uint64)
    equal = _equal(template, text, low, high) if equal is None else equal
    must = np.zeros(len(template) + 1, bool)
    must[list(needed)] = True
    wanted, width = int(must.sum()), len(equal)
    places, matched = np.arange(width), equal.any(axis=0)
    state, first = np.zeros(width, np.int64), np.full(width, -1)
    best, span = 0, (-1, -1)

    def better(i: int) -> None:
        nonlocal best, span
        whole = np.where(state & (_WORD_FOUND - 1) == wanted, state, 0) if wanted else state
        at = int(whole.argmax())
        if whole[at] // _POINT > best // _POINT:
            best, span = int(whole[at]), (int(first[at]), i + low + at + 1)

    def inserted(i: int) -> None:
        """Text words put in behind row ``i``."""
        nonlocal state, first
        if must[i] and must[i + 1]:
            return
        reach = state + places * _POINT
        most = np.maximum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == most, places, 0))
        moved = most - places * _POINT
        state, first = np.where(moved >= _POINT, moved, 0), first[source]

    def row(i: int) -> None:
        nonlocal state, first
        same = equal[:, i]
        begun = np.where(same & (state == 0), i + low + places, first)
        if must[i]:
            state = np.where(same, state + 2 * _POINT + _WORD_FOUND + 1, 0)
            first = begun
        else:
            across = np.where(same, state + 2 * _POINT + _WORD_FOUND, state - _POINT)
            skipped = np.append(state[1:] - _POINT, 0)
            begun = np.where(skipped > across, np.append(first[1:], -1), begun)
            state = np.maximum(across, skipped)
            state, first = np.where(state >= _POINT, state, 0), begun
        better(i)
        inserted(i)

    at = 0
    for c, begin, behind in [*_anchors(equal, anchor), (-1, len(template), -1)]:
        for i in range(at, begin):
            if matched[i] or state.any():
                row(i)
        if c < 0:
            break
        length, old = behind - begin, int(state[c])
        start = int(first[c]) if old else begin + low + c
        state, first = np.zeros(width, np.int64), np.full(width, -1)
        state[c] = old + length * (2 * _POINT + _WORD_FOUND) + int(must[begin:behind].sum())
        first[c] = start
        better(behind - 1)
        inserted(behind - 1)
        at = behind
    return best % _POINT // _WORD_FOUND, *span


@dataclass(frozen=True, order=True)
class Match:
    """A notice in a text: words of it found in order, first word and behind the last."""

    first: int
    behind: int
    template: int
    equal: int
    coverage: float


def _groups(starts: np.ndarray, band: int) -> Iterator[tuple[int, int]]:
    """First and last of each group of beginnings, each within ``band`` of the one before, that spans a few bands at most."""
    cuts = np.flatnonzero(np.diff(starts) > band) + 1
    for part in np.split(starts, cuts) if len(cuts) else [starts]:
        begin = 0
        while begin < len(part):
            end = int(np.searchsorted(part, part[begin] + 4 * band, "right"))
            yield int(part[begin]), int(part[end - 1])
            begin = end


def _has(text: np.ndarray, pattern: np.ndarray, needed: np.ndarray, low: int, high: int) -> bool:
    """Whether each of the obligatory words is somewhere in the band."""
    at = needed[:, None] + np.arange(low, high + 1)
    inside = (at >= 0) & (at < len(text))
    return bool(((text[np.where(inside, at, 0)] == pattern[needed][:, None]) & inside).any(axis=1).all()) if len(text) else False


def _matches(words: np.ndarray, index: Index, gram: int, coverage: float, partial: float = PARTIAL) -> list[Match]:
    """The notices in a text, by place. Of those that overlap, the one with the most equal words, then with the larger coverage, is left."""
    begins = defaultdict(list)
    for template, position, at in index.hits(_grams(words, gram)):
        begins[template].append(at - position)
    found = []
    for template, starts in begins.items():
        pattern, needed = index.words[template], index.needed[template]
        least = min(partial, coverage) if len(pattern) >= LONG else coverage
        band = max(2, min(WIDEST_BAND, len(pattern) // 4))
        hits = np.sort(starts)
        for first, last in _groups(np.unique(hits), band):
            near = np.searchsorted(hits, last + band, "right") - np.searchsorted(hits, first - band)
            if near < index.least[template]:
                continue
            low = max(0, first - band)
            text = words[low : last + len(pattern) + band]
            if not _has(text, pattern, needed, first - band - low, last + band - low):
                continue
            equal = _equal(pattern, text, first - band - low, last + band - low)
            matched = equal.any(axis=0)
            if matched.sum() < least * len(pattern):
                continue
            together = np.zeros(len(pattern) + 1, np.int64)
            runs = _runs(equal, min(gram, len(pattern)))
            np.add.at(together, runs[:, 1], 1)
            np.add.at(together, runs[:, 2], -1)
            if (np.cumsum(together) > 0).sum() < least * len(pattern) / 2:
                continue
            count, begin, behind = align(pattern, text, first - band - low, last + band - low, needed, equal=equal)
            if count and count / len(pattern) >= least:
                found.append(Match(low + begin, low + behind, template, count, count / len(pattern)))
    left: list[Match] = []
    for match in sorted(set(found), key=lambda m: (-m.equal, -m.coverage, m.first, m.template)):
        at = bisect(left, match.first, key=lambda m: m.first)  # left is in order and has no overlaps
        if (at == 0 or left[at - 1].behind <= match.first) and (at == len(left) or match.behind <= left[at].first):
            left.insert(at, match)
    return left


def license_notices(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    gram: int = GRAM,
    window: int = WINNOW,
    coverage: float = COVERAGE,
    obligatory: Mapping[str, Sequence[str]] = OBLIGATORY,
    partial: float = PARTIAL,
) -> DataFrame:
    """One row per notice found: doc_id, license, coverage, complete, matched_words, first_word, last_word, begin, end.

    coverage is the share of the template's words that the text has in order; a notice is complete from ``coverage`` on, and of
    a template of 200 words or more a smaller part is reported too, from ``partial`` on. begin and end are the character
    span in the text (end behind the last). Texts are searched whole; words are runs of a-z and digits, case aside. Notices
    do not overlap: the best is reported. The phrases that ``obligatory`` has for a template must be in the text. Null, empty and
    other texts without notices give no rows; repeated rows each give theirs. The templates must be few: every task holds them.
    """
    held = docs.sparkSession.sparkContext.broadcast(Index.of(templates, gram, window, obligatory))
    rows = docs.select("doc_id", full_text().alias("text"))
    schema = extended(
        rows.select("doc_id").schema,
        "license string, coverage double, complete boolean, matched_words bigint, first_word bigint, last_word bigint, begin bigint, end bigint",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            found = []
            for row, text in enumerate(batch.column(1)):
                data = text.as_py().encode().lower()
                notices = _matches(_numbers(data), index, gram, coverage, partial)
                spans = _spans(data, [w for m in notices for w in (m.first, m.behind - 1)])
                passed = begin = 0  # bytes and characters
                for m in notices:
                    first, last = spans[m.first][0], spans[m.behind - 1][1]
                    begin, passed = begin + len(data[passed:first].decode()), first
                    end = begin + len(data[first:last].decode())
                    complete = m.coverage >= coverage
                    found.append((row, index.names[m.template], m.coverage, complete, m.equal, m.first, m.behind - 1, begin, end))
            columns = list(zip(*found)) or [()] * 9
            arrays = [batch.column(0).take(pa.array(columns[0], pa.int64()))]
            arrays += [pa.array(c, f.type) for c, f in zip(columns[1:], _FIELDS)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *[f.name for f in _FIELDS]])

    return rows.mapInArrow(run, schema)


_FIELDS = [pa.field("license", pa.string()), pa.field("coverage", pa.float64()), pa.field("complete", pa.bool_())] + [
    pa.field(n, pa.int64()) for n in ("matched_words", "first_word", "last_word", "begin", "end")
]


def _spans(data: bytes, wanted: list[int]) -> dict[int, tuple[int, int]]:
    """Byte spans of the words with the numbers ``wanted``."""
    if not wanted:
        return {}
    needed, last, spans = set(wanted), max(wanted), {}
    for number, match in enumerate(_WORD.finditer(data)):
        if number in needed:
            spans[number] = match.span()
        if number == last:
            break
    return spans
