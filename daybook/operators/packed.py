"""Several values packed in one field (problem 5).

Dictionary-guided segmentation: a multi-pattern automaton finds the whole
values of a reference list inside the text, and dynamic programming picks the
cover by segments that is worth most.  Cuts are proposed at every delimiter.
One of the field's own delimiters separates unless it stands inside a known
value and cutting there explains less of the text; a soft one (a comma, a
colon, a hyphen, a slash or "and" in prose) belongs to the value unless all
that it joins are known values and the whole is none.  Quoted values, list
marks and JSON lists are recognised before.

The work is done a batch of distinct texts at a time inside Arrow tasks; it
needs no shuffle, so a hot key or a repeated text plays no part.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import bounded_rows

#: Worth of a whole value of the dictionary, and of a cut at a delimiter.
KNOWN_WORTH = 4.0
CUT_WORTH = 1.0
#: Most reference entries that are sent to every task, and most texts a task remembers.
DICTIONARY_BOUND = 200_000
CACHE_BOUND = 50_000


@dataclass(frozen=True)
class Grammar:
    """How the values of a field are separated: always, and where a dictionary speaks for it (with the blanks around)."""

    delimiter: str
    bullets: bool
    name: str
    soft: str = ""


#: Prose: commas, colons, hyphens, "and" and slashes without a blank before them belong to the value.
PROSE = Grammar(r"[;；|\r\n]|(?<=\s)/|(?<=\s)[•·](?=\s)", True, "prose", r"\s*[,:&+/–-]\s*|\s+and\s+")
#: Reference numbers: hyphens and blanks belong to the value.
NUMBERS = Grammar(r"[,/;；|\r\n&+]|(?<=[\s\"”])and(?=[\s\"“])", False, "numbers")

_QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»"}
_CLOSING = frozenset(_QUOTES.values())
_BLANKS = re.compile(r"\s*")
_BULLET = re.compile(r"[•·*‣▪–-]\s+")
_ENUMERATED = re.compile(r"\(?(\d{1,3})[.)]\s+")
_INLINE = re.compile(r"(?:(?<=^)|(?<=\s))(?:\((\d{1,3})\)|(\d{1,3})[.)])\s+")


def build_automaton(values: Iterable[str]) -> ahocorasick.Automaton | None:
    """Automaton over whole values, letter case apart; None where there are none."""
    out = ahocorasick.Automaton()
    for value in values:
        folded = fold(value).strip()
        if folded:
            out.add_word(folded, len(folded))
    if not len(out):
        return None
    out.make_automaton()
    return out


def fold(text: str) -> str:
    """Lower case of the same length, so that positions stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def known_spans(text: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, int]]:
    """Places where a whole value of the dictionary stands between word borders."""
    if automaton is None:
        return []
    spans, folded = [], fold(text)
    for end, length in automaton.iter(folded):
        start, stop = end + 1 - length, end + 1
        if (start == 0 or not folded[start - 1].isalnum()) and (stop == len(folded) or not folded[stop].isalnum()):
            spans.append((start, stop))
    return spans


def _closers(text: str, close: str, marks: re.Pattern, bullets: bool) -> tuple[list[int], dict[int, tuple[int, bool]]]:
    """(places of quotes that can end a value, run of quotes by its start: (length, followed by a delimiter)).

    A quote ends a value before a delimiter or the end of the text; doubled
    straight quotes are an escape, so only a run of odd length ends one.
    """
    ends, runs = [], {}
    for m in re.finditer(re.escape(close) + ("+" if close == '"' else ""), text):
        after = _BLANKS.match(text, m.end()).end()
        followed = after == len(text) or bool(marks.match(text, m.end()) or marks.match(text, after) or (bullets and _INLINE.match(text, after)))
        runs[m.start()] = (m.end() - m.start(), followed)
        if followed and (m.end() - m.start()) % 2:
            ends.append(m.end() - 1)
    return ends, runs


def _quoted_spans(text: str, marks: re.Pattern, bullets: bool) -> list[tuple[int, int]]:
    """Spans of quoted values: a quote opens where a value begins and closes before a delimiter or the end."""
    if not any(q in text for q in _QUOTES):
        return []
    begins = [0, *(m.end() for m in marks.finditer(text))]
    if bullets:
        begins = sorted({*begins, *(m.end() for m in _INLINE.finditer(text))})
    closers: dict[str, tuple[list[int], dict[int, tuple[int, bool]]]] = {}
    spans, done = [], 0
    for at in begins:
        if at < done:
            continue
        start = _BLANKS.match(text, at).end()
        mark = bullets and (_BULLET.match(text, start) or _ENUMERATED.match(text, start))
        start = mark.end() if mark else start
        close = _QUOTES.get(text[start : start + 1])
        if not close:
            continue
        ends, runs = closers.setdefault(close, _closers(text, close, marks, bullets)) if close not in closers else closers[close]
        length, followed = runs.get(start, (1, False)) if close == text[start] else (1, False)
        if followed and length > 1 and length % 2 == 0:  # the quote opens a run whose rest closes it
            stop = start + length
        else:
            k = bisect_right(ends, start + length - 1)
            if k == len(ends):
                continue
            stop = ends[k] + 1
        spans.append((start, stop))
        done = stop
    return spans


def _undo(token: str, bullets: bool) -> str:
    """A segment without surrounding blanks, list marks and enclosing quotes, escapes undone."""
    token = token.strip()
    if bullets:
        mark = _BULLET.match(token) or _ENUMERATED.match(token)
        if mark:
            token = token[mark.end() :].strip()
        elif token in {"•", "·", "*", "-", "–"}:
            return ""
    if len(token) > 1 and _QUOTES.get(token[0]) == token[-1]:
        inner = token[1:-1]
        if token[0] != '"':
            return inner.strip()
        if '"' not in inner.replace('""', ""):
            return inner.replace('""', '"').strip()
    return token


def split_packed(text: str | None, grammar: Grammar = PROSE, automaton: ahocorasick.Automaton | None = None, known_worth: float = KNOWN_WORTH) -> list[str]:
    """The values of one field in order; empty values are left out, null and blank text have none."""
    if not text or not text.strip():
        return []
    bare = text.strip()
    if bare[0] == "[" and bare[-1] == "]":
        try:
            items = json.loads(bare)
            return [x for x in (("" if i is None else i if isinstance(i, str) else json.dumps(i)).strip() for i in items) if x]
        except ValueError:
            pass
    marks = _compiled(grammar)
    cuts = [m.span() for m in marks.finditer(text)]
    if grammar.bullets:
        nth, inline = 1, []
        for m in _INLINE.finditer(text):
            if int(m[1] or m[2]) == nth and (nth > 1 or not text[: m.start()].strip()):
                inline.append((m.start(), m.end()))
                nth += 1
        if len(inline) > 1:
            cuts = sorted(set(cuts) | set(inline))
    if not cuts:
        token = _undo(text, grammar.bullets)
        return _known_parts(token, bare, grammar, automaton) if token else []
    quoted = _quoted_spans(text, marks, grammar.bullets)
    if quoted:
        starts = [a for a, _ in quoted]
        cuts = [c for c in cuts if not ((k := bisect_right(starts, c[0])) and c[0] < quoted[k - 1][1])]
    cuts = _best_cover(text, cuts, known_spans(text, automaton), known_worth)
    out, at = [], 0
    for start, stop in [*cuts, (len(text), len(text))]:
        if start >= at:
            token = _undo(text[at:start], grammar.bullets)
            if token:
                out += _known_parts(token, text[at:start].strip(), grammar, automaton)
            at = stop
    return out


def _known_parts(token: str, written: str, grammar: Grammar, automaton: ahocorasick.Automaton | None) -> list[str]:
    """A value taken apart at soft delimiters where it is wholly made of known values, into the fewest of them; else itself.

    A known value stays whole, and so does a quoted one.
    """
    if not grammar.soft or automaton is None or written[-1:] in _CLOSING:
        return [token]
    soft = _compiled_soft(grammar)
    if not soft.search(token) or fold(token) in automaton:
        return [token]
    # pieces[p]: (known values before place p, start of the last one, its end).
    pieces: dict[int, tuple[int, int, int]] = {0: (0, -1, 0)}
    for start, stop in sorted(known_spans(token, automaton)):
        if start not in pieces:
            continue
        joint = soft.match(token, stop)
        after = len(token) + 1 if stop == len(token) else joint.end() if joint else -1
        n = pieces[start][0] + 1
        if after >= 0 and (after not in pieces or n < pieces[after][0]):
            pieces[after] = (n, start, stop)
    at, out = len(token) + 1, []
    if at not in pieces:
        return [token]
    while at > 0:
        _, start, stop = pieces[at]
        out.append(token[start:stop])
        at = start
    return out[::-1]


_PATTERNS: dict[str, re.Pattern] = {}


def _compiled_soft(grammar: Grammar) -> re.Pattern:
    name = f"{grammar.name}, soft"
    if name not in _PATTERNS:
        _PATTERNS[name] = re.compile(grammar.soft, re.IGNORECASE)
    return _PATTERNS[name]


def _compiled(grammar: Grammar) -> re.Pattern:
    if grammar.name not in _PATTERNS:
        _PATTERNS[grammar.name] = re.compile(grammar.delimiter, re.IGNORECASE)
    return _PATTERNS[grammar.name]


def _best_cover(text: str, cuts: list[tuple[int, int]], known: list[tuple[int, int]], known_worth: float) -> list[tuple[int, int]]:
    """The cuts of the cover worth most: a cut counts CUT_WORTH, a known value that stays whole ``known_worth``.

    Only a known value with a delimiter inside can lose by a cut.  Cuts outside
    of such values are always made; values that overlap form a cluster, and the
    dynamic programme runs over the cuts within each cluster.
    """
    starts = [s for s, _ in cuts]
    over = sorted((a, b) for a, b in known if (k := bisect_right(starts, a)) < len(cuts) and cuts[k][1] < b)
    if not over:
        return cuts
    clusters: list[tuple[int, int, list[tuple[int, int]]]] = []
    for a, b in over:
        if clusters and a < clusters[-1][1]:
            first, last, members = clusters[-1]
            clusters[-1] = (first, max(last, b), [*members, (a, b)])
        else:
            clusters.append((a, b, [(a, b)]))
    made, at = [], 0
    for first, last, members in clusters:
        low, high = bisect_right(starts, first), bisect_right(starts, last - 1)
        made += cuts[at:low]
        made += _cover_cluster(cuts[low:high], members, first, last, known_worth)
        at = high
    return made + cuts[at:]


def _cover_cluster(cuts: list[tuple[int, int]], over: list[tuple[int, int]], first: int, last: int, known_worth: float) -> list[tuple[int, int]]:
    points = [(first, first), *cuts, (last, last)]
    best, come = [0.0] * len(points), [0] * len(points)
    for k in range(1, len(points)):
        score, arg = None, 0
        for j in range(k):
            lo, hi = points[j][1], points[k][0]
            worth = best[j] + (CUT_WORTH if k < len(points) - 1 else 0.0) + known_worth * sum(lo <= a and b <= hi for a, b in over)
            if score is None or worth > score:
                score, arg = worth, j
        best[k], come[k] = score, arg
    made, k = [], come[-1]
    while k > 0:
        made.append(points[k])
        k = come[k]
    return made[::-1]


def remembered(split: Callable[[str], list], bound: int = CACHE_BOUND) -> Callable[[str], list]:
    """``split`` with its last results kept, as the same texts come again and again."""
    kept: dict[str, list] = {}

    def of(text: str) -> list:
        out = kept.get(text)
        if out is None:
            out = split(text)
            if len(kept) >= bound:
                kept.clear()
            if len(text) < 2_000:
                kept[text] = out
        return out

    return of


_ROWS = pa.schema([("record", pa.int64()), ("field_name", pa.string()), ("pos", pa.int32()), ("token", pa.string())])


def unpack_fields(records: DataFrame, grammars: dict[str, Grammar], dictionaries: dict[str, DataFrame], record_id: str = "row_id", least: int = 2) -> DataFrame:
    """One row a value: record, field_name, pos (from 1) and token, of fields with ``least`` values or more.

    ``dictionaries`` gives the reference list of a field (its first column);
    its size is checked.  Null, empty and blank fields have no values; repeated
    values and repeated rows each keep their place; texts are read whole.
    """
    words = {f: [r[0] for r in bounded_rows(d, DICTIONARY_BOUND, f"the dictionary of {f}") if r[0]] for f, d in dictionaries.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = {}
        for field, grammar in grammars.items():
            automaton = build_automaton(words.get(field, []))
            splits[field] = remembered(lambda text, g=grammar, a=automaton: split_packed(text, g, a))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for n, (field, split) in enumerate(splits.items(), 1):
                for record, text in zip(ids, batch.column(n).to_pylist(), strict=True):
                    tokens = split(text) if text else []
                    if len(tokens) >= least:
                        out.extend((record, field, k, token) for k, token in enumerate(tokens, 1))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS)

    picked = records.select(F.col(record_id).cast("bigint").alias("record"), *[F.col(f).cast("string").alias(f"field_{k}") for k, f in enumerate(grammars)])
    return picked.mapInArrow(run, "record bigint, field_name string, pos int, token string")
