"""Mapping free-entered values to a canonical list (problem 2).

The words of a value are first brought to known words (letter variants,
misspellings, abbreviations).  A multi-pattern automaton over the canonical
names and their aliases then finds the names embedded in the value; the longest
non-overlapping matches win and decide.  Aliases are a table of the caller's
(alias, what it stands for); a name of the list with any of its words put in
the alias's words is a pattern of its own, and so is each turned about ("theft,
vehicle" for "vehicle theft").  Aliases act through the automaton only.

Values in which nothing is embedded, and the words around embedded names, go to
token-set similarity with the canonical names; a value of which all stays below
its threshold is reported as unmatched.

The reference list, the aliases and the index are small and checked to be so;
values are matched a batch at a time in Arrow tasks without any shuffle, each
different text once as long as a task remembers it.
"""

from __future__ import annotations

import csv
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.packed import CACHE_BOUND, DICTIONARY_BOUND, Grammar, build_automaton, remembered, split_packed
from daybook.session import bounded_rows

UNMATCHED = "(unmatched)"
#: Least token-set similarity of a match, and weight of a word that carries little meaning.
THRESHOLD = 0.65
LIGHT = 0.35
#: Least likeness of a word left over to the entry's word left over, and to a word of a name before the automaton runs.
LOOSE = 0.45
CONTEXT = 0.55
#: Most patterns of an automaton (names and aliases with their turns), and the table of aliases used where none is given.
PATTERN_BOUND = 2_000_000
ALIAS_FILE = Path(__file__).with_name("aliases.csv")

# Words without much meaning of their own.
LIGHT_WORDS = frozenset("a an and as at by for from in into is of off on or out the to up was with without".split())
# Letters of other alphabets that look like Latin ones.
LOOKALIKES = str.maketrans("авеіјкмнорсстухѕԁһαβεικνορτυχ", "abeijkmhopcctyxsdhabeiknoptux")
_VOWELS = re.compile("[aeiou]")


def plain(text: str) -> str:
    """Lower-case Latin letters and digits with single blanks: width, accents, look-alike letters and marks made plain."""
    text = unicodedata.normalize("NFKD", text).lower().translate(LOOKALIKES)
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"\bw\s*/\s*o\b", "without", text)
    text = re.sub(r"\bw\s*/", "with ", text)
    text = text.replace("'", "").replace("’", "")
    text = " ".join(re.findall(r"[a-z0-9]+", text))
    return text


def skeleton(word: str) -> str:
    """The first letter and the consonants after it."""
    return word[:1] + _VOWELS.sub("", word[1:])


def distance(a: str, b: str, most: int) -> int:
    """Edits (insertions, deletions, changes, swaps of neighbours) between two words, or ``most`` + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if older is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


def allowed_edits(length: int) -> int:
    return 0 if length < 4 else 1 if length < 6 else 2


def _deletions(word: str, most: int) -> set[str]:
    out, layer = {word}, {word}
    for _ in range(most):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out |= layer
    return out


def read_aliases(path: str | Path = ALIAS_FILE) -> list[tuple[str, str]]:
    """(alias, what it stands for) of a CSV table with the columns alias and means."""
    with open(path, encoding="utf-8", newline="") as f:
        return [(r["alias"], r["means"]) for r in csv.DictReader(f)]


def _turns(words: tuple[str, ...]) -> Iterator[tuple[str, ...]]:
    """The words turned about: some of the first ones put behind the others."""
    return (words[k:] + words[:k] for k in range(1, len(words)))


class Matcher:
    """Finds the entries of one reference list in values.

    ``aliases`` are (alias, words it stands for) pairs; without them only the
    names themselves are looked for.
    """

    def __init__(self, entries: list[str], threshold: float = THRESHOLD, aliases: Iterable[tuple[str, str]] = ()):
        self.threshold = threshold
        self.entries = list(dict.fromkeys(entries))
        self.words = [plain(e).split() for e in self.entries]
        self.having: dict[str, list[int]] = defaultdict(list)
        for k, words in enumerate(self.words):
            for w in set(words):
                self.having[w].append(k)
        by_first: dict[str, list[tuple[tuple[str, ...], tuple[str, ...]]]] = defaultdict(list)
        for alias, means in aliases:
            said, meant = tuple(plain(alias).split()), tuple(plain(means).split())
            if said and meant:
                by_first[meant[0]].append((meant, said))
        # Of equal patterns a name goes before an alias and an alias before a turn.
        patterns: dict[str, tuple[int, list[int]]] = {}
        self.said: dict[str, set[int]] = defaultdict(set)
        self.ways: list[set[str]] = [set() for _ in self.words]
        for k, words in enumerate(self.words):
            for variant in self._variants(tuple(words), by_first):
                self.ways[k].update(variant)
                for w in variant:
                    self.said[w].add(k)
                self._pattern(patterns, variant, k, 0 if list(variant) == words else 1)
                for turned in _turns(variant):
                    self._pattern(patterns, turned, k, 2)
            if len(patterns) > PATTERN_BOUND:
                raise ValueError(f"names and aliases make more than {PATTERN_BOUND} patterns")
        self.known = sorted(self.said)
        self.is_known = frozenset(self.said)
        self.by_skeleton: dict[str, set[str]] = defaultdict(set)
        self.by_deletion: dict[str, set[str]] = defaultdict(set)
        for w in self.known:
            if len(w) > 3:
                self.by_skeleton[skeleton(w)].add(w)
                for d in _deletions(w, allowed_edits(len(w) + 1)):
                    self.by_deletion[d].add(w)
        self.automaton = ahocorasick.Automaton()
        for text, (_, ks) in patterns.items():
            self.automaton.add_word(f" {text} ", (len(text) + 1, ks))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.resolve = lru_cache(200_000)(self._resolve)

    @staticmethod
    def _variants(words: tuple[str, ...], by_first: dict) -> Iterator[tuple[str, ...]]:
        """The words with any of them put in words of an alias that stands for them."""
        if not words:
            return
        heads = [(words[:1], 1)] + [(said, len(meant)) for meant, said in by_first.get(words[0], ()) if words[: len(meant)] == meant]
        for head, n in heads:
            if n == len(words):
                yield head
            else:
                for tail in Matcher._variants(words[n:], by_first):
                    yield head + tail

    @staticmethod
    def _pattern(patterns: dict, words: tuple[str, ...], k: int, rank: int) -> None:
        text = " ".join(words)
        held = patterns.get(text)
        if held is None or rank < held[0]:
            patterns[text] = (rank, [k])
        elif rank == held[0] and k not in held[1]:
            held[1].append(k)

    def _resolve(self, token: str) -> tuple[tuple[str, float], ...]:
        """Known words that ``token`` may be, with how sure that is, surest first."""
        if token in self.is_known:
            return ((token, 1.0),)
        if token.isdigit():
            return ()
        if re.search("[01]", token):
            token = token.replace("0", "o").replace("1", "i")
            if token in self.is_known:
                return ((token, 1.0),)
        if token in LIGHT_WORDS:
            return ()
        found: dict[str, float] = {}

        def note(word: str, sure: float) -> None:
            found[word] = max(found.get(word, 0.0), sure)

        for singular in (token[:-1] if token.endswith("s") else "", token[:-3] + "y" if token.endswith("ies") else ""):
            if singular in self.is_known:
                note(singular, 1.0)
        if not found and len(token) > 2:
            for bare in (token, token[:-1] if token.endswith("s") else ""):
                if bare and bare == skeleton(bare):
                    for w in self.by_skeleton.get(bare, ()):
                        note(w, 0.95)
            at = bisect_left(self.known, token)
            while at < len(self.known) and self.known[at].startswith(token):
                if len(self.known[at]) >= len(token) + 2:
                    note(self.known[at], 0.93)
                at += 1
        if not found:
            most = allowed_edits(len(token))
            near = set().union(*(self.by_deletion.get(d, ()) for d in _deletions(token, most))) if most else set()
            for w in near:
                d = distance(token, w, min(most, allowed_edits(len(w) + 1)))
                if d <= most:
                    note(w, 1 - 0.8 * d / max(len(token), len(w)))
            if len(token) > 3 and token == skeleton(token) and not found:
                for s, ws in self.by_skeleton.items():
                    if abs(len(s) - len(token)) < 2 and len(s) > 4 and distance(token, s, 1) == 1:
                        for w in ws:
                            note(w, 0.75)
        return tuple(sorted(found.items(), key=lambda x: (-x[1], x[0])))

    def _tokens(self, value: str) -> list[tuple[str, tuple]]:
        """(token, what it may be); tokens that run together are taken apart."""
        out = []
        for token in plain(value).split():
            means = self.resolve(token)
            if (not means or means[0][1] < 0.9) and len(token) > 4 and token not in LIGHT_WORDS:
                parts = self._apart(token)
                if parts and min(p[1][0][1] if p[1] else 1.0 for p in parts) >= (means[0][1] if means else 0.7):
                    out += parts
                    continue
            out.append((token, means))
        return out

    def _apart(self, token: str) -> list[tuple[str, tuple]]:
        """Two words that ``token`` was run together from; one of them has to be known as written or both by their consonants."""
        best: tuple[float, list] = (0.0, [])
        for k in range(2, len(token) - 1):
            parts = (token[:k], token[k:])
            written = [t in self.is_known or t in LIGHT_WORDS for t in parts]
            anchor = all(written) or any(w and len(t) > (3 if t in LIGHT_WORDS else 2) for w, t in zip(written, parts, strict=True))
            if not anchor and not all(w or len(t) > 2 and t == skeleton(t) for w, t in zip(written, parts, strict=True)):
                continue
            pair = [(t, self.resolve(t)) for t in parts]
            sure = [means[0][1] if means else 1.0 if t in LIGHT_WORDS else 0.0 for t, means in pair]
            bones = max(map(len, parts)) > 3 and all(w or x >= 0.95 for w, x in zip(written, sure, strict=True))
            if min(sure) > best[0] and (anchor or bones):
                best = (min(sure), pair)
        return best[1]

    def match(self, value: str) -> list[str]:
        """The entries meant by ``value``: those embedded in it and meant by its other words, else the most similar one; empty where none is meant."""
        tokens = self._tokens(value)
        if not tokens:
            return []
        taken = self._embedded(tokens)
        if taken:
            return self._with_rest(tokens, taken)
        best = self._most_similar(tokens)
        return [self.entries[best[0]]] if best and best[1] >= self.threshold else []

    def _likely_words(self, tokens: list[tuple[str, tuple]]) -> list[str]:
        """The word each token most likely is: of several, and of words that are no near misspelling, one of a name with another word of the value."""
        sure: dict[int, int] = defaultdict(int)
        entries_of = [{k for m, _ in means if m not in LIGHT_WORDS for k in self.said[m]} for _, means in tokens]
        for ks in entries_of:
            for k in ks:
                sure[k] += 1
        words = []
        for (token, means), own in zip(tokens, entries_of, strict=True):
            if len(means) > 1:
                token = max(means, key=lambda m: (m[1] + (0.1 if any(sure[k] > 1 for k in self.said[m[0]] & own) else 0.0), m[1]))[0]
            elif means:
                token = means[0][0]
            elif len(token) > 3 and not token.isdigit() and sure:
                near = max(((self._likeness(token, w), w) for w in sorted(set().union(*(self.ways[k] for k in sure))) if len(w) > 3), default=(0.0, ""))
                token = near[1] if near[0] >= CONTEXT else token
            words.append(token)
        return words

    def _embedded(self, tokens: list[tuple[str, tuple]]) -> list[tuple[int, int, list[int]]]:
        """(first token, tokens, entries) of the names and aliases in a value: the longest ones that don't overlap, in order."""
        if not len(self.automaton):
            return []
        words = self._likely_words(tokens)
        line, starts = " " + " ".join(words) + " ", {}
        at = 0
        for n, w in enumerate(words):
            starts[at] = n
            at += len(w) + 1
        hits = sorted(((end - length, length, ks) for end, (length, ks) in self.automaton.iter(line)), key=lambda h: (-h[1], h[0]))
        taken: list[tuple[int, int, list[int]]] = []
        free = bytearray(b"\x01") * len(words)
        for start, length, ks in hits:
            first, n = starts[start], line.count(" ", start + 1, start + length) + 1
            if all(free[first : first + n]):
                free[first : first + n] = bytes(n)
                taken.append((first, n, ks))
        return sorted(taken)

    def _with_rest(self, tokens: list[tuple[str, tuple]], taken: list[tuple[int, int, list[int]]]) -> list[str]:
        """The embedded entries and those that the words before, between and behind them mean.

        Words left over mean an entry only with two of its words (or all), as
        one word is a coincidence.
        """
        found: list[int] = []
        at = 0
        for first, n, ks in [*taken, (len(tokens), 0, [])]:
            rest = self._most_similar(tokens[at:first])
            if rest and rest[1] >= self.threshold:
                words = set(self.words[rest[0]])
                if len({m for _, means in tokens[at:first] for m, _ in means} & words) >= min(2, len(words)):
                    found.append(rest[0])
            found += ks
            at = first + n
        return [self.entries[k] for k in dict.fromkeys(found)]

    def _most_similar(self, tokens: list[tuple[str, tuple]]) -> tuple[int, float] | None:
        tokens = list(dict.fromkeys(tokens))
        candidates = {k for _, means in tokens for m, _ in means for k in self.having.get(m, ()) if m not in LIGHT_WORDS}
        scored = [(self._similarity(tokens, k), -len(self.words[k]), -k) for k in candidates]
        if not scored:
            return None
        score, _, k = max(scored)
        return -k, score

    def _similarity(self, tokens: list[tuple[str, tuple]], k: int) -> float:
        """Weighted Dice similarity of the value's words and the entry's words as sets.

        A word that stands for none of the list is compared loosely with the
        entry's words that are still open.
        """
        open_words = dict.fromkeys(self.words[k])
        whole = sum(_weight(w) for w in open_words)
        hit = total = 0.0
        used: set[str] = set()
        strange = []
        for token, means in tokens:
            w = max((m for m in means if m[0] in open_words), key=lambda m: m[1], default=None)
            if w:
                used.add(w[0])
                del open_words[w[0]]
                hit += _weight(w[0]) * w[1]
                total += _weight(w[0])
            elif not any(m[0] in used for m in means):
                if len(token) > 3 and (not means or means[0][1] < 0.9):
                    strange.append(token)
                else:
                    total += _weight(token)
        for token in strange:
            near = max(((self._likeness(token, w), w) for w in open_words if len(w) > 3), default=(0.0, ""))
            if near[0] >= LOOSE:
                del open_words[near[1]]
                hit += _weight(near[1]) * near[0]
                total += _weight(near[1])
            else:
                total += _weight(token)
        return 2 * hit / (total + whole)

    @staticmethod
    def _likeness(a: str, b: str) -> float:
        most = max(len(a), len(b)) // 2
        return 1 - distance(a, b, most) / max(len(a), len(b))


def _weight(word: str) -> float:
    return LIGHT if word in LIGHT_WORDS else 0.5 if len(word) < 3 or word.isdigit() else 1.0


_ROWS = pa.schema([("record", pa.int64()), ("field_name", pa.string()), ("value", pa.string()), ("raw_token", pa.string())])


def map_values(records: DataFrame, grammars: dict[str, Grammar], lists: dict[str, DataFrame], record_id: str = "row_id", threshold: float = THRESHOLD, aliases: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """record, field_name, value and raw_token: a row for each entry meant by each value of the fields.

    ``lists`` gives the reference list of each field (its first column);
    ``aliases`` are (alias, words it stands for) pairs, those of
    :data:`ALIAS_FILE` where not given.
    Values that mean no entry have the raw_token ``(unmatched)``.  Null, empty
    and blank fields hold no value and give no row; repeated values and rows
    are each mapped; an empty reference list leaves every value unmatched.
    """
    aliases = read_aliases() if aliases is None else list(aliases)
    entries = {f: [r[0] for r in bounded_rows(d, DICTIONARY_BOUND, f"the reference list of {f}") if r[0] is not None] for f, d in lists.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = {}
        for field, grammar in grammars.items():
            automaton, matcher = build_automaton(entries.get(field, [])), Matcher(entries.get(field, []), threshold, aliases)
            tools[field] = (remembered(lambda t, g=grammar, a=automaton: split_packed(t, g, a)), remembered(matcher.match, 4 * CACHE_BOUND))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for n, (field, (split, match)) in enumerate(tools.items(), 1):
                for record, text in zip(ids, batch.column(n).to_pylist(), strict=True):
                    for value in split(text) if text else ():
                        out.extend((record, field, value, token) for token in match(value) or (UNMATCHED,))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS)

    picked = records.select(F.col(record_id).cast("bigint").alias("record"), *[F.col(f).cast("string").alias(f"field_{k}") for k, f in enumerate(grammars)])
    return picked.mapInArrow(run, "record bigint, field_name string, value string, raw_token string")


def meant_entries(mapped: DataFrame) -> DataFrame:
    """record, field_name and each distinct raw_token meant by the field, ``(unmatched)`` among them."""
    return mapped.select("record", "field_name", "raw_token").distinct()
