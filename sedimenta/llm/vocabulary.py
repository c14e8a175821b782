"""Free-entered values mapped to the entries of a reference list.

A symmetric-delete dictionary of the list's terms finds all within a bounded
edit distance by looking up the value's own deletions. Candidates are ranked by
a weighted Damerau-Levenshtein distance, then by how often the term is written
without a slip in the data. Values that are more than a term (qualifiers,
inverted order) are corrected word by word and searched for the longest term
they contain. What no term fits is reported as unmatched.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import product
from math import prod

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.edits import typing_distance
from sedimenta.llm.lexicon import SAME, STOP
from sedimenta.llm.names import plain

UNMATCHED = "unmatched"
#: The list is broadcast; a longer one is refused.
MAX_ENTRIES = 20_000
#: Values with more readings are read once, with all meanings of their words.
MAX_READINGS = 4_096
_ONE = {word: first for first, words in SAME.items() for word in words.split()}
_BRITISH = [(r"aem(?=i|o)", "em"), (r"oed", "ed"), (r"umour", "umor"), (r"isation\b", "ization"), (r"ised\b", "ized"), (r"labell", "label"), (r"paed", "ped"), (r"thalass?aemia", "thalassemia"), (r"programme", "program")]
_NOISE = re.compile(r"\[[^\]]*\]|\(\s*(?:ongoing|updated|new|eu|us|jp|[a-z]{2}(?:\s*,\s*[a-z]{2})+)\s*\)|,?\s*see (?:foot)?note(?:\s*\d+)?\s*$|\s+-\s+(?:ongoing|updated|new)\s*$")
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4"}
_PHASE = re.compile(r"\b(?:phase|p) (\d)(?: ?[abc])?\b(?: (?:phase|p))?(?: (\d)(?: ?[abc])?\b)?")


def limit_for(length: int) -> float:
    return 0.0 if length < 5 else 1.0 if length < 8 else 2.0


def deletions(text: str, depth: int) -> set[str]:
    found = {text}
    layer = {text}
    for _ in range(depth):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        found |= layer
    return found


def words(value: str, vocab: str) -> list[tuple[str, bool]]:
    """Words of a cleaned value with whether each was cut off by a full stop."""
    text = plain(value.replace("β", "beta ").replace("Β", "beta ").replace("’", "'").replace("—", " "))
    text = _NOISE.sub(" ", text)
    for pattern, to in _BRITISH:
        text = re.sub(pattern, to, text)
    text = re.sub(r"(?<=[a-z])'s\b", "", text.replace("+", " "))
    if vocab == "phase":
        text = re.sub(r"(?<=[a-z])(?=\d)", " ", text)
        text = re.sub(r"\b(i{1,3}|iv)(?=[abc]\b)", lambda m: _ROMAN[m[1]], text)
    found = re.findall(r"([a-z0-9]+)(\.?)", text)
    return [(_ONE.get(w, w), bool(dot)) for w, dot in found]


def designators(tokens: list[str]) -> list[str]:
    """Words that tell entries apart by a character; no slip may touch them."""
    return sorted(t for t in tokens if len(t) <= 2 or any(c.isdigit() for c in t))


class Terms:
    """The dictionary of one list; ``entries`` are (code, label, aliases), ``phrases`` wordings of labels the caller knows.

    The initials of a label of three words or more are an alias of it, unless
    two labels share them.
    """

    def __init__(self, vocab: str, entries: list[tuple[str, str, list[str]]], frequency: dict[str, int] | None = None, phrases: dict[str, str] | None = None) -> None:
        self.vocab = vocab
        self.codes: dict[str, str] = {}
        self.bags: dict[frozenset, str] = {}
        self.phases: dict[tuple[str, ...], str] = {}
        self.frequency = frequency or {}
        initials: dict[str, set[str]] = defaultdict(set)
        for _, label, _ in entries:
            letters = "".join(w[0] for w in re.findall(r"[a-z0-9]+", re.sub(r"'s\b", "", plain(label))) if w not in STOP)
            initials[letters].add(label)
        own = {label: letters for letters, labels in initials.items() for label in labels if len(letters) >= 3 and len(labels) == 1}
        for code, label, aliases in entries:
            said = [label, *aliases, code.replace("_", " "), *(phrases or {}).get(label, "").split(";"), own.get(label, "")]
            for phrase in said:
                tokens = self._tokens(phrase)
                if not tokens:
                    continue
                if vocab == "phase" and (m := _PHASE.search(" ".join(tokens))):
                    self.phases.setdefault(tuple(sorted({x for x in m.groups() if x})), code)
                self.codes.setdefault(" ".join(tokens), code)
                self.bags.setdefault(frozenset(t for t in tokens if t not in STOP) or frozenset(tokens), code)
        among: dict[str, int] = defaultdict(int)
        for bag in self.bags:
            for w in bag:
                among[w] += 1
        #: Terms of several words by their rarest word, so that a value meets few of them.
        self.by_rarest: dict[str, list[tuple[frozenset, str]]] = defaultdict(list)
        for bag, code in self.bags.items():
            if len(bag) > 1:
                self.by_rarest[min(bag, key=lambda w: (among[w], w))].append((bag, code))
        self.by_deletion: dict[str, list[str]] = defaultdict(list)
        for term in self.codes:
            for d in deletions(term, int(limit_for(len(term)))):
                self.by_deletion[d].append(term)
        self.vocabulary = {t for term in self.codes for t in term.split()} | ({"phase"} if vocab == "phase" else set())
        self.vocabulary |= {word for word, first in _ONE.items() if first in self.vocabulary}
        #: The words of each term, by word: what else a value must have for the word to matter.
        self.having: dict[str, set[frozenset]] = defaultdict(set)
        for term in [*map(str.split, self.codes), *self.bags]:
            for w in term:
                self.having[w].add(frozenset(term))
        self.word_deletion: dict[str, list[str]] = defaultdict(list)
        for w in self.vocabulary:
            for d in deletions(w, int(min(1.0, limit_for(len(w))))):
                self.word_deletion[d].append(w)

    def _tokens(self, phrase: str) -> list[str]:
        return [w for w, _ in words(phrase, self.vocab)]

    def exact(self, value: str) -> str | None:
        term = " ".join(self._tokens(value))
        return term if term in self.codes else None

    def _near(self, text: str, index: dict[str, list[str]], most: float) -> list[tuple[float, int, str]]:
        limit = min(most, limit_for(len(text) + 2))
        if not limit:
            return []
        met = {c for d in deletions(text, int(limit)) for c in index.get(d, ())}
        marks = designators(text.split())
        ranked = []
        for c in met:
            if designators(c.split()) == marks and (d := typing_distance(text, c, limit)) <= min(limit, limit_for(max(len(c), len(text)))):
                ranked.append((d, -self.frequency.get(c, 0), c))
        return sorted(ranked)

    def _options(self, tokens: list[tuple[str, bool]]) -> list[list[str]]:
        """Per word what it may stand for: itself, all words equally near, or all that begin with it before a full stop."""
        found = []
        for w, dotted in tokens:
            options = [w]
            if w not in self.vocabulary and len(w) >= 4 and (near := self._near(w, self.word_deletion, 1.0)):
                options = [c for d, _, c in near if d == near[0][0]]
            elif dotted and w not in self.vocabulary and len(w) >= 3:
                options = sorted(v for v in self.vocabulary if v.startswith(w)) or [w]
            found.append(list(dict.fromkeys(_ONE.get(o, o) for o in options)))
        return found

    def _corrected(self, tokens: list[tuple[str, bool]]) -> Iterator[list[str]]:
        """The readings of the value with its words corrected, as many as the words that are open have meanings.

        A word in no term with what stands beside it changes no reading's term, so
        of several such meanings one is enough.
        """
        options = self._options(tokens)
        around = [{o for other in options[:i] + options[i + 1 :] for o in other} for i in range(len(options))]
        kept = []
        for words_, beside in zip(options, around, strict=True):
            useful = [o for o in words_ if any(t <= beside | {o} for t in self.having.get(o, ()))]
            kept.append(useful + [o for o in words_ if o not in useful][:1] if len(words_) > 1 else words_)
        if prod(map(len, kept)) > MAX_READINGS:  # all meanings side by side; terms are then found in any order
            kept = [[o] for words_ in kept for o in words_]
        return (list(reading) for reading in product(*kept))

    def code(self, value: str) -> str:
        """The code ``value`` means, or UNMATCHED."""
        tokens = words(value, self.vocab)
        text = " ".join(w for w, _ in tokens)
        if text in self.codes:
            return self.codes[text]
        if (near := self._near(text, self.by_deletion, 2.0)) and (len(near) == 1 or near[0][:2] < near[1][:2] or self.codes[near[0][2]] == self.codes[near[1][2]]):
            return self.codes[near[0][2]]
        read = {r for fixed in self._corrected(tokens) if (r := self._read(fixed))[1] != UNMATCHED}
        most = max((size for size, _ in read), default=0)
        found = {code for size, code in read if size == most}  # of the readings, those with the term of most words
        return found.pop() if len(found) == 1 else UNMATCHED

    def _read(self, tokens: list[str]) -> tuple[int, str]:
        """Words and code of the term a reading has."""
        if self.vocab == "phase" and (m := _PHASE.search(" ".join(tokens))):
            return 1, self.phases.get(tuple(sorted({x for x in m.groups() if x})), UNMATCHED)
        return self._contained(tokens)

    def _contained(self, tokens: list[str]) -> tuple[int, str]:
        """Words and code of the longest term in ``tokens``: most words, words in place before words in any order, most letters."""
        ranked: list[tuple[tuple[int, int, int], str]] = []
        n = len(tokens)
        for i in range(n):
            for j in range(i + 1, n + 1):
                if (term := " ".join(tokens[i:j])) in self.codes:
                    size = len({t for t in tokens[i:j] if t not in STOP}) or 1
                    ranked.append(((size, 1, len(term)), self.codes[term]))
        bag = {t for t in tokens if t not in STOP}
        ranked += [((len(t), 0, sum(map(len, t))), code) for w in bag for t, code in self.by_rarest.get(w, ()) if t <= bag]
        best = max((rank for rank, _ in ranked), default=(0, 0, 0))
        found = {code for rank, code in ranked if rank == best}
        return best[0], found.pop() if len(found) == 1 else UNMATCHED


def read_entries(vocabulary: DataFrame) -> dict[str, list[tuple[str, str, list[str]]]]:
    """The reference list on the driver; its size is checked against MAX_ENTRIES."""
    rows = vocabulary.select("vocab", "code", "label", "aliases").where(F.col("code").isNotNull()).distinct().limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"a reference list of over {MAX_ENTRIES} entries is too long to broadcast")
    out: dict[str, list[tuple[str, str, list[str]]]] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["vocab"], r["code"])):
        out[r["vocab"]].append((r["code"], r["label"] or "", [a for a in r["aliases"] or [] if a]))
    return dict(out)


def verbatims(expected: DataFrame) -> DataFrame:
    """expected_id, phases, indications, modality of every row; nothing else is read."""
    return expected.where(F.col("expected_id").isNotNull()).select(
        F.col("expected_id").cast("long").alias("expected_id"),
        F.col("programs.phase_verbatim").alias("phase"),
        F.col("programs.indication_verbatim").alias("indication"),
        F.array("modality_verbatim").alias("modality"),
    )


_FIELDS = ("phase", "indication", "modality")


Phrases = dict[str, dict[str, str]]


def _clean_counts(entries: dict, phrases: Phrases) -> object:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = {f: Terms(f, entries.get(f, []), None, phrases.get(f)) for f in _FIELDS}
        seen: dict[tuple[str, str], int] = defaultdict(int)
        known: dict[tuple[str, str], str | None] = {}
        for batch in batches:
            for f in _FIELDS:
                for values in batch[f]:
                    for v in values if values is not None else []:
                        if v is None:
                            continue
                        if (f, v) not in known:
                            if len(known) > 200_000:
                                known.clear()
                            known[f, v] = terms[f].exact(v)
                        if known[f, v] is not None:
                            seen[f, known[f, v]] += 1
        yield pd.DataFrame([(f, t, n) for (f, t), n in seen.items()], columns=["field", "term", "n"])

    return count


def _assigned(entries: dict, frequency: dict[str, dict[str, int]], phrases: Phrases) -> object:
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = {f: Terms(f, entries.get(f, []), frequency.get(f), phrases.get(f)) for f in _FIELDS}
        known: dict[tuple[str, str], str] = {}
        for batch in batches:
            out = []
            for f in _FIELDS:
                for eid, values in zip(batch["expected_id"], batch[f], strict=True):
                    for pos, v in enumerate(values if values is not None else []):
                        if v is None or not v.strip():
                            continue
                        if (f, v) not in known:
                            if len(known) > 200_000:
                                known.clear()
                            known[f, v] = terms[f].code(v)
                        out.append((eid, f, pos, v, known[f, v]))
            yield pd.DataFrame(out, columns=["expected_id", "field", "pos", "verbatim", "code"])

    return assign


def mapped_verbatims(expected: DataFrame, vocabulary: DataFrame, phrases: Phrases | None = None) -> DataFrame:
    """expected_id, field, pos, verbatim, code of every verbatim that isn't null or blank.

    ``expected`` has expected_id, programs (array of structs with phase_verbatim
    and indication_verbatim) and modality_verbatim; ``vocabulary`` vocab, code,
    label and aliases; ``phrases`` may name, per vocab and label, further wordings
    (divided by semicolons) beside the table's aliases. field is 'phase', 'indication' or 'modality', pos counts
    programs from 0 (nulls and blanks included in the count). code is UNMATCHED
    where no entry fits, or two fit equally. Null arrays have no verbatims, rows
    without expected_id are left out, repeated rows count once, an empty list
    leaves everything unmatched.
    """
    entries = read_entries(vocabulary)
    rows = verbatims(expected)
    counted = rows.mapInPandas(_clean_counts(entries, phrases or {}), "field string, term string, n long").groupBy("field", "term").agg(F.sum("n").alias("n"))
    frequency: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counted.collect():  # at most one row a term of the list
        frequency[r["field"]][r["term"]] = r["n"]
    return rows.mapInPandas(
        _assigned(entries, dict(frequency), phrases or {}), "expected_id long, field string, pos int, verbatim string, code string"
    ).distinct()


def misses(mapping: DataFrame) -> DataFrame:
    """field, verbatim, n: what could not be mapped, with the places it stands in."""
    return mapping.where(F.col("code") == UNMATCHED).groupBy("field", "verbatim").agg(F.count(F.lit(1)).alias("n"))
