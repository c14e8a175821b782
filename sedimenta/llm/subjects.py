"""Subject areas of documents by class-association rules.

Sentences of labelled documents are transactions of words and word pairs with
the document's area as class item. Items that say nothing about the area are
left out first (so that the wording all texts share makes no itemsets). Parallel
frequent-pattern growth mines the itemsets: items are ranked by frequency, each
item's group gets the more frequent items that stand beside it, and a group
grows its patterns by itself, to MAX_ITEMS items, counting the documents of each
class. Redundant rules (a more general one is as sure) are pruned. A
sentence belongs to the area with the most evidence, the sum of the rules'
log-odds, whose confidence is calibrated as a lower bound over documents; a
document has the areas that a good part of its subject-bearing sentences have.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import cut

#: The classifier is fitted on at most so many labelled documents (the first by a hash of their id).
MAX_LABELLED = 20_000
#: An item has to stand in two documents, or in this share of the labelled ones.
MIN_SHARE = 0.001
#: Lower bound of a rule's confidence: one standard error below the observed one.
Z = 1.0
MIN_CONFIDENCE = 0.5
#: Patterns grow to so many items; those of all items of a sentence would double with each.
MAX_ITEMS = 3
#: A longer run of words without an end of sentence is read in pieces.
MAX_WORDS = 64
#: The rules are held by every worker; more than so many are refused.
MAX_RULES = 2_000_000
#: A more special rule has to be surer by this much.
GAIN = 0.02
#: "About a quarter": shares of planted parts and of passing remarks leave a gap around it.
MIN_AREA_SHARE = 0.2
OTHER = "other"

_BROKEN = re.compile("[ÂÃ].")
_FOREIGN = re.compile(r"[^\x00-\x7f]")
_TAGS = re.compile(r"<[^>]{1,200}>")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+|(?<=\|)\s{2,}")
_WORD = re.compile(r"[^\W\d_][^\W\d_']+")


def _mended(match: re.Match) -> str:
    for encoding in ("cp1252", "latin-1"):
        try:
            return match[0].encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
    return match[0]


def sentence_words(text: str | None) -> Iterator[list[str]]:
    """The words of every sentence of the whole text."""
    if not text:
        return
    # Most texts need few of these steps; each is skipped where it can change nothing.
    if not text.isascii():
        text = _BROKEN.sub(_mended, text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAGS.sub(" ", text)
    text = text.lower()
    if not text.isascii():
        text = _FOREIGN.sub(lambda m: "" if unicodedata.combining(m[0]) else m[0], unicodedata.normalize("NFKD", text))
    for sentence in _SENTENCE.split(text):
        found = _WORD.findall(sentence)
        for start in range(0, len(found), MAX_WORDS):
            yield found[start : start + MAX_WORDS]


def sentence_items(text: str | None) -> list[set[str]]:
    """Words and pairs of neighbouring words of every sentence."""
    return [{*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))} for words in sentence_words(text)]


def _bound(k: Column, n: Column) -> Column:
    """Wilson's lower bound, Z standard errors below k of n."""
    p = k / n
    return (p + Z * Z / 2 / n - Z * F.sqrt(p * (1 - p) / n + Z * Z / 4 / n / n)) / (1 + Z * Z / n)


def bound_of(k: float, n: float) -> float:
    p = k / n
    return (p + Z * Z / 2 / n - Z * math.sqrt(p * (1 - p) / n + Z * Z / 4 / n / n)) / (1 + Z * Z / n)


def agreed_labels(labels: DataFrame) -> DataFrame:
    """doc_id, areas of labelled documents: the areas more than half of its annotators give; at most MAX_LABELLED documents."""
    said = labels.where(F.col("doc_id").isNotNull() & F.col("area").isNotNull()).select("doc_id", F.coalesce("annotator", F.lit("")).alias("annotator"), "area").distinct()
    of_doc = said.groupBy("doc_id").agg(F.countDistinct("annotator").alias("_all"))
    return (
        said.groupBy("doc_id", "area").agg(F.count(F.lit(1)).alias("_n")).join(of_doc, "doc_id").where(2 * F.col("_n") > F.col("_all"))
        .groupBy("doc_id").agg(F.sort_array(F.collect_set("area")).alias("areas"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )


def _training_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (doc, areas, at, sorted(items))
            for doc, areas, text in zip(batch["doc_id"], batch["areas"], batch["text"], strict=True)
            for at, items in enumerate(sentence_items(text))
        ]
        yield pd.DataFrame(rows, columns=["doc_id", "areas", "at", "items"])


def mine_rules(documents: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """items, area, weight of the rules, on the driver; their number is bounded by the labelled sample's and checked.

    A document of several areas counts for each of them.
    """
    none = pd.DataFrame({"items": [], "area": [], "weight": []})
    agreed = cut(agreed_labels(labels))
    n_docs = agreed.count()
    if not n_docs:
        return none
    texts = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most MAX_LABELLED rows of an id and a few areas.
    own = F.broadcast(agreed.select(F.col("doc_id").cast("long").alias("doc_id"), "areas"))
    sentences = cut(texts.join(own, "doc_id").mapInPandas(_training_items, "doc_id long, areas array<string>, at int, items array<string>"))
    least = max(2, math.ceil(MIN_SHARE * n_docs))
    told = sentences.select("doc_id", "areas", F.explode("items").alias("item")).distinct()
    per_area = told.select("item", F.explode("areas").alias("area"), (1.0 / F.size("areas")).alias("part")).groupBy("item", "area").agg(F.count(F.lit(1)).alias("k"), F.sum("part").alias("part"))
    items = (
        per_area.groupBy("item").agg(F.round(F.sum("part")).alias("n"), F.max(F.struct("k", "area")).alias("m"))
        .where(F.col("n") >= least)
        .select("item", "n", F.col("m.area").alias("area"), _bound(F.col("m.k"), F.col("n")).alias("bound"))
    )
    items = cut(items)
    # A pair of words stays only where it is surer than each of its words.
    word = lambda c: items.select(F.col("item").alias(c), F.col("area").alias("area"), F.col("bound").alias(f"{c}_b"))
    split = F.split("item", " ")
    pairs = items.where(F.col("item").contains(" ")).withColumn("w1", split[0]).withColumn("w2", split[1])
    pairs = pairs.join(word("w1"), ["w1", "area"], "left").join(word("w2"), ["w2", "area"], "left")
    surer = F.col("bound") > F.greatest(F.coalesce("w1_b", F.lit(0.0)), F.coalesce("w2_b", F.lit(0.0))) + GAIN
    telling = items.where(~F.col("item").contains(" ")).select("item", "n", "area", "bound").unionByName(pairs.where(surer).select("item", "n", "area", "bound"))
    telling = cut(telling.where(F.col("bound") >= MIN_CONFIDENCE - 0.05))
    baskets = (
        sentences.select("doc_id", "at", "areas", F.explode("items").alias("item"))
        .join(telling.select("item", "n", "bound"), "item")
        .groupBy("doc_id", "at", "areas")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "item", "bound"))).alias("ranked"))
    )
    # Each item's group: what stands beside it and is more frequent (equal ones by name), so every pattern grows in one group.
    groups = baskets.select("doc_id", "areas", F.col("ranked.item").alias("items"), F.posexplode("ranked").alias("pos", "last")).select(
        F.col("last.item").alias("last"), F.col("last.bound").alias("bound"), "doc_id", "areas", F.slice("items", F.lit(1), F.col("pos")).alias("beside")
    )

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(patterns(group, least), columns=["items", "area", "bound"])

    longer = groups.where(F.size("beside") > 0).groupBy("last").applyInPandas(grow, "items array<string>, area string, bound double")
    single = telling.where(F.col("bound") >= MIN_CONFIDENCE).select(F.array("item").alias("items"), "area", "bound")
    rules = single.unionByName(longer).limit(MAX_RULES + 1).toPandas()
    if len(rules) > MAX_RULES:
        raise ValueError("too many rules for every worker to hold: raise MIN_SHARE or MIN_CONFIDENCE")
    return pruned(rules) if len(rules) else none


def patterns(group: pd.DataFrame, least: int) -> list[tuple[list[str], str, float]]:
    """Rules of two to MAX_ITEMS items that end in the group's item and are surer than that alone."""
    last, alone = group["last"].iloc[0], float(group["bound"].iloc[0])
    found: list[tuple[list[str], str, float]] = []

    def extend(suffix: list[str], rows: list[tuple[int, tuple[str, ...], list[str]]]) -> None:
        by_item: dict[str, list[tuple[int, tuple[str, ...], list[str]]]] = defaultdict(list)
        for doc, areas, beside in rows:
            for i, item in enumerate(beside):
                by_item[item].append((doc, areas, beside[:i]))
        for item, own in by_item.items():
            docs = {doc: areas for doc, areas, _ in own}
            if len(docs) < least:
                continue
            counts: dict[str, int] = defaultdict(int)
            for areas in docs.values():
                for area in areas:
                    counts[area] += 1
            k, area = max((k, a) for a, k in counts.items())
            if (bound := bound_of(k, len(docs))) >= max(MIN_CONFIDENCE, alone + GAIN):
                found.append((sorted([item, *suffix]), area, bound))
            if len(suffix) + 1 < MAX_ITEMS:
                extend([item, *suffix], own)

    extend([last], [(d, tuple(a), list(b)) for d, a, b in zip(group["doc_id"], group["areas"], group["beside"], strict=True)])
    return found


def pruned(rules: pd.DataFrame) -> pd.DataFrame:
    """Rules none of whose parts is a rule for the area that is as sure; weight is the log-odds."""
    known: dict[tuple[frozenset, str], float] = {}
    kept = []
    ordered = sorted(((frozenset(i), a, float(b)) for i, a, b in zip(rules["items"], rules["area"], rules["bound"], strict=True)), key=lambda r: (len(r[0]), sorted(r[0]), r[1]))
    for items, area, bound in ordered:
        parts = [items - {x} for x in items] + [frozenset({x}) for x in items] if len(items) > 1 else []
        if any(known.get((p, area), 0.0) >= bound - GAIN for p in parts):
            continue
        known[items, area] = bound
        top = min(bound, 0.995)
        kept.append((sorted(items), area, math.log(top / (1 - top)) if top > 0.5 else 0.01))
    return pd.DataFrame(kept, columns=["items", "area", "weight"])


class Scorer:
    def __init__(self, rules: pd.DataFrame) -> None:
        self.single: dict[str, list[tuple[str, float]]] = {}
        self.several: dict[str, list[tuple[frozenset, str, float]]] = {}
        for items, area, weight in zip(rules["items"], rules["area"], rules["weight"], strict=True):
            if len(items) == 1:
                self.single.setdefault(items[0], []).append((area, weight))
            else:
                self.several.setdefault(items[0], []).append((frozenset(items), area, weight))
        #: All that rules speak of; a sentence's other words and pairs decide nothing.
        self.words = {i for items in rules["items"] for i in items if " " not in i}
        self.after: dict[str, set[str]] = {}
        for pair in {i for items in rules["items"] for i in items if " " in i}:
            first, second = pair.split(" ")
            self.after.setdefault(first, set()).add(second)

    def items(self, words: list[str]) -> set[str]:
        """The words and pairs of a sentence that rules speak of."""
        found = self.words.intersection(words)
        for i, a in enumerate(words[:-1]):
            if a in self.after and words[i + 1] in self.after[a]:
                found.add(f"{a} {words[i + 1]}")
        return found

    def area(self, items: set[str]) -> str | None:
        """The area with the most evidence in a sentence; None without evidence or for OTHER."""
        evidence: dict[str, float] = {}
        for x in items:
            for area, weight in self.single.get(x, ()):
                evidence[area] = evidence.get(area, 0.0) + weight
            for whole, area, weight in self.several.get(x, ()):
                if whole <= items:
                    evidence[area] = evidence.get(area, 0.0) + weight
        if not evidence:
            return None
        best = min(evidence, key=lambda a: (-evidence[a], a))
        return None if best == OTHER else best

    def areas(self, text: str | None) -> list[tuple[str, float]]:
        """The areas a text deals with and their shares, the largest first; OTHER alone if there is none."""
        found = {a: s for a, s in self.shares(text).items() if s >= MIN_AREA_SHARE} or {OTHER: 1.0}
        return sorted(found.items(), key=lambda x: (-x[1], x[0]))

    def shares(self, text: str | None) -> dict[str, float]:
        """Shares of the areas in the subject-bearing sentences of a text."""
        counts: dict[str, int] = {}
        for words in sentence_words(text):
            if area := self.area(self.items(words)):
                counts[area] = counts.get(area, 0) + 1
        total = sum(counts.values())
        return {a: n / total for a, n in counts.items()}


def subject_shares(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, area, share of the areas a document deals with, the largest first in ``place`` (from 0).

    ``documents`` has doc_id and text, ``labels`` doc_id and area; other columns
    are ignored. A document with no area (null, empty or purely formal text, no
    rule) has the one row OTHER with share 1. Rows without doc_id are left out.
    Without usable labels every document is OTHER.
    """
    rules = mine_rules(documents, labels)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(rules)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                out += [(doc, a, s, i) for i, (a, s) in enumerate(scorer.areas(text))]
            yield pd.DataFrame(out, columns=["doc_id", "area", "share", "place"])

    rows = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(score, "doc_id long, area string, share double, place int")


def makeup(shares: DataFrame) -> DataFrame:
    """area, documents, mean_share: the make-up of the corpus by area."""
    return shares.groupBy("area").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg("share"), 6).alias("mean_share"))
