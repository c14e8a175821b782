"""Variant spellings of the names of organisations and assets.

Names are read into forms (core tokens, kind of organisation, initials), so that
case, accents, order, legal forms, abbreviations and nicknames no longer differ.
Forms meet over near tokens, found by symmetric deletion, are verified by
Monge-Elkan similarity over a typing distance, and are clustered into stars
around the most complete and best connected form.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.components import components, smallest_labels
from sedimenta.llm.edits import typing_distance
from sedimenta.llm.star import star_clusters
from sedimenta.session import cut

ACCEPT = 0.80

#: Words for kinds of organisation (fixed values); a token is read as one of
#: them if it is a beginning of it, or of its alias.
KINDS = {
    "laboratories": "laboratory", "medicines": "meds", "biosciences": "biosciences", "genetics": "genetics", "biologics": "biologics",
    "pharmaceuticals": "pharmaceuticals", "therapeutics": "tx", "oncology": "oncology", "institute": "institute",
    "research": "research", "centre": "ctr center", "foundation": "fdn", "clinical": "clinical", "network": "network",
    "biotech": "biotechnology", "vaccines": "vaccines", "diagnostics": "dx", "sciences": "sciences", "holdings": "holdings",
    "university": "univ", "hospital": "hosp", "technologies": "technology", "health": "healthcare", "group": "grp",
}
LEGAL = set("inc corp ltd llc plc gmbh ag sa kk bv co nv spa srl ab as oy limited incorporated corporation company lp llp pty se kg".split())
FILLER = set("the of and amp for de la le der die das und et".split())
#: Nicknames of given names (fixed values).
NICKNAMES = {
    "alexander": "alex sasha sandy alec", "alexandra": "lexi", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny",
    "catherine": "cathy", "charles": "charlie chuck", "christopher": "chris kit", "daniel": "dan danny", "david": "dave",
    "deborah": "debbie", "dorothy": "dot dottie", "edward": "ed eddie ned", "eleanor": "nell ellie", "elizabeth": "betty liz lizzie beth bess eliza",
    "francis": "frank", "frederick": "fritz fred freddie", "george": "georgie", "gerald": "gerry", "harold": "hal", "henrietta": "hattie etta hettie",
    "henry": "hank harry", "isabella": "bella", "james": "jim jimmy jamie", "jennifer": "jenny", "john": "jack johnny", "jonathan": "jon",
    "joseph": "joe joey", "josephine": "josie jo", "judith": "judy", "katherine": "kate kathy katie kitty", "lawrence": "larry",
    "leonard": "lenny len leo", "margaret": "peggy maggie meg madge greta", "martha": "patty", "mary": "molly polly", "matthew": "matt",
    "michael": "mike mick", "nicholas": "nick", "patricia": "pat tricia", "patrick": "paddy", "peter": "pete", "philip": "phil",
    "rebecca": "becky", "richard": "dick rick ricky rich", "robert": "bob rob bobby robbie", "ronald": "ron", "samuel": "sam",
    "sarah": "sally sadie", "stephen": "steve", "susan": "sue", "theodore": "ted teddy theo", "theresa": "tess", "thomas": "tom tommy",
    "timothy": "tim", "victoria": "vicky", "walter": "walt wally", "william": "bill will billy liam",
}
GIVEN = {short: full for full, shorts in NICKNAMES.items() for short in [full, *shorts.split()]}
NOBODY = set(
    "undisclosed partner partners multiple tbd not named n a na unknown none disclosed various confidential to be announced determined other several nil null unnamed third party parties pending".split()
)
SALTS = set(
    "tosylate mesylate hydrochloride sodium maleate fumarate citrate sulfate sulphate acetate phosphate potassium calcium tartrate succinate bromide besylate hcl disodium magnesium".split()
)
_MARKS = re.compile("[™®©*†‡§¶^#¹²³~​]")
_COMBINE = re.compile(r"\s*(?:\+|&|/|;|\band\b|\bplus\b|\bwith\b|\bund\b)\s*")
_CODE = re.compile(r"([a-z]{1,6})[-_ .]?(\d{2,})([a-z]?)")
_TRANSLATE = str.maketrans({"ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ł": "l", "đ": "d"})
_DASHES = re.compile("[‐-―−]")


def plain(name: str) -> str:
    """Lower case without accents, marks, entities and repeated blanks."""
    text = _MARKS.sub(" ", html.unescape(html.unescape(name)))
    text = unicodedata.normalize("NFKD", text.lower().translate(_TRANSLATE))
    text = "".join(c for c in text if not unicodedata.combining(c))
    return " ".join(_DASHES.sub("-", text).split())


def _kinds(token: str) -> set[str]:
    """Kinds a token may stand for: beginnings of at least three letters, aliases, or one slip."""
    if token in KINDS:
        return {token}
    found = set()
    for kind, aliases in KINDS.items():
        stem = re.sub(r"(ies|s)$", "", kind)
        for word in (kind, stem, *aliases.split()):
            if token == word or (len(token) >= 3 and word.startswith((token, token[:-1] if token[-1] == "s" and len(token) > 3 else token))):
                found.add(kind)
    if not found and len(token) >= 6:
        found = {k for k in KINDS for w in (k, *KINDS[k].split()) if len(w) >= 6 and typing_distance(token, w, 1.0) <= 1.0}
    return found


def organisation_form(name: str | None) -> str | None:
    """The form of an organisation's name, None if it names nobody.

    core tokens | kinds | initials | legal form | letter of the kind in an acronym
    """
    if name is None:
        return None
    text = re.sub(r"\b([a-z])\.\s?([a-z])\.(?![a-z])", r"\1\2 ", plain(name))
    acronym = ""
    for pattern in (r"\(([a-z]{2,6})\)\s*$", r"^([a-z]{2,6})\s*/\s"):
        if (m := re.search(pattern, text)) and not _kinds(m[1]):
            acronym, text = m[1], re.sub(pattern, " ", text)
            break
    tokens = [t for t in re.split(r"[^a-z0-9]+", text) if t]
    if not tokens or all(t in NOBODY for t in tokens):
        return None
    core, kinds, initials, legal = [], [], [], ""
    for t in tokens:
        if t in FILLER:
            continue
        if t in LEGAL:
            legal = t
        elif len(t) == 1:
            initials.append(t)
        elif t in GIVEN:
            core.append(GIVEN[t])
        elif found := _kinds(t):
            kinds.append(found)
        else:
            core.append(t)
    if not core and kinds:  # a name made of words for kinds only
        core, kinds = tokens, []
    if not core:
        return None
    # "clinical network" and "research centre" are one kind each; only the first word decides.
    order = {"clinical": 0, "research": 1}
    kinds.sort(key=lambda k: min(order.get(x, 2) for x in k))
    kind = ",".join(sorted(kinds[0])) if kinds else ""
    last = acronym[-1] if acronym and len(acronym) == len(core) + len(initials) + 1 else ""
    return "|".join([" ".join(sorted(core)), kind, "".join(sorted(initials)), legal, last])


def asset_forms(name: str | None) -> list[str]:
    """Forms of an asset's name: 'd|code', 'w|word' or 'm|word word'; several name the same asset."""
    if name is None:
        return []
    text = plain(name)
    if not text or all(t in NOBODY for t in re.split(r"[^a-z0-9]+", text) if t):
        return []
    parts = [p for p in _COMBINE.split(text) if p]
    if len(parts) > 1 and all(len(re.sub(r"[^a-z0-9]", "", p)) >= 4 for p in parts):
        return ["m|" + " ".join(sorted(_simple(p)[2:].replace(" ", "") for p in parts))]
    if m := re.fullmatch(r"(.+?)\s*\(([^()]*)\)", text):
        inner = [w for w in m[2].split() if w not in SALTS]
        forms = [_simple(m[1])]
        if len(inner) == 1 and len(inner[0]) >= 4:
            forms.append(_simple(inner[0]))
        return forms
    return [_simple(text)]


def _simple(text: str) -> str:
    words = [w for w in text.split() if w not in SALTS] or text.split()
    joined = " ".join(words)
    if m := _CODE.fullmatch(joined):
        return "d|" + "".join(m.groups())
    return "w|" + re.sub(r"[^a-z0-9]+", " ", joined).strip()


def monge_elkan(a: list[str], b: list[str], slips: float) -> float:
    """Mean over the tokens of ``a`` of the best similarity to a token of ``b``, 0 where one has none within ``slips``."""
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            n = max(len(x), len(y))
            d = typing_distance(x, y, slips)
            if d <= min(slips, n / 4):
                best = max(best, 1 - d / n)
        if not best:
            return 0.0
        total += best
    return total / len(a)


def organisation_similarity(a: str, b: str) -> float:
    """Similarity of two organisation forms, 0 where they can't be one organisation."""
    (ca, ka, ia, la, xa), (cb, kb, ib, lb, xb) = a.split("|"), b.split("|")
    kinds_a, kinds_b = {k for k in ka.split(",") if k}, {k for k in kb.split(",") if k}
    if kinds_a and kinds_b and not kinds_a & kinds_b:
        return 0.0
    for x, kinds in ((xa, kinds_b), (xb, kinds_a)):
        if x and kinds and not any(k.startswith(x) for k in kinds):
            return 0.0
    ta, tb = ca.split(), cb.split()
    if len(ta) > len(tb) or (len(ta) == len(tb) and ia and not ib):
        (ta, ia, la, kinds_a), (tb, ib, lb, kinds_b) = (tb, ib, lb, kinds_b), (ta, ia, la, kinds_a)
    if all(t in NICKNAMES for t in ta) and (ca != cb or ia != ib or bool(kinds_a) != bool(kinds_b)):
        return 0.0  # given names alone name one organisation only if nothing but the legal form differs
    score = monge_elkan(ta, tb, 2.0)
    if len(ta) == len(tb):
        score = min(score, monge_elkan(tb, ta, 2.0))
        if ia != ib:
            if len(ta) == 1 and ia and ib and not set(ia) & set(ib):
                return 0.0  # 'N. Kestrel' isn't 'P. Kestrel'
            score *= 0.9
    elif score:
        # The shorter form leaves tokens out: by initial, or (a lone token) altogether.
        rest = sorted(tb, key=lambda y: min(typing_distance(x, y, 3.0) for x in ta))[len(ta) :]
        if ia:
            if sorted(ia) != sorted(r[0] for r in rest):
                return 0.0
            score *= 0.97
        elif len(ta) == 1:
            score *= 0.92
        else:
            return 0.0
    if not score and len(ta) == 1 and len(tb) == 2:
        joined = max(1 - typing_distance(ta[0], x, 2.0) / len(ta[0]) for x in (tb[0] + tb[1], tb[1] + tb[0]))
        score = joined if joined > 0.85 else 0.0
    if la and lb:
        score *= 1.0 if la == lb else 0.96
    if kinds_a and kinds_b:
        return score
    return score * 0.98


def asset_similarity(a: str, b: str) -> float:
    if a[0] != b[0] or a[0] == "d":
        return 0.0
    ta, tb = a[2:].split(), b[2:].split()
    if len(ta) != len(tb) or any(c.isdigit() for c in a[2:] + b[2:]):
        return 0.0
    slips = 1.0 if min(map(len, ta + tb)) < 12 else 2.0
    if min(map(len, ta + tb)) < 7:
        return 0.0
    return min(monge_elkan(ta, tb, slips), monge_elkan(tb, ta, slips))


def _spellings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind, name, form, hub of every name; all forms with one hub name one asset."""
    orgs: dict[str, str | None] = {}
    assets: dict[str, list[str]] = {}
    for batch in batches:
        out: set[tuple] = set()
        for preferred, synonyms, partners in zip(batch["preferred_name"], batch["synonyms"], batch["partners"], strict=True):
            for p in partners if partners is not None else []:
                if p not in orgs:
                    if len(orgs) > 200_000:
                        orgs.clear()
                    orgs[p] = organisation_form(p)
                if orgs[p] is not None:
                    out.add(("partner", p, orgs[p], None))
            hub = None
            for n in [preferred, *(synonyms if synonyms is not None else [])]:
                if n is None:
                    continue
                if n not in assets:
                    if len(assets) > 200_000:
                        assets.clear()
                    assets[n] = asset_forms(n)
                for form in assets[n]:
                    hub = hub or form
                    out.add(("asset", n, form, hub))
        yield pd.DataFrame(list(out), columns=["kind", "name", "form", "hub"])


def _slips(kind: str, n: int) -> int:
    """The most slips the verification forgives in a pair of tokens of which the longer has ``n`` letters."""
    if kind == "asset":
        return 0 if n < 7 else 1 if n < 12 else 2
    return min(2, n // 4)


def deletions(text: str, depth: int) -> set[str]:
    found = layer = {text}
    for _ in range(depth):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        found = found | layer
    return found


def _deletion_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """key, token, part: what is left of a token after as many deletions as the verification forgives slips.

    A slip takes at most one letter from either token, so two tokens within the
    limit always share a key, whatever their length. ``part`` marks the lone
    tokens that may be two tokens written together.
    """
    for batch in batches:
        rows = [
            (hash_of(kind, key), token, part)
            for kind, token, part in zip(batch["kind"], batch["token"], batch["part"], strict=True)
            for key in deletions(token, _slips(kind, len(token)))
        ]
        yield pd.DataFrame(rows, columns=["key", "token", "part"])


def hash_of(kind: str, key: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}|{key}") - (1 << 63)


def near_tokens(tokens: DataFrame, kind: str) -> DataFrame:
    """x, y, part: all pairs of tokens, in both orders and each with itself, within the slips the verification forgives.

    ``tokens`` has kind, token and part; a pair needs one token that isn't
    joined from two (part '+') and of those only a lone one (part '1') meets them.
    """
    keyed = cut(tokens.repartition("token").mapInPandas(_deletion_keys, "key long, token string, part string"))
    a = keyed.select("key", F.col("token").alias("x"), F.col("part").alias("px"))
    b = keyed.select("key", F.col("token").alias("y"), F.col("part").alias("py"))
    met = a.join(b, "key").where(((F.col("px") != "+") & (F.col("py") != "+")) | ((F.col("px") == "1") & (F.col("py") == "+"))).select("x", "y", "py").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [typing_distance(x, y, 2.0) <= _slips(kind, max(len(x), len(y))) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch[keep]

    return met.mapInPandas(verify, "x string, y string, py string")


def _core(kind: str, form: str) -> tuple[list[str], list[str]]:
    parts = form.split("|")
    return (parts[0].split(), list(parts[2])) if kind == "partner" else (form[2:].split(), [])


def _seats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """role, token, beside, form: where a form's tokens stand; see :func:`candidate_pairs`."""
    for batch in batches:
        rows = set()
        for kind, form in zip(batch["kind"], batch["form"], strict=True):
            tokens, initials = _core(kind, form)
            n = len(tokens)
            if n == 1:
                for letter in initials or [""]:
                    rows.add(("one", tokens[0], letter, form))
                if not initials:
                    rows.add(("lone", tokens[0], "", form))
            elif n:
                rows.add((f"first{n}", tokens[0], tokens[1], form))
                rows.update((f"any{n}", x, y, form) for i, x in enumerate(tokens) for j, y in enumerate(tokens) if i != j)
            if n == 2 and kind == "partner":
                rows.update(("joined", x, "", form) for x in (tokens[0] + tokens[1], tokens[1] + tokens[0]))
            for x in tokens if kind == "partner" else []:
                rows.update(("short", x, letter, form) for letter in initials)
                if n > 1:
                    rows.add(("in", x, "", form))
                    rows.update(("beside", x, y[0], form) for j, y in enumerate(tokens) if tokens.index(x) != j)
        yield pd.DataFrame(list(rows), columns=["role", "token", "beside", "form"])


def candidate_pairs(forms: DataFrame, kind: str) -> DataFrame:
    """kind, a, b (a < b) of forms of one kind that the verification may accept; none is left out.

    Forms meet over pairs of near tokens, of which a common token has as many as
    it has spellings:

    * forms of equally many tokens, if the first two of one are near two of the
      other (both at once, so a common token alone brings nothing together);
      forms of one token, if an initial is the same or one has none;
    * a lone token and the forms with a token near it, or with two that it joins;
    * a form with initials and the forms with a near token beside one of that letter.
    """
    own = forms.where(F.col("kind") == kind).select("kind", "form").distinct().repartition("form")
    seats = cut(own.mapInPandas(_seats, "role string, token string, beside string, form string"))
    seat = lambda *roles: seats.where(F.col("role").isin(*roles))
    part = F.when(F.max(F.col("role") != "joined"), F.when(F.max(F.col("role") == "one"), "1").otherwise("")).otherwise("+")
    tokens = seats.groupBy("token").agg(part.alias("part")).select(F.lit(kind).alias("kind"), "token", "part")
    tokens = tokens.unionByName(seat("joined").select(F.lit(kind).alias("kind"), "token", F.lit("+").alias("part"))).distinct()
    near = cut(near_tokens(tokens, kind))
    plain_near = near.where("py <> '+'").select("x", "y")

    def meet(left: DataFrame, right: DataFrame, pairs: DataFrame, *on: str) -> DataFrame:
        moved = left.select(F.col("token").alias("x"), "beside", F.col("form").alias("fa")).join(pairs, "x")
        here = right.select(F.col("token").alias("y"), "beside", F.col("form").alias("fb"))
        return moved.join(here, ["y", *on]).select("fa", "fb")

    # Each side widens one of the two tokens by its near ones and both meet on the exact two.
    size = F.regexp_extract("role", r"\d+", 0).alias("n")
    first = seats.where(F.col("role").startswith("first")).select(size, F.col("token").alias("p"), F.col("beside").alias("x"), F.col("form").alias("fa"))
    others = seats.where(F.col("role").startswith("any")).select(size, F.col("token").alias("x"), F.col("beside").alias("q"), F.col("form").alias("fb"))
    equal = first.join(plain_near, "x").select("n", "p", F.col("y").alias("q"), "fa").join(
        others.join(plain_near, "x").select("n", F.col("y").alias("p"), "q", "fb"), ["n", "p", "q"]
    ).select("fa", "fb")
    lettered = seat("one").where("beside <> ''")
    met = equal.unionByName(meet(lettered, lettered, plain_near, "beside")).unionByName(meet(seat("lone"), seat("one"), plain_near))
    if kind == "partner":
        known = seat("lone").where(~F.col("token").isin(*NICKNAMES))  # a given name alone names nobody in particular
        met = met.unionByName(meet(known, seat("in"), plain_near))
        met = met.unionByName(meet(seat("one").withColumn("beside", F.lit("")), seat("joined"), near.where("py = '+'").select("x", "y")))
        met = met.unionByName(meet(seat("short"), seat("beside"), plain_near, "beside"))
    return met.where(F.col("fa") != F.col("fb")).select(F.lit(kind).alias("kind"), F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")).distinct()


def verified_pairs(pairs: DataFrame) -> DataFrame:
    """Candidate pairs whose Monge-Elkan similarity reaches ACCEPT, with it as ``sim``."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sims = [
                organisation_similarity(a, b) if kind == "partner" else asset_similarity(a, b)
                for kind, a, b in zip(batch["kind"], batch["a"], batch["b"], strict=True)
            ]
            batch = batch.assign(sim=sims)
            yield batch[batch["sim"] >= ACCEPT]

    return pairs.mapInPandas(verify, "kind string, a string, b string, sim double")


def name_clusters(expected: DataFrame) -> DataFrame:
    """kind, name, cluster of every distinct name that names something.

    ``expected`` has preferred_name, synonyms and partners (an array of structs
    with a name); other columns are ignored. All names of one row's
    preferred_name and synonyms are one asset. Null, blank and placeholder names
    are left out; null arrays count as empty; repeated rows change nothing but
    the support that settles ties; an empty table gives no rows.
    """
    rows = expected.select("preferred_name", "synonyms", F.col("partners.name").alias("partners"))
    said = rows.mapInPandas(_spellings, "kind string, name string, form string, hub string")
    said = cut(said.groupBy("kind", "name", "form", "hub").agg(F.count(F.lit(1)).alias("n")))
    forms = said.groupBy("kind", "form").agg(F.sum("n").alias("support"))
    # What rows state outright: forms with one hub are one asset.
    stated = said.where((F.col("kind") == "asset") & (F.col("form") != F.col("hub"))).select(
        F.concat(F.lit("asset|"), F.col("form")).alias("a"), F.concat(F.lit("asset|"), F.col("hub")).alias("b")
    )
    stated = smallest_labels(components(stated))
    nodes = forms.select("kind", "form", "support", F.concat_ws("|", "kind", "form").alias("node")).join(stated, "node", "left")
    nodes = cut(nodes.select("kind", "form", "node", "support", F.coalesce("group", "node").alias("group")))
    blocked = nodes.where(~F.col("node").startswith("asset|d|"))
    verified = verified_pairs(candidate_pairs(blocked, "partner").unionByName(candidate_pairs(blocked, "asset")))
    of = lambda c: nodes.select("kind", F.col("form").alias(c), F.col("group").alias(f"g{c}"))
    joined = verified.join(of("a"), ["kind", "a"]).join(of("b"), ["kind", "b"])
    core = F.split("form", r"\|")
    complete = F.when(
        F.col("kind") == "partner",
        F.when(F.size(F.split(core[0], " ")) > 1, 2).otherwise(0) + F.when(core[1] != "", 1).otherwise(0),
    ).otherwise(F.when(F.col("form").startswith("d|"), 1).otherwise(0))
    groups = nodes.groupBy("group").agg(F.max(complete).alias("complete"), F.sum("support").alias("support"), F.max(F.col("node").startswith("asset|d|")).alias("coded"))
    edges = joined.where(F.col("ga") != F.col("gb")).groupBy(F.col("ga").alias("a"), F.col("gb").alias("b")).agg(F.max("sim").alias("sim"))
    coded = groups.where("coded").select("group")
    # Two assets with a code each are two assets, whatever their other names look like.
    a_coded = edges.join(coded, edges["a"] == coded["group"], "left").select("a", "b", "sim", F.col("group").isNotNull().alias("ca"))
    edges = cut(
        a_coded.join(coded, a_coded["b"] == coded["group"], "left").where(~(F.col("ca") & F.col("group").isNotNull())).select("a", "b", "sim")
    )
    degree = edges.select(F.col("a").alias("group")).unionByName(edges.select(F.col("b").alias("group"))).groupBy("group").agg(F.count(F.lit(1)).alias("degree"))
    priority = groups.join(degree, "group").select(
        F.col("group").alias("node"), F.struct("complete", "degree", "support", F.col("group").alias("id")).alias("prio")
    )
    stars = star_clusters(edges, priority).withColumnRenamed("node", "group")
    final = nodes.join(stars, "group", "left").select("kind", "form", F.coalesce("center", "group").alias("cluster"))
    return (
        said.select("kind", "name", "form").join(final, ["kind", "form"]).groupBy("kind", "name").agg(F.min("cluster").alias("cluster"))
    )


def variant_pairs(clusters: DataFrame) -> DataFrame:
    """kind, name_a, name_b (name_a < name_b): the pairs of different names of each cluster."""
    a = clusters.select("kind", "cluster", F.col("name").alias("name_a"))
    b = clusters.select("kind", "cluster", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "cluster"]).where(F.col("name_a") < F.col("name_b")).select("kind", "name_a", "name_b")


#: MinHash banding of tokens as measured by :func:`banding_recall`: padded 2-grams, a recall of RECALL for one slip.
GRAM = 2
RECALL = 0.99
MOST_BANDS = 40


def banding_recall(expected: DataFrame) -> DataFrame:
    """kind, length, pairs, met, bands, rows: near tokens that MinHash banding tuned by length would bring together.

    Bands and rows follow from the collision curve at the similarity a
    transposition leaves in a token of that length. ``pairs`` are all pairs of
    different tokens within the slips the verification forgives, by the longer
    one's length; ``met`` those that share a band.
    """
    from sedimenta.llm.minhash import MinHash, banding, edit_similarity

    rows = expected.select("preferred_name", "synonyms", F.col("partners.name").alias("partners"))
    forms = cut(rows.mapInPandas(_spellings, "kind string, name string, form string, hub string").select("kind", "form").distinct())

    def met(kind: str) -> object:
        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hashers: dict[int, MinHash] = {}
            for batch in batches:
                out = []
                for x, y in zip(batch["x"], batch["y"], strict=True):
                    n = max(len(x), len(y))
                    if n not in hashers:
                        hashers[n] = MinHash(*banding(edit_similarity(n, GRAM, GRAM + 1), RECALL, MOST_BANDS), GRAM)
                    h = hashers[n]
                    out.append((kind, n, bool(set(h.keys(x)) & set(h.keys(y))), h.bands, h.rows))
                yield pd.DataFrame(out, columns=["kind", "length", "met", "bands", "rows"])

        return judge

    found = None
    for kind in ("partner", "asset"):
        seats = forms.where((F.col("kind") == kind) & ~F.col("form").startswith("d|")).repartition("form").mapInPandas(_seats, "role string, token string, beside string, form string")
        tokens = seats.where("role <> 'joined'").select(F.lit(kind).alias("kind"), "token", F.lit("").alias("part")).distinct()
        near = near_tokens(tokens, kind).where("x < y").select("x", "y").distinct()
        judged = near.mapInPandas(met(kind), "kind string, length int, met boolean, bands int, rows int")
        found = judged if found is None else found.unionByName(judged)
    return found.groupBy("kind", "length", "bands", "rows").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("met").alias("met"))
