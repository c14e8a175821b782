"""Sources mixed to target shares of tokens.

Token weights of the cells source x language x topic are raked (iterative
proportional fitting) to three marginals: the sources' target shares, and the
corpus's own shares of languages and topics, so that fixing the sources doesn't
bend the rest more than it must. Each cell's weight is the number of times its
documents are to be used, never more than its source's cap; documents are then
drawn by that calibrated probability in groups of equal length, from the
longest, each group making up for what the one before of its cell drew too much
or little. What is left over in the cells is settled by single documents, so
that sources come out first, and languages and topics as near as they can.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.ranks import with_rank

#: Cells are raked on the driver; their number is checked.
MAX_CELLS = 200_000
#: Documents are drawn in groups of equal length: exact below EXACT tokens, in steps of two percent above.
EXACT = 256
STEP = 0.02
MAX_GROUPS = 2_000_000
ROUNDS = 200
TOLERANCE = 1e-6


def rake(cells: pd.DataFrame, targets: dict[str, tuple[float, int]], total: float | None = None) -> pd.DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``uses``, the expected uses of each cell's documents.

    ``targets`` has (share, cap) of each source. Without ``total`` the largest
    one is taken for which every source present reaches its share (of what the
    sources present can make up) within its cap; with a larger one, sources
    that fall short stay at their cap. Sources have the last word, then
    languages and topics as far as caps allow.
    """
    cells = cells[(cells["tokens"] > 0) & cells["source"].isin([s for s, (share, cap) in targets.items() if share > 0 and cap > 0])].reset_index(drop=True)
    if cells.empty:
        return cells.assign(uses=pd.Series(dtype=float))
    tokens = cells["tokens"].to_numpy(float)
    source, lang, topic = (pd.factorize(cells[c]) for c in ("source", "lang", "topic"))
    share = np.array([targets[s][0] for s in source[1]])
    share /= share.sum()
    cap = np.array([float(targets[s][1]) for s in source[1]])
    have = np.bincount(source[0], tokens)
    most = float((cap * have / share).min())
    wanted = np.minimum(share * (total or most), cap * have)
    margins = [(codes, np.bincount(codes, tokens) / tokens.sum() * wanted.sum()) for codes, _ in (lang, topic)]
    limit = cap[source[0]]
    uses = (wanted / have)[source[0]]
    for _ in range(ROUNDS):
        before = uses.copy()
        for codes, target in margins:
            now = np.bincount(codes, uses * tokens, minlength=len(target))
            uses = np.minimum(limit, uses * (target / np.maximum(now, 1e-12))[codes])
        for s in range(len(share)):
            own = source[0] == s
            uses[own] = _filled(uses[own], tokens[own], wanted[s], cap[s])
        if np.abs(uses - before).max() < TOLERANCE:
            break
    return cells.assign(uses=uses)


def _filled(uses: np.ndarray, tokens: np.ndarray, wanted: float, cap: float) -> np.ndarray:
    """``uses`` scaled to make ``wanted`` tokens, none above ``cap``: what the cap cuts off goes to the others."""
    uses = np.maximum(uses, 1e-9)
    free = np.ones(len(uses), bool)
    for _ in range(len(uses) + 1):
        rest = wanted - cap * tokens[~free].sum()
        now = (uses[free] * tokens[free]).sum()
        if now <= 0:
            break
        scaled = uses * max(rest, 0.0) / now
        over = free & (scaled > cap)
        if not over.any():
            return np.where(free, scaled, cap)
        free &= ~over
    return np.full(len(uses), cap)


def read_targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    rows = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError("too many target sources to rake on the driver")
    return {r["source"]: (r["share"] or 0.0, r["cap"] or 0) for r in rows}


def usable(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("doc_id").isNotNull() & F.col("source").isNotNull() & (F.col("tokens") > 0)).select(
        "doc_id", "source", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("topic", F.lit("")).alias("topic"), F.col("tokens").cast("long").alias("tokens")
    )


def of_sources(rows: DataFrame, targets: dict[str, tuple[float, int]]) -> DataFrame:
    return rows.where(F.col("source").isin([s for s, (share, cap) in targets.items() if share > 0 and cap > 0]))


def drawn(documents: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, copies: the corpus drawn; documents that aren't drawn have no row.

    ``documents`` has doc_id (unique), source, lang, topic and tokens;
    ``targets`` source, target_share and max_repeats. A null lang or topic is a
    value of its own; documents of sources without a target, and those without
    tokens, doc_id or source, aren't drawn. No document has more copies than its
    source's cap. Empty tables give no rows.
    """
    rows = usable(documents)
    spark = rows.sparkSession
    known = read_targets(targets)
    mine = of_sources(rows, known)
    cells = mine.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError("too many cells to rake on the driver: group the languages or topics")
    raked = rake(cells, known, total)
    result = "doc_id long, source string, lang string, topic string, tokens long, copies int"
    if not len(raked):
        return spark.createDataFrame([], result)
    cell = ["source", "lang", "topic"]
    group = [*cell, "length"]
    sized = mine.withColumn("length", F.when(F.col("tokens") < EXACT, F.col("tokens")).otherwise(EXACT + F.floor(F.log(F.col("tokens") / EXACT) / STEP)).cast("long"))
    groups = sized.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")).limit(MAX_GROUPS + 1).toPandas()
    if len(groups) > MAX_GROUPS:
        raise ValueError("too many groups of length to plan on the driver: group the languages or topics")
    quotas = spark.createDataFrame(_quotas(groups.merge(raked[[*cell, "uses"]], on=cell), known), "source string, lang string, topic string, length long, n long, m long")
    placed = with_rank(sized, group, [], ["doc_id"]).join(quotas, group)
    copies = F.floor(F.col("m") / F.col("n")) + F.when(F.col("rank") < F.col("m") % F.col("n"), 1).otherwise(0)
    return placed.select(F.col("doc_id").cast("long").alias("doc_id"), *cell, "tokens", copies.cast("int").alias("copies")).where(F.col("copies") > 0)


def _quotas(groups: pd.DataFrame, targets: dict[str, tuple[float, int]]) -> pd.DataFrame:
    """The uses ``m`` of each group of equally long documents, cell by cell and from the longest.

    Whole documents seldom make the wanted tokens; what a group is over or under
    goes to its cell's next shorter one, so a cell ends within about one of its
    shortest documents of what it should have.
    """
    cell = ["source", "lang", "topic"]
    ordered = groups.sort_values([*cell, "length"], ascending=[True, True, True, False]).reset_index(drop=True)
    owed, last, out, left = 0.0, None, [], []
    for key, n, tokens, uses in zip(zip(*[ordered[c] for c in cell], strict=True), ordered["n"], ordered["tokens"], ordered["uses"], strict=True):
        if key != last:
            owed, last = 0.0, key
        owed += uses * tokens
        m = min(max(round(owed * n / tokens), 0), n * targets[key[0]][1])
        owed -= m * tokens / n
        out.append(m)
        left.append(owed)
    return _settled(ordered.assign(m=out, left=left), targets)[[*cell, "length", "n", "m"]]


def _settled(planned: pd.DataFrame, targets: dict[str, tuple[float, int]]) -> pd.DataFrame:
    """``planned`` with single documents added or left out while that brings sources, then languages and topics, nearer.

    Only the shortest group of a cell changes, and by one document at most
    each, so no cell moves further than one document from its share.
    """
    cell = ["source", "lang", "topic"]
    short = planned.index[~planned.duplicated(cell, keep="last")].to_numpy()
    if not len(short):
        return planned
    chosen = planned.loc[short]
    size = (chosen["tokens"] / chosen["n"]).to_numpy(float)
    m = chosen["m"].to_numpy(int).copy()
    most = (chosen["n"] * chosen["source"].map(lambda s: targets[s][1])).to_numpy(int)
    margins = [(pd.factorize(chosen[c])[0], weight) for c, weight in (("source", 1e3), ("lang", 1.0), ("topic", 1.0))]
    debts = [np.bincount(codes, chosen["left"].to_numpy(float)) for codes, _ in margins]
    moved = np.zeros(len(m), int)
    while True:
        best, at, by = -1e-9, -1, 0
        for step in (1, -1):
            gain = sum(weight * (np.abs(debt[codes] - step * size) - np.abs(debt[codes])) for (codes, weight), debt in zip(margins, debts, strict=True))
            gain[(moved != 0) | (m + step < 0) | (m + step > most)] = np.inf
            if (i := int(gain.argmin())) >= 0 and gain[i] < best:
                best, at, by = gain[i], i, step
        if not by:
            break
        moved[at] = by
        m[at] += by
        for (codes, _), debt in zip(margins, debts, strict=True):
            debt[codes[at]] -= by * size[at]
    out = planned["m"].to_numpy(int).copy()
    out[short] = m
    return planned.assign(m=out)


def share_report(corpus: DataFrame, documents: DataFrame, targets: DataFrame) -> DataFrame:
    """margin, name, target_share, actual_share, documents, tokens, most_copies of every source, language and topic.

    A source's target is the one given, whether its documents suffice or not;
    that of a language or topic is its share of the tokens of the sources in use.
    """
    per = lambda df, c, *aggs: df.groupBy(F.col(c).alias("name")).agg(*aggs).select(F.lit(c).alias("margin"), "*")
    made = F.sum(F.col("tokens") * F.col("copies")).alias("tokens")
    got = [per(corpus, c, F.count(F.lit(1)).alias("documents"), made, F.max("copies").alias("most_copies")) for c in ("source", "lang", "topic")]
    mine = of_sources(usable(documents), read_targets(targets))
    given = targets.where(F.col("source").isNotNull()).groupBy(F.col("source").alias("name")).agg(F.max("target_share").alias("target_share"))
    have = mine.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens"))
    total, own = (F.lit(df.agg(F.sum(x)).first()[0]).cast("double") for df, x in ((corpus, F.col("tokens") * F.col("copies")), (mine, F.col("tokens"))))
    wanted = given.select(F.lit("source").alias("margin"), "name", "target_share")
    for c in ("lang", "topic"):
        wanted = wanted.unionByName(per(have, c, (F.sum("tokens") / own).alias("target_share")))
    found = got[0].unionByName(got[1]).unionByName(got[2])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return wanted.join(found, ["margin", "name"], "left").select(
        "margin", "name", F.round("target_share", 6).alias("target_share"), F.round(F.coalesce(F.col("tokens") / total, F.lit(0.0)), 6).alias("actual_share"),
        zero("documents"), zero("tokens"), zero("most_copies"),
    )
