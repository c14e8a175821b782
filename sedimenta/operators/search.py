"""Faceted, lexical, vector and fused ranking."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RRF_K = 60
MIN_SIMILARITY = 0.05
VECTOR_TOP = 200


def faceted(programs: DataFrame, facets: dict[str, str | None], active_only: bool = False) -> DataFrame:
    """Programs that fit the facets that are given; ``active_only`` counts only without a status facet."""
    for column, value in facets.items():
        if value is not None:
            programs = programs.where(F.col(column) == value)
    if active_only and facets.get("status") is None:
        programs = programs.where(F.col("status") != "discontinued")
    return programs


def text_filter(programs: DataFrame, query: str, *columns: str) -> DataFrame:
    """Programs with the text in any of the columns, in any case; % and _ are wildcards."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).ilike(f"%{query}%"), F.lit(False))
    return programs.where(hit)


def lookup(rows: DataFrame, said: str, id_column: str, name: str) -> DataFrame:
    """The first row by name whose id or name is ``said``, or whose name contains it, in any case."""
    number = F.lit(said).try_cast("long") if dict(rows.dtypes)[id_column] != "string" else F.lit(said)
    hit = F.coalesce(F.col(id_column) == number, F.lit(False)) | (F.upper(name) == said.upper()) | F.col(name).ilike(f"%{said}%")
    return rows.where(hit).orderBy(name, id_column).limit(1)


#: Queries held by every worker at once; more of them are answered in several passes.
QUERIES_PER_PASS = 4_096
#: Rows scored against all queries of a pass at once.
ROWS_AT_ONCE = 1_024


def _passes(queries: DataFrame, per_pass: int) -> Iterator[pd.DataFrame]:
    """The queries in blocks of about ``per_pass``, each small enough to be held by every worker."""
    number = max(1, -(-queries.count() // per_pass))
    for i in range(number):
        yield queries.where(F.pmod(F.xxhash64("id"), F.lit(number)) == i).toPandas()


def _nearest(scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, query) of the ``top`` smallest scores of each query with all ties of the last."""
    if len(scores) <= top:
        return np.nonzero(np.isfinite(scores))
    edge = np.partition(scores, top - 1, axis=0)[top - 1]
    return np.nonzero((scores <= edge) & np.isfinite(scores))


def _answered(parts: list[DataFrame], top: int, score: str, *order: Column) -> DataFrame:
    """query, id, score, rank: what the batches kept, cut to ``top`` for each query."""
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    w = Window.partitionBy("query").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < top).select("query", "id", score, "rank")


def vector_search(rows: DataFrame, queries: DataFrame, top: int = VECTOR_TOP, per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """query, id, distance, rank of the ``top`` rows nearest to each query by cosine distance, then id.

    Both have id and embedding. Queries are taken in blocks against all rows:
    one scan a block, each batch keeping its nearest, of which a query's ranking
    sees at most a few per batch. Vectors without a length or of another length
    than the block's, and null ids, rank nowhere. No queries give no rows.
    """
    size = F.max(F.size("embedding"))
    wanted = queries.where(F.col("id").isNotNull() & F.col("embedding").isNotNull()).select("id", "embedding")
    width = wanted.agg(size).first()[0] or 0
    parts = []
    for block in _passes(wanted.where(F.size("embedding") == width), per_pass):
        ids = block["id"].to_list()
        matrix = np.array(block["embedding"].to_list(), dtype=float).reshape(len(ids), width)
        lengths = np.sqrt((matrix**2).sum(axis=1))

        def score(batches: Iterator[pd.DataFrame], ids: list = ids, matrix: np.ndarray = matrix, lengths: np.ndarray = lengths) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    few = batch.iloc[at : at + ROWS_AT_ONCE]
                    x = np.array(few["embedding"].to_list(), dtype=float)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        distance = np.round(1 - (x @ matrix.T) / np.sqrt((x**2).sum(axis=1))[:, None] / lengths[None, :], 9) + 0.0
                    r, q = _nearest(np.where(np.isnan(distance), np.inf, distance), top)
                    yield pd.DataFrame({"query": [ids[i] for i in q], "id": few["id"].to_numpy()[r], "distance": distance[r, q]})

        kept = rows.where(F.col("id").isNotNull() & (F.size("embedding") == width)).select(F.col("id").cast("long").alias("id"), "embedding")
        parts.append(kept.mapInPandas(score, "query long, id long, distance double"))
    return _answered(parts, top, "distance", F.col("distance"), F.col("id"))


def grams(text: str | None) -> set[str]:
    """3-grams of the words of a text, each padded by two blanks before and one after."""
    return {f"  {w} "[i : i + 3] for w in re.findall("[a-z0-9]+", (text or "").lower()) for i in range(len(w) + 1)}


def lexical_search(rows: DataFrame, queries: DataFrame, top: int = 100, per_pass: int = QUERIES_PER_PASS, least: float = MIN_SIMILARITY) -> DataFrame:
    """query, id, similarity, rank of the ``top`` rows most similar to each query by 3-grams, then by id.

    Both have id and text; similarities up to ``least`` don't count. Queries are
    taken in blocks, indexed by their 3-grams, against all rows: a row touches
    the queries it shares one with.
    """
    parts = []
    for block in _passes(queries.where(F.col("id").isNotNull()).select("id", "text"), per_pass):
        ids, sets = block["id"].to_list(), [grams(t) for t in block["text"]]
        index: dict[str, list[int]] = {}
        for i, own in enumerate(sets):
            for g in own:
                index.setdefault(g, []).append(i)
        sizes = np.array([len(x) for x in sets], dtype=float)

        def score(batches: Iterator[pd.DataFrame], ids: list = ids, index: dict = index, sizes: np.ndarray = sizes) -> Iterator[pd.DataFrame]:
            posts = {g: np.array(i) for g, i in index.items()}
            for batch in batches:
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    few = batch.iloc[at : at + ROWS_AT_ONCE]
                    shared = np.zeros((len(few), len(ids)))
                    own = np.zeros(len(few))
                    for r, text in enumerate(few["text"]):
                        found = grams(text)
                        own[r] = len(found)
                        for g in found:
                            if g in posts:
                                shared[r, posts[g]] += 1
                    similarity = np.round(shared / np.maximum(own[:, None] + sizes[None, :] - shared, 1), 9)
                    r, q = _nearest(np.where(similarity > least, -similarity, np.inf), top)
                    yield pd.DataFrame({"query": [ids[i] for i in q], "id": few["id"].to_numpy()[r], "similarity": similarity[r, q]})

        kept = rows.where(F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"), "text")
        parts.append(kept.mapInPandas(score, "query long, id long, similarity double"))
    return _answered(parts, top, "similarity", F.desc("similarity"), F.col("id"))


def fused_search(top: int, *rankings: DataFrame) -> DataFrame:
    """query, id, score, place of the ``top`` rows of each query by reciprocal rank fusion, then by id."""
    ranks = rankings[0].select("query", "id", "rank")
    for r in rankings[1:]:
        ranks = ranks.unionByName(r.select("query", "id", "rank"))
    scores = ranks.groupBy("query", "id").agg(F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 12).alias("score"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return scores.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def fused(candidates: DataFrame, *rankings: DataFrame) -> DataFrame:
    """id, score of all candidates by reciprocal rank fusion; those without a rank score 0."""
    if not rankings:
        return candidates.select("id", F.lit(0.0).alias("score"))
    ranks = rankings[0].select("id", "rank")
    for r in rankings[1:]:
        ranks = ranks.unionByName(r.select("id", "rank"))
    scores = ranks.groupBy("id").agg(F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 12).alias("score"))
    return candidates.select("id").join(scores, "id", "left").select("id", F.coalesce("score", F.lit(0.0)).alias("score"))
