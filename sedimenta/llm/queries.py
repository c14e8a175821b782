"""Queries of the problems on text and matches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.components import alias_groups
from sedimenta.llm.lexicon import PHRASES
from sedimenta.llm.mixing import drawn, share_report
from sedimenta.llm.names import banding_recall, name_clusters, variant_pairs
from sedimenta.llm.packing import packed, room_report
from sedimenta.llm.subjects import Scorer, makeup, mine_rules, subject_shares
from sedimenta.llm.tokens import count_tokens, with_token_counts
from sedimenta.llm.vocabulary import mapped_verbatims, misses
from sedimenta.session import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_pairs(cut(name_clusters(table(spark, d, "expected_asset"))))


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    """One row per name with its cluster: the compact form of p1_found."""
    return name_clusters(table(spark, d, "expected_asset"))


def p1_banding(spark: SparkSession, d: str) -> DataFrame:
    return banding_recall(table(spark, d, "expected_asset"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    mapping = mapped_verbatims(table(spark, d, "expected_asset"), table(spark, d, "vocab_entry"), PHRASES)
    return mapping.select("expected_id", "field", F.col("pos").cast("int").alias("pos"), "code")


def p5_misses(spark: SparkSession, d: str) -> DataFrame:
    return misses(mapped_verbatims(table(spark, d, "expected_asset"), table(spark, d, "vocab_entry"), PHRASES))


def p5_counted(spark: SparkSession, d: str) -> DataFrame:
    """Verbatims per field, all of which have one code."""
    mapping = mapped_verbatims(table(spark, d, "expected_asset"), table(spark, d, "vocab_entry"), PHRASES)
    return mapping.groupBy("field").agg(F.count(F.lit(1)).alias("verbatims"), F.countDistinct("expected_id").alias("rows"), F.count_if(F.col("code").isNull()).alias("without"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return alias_groups(table(spark, d, "curated_aliases"), table(spark, d, "alias_pair"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return with_token_counts(table(spark, d, "documents"), "doc_id long")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packed(_sizes(spark, d), table(spark, d, "pack_capacity"))


def p8_placed(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity the documents placed, those with several places, and overfull containers."""
    placed = packed(_sizes(spark, d), table(spark, d, "pack_capacity"))
    capacities = table(spark, d, "pack_capacity").where(F.col("capacity_tokens") > 0).distinct()
    fill = placed.groupBy("capacity_id", "container").agg(F.sum("tokens").alias("fill")).join(F.broadcast(capacities), "capacity_id")
    over = fill.groupBy("capacity_id").agg(F.count_if(F.col("fill") > F.col("capacity_tokens")).alias("overfull"))
    docs = placed.groupBy("capacity_id").agg(F.countDistinct("doc_id").alias("documents"))
    return docs.join(over, "capacity_id")


def p8_room(spark: SparkSession, d: str) -> DataFrame:
    return room_report(_sizes(spark, d), table(spark, d, "pack_capacity"))


def _described(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, lang, topic (the main area), tokens of all documents; every text is read once."""
    documents = table(spark, d, "documents")
    rules = mine_rules(documents, table(spark, d, "subject_label"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(rules)
        for batch in batches:
            topics = [scorer.areas(t)[0][0] for t in batch["text"]]
            yield batch.drop(columns="text").assign(topic=topics, tokens=[count_tokens(t) for t in batch["text"]])

    return cut(documents.select("doc_id", "source", "lang", "text").mapInPandas(describe, "doc_id long, source string, lang string, topic string, tokens long"))


def p9_drawn(spark: SparkSession, d: str) -> DataFrame:
    return drawn(_described(spark, d), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    described, targets = _described(spark, d), table(spark, d, "mix_target")
    return share_report(cut(drawn(described, targets)), described, targets)


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per target source whether its documents are there and drawn, and whether any is used too often."""
    described, targets = _described(spark, d), table(spark, d, "mix_target")
    got = drawn(described, targets).groupBy("source").agg(F.max("copies").alias("most"))
    have = described.where("tokens > 0").groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    return targets.distinct().join(have, "source", "left").join(got, "source", "left").select(
        "source", F.coalesce("documents", F.lit(0)).alias("documents"), F.col("most").isNotNull().alias("used"), F.coalesce(F.col("most") > F.col("max_repeats"), F.lit(False)).alias("too_often")
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subject_shares(table(spark, d, "documents"), table(spark, d, "subject_label")).select("doc_id", "area")


def p10_covered(spark: SparkSession, d: str) -> DataFrame:
    """Documents with areas, and how many empty ones aren't 'other'."""
    shares = subject_shares(table(spark, d, "documents"), table(spark, d, "subject_label"))
    empty = table(spark, d, "documents").where(F.coalesce("text", F.lit("")) == "").select("doc_id", F.lit(True).alias("empty"))
    rows = shares.join(empty, "doc_id", "left")
    return rows.agg(
        F.countDistinct("doc_id").alias("documents"), F.count_if(F.col("empty") & (F.col("area") == "other")).alias("empty_other"), F.count_if(F.col("empty") & (F.col("area") != "other")).alias("empty_else")
    )


def p10_makeup(spark: SparkSession, d: str) -> DataFrame:
    return makeup(subject_shares(table(spark, d, "documents"), table(spark, d, "subject_label")))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_members, p1_banding, p5_found, p5_misses, p5_counted, p7_found, p8_packed, p8_placed, p8_room, p9_drawn, p9_shares, p9_kept, p10_found, p10_covered, p10_makeup)
}

SQL = {
    "p5_counted": """
WITH x AS (SELECT DISTINCT expected_id, programs, modality_verbatim FROM expected_asset WHERE expected_id IS NOT NULL),
p AS (SELECT expected_id, unnest(programs) AS p, generate_subscripts(programs, 1) AS pos FROM x),
v AS (SELECT expected_id, 'phase' AS field, pos, p.phase_verbatim AS v FROM p UNION ALL SELECT expected_id, 'indication', pos, p.indication_verbatim FROM p
 UNION ALL SELECT expected_id, 'modality', 1, modality_verbatim FROM x)
SELECT field, count(*) AS verbatims, count(DISTINCT expected_id) AS rows, 0::BIGINT AS without FROM v WHERE regexp_matches(v, '[^\\s\\x{a0}]') GROUP BY 1
""",
    "p8_placed": """
SELECT capacity_id, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0::BIGINT AS overfull
FROM (SELECT DISTINCT capacity_id FROM pack_capacity WHERE capacity_tokens > 0)
""",
    "p10_covered": """
SELECT count(DISTINCT doc_id) AS documents, count(*) FILTER (WHERE coalesce(text, '') = '') AS empty_other, 0::BIGINT AS empty_else FROM documents
""",
    "p9_kept": """
WITH h AS (SELECT source, count(*) AS documents FROM documents WHERE text <> '' AND source IS NOT NULL GROUP BY 1)
SELECT DISTINCT t.source, coalesce(h.documents, 0) AS documents, h.documents IS NOT NULL AND target_share > 0 AS used, false AS too_often
FROM mix_target t LEFT JOIN h USING (source)
""",
    "p7_found": """
WITH RECURSIVE s AS (
  SELECT DISTINCT alias_row_id AS id, x FROM (
    SELECT alias_row_id, canonical AS x FROM curated_aliases
    UNION ALL SELECT alias_row_id, unnest(members) FROM curated_aliases) WHERE x IS NOT NULL AND alias_row_id IS NOT NULL),
hub AS (SELECT x, min(id) AS h FROM s GROUP BY 1),
ids AS (SELECT DISTINCT alias_row_id AS id FROM curated_aliases WHERE alias_row_id IS NOT NULL),
e AS (
  SELECT DISTINCT id AS a, h AS b FROM s JOIN hub USING (x) WHERE id <> h
  UNION SELECT left_id, right_id FROM alias_pair WHERE status = 'accepted' AND left_id IN (SELECT id FROM ids) AND right_id IN (SELECT id FROM ids)),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT id AS src, id AS dst FROM ids UNION SELECT reach.src, g.b FROM reach JOIN g ON reach.dst = g.a)
SELECT src AS alias_row_id, min(dst) AS group_id FROM reach GROUP BY 1
""",
}
