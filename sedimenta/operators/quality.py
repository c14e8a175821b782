"""Completeness verdicts and precision and recall of facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import is_active_program, name_key, phase_identity

MIN_PRECISION = 0.95
MIN_RECALL = 0.90


def tolerance(expected: Column) -> Column:
    return F.greatest(F.lit(2), F.bround(expected * 0.1).cast("int"))


def verdict(assets: Column, programs: Column, expected: Column, known: Column, previous: Column) -> Column:
    """struct(verdict, confidence, best, action) of an extraction's counts.

    ``expected`` may count assets or programs, whichever is nearer (assets on a
    tie); only a known one can fail. Fewer than 60 % of a previous count of at
    least five fails whatever else holds.
    """
    best = F.when(F.abs(expected - programs) < F.abs(expected - assets), programs).otherwise(assets)
    delta = F.abs(expected - best)
    off = delta > tolerance(expected)
    none = assets == 0
    dropped = F.coalesce((previous >= 5) & (1 - assets / previous > 0.4), F.lit(False))
    has = expected.isNotNull()
    plain = F.when(none | (has & off & known), "fail").when(has & (delta > 0), "warn").otherwise("pass")
    sure = F.when(none, 0.98).when(has & off & known, 0.95).when(has & off, 0.80).when(has & (delta > 0), 0.88).otherwise(0.82)
    act = F.when(none, "rerender_and_reextract").when(has & off & known, "focused_reextract_missing_sections")
    return F.struct(
        F.when(dropped, "fail").otherwise(plain).alias("verdict"),
        F.when(dropped, F.greatest(sure, F.lit(0.93))).otherwise(sure).alias("confidence"),
        F.when(has, best).alias("best"),
        F.when(dropped, F.lit("rerender_with_repair_config")).otherwise(act).alias("action"),
    )


def merged(first: Column, second: Column) -> Column:
    """The worse of two verdicts (the first on a tie), the surer confidence, the first action."""
    rank = lambda v: F.when(v == "fail", 2).when(v == "warn", 1).otherwise(0)
    pick = F.when(rank(first["verdict"]) >= rank(second["verdict"]), first["verdict"]).otherwise(second["verdict"])
    both = F.struct(pick.alias("verdict"), F.greatest(first["confidence"], second["confidence"]).alias("confidence"), F.coalesce(first["action"], second["action"]).alias("action"))
    return F.when(second.isNull(), F.struct(first["verdict"].alias("verdict"), first["confidence"].alias("confidence"), first["action"].alias("action"))).otherwise(both)


def asset_facts(documents: DataFrame, active_only: bool = False) -> DataFrame:
    """doc, category, asset, value, detail: what nested assets state, each fact once.

    ``documents`` has doc and the columns of an extracted asset. Names become
    keys; a null modality or target states nothing.
    """
    programs = F.col("programs")
    rows = documents.withColumn("_programs", F.filter(programs, lambda p: is_active_program(p["status"], p["phase_verbatim"])) if active_only else programs)
    if active_only:
        rows = rows.where(F.size("_programs") > 0)
    none = F.lit("")
    fact = lambda c, v, d=none: F.struct(F.lit(c).alias("category"), v.alias("value"), d.alias("detail"))
    key = name_key(F.col("preferred_name"))
    simple = F.array_compact(
        F.array(
            fact("asset", none),
            F.when(F.col("modality_verbatim").isNotNull() & (F.col("modality_verbatim") != ""), fact("modality", name_key(F.col("modality_verbatim")))),
            F.when(F.col("target_verbatim").isNotNull() & (F.col("target_verbatim") != ""), fact("target", name_key(F.col("target_verbatim")))),
        )
    )
    empty = F.array().cast("array<struct<category:string,value:string,detail:string>>")
    of_programs = F.transform("_programs", lambda p: fact("program", name_key(p["indication_verbatim"])))
    of_phases = F.transform("_programs", lambda p: fact("phase", name_key(p["indication_verbatim"]), phase_identity(F.coalesce(p["phase_verbatim"], none))))
    of_partners = F.transform("partners", lambda p: fact("partner", name_key(p["name"])))
    facts = F.concat(simple, *[F.coalesce(x, empty) for x in (of_programs, of_phases, of_partners)])
    return rows.select("doc", key.alias("asset"), F.explode(facts).alias("f")).select("doc", "f.category", "asset", "f.value", "f.detail").distinct()


def scores(predicted: DataFrame, gold: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 of distinct facts ``keys``, per ``by``; empty denominators count as 1."""
    p = predicted.select(*keys).distinct().withColumn("_p", F.lit(1))
    g = gold.select(*keys).distinct().withColumn("_g", F.lit(1))
    both = p.join(g, keys, "full_outer")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    counted = both.groupBy(*by).agg(
        count(F.col("_p").isNotNull() & F.col("_g").isNotNull()).alias("tp"), count(F.col("_g").isNull()).alias("fp"), count(F.col("_p").isNull()).alias("fn")
    )
    share = lambda d: F.when(F.col("tp") + F.col(d) > 0, F.col("tp") / (F.col("tp") + F.col(d))).otherwise(1.0)
    counted = counted.withColumn("_pr", share("fp")).withColumn("_re", share("fn"))
    f1 = F.when(F.col("_pr") + F.col("_re") > 0, 2 * F.col("_pr") * F.col("_re") / (F.col("_pr") + F.col("_re"))).otherwise(0.0)
    return counted.select(*by, "tp", "fp", "fn", F.round("_pr", 4).alias("precision"), F.round("_re", 4).alias("recall"), F.round(f1, 4).alias("f1"))


def gate(scored: DataFrame) -> DataFrame:
    """``scored`` with whether it passes MIN_PRECISION and MIN_RECALL."""
    return scored.withColumn("passed", (F.col("precision") >= MIN_PRECISION) & (F.col("recall") >= MIN_RECALL))
