"""Change feed of capture sequences, with a guard against bad captures and confirmed exits.

Captures of a group are replayed in order. A capture with fewer assets than
DROP of the median of the last accepted four is set aside. Over the accepted
ones, what an asset did follows from its own rows and their places in the
sequence: a gap of CONFIRM_N places or more is an exit and a return, a shorter
one is nothing. So the feed is a window over (group, asset), whatever the number
of assets of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import cut

# ---- fixed values: order and labels of the phases ----
PHASE_ORDER = {"preclinical": 10, "phase_1": 20, "phase_1_2": 25, "phase_2": 30, "phase_2_3": 35, "phase_3": 40, "filed": 50, "approved": 60, "discontinued": 70}
PHASE_LABELS = {
    "preclinical": "Preclinical", "phase_1": "Phase 1", "phase_1_2": "Phase 1/2", "phase_2": "Phase 2", "phase_2_3": "Phase 2/3",
    "phase_3": "Phase 3", "filed": "Filed / Registration", "approved": "Approved / Marketed", "discontinued": "Discontinued",
}
# ---- end of fixed values ----
CONFIRM_N = 2
DROP = 0.6
TRAIL = 4
SCHEMA = (
    "group string, type string, asset_id string, asset string, period string, eff_min timestamp_ntz, eff_max timestamp_ntz, status string, "
    "from_phase string, to_phase string, direction string, last_phase string, exit_class string, partner string"
)


def _mapped(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def phase_label(code: Column) -> Column:
    return F.coalesce(_mapped(PHASE_LABELS, code), code)


def phase_order(code: Column) -> Column:
    return F.coalesce(_mapped(PHASE_ORDER, code), F.lit(0))


def exit_class(code: Column) -> Column:
    return (
        F.when(code.isin("filed", "approved"), "likely_approved_graduated")
        .when(code == "phase_3", "late_stage_exit_ambiguous")
        .otherwise("likely_discontinued_early")
    )


def guarded_captures(observations: DataFrame) -> DataFrame:
    """group, capture_id, captured_at, period, assets, trail_median, accepted, place (among the accepted, from 0).

    The guard depends on which captures it accepted before, so each group's
    sequence of counts (a few numbers per capture, no assets) is folded in one
    expression.
    """
    counts = observations.groupBy("group", "capture_id").agg(
        F.min("captured_at").alias("captured_at"), F.max("period").alias("period"), F.countDistinct("asset_id").alias("assets")
    )
    row = F.struct("captured_at", "capture_id", "period", F.col("assets").cast("int").alias("assets"))
    series = counts.groupBy("group").agg(F.array_sort(F.collect_list(row)).alias("series"))
    flag = "struct<captured_at:timestamp_ntz,capture_id:string,period:string,assets:int,trail_median:double,accepted:boolean>"
    start = F.struct(F.array().cast("array<int>").alias("last"), F.array().cast(f"array<{flag}>").alias("out"))

    def median(xs: Column) -> Column:
        s, n = F.array_sort(xs), F.size(xs)
        high = F.get(s, F.floor(n / 2).cast("int")).cast("double")
        low = F.get(s, (F.floor((n - 1) / 2)).cast("int")).cast("double")
        return (low + high) / 2

    def step(acc: Column, x: Column) -> Column:
        trail = F.when(F.size(acc["last"]) > 0, median(acc["last"]))
        ok = trail.isNull() | (x["assets"] == 0) | (x["assets"] >= DROP * trail)
        grown = F.concat(acc["last"], F.array(x["assets"]))
        kept = F.when(F.size(grown) > TRAIL, F.slice(grown, -TRAIL, TRAIL)).otherwise(grown)
        made = F.struct(x["captured_at"].alias("captured_at"), x["capture_id"].alias("capture_id"), x["period"].alias("period"), x["assets"].alias("assets"), trail.alias("trail_median"), ok.alias("accepted"))
        return F.struct(F.when(ok, kept).otherwise(acc["last"]).alias("last"), F.concat(acc["out"], F.array(made)).alias("out"))

    flags = series.select("group", F.explode(F.aggregate("series", start, step)["out"]).alias("c")).select("group", "c.*")
    order = Window.partitionBy("group").orderBy("captured_at", "capture_id")
    return flags.withColumn("place", F.when(F.col("accepted"), F.sum(F.col("accepted").cast("int")).over(order) - 1))


def change_feed(observations: DataFrame, confirm_n: int = CONFIRM_N) -> DataFrame:
    """Events in the form of SCHEMA, from rows (group, capture_id, captured_at, period, asset_id, name, phase_code, partners).

    One row per capture and asset is expected. Null partners count as none.
    """
    captures = cut(guarded_captures(observations.select("group", "capture_id", "captured_at", "period", "asset_id")).where("accepted"))  # a row per capture, used three times
    order = Window.partitionBy("group").orderBy("place")
    slots = captures.select(
        "group", "capture_id", "place", "period", F.max("place").over(Window.partitionBy("group")).alias("last_place"),
        F.lead("captured_at").over(order).alias("next_at"), F.lead("period").over(order).alias("next_period"),
    )
    rows = observations.select("group", "capture_id", "captured_at", "asset_id", "name", "phase_code", F.array_sort(F.coalesce("partners", F.array().cast("array<string>"))).alias("partners"))
    seen = rows.join(slots, ["group", "capture_id"])
    w = Window.partitionBy("group", "asset_id").orderBy("place")
    obs = F.struct("place", "captured_at", "phase_code", "partners")
    seen = seen.withColumn("p", F.lag(obs).over(w)).withColumn("next", F.lead("place").over(w))
    p, t = F.col("p"), lambda: F.lit(None).cast("timestamp_ntz")
    s = lambda: F.lit(None).cast("string")

    def event(kind: str, **given: Column) -> Column:
        defaults = {"period": F.col("period"), "eff_min": t(), "eff_max": F.col("captured_at"), "status": F.lit("confirmed"), "from_phase": s(), "to_phase": s(), "direction": s(), "last_phase": s(), "exit_class": s(), "partner": s()}
        return F.struct(F.lit(kind).alias("type"), *[c.alias(n) for n, c in {**defaults, **given}.items()])

    back = p.isNotNull() & (F.col("place") - p["place"] > confirm_n)
    steady = p.isNotNull() & ~back
    moved = steady & F.col("phase_code").isNotNull() & ~F.col("phase_code").eqNullSafe(p["phase_code"])
    old, new = phase_order(p["phase_code"]), phase_order(F.col("phase_code"))
    direction = F.when(new > old, "advance").when(new < old, "regress").otherwise("lateral")
    partners = lambda kind, gone, came: F.when(steady, F.transform(F.array_except(came, gone), lambda x: event(kind, partner=x))).otherwise(F.array())
    inside = F.concat(
        F.array_compact(
            F.array(
                F.when(p.isNull() & (F.col("place") > 0), event("asset_added", to_phase=phase_label(F.col("phase_code")))),
                F.when(back, event("asset_reappeared", eff_min=p["captured_at"])),
                F.when(moved, event("asset_phase_changed", eff_min=p["captured_at"], from_phase=phase_label(p["phase_code"]), to_phase=phase_label(F.col("phase_code")), direction=direction)),
            )
        ),
        partners("partner_added", p["partners"], F.col("partners")),
        partners("partner_removed", F.col("partners"), p["partners"]),
    )
    cols = ["group", "asset_id", F.col("name").alias("asset")]
    # A row followed by absence: the capture after it, joined as one small row per capture, names and dates the exit.
    away = F.coalesce("next", F.col("last_place") + 1) - F.col("place") - 1
    gone = (away >= confirm_n) | (F.col("next").isNull() & (away > 0))
    left = event(
        "asset_left_pipeline", period=F.col("next_period"), eff_min=F.col("captured_at"), eff_max=F.col("next_at"),
        status=F.when(away >= confirm_n, "confirmed").otherwise("provisional"),
        last_phase=phase_label(F.col("phase_code")), exit_class=exit_class(F.col("phase_code")),
    )
    told = F.concat(inside, F.array_compact(F.array(F.when(gone, left))))
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return seen.select(*cols, F.explode(told).alias("e")).select("group", "asset_id", "asset", "e.*").select(*names)
