"""Queries of the loaded entities: programs and versions, search, hierarchies, edges, captures, details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions import text as tx
from sedimenta.operators import graph, history, identity, search
from sedimenta.plans.catalogue import _KEY, _PRECLEAN, _PROGRAM, _phases, _programs, _vocab, query
from sedimenta.session import cut, table

AT = "2022-06-30 00:00:00"
GOLD_KEYS = ["company_id", "asset", "indication"]
_AREA_SQL = "CASE " + " ".join(f"WHEN regexp_matches({{c}}, '{p}', 'i') THEN '{label}'" for label, p in tx.AREA_RULES) + f" ELSE '{tx.AREA_OTHER}' END"


def _words(s: SparkSession, d: str, vocab: str) -> DataFrame:
    """word, code: labels, aliases and codes of one vocabulary in lower case; a fixed list, broadcast by size."""
    said = _vocab(s, d, vocab).select("code", F.explode(F.concat("aliases", F.array("label", F.replace("code", F.lit("_"), F.lit(" "))))).alias("w"))
    return said.groupBy(F.lower("w").alias("word")).agg(F.min("code").alias("code"))


def gold_rows(s: SparkSession, d: str) -> DataFrame:
    """Nested documents as observations of programs: keys, verbatims and their normal forms."""
    a = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).distinct()
    rows = a.select(
        "expected_id", "company_id", "snapshot_id", "captured_at", "loaded_at", "preferred_name", tx.name_key(F.col("preferred_name")).alias("asset"), F.posexplode("programs").alias("pos", "p")
    ).select("*", "p.indication_verbatim", "p.phase_verbatim", F.col("p.status").alias("said"), tx.name_key(F.col("p.indication_verbatim")).alias("indication")).drop("p")
    rows = rows.where((F.col("asset") != "") & (F.col("indication") != "")).withColumn("core", tx.preclean(F.col("phase_verbatim")))
    coded = rows.join(_words(s, d, "phase").withColumnRenamed("code", "phase_code"), F.col("core") == F.col("word"), "left")
    return coded.withColumn("status", tx.development_status(F.col("said"), F.col("phase_verbatim"), F.col("phase_code"))).drop("core", "word", "said")


_GOLD = f"""words AS (SELECT vocab, lower(w) AS word, min(code) AS code FROM (SELECT vocab, code, unnest(list_concat(aliases, [label, replace(code, '_', ' ')])) AS w FROM vocab_entry) GROUP BY 1, 2),
a AS (SELECT DISTINCT * FROM expected_asset WHERE preferred_name IS NOT NULL),
px AS (SELECT expected_id, company_id, snapshot_id, captured_at, loaded_at, preferred_name, {_KEY.format(c='preferred_name')} AS asset, unnest(programs) AS p, generate_subscripts(programs, 1) - 1 AS pos FROM a),
pk AS (SELECT *, p.indication_verbatim AS indication_verbatim, p.phase_verbatim AS phase_verbatim, coalesce({_KEY.format(c='p.indication_verbatim')}, '') AS indication, {_PRECLEAN.format(c='p.phase_verbatim')} AS core FROM px),
g AS (SELECT pk.*, w.code AS phase_code, CASE WHEN w.code = 'discontinued' OR regexp_matches(lower(coalesce(p.status, '') || ' ' || coalesce(phase_verbatim, '')), '{tx.ENDED_WORDS}') THEN 'discontinued'
 WHEN regexp_matches(lower(coalesce(p.status, '') || ' ' || coalesce(phase_verbatim, '')), '{tx.PAUSED_WORDS}') THEN 'paused' ELSE 'active' END AS status
 FROM pk LEFT JOIN words w ON w.vocab = 'phase' AND w.word = pk.core WHERE asset <> '' AND indication <> ''),
obs AS (SELECT * FROM g WHERE captured_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company_id, asset, indication, captured_at ORDER BY loaded_at DESC NULLS LAST, expected_id DESC, pos DESC) = 1),
og AS (SELECT *, lag(phase_code) OVER w AS pp, lag(status) OVER w AS ps FROM obs WINDOW w AS (PARTITION BY company_id, asset, indication ORDER BY captured_at)),
ver AS (SELECT company_id, asset, indication, phase_code, status, captured_at AS valid_from, lead(captured_at) OVER (PARTITION BY company_id, asset, indication ORDER BY captured_at) AS valid_to
 FROM og WHERE ps IS NULL OR ps <> status OR pp IS DISTINCT FROM phase_code)"""


def _observed(s: SparkSession, d: str) -> DataFrame:
    """One observation per program and time, the one loaded last; kept, as histories and what was last seen both need it."""
    said = ["preferred_name", "phase_code", "status", "indication_verbatim", "phase_verbatim", "snapshot_id"]
    last = F.max_by(F.struct(*said), F.struct("loaded_at", "expected_id", "pos"))
    return gold_rows(s, d).where(F.col("captured_at").isNotNull()).groupBy(*GOLD_KEYS, "captured_at").agg(last.alias("m")).select(*GOLD_KEYS, "captured_at", "m.*").transform(cut)


@query(f"WITH {_GOLD} SELECT * FROM ver")
def loaded_versions(s: SparkSession, d: str) -> DataFrame:
    """The loader: documents normalised into programs with versions of phase and status; loading twice changes nothing."""
    return history.build_history(_observed(s, d), GOLD_KEYS, ["phase_code", "status"], "captured_at")


_ASSET_DIM = f"""dim AS (SELECT {_KEY.format(c='preferred_name')} AS asset, min(preferred_name) AS asset_name, arg_min(modality_verbatim, (expected_id)) FILTER (WHERE modality_verbatim <> '') AS modality_verbatim,
 arg_min(mechanism_verbatim, (expected_id)) FILTER (WHERE mechanism_verbatim <> '') AS mechanism_verbatim, string_agg(DISTINCT upper(target_verbatim), ', ' ORDER BY upper(target_verbatim)) FILTER (WHERE target_verbatim <> '') AS target_symbols,
 max(CASE WHEN target_verbatim <> '' THEN 'disclosed' END) AS target_source FROM a GROUP BY 1)"""


def asset_dimension(s: SparkSession, d: str) -> DataFrame:
    """One row per asset: name, first modality and mechanism given (what is there stays), targets."""
    a = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).withColumn("asset", tx.name_key(F.col("preferred_name")))
    given = lambda c: F.min_by(c, F.when(F.col(c) != "", F.col("expected_id"))).alias(c)
    target = F.when(F.col("target_verbatim") != "", F.upper("target_verbatim"))
    found = F.array_join(F.sort_array(F.collect_set(target)), ", ")
    return a.groupBy("asset").agg(
        F.min("preferred_name").alias("asset_name"), given("modality_verbatim"), given("mechanism_verbatim"), F.when(F.count(target) > 0, found).alias("target_symbols"), F.max(F.when(target.isNotNull(), "disclosed")).alias("target_source")
    )


_BASE = f"""WITH {_GOLD}, {_ASSET_DIM},
cur AS (SELECT * FROM ver WHERE {{open}}), ph AS (SELECT code AS phase_code, label AS phase_label, sort_order FROM vocab_entry WHERE vocab = 'phase'),
lo AS (SELECT * FROM obs WHERE {{seen}} QUALIFY row_number() OVER (PARTITION BY company_id, asset, indication ORDER BY captured_at DESC) = 1),
base AS (SELECT cur.company_id, cur.asset, asset_name, mw.code AS modality_code, modality_verbatim, mechanism_verbatim, target_symbols, target_source, cur.indication, iv.label AS indication_label, indication_verbatim,
 cur.phase_code, phase_label, ph.sort_order, phase_verbatim, cur.status, iw.code AS mapping_code, {_AREA_SQL.format(c="concat_ws(' ', iv.label, indication_verbatim)")} AS therapeutic_area, NULL::VARCHAR AS ticker, NULL::VARCHAR AS source_url,
 lo.captured_at AS fetched_at, snapshot_id, cur.valid_from, cur.valid_to
 FROM cur JOIN lo USING (company_id, asset, indication) JOIN dim ON dim.asset = cur.asset LEFT JOIN ph ON ph.phase_code = cur.phase_code
 LEFT JOIN words iw ON iw.vocab = 'indication' AND iw.word = lower(indication_verbatim) LEFT JOIN vocab_entry iv ON iv.vocab = 'indication' AND iv.code = iw.code
 LEFT JOIN words mw ON mw.vocab = 'modality' AND mw.word = lower(modality_verbatim))"""
_NOW = _BASE.replace("{open}", "valid_to IS NULL").replace("{seen}", "true")
_THEN = _BASE.replace("{open}", f"valid_from <= TIMESTAMP '{AT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AT}')").replace("{seen}", f"captured_at <= TIMESTAMP '{AT}'")


def program_base(s: SparkSession, d: str, at: str | None = None) -> DataFrame:
    """The base of program queries: the version current now, or open at ``at``, with what was last seen until then."""
    observed = _observed(s, d)
    versions = history.build_history(observed, GOLD_KEYS, ["phase_code", "status"], "captured_at")
    when = F.lit(at).cast("timestamp_ntz")
    current = versions.where(F.col("valid_to").isNull()) if at is None else history.as_of(versions, when)
    seen = observed if at is None else observed.where(F.col("captured_at") <= when)
    last = F.max_by(F.struct("indication_verbatim", "phase_verbatim", F.col("captured_at").alias("fetched_at"), "snapshot_id"), "captured_at")
    rows = current.join(seen.groupBy(*GOLD_KEYS).agg(last.alias("m")), GOLD_KEYS).join(asset_dimension(s, d), "asset").join(_phases(s, d).withColumnRenamed("phase", "phase_code"), "phase_code", "left")
    mapping = _words(s, d, "indication").select(F.col("word").alias("_i"), F.col("code").alias("mapping_code"))
    labels = _vocab(s, d, "indication").select(F.col("code").alias("mapping_code"), F.col("label").alias("indication_label"))
    modality = _words(s, d, "modality").select(F.col("word").alias("_m"), F.col("code").alias("modality_code"))
    rows = rows.join(mapping, F.lower("m.indication_verbatim") == F.col("_i"), "left").join(labels, "mapping_code", "left").join(modality, F.lower("modality_verbatim") == F.col("_m"), "left")
    none = lambda c: F.lit(None).cast("string").alias(c)
    return rows.select(
        *GOLD_KEYS, "asset_name", "modality_code", "modality_verbatim", "mechanism_verbatim", "target_symbols", "target_source", "indication_label", "m.indication_verbatim",
        "phase_code", "phase_label", "sort_order", "m.phase_verbatim", "status", "mapping_code", tx.therapeutic_area(F.col("indication_label"), F.col("m.indication_verbatim")).alias("therapeutic_area"),
        none("ticker"), none("source_url"), "m.fetched_at", "m.snapshot_id", "valid_from", "valid_to",
    )


@query(_NOW + " SELECT * FROM base")
def current_program_base(s: SparkSession, d: str) -> DataFrame:
    return program_base(s, d)


@query(_THEN + " SELECT * FROM base")
def program_base_as_of(s: SparkSession, d: str) -> DataFrame:
    return program_base(s, d, AT)


_FIELDS = ["asset_name", "mechanism_verbatim", "indication_verbatim", "target_symbols", "indication_label"]
_PAGE = "company_id, asset, indication, asset_name, phase_code, status, therapeutic_area"
_TEXT_HIT = "(" + " OR ".join(f"{c} ILIKE '%{{q}}%'" for c in _FIELDS) + " OR asset IN (SELECT {key} FROM (SELECT preferred_name, unnest(synonyms) AS x FROM a) WHERE x ILIKE '%{{q}}%'))".format(key=_KEY.format(c="preferred_name"))


def _synonym_assets(s: SparkSession, d: str, q: str) -> DataFrame:
    a = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull() & F.exists("synonyms", lambda x: x.ilike(f"%{q}%")))
    return a.select(tx.name_key(F.col("preferred_name")).alias("asset"), F.lit(True).alias("_syn")).distinct()


def _with_text(s: SparkSession, d: str, rows: DataFrame, q: str) -> DataFrame:
    """Rows with the text in one of five fields or in a synonym of their asset: an existence flag under OR."""
    hit = F.coalesce("_syn", F.lit(False))
    for c in _FIELDS:
        hit = hit | F.coalesce(F.col(c).ilike(f"%{q}%"), F.lit(False))
    return rows.join(_synonym_assets(s, d, q), "asset", "left").where(hit).drop("_syn")


@query(f"""{_NOW}, hits AS (SELECT * FROM base WHERE status <> 'discontinued' AND {_TEXT_HIT.format(q='cancer')}), n AS (SELECT count(*) AS total FROM hits)
SELECT total, {_PAGE} FROM (SELECT * FROM hits ORDER BY sort_order DESC NULLS LAST, asset_name, company_id, asset, indication LIMIT 25 OFFSET 10), n""")
def program_search_page(s: SparkSession, d: str) -> DataFrame:
    """Faceted search with its total and one page."""
    hits = cut(_with_text(s, d, search.faceted(program_base(s, d), {}, active_only=True), "cancer").select("sort_order", *_PAGE.split(", ")))
    page = hits.orderBy(F.desc_nulls_last("sort_order"), "asset_name", *GOLD_KEYS).offset(10).limit(25)
    return page.select(F.lit(hits.count()).cast("long").alias("total"), *_PAGE.split(", "))


@query(f"""{_NOW} SELECT total, {_PAGE}, place FROM (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY CASE phase_code WHEN 'discontinued' THEN 0 ELSE coalesce(sort_order, -1) END DESC, asset_name, company_id, asset, indication) AS place FROM base) WHERE place <= 50""")
def structured_browse(s: SparkSession, d: str) -> DataFrame:
    """Programs without a query text: by phase (discontinued last but for none), name and key."""
    rank = F.when(F.col("phase_code") == "discontinued", 0).otherwise(F.coalesce("sort_order", F.lit(-1)))
    base = cut(program_base(s, d).select("sort_order", *_PAGE.split(", ")))
    order = [F.desc("rank"), F.col("asset_name"), *[F.col(k) for k in GOLD_KEYS]]
    top = base.withColumn("rank", rank).orderBy(*order).limit(50)
    placed = top.withColumn("place", F.row_number().over(Window.orderBy(*order)))  # of 50 rows
    return placed.select(F.lit(base.count()).cast("long").alias("total"), *_PAGE.split(", "), "place")


@query(f"""{_NOW} SELECT {_PAGE} FROM base WHERE asset IN (SELECT {_KEY.format(c='preferred_name')} FROM a WHERE target_verbatim ILIKE '%SYG1%' OR mechanism_verbatim ILIKE '%SYG1%' OR len(list_filter(synonyms, lambda x: x ILIKE '%SYG1%')) > 0) AND status <> 'discontinued'""")
def programs_by_target(s: SparkSession, d: str) -> DataFrame:
    """Programs of all assets that hit a gene by target, mechanism or synonym."""
    like = lambda c: F.coalesce(c.ilike("%SYG1%"), F.lit(False))
    hit = like(F.col("target_verbatim")) | like(F.col("mechanism_verbatim")) | F.coalesce(F.exists("synonyms", lambda x: x.ilike("%SYG1%")), F.lit(False))
    assets = table(s, d, "expected_asset").where(hit).select(tx.name_key(F.col("preferred_name")).alias("asset")).distinct()
    return search.faceted(program_base(s, d), {}, active_only=True).join(assets, "asset", "left_semi").select(*_PAGE.split(", "))


# ---- hierarchy of indications: root, therapeutic area, indication ----

_TREE = f"""i AS (SELECT code, label, {_AREA_SQL.format(c='label')} AS area FROM vocab_entry WHERE vocab = 'indication'),
clo AS (SELECT 'disease' AS ancestor, 'disease' AS descendant, 0 AS depth UNION ALL SELECT DISTINCT area, area, 0 FROM i UNION ALL SELECT code, code, 0 FROM i UNION ALL SELECT DISTINCT 'disease', area, 1 FROM i
 UNION ALL SELECT area, code, 1 FROM i UNION ALL SELECT 'disease', code, 2 FROM i)"""


def _tree(s: SparkSession, d: str) -> DataFrame:
    """Closure of root, areas and indications."""
    areas = _vocab(s, d, "indication").select("code", tx.therapeutic_area(F.col("label")).alias("area"))
    edges = areas.select(F.lit("disease").alias("parent"), F.col("area").alias("child")).unionByName(areas.select(F.col("area").alias("parent"), F.col("code").alias("child"))).distinct()
    return graph.closure(edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct(), edges)


_ADJ = """adj AS (SELECT descendant AS node, CASE WHEN depth = 0 THEN 'exact' ELSE 'descendant' END AS relation, depth AS distance FROM clo WHERE ancestor = '{node}'
 UNION ALL SELECT ancestor, 'ancestor', depth FROM clo WHERE descendant = '{node}' AND depth BETWEEN 1 AND 2)"""


@query(f"""WITH {_PROGRAM}, {_TREE}, {_ADJ.format(node='Oncology')}
SELECT version_id, program_id, indication_id, relation, distance, row_number() OVER (ORDER BY CASE relation WHEN 'exact' THEN 0 WHEN 'descendant' THEN 1 ELSE 2 END, distance, version_id) AS place
FROM prog JOIN adj ON node = indication_id WHERE valid_to IS NULL AND status <> 'discontinued' QUALIFY place <= 500""")
def programs_by_disease(s: SparkSession, d: str) -> DataFrame:
    """Programs of an indication or one near it in the hierarchy; ranked, then the first 500."""
    near = graph.adjacent(_tree(s, d), "Oncology").withColumnRenamed("node", "indication_id")
    rows = search.faceted(_programs(s, d).where(F.col("valid_to").isNull()), {}, active_only=True).join(near, "indication_id")
    order = [graph.relation_rank(F.col("relation")), F.col("distance"), F.col("version_id")]
    top = rows.orderBy(*order).limit(500)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).select("version_id", "program_id", "indication_id", "relation", "distance", "place")


@query(f"""WITH {_PROGRAM}, {_TREE}, node AS (SELECT coalesce((SELECT min(code) FROM i WHERE lower(label) = 'heart failure'), (SELECT min(area) FROM i WHERE lower(area) = 'heart failure')) AS node),
near AS (SELECT descendant AS n FROM clo, node WHERE ancestor = node UNION SELECT ancestor FROM clo, node WHERE descendant = node AND depth BETWEEN 1 AND 2)
SELECT version_id, program_id, indication_id FROM prog WHERE valid_to IS NULL AND status <> 'discontinued' AND (indication_id IN (SELECT n FROM near) OR indication ILIKE '%heart failure%' OR indication_verbatim ILIKE '%heart failure%')""")
def programs_by_disease_name(s: SparkSession, d: str) -> DataFrame:
    """A disease by name: its code and those near it, or a label that contains the name."""
    name = "heart failure"
    found = _vocab(s, d, "indication").where(F.lower("label") == name).agg(F.min("code")).first()[0] or name
    near = graph.adjacent(_tree(s, d), found).select(F.col("node").alias("indication_id"), F.lit(True).alias("_near"))
    rows = search.faceted(_programs(s, d).where(F.col("valid_to").isNull()), {}, active_only=True).join(near, "indication_id", "left")
    said = F.col("indication").ilike(f"%{name}%") | F.col("indication_verbatim").ilike(f"%{name}%")
    return rows.where(F.coalesce("_near", F.lit(False)) | F.coalesce(said, F.lit(False))).select("version_id", "program_id", "indication_id")


@query(f"WITH {_TREE} SELECT i.code AS node, i.label, list_sort(list(c.ancestor)) AS ancestors FROM i JOIN clo c ON c.descendant = i.code GROUP BY 1, 2")
def indication_ancestors(s: SparkSession, d: str) -> DataFrame:
    """Each indication with all its ancestors, itself included."""
    up = _tree(s, d).groupBy(F.col("descendant").alias("node")).agg(F.array_sort(F.collect_list("ancestor")).alias("ancestors"))
    return _vocab(s, d, "indication").select(F.col("code").alias("node"), "label").join(up, "node")


@query("""WITH RECURSIVE e AS (SELECT 's' || s_suppkey AS child, 'n' || s_nationkey AS parent FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region),
w AS (SELECT child AS node, 0 AS depth FROM e WHERE child IN ('s3', 's5', 's8') UNION ALL SELECT e.parent, w.depth + 1 FROM w JOIN e ON e.child = w.node WHERE w.depth < 6 AND w.node <> 'r1' AND e.parent <> 'world')
SELECT node, min(depth)::INT AS depth FROM w GROUP BY 1""")
def upward_walk(s: SparkSession, d: str) -> DataFrame:
    """Terms reached upwards from seeds in breadth, to a depth, not beyond stop nodes and never into excluded ones."""
    from sedimenta.plans.catalogue import _geo

    seeds = s.createDataFrame([("s3",), ("s5",), ("s8",)], "node string")
    return graph.walk_up(seeds, _geo(s, d)[1], max_depth=6, max_nodes=4_000, stop=["r1"], keep=lambda node: node != "world")


# ---- edges between programs, as memberships of groups ----


@query("""WITH pc AS (SELECT program_id, list_sort(list_distinct(list(indication_id))) AS inds, list_sort(list_distinct(list(company_id))) AS comps FROM program_indication WHERE program_id IS NOT NULL GROUP BY 1),
b AS (SELECT program_id, min(born_on) AS born_on FROM program_born_on GROUP BY 1),
r AS (SELECT 'mechanism' AS kind, 1.0::DOUBLE AS weight, unnest(comps) AS key, program_id AS member, []::VARCHAR[] AS apart FROM pc UNION ALL SELECT 'competitive', 0.7, unnest(inds), program_id, comps FROM pc)
SELECT r.kind, weight, r.key, member, apart, born_on FROM r JOIN (SELECT kind, key FROM r GROUP BY 1, 2 HAVING count(*) > 1) USING (kind, key) LEFT JOIN b ON b.program_id = member""")
def edge_groups(s: SparkSession, d: str) -> DataFrame:
    """Mechanism and competitive edges of all programs (companies stand in for targets) with their births, in linear form."""
    sets = table(s, d, "program_indication").where(F.col("program_id").isNotNull()).groupBy(F.col("program_id").alias("member")).agg(F.collect_set("indication_id").alias("inds"), F.collect_set("company_id").alias("comps"))
    born = table(s, d, "program_born_on").groupBy(F.col("program_id").alias("member")).agg(F.min("born_on").alias("born_on"))
    return graph.edge_groups(sets.join(born, "member", "left"), "comps", "inds")


# ---- silver to captures ----

_ALIAS = """al AS (SELECT name, min(id) AS id FROM (SELECT unnest(members) AS name, alias_row_id AS id FROM curated_aliases UNION ALL SELECT canonical, alias_row_id FROM curated_aliases) WHERE name IS NOT NULL GROUP BY 1)"""


@query(f"""WITH {_GOLD}, {_ALIAS}, ph AS (SELECT code, sort_order FROM vocab_entry WHERE vocab = 'phase'),
r AS (SELECT g.company_id, g.snapshot_id, coalesce(g.captured_at, g.loaded_at) AS seen_at, coalesce(al.id::VARCHAR, g.asset) AS asset_id, preferred_name, phase_code, sort_order FROM g LEFT JOIN al ON al.name = preferred_name LEFT JOIN ph ON ph.code = phase_code),
q AS (SELECT a.snapshot_id, coalesce(al.id::VARCHAR, {_KEY.format(c='preferred_name')}) AS asset_id, list_sort(list(DISTINCT t.name)) AS partners FROM (SELECT snapshot_id, preferred_name, unnest(partners) AS t FROM a) a LEFT JOIN al ON al.name = preferred_name WHERE t.name IS NOT NULL GROUP BY 1, 2)
SELECT r.company_id, r.snapshot_id, min(seen_at) AS captured_at, strftime(min(seen_at), '%Y-%m-%d') AS period, r.asset_id, min(preferred_name) AS name, arg_max(phase_code, sort_order) AS phase_code, coalesce(any_value(q.partners), []) AS partners
FROM r LEFT JOIN q USING (snapshot_id, asset_id) GROUP BY 1, 2, 5""")
def captures_from_documents(s: SparkSession, d: str) -> DataFrame:
    """Observations per capture and resolved asset: highest known phase, union of partners, time and its label."""
    aliases = table(s, d, "curated_aliases").select(F.explode(F.concat(F.coalesce("members", F.array().cast("array<string>")), F.array("canonical"))).alias("preferred_name"), "alias_row_id")
    known = aliases.where(F.col("preferred_name").isNotNull()).groupBy("preferred_name").agg(F.min("alias_row_id").cast("string").alias("known"))
    order = _phases(s, d).select(F.col("phase").alias("phase_code"), "sort_order")
    rows = gold_rows(s, d).join(known, "preferred_name", "left").withColumn("asset_id", F.coalesce("known", "asset")).join(order, "phase_code", "left").withColumn("at", F.coalesce("captured_at", "loaded_at"))
    captures = rows.groupBy("company_id", "snapshot_id", "asset_id").agg(
        F.min("at").alias("captured_at"), F.date_format(F.min("at"), "yyyy-MM-dd").alias("period"), F.min("preferred_name").alias("name"), F.max_by("phase_code", "sort_order").alias("phase_code")
    )
    named = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).join(known, "preferred_name", "left").withColumn("asset_id", F.coalesce("known", tx.name_key(F.col("preferred_name"))))
    partners = named.select("snapshot_id", "asset_id", F.explode("partners.name").alias("p")).where(F.col("p").isNotNull()).groupBy("snapshot_id", "asset_id").agg(F.sort_array(F.collect_set("p")).alias("partners"))
    none = F.array().cast("array<string>")
    return captures.join(partners, ["snapshot_id", "asset_id"], "left").withColumn("partners", F.coalesce("partners", none))


@query("""SELECT event_id, program_id, type, event_at, born_on, place FROM (SELECT DISTINCT e.event_id, e.program_id, e.type, e.event_at, b.born_on, dense_rank() OVER (ORDER BY e.event_at DESC NULLS LAST, e.event_id DESC) AS place
FROM change_event e LEFT JOIN (SELECT program_id, min(born_on) AS born_on FROM program_born_on GROUP BY 1) b USING (program_id) WHERE e.status = 'confirmed' AND e.type IN ('asset_phase_changed', 'asset_left_pipeline')) WHERE place <= 200""")
def event_feed(s: SparkSession, d: str) -> DataFrame:
    """Confirmed events of some types, newest first, undated last: the first 200."""
    kinds = ["asset_phase_changed", "asset_left_pipeline"]
    events = table(s, d, "change_event").where((F.col("status") == "confirmed") & F.col("type").isin(kinds)).select("event_id", "program_id", "type", "event_at").distinct()
    order = [F.desc_nulls_last("event_at"), F.desc("event_id")]
    top = events.orderBy(*order).limit(200).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    born = table(s, d, "program_born_on").groupBy("program_id").agg(F.min("born_on").alias("born_on"))
    return top.join(born, "program_id", "left").select("event_id", "program_id", "type", "event_at", "born_on", "place")


# ---- mapping cascade ----

_STAGED = "lower({c})"
for _w in tx.STAGE_WORDS:
    _STAGED = f"replace({_STAGED}, '{_w}', ' ')"
_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\s*\([^)]*\)', '', 'g'), '\s+(in\s+)?combination with .*$', '', 'i'), ',\s+(adults?|patients?|in\b).*$', '', 'i'), '^(\s*(\d+l\+?|first[- ]line|second[- ]line|third[- ]line)\s+)+', '', 'i'), '^[ ,;]+|[ ,;]+$', '', 'g')"
_CASCADED = "regexp_replace(" + _STAGED.replace("{c}", "regexp_replace(cleaned, '(\\w)[''’]s\\b', '\\1', 'g')") + ", '[^a-z0-9]+', '', 'g')"


@query(f"""WITH {_GOLD}, x AS (SELECT DISTINCT indication_verbatim AS verbatim, {_CLEAN.format(c='indication_verbatim')} AS cleaned FROM g),
k AS (SELECT verbatim, {_CASCADED} AS key FROM x), e AS (SELECT word, code FROM words WHERE vocab = 'indication'),
n AS (SELECT regexp_replace(regexp_replace(word, '(\\w)[''’]s\\b', '\\1', 'g'), '[^a-z0-9]+', '', 'g') AS key, min(code) AS code FROM e GROUP BY 1)
SELECT verbatim, coalesce(e.code, n.code) AS code, CASE WHEN e.code IS NOT NULL THEN 'exact' WHEN n.code IS NOT NULL THEN 'normalized' ELSE 'none' END AS method,
CASE WHEN e.code IS NOT NULL THEN 1.0 WHEN n.code IS NOT NULL THEN 0.9 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN e.code IS NOT NULL OR n.code IS NOT NULL THEN 'auto' ELSE 'review' END AS status
FROM k LEFT JOIN e ON e.word = lower(trim(verbatim)) LEFT JOIN n ON n.key <> '' AND n.key = k.key""")
def indication_mapping(s: SparkSession, d: str) -> DataFrame:
    """Indications mapped in a cascade: as written, then cleaned of populations, stages and possessives; the rest goes to review."""
    said = gold_rows(s, d).select(F.col("indication_verbatim").alias("verbatim")).distinct()
    key = tx.name_key(tx.without_stage_words(tx.without_possessive(tx.clean_indication(F.col("verbatim")))))
    words = _words(s, d, "indication")
    exact = words.select(F.col("word").alias("_e"), F.col("code").alias("_exact"))
    near = words.groupBy(tx.name_key(tx.without_possessive(F.col("word"))).alias("_n")).agg(F.min("code").alias("_near")).where(F.col("_n") != "")
    rows = said.join(exact, F.lower(tx.stripped(F.col("verbatim"))) == F.col("_e"), "left").join(near, key == F.col("_n"), "left")
    step = lambda a, b, c: F.when(F.col("_exact").isNotNull(), a).when(F.col("_near").isNotNull(), b).otherwise(c)
    return rows.select("verbatim", F.coalesce("_exact", "_near").alias("code"), step("exact", "normalized", "none").alias("method"), step(F.lit(1.0), F.lit(0.9), F.lit(0.0)).alias("confidence"), step("auto", "auto", "review").alias("status"))


@query(f"""WITH {_GOLD}, m AS (SELECT indication, w.code, CASE WHEN lower(v.label) = w.word THEN 1.0 ELSE 0.9 END AS confidence FROM (SELECT DISTINCT indication, lower(indication_verbatim) AS lv FROM g) JOIN words w ON w.vocab = 'indication' AND w.word = lv JOIN vocab_entry v ON v.vocab = 'indication' AND v.code = w.code)
SELECT indication, code, confidence::DOUBLE AS confidence FROM m QUALIFY row_number() OVER (PARTITION BY indication ORDER BY confidence DESC NULLS LAST, code) = 1""")
def best_indication_mapping(s: SparkSession, d: str) -> DataFrame:
    """One mapping per indication, the surest; nothing downstream fans out."""
    said = gold_rows(s, d).select("indication", F.lower("indication_verbatim").alias("word")).distinct()
    labels = _vocab(s, d, "indication").select("code", F.lower("label").alias("_label"))
    rows = said.join(_words(s, d, "indication"), "word").join(labels, "code").withColumn("confidence", F.when(F.col("_label") == F.col("word"), 1.0).otherwise(0.9))
    return identity.first_per_key(rows.select("indication", "code", "confidence"), ["indication"], F.desc_nulls_last("confidence"), "code")


@query(f"""WITH {_GOLD} SELECT core AS key, count(*) AS places, 'unmapped' AS status FROM g WHERE phase_code IS NULL AND core <> '' GROUP BY 1""")
def unmapped_phases(s: SparkSession, d: str) -> DataFrame:
    """What the exact dictionary misses, once each, for review."""
    rows = gold_rows(s, d).where(F.col("phase_code").isNull()).withColumn("key", tx.preclean(F.col("phase_verbatim"))).where(F.col("key") != "")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("places")).withColumn("status", F.lit("unmapped"))


# ---- details and lists ----


@query(f"""{_NOW}, m AS (SELECT asset, count(*) AS programs, max(sort_order) AS top FROM base GROUP BY 1),
sy AS (SELECT asset, list_sort(list(DISTINCT x)) AS synonyms FROM (SELECT {_KEY.format(c='preferred_name')} AS asset, unnest(synonyms) AS x FROM a) WHERE x IS NOT NULL GROUP BY 1),
pa AS (SELECT asset, list_sort(list(DISTINCT t.name)) AS partners FROM (SELECT {_KEY.format(c='preferred_name')} AS asset, unnest(partners) AS t FROM a) WHERE t.name IS NOT NULL GROUP BY 1),
pr AS (SELECT asset, list_sort(list(company_id || ':' || indication || ':' || coalesce(phase_code, 'unmapped'))) AS programs_of FROM base GROUP BY 1)
SELECT dim.asset, asset_name, target_symbols, coalesce(sy.synonyms, []) AS synonyms, coalesce(pa.partners, []) AS partners, coalesce(pr.programs_of, []) AS programs_of, coalesce(m.programs, 0) AS programs
FROM dim LEFT JOIN m USING (asset) LEFT JOIN sy USING (asset) LEFT JOIN pa USING (asset) LEFT JOIN pr USING (asset)""")
def asset_detail(s: SparkSession, d: str) -> DataFrame:
    """Each asset with its synonyms, partners and programs nested."""
    a = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).withColumn("asset", tx.name_key(F.col("preferred_name")))
    of = lambda x, name: a.select("asset", F.explode(x).alias("x")).where(F.col("x").isNotNull()).groupBy("asset").agg(F.sort_array(F.collect_set("x")).alias(name))
    told = F.concat_ws(":", "company_id", "indication", F.coalesce("phase_code", F.lit("unmapped")))
    programs = program_base(s, d).groupBy("asset").agg(F.array_sort(F.collect_list(told)).alias("programs_of"), F.count(F.lit(1)).alias("programs"))
    rows = asset_dimension(s, d).join(of("synonyms", "synonyms"), "asset", "left").join(of("partners.name", "partners"), "asset", "left").join(programs, "asset", "left")
    filled = lambda c: F.coalesce(c, F.array().cast("array<string>")).alias(c)
    return rows.select("asset", "asset_name", "target_symbols", filled("synonyms"), filled("partners"), filled("programs_of"), F.coalesce("programs", F.lit(0)).alias("programs"))


@query(f"""{_NOW} SELECT company_id, status = 'discontinued' AS discontinued, coalesce(phase_code, 'unmapped') AS phase, count(*) AS n, list_sort(list(asset_name || ' / ' || indication)) AS programs FROM base GROUP BY 1, 2, 3""")
def company_programs(s: SparkSession, d: str) -> DataFrame:
    """Programs of each company by phase, the discontinued apart."""
    return program_base(s, d).groupBy("company_id", (F.col("status") == "discontinued").alias("discontinued"), F.coalesce("phase_code", F.lit("unmapped")).alias("phase")).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.concat("asset_name", F.lit(" / "), "indication"))).alias("programs")
    )


@query(f"""{_NOW}, c AS (SELECT company_id, count(*) AS n_programs, count(*) FILTER (WHERE status <> 'discontinued') AS n_active, max(fetched_at) AS last_fetched FROM base GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY n_programs DESC, company_id) AS place FROM c QUALIFY place <= 100""")
def company_list(s: SparkSession, d: str) -> DataFrame:
    """Companies by their number of programs: the first 100."""
    counted = program_base(s, d).groupBy("company_id").agg(F.count(F.lit(1)).alias("n_programs"), F.count_if(F.col("status") != "discontinued").alias("n_active"), F.max("fetched_at").alias("last_fetched"))
    order = [F.desc("n_programs"), F.col("company_id")]
    return counted.orderBy(*order).limit(100).withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query(f"""WITH {_GOLD} SELECT DISTINCT g.indication, w.code, v.label FROM g LEFT JOIN words w ON w.vocab = 'indication' AND w.word = lower(indication_verbatim) LEFT JOIN vocab_entry v ON v.vocab = 'indication' AND v.code = w.code
WHERE indication_verbatim ILIKE '%diabetes%' AND w.code IS NOT NULL""")
def indication_list(s: SparkSession, d: str) -> DataFrame:
    """Mapped indications whose text holds a word."""
    rows = search.text_filter(gold_rows(s, d), "diabetes", "indication_verbatim").select("indication", F.lower("indication_verbatim").alias("word"))
    labels = _vocab(s, d, "indication").select("code", "label")
    return rows.join(_words(s, d, "indication"), "word").join(labels, "code", "left").select("indication", "code", "label").distinct()


_PUBLISHED = ["expected_asset", "program_indication", "program_born_on", "change_event", "capture_asset", "curated_aliases", "vocab_entry"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS relation, count(*) AS n FROM {t}" for t in _PUBLISHED))
def published_counts(s: SparkSession, d: str) -> DataFrame:
    counts = [table(s, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("relation"), "n") for t in _PUBLISHED]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("""SELECT CAST(captured_at AS DATE) AS day, coalesce(nullif(lower(trim(phase_code)), ''), 'unmapped') AS bucket, count(DISTINCT asset_id) AS assets FROM capture_asset WHERE asset_id IS NOT NULL GROUP BY 1, 2""")
def phase_histogram(s: SparkSession, d: str) -> DataFrame:
    """Assets per day of capture and phase."""
    code = F.lower(F.trim("phase_code"))
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull())
    return rows.groupBy(F.to_date("captured_at").alias("day"), F.coalesce(F.when(code != "", code), F.lit("unmapped")).alias("bucket")).agg(F.countDistinct("asset_id").alias("assets"))


@query("""SELECT source_id, capture_id, count(*) AS rows FROM capture_asset WHERE CAST(captured_at AS DATE) = DATE '2022-08-24' GROUP BY 1, 2""")
def captures_of_a_day(s: SparkSession, d: str) -> DataFrame:
    """Equality on the date of a timestamp, as a range that the scan can use."""
    day = F.lit("2022-08-24").cast("timestamp_ntz")
    rows = table(s, d, "capture_asset").where((F.col("captured_at") >= day) & (F.col("captured_at") < F.lit("2022-08-25").cast("timestamp_ntz")))
    return rows.groupBy("source_id", "capture_id").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey = TRY_CAST('17' AS BIGINT) OR s_name = '17' OR upper(s_name) = '17' OR s_name ILIKE '%17%' ORDER BY s_name LIMIT 1""")
def entity_lookup(s: SparkSession, d: str) -> DataFrame:
    """An entity by id, name or part of its name: the first by name."""
    return search.lookup(table(s, d, "supplier"), "17", "s_suppkey", "s_name").select("s_suppkey", "s_name")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY o_totalprice, o_orderkey LIMIT 20""")
def work_queue(s: SparkSession, d: str) -> DataFrame:
    """Items in some states whose owner isn't done yet, the smallest first: the next 20."""
    orders = table(s, d, "orders")
    done = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    open_ = orders.where(F.col("o_orderstatus").isin("O", "P")).join(done, "o_custkey", "left_anti")
    return open_.orderBy("o_totalprice", "o_orderkey").limit(20).select("o_orderkey", "o_orderstatus")


@query("""WITH u AS (SELECT c_nationkey, c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0), t AS (SELECT DISTINCT o_custkey FROM orders)
SELECT coalesce(CASE WHEN t.o_custkey IS NOT NULL THEN 'attempted' END, 'not_attempted') AS status, count(*) AS n, min(c_acctbal) AS least FROM u LEFT JOIN t ON t.o_custkey = u.c_custkey GROUP BY 1""")
def universe_status(s: SparkSession, d: str) -> DataFrame:
    """A universe (null and zero sizes dropped) against what was attempted, by state."""
    universe = table(s, d, "customer").where(F.col("c_acctbal") > 0)
    tried = table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("attempted").alias("s")).distinct()
    return universe.join(tried, "c_custkey", "left").groupBy(F.coalesce("s", F.lit("not_attempted")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("least"))


@query("""SELECT c.c_custkey, c.c_acctbal, row_number() OVER (ORDER BY c.c_acctbal, c.c_custkey) AS place FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey NOT IN (SELECT o_custkey FROM orders) QUALIFY place <= 8""")
def frontier(s: SparkSession, d: str) -> DataFrame:
    """What wasn't attempted yet, the smallest first: the next eight."""
    rest = table(s, d, "customer").where(F.col("c_acctbal") > 0).join(table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    order = [F.col("c_acctbal"), F.col("c_custkey")]
    return rest.orderBy(*order).limit(8).withColumn("place", F.row_number().over(Window.orderBy(*order))).select("c_custkey", "c_acctbal", "place")


@query("""WITH x AS (SELECT expected_id, list_transform(programs, lambda p: p.phase_verbatim) AS phases, list_transform(programs, lambda p: p.indication_verbatim) AS inds FROM (SELECT DISTINCT * FROM expected_asset)),
z AS (SELECT expected_id, unnest(phases) AS phase, unnest(inds) AS indication, generate_subscripts(phases, 1) - 1 AS pos FROM x)
SELECT expected_id, pos, phase, indication FROM z""")
def zipped_arrays(s: SparkSession, d: str) -> DataFrame:
    """Two arrays of one document joined by position."""
    rows = table(s, d, "expected_asset").distinct().select("expected_id", F.col("programs.phase_verbatim").alias("phases"), F.col("programs.indication_verbatim").alias("inds"))
    return rows.select("expected_id", F.posexplode(F.arrays_zip("phases", "inds")).alias("pos", "z")).select("expected_id", "pos", F.col("z.phases").alias("phase"), F.col("z.inds").alias("indication"))


@query(f"""WITH {_ALIAS.replace('al AS', 'al0 AS')}, k AS (SELECT name, id FROM al0), n AS (SELECT DISTINCT x AS name FROM (SELECT preferred_name AS x FROM expected_asset UNION ALL SELECT unnest(synonyms) FROM expected_asset) WHERE x IS NOT NULL)
SELECT n.name, lower(n.name) AS low FROM n WHERE lower(n.name) NOT IN (SELECT lower(name) FROM k)""")
def aliases_to_seed(s: SparkSession, d: str) -> DataFrame:
    """Names without an alias yet, letter case aside; what was decided stays."""
    a = table(s, d, "expected_asset")
    names = a.select(F.explode(F.concat(F.array("preferred_name"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("name")).where(F.col("name").isNotNull()).distinct().withColumn("low", F.lower("name"))
    known = table(s, d, "curated_aliases").select(F.explode(F.concat(F.coalesce("members", F.array().cast("array<string>")), F.array("canonical"))).alias("n")).where(F.col("n").isNotNull())
    return names.join(known.select(F.lower("n").alias("low")), "low", "left_anti")


@query(f"""WITH {_GOLD}, {_ASSET_DIM}, ann AS (SELECT DISTINCT p_brand AS asset_type, p_type AS target FROM part),
gap AS (SELECT asset FROM dim WHERE mechanism_verbatim IS NULL AND target_symbols IS NULL)
SELECT asset, 'Brand#' || (length(asset) % 5 + 1) || '1' AS annotation, n FROM gap JOIN (SELECT asset_type, count(*) AS n FROM ann GROUP BY 1 HAVING count(*) <= 6) f ON f.asset_type = 'Brand#' || (length(asset) % 5 + 1) || '1'""")
def gap_enrichment(s: SparkSession, d: str) -> DataFrame:
    """Annotations for assets that disclosed neither mechanism nor target; families of too many targets are left out."""
    gap = asset_dimension(s, d).where(F.col("mechanism_verbatim").isNull() & F.col("target_symbols").isNull()).select("asset")
    small = table(s, d, "part").groupBy(F.col("p_brand").alias("annotation")).agg(F.countDistinct("p_type").alias("n")).where(F.col("n") <= 6)
    keyed = gap.withColumn("annotation", F.concat(F.lit("Brand#"), (F.length("asset") % 5 + 1).cast("string"), F.lit("1")))
    return keyed.join(small, "annotation").select("asset", "annotation", "n")


@query("""SELECT 'program_indication' AS relation, count(*) AS left_over FROM program_indication WHERE company_id <> 'CO000000042' UNION ALL SELECT 'change_event', count(*) FROM change_event WHERE company_id <> 'CO000000042'
UNION ALL SELECT 'program_born_on', count(*) FROM program_born_on WHERE program_id NOT IN (SELECT program_id FROM program_indication WHERE company_id = 'CO000000042')""")
def company_reset(s: SparkSession, d: str) -> DataFrame:
    """What a company's removal leaves of each relation, children first."""
    gone = s.createDataFrame([("CO000000042",)], "company_id string")
    versions = table(s, d, "program_indication")
    programs = versions.join(gone, "company_id", "left_semi").select("program_id")
    parts = [
        ("program_indication", identity.without(versions, gone, "company_id")), ("change_event", identity.without(table(s, d, "change_event"), gone, "company_id")),
        ("program_born_on", identity.without(table(s, d, "program_born_on"), programs, "program_id")),
    ]
    counts = [df.agg(F.count(F.lit(1)).alias("left_over")).select(F.lit(n).alias("relation"), "left_over") for n, df in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# ---- get or create, neighbours at a time, rebuilds ----


@query(f"""WITH {_ALIAS}, n AS (SELECT DISTINCT preferred_name AS name FROM expected_asset WHERE preferred_name IS NOT NULL), low AS (SELECT lower(trim(name)) AS k, min(id) AS id FROM al GROUP BY 1),
r AS (SELECT n.name, {_KEY.format(c='n.name')} AS key, coalesce(al.id, low.id) AS id FROM n LEFT JOIN al USING (name) LEFT JOIN low ON low.k = lower(trim(n.name)))
SELECT name, CASE WHEN id IS NOT NULL THEN id::VARCHAR ELSE 'new-' || sha256(CASE WHEN key = '' THEN name ELSE key END) END AS asset_id, id IS NULL AS created FROM r""")
def resolved_or_created(s: SparkSession, d: str) -> DataFrame:
    """Each name's asset: a known one, else a new one whose id follows from the name's key, so that loading again makes the same."""
    said = table(s, d, "curated_aliases").select(F.explode(F.concat(F.coalesce("members", F.array().cast("array<string>")), F.array("canonical"))).alias("name"), F.col("alias_row_id").alias("asset_id")).where(F.col("name").isNotNull())
    names = table(s, d, "expected_asset").select(F.col("preferred_name").alias("name")).where(F.col("name").isNotNull()).distinct()
    exact = said.groupBy("name").agg(F.min("asset_id").alias("_a"))
    low = said.groupBy(F.lower(tx.stripped(F.col("name"))).alias("_k")).agg(F.min("asset_id").alias("_b"))
    rows = names.join(exact, "name", "left").join(low, F.lower(tx.stripped(F.col("name"))) == F.col("_k"), "left").withColumn("id", F.coalesce("_a", "_b"))
    key = tx.name_key(F.col("name"))
    new = F.concat(F.lit("new-"), F.sha2(F.when(key == "", F.col("name")).otherwise(key), 256))
    return rows.select("name", F.coalesce(F.col("id").cast("string"), new).alias("asset_id"), F.col("id").isNull().alias("created"))


@query("""WITH w AS (SELECT DISTINCT trim(n) AS name FROM (SELECT unnest(['GERMANY', 'Atlantis ', 'FRANCE', 'atlantis', '']) AS n) WHERE trim(n) <> ''), k AS (SELECT lower(name) AS k, min(name) AS name FROM w GROUP BY 1)
SELECT k.name, n_nationkey AS key, CASE WHEN n_nationkey IS NULL THEN 'created' ELSE 'found' END AS outcome FROM k LEFT JOIN nation ON lower(n_name) = k""")
def onboarded(s: SparkSession, d: str) -> DataFrame:
    """A list of names put in: those known are found, the others created once."""
    asked = s.createDataFrame([("GERMANY",), ("Atlantis ",), ("FRANCE",), ("atlantis",), ("",)], "name string").select(F.trim("name").alias("name")).where(F.col("name") != "")
    once = asked.groupBy(F.lower("name").alias("k")).agg(F.min("name").alias("name"))
    known = table(s, d, "nation").select(F.lower("n_name").alias("k"), F.col("n_nationkey").alias("key"))
    return once.join(known, "k", "left").select("name", "key", F.when(F.col("key").isNull(), "created").otherwise("found").alias("outcome"))


@query("""WITH b AS (SELECT program_id AS member, min(born_on) AS born_on FROM program_born_on GROUP BY 1), ti AS (SELECT DISTINCT program_id AS member, company_id AS key FROM program_indication), ii AS (SELECT DISTINCT program_id AS member, indication_id AS key FROM program_indication),
me AS (SELECT min(program_id) AS node FROM program_indication),
m AS (SELECT DISTINCT member FROM ti, me WHERE key IN (SELECT key FROM ti, me WHERE member = node) AND member <> node),
c AS (SELECT DISTINCT member FROM ii, me WHERE key IN (SELECT key FROM ii, me WHERE member = node) AND member <> node AND member NOT IN (SELECT member FROM m)),
e AS (SELECT member, 'mechanism' AS kind, 1.0::DOUBLE AS weight FROM m UNION ALL SELECT member, 'competitive', 0.7 FROM c)
SELECT e.member, e.kind, e.weight FROM e LEFT JOIN b USING (member), (SELECT born_on FROM b, me WHERE member = node) o WHERE greatest(b.born_on, o.born_on) <= TIMESTAMP '2021-12-31'""")
def related_as_of(s: SparkSession, d: str) -> DataFrame:
    """The neighbours of a program that were there at a time."""
    from sedimenta.plans.catalogue import related_programs

    return related_programs(s, d).where(F.col("born_on") <= F.lit("2021-12-31").cast("timestamp_ntz")).select("member", "kind", "weight")


@query("""SELECT company_id, type, count(*) AS n FROM (SELECT DISTINCT * FROM change_event WHERE company_id IS NOT NULL) GROUP BY 1, 2""")
def rebuilt_feed(s: SparkSession, d: str) -> DataFrame:
    """Derived events written by company, then rebuilt for some companies: what is read has each once."""
    from sedimenta.plans.pages import _shared
    from sedimenta.sources.snapshots import rebuild_partitions

    folder = f"{_shared(s)}/feed"
    events = table(s, d, "change_event").where(F.col("company_id").isNotNull()).distinct()
    rebuild_partitions(events, folder, "company_id")
    rebuild_partitions(events.where(F.col("company_id") > "CO000001020"), folder, "company_id")
    return s.read.parquet(folder).groupBy(F.col("company_id").cast("string").alias("company_id"), "type").agg(F.count(F.lit(1)).alias("n"))
