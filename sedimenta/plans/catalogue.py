"""Queries of the relational core on the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions import text as tx
from sedimenta.functions import web
from sedimenta.operators import changes, graph, history, identity, quality, search
from sedimenta.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


AS_OF = "2023-06-30 00:00:00"
KEYS = ["program_id", "indication_id", "company_id"]


def _versions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "program_indication").distinct()


def _vocab(s: SparkSession, d: str, name: str) -> DataFrame:
    """One of the fixed vocabularies; broadcast by size."""
    return table(s, d, "vocab_entry").where(F.col("vocab") == name)


def _phases(s: SparkSession, d: str) -> DataFrame:
    return _vocab(s, d, "phase").select(F.col("code").alias("phase"), F.col("label").alias("phase_label"), "sort_order")


def _indications(s: SparkSession, d: str) -> DataFrame:
    return _vocab(s, d, "indication").select(F.col("code").alias("indication_id"), F.col("label").alias("indication"))


_PROGRAM = """
v AS (SELECT DISTINCT * FROM program_indication),
ph AS (SELECT code AS phase, label AS phase_label, sort_order FROM vocab_entry WHERE vocab = 'phase'),
ind AS (SELECT code AS indication_id, label AS indication FROM vocab_entry WHERE vocab = 'indication'),
born AS (SELECT program_id, min(born_on) AS born_on FROM program_born_on GROUP BY 1),
prog AS (SELECT v.*, phase_label, sort_order, indication, born_on FROM v LEFT JOIN ph USING (phase) LEFT JOIN ind USING (indication_id) LEFT JOIN born USING (program_id))
"""


def _programs(s: SparkSession, d: str) -> DataFrame:
    """Versions with labels and birth: the base of the program queries."""
    born = table(s, d, "program_born_on").groupBy("program_id").agg(F.min("born_on").alias("born_on"))
    return _versions(s, d).join(_phases(s, d), "phase", "left").join(_indications(s, d), "indication_id", "left").join(born, "program_id", "left")


_SHOWN = "version_id, program_id, indication, company_id, phase_label, sort_order, status, born_on"
SHOWN = _SHOWN.split(", ")


@query(f"WITH {_PROGRAM} SELECT {_SHOWN} FROM prog WHERE valid_to IS NULL AND status <> 'discontinued'")
def current_programs_faceted(s: SparkSession, d: str) -> DataFrame:
    current = _programs(s, d).where(F.col("valid_to").isNull())
    return search.faceted(current, {"phase": None, "status": None}, active_only=True).select(*SHOWN)


@query(f"WITH {_PROGRAM} SELECT {_SHOWN} FROM prog WHERE valid_to IS NULL AND phase = 'phase_2' AND status = 'active' AND (indication ILIKE '%cancer%' OR indication_verbatim ILIKE '%cancer%')")
def programs_by_facet_and_text(s: SparkSession, d: str) -> DataFrame:
    current = _programs(s, d).where(F.col("valid_to").isNull())
    chosen = search.faceted(current, {"phase": "phase_2", "status": "active"}, active_only=True)
    return search.text_filter(chosen, "cancer", "indication", "indication_verbatim").select(*SHOWN)


@query(f"WITH {_PROGRAM} SELECT {_SHOWN} FROM prog WHERE valid_from <= TIMESTAMP '{AS_OF}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF}')")
def programs_as_of(s: SparkSession, d: str) -> DataFrame:
    return history.as_of(_programs(s, d), F.lit(AS_OF).cast("timestamp_ntz")).select(*SHOWN)


@query(f"WITH {_PROGRAM} SELECT {_SHOWN} FROM prog WHERE valid_to IS NULL ORDER BY sort_order DESC NULLS LAST, program_id, version_id LIMIT 50")
def program_page(s: SparkSession, d: str) -> DataFrame:
    """The first page of the programs, most advanced first."""
    return _programs(s, d).where(F.col("valid_to").isNull()).orderBy(F.desc_nulls_last("sort_order"), "program_id", "version_id").limit(50).select(*SHOWN)


@query(f"WITH {_PROGRAM} SELECT phase, status, count(*) AS programs, count(DISTINCT company_id) AS companies, count(DISTINCT indication_id) AS indications FROM prog WHERE valid_to IS NULL GROUP BY 1, 2")
def facet_counts(s: SparkSession, d: str) -> DataFrame:
    return (
        _versions(s, d).where(F.col("valid_to").isNull()).groupBy("phase", "status")
        .agg(F.count(F.lit(1)).alias("programs"), F.countDistinct("company_id").alias("companies"), F.countDistinct("indication_id").alias("indications"))
    )


@query("""SELECT 'phase' AS facet, phase AS value FROM program_indication WHERE valid_to IS NULL AND phase IS NOT NULL
UNION SELECT 'status', status FROM program_indication WHERE valid_to IS NULL AND status IS NOT NULL
UNION SELECT 'indication', indication_id FROM program_indication WHERE valid_to IS NULL AND indication_id IS NOT NULL""")
def facet_values(s: SparkSession, d: str) -> DataFrame:
    current = table(s, d, "program_indication").where(F.col("valid_to").isNull())
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), F.col(c).alias("value")) for n, c in (("phase", "phase"), ("status", "status"), ("indication", "indication_id"))])
    return current.select(F.explode(pairs).alias("p")).select("p.facet", "p.value").where(F.col("value").isNotNull()).distinct()


@query("""SELECT company_id, count(*) FILTER (WHERE valid_to IS NULL) AS current_versions, count(*) FILTER (WHERE valid_to IS NULL AND status <> 'discontinued') AS active_versions,
count(DISTINCT program_id) AS programs, max(recorded_at) AS last_recorded FROM (SELECT DISTINCT * FROM program_indication) GROUP BY 1""")
def company_overview(s: SparkSession, d: str) -> DataFrame:
    is_open = F.col("valid_to").isNull()
    return _versions(s, d).groupBy("company_id").agg(
        F.count(F.when(is_open, 1)).alias("current_versions"),
        F.count(F.when(is_open & (F.col("status") != "discontinued"), 1)).alias("active_versions"),
        F.countDistinct("program_id").alias("programs"),
        F.max("recorded_at").alias("last_recorded"),
    )


@query("SELECT program_id, min(born_on) AS born_on, count(*) AS sources FROM (SELECT DISTINCT * FROM program_born_on) WHERE born_on IS NOT NULL GROUP BY 1")
def born_on(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "program_born_on").distinct().where(F.col("born_on").isNotNull()).groupBy("program_id").agg(F.min("born_on").alias("born_on"), F.count(F.lit(1)).alias("sources"))


@query("""WITH p AS (SELECT code AS phase, sort_order FROM vocab_entry WHERE vocab = 'phase' AND sort_order < 70)
SELECT program_id, arg_max(phase, sort_order) AS phase, max(sort_order) AS sort_order FROM program_indication JOIN p USING (phase) GROUP BY 1""")
def most_advanced_phase(s: SparkSession, d: str) -> DataFrame:
    ranked = table(s, d, "program_indication").join(_phases(s, d).where(F.col("sort_order") < 70).drop("phase_label"), "phase")
    return ranked.groupBy("program_id").agg(F.max_by("phase", "sort_order").alias("phase"), F.max("sort_order").alias("sort_order"))


@query("""WITH c AS (SELECT indication_id, company_id, count(*) AS n FROM (SELECT DISTINCT * FROM program_indication) GROUP BY 1, 2)
SELECT indication_id, company_id, n FROM c QUALIFY row_number() OVER (PARTITION BY indication_id ORDER BY n DESC, company_id) = 1""")
def leading_company(s: SparkSession, d: str) -> DataFrame:
    """The most frequent company of each indication: a mode with a tie rule."""
    counted = _versions(s, d).groupBy("indication_id", "company_id").agg(F.count(F.lit(1)).alias("n"))
    return identity.first_per_key(counted, ["indication_id"], F.desc("n"), "company_id")


@query("""SELECT DISTINCT company_id, name FROM (
SELECT company_id, preferred_name AS name FROM expected_asset UNION ALL SELECT company_id, unnest(synonyms) FROM expected_asset
UNION ALL SELECT company_id, originator_verbatim FROM expected_asset) WHERE name IS NOT NULL""")
def alias_union(s: SparkSession, d: str) -> DataFrame:
    names = F.concat(F.array("preferred_name", "originator_verbatim"), F.coalesce("synonyms", F.array().cast("array<string>")))
    return table(s, d, "expected_asset").select("company_id", F.explode(names).alias("name")).where(F.col("name").isNotNull()).distinct()


@query("""WITH r AS (SELECT DISTINCT source_id, capture_id, captured_at, asset_id FROM capture_asset WHERE asset_id IS NOT NULL),
c AS (SELECT source_id, capture_id, captured_at, count(DISTINCT asset_id) AS assets FROM r GROUP BY 1, 2, 3)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY captured_at DESC, capture_id DESC) = 1""")
def latest_capture(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull())
    counted = rows.groupBy("source_id", "capture_id", "captured_at").agg(F.countDistinct("asset_id").alias("assets"))
    best = F.max_by(F.struct("capture_id", "captured_at", "assets"), F.struct("captured_at", "capture_id"))
    return counted.groupBy("source_id").agg(best.alias("m")).select("source_id", "m.*")


@query("""WITH r AS (SELECT DISTINCT capture_id, asset_id, unnest(partners) AS p FROM capture_asset WHERE asset_id IS NOT NULL)
SELECT capture_id, asset_id, string_agg(p, '; ' ORDER BY p) AS partners, count(*) AS n FROM r WHERE p IS NOT NULL GROUP BY 1, 2""")
def partner_sets(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull()).select("capture_id", "asset_id", F.explode("partners").alias("p")).where(F.col("p").isNotNull())
    sets = rows.groupBy("capture_id", "asset_id").agg(F.sort_array(F.collect_set("p")).alias("s"))
    return sets.select("capture_id", "asset_id", F.array_join("s", "; ").alias("partners"), F.size("s").cast("long").alias("n"))


@query("SELECT source, lang, count(*) AS documents FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM subject_label) GROUP BY 1, 2")
def unlabelled_documents(s: SparkSession, d: str) -> DataFrame:
    """Pending work: an anti-join, then counts."""
    rest = table(s, d, "documents").join(table(s, d, "subject_label").select("doc_id"), "doc_id", "left_anti")
    return rest.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("documents"))


@query("""SELECT DISTINCT program_id FROM program_indication WHERE program_id IN (SELECT program_id FROM change_event WHERE type = 'asset_phase_changed')
OR program_id IN (SELECT program_id FROM program_born_on WHERE born_on >= TIMESTAMP '2022-01-01')""")
def programs_in_either(s: SparkSession, d: str) -> DataFrame:
    moved = table(s, d, "change_event").where(F.col("type") == "asset_phase_changed").select("program_id")
    late = table(s, d, "program_born_on").where(F.col("born_on") >= F.lit("2022-01-01").cast("timestamp_ntz")).select("program_id")
    return table(s, d, "program_indication").join(moved.union(late).distinct(), "program_id", "left_semi").select("program_id").distinct()


_GEO = """RECURSIVE e AS (SELECT 'world' AS parent, 'r' || r_regionkey AS child FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation
UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
nodes AS (SELECT parent AS node FROM e UNION SELECT child FROM e),
c AS (SELECT node AS ancestor, node AS descendant, 0 AS depth FROM nodes UNION ALL SELECT c.ancestor, e.child, c.depth + 1 FROM c JOIN e ON c.descendant = e.parent WHERE c.depth < 30),
m AS (SELECT ancestor, descendant, min(depth)::INT AS depth FROM c GROUP BY 1, 2)"""


def _geo(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    edges = (
        table(s, d, "region").select(F.lit("world").alias("parent"), name("r", "r_regionkey").alias("child"))
        .unionByName(table(s, d, "nation").select(name("r", "n_regionkey").alias("parent"), name("n", "n_nationkey").alias("child")))
        .unionByName(table(s, d, "supplier").select(name("n", "s_nationkey").alias("parent"), name("s", "s_suppkey").alias("child")))
    )
    return edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct(), edges


@query(f"WITH {_GEO} SELECT ancestor, descendant, depth FROM m")
def hierarchy_closure(s: SparkSession, d: str) -> DataFrame:
    return graph.closure(*_geo(s, d))


@query(f"""WITH {_GEO} SELECT descendant AS node, CASE WHEN depth = 0 THEN 'exact' ELSE 'descendant' END AS relation, depth AS distance FROM m WHERE ancestor = 'r1'
UNION ALL SELECT ancestor, 'ancestor', depth FROM m WHERE descendant = 'r1' AND depth BETWEEN 1 AND 2""")
def adjacent_nodes(s: SparkSession, d: str) -> DataFrame:
    return graph.adjacent(graph.closure(*_geo(s, d)), "r1")


@query(f"""WITH {_GEO}, a AS (SELECT 'r1' AS node, 'north' AS area, 1 AS priority UNION ALL SELECT 'r2', 'south', 2 UNION ALL SELECT 'n7', 'seven', 0)
SELECT d.node, coalesce((SELECT arg_min(a.area, a.priority) FROM m JOIN a ON m.ancestor = a.node WHERE m.descendant = d.node), 'elsewhere') AS area FROM nodes d""")
def anchored_areas(s: SparkSession, d: str) -> DataFrame:
    anchors = s.createDataFrame([("r1", "north", 1), ("r2", "south", 2), ("n7", "seven", 0)], "node string, area string, priority int")
    return graph.anchored_area(graph.closure(*_geo(s, d)), anchors, "elsewhere")


_AREAS = " ".join(f"WHEN regexp_matches(t, '{p}', 'i') THEN '{label}'" for label, p in tx.AREA_RULES)


@query(f"""WITH x AS (SELECT DISTINCT v.indication_id, v.indication_verbatim AS verbatim, concat_ws(' ', e.label, v.indication_verbatim) AS t FROM program_indication v LEFT JOIN vocab_entry e ON e.vocab = 'indication' AND e.code = v.indication_id)
SELECT indication_id, verbatim, CASE {_AREAS} ELSE '{tx.AREA_OTHER}' END AS area FROM x""")
def therapeutic_areas(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "program_indication").select("indication_id", F.col("indication_verbatim").alias("verbatim")).distinct().join(_indications(s, d), "indication_id", "left")
    return rows.select("indication_id", "verbatim", tx.therapeutic_area(F.col("indication"), F.col("verbatim")).alias("area"))


_WHITE = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_PRECLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\([^)]*\)', ' ', 'g'), '[*#†‡§✝~^]+', ' ', 'g'), '\b(in progress|achieved|ongoing|status)\b', ' ', 'g'), 'WHITE', ' ', 'g'))".replace("WHITE", _WHITE.replace("{", "{{").replace("}", "}}"))
_IDENTITY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tx.PHASE_IDENTITY.items())


@query(f"""WITH p AS (SELECT unnest(programs, recursive := true) FROM expected_asset), x AS (SELECT DISTINCT phase_verbatim, {_PRECLEAN.format(c='phase_verbatim')} AS core FROM p WHERE phase_verbatim IS NOT NULL),
k AS (SELECT phase_verbatim, core, regexp_replace(core, '[^a-z0-9]+', '', 'g') AS key FROM x)
SELECT phase_verbatim, core, CASE key {_IDENTITY} ELSE key END AS identity FROM k""")
def phase_identities(s: SparkSession, d: str) -> DataFrame:
    said = table(s, d, "expected_asset").select(F.explode("programs.phase_verbatim").alias("phase_verbatim")).where(F.col("phase_verbatim").isNotNull()).distinct()
    return said.select("phase_verbatim", tx.preclean(F.col("phase_verbatim")).alias("core"), tx.phase_identity(F.col("phase_verbatim")).alias("identity"))


@query(f"""WITH p AS (SELECT unnest(programs, recursive := true) FROM expected_asset), x AS (SELECT DISTINCT {_PRECLEAN.format(c='phase_verbatim')} AS core FROM p),
v AS (SELECT code, lower(unnest(list_append(aliases, label))) AS alias FROM vocab_entry WHERE vocab = 'phase')
SELECT core, min(code) AS code FROM x LEFT JOIN v ON core = alias WHERE core <> '' GROUP BY 1""")
def vocabulary_lookup(s: SparkSession, d: str) -> DataFrame:
    """Exact dictionary lookup of precleaned phases; misses have a null code."""
    said = table(s, d, "expected_asset").select(F.explode("programs.phase_verbatim").alias("v"))
    core = said.select(tx.preclean(F.col("v")).alias("core")).where(F.col("core") != "").distinct()
    words = _vocab(s, d, "phase").select("code", F.explode(F.concat("aliases", F.array("label"))).alias("a")).select("code", F.lower("a").alias("alias"))
    return core.join(words, core["core"] == words["alias"], "left").groupBy("core").agg(F.min("code").alias("code"))


@query("""WITH p AS (SELECT unnest(programs, recursive := true) FROM expected_asset), x AS (SELECT DISTINCT status, phase_verbatim, lower(coalesce(status, '') || ' ' || coalesce(phase_verbatim, '')) AS t FROM p)
SELECT status, phase_verbatim, CASE WHEN regexp_matches(t, 'discontinu|terminat|removed|withdrawn') THEN 'discontinued' WHEN regexp_matches(t, 'hold|pause|suspend') THEN 'paused' ELSE 'active' END AS class FROM x""")
def status_classes(s: SparkSession, d: str) -> DataFrame:
    said = table(s, d, "expected_asset").select(F.explode("programs").alias("p")).select("p.status", "p.phase_verbatim").distinct()
    return said.select("status", "phase_verbatim", tx.development_status(F.col("status"), F.col("phase_verbatim"), F.lit(None).cast("string")).alias("class"))


@query(r"""WITH x AS (SELECT DISTINCT name FROM (SELECT unnest(partners, recursive := true) FROM expected_asset) WHERE name IS NOT NULL),
n AS (SELECT name, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '\([^)]*\)', ' ', 'g'),
 '\b(inc|llc|ltd|corp|corporation|co|company|pharmaceuticals?|pharma|therapeutics|biopharma|biosciences?|sa|ag|gmbh|plc|nv|monoclonals|a johnson . johnson company)\b\.?', ' ', 'gi'), '[.,]', ' ', 'g'), '\s+', ' ', 'g')) AS c FROM x)
SELECT name, nullif(c, '') AS display, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS key FROM n""")
def partner_names(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "expected_asset").select(F.explode("partners.name").alias("name")).where(F.col("name").isNotNull()).distinct()
    return names.select("name", tx.partner_display(F.col("name")).alias("display"), tx.name_key(F.col("name")).alias("key"))


@query(r"""WITH x AS (SELECT DISTINCT preferred_name AS name FROM expected_asset WHERE preferred_name IS NOT NULL)
SELECT name, regexp_matches(name, '^[A-Za-z]{1,6}[- ]?\d{2,}') AS is_code, regexp_replace(lower(regexp_replace(regexp_replace(name, '[®™✦^#*∗◆†‡§~]+', '', 'g'), '\([^)]*\)', ' ', 'g')), '[^a-z0-9]', '', 'g') AS core,
CASE WHEN length(name) > 12 THEN substring(name, 1, 11) || '…' ELSE name END AS short FROM x""")
def asset_name_keys(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "expected_asset").select(F.col("preferred_name").alias("name")).where(F.col("name").isNotNull()).distinct()
    n = F.col("name")
    return names.select("name", tx.is_development_code(n).alias("is_code"), tx.core_name(n).alias("core"), tx.clamped(n, 12).alias("short"))


@query(r"""WITH x AS (SELECT DISTINCT indication_verbatim AS verbatim FROM program_indication WHERE indication_verbatim IS NOT NULL)
SELECT verbatim, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(verbatim, '\s*\([^)]*\)', '', 'g'), '\s+(in\s+)?combination with .*$', '', 'i'), ',\s+(adults?|patients?|in\b).*$', '', 'i'),
 '^(\s*(\d+l\+?|first[- ]line|second[- ]line|third[- ]line)\s+)+', '', 'i'), '^[ ,;]+|[ ,;]+$', '', 'g') AS cleaned FROM x""")
def cleaned_indications(s: SparkSession, d: str) -> DataFrame:
    said = table(s, d, "program_indication").select(F.col("indication_verbatim").alias("verbatim")).where(F.col("verbatim").isNotNull()).distinct()
    return said.select("verbatim", tx.clean_indication(F.col("verbatim")).alias("cleaned"))


@query(rf"""WITH h AS (SELECT doc_id, source, sha256(trim(regexp_replace(text, '{_WHITE}', ' ', 'g'))) AS hash FROM documents)
SELECT hash, min(doc_id) AS first_doc, count(*) AS copies, count(DISTINCT source) AS sources FROM h GROUP BY 1""")
def distinct_contents(s: SparkSession, d: str) -> DataFrame:
    hashed = table(s, d, "documents").select("doc_id", "source", tx.content_hash(F.col("text")).alias("hash"))
    return hashed.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.countDistinct("source").alias("sources"))


@query(r"""WITH h AS (SELECT source_id, capture_id, captured_at, list_sort(list(DISTINCT asset_id || ':' || coalesce(lower(trim(phase_code)), ''))) AS content
 FROM capture_asset WHERE asset_id IS NOT NULL GROUP BY 1, 2, 3)
SELECT source_id, capture_id, len(content) AS lines, lag(content) OVER w IS DISTINCT FROM content AS changed FROM h WINDOW w AS (PARTITION BY source_id ORDER BY captured_at, capture_id)""")
def captures_with_hash_skip(s: SparkSession, d: str) -> DataFrame:
    """Whether a capture's content differs from that of the capture before of its source.

    The digest of a capture is the exclusive-or of its distinct lines' two
    hashes with their number: partial sums combine before the shuffle and no
    capture is gathered in one place.
    """
    from sedimenta.operators.ordered import neighbour, with_blocks

    line = F.concat("asset_id", F.lit(":"), F.coalesce(F.lower(F.trim("phase_code")), F.lit("")))
    capture = ["source_id", "capture_id", "captured_at"]
    lines = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull()).select(*capture, F.xxhash64(line).alias("d1"), F.xxhash64(F.lit("b"), line).alias("d2")).distinct()
    digests = lines.groupBy(*capture).agg(F.struct(F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.count(F.lit(1)).alias("n")).alias("digest"))
    seen = neighbour(with_blocks(digests, ["source_id"], "captured_at"), ["source_id"], ["captured_at", "capture_id"], F.col("digest"), "before")
    return seen.select("source_id", "capture_id", F.col("digest.n").alias("lines"), (~F.col("digest").eqNullSafe(F.col("before"))).alias("changed"))


_PHASE_WORDS = r"\b(pre[- ]?clinical|phase\s*[1-4]|phase\s*(?:i{1,3}|iv)\b|ph\s*[1-3]\b|registration|filed|approved|marketed|commercial|discovery)\b"


@query(rf"""WITH x AS (SELECT doc_id, len(regexp_extract_all(text, '{_PHASE_WORDS}', 0, 'i')) AS hits, len(regexp_extract_all(text, '<tr\b', 0, 'i')) AS rows, regexp_matches(text, '<table\b', 'i') AS has_table FROM documents)
SELECT doc_id, hits::INT AS hits, CASE WHEN doc_id % 3 = 0 AND hits < 3 THEN 'image_page' WHEN has_table AND rows >= 4 AND hits >= 3 THEN 'html_table' WHEN hits >= 3 AND rows < 4 THEN 'js_cards' ELSE 'pipeline_page' END AS class FROM x""")
def page_classes(s: SparkSession, d: str) -> DataFrame:
    """Class of every document read as a page; every third is taken to show an image."""
    docs = table(s, d, "documents")
    return docs.select("doc_id", tx.phase_hits(F.col("text")).alias("hits"), web.page_class(F.col("text"), F.col("text"), F.col("doc_id") % 3 == 0).alias("class"))


@query(r"""WITH u AS (SELECT doc_id, 'https://www.example.org/' || source || '/' || doc_id || CASE source WHEN 'annual_report' THEN '.pdf' WHEN 'qa_note' THEN '.XLSX?v=2' WHEN 'legal_filing' THEN '.csv#top' ELSE '' END AS url FROM documents),
t AS (SELECT *, regexp_replace(lower(url), '[?#].*$', '') AS path FROM u)
SELECT doc_id, url, CASE WHEN path LIKE '%.csv' THEN 'csv_doc' WHEN path LIKE '%.xlsx' THEN 'xlsx_doc' WHEN path LIKE '%.pdf' THEN 'pdf_doc' END AS type,
CASE WHEN path LIKE '%.csv' THEN 5 WHEN path LIKE '%.xlsx' THEN 10 WHEN path LIKE '%.pdf' THEN 20 ELSE 50 END AS rank,
CASE WHEN source_hit THEN 100 ELSE 0 END AS score FROM (SELECT *, regexp_matches(path, '^https://[^/]*/.*pipeline') AS source_hit FROM t)""")
def source_urls(s: SparkSession, d: str) -> DataFrame:
    ending = F.when(F.col("source") == "annual_report", ".pdf").when(F.col("source") == "qa_note", ".XLSX?v=2").when(F.col("source") == "legal_filing", ".csv#top").otherwise("")
    urls = table(s, d, "documents").select("doc_id", F.concat(F.lit("https://www.example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string"), ending).alias("url"))
    kind = web.url_type(F.col("url"))
    return urls.select("doc_id", "url", kind.alias("type"), web.source_rank(F.coalesce(kind, F.lit(web.DEFAULT_TYPE))).alias("rank"), web.link_score(F.col("url"), F.lit(None).cast("string")).alias("score"))


@query("""WITH c AS (SELECT source_id, capture_id, captured_at, count(DISTINCT asset_id) AS assets FROM capture_asset WHERE asset_id IS NOT NULL GROUP BY 1, 2, 3),
p AS (SELECT *, lag(assets) OVER (PARTITION BY source_id ORDER BY captured_at, capture_id) AS previous FROM c),
e AS (SELECT *, greatest(2, round_even(previous * 0.1, 0)) AS tol, abs(previous - assets) AS delta FROM p)
SELECT capture_id, assets, previous,
CASE WHEN previous >= 5 AND 1 - assets / previous > 0.4 THEN 'fail' WHEN previous IS NOT NULL AND delta > 0 THEN 'warn' ELSE 'pass' END AS verdict,
CASE WHEN previous >= 5 AND 1 - assets / previous > 0.4 THEN 0.93 WHEN previous IS NOT NULL AND delta > tol THEN 0.8 WHEN previous IS NOT NULL AND delta > 0 THEN 0.88 ELSE 0.82 END::DOUBLE AS confidence FROM e""")
def capture_verdicts(s: SparkSession, d: str) -> DataFrame:
    """Completeness of every capture, the count before serving as the page's inferred count."""
    from sedimenta.operators.ordered import neighbour, with_blocks

    counts = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull()).groupBy("source_id", "capture_id", "captured_at").agg(F.countDistinct("asset_id").alias("assets"))
    seen = neighbour(with_blocks(counts, ["source_id"], "captured_at"), ["source_id"], ["captured_at", "capture_id"], F.col("assets"), "previous")
    v = quality.verdict(F.col("assets"), F.col("assets"), F.col("previous"), F.lit(False), F.col("previous"))
    return seen.select("capture_id", "assets", "previous", v.alias("v")).select("capture_id", "assets", "previous", "v.verdict", "v.confidence")


@query("""WITH p AS (SELECT DISTINCT doc_id, area FROM subject_label WHERE annotator = 'ann1'), g AS (SELECT DISTINCT doc_id, area FROM subject_label WHERE annotator = 'ann2'),
b AS (SELECT coalesce(p.area, g.area) AS area, p.doc_id IS NOT NULL AS inp, g.doc_id IS NOT NULL AS ing FROM p FULL JOIN g ON p.doc_id = g.doc_id AND p.area = g.area),
c AS (SELECT area, count(*) FILTER (WHERE inp AND ing) AS tp, count(*) FILTER (WHERE NOT ing) AS fp, count(*) FILTER (WHERE NOT inp) AS fn FROM b GROUP BY 1),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END AS r FROM c)
SELECT area, tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1, round(p, 4) >= 0.95 AND round(r, 4) >= 0.9 AS passed FROM r""")
def annotator_scores(s: SparkSession, d: str) -> DataFrame:
    labels = table(s, d, "subject_label")
    of = lambda who: labels.where(F.col("annotator") == who)
    return quality.gate(quality.scores(of("ann1"), of("ann2"), ["doc_id", "area"], ["area"]))


@query(r"""WITH a AS (SELECT DISTINCT * FROM expected_asset WHERE preferred_name IS NOT NULL), k AS (SELECT *, regexp_replace(lower(preferred_name), '[^a-z0-9]+', '', 'g') AS asset FROM a),
f AS (SELECT DISTINCT snapshot_id, 'asset' AS category, asset, '' AS value FROM k
UNION SELECT snapshot_id, 'modality', asset, regexp_replace(lower(modality_verbatim), '[^a-z0-9]+', '', 'g') FROM k WHERE modality_verbatim <> ''
UNION SELECT snapshot_id, 'target', asset, regexp_replace(lower(target_verbatim), '[^a-z0-9]+', '', 'g') FROM k WHERE target_verbatim <> ''
UNION SELECT snapshot_id, 'program', asset, regexp_replace(lower(coalesce(p.indication_verbatim, '')), '[^a-z0-9]+', '', 'g') FROM (SELECT snapshot_id, asset, unnest(programs) AS p FROM k)
UNION SELECT snapshot_id, 'phase', asset, indication || '/' || CASE key {IDENT} ELSE key END FROM (SELECT snapshot_id, asset, regexp_replace(lower(coalesce(p.indication_verbatim, '')), '[^a-z0-9]+', '', 'g') AS indication, coalesce(regexp_replace({PRE}, '[^a-z0-9]+', '', 'g'), '') AS key FROM (SELECT snapshot_id, asset, unnest(programs) AS p FROM k))
UNION SELECT snapshot_id, 'partner', asset, regexp_replace(lower(coalesce(p.name, '')), '[^a-z0-9]+', '', 'g') FROM (SELECT snapshot_id, asset, unnest(partners) AS p FROM k))
SELECT category, count(*) AS facts, count(DISTINCT asset) AS assets FROM f GROUP BY 1""".replace("{IDENT}", _IDENTITY).replace("{PRE}", _PRECLEAN.format(c="coalesce(p.phase_verbatim, '')")))
def fact_counts(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).withColumnRenamed("snapshot_id", "doc")
    facts = quality.asset_facts(docs)
    return facts.groupBy("category").agg(F.count(F.lit(1)).alias("facts"), F.countDistinct("asset").alias("assets"))


@query("""SELECT event_type, TRY_CAST(props->>'$.k' AS INT) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def json_properties(s: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(s, d, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""WITH a AS (SELECT DISTINCT * FROM expected_asset)
SELECT company_id, count(*) AS assets, coalesce(sum(len(programs)), 0)::BIGINT AS programs, coalesce(sum(len(partners)), 0)::BIGINT AS partners,
round(coalesce(sum(len(list_filter(programs, lambda p: p.phase_verbatim <> '' AND p.indication_verbatim <> ''))) / nullif(sum(len(programs)), 0), 0), 3) AS quality FROM a GROUP BY 1""")
def nested_counts(s: SparkSession, d: str) -> DataFrame:
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)
    sound = F.size(F.filter("programs", lambda p: (F.coalesce(p["phase_verbatim"], F.lit("")) != "") & (F.coalesce(p["indication_verbatim"], F.lit("")) != "")))
    rows = table(s, d, "expected_asset").distinct().select("company_id", size("programs").alias("p"), size("partners").alias("q"), F.when(F.col("programs").isNotNull(), sound).otherwise(0).alias("g"))
    return rows.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("assets"), F.sum("p").alias("programs"), F.sum("q").alias("partners"),
        F.round(F.when(F.sum("p") > 0, F.sum("g") / F.sum("p")).otherwise(0.0), 3).alias("quality"),
    )


@query("""SELECT route, count(*) AS n FROM (SELECT DISTINCT expected_id, list_filter(additional_fields, lambda f: contains(lower(f.name), 'route'))[1].value AS route FROM expected_asset) GROUP BY 1""")
def named_fields(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "expected_asset").select("expected_id", tx.named_value(F.col("additional_fields"), "route").alias("route")).distinct()
    return rows.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


_TRI = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring('  ' || w || ' ', i, 3)))))"
_LEX = """t AS (SELECT id, text, {tri} AS g FROM items), lex AS (SELECT q.id AS query, t.id, round(len(list_intersect(t.g, q.g)) / len(list_distinct(list_concat(t.g, q.g))), 9) AS similarity
 FROM t, t q WHERE q.id % 20 = 0), lr AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) - 1 AS rank FROM lex WHERE similarity > 0.05)""".replace("{tri}", _TRI.format(c="text"))
_VEC = """v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings), vr AS (SELECT q.id AS query, v.id, round(list_cosine_distance(v.e, q.e), 9) + 0.0 AS distance FROM v, v q WHERE q.id % 20 = 0),
vq AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, id) - 1 AS rank FROM vr)"""


def _names(s: SparkSession, d: str) -> DataFrame:
    """One row per distinct name of a part, under its smallest key."""
    return table(s, d, "part").groupBy(F.col("p_name").alias("text")).agg(F.min("p_partkey").alias("id")).select("id", "text")


def _queries(rows: DataFrame) -> DataFrame:
    """The queries of a search: every row whose id is divisible by 20."""
    return rows.where(F.col("id") % 20 == 0)


@query(f"WITH items AS (SELECT min(p_partkey) AS id, p_name AS text FROM part GROUP BY p_name), {_LEX} SELECT query, id, similarity, rank FROM lr WHERE rank < 10")
def lexical_ranking(s: SparkSession, d: str) -> DataFrame:
    rows = _names(s, d)
    return search.lexical_search(rows, _queries(rows), 10)


@query(f"WITH {_VEC} SELECT query, id, distance, rank FROM vq WHERE rank < 10")
def vector_ranking(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "embeddings").withColumnRenamed("vec_id", "id")
    return search.vector_search(rows, _queries(rows), 10)


@query(f"""WITH items AS (SELECT p_partkey AS id, p_name AS text FROM part JOIN embeddings ON vec_id = p_partkey), {_LEX}, {_VEC},
r AS (SELECT query, id, rank FROM lr WHERE rank < 100 UNION ALL SELECT vq.query, vq.id, vq.rank FROM vq WHERE rank < 200 AND query IN (SELECT id FROM items) AND id IN (SELECT id FROM items)),
f AS (SELECT query, id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score FROM r GROUP BY 1, 2)
SELECT query, id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS place FROM f QUALIFY place <= 20""")
def fused_ranking(s: SparkSession, d: str) -> DataFrame:
    """Parts that have a vector, ranked for each query by name and by vector, both fused."""
    vectors = table(s, d, "embeddings").withColumnRenamed("vec_id", "id")
    items = table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text")).join(vectors, "id")
    near = search.vector_search(vectors, _queries(vectors), 200).join(items.select("id"), "id", "left_semi").join(items.select(F.col("id").alias("query")), "query", "left_semi")
    return search.fused_search(20, search.lexical_search(items, _queries(items), 100), near)


_OBS = """o AS (SELECT source_id AS grp, capture_id, captured_at, period, asset_id, name, nullif(lower(trim(phase_code)), '') AS phase, list_sort(list_distinct(coalesce(partners, []))) AS partners
 FROM (SELECT DISTINCT * FROM capture_asset) WHERE asset_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY capture_id, asset_id ORDER BY loaded_at DESC, phase_code DESC) = 1),
c AS (SELECT grp, capture_id, captured_at, max(period) AS period, count(*) AS n, row_number() OVER (PARTITION BY grp ORDER BY captured_at, capture_id) AS rn FROM o GROUP BY 1, 2, 3),
g AS (SELECT grp, rn, capture_id, n, true AS ok, [n] AS last4, NULL::DOUBLE AS trail FROM c WHERE rn = 1
 UNION ALL SELECT c.grp, c.rn, c.capture_id, c.n, c.n >= 0.6 * list_aggregate(g.last4, 'median'), CASE WHEN c.n >= 0.6 * list_aggregate(g.last4, 'median') THEN list_append(g.last4, c.n)[-4:] ELSE g.last4 END, list_aggregate(g.last4, 'median')
 FROM g JOIN c ON c.grp = g.grp AND c.rn = g.rn + 1)"""


def _observations(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull())
    code = F.lower(F.trim("phase_code"))
    content = F.struct("loaded_at", F.col("phase_code").alias("raw"), "period", "name", F.when(code != "", code).alias("phase_code"), F.array_sort(F.array_distinct(F.coalesce("partners", F.array().cast("array<string>")))).alias("partners"))
    latest = rows.groupBy("source_id", "capture_id", "captured_at", "asset_id").agg(F.max(content).alias("m"))
    return latest.select(F.col("source_id").alias("group"), "capture_id", "captured_at", "asset_id", "m.period", "m.name", "m.phase_code", "m.partners")


@query(f'WITH RECURSIVE {_OBS} SELECT grp AS "group", capture_id, n::INT AS assets, trail AS trail_median, ok AS accepted FROM g')
def quarantined_captures(s: SparkSession, d: str) -> DataFrame:
    return changes.guarded_captures(_observations(s, d)).select("group", "capture_id", "assets", "trail_median", "accepted")


_LABEL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in changes.PHASE_LABELS.items()) + " ELSE {c} END"
_ORDER = "CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in changes.PHASE_ORDER.items()) + " ELSE 0 END"
_FEED = f"""WITH RECURSIVE {_OBS},
ac AS (SELECT g.grp, g.capture_id, c.captured_at, c.period, row_number() OVER (PARTITION BY g.grp ORDER BY g.rn) - 1 AS place FROM g JOIN c ON c.grp = g.grp AND c.rn = g.rn WHERE g.ok),
s AS (SELECT o.grp, o.asset_id, o.name, o.phase, o.partners, o.captured_at, ac.period, ac.place, lag(ac.place) OVER w AS pp, lag(o.captured_at) OVER w AS pat, lag(o.phase) OVER w AS pph, lag(o.partners) OVER w AS ppa, lead(ac.place) OVER w AS nx, max(ac.place) OVER (PARTITION BY o.grp) AS dummy
 FROM o JOIN ac ON o.grp = ac.grp AND o.capture_id = ac.capture_id WINDOW w AS (PARTITION BY o.grp, o.asset_id ORDER BY ac.place)),
ends AS (SELECT grp, max(place) AS last_place FROM ac GROUP BY 1),
ev AS (
SELECT grp, 'asset_added' AS type, asset_id, name AS asset, period, NULL::TIMESTAMP AS eff_min, captured_at AS eff_max, 'confirmed' AS status, NULL::VARCHAR AS from_phase, {_LABEL.format(c='phase')} AS to_phase, NULL::VARCHAR AS direction, NULL::VARCHAR AS last_phase, NULL::VARCHAR AS exit_class, NULL::VARCHAR AS partner FROM s WHERE pp IS NULL AND place > 0
UNION ALL SELECT grp, 'asset_reappeared', asset_id, name, period, pat, captured_at, 'confirmed', NULL, NULL, NULL, NULL, NULL, NULL FROM s WHERE place - pp > 2
UNION ALL SELECT grp, 'asset_phase_changed', asset_id, name, period, pat, captured_at, 'confirmed', {_LABEL.format(c='pph')}, {_LABEL.format(c='phase')}, CASE WHEN {_ORDER.format(c='phase')} > {_ORDER.format(c='pph')} THEN 'advance' WHEN {_ORDER.format(c='phase')} < {_ORDER.format(c='pph')} THEN 'regress' ELSE 'lateral' END, NULL, NULL, NULL FROM s WHERE place - pp <= 2 AND phase IS NOT NULL AND phase IS DISTINCT FROM pph
UNION ALL SELECT grp, 'partner_added', asset_id, name, period, NULL, captured_at, 'confirmed', NULL, NULL, NULL, NULL, NULL, unnest(list_filter(partners, lambda x: NOT list_contains(ppa, x))) FROM s WHERE place - pp <= 2
UNION ALL SELECT grp, 'partner_removed', asset_id, name, period, NULL, captured_at, 'confirmed', NULL, NULL, NULL, NULL, NULL, unnest(list_filter(ppa, lambda x: NOT list_contains(partners, x))) FROM s WHERE place - pp <= 2
UNION ALL SELECT s.grp, 'asset_left_pipeline', s.asset_id, s.name, f.period, s.captured_at, f.captured_at, CASE WHEN coalesce(nx, last_place + 1) - s.place - 1 >= 2 THEN 'confirmed' ELSE 'provisional' END, NULL, NULL, NULL, {_LABEL.format(c='s.phase')},
 CASE WHEN s.phase IN ('filed', 'approved') THEN 'likely_approved_graduated' WHEN s.phase = 'phase_3' THEN 'late_stage_exit_ambiguous' ELSE 'likely_discontinued_early' END, NULL
 FROM s JOIN ends USING (grp) JOIN ac f ON f.grp = s.grp AND f.place = s.place + 1 WHERE coalesce(nx, last_place + 1) - s.place - 1 >= 2 OR (nx IS NULL AND last_place > s.place))
"""


@query(_FEED + 'SELECT grp AS "group", * EXCLUDE (grp) FROM ev')
def change_feed(s: SparkSession, d: str) -> DataFrame:
    return changes.change_feed(_observations(s, d))


@query(_FEED + "SELECT type, status, coalesce(direction, exit_class, '') AS kind, count(*) AS events, count(DISTINCT asset_id) AS assets FROM ev GROUP BY 1, 2, 3")
def change_summary(s: SparkSession, d: str) -> DataFrame:
    feed = changes.change_feed(_observations(s, d))
    return feed.groupBy("type", "status", F.coalesce("direction", "exit_class", F.lit("")).alias("kind")).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("asset_id").alias("assets"))


@query("""SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'signup') AS signup, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'click') AS click,
count(*) FILTER (WHERE event_type = 'purchase') AS purchase, count(*) FILTER (WHERE event_type = 'error') AS error, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def daily_distribution(s: SparkSession, d: str) -> DataFrame:
    kinds = ["signup", "view", "click", "purchase", "error"]
    counts = [F.count(F.when(F.col("event_type") == k, 1)).alias(k) for k in kinds]
    return table(s, d, "events").groupBy(F.to_date("ts").alias("day")).agg(*counts, F.countDistinct("user_id").alias("users"))


@query("""WITH q AS (SELECT DISTINCT source_id, capture_id, captured_at, coalesce(nullif(trim(period), ''), strftime(captured_at, '%Y-%m-%d')) AS period FROM capture_asset),
a AS (SELECT source_id, period, date_trunc('quarter', captured_at) + INTERVAL 45 DAY AS anchor, captured_at, capture_id FROM q)
SELECT source_id, date_trunc('quarter', captured_at) AS quarter, arg_min(capture_id, (abs(date_diff('day', anchor::DATE, captured_at::DATE)), capture_id)) AS capture_id, count(DISTINCT capture_id) AS captures FROM a GROUP BY 1, 2""")
def quarter_captures(s: SparkSession, d: str) -> DataFrame:
    """The capture nearest to the middle of each quarter, per source."""
    rows = table(s, d, "capture_asset").select("source_id", "capture_id", "captured_at").distinct()
    quarter = F.date_trunc("quarter", "captured_at").cast("timestamp_ntz")
    off = F.abs(F.date_diff(F.to_date("captured_at"), F.date_add(F.to_date(quarter), 45)))
    return rows.groupBy("source_id", quarter.alias("quarter")).agg(F.min_by("capture_id", F.struct(off, F.col("capture_id"))).alias("capture_id"), F.countDistinct("capture_id").alias("captures"))


@query("""WITH g AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, lag(o_orderpriority) OVER w AS pp, lag(o_orderstatus) OVER w AS ps, lag(o_orderkey) OVER w AS pk FROM (
SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
v AS (SELECT * FROM g WHERE pk IS NULL OR pp <> o_orderpriority OR ps <> o_orderstatus)
SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM v""")
def customer_history(s: SparkSession, d: str) -> DataFrame:
    """Versions of each customer's last order priority and status."""
    orders = table(s, d, "orders").groupBy("o_custkey", "o_orderdate").agg(F.max_by(F.struct("o_orderpriority", "o_orderstatus"), "o_orderkey").alias("m")).select("o_custkey", "o_orderdate", "m.*")
    return history.build_history(orders, ["o_custkey"], ["o_orderpriority", "o_orderstatus"], "o_orderdate")


@query(r"""WITH RECURSIVE n AS (SELECT DISTINCT x AS name, regexp_replace(lower(regexp_replace(regexp_replace(x, '[®™✦^#*∗◆†‡§~]+', '', 'g'), '\([^)]*\)', ' ', 'g')), '[^a-z0-9]', '', 'g') AS key FROM (SELECT canonical AS x FROM curated_aliases UNION SELECT unnest(members) FROM curated_aliases) WHERE x IS NOT NULL)
SELECT name, CASE WHEN key = '' THEN name ELSE min(name) OVER (PARTITION BY key) END AS "group" FROM n""")
def name_groups(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "curated_aliases").select(F.explode(F.concat(F.array("canonical"), F.coalesce("members", F.array().cast("array<string>")))).alias("name")).where(F.col("name").isNotNull()).distinct()
    return graph.identity_groups(names.withColumn("key", tx.core_name(F.col("name"))))


@query(r"""WITH al AS (SELECT unnest(members) AS name, alias_row_id AS asset_id FROM curated_aliases), sy AS (SELECT canonical AS name, alias_row_id AS asset_id FROM curated_aliases),
w AS (SELECT DISTINCT name FROM (SELECT name FROM al UNION SELECT lower(name) FROM sy UNION SELECT preferred_name FROM expected_asset) WHERE name IS NOT NULL),
a AS (SELECT name, min(asset_id) AS i FROM al WHERE name IS NOT NULL GROUP BY 1), b AS (SELECT lower(trim(name)) AS k, min(asset_id) AS i FROM sy WHERE name IS NOT NULL GROUP BY 1), c AS (SELECT regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS k, min(asset_id) AS i FROM sy WHERE name IS NOT NULL GROUP BY 1)
SELECT w.name, coalesce(a.i, b.i, c.i) AS asset_id FROM w LEFT JOIN a ON w.name = a.name LEFT JOIN b ON lower(trim(w.name)) = b.k LEFT JOIN c ON c.k <> '' AND regexp_replace(lower(w.name), '[^a-z0-9]+', '', 'g') = c.k""")
def resolved_names(s: SparkSession, d: str) -> DataFrame:
    curated = table(s, d, "curated_aliases")
    aliases = curated.select(F.explode("members").alias("name"), F.col("alias_row_id").alias("asset_id"))
    synonyms = curated.select(F.col("canonical").alias("name"), F.col("alias_row_id").alias("asset_id"))
    names = aliases.select("name").union(synonyms.select(F.lower("name"))).union(table(s, d, "expected_asset").select("preferred_name")).where(F.col("name").isNotNull()).distinct()
    return identity.resolved(names, aliases, synonyms)


@query("""WITH k AS (SELECT DISTINCT program_id, indication_id, company_id FROM program_observation), old AS (SELECT DISTINCT program_id, indication_id, company_id FROM program_indication)
SELECT * FROM k UNION SELECT program_id, indication_id, company_id FROM change_event WHERE (program_id, indication_id, company_id) NOT IN (SELECT (program_id, indication_id, company_id) FROM old)""")
def programs_to_insert(s: SparkSession, d: str) -> DataFrame:
    """Program keys that observations and events name and the history lacks."""
    new = table(s, d, "program_observation").select(*KEYS).unionByName(table(s, d, "change_event").select(*KEYS))
    return identity.missing(new, table(s, d, "program_indication"), KEYS)


@query("""SELECT p.p_brand, p.p_type, count(DISTINCT l.l_suppkey) AS suppliers, sum(l.l_extendedprice::DECIMAL(12, 2) * (1 - l.l_discount::DECIMAL(4, 2)))::DOUBLE AS revenue FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_quantity >= 10 GROUP BY 1, 2""")
def brand_revenue(s: SparkSession, d: str) -> DataFrame:
    lines = table(s, d, "lineitem").where(F.col("l_quantity") >= 10)
    joined = lines.join(table(s, d, "part"), lines["l_partkey"] == F.col("p_partkey"))
    return joined.groupBy("p_brand", "p_type").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double").alias("revenue"))


@query("""WITH l AS (SELECT DISTINCT target_verbatim AS key, regexp_replace(lower(preferred_name), '[^a-z0-9]+', '', 'g') AS member FROM expected_asset WHERE target_verbatim <> '' AND preferred_name IS NOT NULL),
h AS (SELECT key, min(member) AS hub, count(*) AS n FROM l GROUP BY 1 HAVING count(*) > 1) SELECT key, member, hub, 'mechanism' AS kind, 1.0::DOUBLE AS weight FROM l JOIN h USING (key)""")
def mechanism_edges(s: SparkSession, d: str) -> DataFrame:
    links = table(s, d, "expected_asset").where((F.col("target_verbatim") != "") & F.col("preferred_name").isNotNull()).select(tx.name_key(F.col("preferred_name")).alias("member"), F.col("target_verbatim").alias("key"))
    return graph.shared_groups(links, "mechanism", 1.0)


@query("""WITH b AS (SELECT program_id AS member, min(born_on) AS born_on FROM program_born_on GROUP BY 1), ti AS (SELECT DISTINCT program_id AS member, company_id AS key FROM program_indication), ii AS (SELECT DISTINCT program_id AS member, indication_id AS key FROM program_indication),
me AS (SELECT min(program_id) AS node FROM program_indication),
m AS (SELECT DISTINCT member FROM ti, me WHERE key IN (SELECT key FROM ti, me WHERE member = node) AND member <> node),
c AS (SELECT DISTINCT member FROM ii, me WHERE key IN (SELECT key FROM ii, me WHERE member = node) AND member <> node AND member NOT IN (SELECT member FROM m)),
e AS (SELECT member, 'mechanism' AS kind, 1.0::DOUBLE AS weight FROM m UNION ALL SELECT member, 'competitive', 0.7 FROM c)
SELECT e.member, e.kind, e.weight, greatest(b.born_on, o.born_on) AS born_on FROM e LEFT JOIN b USING (member), (SELECT born_on FROM b, me WHERE member = node) o""")
def related_programs(s: SparkSession, d: str) -> DataFrame:
    """Neighbours of the first program: companies stand in for targets."""
    versions = table(s, d, "program_indication")
    node = F.lit(versions.agg(F.min("program_id")).first()[0])
    links = lambda c: versions.select(F.col("program_id").alias("member"), F.col(c).alias("key")).distinct()
    born = table(s, d, "program_born_on").groupBy(F.col("program_id").alias("member")).agg(F.min("born_on").alias("born_on"))
    return graph.neighbours(node, links("company_id"), links("indication_id"), born)


@query(_FEED + """, t AS (SELECT period, type, direction, exit_class, status FROM ev WHERE period IS NOT NULL)
SELECT period, count(*) FILTER (WHERE type = 'asset_added') AS added, count(*) FILTER (WHERE type = 'asset_phase_changed' AND direction = 'advance') AS advances,
count(*) FILTER (WHERE type = 'asset_left_pipeline' AND status = 'confirmed') AS exits, count(*) FILTER (WHERE type = 'asset_left_pipeline' AND exit_class = 'late_stage_exit_ambiguous') AS late_exits,
count(*) FILTER (WHERE type LIKE 'partner%') AS partner_changes FROM t GROUP BY 1""")
def history_summary(s: SparkSession, d: str) -> DataFrame:
    feed = changes.change_feed(_observations(s, d)).where(F.col("period").isNotNull())
    n = lambda c: F.count(F.when(c, 1))
    kind, left = F.col("type"), F.col("type") == "asset_left_pipeline"
    return feed.groupBy("period").agg(
        n(kind == "asset_added").alias("added"), n((kind == "asset_phase_changed") & (F.col("direction") == "advance")).alias("advances"),
        n(left & (F.col("status") == "confirmed")).alias("exits"), n(left & (F.col("exit_class") == "late_stage_exit_ambiguous")).alias("late_exits"),
        n(kind.startswith("partner")).alias("partner_changes"),
    )


_KEY = "regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"


@query(f"""WITH a AS (SELECT DISTINCT company_id, preferred_name, captured_at, loaded_at, expected_id, programs FROM expected_asset WHERE preferred_name IS NOT NULL),
p AS (SELECT company_id, {_KEY.format(c='preferred_name')} AS asset, captured_at, loaded_at, expected_id, generate_subscripts(programs, 1) AS pos, unnest(programs) AS p FROM a),
k AS (SELECT company_id, asset, {_KEY.format(c='p.indication_verbatim')} AS indication, p.phase_verbatim AS phase, captured_at, loaded_at, expected_id, pos FROM p WHERE p.indication_verbatim IS NOT NULL)
SELECT company_id, asset, indication, phase, captured_at AS seen_at FROM k WHERE indication <> ''
QUALIFY row_number() OVER (PARTITION BY company_id, asset, indication ORDER BY captured_at DESC, loaded_at DESC, expected_id DESC, pos DESC) = 1""")
def gold_programs(s: SparkSession, d: str) -> DataFrame:
    """Nested documents loaded as programs: one row per company, asset and indication, as last seen."""
    rows = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).select("company_id", tx.name_key(F.col("preferred_name")).alias("asset"), "captured_at", "loaded_at", "expected_id", F.posexplode("programs").alias("pos", "p"))
    keyed = rows.withColumn("indication", tx.name_key(F.col("p.indication_verbatim"))).where(F.col("indication") != "")
    last = F.max_by(F.struct(F.col("p.phase_verbatim").alias("phase"), F.col("captured_at").alias("seen_at")), F.struct("captured_at", "loaded_at", "expected_id", "pos"))
    return keyed.groupBy("company_id", "asset", "indication").agg(last.alias("m")).select("company_id", "asset", "indication", "m.*")


@query("""WITH c AS (SELECT source_id, date_trunc('quarter', captured_at) AS quarter, count(DISTINCT asset_id) AS assets FROM capture_asset WHERE asset_id IS NOT NULL GROUP BY 1, 2),
q AS (SELECT DISTINCT quarter FROM c), b AS (SELECT source_id, min(quarter) AS first FROM c GROUP BY 1),
g AS (SELECT b.source_id, q.quarter, c.assets FROM b JOIN q ON q.quarter >= b.first LEFT JOIN c ON c.source_id = b.source_id AND c.quarter = q.quarter)
SELECT source_id, quarter, assets IS NOT NULL AS observed, last_value(assets IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY quarter) AS assets FROM g""")
def carried_forward(s: SparkSession, d: str) -> DataFrame:
    """Assets per source and quarter from its first on, quarters without a capture carrying the last count."""
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull())
    counts = rows.groupBy("source_id", F.date_trunc("quarter", "captured_at").cast("timestamp_ntz").alias("quarter")).agg(F.countDistinct("asset_id").alias("assets"))
    first = counts.groupBy("source_id").agg(F.min("quarter").alias("first"))
    last = F.lit(counts.agg(F.max("quarter")).first()[0]).cast("timestamp_ntz")
    seen = counts.select("quarter").distinct()  # as many as the years have
    grid = first.select("source_id", F.explode(F.sequence("first", last, F.expr("INTERVAL 3 MONTHS"))).alias("quarter")).join(seen, "quarter", "left_semi")
    w = Window.partitionBy("source_id").orderBy("quarter")
    return grid.join(counts, ["source_id", "quarter"], "left").select("source_id", "quarter", F.col("assets").isNotNull().alias("observed"), F.last("assets", ignorenulls=True).over(w).alias("assets"))


@query("""SELECT DISTINCT company_id, preferred_name, target_verbatim, mechanism_verbatim FROM expected_asset
WHERE upper(target_verbatim) = 'SYG1' OR mechanism_verbatim ILIKE '%SYG1%' OR len(list_filter(synonyms, lambda x: x ILIKE '%SYG1%')) > 0""")
def assets_by_target(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "expected_asset")
    hit = (F.upper("target_verbatim") == "SYG1") | F.col("mechanism_verbatim").ilike("%SYG1%") | F.exists("synonyms", lambda x: x.ilike("%SYG1%"))
    return a.where(hit).select("company_id", "preferred_name", "target_verbatim", "mechanism_verbatim").distinct()


@query("""WITH a AS (SELECT DISTINCT expected_id, preferred_name, modality_verbatim, target_verbatim, mechanism_verbatim, list_sort(list_distinct(list_transform(coalesce(programs, []), lambda p: p.indication_verbatim))) AS inds FROM expected_asset),
t AS (SELECT expected_id, array_to_string(list_filter([preferred_name, modality_verbatim, target_verbatim, mechanism_verbatim, array_to_string(list_filter(inds, lambda x: x IS NOT NULL), ', ')], lambda x: x IS NOT NULL AND trim(x, ' ') <> ''), ' | ') AS text FROM a)
SELECT expected_id, text, sha256('local-1024' || chr(10) || text) AS text_hash FROM t""")
def embedding_corpus(s: SparkSession, d: str) -> DataFrame:
    """The text to embed of each asset, with the hash that tells whether it changed."""
    a = table(s, d, "expected_asset")
    said = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.coalesce(F.col("programs.indication_verbatim"), F.array().cast("array<string>"))))), ", ")
    text = tx.embedding_text(F.col("preferred_name"), F.col("modality_verbatim"), F.col("target_verbatim"), F.col("mechanism_verbatim"), said)
    return a.select("expected_id", text.alias("text")).distinct().select("expected_id", "text", tx.embedding_hash("local-1024", F.col("text")).alias("text_hash"))


@query(f"""WITH {_PROGRAM} SELECT company_id, coalesce(phase_label, 'unmapped') AS phase, count(*) AS n, string_agg(DISTINCT indication, '; ' ORDER BY indication) AS indications, bool_or(status = 'active') AS any_active
FROM prog WHERE valid_to IS NULL AND status <> 'discontinued' GROUP BY 1, 2""")
def company_detail(s: SparkSession, d: str) -> DataFrame:
    current = search.faceted(_programs(s, d).where(F.col("valid_to").isNull()), {}, active_only=True)
    return current.groupBy("company_id", F.coalesce("phase_label", F.lit("unmapped")).alias("phase")).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set("indication")), "; ").alias("indications"), F.bool_or(F.col("status") == "active").alias("any_active")
    )


@query("""SELECT program_id FROM program_indication INTERSECT SELECT program_id FROM change_event WHERE event_at IS NOT NULL""")
def programs_in_both(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "program_indication").select("program_id").intersect(table(s, d, "change_event").where(F.col("event_at").isNotNull()).select("program_id"))


@query("""WITH d AS (SELECT company_id, count(*) AS documents, count(DISTINCT source) AS sources, max(captured_at) AS last_captured, arg_max(source, (captured_at, doc_id)) AS last_source FROM documents GROUP BY 1),
p AS (SELECT company_id, count(DISTINCT program_id) AS programs FROM program_indication GROUP BY 1)
SELECT d.*, coalesce(p.programs, 0) AS programs, CASE WHEN p.programs IS NULL THEN 'not_attempted' ELSE 'loaded' END AS status FROM d LEFT JOIN p USING (company_id)""")
def coverage_report(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").groupBy("company_id").agg(
        F.count(F.lit(1)).alias("documents"), F.countDistinct("source").alias("sources"), F.max("captured_at").alias("last_captured"), F.max_by("source", F.struct("captured_at", "doc_id")).alias("last_source")
    )
    programs = table(s, d, "program_indication").groupBy("company_id").agg(F.countDistinct("program_id").alias("programs"))
    return docs.join(programs, "company_id", "left").select(*docs.columns, F.coalesce("programs", F.lit(0)).alias("programs"), F.when(F.col("programs").isNull(), "not_attempted").otherwise("loaded").alias("status"))
