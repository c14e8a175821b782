"""Queries of pages, sources and quality: link discovery, structured pages, reading decisions, verdicts, scores, round trips."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions import text as tx
from sedimenta.functions import web
from sedimenta.operators import identity, quality, search
from sedimenta.plans.catalogue import _KEY, query
from sedimenta.plans.gold import _GOLD, asset_dimension, gold_rows
from sedimenta.session import table
from sedimenta.sources import documents, snapshots

# ---- pages made of the rows of documents: base and html ----

_HTML = """pg AS (SELECT doc_id, 'https://www.example.org/' || source || '/index.html' AS base,
 '<a href="/files/pipeline-' || doc_id || '.xlsx?v=2">x</a><a href="chart.pdf">c</a><a HREF=''https://cdn.example.net/our-pipeline''>p</a><a href="about">a</a><a href="chart.pdf">again</a>'
 || '<img src="/i/logo.png" alt="logo"><img class="wide" data-src="pipeline-' || doc_id || '.png"><img src="/i/c.png" alt="Clinical programs">' AS html FROM documents)"""


def _pages(s: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    html = F.concat(
        F.lit('<a href="/files/pipeline-'), n, F.lit('.xlsx?v=2">x</a><a href="chart.pdf">c</a><a HREF=\'https://cdn.example.net/our-pipeline\'>p</a><a href="about">a</a><a href="chart.pdf">again</a>'),
        F.lit('<img src="/i/logo.png" alt="logo"><img class="wide" data-src="pipeline-'), n, F.lit('.png"><img src="/i/c.png" alt="Clinical programs">'),
    )
    return table(s, d, "documents").select("doc_id", F.concat(F.lit("https://www.example.org/"), "source", F.lit("/index.html")).alias("base"), html.alias("html"))


_RESOLVED = "CASE WHEN {h} LIKE 'http%' THEN {h} WHEN {h} LIKE '/%' THEN 'https://www.example.org' || {h} ELSE regexp_replace(base, '[^/]*$', '') || {h} END"
_LINKS = f"""{_HTML}, l AS (SELECT DISTINCT doc_id, {_RESOLVED.format(h='h')} AS url FROM (SELECT doc_id, base, unnest(regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1, 'i')) AS h FROM pg)),
ty AS (SELECT doc_id, url, CASE WHEN regexp_matches(url, '\\.csv([?#].*)?$') THEN 'csv_doc' WHEN regexp_matches(url, '\\.xlsx([?#].*)?$') THEN 'xlsx_doc' WHEN regexp_matches(url, '\\.pdf([?#].*)?$') THEN 'pdf_doc' ELSE 'pipeline_page' END AS type FROM l),
di AS (SELECT *, CASE type WHEN 'csv_doc' THEN 5 WHEN 'xlsx_doc' THEN 10 WHEN 'pdf_doc' THEN 20 ELSE 50 END AS rank FROM ty WHERE type <> 'pipeline_page' OR url ILIKE '%pipeline%')"""


@query(f"WITH {_LINKS} SELECT doc_id, url, type, rank FROM di")
def discovered_links(s: SparkSession, d: str) -> DataFrame:
    found = _pages(s, d).select("doc_id", F.explode(web.discovered(F.col("base"), F.col("html"))).alias("l"))
    return found.select("doc_id", "l.url", "l.type", "l.rank")


@query(f"WITH {_LINKS} SELECT doc_id, url, type FROM di WHERE type IN ('csv_doc', 'xlsx_doc', 'pdf_doc') AND rank < 50 AND regexp_matches(url, '{web.FILE_HINTS}', 'i') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank, url) = 1")
def promoted_files(s: SparkSession, d: str) -> DataFrame:
    """The best linked file that outranks the page, where there is one."""
    links = discovered_links(s, d)
    fit = links.where(web.is_promotable(F.col("url"), F.col("type"), F.lit("pipeline_page")))
    return fit.groupBy("doc_id").agg(F.min_by(F.struct("url", "type"), F.struct("rank", "url")).alias("m")).select("doc_id", "m.*")


@query(f"WITH {_LINKS} SELECT url, min(type) AS type, count(*) AS pages FROM di WHERE url NOT IN (SELECT url FROM di WHERE doc_id % 2 = 0) GROUP BY 1")
def sources_to_insert(s: SparkSession, d: str) -> DataFrame:
    """Discovered URLs that aren't registered yet, once each."""
    links = discovered_links(s, d)
    known = links.where(F.col("doc_id") % 2 == 0).select("url")
    return links.join(known, "url", "left_anti").groupBy("url").agg(F.min("type").alias("type"), F.count(F.lit(1)).alias("pages"))


@query(f"WITH {_HTML} SELECT doc_id, list_sort(['https://www.example.org/i/c.png', regexp_replace(base, '[^/]*$', '') || 'pipeline-' || doc_id || '.png']) AS images FROM pg")
def pipeline_images(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("doc_id", web.image_urls(F.col("base"), F.col("html")).alias("images"))


_CARD = "'<div class=\"card\"><h4>' || {n} || '</h4><h5>Indication</h5><p>' || {i} || '</p><h5>Phase</h5><p><b>' || {p} || '</b></p><div class=\"bar\"> Fast&nbsp;track </div></div>'"


@query(f"""WITH {_GOLD}, c AS (SELECT company_id, snapshot_id, expected_id, pos, regexp_replace(preferred_name, '[<>&]', '', 'g') AS n, regexp_replace(indication_verbatim, '[<>&]', '', 'g') AS i, regexp_replace(coalesce(phase_verbatim, ''), '[<>&]', '', 'g') AS p FROM g),
t AS (SELECT *, trim(regexp_replace(n, '[\\s\\x{{00a0}}]+', ' ', 'g')) AS name, trim(regexp_replace(i, '[\\s\\x{{00a0}}]+', ' ', 'g')) AS indication, trim(regexp_replace(p, '[\\s\\x{{00a0}}]+', ' ', 'g')) AS phase FROM c)
SELECT expected_id, pos, name, indication, phase, 'Fast track' AS notes FROM t WHERE name <> '' AND indication <> '' AND phase <> ''""")
def structured_cards(s: SparkSession, d: str) -> DataFrame:
    """Programs read back from a page of cards, one card a program."""
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[<>&]", "")
    html = F.concat(
        F.lit('<div class="card"><h4>'), plain("preferred_name"), F.lit("</h4><h5>Indication</h5><p>"), plain("indication_verbatim"), F.lit("</p><h5>Phase</h5><p><b>"), plain("phase_verbatim"),
        F.lit('</b></p><div class="bar"> Fast&nbsp;track </div></div>'),
    )
    pages = gold_rows(s, d).select("expected_id", "pos", html.alias("html"))
    block, after = r'(?s)<div class="card">(.*?</div>)</div>', r"(?s)<h5>{}</h5>\s*<p>(.*?)</p>"
    found = web.cards(F.col("html"), block, r"(?s)<h4>(.*?)</h4>", after.format("Indication"), after.format("Phase"), r'(?s)<div class="bar">(.*?)</div>')
    return pages.select("expected_id", "pos", F.explode(found).alias("c")).select("expected_id", "pos", "c.*")


_HITS = r"len(regexp_extract_all(coalesce(text, ''), '\b(pre[- ]?clinical|phase\s*[1-4]|phase\s*(?:i{1,3}|iv)\b|ph\s*[1-3]\b|registration|filed|approved|marketed|commercial|discovery)\b', 0, 'i'))"


@query(f"""WITH x AS (SELECT doc_id, {_HITS} AS hits, (doc_id % 3 = 0) AS images, CASE doc_id % 7 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN NULL ELSE 200 END AS status, doc_id % 11 = 0 AS document, length(coalesce(text, '')) AS n,
 regexp_matches(lower(coalesce(text, '')), '{web.PRESS_MARKERS}') AS press FROM documents)
SELECT doc_id, CASE WHEN status IS NULL OR status IN (401, 403, 429, 503) OR (hits < 3 AND NOT images AND status < 400) THEN 'fallback' WHEN status >= 400 THEN 'give_up' ELSE 'keep' END AS decision,
CASE WHEN images AND hits < 3 THEN 'visual' WHEN NOT document AND NOT images AND hits >= 12 THEN 'text' ELSE 'both' END AS mode, coalesce(status < 400, true) AND NOT press AND (hits >= 3 OR (images AND n >= 200)) AS valid FROM x""")
def page_decisions(s: SparkSession, d: str) -> DataFrame:
    """Whether a rendered page is kept, how it is read, and whether it is a page about a pipeline at all."""
    status = F.when(F.col("doc_id") % 7 == 0, 403).when(F.col("doc_id") % 7 == 1, 404).when(F.col("doc_id") % 7 == 2, F.lit(None).cast("int")).otherwise(200)
    t, images = F.col("text"), F.col("doc_id") % 3 == 0
    mode = web.reading_mode(t, F.col("doc_id") % 11 == 0, images.cast("int"), F.lit("pipeline_page"))
    return table(s, d, "documents").select("doc_id", web.render_decision(status, t, images).alias("decision"), mode.alias("mode"), web.is_pipeline_page(status, t, images).alias("valid"))


@query(r"""WITH n AS (SELECT DISTINCT name FROM (SELECT preferred_name AS name FROM expected_asset UNION SELECT originator_verbatim FROM expected_asset UNION SELECT target_verbatim FROM expected_asset UNION SELECT indication_verbatim FROM program_indication) WHERE name IS NOT NULL)
SELECT name, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, regexp_replace(name, '(\w)[''’]s\b', '\1', 'g') AS plain,
regexp_matches(name, 'discontinu|removed|terminat|withdraw|inactiv|no longer|delist', 'i') AS inactive FROM n""")
def name_forms(s: SparkSession, d: str) -> DataFrame:
    """Slug, form without possessives, and whether a text says that something ended."""
    a = table(s, d, "expected_asset")
    names = a.select(F.explode(F.array("preferred_name", "originator_verbatim", "target_verbatim")).alias("name")).unionByName(table(s, d, "program_indication").select(F.col("indication_verbatim").alias("name"))).where(F.col("name").isNotNull()).distinct()
    n = F.col("name")
    return names.select("name", tx.slug(n).alias("slug"), tx.without_possessive(n).alias("plain"), n.rlike(tx.INACTIVE_WORDS).alias("inactive"))


_COUNTED = r"""list_filter(list_transform(list_concat(regexp_extract_all(coalesce(text, ''), '\b(?:pipeline|portfolio)\s+(?:includes|contains|comprises|has)\s+(\d{1,3})\b', 1, 'i'), list_concat(
 regexp_extract_all(coalesce(text, ''), '\b(\d{1,3})\s+(?:assets|programs|projects|medicines|molecules|compounds)\b', 1, 'i'), regexp_extract_all(coalesce(text, ''), '\btotal(?:\s+of)?\s+(\d{1,3})\s+(?:assets|programs|projects|medicines|molecules|compounds)\b', 1, 'i'))),
 lambda x: x::INT), lambda n: n BETWEEN 1 AND 250)"""


@query(f"""SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 42 ELSE list_min({_COUNTED}) END AS expected FROM documents""")
def expected_counts(s: SparkSession, d: str) -> DataFrame:
    """The known count of a page, else the smallest plausible one its text states."""
    return table(s, d, "documents").select("doc_id", tx.expected_count(F.col("text"), F.when(F.col("doc_id") % 10 == 0, 42)).alias("expected"))


@query(r"""WITH x AS (SELECT expected_id, company_id, list_sort(list_filter(list_transform(coalesce(partners, []), lambda p: p.name), lambda x: x IS NOT NULL)) AS parts, coalesce(page_notes, '') AS t FROM (SELECT DISTINCT * FROM expected_asset))
SELECT expected_id, sha256(array_to_string(list_concat([trim(regexp_replace(t, '[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))], parts), chr(10))) AS digest FROM x""")
def artifact_digests(s: SparkSession, d: str) -> DataFrame:
    """Digest of a page's notes and the names beside them, whose order doesn't count."""
    parts = F.coalesce(F.col("partners.name"), F.array().cast("array<string>"))
    return table(s, d, "expected_asset").distinct().select("expected_id", tx.hash_material(F.coalesce("page_notes", F.lit("")), parts).alias("digest"))


@query("""WITH x AS (SELECT company_id, list(['' || n_name, n_key, 'x'] ORDER BY n_key) AS body FROM (SELECT 'c' || n_regionkey AS company_id, n_name, '' || n_nationkey AS n_key FROM nation) GROUP BY 1)
SELECT company_id, array_to_string(list_concat(['| name | key |  |', '| --- | --- | --- |'], list_transform(body, lambda r: '| ' || r[1] || ' | ' || r[2] || ' | ' || r[3] || ' |')), chr(10)) AS markdown FROM x""")
def markdown_tables(s: SparkSession, d: str) -> DataFrame:
    """Rows of cells as a table: a blank row dropped, a short head padded."""
    cells = F.array("n_name", F.col("n_nationkey").cast("string"), F.lit("x"))
    rows = table(s, d, "nation").groupBy(F.concat(F.lit("c"), F.col("n_regionkey").cast("string")).alias("company_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("k"), cells.alias("r")))).alias("b"))
    head = F.array(F.array(F.lit("name"), F.lit("key")), F.array(F.lit(" "), F.lit(None).cast("string")))
    return rows.select("company_id", tx.markdown_table(F.concat(head, F.col("b.r"))).alias("markdown"))


# ---- quality ----

_VERDICT = f"""WITH {_GOLD}, sn AS (SELECT company_id, snapshot_id, min(coalesce(captured_at, loaded_at)) AS seen_at, count(DISTINCT CASE WHEN k <> '' THEN k END) AS assets, max(page_notes) AS text
 FROM (SELECT *, coalesce({_KEY.format(c='preferred_name')}, '') AS k FROM (SELECT DISTINCT * FROM expected_asset)) GROUP BY 1, 2),
np AS (SELECT snapshot_id, count(*) AS programs FROM g GROUP BY 1),
x AS (SELECT sn.*, coalesce(np.programs, 0) AS programs, company_id LIKE '%5' AS known, CASE WHEN company_id LIKE '%5' THEN 3 WHEN company_id LIKE '%4' THEN 2 END AS expected FROM sn LEFT JOIN np USING (snapshot_id)),
y AS (SELECT *, last_value(CASE WHEN assets > 0 THEN assets * 3 END IGNORE NULLS) OVER (PARTITION BY company_id ORDER BY seen_at, snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM x),
b AS (SELECT *, CASE WHEN abs(expected - programs) < abs(expected - assets) THEN programs ELSE assets END AS best FROM y),
v AS (SELECT *, abs(expected - best) AS delta, greatest(2, round_even(expected * 0.1, 0)) AS tol, coalesce(previous >= 5 AND 1 - assets / previous > 0.4, false) AS dropped FROM b),
w AS (SELECT *, CASE WHEN dropped OR assets = 0 OR coalesce(delta > tol AND known, false) THEN 'fail' WHEN delta > 0 THEN 'warn' ELSE 'pass' END AS verdict,
 CASE WHEN assets = 0 THEN 0.98 WHEN delta > tol AND known THEN 0.95 WHEN delta > tol THEN 0.80 WHEN delta > 0 THEN 0.88 ELSE 0.82 END AS sure FROM v)"""


@query(_VERDICT + """ SELECT snapshot_id, assets, programs, previous, CASE WHEN verdict <> 'fail' AND programs = 0 THEN 'warn' ELSE verdict END AS verdict,
greatest(CASE WHEN dropped THEN greatest(sure, 0.93) ELSE sure END, CASE WHEN programs = 0 THEN 0.9 ELSE 0.0 END)::DOUBLE AS confidence,
CASE WHEN dropped THEN 'rerender_with_repair_config' WHEN assets = 0 THEN 'rerender_and_reextract' WHEN delta > tol AND known THEN 'focused_reextract_missing_sections' WHEN programs = 0 THEN 'look' END AS action FROM w""")
def extraction_verdicts(s: SparkSession, d: str) -> DataFrame:
    """Completeness of every capture of documents: against a trusted or stated count, the last good one, and a second opinion."""
    a = table(s, d, "expected_asset").distinct().withColumn("k", F.nullif(tx.name_key(F.col("preferred_name")), F.lit("")))
    per = a.groupBy("company_id", "snapshot_id").agg(F.min(F.coalesce("captured_at", "loaded_at")).alias("seen_at"), F.countDistinct("k").alias("assets"))
    programs = gold_rows(s, d).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("programs"))
    ends = lambda x: F.col("company_id").endswith(x)
    rows = per.join(programs, "snapshot_id", "left").withColumn("programs", F.coalesce("programs", F.lit(0))).withColumn("known", ends("5")).withColumn("expected", F.when(ends("5"), 3).when(ends("4"), 2))
    before = Window.partitionBy("company_id").orderBy("seen_at", "snapshot_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("previous", F.last(F.when(F.col("assets") > 0, F.col("assets") * 3), ignorenulls=True).over(before))
    c = F.col
    first = quality.verdict(c("assets"), c("programs"), c("expected"), c("known"), c("previous"))
    second = F.when(c("programs") == 0, F.struct(F.lit("warn").alias("verdict"), F.lit(0.9).alias("confidence"), F.lit("look").alias("action")))
    judged = rows.withColumn("v", first).withColumn("w", second)
    both = quality.merged(F.struct("v.verdict", "v.confidence", "v.action"), c("w"))
    return judged.select("snapshot_id", "assets", "programs", "previous", both.alias("m")).select("snapshot_id", "assets", "programs", "previous", "m.*")


@query("""WITH l AS (SELECT DISTINCT doc_id, annotator, area FROM subject_label), p AS (SELECT DISTINCT annotator, doc_id, area FROM l),
gd AS (SELECT DISTINCT x.annotator, y.doc_id, y.area FROM (SELECT DISTINCT annotator FROM l) x JOIN l y ON y.annotator <> x.annotator WHERE (x.annotator, y.doc_id) IN (SELECT (annotator, doc_id) FROM l)),
sc AS (SELECT DISTINCT annotator, area FROM gd), pp AS (SELECT p.* FROM p JOIN sc USING (annotator, area) WHERE (annotator, doc_id) IN (SELECT (annotator, doc_id) FROM gd)),
b AS (SELECT coalesce(pp.annotator, gd.annotator) AS annotator, pp.doc_id IS NOT NULL AS inp, gd.doc_id IS NOT NULL AS ing FROM pp FULL JOIN gd ON pp.annotator = gd.annotator AND pp.doc_id = gd.doc_id AND pp.area = gd.area),
c AS (SELECT annotator, count(*) FILTER (WHERE inp AND ing) AS tp, count(*) FILTER (WHERE NOT ing) AS fp, count(*) FILTER (WHERE NOT inp) AS fn FROM b GROUP BY 1),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END AS r FROM c)
SELECT annotator, tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1, round(p, 4) >= 0.95 AND round(r, 4) >= 0.9 AS passed FROM r""")
def annotators_compared(s: SparkSession, d: str) -> DataFrame:
    """Every annotator against the others on the documents they share, within the areas those gave, summed over areas."""
    labels = table(s, d, "subject_label").select("doc_id", "annotator", "area").distinct()
    other = labels.select("doc_id", F.col("annotator").alias("_by"), "area")
    gold = labels.select("annotator", "doc_id").distinct().join(other, "doc_id").where(F.col("_by") != F.col("annotator")).select("annotator", "doc_id", "area").distinct()
    predicted = labels.join(gold.select("annotator", "doc_id").distinct(), ["annotator", "doc_id"], "left_semi").join(gold.select("annotator", "area").distinct(), ["annotator", "area"], "left_semi")
    return quality.gate(quality.scores(predicted, gold, ["annotator", "doc_id", "area"], ["annotator"]))


@query(f"""WITH x AS (SELECT alias_row_id, canonical, unnest(list_append(coalesce(members, []), canonical)) AS m FROM curated_aliases)
SELECT {_KEY.format(c='m')} AS alias, arg_max({_KEY.format(c='canonical')}, alias_row_id) AS key FROM x WHERE m IS NOT NULL AND canonical IS NOT NULL AND {_KEY.format(c='m')} <> '' GROUP BY 1""")
def canonical_keys(s: SparkSession, d: str) -> DataFrame:
    """The key each alias counts as; of several the one decided last."""
    a = table(s, d, "curated_aliases").where(F.col("canonical").isNotNull())
    said = a.select("alias_row_id", "canonical", F.explode(F.concat(F.coalesce("members", F.array().cast("array<string>")), F.array("canonical"))).alias("m"))
    keyed = said.select("alias_row_id", tx.name_key(F.col("canonical")).alias("key"), tx.name_key(F.col("m")).alias("alias")).where(F.col("alias") != "")
    return keyed.groupBy("alias").agg(F.max_by("key", "alias_row_id").alias("key"))


# ---- incremental work, transcriptions, fills ----


@query("""WITH a AS (SELECT DISTINCT expected_id, preferred_name, modality_verbatim, target_verbatim, mechanism_verbatim, list_sort(list_distinct(list_transform(coalesce(programs, []), lambda p: p.indication_verbatim))) AS inds FROM expected_asset),
t AS (SELECT expected_id, array_to_string(list_filter([preferred_name, modality_verbatim, target_verbatim, mechanism_verbatim, array_to_string(list_filter(inds, lambda x: x IS NOT NULL), ', ')], lambda x: x IS NOT NULL AND trim(x, ' ') <> ''), ' | ') AS text FROM a),
h AS (SELECT expected_id, text, sha256('local-1024' || chr(10) || text) AS hash, sha256('local-1024' || chr(10) || text || 'old') AS old FROM t)
SELECT expected_id, text FROM h WHERE expected_id % 3 = 0 OR (expected_id % 3 = 1 AND old IS DISTINCT FROM hash)""")
def texts_to_embed(s: SparkSession, d: str) -> DataFrame:
    """Only texts whose digest isn't the stored one, or that aren't stored, are embedded again."""
    from sedimenta.plans.catalogue import embedding_corpus

    corpus = embedding_corpus(s, d)
    kind = F.col("expected_id") % 3
    stored = corpus.where(kind > 0).select("expected_id", F.when(kind == 1, tx.embedding_hash("local-1024", F.concat("text", F.lit("old")))).otherwise(F.col("text_hash")).alias("stored"))
    return corpus.join(stored, "expected_id", "left").where(~F.col("text_hash").eqNullSafe(F.col("stored"))).select("expected_id", "text")


@query(f"""WITH {_GOLD}, r AS (SELECT company_id AS chart, trim(preferred_name, ' ') AS name, a.expected_id, target_verbatim, modality_verbatim, p.indication_verbatim AS ind, p.phase_verbatim AS phase, pos
 FROM (SELECT *, unnest(programs) AS p, generate_subscripts(programs, 1) - 1 AS pos FROM a) a)
SELECT chart, name, arg_min(target_verbatim, (expected_id, pos)) FILTER (WHERE target_verbatim IS NOT NULL) AS target, arg_min(modality_verbatim, (expected_id, pos)) FILTER (WHERE modality_verbatim IS NOT NULL) AS modality,
list(coalesce(ind, name) || ' @ ' || coalesce(phase, '?') ORDER BY expected_id, pos) AS programs FROM r GROUP BY 1, 2""")
def chart_assets(s: SparkSession, d: str) -> DataFrame:
    """Rows of a chart gathered into assets: one per name, the first target and modality given, its programs in order."""
    a = table(s, d, "expected_asset").where(F.col("preferred_name").isNotNull()).distinct()
    rows = a.select(F.col("company_id").alias("chart"), F.trim("preferred_name").alias("name"), "expected_id", "target_verbatim", "modality_verbatim", F.posexplode("programs").alias("pos", "p"))
    at = F.struct("expected_id", "pos")
    first = lambda c, n: F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(n)
    told = F.concat(F.coalesce("p.indication_verbatim", "name"), F.lit(" @ "), F.coalesce("p.phase_verbatim", F.lit("?")))
    return rows.groupBy("chart", "name").agg(first("target_verbatim", "target"), first("modality_verbatim", "modality"), F.array_sort(F.collect_list(F.struct("expected_id", "pos", told.alias("t")))).alias("l")).select("chart", "name", "target", "modality", F.col("l.t").alias("programs"))


@query(f"""WITH {_GOLD}, e AS (SELECT {_KEY.format(c='preferred_name')} AS asset, arg_min(modality_verbatim, expected_id) FILTER (WHERE modality_verbatim <> '') AS modality_verbatim FROM a GROUP BY 1)
SELECT asset, coalesce(modality_verbatim, 'M' || (length(asset) % 3)) AS modality_verbatim FROM e""")
def filled_modalities(s: SparkSession, d: str) -> DataFrame:
    """Missing modalities taken from a second source; what was disclosed stays."""
    known = asset_dimension(s, d).select("asset", "modality_verbatim")
    other = known.select("asset", F.concat(F.lit("M"), (F.length("asset") % 3).cast("string")).alias("modality_verbatim"))
    return identity.filled(known, other, ["asset"], ["modality_verbatim"])


@query("""SELECT d.company_id, count(DISTINCT doc_id) AS documents, any_value(n) AS readings FROM documents d JOIN (SELECT company_id, count(DISTINCT stat_id) AS n FROM capture_stats GROUP BY 1) s ON upper(trim(s.company_id)) = upper(trim(d.company_id)) GROUP BY 1""")
def across_systems(s: SparkSession, d: str) -> DataFrame:
    """Two systems joined on a shared code, letter case and blanks aside."""
    key = lambda c: F.upper(F.trim(c)).alias("code")
    readings = table(s, d, "capture_stats").groupBy(key("company_id")).agg(F.countDistinct("stat_id").alias("readings"))
    docs = table(s, d, "documents").groupBy("company_id").agg(F.countDistinct("doc_id").alias("documents"))
    return docs.join(readings, F.upper(F.trim("company_id")) == F.col("code")).select("company_id", "documents", "readings")


@query("""SELECT source, language, n FROM (SELECT source, coalesce(lang, 'und') AS language, count(*) AS n FROM documents GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, language) <= 3""")
def top_languages(s: SparkSession, d: str) -> DataFrame:
    """The three commonest languages of each source, by total."""
    counted = table(s, d, "documents").groupBy("source", F.coalesce("lang", F.lit("und")).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy(F.desc("n"), "language")
    return counted.withColumn("r", F.row_number().over(w)).where("r <= 3").drop("r")


# ---- sources and sinks, written to the shared folder and read again ----


def _shared(s: SparkSession) -> str:
    """A folder for round trips: in the checkpoint folder, a temporary one only in a local session without it."""
    root = s.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not s.sparkContext.master.startswith("local") or s.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/round-trip-{os.getpid()}-{s.sparkContext.applicationId}"


@query("SELECT '' || c_custkey AS key, c_name AS name, '' || c_nationkey AS nation FROM customer")
def delimited_round_trip(s: SparkSession, d: str) -> DataFrame:
    """A table written with an odd delimiter and read by sniffing it."""
    folder = f"{_shared(s)}/delimited"
    text = lambda c: F.col(c).cast("string")
    table(s, d, "customer").select(text("c_custkey").alias("key"), F.col("c_name").alias("name"), text("c_nationkey").alias("nation")).write.mode("overwrite").csv(folder, sep="|", header=True)
    return documents.read_delimited(s, folder)


@query("SELECT 'region ' || n_regionkey AS sheet, '' || n_nationkey AS key, n_name AS name FROM nation")
def workbook_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Sheets of a workbook, and a broken file beside it that is reported as a row and left out here."""
    folder = f"{_shared(s)}/books"
    rows = table(s, d, "nation").orderBy("n_nationkey").collect()  # 25 rows
    sheets = {f"region {r}": [["key", "name"]] + [[str(x.n_nationkey), x.n_name] for x in rows if x.n_regionkey == r] for r in sorted({x.n_regionkey for x in rows})}
    put = lambda name, content: snapshots.put_artifact(s, f"{folder}/{name}", content)
    put("a.xlsx", documents.xlsx_bytes(sheets))
    put("b.xlsx", b"not a workbook")
    read = documents.read_xlsx(s, folder)
    return read.where(F.col("error").isNull() & (F.col("row") > 0)).select("sheet", F.col("cells")[0].alias("key"), F.col("cells")[1].alias("name"))


@query("""SELECT company_id AS slug, count(*) AS assets, count(DISTINCT preferred_name) AS names FROM (SELECT DISTINCT * FROM expected_asset WHERE company_id IS NOT NULL) GROUP BY 1""")
def golden_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Labelled documents written as fixtures by slug and read again."""
    folder = f"{_shared(s)}/golden"
    rows = table(s, d, "expected_asset").where(F.col("company_id").isNotNull()).distinct().withColumnRenamed("company_id", "slug").select("slug", "expected_id", "preferred_name", "synonyms", "programs")
    documents.write_golden(rows, folder)
    return s.read.json(folder).groupBy("slug").agg(F.count(F.lit(1)).alias("assets"), F.countDistinct("preferred_name").alias("names"))


@query("""SELECT captured_at, period, asset_id FROM (SELECT DISTINCT captured_at, coalesce(period, '') AS period, asset_id FROM capture_asset WHERE asset_id IS NOT NULL AND source_id = (SELECT min(source_id) FROM capture_asset))""")
def captures_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Captures of a source written as one JSON document each and read in their order."""
    folder = f"{_shared(s)}/captures"
    rows = table(s, d, "capture_asset").where(F.col("asset_id").isNotNull())
    one = rows.where(F.col("source_id") == F.lit(table(s, d, "capture_asset").agg(F.min("source_id")).first()[0]))
    asset = F.struct("asset_id", "name", "phase_code", "partners")
    said = one.groupBy("captured_at", F.coalesce("period", F.lit("")).alias("period")).agg(F.collect_set(asset).alias("assets"))
    said.select(F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("captured"), "period", "assets").write.mode("overwrite").json(folder)
    return documents.read_captures(s, folder, multiline=False).select("captured_at", "period", "asset_id").distinct()


@query("""SELECT doc_id, CASE WHEN source = 'annual_report' THEN 'pdf' WHEN source = 'qa_note' THEN 'xlsx' WHEN source = 'legal_filing' THEN 'csv' END AS kind FROM documents""")
def document_kinds(s: SparkSession, d: str) -> DataFrame:
    """Kind of a document by its content type, else by its extension."""
    src = F.col("source")
    content = F.when(src == "annual_report", "application/pdf; charset=x").when(src == "legal_filing", "TEXT/CSV").otherwise("text/html")
    extension = F.when(src == "qa_note", ".XLSX").otherwise(".htm")
    return table(s, d, "documents").select("doc_id", documents.document_kind(content, extension).alias("kind"))


@query("""WITH v AS (SELECT vocab, code, label FROM vocab_entry UNION ALL SELECT 'phase', 'phase_4', 'Phase 4') SELECT vocab, code, CASE WHEN code = 'vaccine' THEN 'Vaccines' ELSE label END AS label FROM v""")
def seeded_vocabulary(s: SparkSession, d: str) -> DataFrame:
    """Seed entries put into a vocabulary by their natural key: one replaced, one added."""
    seeds = s.createDataFrame([("modality", "vaccine", "Vaccines"), ("phase", "phase_4", "Phase 4")], "vocab string, code string, label string")
    return identity.upserted(table(s, d, "vocab_entry").select("vocab", "code", "label"), seeds, ["vocab", "code"])


@query("""WITH t AS (SELECT 'Customer#000000007' AS name, 12 AS known UNION ALL SELECT 'Customer#000000009', NULL UNION ALL SELECT 'nobody', 4)
SELECT c_custkey, known FROM customer JOIN t ON c_name = name WHERE known IS NOT NULL AND c_acctbal IS NOT NULL""")
def trusted_counts(s: SparkSession, d: str) -> DataFrame:
    """Trusted counts put beside the sources of the companies they name."""
    trusted = s.createDataFrame([("Customer#000000007", 12), ("Customer#000000009", None), ("nobody", 4)], "c_name string, known int")
    return table(s, d, "customer").where(F.col("c_acctbal").isNotNull()).join(trusted.where(F.col("known").isNotNull()), "c_name").select("c_custkey", "known")


@query("""WITH items AS (SELECT version_id AS id, program_id, indication_verbatim AS text, indication_id, company_id, phase, status FROM (SELECT DISTINCT * FROM program_indication)
 WHERE valid_from <= TIMESTAMP '2023-06-30' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2023-06-30') AND status <> 'discontinued' AND indication_id IN (SELECT code FROM vocab_entry WHERE vocab = 'indication' AND label ILIKE '%cancer%')),
q AS (SELECT vec_id AS query, 'cancer of the lung' AS said, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0),
lx AS (SELECT id, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) AS similarity FROM (SELECT id, {A} AS a, {B} AS b FROM items)),
lr AS (SELECT id, row_number() OVER (ORDER BY similarity DESC, id) - 1 AS rank FROM lx WHERE similarity > 0.05),
vr AS (SELECT q.query, items.id, row_number() OVER (PARTITION BY q.query ORDER BY round(list_cosine_distance(m.embedding::DOUBLE[], q.e), 9) + 0.0, items.id) - 1 AS rank FROM items JOIN embeddings m ON m.vec_id = items.id JOIN q ON true),
r AS (SELECT q.query, id, rank FROM lr, q WHERE rank < 100 UNION ALL SELECT query, id, rank FROM vr WHERE rank < 200),
f AS (SELECT query, id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score FROM r GROUP BY 1, 2)
SELECT query, id, score, program_id, phase, status, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS place FROM f) JOIN items USING (id) WHERE place <= 20"""
.replace("{A}", "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring('  ' || w || ' ', i, 3)))))")
.replace("{B}", "list_distinct(flatten(list_transform(list_filter(string_split_regex('cancer of the lung', '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring('  ' || w || ' ', i, 3)))))"))
def hybrid_search(s: SparkSession, d: str) -> DataFrame:
    """Versions open at a time, of some diseases and states, ranked by text and by vector and fused, for a set of queries.

    The text is one, the vectors are those of every id divisible by 20; a version's vector is that of its id.
    """
    from sedimenta.operators.history import as_of

    at = F.lit("2023-06-30").cast("timestamp_ntz")
    open_ = as_of(table(s, d, "program_indication").distinct(), at)
    disease = search.text_filter(table(s, d, "vocab_entry").where("vocab = 'indication'"), "cancer", "label").select(F.col("code").alias("indication_id"))
    items = search.faceted(open_, {}, active_only=True).join(disease, "indication_id", "left_semi").select(F.col("version_id").alias("id"), "program_id", F.col("indication_verbatim").alias("text"), "phase", "status")
    vectors = table(s, d, "embeddings").withColumnRenamed("vec_id", "id")
    wanted = vectors.where(F.col("id") % 20 == 0)
    lexical = search.lexical_search(items, wanted.select("id", F.lit("cancer of the lung").alias("text")), 100)
    near = search.vector_search(vectors.join(items.select("id"), "id", "left_semi"), wanted, 200)
    return search.fused_search(20, lexical, near).join(items, "id").select("query", "id", "score", "program_id", "phase", "status", "place")


@query("""SELECT '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' AS line FROM region""")
def json_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows as JSON documents, as an interface hands them out."""
    return table(s, d, "region").select(F.to_json(F.struct("r_regionkey", "r_name")).alias("line"))


@query("""SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def published_view(s: SparkSession, d: str) -> DataFrame:
    """A relation published under a name, dropped and made anew, and read through SQL."""
    joined = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    snapshots.publish({"published_nation": joined.select("n_name", "r_name")})
    return s.sql("SELECT n_name, r_name FROM published_nation")


@query("""SELECT c_custkey, greatest(coalesce(c_nationkey * 200, 2000), 3500) AS wait_ms, true AS full_page,
list_concat(['#x' || c_nationkey % 3], list_filter(['#x0', '.more', '#x1'], lambda y: y <> '#x' || c_nationkey % 3)) AS selectors FROM customer""")
def merged_configs(s: SparkSession, d: str) -> DataFrame:
    """A site's settings with the general ones: longer waits, own selectors first, none twice."""
    own = F.array(F.concat(F.lit("#x"), (F.col("c_nationkey") % 3).cast("string")))
    merged = web.merged_config(F.col("c_nationkey") * 200, own, ["#x0", ".more", "#x1"])
    return table(s, d, "customer").select("c_custkey", merged.alias("m")).select("c_custkey", "m.*")


@query(f"""WITH x AS (SELECT source, doc_id, text, {_HITS} AS hits, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS via, CASE WHEN source LIKE '%pipeline%' THEN 100 ELSE 0 END + CASE WHEN doc_id % 5 = 0 THEN 20 ELSE 0 END AS score,
 doc_id % 4 = 1 AS news, lower(coalesce(text, '')) AS low FROM documents)
SELECT source, doc_id, via, score FROM x WHERE NOT news AND NOT regexp_matches(low, '{web.PRESS_MARKERS}') AND hits >= 3 QUALIFY row_number() OVER (PARTITION BY source ORDER BY via, score DESC, doc_id) = 1""")
def source_cascade(s: SparkSession, d: str) -> DataFrame:
    """The page taken for each source: of the search's results, then of the map's, the best scored that is a valid page."""
    pages = table(s, d, "documents").withColumn("via", (F.col("doc_id") % 2).cast("int")).where(F.col("doc_id") % 4 != 1)
    url = F.concat(F.lit("https://e.org/"), F.when(F.col("source").contains("pipeline"), "pipeline").otherwise("page"), F.when(F.col("doc_id") % 5 == 0, "/research").otherwise(""))
    valid = pages.where(web.is_pipeline_page(F.lit(200), F.col("text"), F.lit(False))).withColumn("score", web.link_score(url, F.lit(None).cast("string")))
    return identity.first_per_key(valid.select("source", "doc_id", "via", "score"), ["source"], "via", F.desc("score"), "doc_id")
