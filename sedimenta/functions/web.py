"""URLs, links and rendered pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.text import lookup, phase_hits

# ---- fixed values ----
SOURCE_RANK = {"csv_doc": "5", "xlsx_doc": "10", "pdf_doc": "20", "html_table": "35", "pipeline_page": "50", "js_cards": "60", "image_page": "70"}
TYPE_BY_EXTENSION = {".csv": "csv_doc", ".xlsx": "xlsx_doc", ".xls": "xlsx_doc", ".pdf": "pdf_doc"}
DEFAULT_TYPE = "pipeline_page"
FILE_HINTS = "pipeline|product|candidate|portfolio|development|rd|r-d|clinical"
SECTION_HINTS = "science|research|development|portfolio|products|medicines|candidates|innovation|programs"
PRESS_MARKERS = "globenewswire|globe newswire|prnewswire|pr newswire|business wire|businesswire|for immediate release|accesswire|/source:"
IMAGE_HINTS = "pipeline|program|candidate|development|clinical"
IMAGE_ATTRIBUTES = ("src", "alt", "title", "class", "id", "data-src", "data-lazy-src")
BLOCKED_STATUSES = (401, 403, 429, 503)
TEXT_RICH_HITS = 12
# ---- end of fixed values ----


def url_path(url: Column) -> Column:
    return F.regexp_replace(F.lower(url), r"[?#].*$", "")


def url_extension(url: Column) -> Column:
    """The file extension of a URL's path with its dot, empty if it has none."""
    return F.regexp_extract(F.regexp_extract(url_path(url), "([^/]*)$", 1), r"(\.[a-z0-9]+)$", 1)


def url_type(url: Column) -> Column:
    """csv_doc, xlsx_doc or pdf_doc by extension, null for a page."""
    return lookup(TYPE_BY_EXTENSION, url_extension(url))


def source_rank(source_type: Column) -> Column:
    return F.coalesce(lookup(SOURCE_RANK, source_type), F.lit("50")).cast("int")


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base``; dots in paths are kept as they are."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"[^/]*$", "")
    folder = F.when(F.length(folder) <= F.length(root), F.concat(root, F.lit("/"))).otherwise(folder)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href == "", base)
        .when(href.startswith("?") | href.startswith("#"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(F.concat(folder, href))
    )


def links(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?i)href=[\"']([^\"']+)[\"']"), F.lit(1))


def discovered(base: Column, html: Column) -> Column:
    """Array of (url, type, rank) of the links that lead to documents or to pages about the pipeline, each URL once, by rank."""
    urls = F.transform(links(html), lambda h: absolute_url(base, h))
    typed = F.transform(F.array_distinct(urls), lambda u: F.struct(source_rank(F.coalesce(url_type(u), F.lit(DEFAULT_TYPE))).alias("rank"), u.alias("url"), F.coalesce(url_type(u), F.lit(DEFAULT_TYPE)).alias("type")))
    return F.array_sort(F.filter(typed, lambda x: (x["type"] != DEFAULT_TYPE) | F.lower(x["url"]).contains("pipeline")))


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, empty if it has none."""
    return F.regexp_extract(tag, f"(?i)(?<![-a-z0-9_:.]){name}=[\"']([^\"']*)[\"']", 1)


def image_urls(base: Column, html: Column) -> Column:
    """URLs of the images whose attributes say that they show a pipeline, sorted, each once."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<img\b[^>]*>"), F.lit(0))
    said = lambda t: F.concat_ws(" ", *[attribute(t, a) for a in IMAGE_ATTRIBUTES])
    first = lambda t: F.coalesce(*[F.nullif(attribute(t, a), F.lit("")) for a in ("src", "data-src", "data-lazy-src")])
    hits = F.filter(tags, lambda t: F.lower(said(t)).rlike(IMAGE_HINTS) & first(t).isNotNull())
    return F.array_sort(F.array_distinct(F.transform(hits, lambda t: absolute_url(base, first(t)))))


def cards(html: Column, block: str, name: str, indication: str, phase: str, note: str) -> Column:
    """Array of (name, indication, phase, notes) read from the blocks of a structured page; blocks that lack one of the three are left out.

    The parameters are patterns; each field is the first group of its first match.
    """
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(block), F.lit(1))
    field = lambda b, p: plain_html(F.regexp_extract(b, p, 1))
    notes = lambda b: F.array_join(F.filter(F.transform(F.regexp_extract_all(b, F.lit(note), F.lit(1)), plain_html), lambda x: x != ""), "; ")
    read = F.transform(found, lambda b: F.struct(field(b, name).alias("name"), field(b, indication).alias("indication"), field(b, phase).alias("phase"), notes(b).alias("notes")))
    return F.filter(read, lambda c: (c["name"] != "") & (c["indication"] != "") & (c["phase"] != ""))


def merged_config(wait_ms: Column, selectors: Column, general: list[str], least_wait: int = 3_500) -> Column:
    """struct(wait_ms, full_page, selectors) of a page that is rendered again: waits no shorter, own selectors first, none twice."""
    known = F.coalesce(selectors, F.array().cast("array<string>"))
    return F.struct(
        F.greatest(F.coalesce(wait_ms, F.lit(2_000)), F.lit(least_wait)).alias("wait_ms"), F.lit(True).alias("full_page"), F.array_union(known, F.array(*[F.lit(g) for g in general])).alias("selectors")
    )


def render_decision(status: Column, text: Column, images: Column, fallback: bool = True) -> Column:
    """keep, fallback (blocked, failed or without evidence) or give_up of a rendered page."""
    poor = (phase_hits(text) < 3) & ~images
    again = status.isNull() | status.isin(*BLOCKED_STATUSES) | (poor & (status < 400))
    return F.when(again, F.lit("fallback" if fallback else "give_up")).when(status >= 400, "give_up").otherwise("keep")


def reading_mode(text: Column, document: Column, images: Column, source_type: Column) -> Column:
    """text (dense phase words in the page itself), visual (an image page, or a chart and few words) or both."""
    rich = ~document & (images == 0) & (phase_hits(text) >= TEXT_RICH_HITS)
    visual = (source_type == "image_page") | ((images > 0) & (phase_hits(text) < 3))
    return F.when(visual, "visual").when(rich, "text").otherwise("both")


def is_promotable(url: Column, source_type: Column, page_type: Column) -> Column:
    """A linked document that outranks the page and whose URL looks like one about the pipeline."""
    return source_type.isin("csv_doc", "xlsx_doc", "pdf_doc") & (source_rank(source_type) < source_rank(page_type)) & F.lower(url).rlike(FILE_HINTS)


def page_class(html: Column, text: Column, has_images: Column, least: int = 3) -> Column:
    """image_page, html_table, js_cards or the default page."""
    hits = phase_hits(text)
    rows = F.coalesce(F.regexp_count(html, F.lit(r"(?i)<tr\b")), F.lit(0))
    table = F.coalesce(html.rlike(r"(?i)<table\b"), F.lit(False))
    return (
        F.when(has_images & (hits < least), "image_page")
        .when(table & (rows >= 4) & (hits >= least), "html_table")
        .when((hits >= least) & (rows < 4), "js_cards")
        .otherwise(DEFAULT_TYPE)
    )


def link_score(url: Column, title: Column) -> Column:
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    t = F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(path.contains("pipeline"), 100).otherwise(0)
        + F.when(t == "pipeline", 90).when(t.contains("pipeline"), 70).otherwise(0)
        + F.when(path.rlike(SECTION_HINTS), 20).otherwise(0)
    )


def company_token(name: Column) -> Column:
    """The first significant word of a company's name."""
    words = F.split(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9 ]", " ")), r"\s+")
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin("the", "inc", "ltd", "plc"))
    return F.when(F.size(kept) > 0, kept[0]).otherwise(F.lower(name))


def is_press_release(text: Column) -> Column:
    return F.coalesce(F.lower(text).rlike(PRESS_MARKERS), F.lit(False))


def is_pipeline_page(status: Column, text: Column, has_images: Column) -> Column:
    """A page that loaded, is no press release, and has phase words, or an image with some text."""
    ok = F.coalesce(status < 400, F.lit(True)) & ~is_press_release(text)
    return ok & ((phase_hits(text) >= 3) | (has_images & (F.length(F.coalesce(text, F.lit(""))) >= 200)))


def plain_html(value: Column) -> Column:
    """Text of a fragment: superscripts unwrapped, tags out, common entities resolved, blanks collapsed."""
    v = F.regexp_replace(value, r"(?is)</?sup[^>]*>", "")
    v = F.regexp_replace(v, r"(?s)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        v = F.replace(v, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(v, r"[\s ]+", " "))
