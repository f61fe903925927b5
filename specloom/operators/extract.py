"""HTML pages to long specification rows: one narrow job from scan to rows, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from specloom import registry as R
from specloom.functions import html as H
from specloom.functions import values as V
from specloom.functions.text import built_once, found, let, strip


@built_once
def _clean_column() -> Column:
    return H.clean_html(F.col("html"))


def _clean(pages: DataFrame, keys: list[str]) -> DataFrame:
    return pages.select(*keys, _clean_column().alias("clean"))


def page_texts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """X1."""
    return _clean(pages, keys).select(*keys, H.page_text(F.col("clean")).alias("page_text"))


def pairs(pages: DataFrame, keys: list[str], structure: str) -> DataFrame:
    """label/value pairs of one structure, one row each; cell values are reduced to text."""
    make = {
        "table": lambda c: H.table_pairs(H.table_rows(c)),
        "block": H.vendor_pairs,
        "block_list": H.vendor_list_pairs,
        "list": lambda c: H.list_pairs(H.list_items(c)),
        "definition": H.definition_pairs,
    }[structure]
    out = _clean(pages, keys).select(*keys, F.inline(make(F.col("clean"))))
    value = F.when(F.col("is_text"), F.col("value")).otherwise(H.cell_text(F.col("value")))
    return out.select(*keys, "row_pos", "cell_pos", "label", value.alias("value"), "confidence")


def field_labels(labels: DataFrame, label: str) -> DataFrame:
    """Fields whose search terms occur in a label, with the best (lowest) term rank."""
    def rank(field: R.Field) -> Column:
        low = F.lower(F.col(label))
        hits = [F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(field.terms)]
        return F.coalesce(*hits)
    found_fields = F.array(*[F.struct(F.lit(f.code).alias("field_code"), rank(f).alias("alias_rank")) for f in R.FIELDS])
    return labels.select("*", F.inline(F.filter(found_fields, lambda x: x.alias_rank.isNotNull())))


@built_once
def _raw_stages() -> list[list[Column]]:
    """The columns of the extraction stages, from ``clean`` to the array of hits."""
    c = F.col
    cut = [H.page_text(c("clean")).alias("text"), H.table_rows(c("clean")).alias("rows"),
           H.list_items(c("clean")).alias("items"), c("clean")]
    paired = [c("text"), F.lower("text").alias("low"), c("rows"), H.vendor_pairs(c("clean")).alias("blocks"),
              H.vendor_list_pairs(c("clean")).alias("block_list"), H.table_pairs(c("rows")).alias("cells"),
              H.list_pairs(c("items")).alias("listed"), H.definition_pairs(c("clean")).alias("defined"),
              H.spec_container(c("clean")).alias("container")]
    structures = [c(n) for n in ("blocks", "block_list", "cells", "listed", "defined")]
    labelled = [c("text"), c("low"), c("rows"), c("blocks"), c("container"), H.table_rows(c("container")).alias("container_rows"),
                H.label_hits(structures).alias("labelled")]
    by_label = {f.code: F.get(c("labelled"), F.lit(i)) for i, f in enumerate(H.LABEL_FIELDS)}

    def hit(field: R.Field) -> Column:
        if field.code == "stream_count":
            return H.stream_count_hit(c("low"))
        if field.code == "supplement_light_type":
            return H.light_type_hit(c("low"))
        if field.code == "deep_learning_function_categories":
            return H.smart_functions_hit(c("blocks"), c("rows"))
        tries = [by_label[field.code]]
        if field.code in H.ROW_OF_FIELD:
            tries.append(H.position_hit(field, c("container_rows")))
        pattern = H.regex_hit(field.code, c("text"))
        if pattern is not None:
            tries.append(pattern)
        if field.code == "approval_anti_corrosion_protection":
            tries.append(H.protection_hit(c("rows")))
        return F.coalesce(*[t.cast(H.HIT) for t in tries])

    hits = F.array(*[F.struct(F.lit(f.code).alias("field_code"), hit(f).cast(H.HIT).alias("hit")) for f in R.FIELDS])
    # a condition inside the generator, not a filter: a filter would be pushed down and find the container twice
    found_hits = F.inline(F.when(c("container").isNotNull(), F.filter(hits, lambda h: h.hit.isNotNull())))
    # a distance that cannot be converted is kept at half the confidence
    # inside a lambda the parsed parts become methods of their own; in line, the stage would grow beyond what compiles
    bad_distance = ((c("field_code") == "supplement_light_range") & c("hit.method").startswith("label_")
                    & let(V.parse_distance(c("hit.raw_value")), lambda d: d.error.isNotNull()))
    confidence = F.when(bad_distance, c("hit.confidence") * 0.5).otherwise(c("hit.confidence"))
    flat = [c("field_code"), c("hit.raw_value"), confidence.alias("confidence"), c("hit.method")]
    return [cut, paired, labelled, [found_hits], flat]


def extract_raw(pages: DataFrame, keys: list[str]) -> DataFrame:
    """At most one raw value per page and field, by label, then position, then pattern.

    Pages without a specification container give no rows. All work stays inside the row, so the number and
    size of the partitions is that of the scan.
    """
    out = _clean(pages, keys)
    for columns in _raw_stages():
        out = out.select(*keys, *columns)
    return out


def pages_without_container(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Warning rows for pages that cannot be extracted."""
    clean = _clean(pages, keys).where(H.spec_container(F.col("clean")).isNull())
    return clean.select(*keys, F.lit("No specification containers found").alias("warning"))


def position_values(pages: DataFrame, keys: list[str]) -> DataFrame:
    """X6 alone: the positional values of the first container."""
    rows = _clean(pages, keys).select(*keys, H.table_rows(H.spec_container(F.col("clean"))).alias("rows"))
    hits = F.array(*[F.struct(F.lit(code).alias("field_code"), H.position_hit(R.FIELD_BY_CODE[code], F.col("rows"))
                              .cast(H.HIT).alias("hit")) for code in H.ROW_OF_FIELD])
    return rows.select(*keys, F.inline(F.filter(hits, lambda h: h.hit.isNotNull()))).select(
        *keys, "field_code", "hit.raw_value", "hit.confidence")


def pattern_values(pages: DataFrame, keys: list[str]) -> DataFrame:
    """X7 alone: pattern hits over the whole page text."""
    texts = page_texts(pages, keys)
    codes = ("max_resolution", "supplement_light_range", "aperture")
    hits = F.array(*[F.struct(F.lit(c).alias("field_code"), H.regex_hit(c, F.col("page_text")).cast(H.HIT).alias("hit"))
                     for c in codes])
    return texts.select(*keys, F.inline(F.filter(hits, lambda h: h.hit.isNotNull()))).select(
        *keys, "field_code", "hit.raw_value", "hit.confidence")


def page_inference(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The fields read from the page as a whole, NULL where the page says nothing."""
    parts = _clean(pages, keys).select(
        *keys, F.lower(H.page_text(F.col("clean"))).alias("low"), H.vendor_pairs(F.col("clean")).alias("blocks"),
        H.table_rows(F.col("clean")).alias("rows"))
    return parts.select(
        *keys, H.stream_count_hit(F.col("low")).raw_value.alias("stream_count"),
        H.light_type_hit(F.col("low")).raw_value.alias("light_type"),
        H.smart_functions_hit(F.col("blocks"), F.col("rows")).raw_value.alias("smart_functions"),
        H.protection_hit(F.col("rows")).raw_value.alias("ip_rating"))


@built_once
def _normal_value(strict_units: bool) -> Column:
    return V.field_value(F.col("field_code"), F.col("raw_value"), strict_units)


def normalize_specs(specs: DataFrame, strict_units: bool = False) -> DataFrame:
    """N1 over a long table: replaces normalized_value and unit, adds the issue texts."""
    n = specs.withColumn("_n", _normal_value(strict_units))
    kept = [c for c in specs.columns if c not in ("normalized_value", "unit", "issues")]
    return n.select(*kept, "_n.normalized_value", "_n.unit", "_n.issues")


def newest_raw(pages: DataFrame, version: str | None = None) -> DataFrame:
    """Raw values of the newest stored copy of each url, one row per url and field.

    ``version`` names a column that orders the copies; ties, and all copies without it, go by a hash of the HTML. The newest
    copies are found from hashes and compared with the extracted values, so HTML is not shuffled even when one url has
    very many copies.
    """
    order = F.struct(*([F.col(version).alias("version")] if version else []), F.xxhash64("html").alias("digest"))
    copies = pages.withColumn("_copy", order)
    newest = copies.groupBy("url").agg(F.max("_copy").alias("_copy"))
    raw = extract_raw(copies, ["url", "_copy"]).join(newest.hint("merge"), ["url", "_copy"], "left_semi").drop("_copy")
    return raw.dropDuplicates(["url", "field_code"])  # rows of equal copies are equal


def extract_specs(catalog: DataFrame, pages: DataFrame, strict_units: bool = False,
                  version: str | None = None) -> DataFrame:
    """Catalog entries with their stored pages to normalized spec rows.

    Pages are reduced to raw values and normalized before the join, once per page and field and not once per run, locale
    and product; the join moves values and never HTML. Of several copies of a url one counts (``newest_raw``).
    Joins with pages are merge joins: sizes are estimated from the files of the pages, and what a page gives is far larger
    than such an estimate, so a broadcast of it would pass all values through the driver.
    """
    raw = normalize_specs(newest_raw(pages, version), strict_units)
    c = catalog.select("run_id", "brand", F.coalesce("series_l1", F.lit("")).alias("series_l1"),
                       F.coalesce("series_l2", F.lit("")).alias("series_l2"), "product_model", "product_url")
    rows = c.join(raw.hint("merge"), c.product_url == raw.url)
    specs = rows.select(
        "run_id", "brand", "series_l1", "series_l2", "product_model", "field_code",
        R.field_name(F.col("field_code")).alias("field_name"), "raw_value",
        R.value_type(F.col("field_code")).alias("value_type"), F.col("product_url").alias("source_url"),
        F.col("confidence").alias("extract_confidence"), F.lit(False).alias("is_manual_override"), "method", "normalized_value", "unit", "issues")
    return specs


def missing_pages(catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """Catalog entries whose page was not stored."""
    return catalog.join(pages.select(F.col("url").alias("product_url")).hint("merge"), "product_url", "left_anti")


def extraction_counts(catalog: DataFrame, pages: DataFrame, specs: DataFrame) -> DataFrame:
    """A15 by run: products processed, specs, average specs per product, failures."""
    stored = pages.select(F.col("url").alias("product_url"), F.lit(1).alias("stored"))
    # one stored page per url: group before the join so that repeated pages do not repeat products
    products = catalog.join(stored.groupBy("product_url").agg(F.max("stored").alias("stored")).hint("merge"), "product_url", "left")
    done = products.groupBy("run_id").agg(F.count("stored").alias("products_processed"),
                                          (F.count("*") - F.count("stored")).alias("extraction_failures"))
    found_specs = specs.groupBy("run_id").agg(F.count("*").alias("specs_extracted"))
    n = F.coalesce("specs_extracted", F.lit(0))
    return done.join(found_specs, "run_id", "left").select(
        "run_id", "products_processed", n.alias("specs_extracted"),
        F.when(F.col("products_processed") > 0, F.round(n / F.col("products_processed"), 2)).otherwise(0.0)
        .alias("avg_specs_per_product"), "extraction_failures")


def replace_product(specs: DataFrame, fresh: DataFrame, run_id: str, model: str) -> DataFrame:
    """The run's rows of one product replaced by newly extracted ones."""
    same = (F.col("run_id") == run_id) & F.col("product_model").eqNullSafe(F.lit(model))
    return specs.where(~same).unionByName(fresh.where(same), allowMissingColumns=True)


def list_page_labels(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Label and value per list item, the first occurrence of a label within its page."""
    found_pairs = _clean(pages, keys).select(*keys, H.list_page_pairs(F.col("clean")).alias("pairs"))
    labelled = found_pairs.select(*keys, "pairs", F.transform("pairs", lambda p: p.label).alias("labels"))
    first = F.filter(F.col("pairs"), lambda p, i: F.array_position(F.col("labels"), p.label) == i + 1)
    return labelled.select(*keys, F.inline(first))


def list_page_specs(pages: DataFrame, keys: list[str]) -> DataFrame:
    """List-page extraction: raw and normalized value per field, from label pairs and page text."""
    p = _clean(pages, keys).select(*keys, H.page_text(F.col("clean")).alias("text"),
                                   H.list_page_pairs(F.col("clean")).alias("pairs"))
    text, label_pairs = F.col("text"), F.col("pairs")
    streams = F.when(text.rlike("(?i)Third Stream"), "3").when(text.rlike("(?i)Sub Stream|Sub-stream"), "2")
    raws = {code: H.list_page_value(label_pairs, labels) for code, labels in R.LIST_PAGE_LABELS.items()}
    raws["stream_count"] = streams
    raws["supplement_light_type"] = V.list_page_light_type(text)
    raws["deep_learning_function_categories"] = F.get(
        F.filter(label_pairs, lambda x: x.label == "Smart Event"), F.lit(0)).value
    p = p.select(*keys, "pairs", *[c.alias(f"r_{code}") for code, c in raws.items()])

    def normal(code: str, raw: Column) -> Column:
        if code == "main_stream_max_fps_resolution":
            return V.stream_at(raw)
        if code == "supplement_light_range":
            return V.float_text(V.list_page_distance(raw))
        if code == "aperture":
            return F.coalesce(F.concat(F.lit("f/"), found(raw, V.NUMBER)), raw)
        if code == "deep_learning_function_categories":
            return V.smart_event_categories(raw)
        if code == "interface_items":
            return V.json_list(H.interfaces(F.col("pairs"), raw))
        if code == "max_resolution":
            return F.regexp_replace(strip(raw), V.SIZE_SIGN, "x")
        return raw

    rows = F.array(*[F.struct(F.lit(c).alias("field_code"), F.col(f"r_{c}").alias("raw_value"),
                              normal(c, F.col(f"r_{c}")).alias("normalized_value"),
                              F.lit(R.UNIT_BY_FIELD.get(c)).cast("string").alias("unit")) for c in R.FIELD_CODES])
    return p.select(*keys, F.inline(F.filter(rows, lambda x: F.coalesce(x.raw_value, F.lit("")) != "")))


# --- X15 and E2: site rules ------------------------------------------------------------------------

@dataclass(frozen=True)
class SiteRules:
    """How the links of one site are read; a user can pass rules of their own.

    ``patterns``: (kind, pattern, group of the slug). ``name`` gives a link's name from its kind, slug and heading, and the allowed
    series; links without a name are left out. ``text`` shortens the link text where a site needs it.
    """
    patterns: tuple[tuple[str, str, int], ...]
    name: Callable[[Column, Column, Column, list[str]], Column]
    text: Callable[[Column], Column] = lambda text: text


def _dashed(slug: Column) -> Column:
    return F.regexp_replace(slug, "-", " ")


def _tabbed_name(kind: Column, slug: Column, heading: Column, allowlist: list[str]) -> Column:
    return F.when(kind == "product", F.upper(slug)).when(kind == "subseries", F.initcap(_dashed(slug))).otherwise(slug)


def _catalog_name(kind: Column, slug: Column, heading: Column, allowlist: list[str]) -> Column:
    model, series = F.coalesce(heading, _dashed(slug)), H.series_name(slug, allowlist)
    return (F.when(kind == "series", series).when(kind == "product_series", F.when(V.allowed_series(series, list(allowlist)), series))
            .when(V.valid_model(model), model).when(V.valid_model(slug), F.upper(slug)))


def _first_words(text: Column) -> Column:
    """Link texts of the catalog site run on into the description; the name is their first ten words."""
    return F.array_join(F.slice(F.split(text, r"(?U)\s+"), 1, PRODUCT_NAME_WORDS), " ")


# --- fixed values: link patterns of the two site layouts, words of a product name ------------------
PRODUCT_NAME_WORDS = 10
SITE_RULES = {
    "tabbed": SiteRules((
        ("series", r"^(?:https?://[^/]+)?/products/network-products/network-cameras/([\w-]+)", 1),
        ("subseries", r"(?i)/network-cameras/[\w-]+/([\w-]+)/(?:ipc|dh)", 1),
        ("product", r"(?i)/network-cameras/[\w-]+/[\w-]+/(ipc-[\w-]+|dh-[\w-]+)", 1),
    ), _tabbed_name),
    "catalog": SiteRules((
        ("series", r"^/[^/]+/products/IP-Products/Network-Cameras/([^/]+)/?$", 1),
        ("product_series", r"/Network-Cameras/([^/]+)", 1),
        ("product", r"/products/IP-Products/Network-Cameras/[^/]+/([^/]+)/?$", 1),
    ), _catalog_name, _first_words),
}


def page_links(pages: DataFrame, keys: list[str]) -> DataFrame:
    """All anchors with a target, in page order."""
    found_links = _clean(pages, keys).select(*keys, F.posexplode(H.links(F.col("clean"))).alias("pos", "link"))
    return found_links.select(*keys, "pos", "link.*")


def site_links(pages: DataFrame, keys: list[str], site: str | SiteRules, base_url: str, allowlist: list[str] = ()) -> DataFrame:
    """Series, subseries and products linked from listing pages, by the rules of one site layout (a known one or own).

    One row per page, kind and name: the first link wins.
    """
    own = SITE_RULES[site] if isinstance(site, str) else site
    rules = F.array(*[F.struct(F.lit(kind).alias("kind"), found(F.col("href"), pattern, group).alias("slug"))
                      for kind, pattern, group in own.patterns])
    rows = page_links(pages, keys).select("*", F.inline(F.filter(rules, lambda r: r.slug.isNotNull())))
    name = own.name(F.col("kind"), F.col("slug"), F.col("heading"), list(allowlist))
    named = rows.select(*keys, "pos", "kind", "slug", name.alias("name"), own.text(F.col("text")).alias("text"),
                        H.absolute_url(F.lit(base_url), F.col("href")).alias("url")).where(F.col("name").isNotNull())
    # links of one page are few; keep the first per name with a map-side combining aggregate
    first = named.groupBy(*keys, "kind", "name").agg(
        F.min_by(F.struct("pos", "slug", "text", "url"), "pos").alias("first"))
    return first.select(*keys, "kind", "name", "first.*")
