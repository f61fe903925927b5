"""Label/value extraction from HTML as array expressions.

Everything here works inside one row: a page is cut into fragments with regular expressions and the fragments
are filtered and transformed as arrays. No step needs a shuffle, so a page table of any size is processed where
it is read. ``clean`` always means HTML after ``clean_html``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from specloom import registry as R
from specloom.functions import values as V
from specloom.functions.text import (
    STRINGS, decode_entities, found, json_list, let, restore_markup, split_items, sql_text, strip,
)

TAG = r"<[/!?a-zA-Z][^>]*>"
LABEL_LIMIT = 100

# --- fixed values: class names of the two vendor layouts -------------------------------------------
BLOCK = ("div", "main-item", "item-title", "item-title-detail")
BLOCK_LIST = ("li", "tech-specs-items-description-list", "tech-specs-items-description__title",
              "tech-specs-items-description__description")


def open_tag(name: str, css_class: str | None = None, loose: str | None = None) -> str:
    """Pattern of an opening tag, with a class token (exact) or a class fragment (``loose``)."""
    if css_class:
        return rf"""<{name}\b[^>]*?\bclass\s*=\s*["'](?:[^"'>]*\s)?{css_class}(?:\s[^"'>]*)?["'][^>]*>"""
    if loose:
        return rf"""<{name}\b[^>]*?\bclass\s*=\s*["'][^"'>]*(?:{loose})[^>]*>"""
    return rf"<{name}\b[^>]*>"


def pieces(c: Column, start: str, stop: str) -> Column:
    """The texts between each match of ``start`` and the next match of ``stop`` (or the end).

    Regular-expression functions keep their compiled pattern between rows, which ``split`` does not; inside
    lambdas that makes most of the difference.
    """
    return F.regexp_extract_all(c, F.lit(rf"(?is){start}(.*?)(?={stop}|\z)"), F.lit(1))


def until(c: Column, stop: str) -> Column:
    """Text before the first match of ``stop``; the whole text without one."""
    return F.regexp_extract(c, rf"(?is)\A(.*?)(?:{stop}|\z)", 1)


def after_first(c: Column, start: str) -> Column:
    """Text after the first match of ``start``; NULL without one."""
    return F.when(c.rlike(f"(?i){start}"), F.regexp_extract(c, rf"(?is){start}(.*)\z", 1))


def balanced(c: Column, tag: str) -> Column:
    """Content of an element whose opening tag was just consumed, up to its own closing tag."""
    edge = rf"</?{tag}\b"
    parts = F.regexp_extract_all(c, F.lit(rf"(?is){edge}.*?(?={edge}|\z)|\A.+?(?={edge}|\z)"), F.lit(0))
    # depth starts inside the element; kept counts the parts before its closing tag
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))

    def step(s: Column, part: Column) -> Column:
        change = F.when(part.rlike(rf"(?i)\A<{tag}\b"), 1).when(part.rlike(rf"(?i)\A</{tag}\b"), -1).otherwise(0)
        return F.when(s.depth == 0, s).otherwise(let(s.depth + change, lambda depth: F.struct(
            depth.alias("depth"), (s.kept + F.when(depth == 0, 0).otherwise(1)).alias("kept"))))

    return let(parts, lambda p: F.array_join(F.slice(p, F.lit(1), F.aggregate(p, start, step, lambda s: s.kept)), ""))


# --- nested markup ---------------------------------------------------------------------------------

LEVEL = r"\x01(\d+)\x02"  # depth of nesting, written before a tag
SAME = r"\x01\1\x02"  # a tag of the same depth


def nested(c: Column, owner: str) -> Column:
    """Whether an ``owner`` element opens inside another one."""
    return c.rlike(rf"(?is)<(?:{owner})\b[^<]*(?:<(?!/?(?:{owner})\b)[^<]*)*+<(?:{owner})\b")


def with_levels(c: Column, owner: str, inner: str) -> Column:
    """The depth of ``owner`` elements written before each tag of theirs and before each ``inner`` tag.

    The page is cut at the ``owner`` tags alone and their depths are folded once, so the work grows with the length of the page.
    Tags of one element, and those it ends at, then carry the same depth; deeper ones in between belong to inner elements.
    """
    edge = rf"</?(?:{owner})\b"
    parts = F.regexp_extract_all(F.translate(c, "\x01\x02", ""), F.lit(rf"(?is){edge}.*?(?={edge}|\z)|\A.+?(?={edge}|\z)"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<int>").alias("levels"))

    def step(s: Column, part: Column) -> Column:
        change = F.when(part.rlike(rf"(?i)\A<(?:{owner})\b"), 1).when(part.rlike(rf"(?i)\A</(?:{owner})\b"), -1).otherwise(0)
        return let(F.greatest(s.depth + change, F.lit(0)), lambda depth: F.struct(
            depth.alias("depth"), F.array_append(s.levels, depth).alias("levels")))

    def marked(part: Column, before: Column, after: Column) -> Column:
        mark = lambda depth: F.concat(F.lit("\x01"), depth.cast("string"), F.lit("\x02"))
        own = F.when(part.rlike(rf"(?i)\A{edge}"), mark(F.greatest(before, after))).otherwise("")
        return F.concat(own, F.regexp_replace(part, F.lit(rf"(?i)(?=</?(?:{inner})\b)"), mark(after)))

    return let(parts, lambda p: let(F.aggregate(p, start, step, lambda s: s.levels), lambda levels: F.array_join(
        F.transform(p, lambda part, i: marked(part, F.coalesce(F.get(levels, i - 1), F.lit(0)), F.get(levels, i))), "")))


def without_levels(c: Column) -> Column:
    return F.regexp_replace(c, r"\x01\d+\x02", "")


def whole_elements(levelled: Column, tag: str, stop: str = "") -> Column:
    """Contents of all ``tag`` elements in page order, inner ones once more on their own; depths are kept.

    The content is captured by a lookahead, so the search goes on inside it.
    """
    return F.regexp_extract_all(levelled, F.lit(rf"(?is){LEVEL}<(?:{tag})\b[^>]*>(?=(.*?)(?:{SAME}{stop}|\z))"), F.lit(2))


# --- X1: text --------------------------------------------------------------------------------------

def clean_html(html: Column) -> Column:
    """Drop scripts, styles, templates and comments; decode entities once for the whole page."""
    return decode_entities(F.regexp_replace(
        html, r"(?is)<(script|style|template)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)", ""), keep_markup=True)


def page_text(clean: Column) -> Column:
    """All text of a page, tags removed without a separator."""
    return restore_markup(F.regexp_replace(clean, TAG, ""))


def cell_text(fragment: Column) -> Column:
    """Text of a small fragment: the stripped text nodes joined without a separator."""
    return restore_markup(strip(F.regexp_replace(fragment, rf"(?U)\s*+{TAG}\s*+", "")))


def text_lines(fragment: Column) -> Column:
    """Trimmed non-blank text lines; every tag ends a line."""
    lines = F.split(restore_markup(F.regexp_replace(fragment, TAG, "\n")), "\n")
    return F.filter(F.transform(lines, strip), lambda x: x != "")


# --- X2-X5: label/value pairs ----------------------------------------------------------------------

PAIR = ("array<struct<label:string,value:string,is_text:boolean,confidence:double,method:string,"
        "row_pos:int,cell_pos:int>>")


def _pair(label: Column, value: Column, is_text, confidence, method, row_pos: Column, cell_pos: Column) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(label.alias("label"), value.alias("value"), as_col(is_text).alias("is_text"),
                    as_col(confidence).cast("double").alias("confidence"), as_col(method).alias("method"),
                    row_pos.cast("int").alias("row_pos"), cell_pos.cast("int").alias("cell_pos"))


def table_rows(clean: Column) -> Column:
    """array<array<string>>: the cell fragments of every table row.

    A cell that holds a table is a cell as a whole, followed in its row by the inner cells; inner rows are rows too.
    """
    rows = pieces(clean, open_tag("tr"), r"</?tr\b|</table\b")
    flat = F.transform(rows, lambda r: pieces(r, open_tag("t[dh]"), r"</?t[dh]\b"))
    whole_rows = whole_elements(with_levels(clean, "table", "tr|t[dh]"), "tr", r"</?t(?:r|able)\b")
    owned = F.transform(whole_rows, lambda r: F.transform(whole_elements(r, "t[dh]"), without_levels))
    return F.when(nested(clean, "table"), owned).otherwise(flat)


def table_pairs(rows: Column) -> Column:
    """Every cell with the next cell of its row; ``label`` is lower case."""
    def pairs(row: Column, r: Column) -> Column:
        labels = F.slice(row, F.lit(1), F.greatest(F.size(row) - 1, F.lit(0)))
        return F.transform(labels, lambda c, i: _pair(
            F.lower(cell_text(c)), F.get(row, i + 1), False, 1.0, "label_match_table", r, i))
    short = F.filter(F.flatten(F.transform(rows, pairs)), lambda p: F.length(p.label) < LABEL_LIMIT)
    return short.cast(PAIR)


def block_pairs(clean: Column, layout: tuple[str, str, str, str], inner_tag: str, method: str) -> Column:
    """One pair per vendor block (container, title and value found by class name)."""
    tag, container, title, value = layout
    # most pages do not use the layout: a plain search tells that faster than a pattern
    clean = F.when(F.contains(clean, F.lit(container)), clean)
    blocks = F.transform(pieces(clean, open_tag(tag, container), open_tag(tag, container)), lambda b: balanced(b, tag))

    def part(block: Column, css_class: str) -> Column:
        return cell_text(balanced(after_first(block, open_tag(inner_tag, css_class)), inner_tag))

    pairs = F.transform(blocks, lambda b, i: _pair(
        F.lower(part(b, title)), part(b, value), True, 1.0, method, i, F.lit(0)))
    return F.coalesce(F.filter(pairs, lambda p: p.label.isNotNull() & p.value.isNotNull()).cast(PAIR),
                      F.array().cast(PAIR))


def vendor_pairs(clean: Column) -> Column:
    return block_pairs(clean, BLOCK, "div", "label_match_block")


def vendor_list_pairs(clean: Column) -> Column:
    return block_pairs(clean, BLOCK_LIST, "span", "label_match_block_list")


def list_items(clean: Column) -> Column:
    """Fragments of the list items of a page; an item holds its inner lists, whose items follow it on their own."""
    owned = F.transform(whole_elements(with_levels(clean, "[uo]l", "li"), "li"), without_levels)
    return F.when(nested(clean, "[uo]l"), owned).otherwise(pieces(clean, open_tag("li"), r"<li\b|</(?:li|ul|ol)\b"))


def list_pairs(items: Column) -> Column:
    """X4: 'label: value' in one item, else the item with the next one. Takes ``list_items``."""
    texts = F.transform(items, cell_text)

    def pair(text: Column, i: Column) -> Column:
        inline = text.rlike("[:：]")
        own = strip(F.get(F.split(text, "[:：]", 2), F.lit(1)))
        return _pair(F.lower(text), F.when(inline, own).otherwise(F.get(items, i + 1)), inline,
                     F.when(inline, 0.9).otherwise(0.8),
                     F.when(inline, "label_match_list").otherwise("label_match_list_next"), i, F.lit(0))

    usable = lambda p: (F.length(p.label) < LABEL_LIMIT) & p.value.isNotNull()
    return F.filter(F.transform(texts, pair), usable).cast(PAIR)


TERM = "array<struct<label:string,definition:string,closes:boolean>>"


def terms(clean: Column) -> Column:
    """Every term of a page with its own definition (NULL without one) and whether its list ends before the next term."""
    def term(label: Column, definition: Column, closes: Column) -> Column:
        return F.struct(label.alias("label"), definition.alias("definition"), closes.alias("closes"))

    flat = F.transform(pieces(clean, open_tag("dt"), open_tag("dt")), lambda t: term(
        until(t, r"</dt\b|<dd\b|</dl\b"), until(after_first(until(t, r"</dl\b"), open_tag("dd")), r"</d[dl]\b"), t.rlike(r"(?i)</dl\b")))
    # label, own definition with its tag, end of the list: what of them comes first at the depth of the term
    pattern = (rf"(?is){LEVEL}<dt\b[^>]*>(?=(.*?)(?:{SAME}|\z))"
               rf"(?=.*?(?:{SAME}(?:(<dd\b[^>]*>.*?)(?={SAME}|\z)|<dt\b|(</dl\b))|\z))")
    levelled = with_levels(clean, "dl", "d[td]")
    parts = lambda c, group: F.regexp_extract_all(c, F.lit(pattern), F.lit(group))
    owned = let(levelled, lambda c: let(F.struct(parts(c, 2).alias("l"), parts(c, 3).alias("d"), parts(c, 4).alias("e")), lambda x: F.transform(
        x.l, lambda label, i: term(without_levels(label), after_first(without_levels(F.get(x.d, i)), r"\A<dd\b[^>]*>"), F.get(x.e, i) != ""))))
    return F.when(nested(clean, "dl"), owned.cast(TERM)).otherwise(flat.cast(TERM))


def definition_pairs(clean: Column) -> Column:
    """Every term with the first definition that follows it in its list."""
    start = F.struct(F.lit(None).cast("string").alias("next"), F.array().cast(STRINGS).alias("values"))

    def step(s: Column, t: Column) -> Column:
        return let(F.coalesce(t.definition, F.when(~t.closes, s.next)), lambda value: F.struct(
            value.alias("next"), F.array_append(s.values, value).alias("values")))

    # from the last term to the first, so that each looks at its follower only
    values = lambda ts: F.reverse(F.aggregate(F.reverse(ts), start, step, lambda s: s.values))
    pairs = let(terms(clean), lambda ts: let(values(ts), lambda vs: F.transform(ts, lambda t, i: _pair(
        F.lower(cell_text(t.label)), F.get(vs, i), False, 1.0, "label_match_dl", i, F.lit(0)))))
    return F.filter(pairs, lambda p: p.value.isNotNull()).cast(PAIR)


# --- X6: container ---------------------------------------------------------------------------------

def spec_container(clean: Column) -> Column:
    """Fragment of the first specification container, NULL when the page has none."""
    block = after_first(clean, open_tag(BLOCK[0], BLOCK[1]))
    table = after_first(clean, open_tag("table", loose="spec"))
    div = after_first(clean, open_tag("div", loose="spec|param|detail"))
    dl = after_first(clean, open_tag("dl"))
    plain = after_first(clean, open_tag("table"))
    return F.coalesce(block, balanced(table, "table"), balanced(div, "div"), balanced(dl, "dl"),
                      balanced(plain, "table"))


# --- X9: values ------------------------------------------------------------------------------------

def cell_items(fragment: Column) -> Column:
    """Items of a list cell: its list elements, else its separated text."""
    elements = F.filter(F.transform(list_items(fragment), cell_text), lambda x: x != "")
    return F.when(fragment.rlike("(?i)" + open_tag("li")), elements).otherwise(split_items(cell_text(fragment)))


def cell_value(fragment: Column, is_list: Column | bool = False) -> Column:
    """Raw value of a cell, NULL for an empty or placeholder cell."""
    def value(text: Column) -> Column:
        if is_list is False:
            return F.when(~F.lower(text).isin(*R.EMPTY_CELLS), text)
        items = let(cell_items(fragment), lambda x: F.when(F.size(x) > 0, json_list(x)))
        return F.when(~F.lower(text).isin(*R.EMPTY_CELLS), F.when(is_list if isinstance(is_list, Column) else F.lit(is_list), items).otherwise(text))
    return let(cell_text(fragment), value)


HIT = "struct<raw_value:string,confidence:double,method:string>"


def _hit(raw: Column, confidence, method) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(raw.alias("raw_value"), as_col(confidence).cast("double").alias("confidence"),
                    as_col(method).alias("method"))


# fields found by label; the others are read from the page as a whole
LABEL_FIELDS = tuple(f for f in R.FIELDS if f.code not in (
    "stream_count", "supplement_light_type", "deep_learning_function_categories"))


def label_hits(structures: list[Column]) -> Column:
    """For each of ``LABEL_FIELDS`` the first usable pair by search term, then by structure.

    Only the first pair of a structure counts for a term, also when its cell turns out to be empty.
    """
    fields = F.expr("array(" + ", ".join(
        f"named_struct('is_list', {str(f.value_type == 'list_text').lower()}, 'terms', array("
        + ", ".join(map(sql_text, f.terms)) + "))" for f in LABEL_FIELDS) + ")")

    def for_term(term: Column) -> Column:
        return F.array(*[F.get(F.filter(s, lambda p: F.contains(p.label, term)), F.lit(0)) for s in structures])

    def hit(pair: Column, is_list: Column) -> Column:
        raw = F.when(pair.is_text, pair.value).otherwise(cell_value(pair.value, is_list))
        return _hit(raw, pair.confidence, pair.method)

    def for_field(field: Column) -> Column:
        candidates = F.filter(F.flatten(F.transform(field.terms, for_term)), lambda p: p.isNotNull())
        usable = F.filter(F.transform(candidates, lambda p: hit(p, field.is_list)), lambda h: h.raw_value.isNotNull())
        return F.get(usable, F.lit(0))

    return F.transform(fields, for_field)


# --- fixed values: row of a field in a specification table without labels ---------------------------
ROW_OF_FIELD = {"max_resolution": 0, "image_sensor": 1, "lens_type": 2}


def position_hit(field: R.Field, container_rows: Column) -> Column:
    """Second cell of the field's usual row."""
    row = F.get(container_rows, F.lit(ROW_OF_FIELD[field.code]))
    return let(cell_value(F.get(row, F.lit(1))), lambda raw: F.when(
        raw.isNotNull(), _hit(raw, 0.7, "position_inference")))


def regex_hit(code: str, text: Column) -> Column | None:
    """First value-like text of the page."""
    if code == "max_resolution":
        raw = F.regexp_replace(found(text, V.SIZE, 0), V.SIZE_SIGN, "x")
    elif code == "supplement_light_range":
        raw = found(text, rf"(?iU){V.NUMBER}\s*(?:m|meters?|ft|feet)\b", 0)
    elif code == "aperture":
        raw = found(text, rf"(?iU)f/?\s*{V.NUMBER}", 0)
    else:
        return None
    return F.when(raw.isNotNull(), _hit(raw, 0.6, "regex_fallback"))


# --- X10-X13: fields read from the page as a whole --------------------------------------------------

def stream_count_hit(low: Column) -> Column:
    """X11, from the lower-case page text."""
    said = lambda word: low.rlike(rf"(?U){word}\s+stream")
    count = F.when(said("third"), "3").when(said("sub"), "2").when(said("main"), "1")
    return F.when(F.contains(low, F.lit("stream")) & count.isNotNull(), _hit(count, 1.0, "page_inference"))


def light_type_hit(low: Column) -> Column:
    """X12, with the infrared and warm light pair of X13, from the lower-case page text.

    A plain search for a word stands before each pattern: most pages fail it, and it is much cheaper.
    """
    has = lambda word: F.contains(low, F.lit(word))
    hit = lambda value, confidence: _hit(F.lit(value), confidence, "page_inference")
    warm = has("warm") & low.rlike(V.WARM_LIGHT)
    return (F.when((has("range") & low.rlike(V.IR_RANGE)) | (has("wavelength") & low.rlike(V.IR_WAVELENGTH)), hit("IR", 1.0))
            .when(has("infrared"), hit("IR", 0.9))
            .when(has("white") & low.rlike(V.WHITE_LIGHT), hit("White Light", 1.0))
            .when(warm & has("ir"), _hit(F.lit("IR + Warm Light"), 0.9, "light_pair"))
            .when(warm, hit("Warm Light", 1.0))
            .when(has("laser"), hit("Laser", 1.0)))


def smart_functions_hit(blocks: Column, rows: Column) -> Column:
    """Items of the first block titled 'smart', else functions named in table rows."""
    smart = F.filter(blocks, lambda b: F.contains(b.label, F.lit("smart")))
    named = F.get(F.filter(F.transform(smart, lambda b: split_items(b.value, ",")), lambda x: F.size(x) > 0), F.lit(0))

    def functions(row: Column) -> Column:
        return let(F.struct(cell_text(F.get(row, F.lit(0))).alias("label"), cell_text(F.get(row, F.lit(1))).alias("value")),
                   lambda texts: named_in(row, texts.label, texts.value))

    def named_in(row: Column, label: Column, value: Column) -> Column:
        low = F.lower(label)
        off = F.lower(value).isin(*R.OFF_VALUES)
        any_of = lambda words: low.rlike("|".join(words))
        element = F.get(row, F.lit(1))
        items = F.when(element.rlike("(?i)" + open_tag("li")), cell_items(element)).when(
            value.rlike("[;,]"), split_items(value, "[;,]")).otherwise(F.array(value))
        return (F.when(any_of(R.SMART_LABELS), F.when(off, F.array().cast(STRINGS)).otherwise(F.array(label)))
                .when(any_of(R.SMART_TOPICS) & ~off & (value != ""), items)
                .otherwise(F.array().cast(STRINGS)))

    wide = F.filter(rows, lambda r: F.size(r) >= 2)
    listed = F.array_distinct(F.flatten(F.transform(wide, functions)))
    by_block = let(named, lambda x: F.when(x.isNotNull(), _hit(json_list(x), 1.0, "smart_event_block")))
    by_table = let(listed, lambda x: F.when(F.size(x) > 0, _hit(json_list(x), 0.9, "smart_event_table")))
    return F.coalesce(by_block, by_table)


def protection_hit(rows: Column) -> Column:
    """An IP rating in the row labelled exactly 'Protection' also serves as anti-corrosion grade."""
    cells = F.transform(F.filter(rows, lambda r: F.size(r) >= 2),
                        lambda r: F.struct(cell_text(F.get(r, F.lit(0))).alias("label"),
                                           cell_text(F.get(r, F.lit(1))).alias("value")))
    first = F.get(F.filter(cells, lambda c: (c.label == "Protection") & c.value.rlike("IP[0-9]{2}")), F.lit(0))
    return F.when(first.isNotNull(), _hit(first.value, 1.0, "protection_row"))


# --- X14: list pages --------------------------------------------------------------------------------

def list_page_pairs(clean: Column) -> Column:
    """Label (first line) and value (other lines) of every list item with both."""
    def pair(item: Column, i: Column) -> Column:
        return let(text_lines(item), lambda lines: F.struct(
            F.get(lines, F.lit(0)).alias("label"),
            F.array_join(F.slice(lines, F.lit(2), F.size(lines)), " ").alias("value"), i.alias("pos")))
    return F.filter(F.transform(list_items(clean), pair),
                    lambda p: F.length(p.label).between(1, LABEL_LIMIT) & (p.value != ""))


def list_page_value(pairs: Column, labels: tuple[str, ...]) -> Column:
    """Value by label: exact text, else the first label that contains it in any case."""
    tries = []
    for label in labels:
        exact = F.filter(pairs, lambda p: p.label == label)
        part = F.filter(pairs, lambda p: F.contains(F.lower(p.label), F.lit(label.lower())))
        tries += [F.get(exact, F.lit(0)).value, F.get(part, F.lit(0)).value]
    return F.coalesce(*tries)


def interfaces(pairs: Column, raw: Column) -> Column:
    """The interface value followed by video output and storage values, without 'No' and repeats."""
    named = "|".join(R.EXTRA_INTERFACE_LABELS)
    extra = F.transform(F.filter(pairs, lambda p: F.lower(p.label).rlike(named) & (p.value != "No")), lambda p: p.value)
    first = F.when(F.coalesce(raw, F.lit("")) != "", F.array(strip(raw))).otherwise(F.array().cast(STRINGS))
    return F.array_distinct(F.concat(first, extra))


# --- X15: links -------------------------------------------------------------------------------------

def links(clean: Column) -> Column:
    """array<struct<href, heading, text>> of the anchors with a target."""
    anchors = F.regexp_extract_all(clean, F.lit(r"(?is)<a\b([^>]*>.*?)(?=</?a\b|\z)"), F.lit(1))

    def link(anchor: Column) -> Column:
        return let(F.struct(until(anchor, ">").alias("tag"), after_first(anchor, ">").alias("body")),
                   lambda a: parts(a.tag, a.body))

    def parts(tag: Column, body: Column) -> Column:
        href = F.coalesce(found(tag, r"""(?i)\bhref\s*=\s*"([^"]*)\""""), found(tag, r"""(?i)\bhref\s*=\s*'([^']*)'"""),
                          found(tag, r"""(?i)\bhref\s*=\s*([^"'\s>]+)"""))
        heading = cell_text(until(after_first(body, open_tag("h3", "h3-seo")), r"</h3\b"))
        return F.struct(restore_markup(href).alias("href"), heading.alias("heading"), F.array_join(text_lines(body), " ").alias("text"))
    return F.filter(F.transform(anchors, link), lambda x: x.href.isNotNull())


def series_name(slug: Column, allowlist: list[str] = ()) -> Column:
    """Series name of a url slug: the known names, else the first allowed name inside the slug."""
    low = F.lower(F.rtrim(slug, F.lit("-")))
    return F.coalesce(R.lookup(low, R.SERIES_BY_SLUG),
                      *[F.when(F.contains(low, F.lit(k.lower())), k) for k in allowlist])


def series_slug(name: Column) -> Column:
    return F.concat(F.regexp_replace(name, "[ /]", "-"), F.lit("-Series"))


def absolute_url(base: Column, href: Column) -> Column:
    """Join a site root and a link target."""
    return (F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), href))
            .when(href.startswith("/"), F.concat(F.regexp_extract(base, "^([^:]+://[^/]+)", 1), href))
            .otherwise(F.concat(F.regexp_replace(base, "/*$", "/"), href)))
