"""Personal data and the terms that give it away (operator 6). DataFrame functions only.

Base spans come from patterns. All words of a text outside its base spans are terms that may disclose its entities. Corpus
statistics say how strongly: with document frequencies, ``PMI(e; t) = log2(N df(e, t) / (df(e) df(t)))`` is what a term
tells about an entity and ``IC(e) = log2(N / df(e))`` is all there is to tell. A term whose share ``PMI / IC`` exceeds the
threshold is sanitised wherever it stands in a text with that entity: generalised to its class, or removed
when it tells nearly everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.llm.common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract. Possessive repetition can't change a match here (what follows is never in the class) and
# keeps the matcher from recursing; a match may only begin where a run begins or the last match ended, as the leftmost
# match always does, so long runs are read once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+", "ip": ".", "card": None}
CONTEXT = 1 << 31  # code points on each side of a base span in which terms stand: more than a text has, so all its words count
TERM = r"\p{L}{3,}"
# base spans are hidden before words are looked for: letters by one mark, all else by another, so that places stay and a word that
# runs into a span is none
LETTER, OTHER = "\ue000", "\ue001"
WORD = rf"(?<![\p{{L}}{LETTER}])\p{{L}}{{3,}}+(?![\p{{L}}{LETTER}])"
SUPPORT = 3  # different texts in which entity and term must stand together
THRESHOLD = 0.8  # share of the entity's information from which a term is generalised
REMOVE = 0.95  # share from which it is removed


def matches(text: Column, pattern: str, valid=None) -> Column:
    """``array<struct<value, start, end>>`` of the pattern's matches (code points, end exclusive), in order."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.lit(0).cast("bigint")
    placed = F.aggregate(
        F.arrays_zip(found.alias("value"), F.slice(F.transform(between, F.length), 1, F.size(found)).alias("gap")),
        F.struct(start.alias("at"), F.array().cast("array<struct<value:string,start:bigint,end:bigint>>").alias("out")),
        lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + F.length(m["value"])).cast("bigint").alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                m["value"].alias("value"), (acc["at"] + m["gap"]).cast("bigint").alias("start"),
                (acc["at"] + m["gap"] + F.length(m["value"])).cast("bigint").alias("end")))).alias("out")),
        lambda acc: acc["out"])
    none = F.array().cast("array<struct<value:string,start:bigint,end:bigint>>")
    out = F.when(F.size(found) > 0, placed).otherwise(none)
    return F.filter(out, lambda m: valid(m["value"])) if valid else out


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    doubled = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str):
    if kind == "ip":
        return lambda v: F.forall(F.split(v, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                                  & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return lambda v: F.when(F.length(digits(v)).between(12, 19), luhn(digits(v))).otherwise(False)
    if kind == "phone":
        return lambda v: F.length(digits(v)).between(9, 15)
    return None


def _labelled(rank: int, kind: str):
    return lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        F.concat(F.lit(kind + ":"), F.lower(m["value"]) if kind in ("email", "ip") else digits(m["value"])).alias("entity"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def base_spans(text: Column) -> Column:
    """``array<struct<kind, start, end, entity>>`` of all kinds, by start, then kind as listed."""
    parts = []
    for rank, kind in enumerate(KINDS):
        found = matches(text, PATTERNS[kind], _valid(kind))
        rows = F.transform(found, _labelled(rank, kind))
        none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,entity:string>>")
        parts.append(F.when(text.contains(NEEDS[kind]), rows).otherwise(none) if NEEDS[kind] else rows)
    return F.array_sort(F.concat(*parts))


def _hidden(text: Column, spans: Column) -> Column:
    """The text with its base spans hidden behind marks, length and places unchanged."""
    kind = "struct<at:bigint,out:array<string>>"
    plain = F.translate(text, LETTER, OTHER)
    hide = lambda v: F.regexp_replace(F.regexp_replace(v, r"\p{L}", LETTER), f"[^{LETTER}]", OTHER)

    def step(acc, s):
        begin = F.greatest(s["start"], acc["at"])
        parts = F.array(F.substring(plain, acc["at"] + 1, begin - acc["at"]), hide(F.substring(plain, begin + 1, s["end"] - begin)))
        return F.when(s["end"] > acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], parts).alias("out")).cast(kind)).otherwise(acc)
    return F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out")).cast(kind), step,
                       lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(plain, acc["at"] + 1, F.length(plain))))


def find_base(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, spans, hidden`` per row; ``digest`` (of the text) and the text with hidden spans only where there are spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", "text", base_spans(F.col("text")).alias("spans"))
    some = F.size("spans") > 0
    return rows.select("doc_id", F.when(some, F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "spans",
                       F.when(some, _hidden(F.col("text"), F.col("spans"))).alias("hidden"))


def _texts(base: DataFrame) -> DataFrame:
    """``digest, n, entities, hidden``: the different texts with base spans and the number of their copies."""
    entities = F.array_distinct(F.transform("spans", lambda s: s["entity"]))
    return base.where("digest is not null").groupBy("digest").agg(
        F.count("*").alias("n"), F.first(entities).alias("entities"), F.first("hidden").alias("hidden"))  # copies have equal ones


def disclosing(base: DataFrame, docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """``entity, term, share``: the terms that exceed the threshold, from the statistics of the whole corpus.

    Copies of one text count in the frequencies, as they do in df(t), but one text alone supports nothing: an entity in fewer texts
    than ``support`` has no pair, so only the others meet the words of their texts.
    """
    texts = _texts(base)
    held = texts.select("digest", "n", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.sum("n").alias("df_entity"), F.count("*").alias("texts"))
    common = held.join(entities.where(F.col("texts") >= support).select("entity"), "entity", "left_semi").groupBy("digest").agg(
        F.collect_list("entity").alias("common"))
    words = texts.join(common, "digest").select("n", "common", F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("hidden", F.lit(WORD), F.lit(0)), F.lower))).alias("term"))
    pairs = words.select("n", "term", F.explode("common").alias("entity")).groupBy("entity", "term").agg(
        F.sum("n").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    pairs = materialize(pairs.select("entity", "term", "both"))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty()), F.lit(TERM), F.lit(0)))).alias("term"))
    # counted before the join: a term that stands nearly everywhere is one row per task then
    df = words.groupBy("term").agg(F.count("*").alias("df_term")).join(pairs.select("term").distinct(), "term", "left_semi")
    n = F.lit(float(base.count()))
    information = F.log2(n / F.col("df_entity"))
    told = F.log2(n * F.col("both") / (F.col("df_entity") * F.col("df_term")))
    return (pairs.join(df, "term").join(entities.drop("texts"), "entity").where(information > 0)
            .select("entity", "term", (told / information).alias("share")).where(F.col("share") >= threshold))


def term_spans(base: DataFrame, terms: DataFrame, remove: float = REMOVE) -> DataFrame:
    """``digest, term_spans``: every place of a disclosing term in a text with its entity, as ``array<struct<start, end, removed>>``."""
    texts = _texts(base)
    wanted = texts.select("digest", F.explode("entities").alias("entity")).join(terms, "entity").groupBy("digest", "term").agg(
        (F.max("share") >= remove).alias("removed"))
    found = F.regexp_extract_all("hidden", F.lit(WORD), F.lit(0))
    gaps = F.transform(F.split("hidden", WORD, -1), F.length)
    words = texts.join(wanted.select("digest").distinct(), "digest", "left_semi").select("digest", F.posexplode(F.arrays_zip(
        found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap")))).select("digest", "pos", "col.value", "col.gap")
    so_far = Window.partitionBy("digest").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # the words of one text
    end = F.sum(F.col("gap") + F.length("value")).over(so_far)
    places = words.withColumn("end", end).select("digest", F.lower("value").alias("term"), (F.col("end") - F.length("value")).alias("start"), "end")
    return places.join(wanted, ["digest", "term"]).groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "removed"))).alias("term_spans"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, remove: float = REMOVE) -> DataFrame:
    """Spans of personal data and disclosing terms per row of ``docs`` (``doc_id, text``; other columns ignored).

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term``. ``spans`` adds ``term:start:end`` to the base spans. Null and
    empty texts have no spans; rows with null or repeated ``doc_id`` are read each on its own. An empty table gives no rows.
    """
    base = materialize(find_base(docs))
    extra = term_spans(base, disclosing(base, docs, support, threshold), remove)
    columns = ["doc_id", "spans"]
    bare = base.where("digest is null").select(*columns, F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>").alias("term_spans"))
    rows = base.where("digest is not null").join(extra, "digest", "left").select(*columns, "term_spans").unionByName(bare)
    none = F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>")
    full = F.array_sort(F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.transform(F.coalesce("term_spans", none), lambda t: F.struct(
            t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("term").alias("kind")))))
    return rows.select(
        "doc_id", *[F.size(F.filter("spans", _of_kind(k))).cast("long").alias("n_" + k) for k in KINDS],
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(full).alias("spans"),
        F.size(F.coalesce("term_spans", none)).cast("long").alias("n_term"))


def _rewrite(text: Column, spans: Column, terms: Column) -> Column:
    """The text with base spans replaced by their kind, terms by their class or nothing; overlapping spans become one."""
    name = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(
        F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label")))
    word = F.transform(terms, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["removed"], F.lit("")).when(
        F.substring(text, t["start"] + 1, F.lit(1)).rlike(r"\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[WORD]")).alias("label")))
    kind = "array<struct<start:bigint,end:bigint,label:string>>"
    merged = F.aggregate(F.array_sort(F.concat(name, word)).cast(kind), F.array().cast(kind), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.try_element_at(acc, F.lit(-1))["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(s["end"], F.try_element_at(acc, F.lit(-1))["end"]).alias("end"),
            F.try_element_at(acc, F.lit(-1))["label"].alias("label")))).cast(kind)).otherwise(F.concat(acc, F.array(s))))
    pieces = F.transform(merged, lambda s, i: F.concat(
        F.substring(text, _end_before(merged, i) + 1, s["start"] - _end_before(merged, i)), s["label"]))
    tail = F.substring(text, F.coalesce(F.try_element_at(merged, F.lit(-1))["end"], F.lit(0).cast("bigint")) + 1, F.length(text))
    return F.concat(F.array_join(pieces, ""), tail)


def _end_before(merged: Column, i: Column) -> Column:
    return F.when(i > 0, F.element_at(merged, F.greatest(i, F.lit(1)))["end"]).otherwise(F.lit(0).cast("bigint"))


def sanitise(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, remove: float = REMOVE) -> DataFrame:
    """``docs`` with personal data and disclosing terms taken out of ``text``; all rows and columns stay.

    Texts without base spans (null ones too) come back as they are.
    """
    base = materialize(find_base(docs))
    extra = term_spans(base, disclosing(base, docs, support, threshold), remove)
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_or_empty().alias("text")).withColumn("spans", base_spans(F.col("text")))
    clean = rows.where(F.size("spans") == 0).select("row.*")
    none = F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>")
    found = rows.where(F.size("spans") > 0).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).join(extra, "digest", "left")
    changed = found.select(F.col("row").withField("text", _rewrite(F.col("text"), F.col("spans"), F.coalesce("term_spans", none))).alias("row"))
    return changed.select("row.*").unionByName(clean)
