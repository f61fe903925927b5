"""Checks of human corrections and upserts."""

from pyspark.sql import functions as F

from specloom.checks.base import check
from specloom.operators import merge

RUN = "19980101_monthly_01"
AT = "TIMESTAMP '2002-01-01 00:00:00'"
FULL = "brand, series_l1, series_l2, product_model, field_code"
USABLE = "coalesce(brand, '') <> '' AND coalesce(series_l1, '') <> ''"
SAME = " AND ".join(f"s.{k} IS NOT DISTINCT FROM m.{k}" for k in FULL.split(", "))


def at():
    return F.lit("2002-01-01 00:00:00").cast("timestamp")


def newest(keys: str, where: str = "TRUE") -> str:
    return f"""(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created_at DESC, input_id DESC) AS k
      FROM manual WHERE {where}) AS q WHERE k = 1)"""


MERGED = f""", s AS (SELECT * FROM specs WHERE run_id = '{RUN}'),
  m AS {newest('product_model, field_code', USABLE + ' AND product_model IS NOT NULL')},
  merged AS (
    SELECT s.run_id, s.brand, s.series_l1, s.series_l2, s.product_model, s.field_code, coalesce(m.manual_value, s.raw_value) AS raw_value,
      CASE WHEN m.input_id IS NULL THEN s.normalized_value ELSE m.manual_value END AS normalized_value, s.unit,
      CASE WHEN m.input_id IS NULL THEN extract_confidence ELSE 1.0 END AS extract_confidence,
      is_manual_override OR m.input_id IS NOT NULL AS is_manual_override, s.source_url
    FROM s LEFT JOIN m ON s.product_model = m.product_model AND s.field_code = m.field_code
    UNION ALL
    SELECT '{RUN}', brand, series_l1, series_l2, coalesce(nullif(product_model, ''), 'MANUAL_INPUT'), field_code, manual_value, manual_value, NULL, 1.0, TRUE, 'MANUAL_INPUT'
    FROM (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.product_model = m.product_model AND s.field_code = m.field_code)
          UNION ALL SELECT * FROM manual WHERE product_model IS NULL AND {USABLE}) AS n)"""
COLS = ["run_id", *FULL.split(", "), "raw_value", "normalized_value", "unit", "extract_confidence", "is_manual_override", "source_url"]

check("J3_merge_manual", MERGED + " SELECT * FROM merged", "specs", "manual")(
    lambda t: merge.merge_manual(t.specs, t.manual, RUN, at()).select(*COLS))
check("J3_merge_counts", MERGED + f""", g AS (SELECT product_model, field_code, {USABLE} AS ok, count(*) AS n FROM manual GROUP BY 1, 2, 3),
  e AS (SELECT g.*, EXISTS (SELECT 1 FROM s WHERE s.product_model = g.product_model AND s.field_code = g.field_code) AS inside FROM g),
  a AS (SELECT *, CASE WHEN ok AND NOT inside THEN CASE WHEN product_model IS NULL THEN n ELSE 1 END ELSE 0 END AS added FROM e)
  SELECT cast(sum(n) AS BIGINT) AS manual_inputs_count, cast(sum(CASE WHEN ok THEN n - added ELSE 0 END) AS BIGINT) AS overrides_applied, cast(sum(added) AS BIGINT) AS new_products_added,
         cast(sum(CASE WHEN ok THEN 0 ELSE n END) AS BIGINT) AS import_errors FROM a""", "specs", "manual")(
    lambda t: merge.merge_counts(t.specs, t.manual, RUN))
check("J4_override_status", f"""SELECT input_id, brand, product_model, field_code,
  CASE WHEN hit THEN 'applied' ELSE 'skipped' END AS status, CASE WHEN NOT hit THEN 'No matching spec record found' END AS reason
  FROM (SELECT *, EXISTS (SELECT 1 FROM specs AS s WHERE s.run_id = '{RUN}' AND {SAME}) AS hit FROM manual AS m) AS q""", "specs", "manual")(
    lambda t: merge.override_status(t.specs, t.manual, RUN))
check("J4_apply_overrides", f""", m AS {newest(FULL)} SELECT s.run_id, s.brand, s.series_l1, s.series_l2, s.product_model, s.field_code,
  CASE WHEN m.input_id IS NULL THEN s.raw_value ELSE m.manual_value END AS raw_value, extract_confidence,
  is_manual_override OR m.input_id IS NOT NULL AS is_manual_override, CASE WHEN m.input_id IS NULL THEN updated_at ELSE {AT} END AS updated_at
  FROM (SELECT * FROM specs WHERE run_id = '{RUN}') AS s LEFT JOIN m ON {SAME}""", "specs", "manual")(
    lambda t: merge.apply_overrides(t.specs, t.manual, RUN, at()).select(
        "run_id", *FULL.split(", "), "raw_value", "extract_confidence", "is_manual_override", "updated_at"))
check("J8_audit_trail", MERGED + f""", l AS {newest(FULL)}, o AS (SELECT {FULL}, max({{'t': updated_at, 'v': normalized_value}}).v AS previous_value
    FROM s GROUP BY {FULL}),
  d AS (SELECT DISTINCT run_id, {FULL} FROM merged WHERE is_manual_override)
  SELECT s.run_id, s.brand, s.series_l1, s.series_l2, s.product_model, s.field_code, previous_value, m.manual_value, m.operator, m.reason, m.created_at
  FROM d AS s JOIN l AS m ON {SAME} LEFT JOIN o ON {SAME.replace('m.', 'o.')}""", "specs", "manual")(
    lambda t: merge.audit_trail(merge.merge_manual(t.specs, t.manual, RUN, at()), t.specs, t.manual, RUN))
check("J13_revert_override", MERGED + f""", x AS (SELECT * FROM merged),
  o AS (SELECT run_id, {FULL}, max({{'t': updated_at, 'r': raw_value, 'v': normalized_value, 'c': extract_confidence}}) AS o FROM s GROUP BY run_id, {FULL}),
  h AS (SELECT x.*, o.o AS old, x.brand = 'Brand#12' AND x.product_model = 'M4' AND x.field_code = 'aperture' AND x.is_manual_override AS hit
    FROM x LEFT JOIN o ON x.run_id = o.run_id AND {SAME.replace('s.', 'x.').replace('m.', 'o.')})
  SELECT run_id, {FULL}, CASE WHEN hit AND old IS NOT NULL THEN old.r ELSE raw_value END AS raw_value,
    CASE WHEN hit AND old IS NOT NULL THEN old.v ELSE normalized_value END AS normalized_value,
    CASE WHEN hit THEN FALSE ELSE is_manual_override END AS is_manual_override FROM h""", "specs", "manual")(
    lambda t: merge.revert_override(merge.merge_manual(t.specs, t.manual, RUN, at()), t.specs, RUN, "Brand#12", "M4", "aperture").select(
        "run_id", *FULL.split(", "), "raw_value", "normalized_value", "is_manual_override"))
check("J13_manual_left", """SELECT input_id FROM manual WHERE NOT coalesce(brand = 'Brand#12' AND field_code = 'aperture'
  AND product_model = 'M4', FALSE)""", "manual")(
    lambda t: merge.without_manual(t.manual, "Brand#12", "M4", "aperture").select("input_id"))
check("W2_last_manual", f"SELECT * FROM {newest(FULL)} AS q", "manual")(lambda t: merge.latest_manual(t.manual))
check("W3_upsert_specs", f""", u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_model, field_code
      ORDER BY updated_at DESC, raw_value DESC NULLS LAST) AS k FROM specs WHERE run_id > '{RUN}') AS q WHERE k = 1),
  e AS (SELECT * FROM specs WHERE run_id = '{RUN}')
  SELECT e.run_id, e.brand, e.series_l1, e.series_l2, e.product_model, e.field_code, CASE WHEN u.k IS NULL THEN e.raw_value ELSE u.raw_value END AS raw_value,
    CASE WHEN u.k IS NULL THEN e.unit ELSE u.unit END AS unit, e.is_manual_override
  FROM e LEFT JOIN u ON e.product_model = u.product_model AND e.field_code = u.field_code
  UNION ALL SELECT '{RUN}', brand, series_l1, series_l2, product_model, field_code, raw_value, unit, is_manual_override FROM u
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.product_model = u.product_model AND e.field_code = u.field_code)""", "specs")(
    # the values of all later runs arrive as updates of one run
    lambda t: merge.upsert_specs(t.specs.where(F.col("run_id") == RUN),
                                 t.specs.where(F.col("run_id") > RUN).withColumn("run_id", F.lit(RUN)), "updated_at").select(
        "run_id", *FULL.split(", "), "raw_value", "unit", "is_manual_override"))

EMPTY = lambda c: f"coalesce({c}, '') = ''"
MISSING = "list_filter([" + ", ".join(f"CASE WHEN {EMPTY(c)} THEN '{c}' END" for c in (
    "brand", "series_l1", "series_l2", "product_model", "field_code", "manual_value", "operator", "reason")) + "], lambda x: x IS NOT NULL)"


def manual_rows(t):
    return t.manual.withColumn("row_no", F.substring("input_id", 2, 20).cast("bigint") + 2)


ROWS = f", r AS (SELECT *, cast(substr(input_id, 2) AS BIGINT) + 2 AS row_no, {MISSING} AS missing FROM manual)"


@check("S8_rejected_rows", ROWS + """ SELECT row_no, 'Row ' || row_no || ': Missing required fields: [''' ||
  array_to_string(missing, ''', ''') || ''']' AS error FROM r WHERE len(missing) > 0""", "manual")
def _(t):
    from specloom.sources.manual import rejected
    return rejected(manual_rows(t))


@check("S8_accepted_rows", ROWS + f""", g AS (SELECT * EXCLUDE (created_at) FROM r WHERE len(missing) = 0)
  SELECT {FULL}, arg_max(manual_value, row_no) AS manual_value, arg_max(operator, row_no) AS operator FROM g GROUP BY {FULL}""", "manual")
def _(t):
    from specloom.sources.manual import accepted
    return accepted(manual_rows(t), at()).select(*FULL.split(", "), "manual_value", "operator")
