"""Field dictionary and other fixed values shared by the jobs.

These are constants of the data contract (codes, labels, aliases, units, class names), kept together so
that every job and every test reads the same table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F

from specloom.functions.text import constant_map


class Field(NamedTuple):
    code: str
    name: str
    value_type: str
    unit: str | None
    rule: str
    aliases: tuple[str, ...]

    @property
    def terms(self) -> list[str]:
        """Label search terms in lookup order: name, aliases as listed, code; lower case, no repeats."""
        return list(dict.fromkeys(t.lower() for t in (self.name, *self.aliases, self.code)))


# --- fixed values: the twelve specification fields -------------------------------------------------
FIELDS: tuple[Field, ...] = (
    Field("image_sensor", "Image Sensor", "text", None, "exact_or_alias",
          ("Image Sensor", "图像传感器")),
    Field("max_resolution", "Max. Resolution", "text", "px", "normalized_resolution",
          ("Max. Resolution", "最大分辨率")),
    Field("lens_type", "Lens Type", "text", None, "exact_or_alias",
          ("Lens Type", "镜头类型")),
    Field("aperture", "Aperture", "text", "f", "normalized_aperture",
          ("Aperture", "光圈")),
    Field("supplement_light_type", "Supplement Light Type", "text", None, "exact_or_alias",
          ("Supplement Light Type", "补光灯类型", "IR Type", "IR LED", "Supplement Light", "Infrared",
           "Illuminator Number", "Illuminator Type")),
    Field("supplement_light_range", "Supplement Light Range", "number_or_text", "m", "normalized_distance",
          ("Supplement Light Range", "补光距离", "IR Range", "IR Distance", "Illumination Distance")),
    Field("main_stream_max_fps_resolution", "Main Stream Max FPS@Resolution", "text", "fps+px",
          "normalized_fps_resolution",
          ("Main Stream", "主码流", "Main Stream Max FPS@Resolution", "Video Frame Rate", "Frame Rate")),
    Field("stream_count", "Stream Count", "integer", "count", "numeric_compare",
          ("Stream Count", "码流数量", "Third Stream", "Stream Capability")),
    Field("interface_items", "Interface", "list_text", None, "set_compare",
          ("Interface", "接口", "Network Port", "Audio Input", "Alarm Input", "Audio Output",
           "Alarm Output")),
    Field("deep_learning_function_categories", "Deep Learning Function Categories", "list_text", None,
          "set_compare",
          ("Deep Learning Function", "深度学习功能", "Smart Event", "Intelligence", "Smart Features",
           "Analytics", "IVS Functions", "AI Functions", "IVS", "SMD", "AcuPick")),
    Field("approval_protection", "Approval.Protection", "text", "grade", "exact_or_alias",
          ("Protection", "防护", "IP67", "IK10")),
    Field("approval_anti_corrosion_protection", "Approval.Anti-Corrosion Protection", "text", "grade",
          "exact_or_alias",
          ("Anti-Corrosion Protection", "防腐等级")),
)

# --- fixed values: severities and issue types ------------------------------------------------------
SEVERITIES = ("P1", "P2", "P3")
MISSING_FIELD, PARSE_FAILED, UNIT_ABNORMAL = "missing_field", "parse_failed", "unit_abnormal"
DUPLICATE_MODEL, SUBSERIES_EMPTY, HIERARCHY_CHANGED = "duplicate_model", "subseries_empty", "hierarchy_changed"
FAILURE_MARKERS = ("ERROR:", "PARSE_FAILED:", "N/A")
FPS_UNITS = ("fps", "px", "fps+px")

# --- fixed values: value aliases, looked up in this order ------------------------------------------
SENSOR_ALIASES = (
    ('1/2.8" Progressive Scan CMOS', '1/2.8" CMOS'),
    ('1/2.8" CMOS', '1/2.8" CMOS'),
    ('1/3" Progressive Scan CMOS', '1/3" CMOS'),
    ('1/1.8" Progressive Scan CMOS', '1/1.8" CMOS'),
    ('1/1.8" CMOS', '1/1.8" CMOS'),
    ("CMOS", "CMOS"),
    ("CCD", "CCD"),
)
LIGHT_ALIASES = (
    ("smart supplement light", "Smart"),
    ("ir", "IR"),
    ("infrared", "IR"),
    ("white light", "White Light"),
    ("led", "LED"),
    ("laser", "Laser"),
)
PROTECTION_ALIASES = (("ip67", "IP67"), ("ip66", "IP66"), ("ik10", "IK10"), ("ik08", "IK08"))

# --- fixed values: distance units in metres --------------------------------------------------------
METRES_PER_UNIT = {
    "m": 1.0, "meter": 1.0, "meters": 1.0, "mt": 1.0,
    "ft": 0.3048, "feet": 0.3048, "foot": 0.3048,
    '"': 0.0254, "in": 0.0254, "inch": 0.0254,
}
# the range reader knows three more
METRES_PER_RANGE_UNIT = {**METRES_PER_UNIT, "inches": 0.0254, "cm": 0.01, "mm": 0.001}

# --- fixed values: picture size by megapixel label -------------------------------------------------
MEGAPIXEL_SIZES = {
    "12MP": "4096x2160", "8MP": "3840x2160", "6MP": "3072x2048", "5MP": "2592x1944", "4MP": "2560x1440",
    "3MP": "2048x1536", "2MP": "1920x1080", "1MP": "1280x720", "0.9MP": "1280x720", "0.4MP": "640x480",
    "0.3MP": "640x480",
}

# --- fixed values: smart event classes, first hit wins ---------------------------------------------
SMART_EVENT_CLASSES = (
    ("line crossing", "Line Crossing Detection"),
    ("intrusion", "Intrusion Detection"),
    ("unattended|baggage", "Unattended Baggage Detection"),
    ("object removal", "Object Removal Detection"),
    ("face", "Face Detection"),
    ("scene change", "Scene Change Detection"),
)
SMART_LABELS = ("ivs", "smd", "acupick", "ai ssa", "smart search", "face detection")
SMART_TOPICS = ("intelligence", "smart", "deep learning", "analytics")
OFF_VALUES = ("no", "off", "none")
EMPTY_CELLS = ("", "-", "n/a", "none")

# --- fixed values: labels of the list-page layout --------------------------------------------------
LIST_PAGE_LABELS = {
    "image_sensor": ("Image Sensor",),
    "max_resolution": ("Max. Resolution", "Max Resolution"),
    "lens_type": ("Lens Type",),
    "aperture": ("Aperture",),
    "supplement_light_range": ("IR Range", "Supplement Light Range", "IR Distance"),
    "main_stream_max_fps_resolution": ("Main Stream",),
    "interface_items": ("Communication Interface", "Network Interface"),
    "approval_protection": ("Protection", "IP Rating"),
    "approval_anti_corrosion_protection": ("Anti-Corrosion Protection", "Anti-Corrosion"),
}
EXTRA_INTERFACE_LABELS = ("video output", "on-board", "on board", "storage")

# --- fixed values: series names by url slug --------------------------------------------------------
SERIES_BY_SLUG = {
    "pro-series-easyip": "Pro",
    "special-series": "Special",
    "value-series": "Value",
    "ultra-series-smartip": "Ultra",
    "pt-cameras": "PT",
    "wi-fi-series": "Wi-Fi",
    "panoramic-series": "Panoramic",
    "colorvu-products": "ColorVu",
    "solar-powered-security-camera-setup": "Solar",
    "deepinview-series1/deepinview-series": "DeepinView",
}

# --- fixed values: report column orders ------------------------------------------------------------
CATALOG_SHEET = ("brand", "series_l1", "series_l2", "product_model", "product_name", "product_url",
                 "catalog_status")
SPEC_SHEET = ("brand", "series_l1", "series_l2", "product_model", "field_code", "field_name", "raw_value",
              "normalized_value", "unit", "extract_confidence", "is_manual_override")
ISSUE_SHEET = ("run_id", "brand", "series_l1", "series_l2", "product_model", "issue_type", "field_code",
               "issue_detail", "severity", "status")
SUMMARY_SHEET = ("run_id", "schedule_type", "started_at", "ended_at", "catalog_count", "spec_field_count",
                 "issue_count", "new_series_count", "disappeared_series_count", "success_rate", "status")
MANUAL_SHEET = ("brand", "series_l1", "series_l2", "product_model", "field_code", "manual_value", "operator",
                "reason")

FIELD_CODES: tuple[str, ...] = tuple(f.code for f in FIELDS)
REQUIRED_FIELDS = FIELD_CODES
FIELD_BY_CODE = {f.code: f for f in FIELDS}
LIST_FIELDS = tuple(f.code for f in FIELDS if f.value_type == "list_text")
UNIT_BY_FIELD = {f.code: f.unit for f in FIELDS if f.unit}


def lookup(key: Column, table: dict[str, object]) -> Column:
    """Value of a small constant table, NULL for an unknown key (a literal map, so no join)."""
    return F.try_element_at(constant_map(table), key)


def expected_unit(field: Column) -> Column:
    return lookup(field, UNIT_BY_FIELD)


def field_name(field: Column) -> Column:
    return lookup(field, {f.code: f.name for f in FIELDS})


def value_type(field: Column) -> Column:
    return lookup(field, {f.code: f.value_type for f in FIELDS})
