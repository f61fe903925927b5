"""Small string column helpers used by every job. All are built-in expressions, none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from functools import wraps
from html.entities import html5

from pyspark import SparkContext
from pyspark.sql import Column, functions as F

# Characters counted as white space, beyond the plain blank that SQL ``trim`` knows.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
              + "".join(chr(c) for c in range(0x2000, 0x200B)) + "    　")
STRINGS = "array<string>"


def built_once(make):
    """Keep the result of a function that builds large column expressions, per running Spark context.

    Building an expression costs a call to the JVM per node; an unresolved column can be used in any number of
    plans.
    """
    kept = {}

    def get(*args):
        context = SparkContext._active_spark_context
        key = (id(context), context.applicationId if context else None, *args)
        if key not in kept:
            for old in [k for k in kept if k[:2] != key[:2]]:  # of a context that was stopped
                del kept[old]
            kept[key] = make(*args)
        return kept[key]

    return wraps(make)(get)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """NULL, empty or white space only; never NULL itself."""
    return F.coalesce(strip(c) == "", F.lit(True))


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a regex group, NULL (not '') when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def sql_text(value: object) -> str:
    """SQL literal of a string or a number."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def constant_map(table: dict[str, object]) -> Column:
    """A literal map; constant folding turns it into one value."""
    return F.expr("map(" + ", ".join(f"{sql_text(k)}, {sql_text(v)}" for k, v in table.items()) + ")")


def strings(*values: str) -> Column:
    """An array<string> literal."""
    return F.expr("array(" + ", ".join(map(sql_text, values)) + ")") if values else F.array().cast(STRINGS)


def json_list(items: Column) -> Column:
    """JSON text of a string array with ', ' between the items."""
    quoted = F.transform(items, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def split_items(c: Column, separators: str = "[,;，、\n]") -> Column:
    """Non-blank trimmed parts of a separated text."""
    return F.filter(F.transform(F.split(c, separators), strip), lambda x: x != "")


def first_wins(items: Column, key=F.lower) -> Column:
    """Drop later items whose key was seen before, keeping order and the first spelling."""
    return F.aggregate(
        items, F.array().cast(STRINGS),
        lambda acc, x: F.when(F.exists(acc, lambda a: key(a) == key(x)), acc).otherwise(F.array_append(acc, x)))


def plain_number(x: Column) -> Column:
    """Whole numbers without a fraction, others with at most two decimals."""
    two = F.regexp_replace(F.format_string("%.2f", x), r"\.?0+$", "")
    return F.when(x == F.floor(x), x.cast("bigint").cast("string")).when(x.isNotNull(), two)


def float_text(x: Column) -> Column:
    """Decimal text of a double: 50.0, also for values Spark would print as 1.0E7."""
    whole = F.concat(x.cast("bigint").cast("string"), F.lit(".0"))
    return F.when((x >= 1e7) & (x < 1e16) & (x == F.floor(x)), whole).otherwise(x.cast("string"))


def first_match(c: Column, rules: Sequence[tuple[str, object]], test) -> Column:
    """CASE over constant rules in listed order; NULL when no rule applies."""
    out = None
    for key, value in rules:
        out = (F if out is None else out).when(test(c, key), F.lit(value))
    return out


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body`` (lambdas have no common subexpressions)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Characters with a meaning in markup, and private-use stand-ins for them while a page is being cut.
MARKUP = "<>\"'&"
STAND_INS = "\ue000\ue001\ue002\ue003\ue004"


def decode_entities(c: Column, keep_markup: bool = False) -> Column:
    """Decode named and numeric character references; texts without '&' are passed through.

    With ``keep_markup`` decoded markup characters come out as stand-ins, so that tags stay recognizable until
    ``restore_markup``.
    """
    shown = dict(zip(MARKUP, STAND_INS)) if keep_markup else {}
    # one text literal, so that the whole list (over two thousand names) is folded into a single map
    named = F.str_to_map(F.lit("\x02".join(f"{name[:-1]}\x01{shown.get(ch, ch)}" for name, ch in sorted(html5.items()) if name[-1] == ";")),
                         F.lit("\x02"), F.lit("\x01"))

    def char_of(ref: Column) -> Column:
        digits = F.regexp_replace(ref, "^#[xX]?0*", "")  # no valid number has more than 6 or 7 digits then
        code = F.when(ref.rlike("^#[xX]"), F.when(F.length(digits) <= 6, F.conv(digits, 16, 10))).when(
            F.length(digits) <= 7, digits).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        if keep_markup:
            char = F.translate(char, MARKUP, STAND_INS)
        return F.when(ref == "", F.lit(None)).when(ref.startswith("#"), F.when(valid, char)).otherwise(
            F.try_element_at(named, ref))

    def one(piece: Column) -> Column:
        ref = F.regexp_extract(piece, r"^(#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);", 1)
        return let(ref, lambda r: F.coalesce(
            F.concat(char_of(r), F.substring(piece, F.length(r) + 2, F.length(piece))), F.concat(F.lit("&"), piece)))

    pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(one(p)))
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


def restore_markup(c: Column) -> Column:
    # most texts have no stand-ins, and searching is cheaper than rebuilding
    return F.when(c.rlike(f"[{STAND_INS}]"), F.translate(c, STAND_INS, MARKUP)).otherwise(c)
