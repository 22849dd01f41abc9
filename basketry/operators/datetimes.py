"""Datetime columns given as text, in one layout a column.

As in pandas the first value in scan order decides: its layout is worked out by
a small grammar (date part, separator, time part, zone), and every other value
must have the same layout or becomes NULL. A first value that is no date decides
nothing: then each value is read by the fixed ISO layouts.

Working out the layouts of all text columns takes one aggregate: the first value
of each column. Everything after is a row-wise expression with a literal layout.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.coerce import datetime_expr, iso_seconds
from basketry.operators.dedup import SEQ

#: Two-digit years from this one on belong to the last century.
PIVOT_YEAR = 69
_DATE = re.compile(r"(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})"
                   r"|(?P<a>\d{1,2})(?P<t>[-/.])(?P<b>\d{1,2})(?P=t)(?P<z>\d{4}|\d{2})"
                   r"|(?P<compact>\d{8})(?!\d)|(?P<month>\d{4}-\d{1,2})(?![-\d])"
                   r"|(?P<dn>\d{1,2}) (?P<n1>[A-Za-z]{3,9}) \d{4}|(?P<n2>[A-Za-z]{3,9}) \d{1,2}, \d{4}")
_TIME = re.compile(r"(?P<sep>[T ])(?P<h>\d{1,2}):\d{2}(?P<sec>:\d{2}(?P<frac>\.\d{1,9})?)?(?P<half> ?[AaPp][Mm])?"
                   r"(?P<zone>Z|[+-]\d{2}:\d{2}|[+-]\d{4})?")
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _month_letters(name: str) -> str | None:
    name = name.lower()
    return "MMMM" if name in _MONTHS and len(name) > 3 else "MMM" if name in {m[:3] for m in _MONTHS} else None


def layout_of(text: str | None) -> str | None:
    """The datetime pattern that a value is written in; None for what is no datetime.

    Day and month in front of a year are month first, unless the first one is
    beyond 12.
    """
    m = _DATE.match(text or "")
    if not m:
        return None
    if m["y"]:
        ok, date = 1 <= int(m["m"]) <= 12 and 1 <= int(m["d"]) <= 31, f"yyyy{m['s']}M{m['s']}d"
    elif m["a"]:
        day_first = int(m["a"]) > 12
        day, month = (m["a"], m["b"]) if day_first else (m["b"], m["a"])
        ok, parts = 1 <= int(month) <= 12 and 1 <= int(day) <= 31, ["d", "M"] if day_first else ["M", "d"]
        date = m["t"].join([*parts, "yyyy" if len(m["z"]) == 4 else "yy"])
    elif m["compact"]:
        ok, date = 1 <= int(m["compact"][4:6]) <= 12 and 1 <= int(m["compact"][6:]) <= 31, "yyyyMMdd"
    elif m["month"]:
        ok, date = 1 <= int(m["month"][5:]) <= 12, "yyyy-M"
    else:
        letters = _month_letters(m["n1"] or m["n2"])
        ok, date = letters is not None, f"d {letters} yyyy" if m["n1"] else f"{letters} d, yyyy"
    rest = text[m.end():]
    if not ok or not rest:
        return date if ok else None
    t = _TIME.fullmatch(rest)
    if not t or m["month"]:
        return None
    hour = "h" if t["half"] else "H"
    out = date + ("'T'" if t["sep"] == "T" else " ") + hour + ":mm" + (":ss" if t["sec"] else "") + (".SSSSSS" if t["frac"] else "")
    if t["half"]:
        out += " a" if t["half"][0] == " " else "a"
    return out + ("" if not t["zone"] else "XXX" if t["zone"] == "Z" or ":" in t["zone"] else "XX")


def infer_layouts(df: DataFrame, columns: Iterable[str], order: str = SEQ) -> dict[str, str | None]:
    """Layout of each text column by its first value that is not missing, in ``order``; one aggregate."""
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    row = df.agg(*[F.min_by(F.trim(F.col(f"`{c}`")), F.when(F.trim(F.col(f"`{c}`")) != "", F.col(order))).alias(c) for c in texts]).first()
    return {c: layout_of(row[c]) for c in texts}


def parsed(c: Column, layout: str) -> Column:
    """Text of one layout as TIMESTAMP_NTZ (with a zone: in UTC); anything else is NULL."""
    text = F.trim(c)
    # a fraction may have up to nine digits, of which six are kept; a pattern letter alone would also take longer numbers
    if ".SSSSSS" in layout:
        text = F.regexp_replace(text, r"(\.\d{6})\d{1,3}", "$1")
    shape = _shape(layout)
    out = F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(layout))
    if "XX" in layout:
        out = F.to_utc_timestamp(out.cast("timestamp"), "UTC")
    out = out.cast("timestamp_ntz")
    if re.search(r"(?<!y)yy(?!y)", layout):
        out = F.when(F.year(out) >= 2000 + PIVOT_YEAR, out - F.expr("INTERVAL 100 YEARS")).otherwise(out)
    return out


def _by_layout(c: Column, layout: str, fixed: Column) -> Column:
    """Text of a column by its layout, else by a fixed one; the usual layouts of dates without a formatter."""
    if layout not in ("yyyy-M-d", "yyyy-M-d H:mm:ss"):
        return F.coalesce(parsed(c, layout), fixed)
    return F.coalesce(iso_seconds(F.trim(c)), parsed(c, layout), fixed)


def _shape(layout: str) -> str:
    """Regular expression of the texts of a layout."""
    known = {"yyyyMMdd": r"\d{8}", "yyyy": r"\d{4}", "yy": r"\d{2}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "M": r"\d{1,2}", "d": r"\d{1,2}",
             "H": r"\d{1,2}", "h": r"\d{1,2}", "mm": r"\d{2}", "ss": r"\d{2}", "SSSSSS": r"\d{1,6}", "a": "[AaPp][Mm]",
             "XXX": r"(?:Z|[+-]\d{2}:\d{2})", "XX": r"(?:Z|[+-]\d{4})", "'T'": "T"}
    out = re.sub("|".join(sorted(known, key=len, reverse=True)) + "|.", lambda m: known.get(m[0], re.escape(m[0])), layout)
    return f"^{out}$"


def coerce_datetimes(df: DataFrame, columns: Iterable[str], order: str = SEQ, layouts: dict[str, str | None] | None = None,
                     iso_too: bool = False) -> DataFrame:
    """The listed columns that exist as TIMESTAMP_NTZ, text ones by their column's layout.

    ``iso_too``: a value that is not in its column's layout is still read if it
    is in one of the fixed ISO layouts, instead of becoming NULL.
    """
    layouts = infer_layouts(df, columns, order) if layouts is None else layouts
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in set(columns):
            fixed = datetime_expr(c, f.dataType)
            layout = layouts.get(f.name)
            if layout is None:
                c = fixed
            else:
                c = _by_layout(c, layout, fixed) if iso_too else parsed(c, layout)
        out.append(c.alias(f.name))
    return df.select(*out)
