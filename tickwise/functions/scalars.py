"""Scalar column functions (SCL-01 … SCL-08), all built-in expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickwise.functions.exprs import rounded

# Fixed value: the reference's default ticker for a missing symbol.
DEFAULT_TICKER = "AAPL"
# Size units in order, step 1024; beyond TB the text is "PB".
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]


def short_token(name: Column) -> Column:
    """SCL-02: initials of the parts split on ``[_\\s-]+``, upper-cased, at
    most 6 characters; no parts → the first 6 characters of the name."""
    parts = F.filter(F.split(name, r"[_\s\-]+"), lambda p: p != "")
    tok = F.upper(F.array_join(F.transform(parts, lambda p: F.substring(p, 1, 1)), ""))
    return F.when(F.size(parts) > 0, F.substring(tok, 1, 6)).otherwise(F.substring(name, 1, 6))


def humanize_seconds(seconds: Column) -> Column:
    """SCL-03: ``1d 2h 3m 4s``; zero day/hour/minute parts are skipped, the
    seconds part is always present.  Fractions are truncated."""
    s = seconds.cast("double").cast("long")
    d, h, m, sec = F.floor(s / 86400), F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60
    return F.concat_ws(" ", F.when(d > 0, F.concat(d.cast("string"), F.lit("d"))),
                       F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))),
                       F.when(m > 0, F.concat(m.cast("string"), F.lit("m"))),
                       F.concat(sec.cast("string"), F.lit("s")))


def _round1_half_even(x: Column) -> Column:
    """One decimal, ties to even — equals Python's ``:.1f`` on values that
    are exact binary fractions (sizes divided by powers of 1024 are)."""
    y = x * 10.0
    r = F.floor(y)
    frac = y - r
    up = (frac > 0.5) | ((frac == 0.5) & (r % 2 == 1))
    return (r + F.when(up, 1).otherwise(0)) / 10.0


def human_size(n: Column) -> Column:
    """SCL-04: bytes → ``512.0 B`` / ``1.5 KB`` … ``TB``, then ``1.0PB``."""
    v = n.cast("double")
    out = None
    for i, unit in enumerate(SIZE_UNITS):
        scaled = v / float(1024 ** i)
        txt = F.concat(F.format_string("%.1f", _round1_half_even(scaled)), F.lit(" " + unit))
        cond = scaled < 1024.0
        out = F.when(cond, txt) if out is None else out.when(cond, txt)
    pb = F.concat(F.format_string("%.1f", _round1_half_even(v / float(1024 ** 5))), F.lit("PB"))
    return out.otherwise(pb)


def safe_ticker(t: Column, default: str = DEFAULT_TICKER) -> Column:
    """SCL-05: NULL or empty → default, upper-cased."""
    return F.upper(F.coalesce(F.nullif(t, F.lit("")), F.lit(default)))


WINDOW_PATTERNS = [r"^lag_close_(\d+)$", r"^lag_return_(\d+)$", r"^sma_(\d+)$", r"^ema_(\d+)$"]


def feature_window(name: Column) -> Column:
    """SCL-06: history a feature needs (``lag_close_k``, ``lag_return_k``,
    ``sma_w``, ``ema_w``); other names need 1."""
    vals = [F.regexp_extract(name, p, 1) for p in WINDOW_PATTERNS]
    got = F.coalesce(*[F.when(v != "", v.cast("int")) for v in vals])
    return F.coalesce(got, F.lit(1))


def fixed(x: Column, digits: int = 3) -> Column:
    """SCL-07: fixed-decimal text of a value rounded half up at ``digits``."""
    return F.format_string(f"%.{digits}f", rounded(x, digits))


def percent(x: Column, digits: int = 1) -> Column:
    """SCL-07: ×100 and rounded."""
    return rounded(x * 100.0, digits)


def json_first(js: Column, *paths: str) -> Column:
    """SCL-08: the first present key of a JSON document (``auc_val`` else
    ``auc``)."""
    return F.coalesce(*[F.get_json_object(js, p) for p in paths])
