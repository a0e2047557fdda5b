from tickwise.functions.exprs import finite, safe_div, rounded, present  # noqa: F401
