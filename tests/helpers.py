"""Comparing rows."""


def rows(df, *columns):
    """Rows of df as a set of tuples, or of the given columns."""
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


def value(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if v != v else f"{v + 0.0:.8g}"
    return str(v)


def table(records, columns, order):
    """Records as sorted tuples of text, columns in the given order."""
    at = [columns.index(c) for c in order]
    return sorted(tuple(value(r[i]) for i in at) for r in records)
