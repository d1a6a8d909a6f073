"""Rows of a frame in an order that tests can compare."""


def rows(df, *cols):
    """Sorted list of tuples of the named columns."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
