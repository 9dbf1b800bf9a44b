"""Small helpers of the tests."""

import datetime as dt


def d(text):
    """A date from ISO text; None stays None."""
    return dt.date.fromisoformat(text) if text else None


def rows(df, *columns):
    """Rows as sorted tuples, nulls last."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
