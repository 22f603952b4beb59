"""How tests read a frame."""


def values(df, *columns):
    """Rows as tuples, sorted, NULLs first."""
    rows = [tuple(r) for r in df.select(*columns).collect()] if columns else [
        tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: [(x is not None, str(x)) for x in r])
