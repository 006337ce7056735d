"""What tests compare frames by."""


def rows_of(df, *columns):
    """Rows as sorted tuples, NULLs first, floats rounded."""

    def clean(v):
        return round(float(v), 6) if isinstance(v, float) else v

    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    rows = [tuple(clean(v) for v in r) for r in picked.collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])
