"""Helpers the tests share."""


def values(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
