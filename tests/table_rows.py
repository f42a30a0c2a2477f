"""Results as plain rows."""


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((value is None, str(value)) for value in row))
