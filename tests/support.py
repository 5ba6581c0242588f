"""What several test modules share."""


def rows(df):
    """Rows as sorted tuples, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
