"""Helpers of the tests. A module with a name of its own: every test folder may have a ``conftest``."""


def rows(df):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
