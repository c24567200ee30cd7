"""Small things shared by the tests."""


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
