"""What several test files compare with."""


def rows(df):
    """Rows as sorted tuples, NULLs included."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
