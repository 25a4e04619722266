"""What several tests use."""

SF_DIR = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, in a stable order."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
