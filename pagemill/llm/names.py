"""Names of helper columns beside the columns of a caller."""

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of ``df`` has it; upper and
    lower case do not tell names apart."""
    taken = {c.lower() for c in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free
