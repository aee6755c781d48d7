"""Column naming."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame


def plain_name(name: str) -> str:
    """Lower-case ASCII name with spaces and hyphens as underscores."""
    decomposed = unicodedata.normalize("NFKD", name)
    letters = "".join(char for char in decomposed if char.isascii())
    return re.sub("[ -]", "_", letters.strip().lower())


def normalise_names(df: DataFrame) -> DataFrame:
    names = [plain_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalisation: {clashes}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, renames: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename the columns that exist; refuse a rename onto another column."""
    wanted = {old: new for old, new in renames if old in df.columns and old != new}
    result = [wanted.get(name, name) for name in df.columns]
    clashes = sorted({name for name in result if result.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.withColumnsRenamed(wanted)
