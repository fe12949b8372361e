"""Which columns can be ordered and hashed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def comparable(df: DataFrame) -> list[str]:
    """All columns but those holding maps or variants, which Spark neither orders nor hashes."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [name for name, kind in kinds.items() if "map<" not in kind and "variant" not in kind]
