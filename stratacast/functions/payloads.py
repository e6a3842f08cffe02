"""Rows out of JSON documents that hold parallel arrays."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_parallel(
    df: DataFrame,
    doc: str,
    root: str,
    fields: Mapping[str, tuple[str, str]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per array position of the arrays under ``root``.

    ``fields`` maps each output column to (JSON field, element type). Arrays
    are lined up by position, short ones are padded with null, and a missing
    one is null throughout; a document without any of them yields no row.

    Documents that match the declared types are parsed once by from_json.
    Those it rejects (numbers written as text, say) go through a variant
    instead, which converts what can be converted and raises on the rest.
    """
    kept = [f"`{c}`" for c in (keep if keep is not None else df.columns) if c != doc]
    members = ", ".join(f"`{field}`: array<{kind}>" for field, kind in fields.values())
    typed = f"`{root}` struct<{members}>, _rejected string"
    accepted = "(_typed IS NOT NULL AND _typed._rejected IS NULL)"
    arrays = [
        f"""CASE WHEN {accepted} THEN _typed.`{root}`.`{field}`
        ELSE variant_get(_variant, '$.{root}.{field}', 'array<{kind}>') END AS `{name}`"""
        for name, (field, kind) in fields.items()
    ]
    # arrays_zip is null if any input is null, so a missing array must be empty.
    padded = [F.coalesce(name, F.array()).alias(name) for name in fields]
    options = {"columnNameOfCorruptRecord": "_rejected"}
    return (
        df.select(*kept, F.col(doc).alias("_doc"), F.from_json(doc, typed, options).alias("_typed"))
        .selectExpr(
            *kept, "_typed", f"CASE WHEN NOT {accepted} THEN parse_json(_doc) END AS _variant"
        )
        .selectExpr(*kept, *arrays)
        .select(*kept, F.inline(F.arrays_zip(*padded)))
    )
