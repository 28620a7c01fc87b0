"""The library's functions for SQL text: temporary functions of a session that Catalyst inlines, and a table function that expands records.

After `register(spark)` any SQL of the session can call fold_code(ref), register_key(ref), normalise_ref(ref, strategy),
bare_key(ref), trigrams(text), similarity(a, b), and `LATERAL expand_records(body)`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ledgerlight.functions.references import DOTTED, SPACED, VARIANT


def _code(pattern: str, figure: int, shank: int) -> str:
    part = lambda n: f"regexp_extract(trim(ref), r'{pattern}', {n})"
    return f"concat_ws('.', upper({part(figure)}), {part(shank)}, lpad({part(3)}, 3, '0'))"


#: name: (parameters, type of the result, expression)
SCALARS = {
    "fold_code": ("ref STRING", "STRING", f"CASE WHEN trim(ref) RLIKE r'{SPACED}' THEN {_code(SPACED, 2, 1)} WHEN trim(ref) RLIKE r'{DOTTED}' THEN {_code(DOTTED, 1, 2)} ELSE ref END"),
    "register_key": ("ref STRING", "STRING", f"fold_code(regexp_replace(ref, r'{VARIANT}', ''))"),
    "normalise_ref": (
        "ref STRING, strategy STRING", "STRING",
        r"CASE WHEN strategy = 'strip-trailing-letters' AND ref RLIKE r'^[0-9]+[A-Za-z]{1,3}\z' THEN regexp_extract(ref, '^([0-9]+)', 1) WHEN strategy = 'reorder-shank-figure-size' THEN fold_code(ref) ELSE ref END",
    ),
    "bare_key": ("ref STRING", "STRING", "upper(regexp_replace(coalesce(ref, ''), '[^0-9A-Za-z]', ''))"),
    "trigrams": (
        "t STRING", "ARRAY<STRING>",
        r"array_distinct(flatten(transform(filter(split(lower(t), r'[^\p{L}\p{N}]+'), w -> w <> ''), w -> transform(sequence(1, length(w) + 1), i -> substring(concat('  ', w, ' '), i, 3)))))",
    ),
    "similarity": ("a STRING, b STRING", "DOUBLE", "size(array_intersect(trigrams(a), trigrams(b))) / nullif(size(array_union(trigrams(a), trigrams(b))), 0)"),
}


class ExpandRecords:
    """(pos, record, key, value) of a JSON body: its list, or the list under `value` or `content`; values that aren't text as JSON. What is no such list has no rows."""

    def eval(self, body: str) -> Iterator[tuple[int, str, str | None, str | None]]:
        try:
            found = json.loads(body) if body else None
        except ValueError:
            return
        if isinstance(found, dict):
            found = found.get("value") or found.get("content")
        for pos, record in enumerate(found if isinstance(found, list) else ()):
            text = json.dumps(record, ensure_ascii=False)
            if not isinstance(record, dict):
                yield pos, text, None, None
                continue
            for key, value in record.items():
                yield pos, text, key, value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session's SQL; their names."""
    for name, (parameters, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("expand_records", udtf(ExpandRecords, returnType="pos int, record string, key string, value string"))
    return [*SCALARS, "expand_records"]
