"""One SQL text for two engines: Spark runs the query, DuckDB runs its check.

Where the engines differ a text uses a macro, @name(arguments), which is written out for each of them. Tables of the
registry projection (see projection.py) are prepended as common table expressions when a text names them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.plans.projection import BASE_TABLES, RELATIONS
from ledgerlight.session import ready_checkpoints, table

MACROS: dict[str, tuple[str, str]] = {
    # name: (Spark, DuckDB); {0}, {1}, ... are the arguments
    "days": ("datediff({1}, {0})", "date_diff('day', {0}, {1})"),
    "seconds": ("CAST(unix_timestamp(CAST({1} AS TIMESTAMP)) - unix_timestamp(CAST({0} AS TIMESTAMP)) AS BIGINT)", "CAST(epoch(date_trunc('second', {1})) - epoch(date_trunc('second', {0})) AS BIGINT)"),
    "plus_days": ("date_add({0}, CAST({1} AS INT))", "CAST({0} + CAST({1} AS INTEGER) AS DATE)"),
    "replace_all": ("regexp_replace({0}, r{1}, {2})", "regexp_replace({0}, {1}, {2}, 'g')"),
    "extract": ("regexp_extract({0}, r{1}, {2})", "regexp_extract({0}, {1}, {2})"),
    "matches": ("({0} RLIKE r{1})", "regexp_matches({0}, {1})"),
    "found": ("regexp_extract_all({0}, r{1}, 0)", "regexp_extract_all({0}, {1})"),
    "set": ("array_join(sort_array(collect_set({0})), {1})", "coalesce(array_to_string(list_sort(list(DISTINCT {0}) FILTER (WHERE {0} IS NOT NULL)), {1}), '')"),
    "all": ("array_join(sort_array(collect_list({0})), {1})", "coalesce(array_to_string(list_sort(list({0}) FILTER (WHERE {0} IS NOT NULL)), {1}), '')"),
    "array_text": ("array_join({0}, {1})", "array_to_string({0}, {1})"),
    "sorted": ("sort_array({0})", "list_sort({0})"),
    "distinct": ("array_distinct({0})", "list_distinct({0})"),
    "size": ("CAST(size({0}) AS BIGINT)", "CAST(len({0}) AS BIGINT)"),
    "at": ("element_at({0}, {1})", "{0}[{1}]"),
    "json": ("get_json_object({0}, '$.{1}')", "json_extract_string({0}, '$.{1}')"),
    "starts": ("startswith({0}, {1})", "starts_with({0}, {1})"),
    "explode": ("explode({0})", "unnest({0})"),
    "split": ("split({0}, {1})", "string_split({0}, {1})"),
    "range": ("sequence({0}, {1})", "range({0}, {1} + 1)"),
    "first_by": ("min_by({0}, {1})", "arg_min({0}, {1})"),
    "last_by": ("max_by({0}, {1})", "arg_max({0}, {1})"),
    "overlap": ("arrays_overlap({0}, {1})", "list_has_any({0}, {1})"),
    "has": ("array_contains({0}, {1})", "list_contains({0}, {1})"),
    "without": ("array_remove({0}, {1})", "list_filter({0}, lambda x: x <> {1})"),
    "array": ("array({*})", "[{*}]"),
    "month": ("date_format({0}, 'yyyy-MM')", "strftime({0}, '%Y-%m')"),
    "week": ("concat(extract(YEAROFWEEK FROM {0}), '-W', lpad(CAST(weekofyear({0}) AS STRING), 2, '0'))", "strftime({0}, '%G-W%V')"),
    "day": ("CAST({0} AS DATE)", "CAST({0} AS DATE)"),
    "date": ("try_cast({0} AS DATE)", "try_cast({0} AS DATE)"),
    "reverse": ("reverse({0})", "reverse({0})"),
    "sha256": ("sha2(CAST({0} AS BINARY), 256)", "sha256({0})"),
    "hash48": ("CAST(conv(substr(md5(CAST({0} AS BINARY)), 1, 12), 16, 10) AS BIGINT)", "CAST('0x' || substr(md5({0}), 1, 12) AS BIGINT)"),
    "md5": ("md5(CAST({0} AS BINARY))", "md5({0})"),
    # {0} = {1} of a left join where {1} is mostly null: by the row's own id {2} such rows go to all tasks, and match nothing
    "sparse_key": ("{0} = coalesce({1}, -1 - {2}) AND {1} IS NOT NULL", "{0} = {1}"),
}


def _arguments(text: str, at: int) -> tuple[list[str], int]:
    """Arguments from the bracket at `at`, and where the bracket closes."""
    depth, begin, out, quote = 0, at + 1, [], False
    for i in range(at, len(text)):
        c = text[i]
        if c == "'":
            quote = not quote
        if quote:
            continue
        if c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
            if depth == 0:
                out.append(text[begin:i].strip())
                return out, i
        elif c == "," and depth == 1:
            out.append(text[begin:i].strip())
            begin = i + 1
    raise ValueError(f"no closing bracket in {text[at : at + 60]!r}")


def write_out(text: str, engine: int) -> str:
    """The text for Spark (0) or DuckDB (1); inner macros first."""
    while m := list(re.finditer(r"@(\w+)\(", text)):
        last = m[-1]
        args, end = _arguments(text, last.end() - 1)
        form = MACROS[last[1]][engine].replace("{*}", ", ".join(args))
        for i, a in enumerate(args):
            form = form.replace(f"{{{i}}}", a)
        text = text[: last.start()] + form + text[end + 1 :]
    return text


def with_relations(text: str, kept: dict[str, str] | None = None) -> str:
    """The text with the relations of the projection that it needs in front; kept: views that hold some of them already."""
    needed: list[str] = []
    relations = RELATIONS | {name: f"SELECT * FROM {view}" for name, view in (kept or {}).items()}

    def need(part: str) -> None:
        for name in relations:
            if name not in needed and re.search(rf"\b{name}\b", part) and not re.search(rf"\b{name} AS \(", text):
                need(relations[name])
                if name not in needed:
                    needed.append(name)

    need(text)
    if not needed:
        return text
    heads = ",\n".join(f"{n} AS ({relations[n].strip()})" for n in needed)
    body = text.strip()
    if m := re.match(r"WITH( RECURSIVE)?\s+", body):
        return f"WITH{m[1] or ''} {heads},\n{body[m.end() :]}"
    return f"WITH {heads}\n{body}"


def spark_sql(text: str) -> str:
    return write_out(with_relations(text), 0)


def duck_sql(text: str) -> str:
    return write_out(with_relations(text), 1)


#: Views of relations that keep_relations() has written, by session and data folder.
_KEPT: dict[tuple[str, str], dict[str, str]] = {}


def keep_relations(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("expiry", "history")) -> dict[str, int]:
    """Write relations of a data folder once, for all queries of this session that follow; the number of rows of each.

    They are Parquet in the shared checkpoint folder, so that queries read the columns and rows that they need. What is
    kept stands for the folder as it was: call it again, or drop_relations(), when the tables have changed.
    """
    ready_checkpoints(spark)
    drop_relations(spark, sf_dir)
    kept, rows = {}, {}
    for name in names:
        token = uuid.uuid4().hex
        folder = f"{spark.sparkContext.getCheckpointDir()}/relations-{token}"
        _run(spark, sf_dir, write_out(with_relations(f"SELECT * FROM {name}", kept), 0)).write.parquet(folder)
        held = spark.read.parquet(folder)
        held.createOrReplaceTempView(f"kept_{token}")
        kept[name], rows[name] = f"kept_{token}", held.count()
    _KEPT[spark.sparkContext.applicationId, sf_dir] = kept
    return rows


def drop_relations(spark: SparkSession, sf_dir: str) -> None:
    """Forget what keep_relations() has written for a data folder."""
    for view in _KEPT.pop((spark.sparkContext.applicationId, sf_dir), {}).values():
        spark.catalog.dropTempView(view)


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The text's result over the tables of the folder."""
    return _run(spark, sf_dir, write_out(with_relations(text, _KEPT.get((spark.sparkContext.applicationId, sf_dir))), 0))


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for name in BASE_TABLES:
        if re.search(rf"\b{name}\b", text):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


def query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(spark, sf_dir, text)
