"""The rules over responses, on rows that every order makes: each of the literal queries' values comes with all others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.plans import literal_queries as cases
from siltstone.sources.files import load

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _sql_list(values: list) -> str:
    show = lambda x: "null" if x is None else "'" + x + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)
    return "[" + ", ".join(map(show, values)) + "]"


def _columns(rows: list[tuple]) -> list[list]:
    return [list(dict.fromkeys(c)) for c in zip(*rows, strict=True)]


def over_orders(name: str, of: str, columns: str, rows: list[tuple], schema: str, made) -> None:
    """Registers the query of that name over rows whose k-th column runs through its values as the order's key, divided by the number of those before, does."""
    values, names, kinds = _columns(rows), columns.split(", "), [x.split()[1] for x in schema.split(", ")]
    sql, spark_columns, step = [], [], 1
    for column, kind, every in zip(names, kinds, values, strict=True):
        sql.append(f"{_sql_list(every)}[o_orderkey // {step} % {len(every)} + 1] as {column}")
        spark_columns.append((column, every, kind, step))
        step *= len(every)

    def run(spark, d) -> DataFrame:
        at = lambda step, n: (F.floor(F.col("o_orderkey") / step) % n + 1).cast("int")
        rows = load(spark, d, "orders").select(*[F.element_at(F.array(*[F.lit(x).cast(k) for x in every]), at(step, len(every))).alias(c) for c, every, k, step in spark_columns])
        return made(rows)

    QUERIES[name] = run
    ORACLE_SQL[name] = cases.ORACLE_SQL[of].replace(cases._values("t", columns, rows), f"t as (select {', '.join(sql)} from orders)")


over_orders("orders_page_counts", "page_count_boundaries", "href, total", cases.COUNTS, "href string, total long", cases.paged)
over_orders("orders_ranges", "content_range", "r, o", cases.RANGES, "r string, o long", cases.ranged)
over_orders("orders_lengths", "content_length", "n, e", cases.LENGTHS, "n string, e string", cases.lengths)
over_orders("orders_fetches", "fetch_class", "status, wait, challenge", cases.FETCHES, "status int, wait string, challenge boolean", cases.fetched)
over_orders("orders_probes", "probe_class", "method, status, type, n, r, wait", cases.PROBES, "method string, status int, type string, n string, r string, wait string", cases.probed)
over_orders("orders_media", "media_class", "status, type, wait, sample", cases.MEDIA, "status int, type string, wait string, sample string", cases.classified)
