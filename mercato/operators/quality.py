"""Data-quality gates.

Every check family returns rows ``(check, table, detail, count, severity)``; the report
(V13) unions them, drops zero counts and derives one ``passed`` verdict, and the gate
(V14) raises when a blocking row remains.  Checks on one table are fused into a single
aggregate; all key checks of a layer come from one pass a key that counts it in every table
that has it, combined before the one shuffle, so a hot key never reaches a single task as raw rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import CANCELED, line_revenue
from ..sources.schemas import CAST_PLAN, MONEY, STAGING_TABLES, TS
from .star import Star

BLOCKING = "blocking"
LOGGED = "logged"
RESULT_COLUMNS = ["check", "table", "detail", "count", "severity"]
_RESULT_SCHEMA = "check string, table string, detail string, count long, severity string"

# Key columns per staging table (documented grain).
PRIMARY_KEYS: list[tuple[str, list[str]]] = [
    ("orders", ["order_id"]),
    ("order_items", ["order_id", "order_item_id"]),
    ("customers", ["customer_id"]),
    ("products", ["product_id"]),
    ("sellers", ["seller_id"]),
]

# Fixed values: (child table, child column, parent table, parent column) in staging.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
]

# The same relations in the star.
OUTPUT_FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("order_payments", "order_id", "fact_orders", "order_id"),
    ("order_reviews", "order_id", "fact_orders", "order_id"),
]

# Fixed values: (table, column, null-rate threshold in basis points) - a rate strictly
# above the threshold is logged.
NULL_POLICY: list[tuple[str, str, int]] = [
    ("orders", "order_approved_at", 5),
    ("orders", "order_delivered_customer_date", 100),
    ("order_reviews", "review_comment_title", 5000),
    ("order_reviews", "review_comment_message", 5000),
]

# Star table -> how its staging row count is taken (None = all rows,
# otherwise the column whose distinct values it must equal).
ROW_RECONCILIATION: list[tuple[str, str, str | None]] = [
    ("dim_customers", "customers", None),
    ("dim_products", "products", None),
    ("dim_sellers", "sellers", None),
    ("fact_orders", "orders", None),
    ("fact_order_items", "order_items", None),
    ("order_payments", "order_payments", None),
    ("order_reviews", "order_reviews", "order_id"),
    ("geolocation", "geolocation", "geolocation_zip_code_prefix"),
]


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rows(agg: DataFrame, specs: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Turn one aggregated row into check rows: specs are (check, table, detail, count
    as a SQL expression over the aggregate's columns, severity).  One ``stack``
    expression, so building a report stays cheap however many checks it holds."""
    args = ", ".join(f"{_sql_str(c)}, {_sql_str(t)}, {_sql_str(d)}, CAST({cnt} AS BIGINT), {_sql_str(sv)}"
                     for c, t, d, cnt, sv in specs)
    return agg.selectExpr(f"stack({len(specs)}, {args}) AS (`check`, `table`, detail, `count`, severity)")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _ts(col: str) -> Column:
    return F.col(col).try_cast(TS)


# ---------------------------------------------------------------- input layer


def _domain_exprs(table: str) -> dict[str, str]:
    out = {}
    if table == "order_reviews":
        out["dom_score"] = "count_if(NOT (try_cast(review_score AS INT) BETWEEN 1 AND 5))"
    if table == "order_items":
        out["dom_price"] = f"count_if(try_cast(price AS {MONEY}) < 0)"
        out["dom_freight"] = f"count_if(try_cast(freight_value AS {MONEY}) < 0)"
    if table == "order_payments":
        out["dom_value"] = f"count_if(try_cast(payment_value AS {MONEY}) < 0)"
    return out


def _temporal_exprs(table: str) -> dict[str, str]:
    if table != "orders":
        return {}
    ts = "try_cast({} AS " + TS + ")"
    return {
        "tmp_a": f"count_if({ts.format('order_delivered_carrier_date')} < {ts.format('order_approved_at')})",
        "tmp_b": f"count_if({ts.format('order_delivered_customer_date')} < "
                 f"{ts.format('order_delivered_carrier_date')})",
        "tmp_c": f"count_if(order_status = '{CANCELED}' AND order_delivered_customer_date IS NOT NULL)",
    }


def table_profiles(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One single-row aggregate per staging table holding every scalar check of that
    table (row count, domain, temporal, null and cast counts), written as one SQL
    aggregate list so building it is a single call."""
    profiles = {}
    for t in STAGING_TABLES:
        exprs = {"n": "count(1)"}
        exprs.update(_domain_exprs(t))
        exprs.update(_temporal_exprs(t))
        for table, c, _ in NULL_POLICY:
            if table == t:
                exprs[f"null_{c}"] = f"count_if({c} IS NULL)"
        for table, c, typ in CAST_PLAN:
            if table == t:
                exprs[f"cast_{c}"] = f"count_if({c} IS NOT NULL AND try_cast({c} AS {typ}) IS NULL)"
        profiles[t] = stg[t].selectExpr(*[f"{e} AS {k}" for k, e in exprs.items()])
    return profiles


def _scalar_specs(table: str) -> list[tuple[str, str, str, Column, str]]:
    """Every scalar check of a table as a (check, table, detail, count, severity) spec
    over the columns of its profile."""
    specs = [("row_count", table, f"no row staged for {table}", "CASE WHEN n > 0 THEN 0 ELSE 1 END", BLOCKING)]
    domain = {"dom_score": "score outside 1 to 5",
              "dom_price": "negative price", "dom_freight": "negative freight",
              "dom_value": "negative payment"}
    for col in _domain_exprs(table):
        specs.append(("domain", table, domain[col], col, BLOCKING))
    temporal = {"tmp_a": "handed to the carrier before approval",
                "tmp_b": "with the customer before the carrier",
                "tmp_c": "canceled, yet handed to the customer"}
    for col in _temporal_exprs(table):
        specs.append(("temporal_sanity", table, temporal[col], col, LOGGED))
    for t, c, bp in NULL_POLICY:
        if t == table:
            specs.append(("null_policy", table, f"{c}: more than {bp} in 10000 missing",
                          f"CASE WHEN null_{c} * 10000 > n * {bp} THEN null_{c} ELSE 0 END", LOGGED))
    for t, c, typ in CAST_PLAN:
        if t == table:
            specs.append(("malformed_cast", table, f"{c}: text that {typ} cannot hold",
                          f"cast_{c}", BLOCKING))
    return specs


def scalar_checks(stg: dict[str, DataFrame]) -> DataFrame:
    """All scalar check rows: each table is scanned once and all its rows come out of a
    single projection of its profile (so column pruning cannot split the aggregate)."""
    profiles = table_profiles(stg)
    return _union([_rows(profiles[t], _scalar_specs(t)) for t in STAGING_TABLES])


def _family(stg: dict[str, DataFrame], check: str) -> DataFrame:
    """One check family alone: only the tables it covers, and column pruning keeps only
    the aggregates it reads."""
    profiles = table_profiles(stg)
    frames = []
    for t in STAGING_TABLES:
        specs = [sp for sp in _scalar_specs(t) if sp[0] == check]
        if specs:
            frames.append(_rows(profiles[t], specs))
    return _union(frames)


def dq_row_counts(stg: dict[str, DataFrame]) -> DataFrame:
    """Each staging table holds at least one row."""
    return _family(stg, "row_count")


# A use of a key: (table, its columns, name of the key, role).  Role 0 is the table the key
# belongs to, roles 1.. are tables that refer to it.
KeyUse = tuple[str, tuple[str, ...], str, int]


def key_counts(tables: Mapping[str, DataFrame], uses: list[KeyUse]) -> DataFrame:
    """(k0 .., c0 ..): how many rows of each role have a key, for the uses of one key.

    One shuffle for all tables that have the key: their tagged keys are one union, and one
    aggregate, combined before the shuffle, counts them; a hot key is one row a task.
    """
    tagged = _union([tables[t].selectExpr(*[f"{c} AS k{i}" for i, c in enumerate(cols)], f"{role} AS role")
                     for t, cols, _, role in uses])
    keys = [c for c in tagged.columns if c != "role"]
    return tagged.groupBy(*keys).agg(*[F.expr(f"count_if(role = {r})").alias(f"c{r}") for r in sorted({u[3] for u in uses})])


def _planned(tables: Mapping[str, DataFrame], *plans) -> DataFrame:
    """The check rows of several plans, one keyed pass for each key; a use that plans share is
    counted once.  A plan is (uses, specs); a spec's count is an aggregate over its key's counts."""
    uses = list(dict.fromkeys(u for plan in plans for u in plan[0]))
    frames = []
    for name in dict.fromkeys(u[2] for u in uses):
        specs = [sp for plan in plans for key, sp in plan[1] if key == name]
        counts = key_counts(tables, [u for u in uses if u[2] == name])
        measured = counts.selectExpr(*[f"coalesce({sp[3]}, 0) AS m{i}" for i, sp in enumerate(specs)])
        frames.append(_rows(measured, [(c, t, d, f"m{i}", sv) for i, (c, t, d, _, sv) in enumerate(specs)]))
    return _union(frames)


def _owned(relations) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """(parent, column) -> the (child, column) pairs that refer to it, in the relations' order."""
    owned: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, ccol, parent, pcol in relations:
        owned.setdefault((parent, pcol), []).append((child, ccol))
    return owned


def _relation_plan(relations, check: str = "referential_integrity"):
    """Orphans: rows of a role whose key no row of role 0 has (a NULL key has no owner)."""
    uses: list[KeyUse] = []
    specs = []
    for (parent, pcol), children in _owned(relations).items():
        name = f"{parent}.{pcol}"
        uses.append((parent, (pcol,), name, 0))
        for role, (child, ccol) in enumerate(children, 1):
            uses.append((child, (ccol,), name, role))
            specs.append((name, (check, child, f"{ccol} without a row in {parent}",
                                 f"sum(CASE WHEN c0 = 0 OR k0 IS NULL THEN c{role} END)", BLOCKING)))
    return uses, specs


def _pk_plan():
    """Keys that several rows of role 0 have."""
    uses, specs = [], []
    for t, cols in PRIMARY_KEYS:
        name = f"{t}.{'+'.join(cols)}"
        uses.append((t, tuple(cols), name, 0))
        specs.append((name, ("pk_uniqueness", t, f"key ({', '.join(cols)}) used by several staged rows", "count_if(c0 > 1)", BLOCKING)))
    return uses, specs


def _review_plan():
    """Review ids that repeat, and orders with several reviews (role of order_reviews among the
    tables that refer to an order)."""
    role = 1 + _owned(FOREIGN_KEYS)["orders", "order_id"].index(("order_reviews", "order_id"))
    return ([("order_reviews", ("review_id",), "order_reviews.review_id", 0), ("order_reviews", ("order_id",), "orders.order_id", role)],
            [("order_reviews.review_id", ("review_duplicates", "order_reviews", "review ids used by several rows", "count_if(c0 > 1)", LOGGED)),
             ("orders.order_id", ("review_duplicates", "order_reviews", "orders reviewed several times", f"count_if(c{role} > 1)", LOGGED))])


def dq_pk_duplicates(stg: Mapping[str, DataFrame]) -> DataFrame:
    """Duplicated key groups per table."""
    return _planned(stg, _pk_plan())


def dq_orphan_fk(stg: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan child rows for the six staging relations (NULL keys count as orphans)."""
    return _planned(stg, _relation_plan(FOREIGN_KEYS))


def dq_domain(stg: dict[str, DataFrame]) -> DataFrame:
    """Score outside 1..5, negative money; NULLs do not count."""
    return _family(stg, "domain")


def dq_temporal(stg: dict[str, DataFrame]) -> DataFrame:
    """The three impossible orderings, logged."""
    return _family(stg, "temporal_sanity")


def dq_null_policy(stg: dict[str, DataFrame]) -> DataFrame:
    """Null count of each policed column when its rate is strictly above the
    threshold (compared exactly in integers; an empty table has rate 0)."""
    return _family(stg, "null_policy")


def dq_review_duplicates(stg: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated review ids; orders reviewed several times (both logged)."""
    return _planned(stg, _review_plan())


def dq_malformed_cast(stg: dict[str, DataFrame]) -> DataFrame:
    """Values present in staging that the star's casts cannot read (blocking)."""
    return _family(stg, "malformed_cast")


def keyed_input_checks(stg: Mapping[str, DataFrame]) -> DataFrame:
    """V02, V03 and V07 from one keyed pass for each key."""
    return _planned(stg, _pk_plan(), _relation_plan(FOREIGN_KEYS), _review_plan())


def input_checks(stg: Mapping[str, DataFrame]) -> DataFrame:
    """All input-layer checks."""
    return scalar_checks(stg).unionByName(keyed_input_checks(stg))


INPUT_FAMILIES = {
    "row_count": dq_row_counts, "pk_uniqueness": dq_pk_duplicates, "referential_integrity": dq_orphan_fk,
    "domain": dq_domain, "temporal_sanity": dq_temporal, "null_policy": dq_null_policy,
    "review_duplicates": dq_review_duplicates, "malformed_cast": dq_malformed_cast,
}


# ---------------------------------------------------------------- output layer


def dq_row_reconciliation(star: Star, stg: Mapping[str, DataFrame]) -> DataFrame:
    """Star row counts equal staging counts (distinct keys for deduplicated tables); one
    union of counts, which written tables answer from their files' footers."""
    counts, specs = [], []
    for i, (name, src, distinct_col) in enumerate(ROW_RECONCILIATION):
        staged = "count(1)" if distinct_col is None else f"count(DISTINCT {distinct_col})"
        counts += [star.tables()[name].selectExpr(f"{2 * i} AS i", "count(1) AS n"), stg[src].selectExpr(f"{2 * i + 1} AS i", f"{staged} AS n")]
        specs.append(("row_reconciliation", name, f"rows of {name} and of its staged source differ in number",
                      f"CASE WHEN n{2 * i} = n{2 * i + 1} THEN 0 ELSE 1 END", BLOCKING))
    every = _union(counts).selectExpr(*[f"max(CASE WHEN i = {i} THEN n END) AS n{i}" for i in range(len(counts))])
    return _rows(every, specs)


def dq_output_orphan_fk(star: Star) -> DataFrame:
    """Orphan rows in the star's six relations."""
    return _planned(star.tables(), _relation_plan(OUTPUT_FOREIGN_KEYS))


def dq_revenue_tieout(star: Star, stg: dict[str, DataFrame]) -> DataFrame:
    """Total item revenue (2dp) equal in star and staging; empty equals empty."""
    a = star.fact_order_items.agg(F.round(F.sum(line_revenue()), 2).alias("a"))
    b = stg["order_items"].agg(
        F.round(F.sum(F.col("price").try_cast(MONEY) + F.col("freight_value").try_cast(MONEY)), 2)
        .alias("b"))
    return _rows(a.crossJoin(b), [("revenue_tie_out", "fact_order_items",
                                   "item revenue of the star is not that of staging",
                                   "CASE WHEN a <=> b THEN 0 ELSE 1 END",
                                   BLOCKING)])


def items_payments_mismatch_count(star: Star, tolerance: float = 0.01) -> DataFrame:
    from .analysis import items_vs_payments
    return items_vs_payments(star, tolerance).agg(F.count(F.lit(1)).alias("n"))


def dq_items_vs_payments(star: Star) -> DataFrame:
    """Orders whose item and payment totals differ by more than 0.01 (logged)."""
    return _rows(items_payments_mismatch_count(star),
                 [("revenue_tie_out", "fact_order_items",
                   "orders paid more or less than their items cost, by over one cent",
                   "n", LOGGED)])


def output_checks(star: Star, stg: Mapping[str, DataFrame]) -> DataFrame:
    """All output-layer checks."""
    return _union([dq_row_reconciliation(star, stg), dq_output_orphan_fk(star),
                   dq_revenue_tieout(star, stg), dq_items_vs_payments(star)])


def output_families(star: Star, stg: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    return {"row_reconciliation": lambda: dq_row_reconciliation(star, stg),
            "referential_integrity": lambda: dq_output_orphan_fk(star),
            "revenue_tie_out": lambda: dq_revenue_tieout(star, stg).unionByName(dq_items_vs_payments(star))}


# ---------------------------------------------------------------- report and gate


def dq_report(results: DataFrame, gate: str) -> DataFrame:
    """Non-zero check rows with the gate name and the gate's verdict.

    The verdict is a window over the report itself - one row per non-zero check, a
    bounded handful - so the checks are evaluated once.
    """
    kept = results.filter(F.col("count") != 0)
    blocking = F.count_if(F.col("severity") == BLOCKING).over(Window.partitionBy())
    return kept.select(F.lit(gate).alias("gate"), *RESULT_COLUMNS, (blocking == 0).alias("passed"))


def dq_summary(report: DataFrame, gate: str) -> DataFrame:
    """One row per gate: passed, blocking failures, logged anomalies."""
    return report.agg(
        F.lit(gate).alias("gate"),
        (F.count_if(F.col("severity") == BLOCKING) == 0).alias("passed"),
        F.count_if(F.col("severity") == BLOCKING).alias("blocking_failures"),
        F.count_if(F.col("severity") == LOGGED).alias("logged_anomalies"))


class QualityGateError(RuntimeError):
    pass


def isolated(spark: SparkSession, families: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Each family evaluated on its own.  One that fails at run time (a value that its
    expressions cannot read, a lost file) becomes a blocking row with the table ``unknown``;
    the others still report."""
    rows: list[tuple] = []
    for name, build in families.items():
        try:
            rows += [tuple(r) for r in build().where("count <> 0").collect()]  # a handful of rows
        except (PySparkException, Py4JError) as error:
            rows.append((name, "unknown", f"the checks did not run: {str(error).strip().splitlines()[0]}", 1, BLOCKING))
    return spark.createDataFrame(rows, _RESULT_SCHEMA)


def _enforce(spark: SparkSession, checks: Callable[[], DataFrame], families: Mapping[str, Callable[[], DataFrame]],
             gate: str) -> DataFrame:
    """All checks in one job; if it fails, family by family."""
    try:
        rows = [tuple(r) for r in checks().where("count <> 0").collect()]
    except (PySparkException, Py4JError):
        return run_gate(isolated(spark, families), gate)
    return run_gate(spark.createDataFrame(rows, _RESULT_SCHEMA), gate)


def gate_input(stg: Mapping[str, DataFrame]) -> DataFrame:
    """The input gate: its report, or QualityGateError."""
    families = {name: functools.partial(fn, stg) for name, fn in INPUT_FAMILIES.items()}
    return _enforce(stg["orders"].sparkSession, lambda: input_checks(stg), families, "input")


def gate_output(star: Star, stg: Mapping[str, DataFrame]) -> DataFrame:
    """The output gate: its report, or QualityGateError."""
    return _enforce(stg["orders"].sparkSession, lambda: output_checks(star, stg), output_families(star, stg), "output")


def run_gate(results: DataFrame, gate: str) -> DataFrame:
    """Evaluate a gate; raise QualityGateError listing blocking rows if any.

    Only the report (one row per non-zero check, a bounded handful) reaches the driver.
    """
    report = dq_report(results, gate)
    rows = report.collect()
    blocking = [r for r in rows if r["severity"] == BLOCKING]
    if blocking:
        lines = "; ".join(f"[{r['check']}] {r['table']}: {r['detail']} (count={r['count']})"
                          for r in blocking)
        raise QualityGateError(f"{gate} gate failed: {lines}")
    return report
