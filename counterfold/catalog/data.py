"""Queries on data preparation: cohorts, kinds, levels, folds, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from counterfold.catalog.tables import (
    DOCUMENTS_SQL,
    GENOTYPES_SQL,
    ORDERS_SQL,
    documents_cohort,
    genotypes,
    lineitem_cohort,
    orders_cohort,
    table,
)
from counterfold.models.base import Design
from counterfold.operators.features import GenotypeEncoder, RestrictedInteractions
from counterfold.operators.folds import count_levels, effective_size, with_folds
from counterfold.operators.schema import (
    column_kinds,
    complete_case_ids,
    dropped_case_ids,
    make_categorical,
    make_float,
    matching_columns,
    profile,
)
from counterfold.plans.estimands import (
    cast_level_table,
    consecutive_levels,
    identify_table,
    nuisance_counts,
)

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# --- cohorts and complete cases -------------------------------------------------


@query(
    "cohort_join",
    f"""
SELECT o_orderkey, o_totalprice, c_mktsegment, n_name, urgent, late, rich, dear
FROM ({ORDERS_SQL})""",
)
def cohort_join(spark, sf):
    return orders_cohort(spark, sf).select(
        "o_orderkey", "o_totalprice", "c_mktsegment", "n_name", "urgent", "late", "rich", "dear"
    )


VARIABLES = ["quality", "lang", "source"]


@query(
    "complete_case_ids",
    f"SELECT doc_id FROM ({DOCUMENTS_SQL}) WHERE quality IS NOT NULL AND lang IS NOT NULL"
    " AND source IS NOT NULL",
)
def complete_ids(spark, sf):
    return complete_case_ids(documents_cohort(spark, sf), VARIABLES, "doc_id")


@query(
    "dropped_case_ids",
    f"SELECT doc_id FROM ({DOCUMENTS_SQL}) WHERE quality IS NULL OR lang IS NULL OR source IS NULL",
)
def dropped_ids(spark, sf):
    return dropped_case_ids(documents_cohort(spark, sf), VARIABLES, "doc_id")


# --- kinds and levels -------------------------------------------------------------

KIND_TABLES = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    "events": ("event_id", "user_id", "event_type", "value"),
    "labels": ("doc_id", "quality", "toxic"),
    "lineitem": ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag"),
}
TEXT = {"o_orderstatus", "o_orderpriority", "event_type", "l_returnflag"}
DOUBLES = {"o_totalprice", "value", "l_quantity", "l_discount", "l_tax"}


def _kinds_sql() -> str:
    parts = []
    for t, columns in KIND_TABLES.items():
        for c in columns:
            finite = "d <= 100" if c in TEXT else "d <= greatest(4, floor(least(0.3 * n, 100)))"
            rest = "text" if c in TEXT else "continuous" if c in DOUBLES else "count"
            two = "false" if c in TEXT else "d = 2 AND lo = 0 AND hi = 1"
            low = "NULL" if c in TEXT else f"min({c})"
            high = "NULL" if c in TEXT else f"max({c})"
            parts.append(f"""
SELECT '{t}' AS "table", '{c}' AS "column",
       CASE WHEN {finite} THEN 'finite' ELSE '{rest}' END AS kind,
       CASE WHEN {two} THEN 'binary' ELSE 'continuous' END AS outcome_kind,
       n - filled AS nulls, CASE WHEN {finite} THEN d END AS levels
FROM (SELECT count(*) AS n, count({c}) AS filled, count(DISTINCT {c}) AS d,
             {low} AS lo, {high} AS hi FROM {t})""")
    return "\nUNION ALL\n".join(parts)


@query("column_kinds", _kinds_sql())
def kinds(spark, sf):
    out = None
    for t, columns in KIND_TABLES.items():
        part = column_kinds(table(spark, sf, t), columns).select(F.lit(t).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "categorical_and_float",
    """
SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS DOUBLE) AS o_custkey,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END::BIGINT AS status_index,
       false AS status_ordered, true AS linecount_ordered
FROM orders""",
)
def categorical_and_float(spark, sf):
    orders = table(spark, sf, "orders").withColumn("size", F.col("o_orderkey") % 7)
    made, info = make_categorical(orders, ["o_orderstatus", "size"], infer_ordered=True)
    levels = F.array(*[F.lit(v) for v in info["o_orderstatus"]["levels"]])
    return make_float(made, "o_custkey").select(
        "o_orderkey", "o_orderstatus", "o_custkey",
        (F.array_position(levels, F.col("o_orderstatus")) - 1).alias("status_index"),
        F.lit(info["o_orderstatus"]["ordered"]).alias("status_ordered"),
        F.lit(info["size"]["ordered"]).alias("linecount_ordered"),
    )


@query(
    "cast_treatment_levels",
    """
WITH cohort AS (
  SELECT o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, o_orderstatus, c_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey),
asked AS (
  SELECT DISTINCT 'urgent' AS treatment, CAST(o_orderkey % 3 AS VARCHAR) AS level FROM orders
  UNION ALL
  SELECT DISTINCT 'c_nationkey', CAST(c_nationkey AS VARCHAR) || '.0' FROM customer
  UNION ALL
  SELECT DISTINCT 'c_nationkey', CAST(c_nationkey AS VARCHAR) || '.5' FROM customer
  UNION ALL
  SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders),
cast_ AS (
  SELECT treatment, level,
    CASE treatment
      WHEN 'urgent' THEN CASE level WHEN '1' THEN 'true' WHEN '0' THEN 'false' END
      WHEN 'c_nationkey' THEN CASE WHEN level LIKE '%.0' THEN split_part(level, '.', 1) END
      ELSE level END AS value
  FROM asked),
seen AS (
  SELECT 'urgent' AS treatment, CAST(urgent AS VARCHAR) AS value, count(*) AS units
  FROM cohort GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM cohort GROUP BY 2
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM cohort GROUP BY 2)
SELECT c.treatment, level, c.value, c.value IS NOT NULL AS valid,
       CAST(coalesce(units, 0) AS BIGINT) AS units
FROM cast_ c LEFT JOIN seen s ON c.treatment = s.treatment AND c.value = s.value""",
)
def cast_levels(spark, sf):
    cohort = orders_cohort(spark, sf).select("urgent", "o_orderstatus", "c_nationkey")
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    key = F.col("c_nationkey").cast("string")

    def ask(df, treatment, level):
        return df.select(F.lit(treatment).alias("treatment"), level.alias("level")).distinct()

    asked = (
        ask(orders, "urgent", (F.col("o_orderkey") % 3).cast("string"))
        .unionByName(ask(customer, "c_nationkey", F.concat(key, F.lit(".0"))))
        .unionByName(ask(customer, "c_nationkey", F.concat(key, F.lit(".5"))))
        .unionByName(ask(orders, "o_orderstatus", F.col("o_orderstatus")))
    )
    return cast_level_table(asked, cohort)


@query(
    "factorial_levels",
    """
WITH levels AS (
  SELECT DISTINCT 'o_orderstatus' AS treatment, o_orderstatus AS level, 0 AS k FROM orders
  UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority, 0 FROM orders
  UNION ALL SELECT DISTINCT 'p_type', p_type, 0 FROM part
  UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR), p_size FROM part),
pairs AS (
  SELECT treatment, lag(level) OVER (PARTITION BY treatment ORDER BY k, level) AS control,
         level AS "case" FROM levels)
SELECT * FROM pairs WHERE control IS NOT NULL""",
)
def factorial_levels(spark, sf):
    a = consecutive_levels(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    b = consecutive_levels(table(spark, sf, "part"), ["p_type", "p_size"])
    return a.unionByName(b)


# --- tables of questions -----------------------------------------------------------


def questions(spark, sf):
    """One question per (supplier nation, brand pair met in an order): the effect of
    the brands on the nation's sales; the graph says that a brand depends on its types."""
    line, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    supplier = table(spark, sf, "supplier")
    sold = (
        line.select("l_partkey", "l_suppkey")
        .join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "p_brand")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    # An identifier that is the same in every run: nation and brand number.
    number = F.split("p_brand", "#")[1].cast("bigint")
    none = F.lit(None).cast("array<string>")
    return sold.select(
        (F.col("s_nationkey").cast("bigint") * 1000 + number).alias("idx"),
        F.lit("ATE").alias("type"),
        F.concat(F.lit("sales_"), F.col("s_nationkey").cast("string")).alias("outcome"),
        F.array(
            F.struct(
                F.col("p_brand").alias("name"), F.lit("1").alias("case"),
                F.lit("0").alias("control"), none.alias("confounders"),
            )
        ).alias("treatments"),
        F.array(F.lit("year")).alias("extra"),
    )


def graph(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("treatment"), F.col("p_type").alias("confounder")
    ).distinct()


QUESTIONS_SQL = """
  SELECT DISTINCT CAST(s_nationkey AS BIGINT) * 1000
           + CAST(split_part(p_brand, '#', 2) AS BIGINT) AS idx,
         'sales_' || CAST(s_nationkey AS VARCHAR) AS outcome, p_brand
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""
GRAPH_SQL = """
  SELECT p_brand AS treatment, list_sort(list(DISTINCT p_type)) AS parents
  FROM part GROUP BY p_brand"""


@query(
    "identify_backdoor",
    f"""
SELECT idx, outcome, p_brand AS treatment,
       array_to_string(parents, ',') AS confounders, true AS identified
FROM ({QUESTIONS_SQL}) JOIN ({GRAPH_SQL}) ON p_brand = treatment""",
)
def identify_backdoor(spark, sf):
    done = identify_table(questions(spark, sf), graph(spark, sf))
    return done.select(
        "idx", "outcome", F.col("treatments")[0]["name"].alias("treatment"),
        F.array_join("all_confounders", ",").alias("confounders"), "identified",
    )


@query(
    "nuisance_counts",
    f"""
WITH q AS (SELECT idx, outcome, p_brand, parents
           FROM ({QUESTIONS_SQL}) JOIN ({GRAPH_SQL}) ON p_brand = treatment),
n AS (
  SELECT outcome AS target,
         array_to_string(list_sort(list_distinct(list_concat(list_concat(parents, ['year']), [p_brand]))), ',')
           AS parents
  FROM q
  UNION ALL SELECT p_brand, array_to_string(parents, ',') FROM q)
SELECT target, parents, count(*) AS uses FROM n GROUP BY target, parents""",
)
def nuisance_uses(spark, sf):
    done = identify_table(questions(spark, sf), graph(spark, sf))
    return nuisance_counts(done).select(
        "target", F.array_join("parents", ",").alias("parents"), "uses"
    )


@query(
    "treatment_set",
    f"SELECT DISTINCT p_brand AS treatment FROM ({QUESTIONS_SQL})",
)
def treatment_set(spark, sf):
    return questions(spark, sf).select(
        F.explode("treatments.name").alias("treatment")
    ).distinct()


# --- folds -------------------------------------------------------------------------


def _blocks(k: str, order: str) -> str:
    """Contiguous blocks, the first n mod k one longer."""
    return f"""
SELECT o_orderkey, CAST(CASE WHEN p < r * (q + 1) THEN p // (q + 1)
    ELSE r + (p - r * (q + 1)) // q END + 1 AS INTEGER) AS fold
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {order}) - 1 AS p,
             count(*) OVER () // {k} AS q, count(*) OVER () % {k} AS r FROM orders)"""


def _rounds(k: str, stratum: str, source: str = "orders") -> str:
    """Strata by first appearance, one round of turns carried across them."""
    return f"""
WITH s AS (SELECT o_orderkey, {stratum} AS s FROM ({source}) x),
firsts AS (SELECT s, min(o_orderkey) AS first_key, count(*) AS c FROM s GROUP BY s),
starts AS (SELECT s, coalesce(sum(c) OVER (ORDER BY first_key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM firsts),
k AS (SELECT {k} AS k)
SELECT o_orderkey, CAST((start + row_number() OVER (PARTITION BY s.s ORDER BY o_orderkey) - 1)
         % k.k + 1 AS INTEGER) AS fold
FROM s JOIN starts USING (s) CROSS JOIN k"""


def _adaptive(neff: str) -> str:
    return f"""CASE WHEN {neff} < 30 THEN {neff} WHEN {neff} < 500 THEN 20
      WHEN {neff} < 5000 THEN 10 WHEN {neff} < 10000 THEN 5 ELSE 3 END"""


@query("folds_cv", _blocks("6", "o_orderkey"))
def folds_cv(spark, sf):
    return with_folds(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "cv")


@query("folds_stratified", _rounds("3", "o_orderstatus", "SELECT * FROM orders"))
def folds_stratified(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return with_folds(orders, "o_orderkey", "stratified", 3, "o_orderstatus").select(
        "o_orderkey", "fold"
    )


JOINT_STRATUM = """'_' || o_orderstatus || '_' || CAST(urgent AS VARCHAR)
  || '_' || CAST(dear AS VARCHAR)"""


@query("folds_joint", _rounds("3", JOINT_STRATUM, ORDERS_SQL))
def folds_joint(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "o_orderstatus", "urgent", "c_acctbal", "dear")
    return with_folds(
        rows, "o_orderkey", "joint", 3, "dear", ["o_orderstatus", "urgent", "c_acctbal"]
    ).select("o_orderkey", "fold")


@query(
    "folds_joint_patterns",
    _rounds("4", "'_' || CAST(urgent AS VARCHAR)", ORDERS_SQL),
)
def folds_joint_patterns(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "o_orderstatus", "urgent", "o_totalprice")
    return with_folds(
        rows, "o_orderkey", "joint", 4, "o_totalprice", ["o_orderstatus", "urgent"], ["^urg"]
    ).select("o_orderkey", "fold")


@query(
    "folds_adaptive",
    _blocks(f"(SELECT {_adaptive('count(*)')} FROM orders)", "o_orderkey"),
)
def folds_adaptive(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_folds(orders, "o_orderkey", "adaptive-cv", outcome="o_totalprice").select(
        "o_orderkey", "fold"
    )


@query(
    "folds_adaptive_strat",
    _rounds(
        f"""(SELECT {_adaptive('least(sum(c), 5 * min(c))')}
             FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderpriority))""",
        "o_orderpriority",
        "SELECT * FROM orders",
    ),
)
def folds_adaptive_strat(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return with_folds(
        orders, "o_orderkey", "adaptive-stratified", outcome="o_orderpriority"
    ).select("o_orderkey", "fold")


@query(
    "folds_adaptive_joint",
    _rounds(
        f"""(SELECT {_adaptive('least(sum(c), 5 * min(c))')}
             FROM (SELECT count(*) AS c FROM ({ORDERS_SQL}) GROUP BY {JOINT_STRATUM}))""",
        JOINT_STRATUM,
        ORDERS_SQL,
    ),
)
def folds_adaptive_joint(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "o_orderstatus", "urgent", "dear")
    return with_folds(
        rows, "o_orderkey", "adaptive-joint", None, "dear", ["o_orderstatus", "urgent"]
    ).select("o_orderkey", "fold")


@query("folds_shuffled")
def folds_shuffled(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return with_folds(orders, "o_orderkey", "cv", 5, seed=7)


@query(
    "folds_shuffled_sizes",
    """
SELECT CAST(f AS INTEGER) AS fold,
       n // 5 + CASE WHEN f <= n % 5 THEN 1 ELSE 0 END AS units
FROM (SELECT count(*) AS n FROM orders) CROSS JOIN range(1, 6) t(f)""",
)
def folds_shuffled_sizes(spark, sf):
    return folds_shuffled(spark, sf).groupBy("fold").agg(F.count(F.lit(1)).alias("units"))


@query(
    "folds_text_key",
    """
SELECT c_name, CAST(CASE WHEN p < r * (q + 1) THEN p // (q + 1)
    ELSE r + (p - r * (q + 1)) // q END + 1 AS INTEGER) AS fold
FROM (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS p,
             count(*) OVER () // 6 AS q, count(*) OVER () % 6 AS r FROM customer)""",
)
def folds_text_key(spark, sf):
    return with_folds(table(spark, sf, "customer").select("c_name"), "c_name", "cv")


@query(
    "count_levels",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key
FROM orders GROUP BY o_orderstatus, o_orderpriority""",
)
def levels_counted(spark, sf):
    return count_levels(
        table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderkey"
    )


def _neff_sql() -> str:
    parts = []
    for t, c in (("labels", "quality"), ("events", "event_type"), ("part", "p_brand")):
        parts.append(f"""
SELECT '{t}' AS "table", n, rarest, neff, CAST({_adaptive('neff')} AS BIGINT) AS nfolds
FROM (SELECT CAST(sum(c) AS BIGINT) AS n, min(c) AS rarest,
             CAST(least(sum(c), 5 * min(c)) AS BIGINT) AS neff
      FROM (SELECT count(*) AS c FROM {t} GROUP BY {c}))""")
    parts.append(f"""
SELECT 'orders', n, NULL, n, CAST({_adaptive('n')} AS BIGINT)
FROM (SELECT count(*) AS n FROM orders)""")
    return "\nUNION ALL\n".join(parts)


@query("neff_nfolds", _neff_sql())
def neff_nfolds(spark, sf):
    parts = [
        effective_size(table(spark, sf, t), c, finite).select(F.lit(t).alias("table"), "*")
        for t, c, finite in (
            ("labels", "quality", True), ("events", "event_type", True),
            ("part", "p_brand", True), ("orders", "o_totalprice", False),
        )
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- features ------------------------------------------------------------------------

NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _products_sql(terms) -> str:
    made = ", ".join(" * ".join(t) + ' AS "' + "_&_".join(t) + '"' for t in terms)
    return f"SELECT {', '.join(NUMBERS)}, {made} FROM lineitem"


@query(
    "interactions_order2",
    _products_sql(
        [("l_discount", "l_quantity"), ("l_discount", "l_tax"), ("l_discount", "l_extendedprice")]
    ),
)
def interactions_order2(spark, sf):
    rows = table(spark, sf, "lineitem").select(*NUMBERS)
    return RestrictedInteractions(2, ("l_discount",)).fit(rows).transform(rows)


@query(
    "interactions_order3",
    _products_sql(
        [
            ("l_quantity", "l_tax"),
            ("l_quantity", "l_discount"), ("l_quantity", "l_extendedprice"),
            ("l_tax", "l_discount"), ("l_tax", "l_extendedprice"),
            ("l_quantity", "l_tax", "l_discount"), ("l_quantity", "l_tax", "l_extendedprice"),
        ]
    ),
)
def interactions_order3(spark, sf):
    rows = table(spark, sf, "lineitem").select(*NUMBERS)
    return RestrictedInteractions(3, ("l_quantity",), ("^l_t",)).fit(rows).transform(rows)


@query(
    "interactions_all",
    _products_sql([(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]]),
)
def interactions_all(spark, sf):
    rows = table(spark, sf, "lineitem").select(*NUMBERS)
    return RestrictedInteractions(2, everything=True).fit(rows).transform(rows)


@query(
    "snp_reference",
    f"""
SELECT 'site_1' AS "column", substr(min(site_1), 1, 1) AS reference FROM ({GENOTYPES_SQL})
UNION ALL SELECT 'site_2', substr(min(site_2), 1, 1) FROM ({GENOTYPES_SQL})""",
)
def snp_reference(spark, sf):
    return GenotypeEncoder(("^site",)).fit(genotypes(spark, sf)).table(spark)


@query(
    "snp_dosage",
    f"""
WITH g AS ({GENOTYPES_SQL}),
r AS (SELECT substr(min(site_1), 1, 1) AS a, substr(min(site_2), 1, 1) AS b FROM g)
SELECT p_partkey, CAST(length(site_1) - length(replace(site_1, a, '')) AS BIGINT) AS site_1,
       CAST(length(site_2) - length(replace(site_2, b, '')) AS BIGINT) AS site_2, p_size
FROM g CROSS JOIN r""",
)
def snp_dosage(spark, sf):
    rows = genotypes(spark, sf)
    return GenotypeEncoder(("_1$", "_2$")).fit(rows).transform(rows)


@query(
    "encode_onehot",
    """
SELECT o_orderkey, CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS automobile,
       CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS building,
       CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS furniture,
       CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS household,
       CAST(n_regionkey AS DOUBLE) AS region, c_acctbal AS balance
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def encode_onehot(spark, sf):
    rows = orders_cohort(spark, sf)
    parents = ("c_mktsegment", "n_regionkey", "c_acctbal")
    design = Design(parents, profile(rows, parents))
    names = [n.split("=")[-1].lower() for n in design.names]
    names = [{"n_regionkey": "region", "c_acctbal": "balance"}.get(n, n) for n in names]
    return rows.select("o_orderkey", *[c.alias(n) for c, n in zip(design.columns(), names)])


@query(
    "columns_by_pattern",
    "SELECT l_discount, l_quantity, l_tax FROM lineitem",
)
def columns_by_pattern(spark, sf):
    rows = lineitem_cohort(spark, sf)
    return rows.select(*matching_columns(sorted(rows.columns), ["^l_t", "^l_q", "count$"]))
