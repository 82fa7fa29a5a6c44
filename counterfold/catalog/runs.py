"""Queries on whole runs: sinks, sources, failures, influence values, rows used."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.catalog.effects import (
    COARSE_Q,
    SATURATED,
    SEG,
    STATUS,
    TRUE_FALSE,
    URGENT_QUESTION,
    D,
    by_idx,
    coarse,
    summary,
    urgent_study,
)
from counterfold.catalog.sqlgen import Study, ate, cm, union
from counterfold.catalog.tables import (
    DOCUMENTS_SQL,
    ORDERS_SQL,
    documents_cohort,
    orders_cohort,
    table,
)
from counterfold.models import Linear, Saturated
from counterfold.plans import estimands as E
from counterfold.plans.engine import Engine, sample_set_id
from counterfold.plans.registry import OSE, TMLE, Models
from counterfold.session import scratch_path
from counterfold.sinks import Outputs, merge_results, sample_references, write_arrow
from counterfold.sources.readers import read_arrow, read_table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# --- influence values ---------------------------------------------------------------------


def _influence_sql() -> str:
    """The mean under urgency is far from 0; the effect of urgency is not."""
    def kept(study, idx):
        return f"""(WITH {study.influence('ose')}, z AS (
  SELECT avg(u) AS psi, abs(avg(u)) / (stddev_samp(u) / sqrt(count(*))) AS z FROM ic)
SELECT CAST({idx} AS INTEGER) AS idx, o_orderkey AS "SAMPLE_ID", CAST(round(u - psi) AS BIGINT) AS ic
FROM ic, z WHERE z >= 3.8905918864131203)"""

    return union([
        kept(coarse(keep=("o_orderkey",)), 0),
        kept(Study(ORDERS_SQL, "o_totalprice", ("urgent",), (SEG,), ((SEG, STATUS),), cm("true"),
                   keep=("o_orderkey",)), 1),
    ])


@query("influence_kept", _influence_sql())
def influence_kept(spark, sf):
    """Influence values of the effects with a p-value below 1e-4."""
    mean = E.CM("o_totalprice", {"urgent": True}, {"urgent": [SEG, STATUS]})
    engine = Engine(
        orders_cohort(spark, sf), [URGENT_QUESTION, mean], {"OSE": OSE(COARSE_Q)},
        key="o_orderkey", pvalue_threshold=1e-4,
    )
    got = engine.run().influence
    return got.select("idx", "SAMPLE_ID", F.round("ic").cast("bigint").alias("ic"))


# --- rows used -------------------------------------------------------------------------------

DOC_QUESTIONS = [
    E.ATE("quality", {"english": TRUE_FALSE}, {"english": ["long"]}),
    E.CM("quality", {"english": True}, {"english": ["long"]}),
    E.CM("n_chars", {"english": True}, {"english": ["long"]}),
    E.ATE("toxic", {"english": TRUE_FALSE}, {"english": ["long"]}),
]


@query(
    "sample_sets",
    f"""
SELECT 'quality' AS outcome, doc_id AS "SAMPLE_ID" FROM ({DOCUMENTS_SQL}) WHERE quality IS NOT NULL
UNION ALL SELECT 'n_chars', doc_id FROM ({DOCUMENTS_SQL})
UNION ALL SELECT 'toxic', doc_id FROM ({DOCUMENTS_SQL}) WHERE toxic IS NOT NULL""",
)
def sample_sets(spark, sf):
    engine = Engine(
        documents_cohort(spark, sf), DOC_QUESTIONS, {"OSE": OSE(SATURATED)}, key="doc_id",
        save_sample_ids=True,
    )
    names = {sample_set_id(q.variables()): q.outcome for q in DOC_QUESTIONS}
    outcome = F.lit(None).cast("string")
    for number, name in names.items():
        outcome = F.when(F.col("sample_set_id") == number, name).otherwise(outcome)
    return engine.sample_sets(range(4)).select(outcome.alias("outcome"), "SAMPLE_ID")


@query(
    "sample_refs",
    f"""
WITH c AS (SELECT count(quality) AS q, count(*) AS n, count(toxic) AS t FROM ({DOCUMENTS_SQL}))
SELECT CAST(0 AS INTEGER) AS idx, CAST(NULL AS BIGINT) AS same_as, q AS n FROM c
UNION ALL SELECT 1, 1, q FROM c
UNION ALL SELECT 2, NULL, n FROM c
UNION ALL SELECT 3, NULL, t FROM c""",
)
def sample_refs(spark, sf):
    engine = Engine(documents_cohort(spark, sf), DOC_QUESTIONS, {"OSE": OSE(SATURATED)})
    results = engine()
    return sample_references(results).join(results.select("idx", "n"), "idx").select(
        "idx", "same_as", "n"
    )


# --- failures -----------------------------------------------------------------------------------

PAIR = {"urgent": TRUE_FALSE, "late": TRUE_FALSE}
PAIR_W = {"urgent": [SEG], "late": [SEG]}
FAILING = [
    E.AIE("o_totalprice", PAIR, PAIR_W),
    E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": [SEG]}),
    E.ATE("o_totalprice", {"late": TRUE_FALSE}, {"late": [SEG]}),
    E.AIE("dear", PAIR, PAIR_W),
]


@query(
    "failed_and_skipped",
    f"""
WITH good AS (SELECT * FROM {urgent_study(ate(["true"], ["false"])).select("ose", "OSE", digits=D)}),
fit AS (SELECT 'Could not fit the following propensity score model: P₀(late | c_mktsegment)' AS m)
SELECT CAST(0 AS INTEGER) AS idx, 'failed' AS status, m AS error, CAST(NULL AS DOUBLE) AS estimate FROM fit
UNION ALL SELECT 1, 'ok', NULL, estimate FROM good
UNION ALL SELECT 2, 'failed', 'Skipped due to shared failed nuisance fit.', NULL
UNION ALL SELECT 3, 'failed', 'Skipped due to shared failed nuisance fit.', NULL""",
)
def failed_and_skipped(spark, sf):
    """A model for numbers is set for one treatment: every question with it fails."""
    broken = Models(Saturated(), Saturated(), Saturated(), (("late", Linear()),))
    got = Engine(orders_cohort(spark, sf), FAILING, {"OSE": OSE(broken)})()
    return got.select("idx", "status", "error", (F.round("estimate", 3) + 0.0).alias("estimate"))


# --- sinks ---------------------------------------------------------------------------------------

BATCHED = [
    E.CM("o_totalprice", {"urgent": True}, {"urgent": [SEG]}),
    E.CM("o_totalprice", {"urgent": False}, {"urgent": [SEG]}),
    E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": [SEG]}),
]
BATCHED_NAMES = ("CM1", "CM0", "ATE")
BATCHED_SQL = union([
    urgent_study(cm("true")).select("ose", "CM1", digits=D),
    urgent_study(cm("false")).select("ose", "CM0", digits=D),
    urgent_study(ate(["true"], ["false"])).select("ose", "ATE", digits=D),
])


@query(
    "batched_run",
    f"""
SELECT CASE estimator WHEN 'ATE' THEN 2 ELSE 1 END::INTEGER AS batch_id, estimator, estimate, std,
       se, n, clipped FROM ({BATCHED_SQL})""",
)
def batched_run(spark, sf):
    out = Outputs(parquet=scratch_path(spark, "batched"), json=scratch_path(spark, "batched-json"))
    Engine(
        orders_cohort(spark, sf), BATCHED, {"OSE": OSE(SATURATED)}, outputs=out, batch_size=2
    )()
    read = spark.read.parquet(out.results_path)
    shown = by_idx(*BATCHED_NAMES)
    return read.select("batch_id", "idx").distinct().select(
        "batch_id", shown.alias("estimator")
    ).join(summary(read, shown), "estimator")


@query(
    "json_results",
    BATCHED_SQL,
)
def json_results(spark, sf):
    out = Outputs(json=scratch_path(spark, "json"))
    Engine(orders_cohort(spark, sf), BATCHED, {"OSE": OSE(SATURATED)}, outputs=out)()
    return summary(spark.read.json(out.json), by_idx(*BATCHED_NAMES))


@query(
    "merge_results",
    f"""
WITH s AS ({BATCHED_SQL}),
p AS (SELECT estimator, CASE estimator WHEN 'CM1' THEN 0 WHEN 'CM0' THEN 1 ELSE 2 END AS idx,
             estimate FROM s)
SELECT 'run1' AS run_id, CAST(idx AS INTEGER) AS idx, estimate FROM p
UNION ALL SELECT 'run2', CAST(idx - 1 AS INTEGER), estimate FROM p WHERE idx > 0""",
)
def merged(spark, sf):
    prefix = scratch_path(spark, "merge")
    rows = orders_cohort(spark, sf)
    for name, asked in (("run1", BATCHED), ("run2", BATCHED[1:])):
        Engine(
            rows, asked, {"OSE": OSE(SATURATED)}, run_id=name, batch_size=2,
            outputs=Outputs(parquet=f"{prefix}-{name}"),
        )()
    out = Outputs(parquet=scratch_path(spark, "merged"))
    merge_results(spark, f"{prefix}-", out)
    return spark.read.parquet(out.results_path).select(
        "run_id", "idx", (F.round("estimate", 3) + 0.0).alias("estimate")
    )


def _interrupted(rows, asked, estimators, out, **options):
    """A run that stops before its second batch is in the manifest, is taken up, and again."""
    engine = Engine(rows, asked, estimators, outputs=out, batch_size=1, **options)
    engine.outputs.initialize(engine.spark)
    engine.outputs.append(engine.run([0], 1), 1)
    torn = engine.run([1], 2)  # its results are there, the manifest does not know them
    for kind in out.kinds():
        torn.results.write.mode("append").partitionBy("batch_id").format(kind).save(
            out.path(kind, "results"))
    for _ in range(2):
        Engine(rows, asked, estimators, outputs=out, batch_size=1, **options)(resume=True)


@query(
    "resume_twice",
    f"""
SELECT f.format, b.estimator, b.estimate, b.n
FROM ({BATCHED_SQL}) b, (SELECT unnest(['parquet', 'json']) AS format) f""",
)
def resume_twice(spark, sf):
    """Taking a run up after a torn batch, and again after its end, doubles no row."""
    out = Outputs(parquet=scratch_path(spark, "resumed"), json=scratch_path(spark, "resumed-json"))
    _interrupted(orders_cohort(spark, sf), BATCHED, {"OSE": OSE(SATURATED)}, out)
    shown = by_idx(*BATCHED_NAMES)
    return reduce(DataFrame.unionByName, [
        summary(out.read(spark, kind, "results"), shown).select(
            F.lit(kind).alias("format"), "estimator", "estimate", "n") for kind in out.kinds()])


@query("json_influence", _influence_sql())
def json_influence(spark, sf):
    """Influence values through JSON lines, written in two batches."""
    mean = E.CM("o_totalprice", {"urgent": True}, {"urgent": [SEG, STATUS]})
    out = Outputs(json=scratch_path(spark, "json-influence"))
    _interrupted(orders_cohort(spark, sf), [URGENT_QUESTION, mean], {"OSE": OSE(COARSE_Q)}, out,
                 key="o_orderkey", pvalue_threshold=1e-4)
    got = out.read(spark, "json", "influence")
    return got.select(
        F.col("idx").cast("int").alias("idx"), "SAMPLE_ID", F.round("ic").cast("bigint").alias("ic"))


def _document_runs(spark, sf):
    """Two runs on other rows with the same variables, each with its rows used; their prefix."""
    prefix = scratch_path(spark, "sets")
    rows = documents_cohort(spark, sf)
    for name, part in (("even", 0), ("odd", 1)):
        Engine(
            rows.where(F.col("doc_id") % 2 == part), DOC_QUESTIONS, {"OSE": OSE(SATURATED)},
            key="doc_id", save_sample_ids=True, pvalue_threshold=1.1, run_id=name, batch_size=2,
            outputs=Outputs(parquet=f"{prefix}-{name}"),
        )()
    return f"{prefix}-"


@query(
    "merge_sample_sets",
    f"""
WITH d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS run_id, * FROM ({DOCUMENTS_SQL}))
SELECT run_id, CAST(q.idx AS INTEGER) AS idx, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids
FROM d, (SELECT unnest([0, 1, 2, 3]) AS idx) q
WHERE CASE q.idx WHEN 2 THEN true WHEN 3 THEN toxic IS NOT NULL ELSE quality IS NOT NULL END
GROUP BY run_id, q.idx""",
)
def merge_sample_sets(spark, sf):
    """Sets of the same variables in two runs keep apart."""
    out = Outputs(parquet=scratch_path(spark, "merged-sets"))
    merge_results(spark, _document_runs(spark, sf), out)
    results = spark.read.parquet(out.results_path).select("run_id", "idx", "sample_set_id")
    sets = spark.read.parquet(out.path("parquet", "sample_sets"))
    return results.join(sets, "sample_set_id").groupBy("run_id", "idx").agg(
        F.count("*").alias("n"), F.sum("SAMPLE_ID").alias("ids"))


@query(
    "merge_influence",
    f"""
WITH d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS run_id, * FROM ({DOCUMENTS_SQL})),
s AS (SELECT run_id, CAST(2 AS INTEGER) AS idx, count(*) AS n FROM d GROUP BY run_id
      UNION ALL SELECT run_id, 0, count(quality) FROM d GROUP BY run_id
      UNION ALL SELECT run_id, 1, count(quality) FROM d GROUP BY run_id
      UNION ALL SELECT run_id, 3, count(toxic) FROM d GROUP BY run_id)
SELECT run_id, idx, n, 0.0 AS mean FROM s""",
)
def merge_influence(spark, sf):
    """Every influence value of two runs in one table; each effect's values have mean zero."""
    out = Outputs(parquet=scratch_path(spark, "merged-influence"))
    merge_results(spark, _document_runs(spark, sf), out)
    kept = spark.read.parquet(out.path("parquet", "influence"))
    return kept.groupBy("run_id", "idx").agg(
        F.count("*").alias("n"), (F.abs(F.round(F.avg("ic"), 6)) + 0.0).alias("mean"))


# --- sources --------------------------------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(
    "scan_csv",
    """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def scan_csv(spark, sf):
    path = scratch_path(spark, "scan") + ".csv"
    table(spark, sf, "orders").select(*ORDER_COLUMNS).write.csv(path, header=True)
    return read_table(spark, path)


@query(
    "scan_arrow",
    f"""
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def scan_arrow(spark, sf):
    """Written by tasks, read by tasks; nulls come through."""
    path = scratch_path(spark, "scan")
    rows = documents_cohort(spark, sf).select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )
    write_arrow(rows.repartition(4), path)
    return read_table(spark, path)


@query(
    "arrow_splits",
    """
SELECT true AS many_tasks, count(*) AS n, sum(doc_id)::BIGINT AS ids, count(DISTINCT doc_id) AS distinct_ids
FROM documents""",
)
def arrow_splits(spark, sf):
    """One file of many record batches is read by several tasks, each batch once."""
    path = scratch_path(spark, "one-file")
    write_arrow(table(spark, sf, "documents").select("doc_id", "source").repartition(1), path,
                batch_rows=100)
    rows = read_arrow(spark, path, split_bytes=4096)
    return rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.sum("doc_id").alias("ids"), F.count_distinct("doc_id").alias("d")
    ).agg((F.count("*") > 1).alias("many_tasks"), F.sum("n").alias("n"), F.sum("ids").alias("ids"),
          F.sum("d").alias("distinct_ids"))


CONFIG_YAML = """
type: Configuration
estimands:
  - type: ATE
    outcome: o_totalprice
    treatment_values:
      urgent: {control: 0, case: 1}
    outcome_extra_covariates: []
  - type: CM
    outcome: o_totalprice
    treatment_values:
      urgent: 1
    treatment_confounders:
      urgent: [c_mktsegment]
    outcome_extra_covariates: []
scm:
  outcomes: [o_totalprice]
  treatments: [urgent]
  confounders: [c_mktsegment]
"""

ESTIMATORS = {
    "estimators": {
        "OSE": {
            "type": "ose",
            "models": {"Q_continuous": "saturated", "Q_binary": "saturated", "G": "saturated"},
        }
    }
}


def _text_file(spark, text: str, extension: str) -> str:
    """One small file in the shared folder."""
    path = scratch_path(spark, "config") + f".{extension}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    out.write(bytearray(text, "utf-8"))
    out.close()
    return path


@query(
    "estimand_file",
    union([
        urgent_study(ate(["true"], ["false"])).select("ose", "ATE", digits=D),
        urgent_study(cm("true")).select("ose", "CM", digits=D),
    ]),
)
def estimand_file(spark, sf):
    """Questions and estimators from files: levels 0/1 become false/true, the effect
    gets its confounders from the graph."""
    questions = _text_file(spark, CONFIG_YAML, "yaml")
    estimators = _text_file(spark, json.dumps(ESTIMATORS), "json")
    got = Engine(orders_cohort(spark, sf), questions, estimators)()
    return summary(got, by_idx("ATE", "CM"))


@query(
    "cached_nuisances",
    union([
        urgent_study(ate(["true"], ["false"])).select("tmle", "price", digits=D),
        Study(ORDERS_SQL, "c_acctbal", ("urgent",), (SEG,), ((SEG,),), ate(["true"], ["false"]))
        .select("tmle", "balance", digits=D),
    ]),
)
def cached_nuisances(spark, sf):
    """Two outcomes share one propensity; at most one fit is kept between groups."""
    asked = [
        E.ATE(y, {"urgent": TRUE_FALSE}, {"urgent": [SEG]}) for y in ("o_totalprice", "c_acctbal")
    ]
    engine = Engine(orders_cohort(spark, sf), asked, {"TMLE": TMLE(SATURATED)}, cache=1,
                    sort_estimands=True)
    return summary(engine(), by_idx("price", "balance"))
