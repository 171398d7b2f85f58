"""Constraint checks over manifests read from the standard tables; each query lists every violation."""

from __future__ import annotations

from pyspark.sql import functions as F

from exprspark.operators import checks, cohort, compare
from exprspark.plans.registry import query, table
from exprspark.plans.views import RUN_COUNTS_SQL, annotation, merged, run_manifest, universe

REPORT = ["study_id", "record", "column", "rule"]


def report(violations):
    return violations.select(*REPORT)


CUSTOMER_SQL = """s AS (
  SELECT 'N' || c_nationkey AS study_id, c_custkey AS record,
    CASE WHEN c_acctbal < 0 THEN '-' || c_custkey WHEN c_mktsegment = 'BUILDING' THEN 'C' || (c_custkey // 50) ELSE 'C_' || c_custkey END AS sample_id,
    CASE WHEN c_acctbal > 9000 THEN '' ELSE c_mktsegment END AS condition FROM customer)"""


def customer_samples(spark, sf):
    key = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("study_id"),
        F.col("c_custkey").alias("record"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("-"), key))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("C"), F.expr("c_custkey div 50").cast("string")))
        .otherwise(F.concat(F.lit("C_"), key))
        .alias("sample_id"),
        F.when(F.col("c_acctbal") > 9000, "").otherwise(F.col("c_mktsegment")).alias("condition"),
    )


@query(
    "sample_violations",
    f"""WITH {CUSTOMER_SQL} SELECT study_id, record, 'sample_id' AS "column", 'invalid_id' AS rule FROM s WHERE NOT regexp_full_match(sample_id, '[A-Za-z0-9][A-Za-z0-9_.-]*')
    UNION ALL SELECT study_id, record, 'condition', 'empty_cell' FROM s WHERE condition = ''
    UNION ALL SELECT study_id, record, 'sample_id', 'repeated_id' FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY study_id, sample_id ORDER BY record) AS k FROM s) WHERE k > 1
    UNION ALL SELECT study_id, 1, 'sample_id', 'no_samples' FROM (SELECT DISTINCT 'N' || n_nationkey AS study_id FROM nation) WHERE study_id NOT IN (SELECT study_id FROM s)""",
)
def sample_violations(spark, sf):
    studies = table(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("study_id"))
    return report(checks.sample_violations(customer_samples(spark, sf), studies))


RUNS_SQL = """s AS (SELECT c_custkey AS record, 'C' || c_custkey AS sample_id FROM customer),
r AS (SELECT o_orderkey AS record,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'R' || (o_orderkey // 2) WHEN o_totalprice < 3000 THEN '_' || o_orderkey ELSE 'R' || o_orderkey END AS run_id,
    CASE WHEN o_totalprice > 480000 THEN 'X' || o_custkey ELSE 'C' || o_custkey END AS sample_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'paired' WHEN '5-LOW' THEN 'both' ELSE 'single' END AS layout,
    CASE o_orderstatus WHEN 'F' THEN 'forward' WHEN 'O' THEN 'reverse' ELSE 'unstranded' END AS strandedness,
    CASE WHEN o_totalprice < 2000 THEN '' ELSE 'r' || o_orderkey END AS fastq_1,
    CASE WHEN o_totalprice > 400000 THEN 'r' || o_orderkey WHEN o_totalprice > 300000 THEN 'm' || o_orderkey ELSE '' END AS fastq_2 FROM orders),
f AS (SELECT sample_id, arg_min(layout, record) AS layout, arg_min(strandedness, record) AS strandedness FROM r GROUP BY 1)"""


def order_runs(spark, sf):
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice")
    low = F.col("o_orderpriority") == "5-LOW"
    customer = F.col("o_custkey").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("record"),
        F.when((F.col("o_orderstatus") == "P") & low, F.concat(F.lit("R"), F.expr("o_orderkey div 2").cast("string")))
        .when(price < 3000, F.concat(F.lit("_"), key))
        .otherwise(F.concat(F.lit("R"), key))
        .alias("run_id"),
        F.when(price > 480000, F.concat(F.lit("X"), customer)).otherwise(F.concat(F.lit("C"), customer)).alias("sample_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "paired").when(low, "both").otherwise("single").alias("layout"),
        F.when(F.col("o_orderstatus") == "F", "forward").when(F.col("o_orderstatus") == "O", "reverse").otherwise("unstranded").alias("strandedness"),
        F.when(price < 2000, "").otherwise(F.concat(F.lit("r"), key)).alias("fastq_1"),
        F.when(price > 400000, F.concat(F.lit("r"), key)).when(price > 300000, F.concat(F.lit("m"), key)).otherwise("").alias("fastq_2"),
    )


def plain_samples(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("record"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("sample_id"),
        F.col("c_mktsegment").alias("condition"),
    )


def _run_rule(where: str, column: str, rule: str, source: str = "r") -> str:
    return f"SELECT 'study' AS study_id, {source}.record, '{column}' AS \"column\", '{rule}' AS rule FROM {where}"


@query(
    "run_mapping_violations",
    f"WITH {RUNS_SQL} "
    + " UNION ALL ".join(
        [
            _run_rule("r WHERE NOT regexp_full_match(run_id, '[A-Za-z0-9][A-Za-z0-9_.-]*')", "run_id", "invalid_id"),
            _run_rule("r WHERE layout = 'both'", "layout", "not_allowed"),
            _run_rule("r WHERE fastq_1 = ''", "fastq_1", "empty_path"),
            _run_rule("r WHERE layout = 'single' AND fastq_2 <> ''", "fastq_2", "second_file_of_single"),
            _run_rule("r WHERE layout = 'paired' AND fastq_2 = ''", "fastq_2", "empty_path"),
            _run_rule("r WHERE layout = 'paired' AND fastq_2 = fastq_1 AND fastq_2 <> ''", "fastq_2", "same_file_twice"),
            _run_rule("(SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY record) AS k FROM r) r WHERE k > 1", "run_id", "repeated_id"),
            _run_rule("r WHERE sample_id NOT IN (SELECT sample_id FROM s)", "sample_id", "unknown_sample"),
            _run_rule("s WHERE sample_id NOT IN (SELECT sample_id FROM r)", "sample_id", "sample_without_run", "s"),
            _run_rule("r JOIN f USING (sample_id) WHERE r.layout <> f.layout", "layout", "mixed_layout"),
            _run_rule("r JOIN f USING (sample_id) WHERE r.strandedness <> f.strandedness", "strandedness", "mixed_strandedness"),
        ]
    ),
)
def run_mapping_violations(spark, sf):
    return report(checks.run_violations(plain_samples(spark, sf), order_runs(spark, sf)))


# One study per supplier; its nation decides which settings are wrong.
SETTINGS_SQL = """
SELECT 'V' || s_suppkey AS study_id, CAST(r AS BIGINT) AS record, c AS "column", rule FROM supplier, (VALUES
  (1, 1, 'value', 'version_must_be_1'), (2, 3, 'value', 'alpha_out_of_range'), (3, 4, 'value', 'filter_must_be_zero_total'),
  (4, 1, 'shrinkage', 'missing_setting'), (5, 6, 'value', 'not_a_type'), (6, 7, 'key', 'unknown_setting'),
  (7, 8, 'key', 'names_absent_covariate'), (8, 7, 'key', 'repeated_key'), (9, 7, 'key', 'empty_key'), (10, 3, 'value', 'alpha_out_of_range')
) AS v(n, r, c, rule) WHERE s_nationkey = n"""


def supplier_settings(spark, sf):
    nation = F.col("s_nationkey")

    def pair(record, key, value):
        key = F.lit(key) if isinstance(key, str) else key
        value = F.lit(value) if isinstance(value, str) else value
        return F.struct(F.lit(record).alias("record"), key.alias("key"), value.alias("value"))

    extra = F.when(nation == 6, "colour").when(nation == 8, "version").when(nation == 9, "")
    rows = F.array(
        pair(1, "version", F.when(nation == 1, "2").otherwise("1")),
        pair(2, "design_terms", "batch,condition"),
        pair(3, "alpha", F.when(nation == 2, "1.5").when(nation == 10, "NaN").otherwise("5e-2")),
        pair(4, "filter", F.when(nation == 3, "none").otherwise("zero_total")),
        pair(5, F.when(nation != 4, "shrinkage"), "apeglm"),
        pair(6, "type.batch", F.when(nation == 5, "ordinal").otherwise("categorical")),
        pair(7, extra, "1"),
        pair(8, F.when(nation == 7, "type.age"), "numeric"),
        pair(9, F.when(nation != 14, "reference.batch"), F.when(nation == 15, "Z").otherwise("A")),
    )
    study = F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("study_id")
    return table(spark, sf, "supplier").select(study, F.inline(rows)).filter("key is not null")


def supplier_covariates(spark, sf):
    """Four samples per supplier study: two conditions crossed with two batches."""
    nation = F.col("s_nationkey")
    cells = []
    for i, (condition, batch) in enumerate([("control", "A"), ("control", "B"), ("treated", "A"), ("treated", "B")]):
        level = F.when((nation == 16) & F.lit(batch == "B"), "A").when((nation == 17) & F.lit(i == 2), "").otherwise(batch)
        weight = F.when((nation == 18) & F.lit(i == 1), "1e999").otherwise(str(i + 0.5))
        for name, value in (("condition", F.lit(condition)), ("batch", level), ("weight", weight)):
            cells.append(F.struct(F.lit(i + 1).alias("record"), F.lit(f"s{i}").alias("sample_id"), F.lit(name).alias("name"), value.alias("value")))
    study = F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("study_id")
    return table(spark, sf, "supplier").select(study, F.inline(F.array(*cells)))


@query("setting_violations", SETTINGS_SQL)
def setting_violations(spark, sf):
    return report(checks.setting_violations(supplier_settings(spark, sf), supplier_covariates(spark, sf)))


@query(
    "covariate_violations",
    """SELECT 'V' || s_suppkey AS study_id, CAST(1 AS BIGINT) AS record, 'weight' AS "column", 'untyped_covariate' AS rule FROM supplier WHERE s_nationkey = 19
       UNION ALL SELECT 'V' || s_suppkey, 3, 'batch', 'empty_category' FROM supplier WHERE s_nationkey = 17
       UNION ALL SELECT 'V' || s_suppkey, 2, 'weight', 'not_a_finite_decimal' FROM supplier WHERE s_nationkey = 18""",
)
def covariate_violations(spark, sf):
    types = checks.covariate_types(supplier_settings(spark, sf))
    weight = table(spark, sf, "supplier").filter("s_nationkey <> 19").select(
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("study_id"), F.lit("weight").alias("name"), F.lit("numeric").alias("type")
    )
    return report(checks.covariate_violations(supplier_covariates(spark, sf), types.unionByName(weight)))


@query(
    "design_violations",
    """SELECT 'V' || s_suppkey AS study_id, CAST(9 AS BIGINT) AS record, 'value' AS "column", 'reference_not_observed' AS rule FROM supplier WHERE s_nationkey = 15
       UNION ALL SELECT 'V' || s_suppkey, 9, 'key', 'reference_not_categorical' FROM supplier WHERE s_nationkey = 5""",
)
def design_violations(spark, sf):
    settings, covariates = supplier_settings(spark, sf), supplier_covariates(spark, sf)
    return report(checks.design_violations(settings, covariates, checks.covariate_types(settings)))


@query(
    "contrast_violations",
    """SELECT 'V' || s_suppkey AS study_id, CAST(r AS BIGINT) AS record, c AS "column", rule FROM supplier, (VALUES
         (20, 2, 'contrast_id', 'repeated_id'), (21, 2, 'numerator', 'same_level_twice'), (22, 2, 'factor', 'not_a_design_term'),
         (22, 2, 'factor', 'not_categorical'), (23, 1, 'denominator', 'level_not_observed'), (24, 1, 'contrast_id', 'invalid_id'),
         (5, 2, 'factor', 'not_categorical'), (15, 2, 'denominator', 'disagrees_with_reference'), (16, 2, 'numerator', 'level_not_observed'),
         (22, 2, 'numerator', 'level_not_observed'), (22, 2, 'denominator', 'level_not_observed')
       ) AS v(n, r, c, rule) WHERE s_nationkey = n
       UNION ALL SELECT 'V' || s_suppkey, 2, 'denominator', 'disagrees_with_reference' FROM supplier WHERE s_nationkey = 21""",
)
def contrast_violations(spark, sf):
    nation = F.col("s_nationkey")
    rows = F.array(
        F.struct(
            F.lit(1).alias("record"), F.when(nation == 24, "../c1").otherwise("c1").alias("contrast_id"), F.lit("condition").alias("factor"),
            F.lit("treated").alias("numerator"), F.when(nation == 23, "placebo").otherwise("control").alias("denominator"),
        ),
        F.struct(
            F.lit(2).alias("record"), F.when(nation == 20, "c1").otherwise("c2").alias("contrast_id"),
            F.when(nation == 22, "weightless").otherwise("batch").alias("factor"), F.lit("B").alias("numerator"),
            F.when(nation == 21, "B").otherwise("A").alias("denominator"),
        ),
    )
    study = F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("study_id")
    contrasts = table(spark, sf, "supplier").select(study, F.inline(rows))
    settings, covariates = supplier_settings(spark, sf), supplier_covariates(spark, sf)
    types = checks.covariate_types(settings)
    return report(checks.contrast_violations(contrasts, settings, covariates, types))


@query(
    "observed_levels",
    """SELECT 'N' || c_nationkey AS study_id, 'condition' AS name,
              array_to_string(list_sort(list_distinct(list(CASE WHEN c_acctbal > 9000 THEN '' ELSE c_mktsegment END))), '|') AS levels FROM customer GROUP BY 1""",
)
def observed_levels(spark, sf):
    covariates = checks.covariates_long(customer_samples(spark, sf))
    types = covariates.select("study_id", "name", F.lit("categorical").alias("type")).distinct()
    return cohort.observed_levels(covariates, types).withColumn("levels", F.array_join("levels", "|"))


@query(
    "matrix_violations",
    """WITH cells AS (SELECT l_orderkey AS record, CASE WHEN l_tax > 0.075 THEN '' ELSE 'P' || l_partkey END AS gene_id,
           CASE WHEN l_linenumber = 7 THEN '7th line' ELSE 'S' || l_linenumber END AS sample_id,
           CASE WHEN l_discount > 0.095 THEN '-1' WHEN l_discount < 0.005 THEN '1.0' WHEN l_quantity > 49 THEN '18446744073709551616' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS count FROM lineitem),
       genes AS (SELECT DISTINCT record, gene_id FROM cells)
       SELECT 'study' AS study_id, CAST(1 AS BIGINT) AS record, sample_id AS "column", 'invalid_id' AS rule FROM (SELECT DISTINCT sample_id FROM cells WHERE sample_id = '7th line')
       UNION ALL SELECT 'study', record, 'gene_id', 'empty_gene' FROM genes WHERE gene_id = ''
       UNION ALL SELECT 'study', record, 'gene_id', 'repeated_gene' FROM (SELECT *, MIN(record) OVER (PARTITION BY gene_id) AS m FROM genes) WHERE record > m
       UNION ALL SELECT 'study', record, sample_id, 'not_a_count' FROM cells WHERE NOT regexp_full_match(count, '[0-9]+') OR count = '18446744073709551616'""",
)
def matrix_violations(spark, sf):
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    cells = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("record"),
        F.when(F.col("l_tax") > 0.075, "").otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("gene_id"),
        F.when(F.col("l_linenumber") == 7, "7th line").otherwise(F.concat(F.lit("S"), F.col("l_linenumber").cast("string"))).alias("sample_id"),
        F.when(F.col("l_discount") > 0.095, "-1").when(F.col("l_discount") < 0.005, "1.0")
        .when(F.col("l_quantity") > 49, "18446744073709551616").otherwise(quantity).alias("count"),
    )
    return report(checks.matrix_violations(cells))


@query(
    "int32_violations",
    f"""WITH {RUN_COUNTS_SQL} SELECT 'study' AS study_id, count AS record, sample_id AS "column", 'beyond_int32' AS rule
        FROM merged WHERE count * 20000000 > 2147483647""",
)
def int32_violations(spark, sf):
    scaled = merged(spark, sf).select("gene_id", "sample_id", F.col("count").alias("record"), (F.col("count") * 20000000).alias("count"))
    return report(checks.int32_violations(scaled))


@query(
    "column_order_violations",
    """WITH have AS (SELECT c_custkey AS ordinal, 'C' || CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey + 1 ELSE c_custkey END AS h FROM customer WHERE c_acctbal >= 0),
            want AS (SELECT c_custkey AS ordinal, 'C' || c_custkey AS w FROM customer)
       SELECT 'study' AS study_id, ordinal AS record, COALESCE(h, w) AS "column", 'column_order' AS rule
       FROM have FULL JOIN want USING (ordinal) WHERE h IS DISTINCT FROM w""",
)
def column_order_violations(spark, sf):
    customer = table(spark, sf, "customer")
    shifted = F.col("c_custkey") + (F.col("c_mktsegment") == "BUILDING").cast("int")
    have = customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit("C"), shifted.cast("string")).alias("sample_id"))
    want = customer.select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("sample_id"))
    return report(checks.column_order_violations(have, want))


@query(
    "annotation_violations",
    """WITH a AS (SELECT p_partkey AS record, CASE p_size WHEN 1 THEN '' WHEN 2 THEN 'Q' || p_partkey WHEN 3 THEN 'P' || (p_partkey // 2) ELSE 'P' || p_partkey END AS gene_id FROM part),
            u AS (SELECT 'P' || p_partkey AS gene_id FROM part)
       SELECT 'study' AS study_id, record, 'gene_id' AS "column", 'empty_gene' AS rule FROM a WHERE gene_id = ''
       UNION ALL SELECT 'study', record, 'gene_id', 'unknown_gene' FROM a WHERE gene_id NOT IN (SELECT gene_id FROM u)
       UNION ALL SELECT 'study', record, 'gene_id', 'repeated_gene' FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene_id ORDER BY record) AS k FROM a) WHERE k > 1""",
)
def annotation_violations(spark, sf):
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size")
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("record"),
        F.when(size == 1, "").when(size == 2, F.concat(F.lit("Q"), key))
        .when(size == 3, F.concat(F.lit("P"), F.expr("p_partkey div 2").cast("string"))).otherwise(F.concat(F.lit("P"), key)).alias("gene_id"),
    )
    return report(checks.annotation_violations(rows, universe(spark, sf)))


@query(
    "input_violations",
    """WITH i AS (SELECT o_orderkey AS record, CASE WHEN o_totalprice > 480000 THEN 'U' || o_orderkey WHEN o_totalprice < 5000 THEN 'R' || (o_orderkey // 2) ELSE 'R' || o_orderkey END AS run_id,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'featurecounts' WHEN '2-HIGH' THEN 'legacy' WHEN '3-MEDIUM' THEN 'bam' ELSE 'tsv' END AS format,
            CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'p' END AS path, CASE WHEN o_orderstatus = 'P' THEN 'c' ELSE '' END AS col FROM orders),
       r AS (SELECT 'R' || o_orderkey AS run_id FROM orders)
       SELECT 'study' AS study_id, record, 'format' AS "column", 'not_allowed' AS rule FROM i WHERE format = 'bam'
       UNION ALL SELECT 'study', record, 'column', 'empty_cell' FROM i WHERE format = 'featurecounts' AND col = ''
       UNION ALL SELECT 'study', record, 'column', 'column_not_expected' FROM i WHERE format <> 'featurecounts' AND col <> ''
       UNION ALL SELECT 'study', record, 'path', 'empty_path' FROM i WHERE path = ''
       UNION ALL SELECT 'study', record, 'run_id', 'unknown_run' FROM i WHERE run_id NOT IN (SELECT run_id FROM r)
       UNION ALL SELECT 'study', record, 'run_id', 'repeated_run' FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY record) AS k FROM i) WHERE k > 1
       UNION ALL SELECT 'study', 1, run_id, 'run_without_input' FROM r WHERE run_id NOT IN (SELECT run_id FROM i)""",
)
def input_violations(spark, sf):
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice")
    orders = table(spark, sf, "orders")
    kind = F.col("o_orderpriority")
    inputs = orders.select(
        F.col("o_orderkey").alias("record"),
        F.when(price > 480000, F.concat(F.lit("U"), key)).when(price < 5000, F.concat(F.lit("R"), F.expr("o_orderkey div 2").cast("string")))
        .otherwise(F.concat(F.lit("R"), key)).alias("run_id"),
        F.when(kind == "1-URGENT", "featurecounts").when(kind == "2-HIGH", "legacy").when(kind == "3-MEDIUM", "bam").otherwise("tsv").alias("format"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise("p").alias("path"),
        F.when(F.col("o_orderstatus") == "P", "c").otherwise("").alias("column"),
    )
    return report(checks.input_violations(inputs, orders.select(F.concat(F.lit("R"), key).alias("run_id"))))


@query(
    "reference_violations",
    """WITH r AS (SELECT 'D' || lang || source AS study_id, doc_id AS record, CASE WHEN n_chars % 3 = 0 THEN 'genome' WHEN n_chars % 3 = 1 THEN 'annotation' ELSE 'index' END AS role,
              CASE WHEN n_chars % 7 = 0 THEN '' ELSE source END AS source, CASE WHEN n_chars % 11 = 0 THEN '' ELSE lang END AS release,
              CASE WHEN n_chars % 5 = 0 THEN md5(text) ELSE upper(sha256(text)) END AS sha256 FROM documents)
       SELECT study_id, record, 'role' AS "column", 'not_allowed' AS rule FROM r WHERE role = 'index'
       UNION ALL SELECT study_id, record, 'source', 'empty_cell' FROM r WHERE source = ''
       UNION ALL SELECT study_id, record, 'release', 'empty_cell' FROM r WHERE release = ''
       UNION ALL SELECT study_id, record, 'sha256', 'not_a_digest' FROM r WHERE length(sha256) <> 64
       UNION ALL SELECT study_id, record, 'role', 'repeated_role' FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY study_id, role ORDER BY record) AS k FROM r) WHERE k > 1
       UNION ALL SELECT study_id, 1, 'role', 'missing_' || want FROM (SELECT DISTINCT study_id FROM r) CROSS JOIN (VALUES ('genome'), ('annotation')) v(want)
         WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.study_id = r.study_id AND x.role = want)""".replace(
        "FROM (SELECT DISTINCT study_id FROM r) CROSS JOIN", "FROM (SELECT DISTINCT study_id FROM r) r CROSS JOIN"
    ),
)
def reference_violations(spark, sf):
    n = F.col("n_chars")
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("D"), F.col("lang"), F.col("source")).alias("study_id"),
        F.col("doc_id").alias("record"),
        F.when(n % 3 == 0, "genome").when(n % 3 == 1, "annotation").otherwise("index").alias("role"),
        F.when(n % 7 == 0, "").otherwise(F.col("source")).alias("source"),
        F.when(n % 11 == 0, "").otherwise(F.col("lang")).alias("release"),
        F.when(n % 5 == 0, F.md5("text")).otherwise(F.upper(F.sha2("text", 256))).alias("sha256"),
        F.lit("reference.fa").alias("path"),
    )
    return report(checks.reference_violations(rows))


@query(
    "run_pair_violations",
    """WITH seen AS (SELECT l_linestatus AS backend, l_linenumber AS "repeat", COUNT(*) AS n,
                            COUNT(*) FILTER (l_quantity > 49 AND l_linenumber = 2) AS failed FROM lineitem GROUP BY ALL),
            wanted AS (SELECT b AS backend, CAST(r AS INTEGER) AS "repeat" FROM (VALUES ('O'), ('F'), ('G')) v(b), range(1, 6) t(r))
       SELECT backend, "repeat", CASE WHEN n IS NULL THEN 'missing' WHEN w IS NULL THEN 'unexpected' WHEN n > 1 THEN 'repeated' ELSE 'failed' END AS rule
       FROM (SELECT *, TRUE AS w FROM wanted) FULL JOIN seen USING (backend, "repeat") WHERE n IS NULL OR w IS NULL OR n > 1 OR failed > 0""",
)
def run_pair_violations(spark, sf):
    runs = table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("backend"), F.col("l_linenumber").alias("repeat"),
        ((F.col("l_quantity") > 49) & (F.col("l_linenumber") == 2)).cast("int").alias("status"),
    )
    return compare.run_pair_violations(runs, ["O", "F", "G"], 5)


@query(
    "cohort_violations",
    """WITH s AS (SELECT c_custkey AS record, 'SRX' || c_custkey AS experiment FROM customer),
            r AS (SELECT o_orderkey AS record, 'SRX' || o_custkey AS experiment, o_orderstatus AS layout FROM orders)
       SELECT 'study' AS study_id, MAX(record) AS record, 'sample_id' AS "column", 'cohort_size' AS rule FROM s HAVING COUNT(*) <> 36
       UNION ALL SELECT 'study', record, 'experiment', 'repeated_experiment' FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY experiment ORDER BY record) AS k FROM r) WHERE k > 1
       UNION ALL SELECT 'study', record, 'experiment', 'sample_without_run' FROM s WHERE experiment NOT IN (SELECT experiment FROM r)
       UNION ALL SELECT 'study', record, 'experiment', 'run_without_sample' FROM r WHERE experiment NOT IN (SELECT experiment FROM s)
       UNION ALL SELECT 'study', record, 'library_layout', 'unexpected_value' FROM r WHERE layout <> 'F'""",
)
def cohort_violations(spark, sf):
    samples = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("record"), F.concat(F.lit("SRX"), F.col("c_custkey").cast("string")).alias("experiment")
    )
    runs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("record"), F.concat(F.lit("SRX"), F.col("o_custkey").cast("string")).alias("experiment_accession"),
        F.col("o_orderstatus").alias("library_layout"),
    )
    return report(checks.cohort_violations(samples, runs, {"library_layout": "F"}, 36))


@query(
    "cohort_summary",
    """SELECT c_mktsegment AS condition, COUNT(*) AS n, ROUND(AVG(c_acctbal), 4) AS balance_mean, ROUND(STDDEV_SAMP(c_acctbal), 4) AS balance_sd,
              COUNT(*) FILTER (n_regionkey = 0) AS region_0, COUNT(*) FILTER (n_regionkey = 1) AS region_1
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def cohort_summary(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("string").alias("region"))
    samples = table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_mktsegment").alias("condition"), F.col("c_acctbal").alias("balance"), "region"
    )
    found = cohort.covariate_summary(samples, "condition", ["balance"], "region", ["0", "1"])
    return found.withColumns({c: F.round(c, 4) for c in ("balance_mean", "balance_sd")})


COHORTS_SQL = """members AS (
  SELECT 'full' AS cohort, s_suppkey FROM supplier UNION ALL SELECT 'without', s_suppkey FROM supplier WHERE s_nationkey <> 4
  UNION ALL SELECT 'subset', s_suppkey FROM supplier WHERE s_acctbal > 5000)"""


@query(
    "cohort_counts",
    f"""WITH {COHORTS_SQL} SELECT cohort, 'P' || l_partkey AS gene_id, COUNT(DISTINCT s_suppkey) AS samples, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count
        FROM members JOIN lineitem ON s_suppkey = l_suppkey GROUP BY ALL""",
)
def cohort_counts(spark, sf):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sample_id"), "s_nationkey", "s_acctbal")
    members = cohort.cohort_members(supplier, supplier.filter("s_nationkey = 4").select("sample_id"), supplier.filter("s_acctbal > 5000").select("sample_id"))
    items = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("gene_id"), F.col("l_suppkey").alias("sample_id"), F.col("l_quantity").cast("bigint").alias("count")
    )
    totals = cohort.cohort_totals(items, members)
    return totals.select("cohort", F.concat(F.lit("P"), F.col("gene_id").cast("string")).alias("gene_id"), "samples", "count")


@query(
    "cohort_projection",
    f"""WITH {RUN_COUNTS_SQL} SELECT gene_id, 'renamed_' || sample_id AS sample_id, count FROM merged WHERE sample_id IN ('S2', 'S5', 'S6')""",
)
def cohort_projection(spark, sf):
    from exprspark.operators.counts import project_cohort

    picked = run_manifest(spark, sf).select("sample_id").distinct().filter(F.col("sample_id").isin("S2", "S5", "S6"))
    members = picked.select(F.col("sample_id").alias("count_column"), F.concat(F.lit("renamed_"), "sample_id").alias("sample_id"))
    return project_cohort(merged(spark, sf).withColumnRenamed("sample_id", "count_column"), members).select("gene_id", "sample_id", "count")


@query(
    "ordered_lookup",
    """SELECT c_custkey AS ordinal, 'C' || c_custkey AS sample_id, n AS runs FROM customer
       LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""",
)
def ordered_lookup(spark, sf):
    samples = table(spark, sf, "customer").select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("sample_id"))
    mapping = table(spark, sf, "orders").groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("sample_id")).agg(F.count(F.lit(1)).alias("runs"))
    return cohort.lookup_in_order(samples, mapping).select("ordinal", "sample_id", "runs")


@query(
    "annotation_projection",
    """SELECT 'P' || p_partkey AS gene_id, p_name AS gene_symbol, p_type AS biotype, CASE WHEN p_size < 5 THEN '' ELSE p_brand END AS chromosome FROM part""",
)
def annotation_projection(spark, sf):
    return annotation(spark, sf)


@query(
    "last_wins_annotation",
    """SELECT gene_id, l_returnflag AS gene_symbol, l_linestatus AS biotype, 'S' || l_suppkey AS chromosome FROM (
         SELECT 'P' || l_partkey AS gene_id, *, ROW_NUMBER() OVER (PARTITION BY l_partkey
           ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS k FROM lineitem) WHERE k = 1""",
)
def last_wins_annotation(spark, sf):
    """Line items as exon rows: the last row of a part in order decides its annotation."""
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene_id"),
        F.col("l_returnflag").alias("gene_symbol"), F.col("l_linestatus").alias("biotype"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("chrom"),
        F.col("l_orderkey").alias("source"), F.struct("l_linenumber", "l_suppkey", "l_extendedprice").alias("record"),
    )
    return cohort.annotation_from_exons(rows)
