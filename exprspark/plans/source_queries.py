"""Queries on published matrices, provenance stages, reserved names, bytes per run and sequences read across intervals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from exprspark.operators import checks, compare, overlap
from exprspark.operators.counts import to_wide
from exprspark.plans.matrix_queries import WITH
from exprspark.plans.registry import query, table
from exprspark.plans.views import SAMPLES, annotation, matrix, merged
from exprspark.session import Workspace
from exprspark.sources.files import PUBLISHED_COLUMNS, read_published_matrix


@query(
    "published_matrix",
    WITH
    + """ SELECT gene_id, p_name AS gene_symbol, p_type AS biotype, CASE WHEN p_size < 5 THEN '' ELSE p_brand END AS chromosome,
             sample_id AS count_column, CAST(count AS VARCHAR) AS count FROM matrix JOIN part ON gene_id = 'P' || p_partkey""",
)
def published_matrix(spark, sf):
    """The matrix written as published, annotation first, and read back as annotation and long counts."""
    ws = Workspace(spark, "published")
    wide = to_wide(merged(spark, sf), SAMPLES).join(annotation(spark, sf), "gene_id")
    named = wide.select(*[F.col(ours).alias(theirs) for theirs, ours in PUBLISHED_COLUMNS.items()], *SAMPLES)
    writer = named.write.mode("errorifexists").option("sep", "\t").option("header", True).option("quoteAll", True)
    writer.option("escape", '"').option("emptyValue", "").csv(ws.folder("matrix"))
    genes, counts = read_published_matrix(spark, ws.folder("matrix"))
    return counts.join(genes, "gene_id").select("gene_id", "gene_symbol", "biotype", "chromosome", "count_column", "count")


@query(
    "bytes_per_run",
    """SELECT 'run' || o_custkey AS run, CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes FROM orders GROUP BY 1""",
)
def bytes_per_run(spark, sf):
    """Orders as the files of an inventory, in a folder per customer."""
    path = F.concat(F.lit("run"), "o_custkey", F.lit("/reads/"), "o_orderkey", F.lit(".fastq")).alias("path")
    return compare.bytes_per_run(table(spark, sf, "orders").select(path, F.floor("o_totalprice").cast("long").alias("bytes")))


@query(
    "reserved_violations",
    """SELECT 'nation' || s_nationkey AS study_id, CAST(s_suppkey AS BIGINT) AS record, 'sample_id' AS "column", 'reserved_id' AS rule, 0 AS rule_order
       FROM supplier WHERE s_suppkey % 7 IN (0, 3)
       UNION ALL SELECT DISTINCT 'nation' || s_nationkey, CAST(1 AS BIGINT), 'PC2', 'reserved_covariate', 1 FROM supplier""",
)
def reserved_violations(spark, sf):
    """Suppliers as samples, a study per nation; some bear a name that result tables need, and so does a covariate."""
    key = F.col("s_suppkey") % 7
    name = F.when(key == 0, "gene_id").when(key == 3, "sample_id").otherwise(F.concat(F.lit("S"), "s_suppkey"))
    study = F.concat(F.lit("nation"), "s_nationkey").alias("study_id")
    return checks.reserved_violations(
        table(spark, sf, "supplier").select(study, F.col("s_suppkey").alias("record"), name.alias("sample_id"), F.col("s_acctbal").alias("PC2"))
    )


@query(
    "read_stage_violations",
    """SELECT 'study' AS study_id, CAST(1 AS BIGINT) AS record, 'C' || c_custkey AS "column", 'not_a_prefix_stage' AS rule, 0 AS rule_order
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
       UNION ALL SELECT 'study', CAST(1 AS BIGINT), 'C' || c_custkey, 'non_prefix_selection', 1 FROM customer WHERE c_nationkey < 5""",
)
def read_stage_violations(spark, sf):
    """Customers as provenance entries: some state another sampling or none, some a selection of their own."""
    segment = F.col("c_mktsegment")
    sampling = F.when(segment == "BUILDING", "every tenth record").when(segment != "MACHINERY", checks.PREFIX_SAMPLING + " seed unused")
    selection = F.when(F.col("c_nationkey") < 5, "longest reads")
    read = F.struct(F.concat(F.lit("C"), "c_custkey").alias("run_id"), selection.alias("selection")).alias("read")
    return checks.read_stage_violations(table(spark, sf, "customer").select(read, sampling.alias("sampling")))


# An order is a sequence line of 32 bases, its customer's orders are a chromosome; a line item reads two intervals of it,
# cut where the chromosome ends. Line items that agree in all keys are one read.
@query(
    "spliced_sequence",
    """WITH lines AS (SELECT o_custkey, o_orderkey, translate(md5(CAST(o_orderkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS bases FROM orders),
            chroms AS (SELECT o_custkey, string_agg(bases, '' ORDER BY o_orderkey) AS whole FROM lines GROUP BY 1),
            r AS (SELECT DISTINCT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS read_id, l_returnflag,
                         substr(whole, 1 + l_partkey % 8, 12) || substr(whole, 21 + l_suppkey % 9, 40) AS bases
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN chroms USING (o_custkey))
       SELECT read_id, CASE WHEN l_returnflag = 'R' THEN reverse(translate(bases, 'ACGT', 'TGCA')) ELSE bases END AS expected FROM r""",
)
def spliced_sequence(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    chrom = F.concat(F.lit("C"), "o_custkey").alias("chrom")
    place = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).cast("long").alias("chunk")
    bases = F.translate(F.md5(F.col("o_orderkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("bases")
    chunks = orders.select(chrom, place, F.lit(32).alias("width"), bases)
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")

    def interval(start, length):
        return F.struct(start.cast("long").alias("start"), (start + length - 1).cast("long").alias("end"))

    # Distinct by the keys themselves, which the join has dealt already.
    keyed = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey").distinct()
    origins = keyed.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("read_id"),
        chrom,
        F.array(interval(1 + F.col("l_partkey") % 8, 12), interval(21 + F.col("l_suppkey") % 9, 40)).alias("intervals"),
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("orientation"),
    )
    return overlap.spliced_sequence(origins, Workspace(spark, "chunks").save(chunks, "chunks"))


@query(
    "cohort_matrix_violations",
    WITH
    + """, n AS (SELECT CAST(substr(gene_id, 2) AS BIGINT) AS record, sample_id FROM matrix)
    SELECT record, sample_id AS "column", CASE record % 50 WHEN 0 THEN 'not_a_count' ELSE 'beyond_int32' END AS rule FROM n WHERE record % 50 < 2
    UNION ALL SELECT DISTINCT record, 'gene_id', 'repeated_gene' FROM n WHERE record % 100 = 7 AND record - 1 IN (SELECT record FROM n)
    UNION ALL SELECT 1, 'S7', 'unknown_count_column' UNION ALL SELECT 1, 'S9', 'missing_count_column'
    UNION ALL SELECT 1, 'treated', 'missing_condition'""",
)
def cohort_matrix_violations(spark, sf):
    """The matrix with planted faults: odd counts, genes named as their neighbour, a renamed sample and one condition only."""
    number = F.substring("gene_id", 2, 20).cast("long")
    gene = F.when(number % 100 == 7, F.concat(F.lit("P"), number - 1)).otherwise(F.col("gene_id"))
    count = F.when(number % 50 == 0, "x1").when(number % 50 == 1, "2147483648").otherwise(F.col("count").cast("string"))
    cells = matrix(spark, sf).select(number.alias("record"), gene.alias("gene_id"), F.col("sample_id").alias("count_column"), count.alias("count"))
    line = F.when(F.col("l_linenumber") == 7, 9).otherwise(F.col("l_linenumber"))
    samples = table(spark, sf, "lineitem").select(F.concat(F.lit("S"), line).alias("count_column"), F.lit("control").alias("condition")).distinct()
    return checks.cohort_matrix_violations(cells, samples, ("control", "treated")).select("record", "column", "rule")
