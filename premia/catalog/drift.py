"""Queries over distribution drift. Line items shipped before 1998 are the reference, the rest current."""

from __future__ import annotations

from pyspark.sql import functions as F

from premia.catalog import tables as T
from premia.catalog.registry import query
from premia.operators.drift import (
    bin_counts,
    drift_coverage,
    drift_report,
    drift_summary,
    edges_frame,
    psi,
    quantile_edges,
)
from premia.operators.quantiles import evenly_spaced
from premia.session import scratch_path
from premia.spec import (
    PSI_BINS,
    PSI_THRESHOLD,
)
from premia.streaming.drift import store_baseline, stream_drift_counts, stream_drift_report

# Price shifts with the date, l_linenumber has few distinct values, "flat" is constant.
_FEATURES = ["price", "quantity", "line", "flat", "gappy"]
_VALUES = """l_shipdate, l_extendedprice * year(l_shipdate) / 1995 AS price, l_quantity AS quantity,
    CAST(l_linenumber AS DOUBLE) AS line, CAST(3 AS DOUBLE) AS flat,
    CASE WHEN l_discount > 0.02 THEN l_discount * l_quantity END AS gappy"""


def _sides(spark, folder):
    rows = T.table(spark, folder, "lineitem").selectExpr(*_split_columns(_VALUES))
    cut = F.year("l_shipdate") < 1998
    return rows.where(cut).drop("l_shipdate"), rows.where(~cut).drop("l_shipdate")


def _split_columns(text):
    return [c.strip() for c in text.split(",")]


_LEVELS = ", ".join(f"{q!r}::DOUBLE" for q in evenly_spaced(PSI_BINS))
# Linear interpolation between the two neighbouring values, from the nearer one, as numpy does it.
_EDGES = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, CASE WHEN t >= 0.5 THEN b - (b - a) * (1 - t) ELSE a + (b - a) * t END AS edge
  FROM (SELECT p - floor(p) AS t, vs[CAST(floor(p) AS BIGINT) + 1] AS a, vs[CAST(ceil(p) AS BIGINT) + 1] AS b
        FROM (SELECT vs, unnest([{_LEVELS}]) * (len(vs) - 1) AS p
              FROM (SELECT list_sort(list({f})) AS vs FROM side WHERE is_reference AND {f} IS NOT NULL)))"""
    for f in _FEATURES
)
_LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, is_reference, {f} AS value FROM side WHERE {f} IS NOT NULL" for f in _FEATURES
)
_PSI_SQL = f"""WITH side AS (SELECT year(l_shipdate) < 1998 AS is_reference, {_VALUES} FROM lineitem),
edges AS (
  SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS edge_no,
         count(*) OVER (PARTITION BY feature) AS n_edges
  FROM (SELECT DISTINCT feature, edge FROM ({_EDGES}))),
long AS ({_LONG}),
inner_edges AS (
  SELECT feature, list(edge) AS cuts FROM edges WHERE edge_no > 0 AND edge_no < n_edges - 1 GROUP BY feature),
binned AS (
  SELECT l.feature, is_reference, len(list_filter(coalesce(cuts, []), lambda e: e <= value)) AS bin
  FROM long l LEFT JOIN inner_edges i USING (feature)),
grid AS (SELECT feature, edge_no AS bin FROM edges WHERE edge_no < n_edges - 1),
counts AS (
  SELECT g.feature, g.bin, count(*) FILTER (is_reference) AS n_reference,
         count(*) FILTER (NOT is_reference) AS n_current
  FROM grid g LEFT JOIN binned b ON b.feature = g.feature AND b.bin = g.bin GROUP BY ALL),
shares AS (
  SELECT feature, greatest(n_reference / sum(n_reference) OVER (PARTITION BY feature), 1e-6) AS r,
         greatest(n_current / sum(n_current) OVER (PARTITION BY feature), 1e-6) AS c FROM counts),
measured AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature),
report AS (
  SELECT f.feature, coalesce(psi, 0.0) AS psi, coalesce(psi, 0.0) > {PSI_THRESHOLD} AS drifted
  FROM (SELECT unnest({_FEATURES}) AS feature) f LEFT JOIN measured USING (feature))"""


@query("quantile_edges", _PSI_SQL + """
SELECT feature, CAST(edge_no AS BIGINT) AS edge_no, round(edge, 6) AS edge FROM edges""")
def quantile_edges_query(spark, folder):
    reference, _ = _sides(spark, folder)
    edges = edges_frame(spark, quantile_edges(reference, _FEATURES))
    return edges.withColumns(
        {"edge_no": F.col("edge_no").cast("long"), "edge": F.round("edge", 6)}
    )


@query("bin_counts", _PSI_SQL + """
SELECT feature, CAST(bin AS BIGINT) AS bin, n_reference, n_current FROM counts""")
def bin_counts_query(spark, folder):
    reference, current = _sides(spark, folder)
    counts = bin_counts(reference, current, quantile_edges(reference, _FEATURES))
    return counts.withColumn("bin", F.col("bin").cast("long"))


@query("psi", _PSI_SQL + " SELECT feature, round(psi, 6) AS psi FROM report")
def psi_query(spark, folder):
    return psi(*_sides(spark, folder), _FEATURES).withColumn("psi", F.round("psi", 6))


@query("drift_report", _PSI_SQL + " SELECT feature, round(psi, 5) AS psi, drifted FROM report")
def drift_report_query(spark, folder):
    return drift_report(*_sides(spark, folder), _FEATURES).withColumn("psi", F.round("psi", 5))


@query("drift_gate", _PSI_SQL + f"""
SELECT CAST({PSI_THRESHOLD} AS DOUBLE) AS psi_threshold, count(*) AS n_features,
       count(*) FILTER (drifted) AS n_drifted_features, bool_or(drifted) AS drifted FROM report""")
def drift_gate_query(spark, folder):
    return drift_summary(drift_report(*_sides(spark, folder), _FEATURES))


@query("drift_exclusions", _PSI_SQL + """
SELECT f.feature, f.feature IN ('price', 'quantity') AS measured,
       CASE f.feature WHEN 'flat' THEN 'constant' WHEN 'line' THEN 'not computable from this source'
                      WHEN 'gappy' THEN 'not computable from this source' END AS reason,
       CASE WHEN f.feature IN ('price', 'quantity') THEN round(psi, 5) END AS psi
FROM (SELECT unnest(['price', 'quantity', 'line', 'flat', 'gappy']) AS feature) f LEFT JOIN report USING (feature)""")
def drift_exclusions_query(spark, folder):
    measured = ["price", "quantity"]
    coverage = drift_coverage(spark, _FEATURES, measured, {"flat": "constant"})
    report = drift_report(*_sides(spark, folder), measured)
    return coverage.join(report, "feature", "left").select(
        "feature", "measured", "reason", F.round("psi", 5).alias("psi")
    )


@query("stream_drift", _PSI_SQL + " SELECT feature, round(psi, 5) AS psi, drifted FROM report")
def stream_drift_query(spark, folder):
    reference, _ = _sides(spark, folder)
    schema = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    items = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(folder)
    current = items.selectExpr(*_split_columns(_VALUES)).where("year(l_shipdate) >= 1998")
    counts, checkpoint = scratch_path(spark, "drift-counts"), scratch_path(spark, "drift-checkpoint")
    baseline = scratch_path(spark, "drift-baseline")
    edges = store_baseline(reference, _FEATURES, baseline)
    stream_drift_counts(current, edges, counts, checkpoint).awaitTermination()
    report = stream_drift_report(spark, _FEATURES, counts, baseline)
    return report.withColumn("psi", F.round("psi", 5))
