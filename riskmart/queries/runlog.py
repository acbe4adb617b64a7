"""Run-log reports (O family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.plans import runlog as O
from riskmart.queries.registry import ctes, query


@query("o1_etl_dashboard", ctes("""
SELECT ProcedureName, Status, ROUND(AVG(ExecutionTimeSeconds), 6) AS AvgDurationSeconds, MAX(ExecutionTimeSeconds) AS MaxDurationSeconds
FROM run_log GROUP BY 1, 2 ORDER BY 1, 2""", "run_log"))
def o1(t):
    return O.etl_dashboard(t.run_log).withColumn("AvgDurationSeconds", F.round("AvgDurationSeconds", 6))


@query("o2_purge_log", ctes("""
SELECT ProcedureName, RowsProcessed, (SELECT COUNT(*) FROM run_log WHERE ExecutionDateTime < TIMESTAMP '2024-01-20 00:00:00') AS RowsDeleted
FROM run_log WHERE ExecutionDateTime >= TIMESTAMP '2024-01-20 00:00:00'""", "run_log"))
def o2(t):
    kept, dropped = O.purge_log(t.run_log, "2024-02-19", 30)
    return kept.select("ProcedureName", "RowsProcessed").crossJoin(F.broadcast(dropped))


@query("o3_step_timings", ctes("""
SELECT ProcedureName, StepName, ROUND(AVG(ExecutionTimeSeconds), 6) AS AvgSeconds, MAX(ExecutionTimeSeconds) AS MaxSeconds, COUNT(*) AS Executions
FROM run_log WHERE ExecutionDateTime >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2""", "run_log"))
def o3(t):
    return O.step_timings(t.run_log, "2024-01-15").withColumn("AvgSeconds", F.round("AvgSeconds", 6))


@query("o4_table_counts", """
SELECT 'Customer' AS TableName, COUNT(*) AS RowCount FROM customer UNION ALL SELECT 'Events', COUNT(*) FROM events
UNION ALL SELECT 'Lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'Orders', COUNT(*) FROM orders""")
def o4(t):
    return O.table_counts({"Orders": t.orders, "Events": t.events, "Lineitem": t.lineitem, "Customer": t.customer})


@query("o5_append_run_log", ctes("""
SELECT ProcedureName, StepName, Status, RowsProcessed, ExecutionTimeSeconds FROM run_log
UNION ALL SELECT 'load_loans', 'FactLoan', 'Success', COUNT(*), 12 FROM stg_loan""", "run_log", "stg_loan"))
def o5(t):
    entry = O.step_log(t.stg_loan, "load_loans", "FactLoan", 12, "2024-01-30 06:00:00")
    return t.run_log.unionByName(entry).drop("ExecutionDateTime")
