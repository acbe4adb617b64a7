"""Checks between the staged tables and the mart load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.validate import check_orphans, fraud_rate_drift

REQUIRED = ("Loan", "Fraud", "Market", "Macro")
# Order of the report.
STATUS_ORDER = ("FAIL", "WARN", "PASS")
SEVERITY_ORDER = ("Critical", "High", "Medium", "Low")


class ValidationFailed(RuntimeError):
    """Raised when the gate finds errors and is told to stop on them."""


def _result(category: str, check: str, status: Column, text: Column, rows: Column, severity: Column) -> Column:
    return F.struct(
        F.lit(category).alias("ValidationCategory"), F.lit(check).alias("ValidationCheck"), status.alias("Status"),
        text.alias("Description"), rows.cast("bigint").alias("AffectedRows"), severity.alias("Severity"))


def _two_way(category, check, bad: Column, status: str, severity: str, bad_text: Column, good_text: Column, rows: Column | None = None) -> Column:
    hit = F.coalesce(bad, F.lit(False))
    count = F.when(hit, rows) if rows is not None else F.lit(None)
    return _result(category, check, F.when(hit, status).otherwise("PASS"), F.when(hit, bad_text).otherwise(good_text), count,
                   F.when(hit, severity).otherwise("Low"))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _n2(c: str) -> Column:
    return F.format_number(F.col(c), 2)


def validate_pre_production(tables: Mapping[str, DataFrame | None], log: DataFrame, as_of, threshold_pct: float = 5.0,
                            historical_loan_average: float | None = None) -> DataFrame:
    """PASS / WARN / FAIL rows of the gate, worst first.

    ``log`` holds the run log, ``historical_loan_average`` the mean loan amount of earlier runs (NULL: no comparison).
    Every table is reduced to one row of counts, so what is combined here is a handful of single rows.
    """
    absent = [n for n in REQUIRED if tables.get(n) is None]
    spark = log.sparkSession
    if absent:
        return spark.range(1).select(F.inline(F.array(_result(
            "ETL Process", "Required Tables", F.lit("FAIL"), F.lit("One or more required staging tables are missing"), F.lit(None), F.lit("Critical")))))
    loan, fraud, market, macro = (tables[n] for n in REQUIRED)
    now = F.lit(as_of).cast("timestamp")
    rate = F.col("InterestRate")
    past = {
        n: F.floor(F.avg(F.when((F.col("StepName") == f"Load{n}Data") & (F.col("Status") == "Loaded")
                                & (F.col("ExecutionDateTime") > F.add_months(now, -1)), F.col("RowsProcessed")))).alias(f"past{n}")
        for n in REQUIRED
    }
    done = F.count_if((F.col("StepName") == "StagingLoad") & (F.col("Status") == "Success")
                      & (F.col("ExecutionDateTime") > now - F.expr("INTERVAL 1 DAY")))
    stats = [
        log.agg(done.alias("done"), *past.values()),
        loan.agg(F.count("*").alias("nLoan"), F.count_if(F.col("LoanAmount") <= 0).alias("badAmount"),
                 F.count_if((rate > 30) | (rate < 0)).alias("badRate"), F.avg(F.col("LoanAmount").cast("double")).alias("avgAmount")),
        fraud.agg(F.count("*").alias("nFraud"), F.count_if(F.col("TransactionDate") > now).alias("futureFraud")),
        market.agg(F.count("*").alias("nMarket")),
        macro.agg(F.count("*").alias("nMacro"), F.count_if(F.col("UnemploymentRate") < 0).alias("negativeJobless"),
                  F.min(F.col("UnemploymentRate").cast("double")).alias("loJobless"), F.max(F.col("UnemploymentRate").cast("double")).alias("hiJobless")),
        check_orphans(fraud, loan, "CustomerID"),
        fraud_rate_drift(log, as_of),
    ]
    row = stats[0]
    for s in stats[1:]:
        row = row.crossJoin(F.broadcast(s))
    row = row.withColumns({
        "currentRate": (F.try_divide(F.col("nFraud") * 100.0, F.col("nLoan"))),
        "pastAmount": F.lit(historical_loan_average).cast("double"),
    })
    limit = F.lit(threshold_pct)
    shown = _text(F.lit(threshold_pct).cast("decimal(5,2)"), "%")
    checks = [
        _result("ETL Process", "Required Tables", F.lit("PASS"), F.lit("All required staging tables exist"), F.lit(None), F.lit("Low")),
        _two_way("ETL Process", "ETL Completion", F.col("done") == 0, "WARN", "Medium",
                 F.lit("No successful staging ETL completion found in the last 24 hours"),
                 F.lit("Staging ETL completed successfully within the last 24 hours")),
    ]
    for n in REQUIRED:
        have, usual = F.col(f"n{n}"), F.col(f"past{n}")
        off = F.coalesce((usual > 0) & (F.abs(have - usual) > usual * limit / 100), F.lit(False))
        name = n.lower()
        checks.append(F.when(have == 0, _result("Data Completeness", f"{n} Data", F.lit("FAIL"), F.lit(f"{n} table is empty"), have, F.lit("Critical")))
                      .otherwise(_result(
                          "Data Completeness", f"{n} Data Count", F.when(off, "WARN").otherwise("PASS"),
                          F.when(off, _text(f"Current {name} count (", have, ") differs from average (", usual, ") by more than ", shown))
                          .otherwise(_text(f"{n} count within expected range: ", have, " records")),
                          have, F.when(off, "Medium").otherwise("Low"))))
    was, cur = F.col("historical_rate"), F.col("currentRate")
    checks += [
        _two_way("Data Quality", "Future Fraud Dates", F.col("futureFraud") > 0, "FAIL", "High",
                 _text("Found ", F.col("futureFraud"), " fraud records with future dates"), F.lit("No fraud records with future dates"), F.col("futureFraud")),
        _two_way("Data Quality", "Negative Unemployment Rates", F.col("negativeJobless") > 0, "FAIL", "High",
                 _text("Found ", F.col("negativeJobless"), " macro records with negative unemployment rates"),
                 F.lit("No negative unemployment rates found"), F.col("negativeJobless")),
        _two_way("Statistical Patterns", "Fraud Rate", (was > 0) & (F.abs(cur - was) > was * limit / 100), "WARN", "Medium",
                 _text("Current fraud rate (", _n2("currentRate"), "%) differs from historical rate (", _n2("historical_rate"), "%) by more than ", shown),
                 _text("Fraud rate (", _n2("currentRate"), "%) within expected range of historical average")),
        _two_way("Statistical Patterns", "Unemployment Volatility", F.col("hiJobless") - F.col("loJobless") > 5, "WARN", "Medium",
                 _text("High unemployment volatility detected: range from ", _n2("loJobless"), "% to ", _n2("hiJobless"), "%"),
                 _text("Unemployment rates within reasonable range: ", _n2("loJobless"), "% to ", _n2("hiJobless"), "%")),
        _two_way("Data Quality", "Negative Loan Amounts", F.col("badAmount") > 0, "FAIL", "High",
                 _text("Found ", F.col("badAmount"), " loans with negative or zero amounts"),
                 F.lit("No loans with negative or zero amounts found"), F.col("badAmount")),
        _two_way("Data Quality", "Unusual Interest Rates", F.col("badRate") > 0, "WARN", "Medium",
                 _text("Found ", F.col("badRate"), " loans with interest rates < 0% or > 30%"), F.lit("All interest rates within reasonable range"), F.col("badRate")),
        _two_way("Referential Integrity", "Orphaned Customer IDs", F.col("orphans") > 0, "WARN", "Medium",
                 _text("Found ", F.col("orphans"), " customers in Fraud table not in Loan table"), F.lit("All Customer IDs have matching records"), F.col("orphans")),
        _two_way("Statistical Patterns", "Loan Amount Distribution",
                 (F.col("pastAmount") > 0) & (F.abs(F.col("avgAmount") - F.col("pastAmount")) > F.col("pastAmount") * limit / 100), "WARN", "Medium",
                 _text("Current average loan amount ($", _n2("avgAmount"), ") differs from historical average ($", _n2("pastAmount"), ") by more than ", shown),
                 _text("Average loan amount ($", _n2("avgAmount"), ") within expected range of historical average")),
    ]
    return row.select(F.inline(F.array(*checks))).orderBy(
        F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("Status")),
        F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("Severity")), "ValidationCategory", "ValidationCheck")


def blocking_log(results: DataFrame, batch_id: str, as_of) -> DataFrame:
    """Log rows of everything that did not pass; FAIL with Critical blocks the load."""
    return results.filter("Status <> 'PASS'").select(
        F.lit(batch_id).alias("BatchID"), F.lit(as_of).cast("timestamp").alias("ExecutionDateTime"), "ValidationCategory",
        F.col("ValidationCheck").alias("DataSource"), F.col("Description").alias("ErrorType"), "Severity",
        F.col("AffectedRows").alias("ErrorCount"),
        ((F.col("Status") == "FAIL") & (F.col("Severity") == "Critical")).cast("int").alias("IsBlocking"))


def overall_status(results: DataFrame) -> DataFrame:
    """One row: FAIL, WARN or PASS, the number of each, and the joined messages of the failures."""
    failures = F.filter(F.sort_array(F.collect_list(F.struct("Status", F.concat_ws(": ", "ValidationCheck", "Description").alias("m")))),
                        lambda x: x["Status"] == "FAIL")
    counts = [F.count_if(F.col("Status") == s).alias(s.lower()) for s in STATUS_ORDER]
    row = results.agg(*counts, F.array_join(F.transform(failures, lambda x: x["m"]), "\r").alias("message"))
    return row.select(F.when(F.col("fail") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("PASS").alias("Status"),
                      F.col("fail").alias("failed"), F.col("warn").alias("warned"), F.col("pass").alias("passed"), "message")


def require_pass(results: DataFrame) -> None:
    """Stop with the joined messages when any check failed."""
    row = overall_status(results).first()
    if row["Status"] == "FAIL":
        raise ValidationFailed(f"pre-production validation failed: {row['message']}")
