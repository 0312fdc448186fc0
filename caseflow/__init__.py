"""caseflow: incremental analytics over long-lived case records, as Spark DataFrame jobs."""
