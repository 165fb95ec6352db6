"""plotloom: table operators for cadastral survey sheets, as Spark DataFrame jobs."""
