"""matchlake: bronze, silver and gold tables for sports results, built with the Spark DataFrame API."""
