"""DataFrame -> DataFrame steps of the ETL."""
