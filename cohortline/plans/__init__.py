"""The event specification, the end-to-end ETL, registered queries and their oracles."""
