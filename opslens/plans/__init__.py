"""End-to-end chains (manufacturing ETL, ecommerce ETL, cross-domain report) and the query catalogue."""
