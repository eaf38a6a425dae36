"""Composite plans: the warehouse build, the ETL run, reports, the query catalog."""
