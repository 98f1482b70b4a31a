"""Country-risk and development-lending analytics as Spark DataFrame operations."""
