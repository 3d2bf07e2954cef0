"""Medallion and history engine on Spark SQL: landed batches in, historised and enriched relations out."""
