"""Jobs and views: ingest, staging, warehouse, views, measures, reports."""
