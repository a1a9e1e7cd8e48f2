"""Hospital price-transparency charges as Spark tables: ingest, clean, enrich, score, model, export."""
