"""Daily-report analytics on Spark: ingest, clean, one daily fact, summaries, marts, reports, tests."""
