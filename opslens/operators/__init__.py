"""DataFrame -> DataFrame operators: scoring, cleaning, rollups, summaries, insight."""
