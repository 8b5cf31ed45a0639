"""Literature mining as Spark jobs: worklists, search, citations, reading, answers."""
