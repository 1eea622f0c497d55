"""corpusloom: a wiki-style corpus turned into a ranked search index, on Spark."""
