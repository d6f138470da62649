"""corpusloom: document-collection and learning-graph analytics on Spark DataFrames."""
