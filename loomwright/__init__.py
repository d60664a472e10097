"""A knowledge-graph curation and text-analytics engine on PySpark."""
