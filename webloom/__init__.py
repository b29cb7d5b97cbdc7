"""Web page analytics on Spark: extraction, tagging, link graph, index, search."""
