"""Modules whose QUERIES and SQL make up the training-data query set."""

from pagewright.llm import copies_queries, line_queries, spam_queries, split_queries, token_queries, value_queries, visual_queries

MODULES = [copies_queries, line_queries, spam_queries, split_queries, token_queries, value_queries, visual_queries]
