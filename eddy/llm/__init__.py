"""Training-data operators: extraction, scoring, deduplication, mixing,
tokenisation, licence scanning and nearest-neighbour search.

Nothing outside this subpackage imports it.  Every operator is a function from
DataFrame to DataFrame; ``eddy.llm.queries`` holds the thin registered queries.
"""
