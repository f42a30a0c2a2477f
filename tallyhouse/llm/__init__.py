"""Training-data operators over Spark tables; ``tallyhouse.llm.queries`` registers them."""
