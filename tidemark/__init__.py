"""tidemark: layered table refinement (raw -> bronze -> silver -> history -> gold) on Spark."""
