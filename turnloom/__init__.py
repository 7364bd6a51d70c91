"""turnloom: DataFrame operators that build and measure conversation corpora on Spark."""
