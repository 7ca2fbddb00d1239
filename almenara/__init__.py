"""almenara: cleaning and analysis of incident records on Spark."""
