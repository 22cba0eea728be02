"""Query catalogue over the driver's tables: analogue inputs, Spark plans, SQL oracles."""
